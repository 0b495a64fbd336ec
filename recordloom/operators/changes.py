"""What a batch would do to a history, without doing it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.operators.history import content, position
from recordloom.specs import ID

NEW, CHANGED, UNCHANGED, SEEN = "new", "changed", "unchanged", "seen"


def detect_changes(current: DataFrame, batch: DataFrame) -> DataFrame:
    """One row per id of the batch: its newest hash, the current one, and the kind of change.

    A newest version at or before last_seen is `seen`: it is a replay, or comes late, and changes nothing current. The
    batch is brought down to one row per id before the join, so both sides are unique.
    """
    value = content([c for c in batch.columns if c in current.columns])
    newest = F.max_by(F.struct(value.alias("value"), position().alias("at")), position()).alias("_new")
    incoming = batch.groupBy(ID).agg(newest)
    known = current.select(ID, "last_seen", value.alias("_old"))
    kind = (
        F.when(F.col("last_seen").isNull(), NEW)
        .when(F.col("_new.at") < F.col("last_seen"), SEEN)
        .when(F.col("_new.value").eqNullSafe(F.col("_old")), UNCHANGED)
        .when(F.col("_new.at") == F.col("last_seen"), SEEN)
        .otherwise(CHANGED)
    )
    return incoming.join(known, ID, "left").select(
        ID, F.col("_new.value.record_hash").alias("new_hash"), F.col("_old.record_hash").alias("old_hash"), kind.alias("change")
    )


def rows_to_write(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of the batch whose id is new or changed.

    A semi-join: an id that occurs several times selects its rows once, it does not multiply them.
    """
    wanted = detect_changes(current, batch).filter(F.col("change").isin(NEW, CHANGED))
    return batch.join(wanted, ID, "left_semi")


def change_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("change").agg(F.count(F.lit(1)).alias("ids"))
