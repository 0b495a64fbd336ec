"""Version histories: every change of a record as one row with the time it was valid.

A history row has the flat columns of the version, record_hash, and
  valid_from, valid_to  source time of this version and of the next differing one (NULL: none yet),
  is_current            no differing version follows; at most one row per id,
  scd_updated_at        run that last wrote the row,
  last_seen             newest version of the id read so far, also when it changed nothing.

Versions that repeat the hash before them are not kept. All functions are DataFrame in, DataFrame
out; `deliveries` arguments come from cleaning.deliveries().
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from recordloom.functions.columns import record_hash
from recordloom.operators.cleaning import ORDER, first_deliveries, newest_versions, with_order
from recordloom.operators.skew import HOT_ROWS, split_hot
from recordloom.session import settled_keys, stored
from recordloom.operators.bundles import LINEAGE
from recordloom.specs import ID, UPDATED, VERSION

HISTORY_COLUMNS = ("is_current", "valid_from", "valid_to", "scd_updated_at", "last_seen")

# Columns that say nothing about the record: all others decide whether a version is a change.
ABOUT = {ID, VERSION, UPDATED, "meta_source", "full_url", *LINEAGE, *HISTORY_COLUMNS, *ORDER, "_seen", "_written"}


def position() -> Column:
    """Place of a version among those of its id; compares like the ORDER columns sort."""
    return F.struct(
        F.col("_at").alias("updated"), F.col("_number").alias("number"), F.col("_version").alias("version")
    )


def content(columns: list[str], prefix: str = "") -> Column:
    """What makes a version differ: the hash, and the hashed values themselves, as hashes can collide."""
    return F.struct(*[F.col(f"{prefix}{c}") for c in columns if c not in ABOUT])


def _moment(at: datetime | Column) -> Column:
    return at if isinstance(at, Column) else F.lit(at).cast("timestamp")


# --- neighbours in time -----------------------------------------------------------------------


def _by_id() -> WindowSpec:
    return Window.partitionBy(ID).orderBy(*ORDER)


def _sliced(rows: DataFrame) -> DataFrame:
    """Rows of hot ids cut by range into time slices, so that no task gets a whole id."""
    return rows.repartitionByRange(ID, *ORDER).withColumn("_slice", F.spark_partition_id())


def _neighbour(
    rows: DataFrame, name: str, value: Column, ahead: bool, sliced: bool, along: dict[str, Column] | None = None
) -> DataFrame:
    """Add `value` of the previous (or, `ahead`, the next) version of the same id.

    `along` are more columns over windows of the whole id, for rows that are not sliced: they share the pass.
    Sliced rows look inside their slice first. Only the outermost rows of the slices, two per slice,
    are brought together per id to look across the borders.
    """
    look = F.lead if ahead else F.lag
    if not sliced:
        return rows.withColumns({**(along or {}), name: look(value).over(_by_id())})
    in_slice = Window.partitionBy(ID, "_slice").orderBy(*ORDER)
    marked = rows.withColumns(
        {
            "_near": look(value).over(in_slice),
            "_first": F.lag(F.lit(1)).over(in_slice).isNull(),
            "_last": F.lead(F.lit(1)).over(in_slice).isNull(),
        }
    )
    border = F.when(F.col("_first") | F.col("_last"), -1).otherwise(F.col("_slice"))
    across = Window.partitionBy(ID, border).orderBy(*ORDER)
    at_border = F.col("_last" if ahead else "_first")
    found = F.when(at_border, look(value).over(across)).otherwise(F.col("_near"))
    return marked.withColumn(name, found).drop("_near", "_first", "_last")


def _link(rows: DataFrame, run_at: Column, sliced: bool, along: dict[str, Column] | None = None) -> DataFrame:
    """Unique versions with last_seen (in the rows or `along`) to history rows: drop unchanged ones, set validity."""
    value = content([c for c in rows.columns if c != "_slice"])
    kept = _neighbour(rows, "_before", value, False, sliced, along).filter(~F.col("_before").eqNullSafe(value))
    linked = _neighbour(kept, "_after", F.struct("_at"), True, sliced)
    is_open = F.col("_after").isNull()
    return linked.withColumns(
        {
            "is_current": is_open,
            "valid_from": F.col("_at"),
            "valid_to": F.col("_after._at"),
            "scd_updated_at": F.coalesce(F.when(is_open, F.col("_written")), run_at),
        }
    ).drop("_before", "_after", "_slice", "_written", "_seen", *ORDER)


def _by_key(rows: DataFrame, hashed: Sequence[str] | None) -> DataFrame:
    """Rows shuffled by id, without what is derived.

    A hash is what a shuffle can compress least. Where it is known which columns are `hashed`, delivered rows get theirs
    again afterwards; stored rows keep the one they were written with.
    """
    rows = rows.drop(*ORDER)
    if hashed is None:
        return rows.repartition(ID)
    kept = F.when(F.col("_written").isNotNull(), F.col("record_hash"))
    dealt = rows.withColumn("record_hash", kept).repartition(ID)
    return dealt.withColumn("record_hash", F.coalesce("record_hash", record_hash(hashed)))


def _history_of(
    rows: DataFrame,
    run_at: Column,
    hot_rows: int,
    among: DataFrame | None = None,
    hashed: Sequence[str] | None = None,
) -> DataFrame:
    """History rows of deliveries; `_written` is the time an already stored row was last written, `_seen` its last_seen.

    Ordinary ids need one shuffle: de-duplication and all neighbour windows share it. Ids with
    `hot_rows` rows or more are cut into time slices instead; they are looked up `among` rows that are cheaper to read.
    """
    ordinary, hot = split_hot(rows, ID, hot_rows, among)
    once = with_order(first_deliveries(_by_key(ordinary, hashed)))
    whole = _by_id().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    result = _link(once, run_at, False, {"last_seen": F.max(F.greatest(position(), "_seen")).over(whole)})
    if hot is not None:
        spread = stored(first_deliveries(hot))  # read by the totals, the range bounds and the slices
        seen = stored(spread.groupBy(ID).agg(F.max(F.greatest(position(), "_seen")).alias("last_seen")))
        result = result.unionByName(_link(_sliced(spread).join(seen, ID), run_at, True))
    return result


def _never() -> Column:
    return F.when(F.lit(False), position())


# --- whole histories --------------------------------------------------------------------------


def rebuild(
    deliveries: DataFrame,
    run_at: datetime | Column,
    hot_rows: int = HOT_ROWS,
    among: DataFrame | None = None,
    hashed: Sequence[str] | None = None,
) -> DataFrame:
    """The history of everything delivered, in source time.

    Hot ids are looked up in `among`, if given: rows that hold at least the deliveries of each of the ids, and that need
    no join to be read. `hashed`, if given, are the columns that the deliveries' record_hash is made of, as in their spec:
    it is then not shuffled.
    """
    rows = deliveries.withColumns({"_written": F.lit(None).cast("timestamp"), "_seen": _never()})
    return _history_of(rows, _moment(run_at), hot_rows, among, hashed)


def current_rows(history: DataFrame) -> DataFrame:
    return history.filter("is_current")


def as_of(history: DataFrame, moment: datetime | Column) -> DataFrame:
    """Rows valid at `moment`, at most one per id."""
    moment = _moment(moment)
    ended = F.col("valid_to") <= moment
    return history.filter((F.col("valid_from") <= moment) & ~F.coalesce(ended, F.lit(False)))


# --- one batch more, exact --------------------------------------------------------------------


def apply(
    history: DataFrame,
    batch: DataFrame,
    deliveries: DataFrame,
    run_at: datetime | Column,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The whole history after `batch`, exact for late, repeated and several versions per id.

    Ids in the batch are rebuilt from all their `deliveries` (which include the batch); the others
    pass unchanged.
    """
    touched, _ = settled_keys(batch.select(ID))
    return history.join(touched, ID, "left_anti").unionByName(
        rebuild(deliveries.join(touched, ID, "left_semi"), run_at, hot_rows)
    )


# --- one batch more, newer versions only ------------------------------------------------------


def _split_current(current: DataFrame, batch: DataFrame, touched: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Current rows as (rows of ids not in the batch, stored rows of ids in the batch); `touched` are the batch's ids.

    The current set is only scanned, unless the batch has too many ids to broadcast.
    """
    if touched is None:
        touched, _ = settled_keys(batch.select(ID))
    return current.join(touched, ID, "left_anti"), stored(current.join(touched, ID, "left_semi"))


def _continue(
    starts: DataFrame,
    batch: DataFrame,
    run_at: Column,
    hot_rows: int,
    among: DataFrame | None = None,
    hashed: Sequence[str] | None = None,
) -> DataFrame:
    """Link the newer versions of the batch behind the current rows of their ids.

    Ids without a current row start with the batch. The start adds one row to an id, so hot ids are looked up in the
    batch, or `among` rows that hold at least the batch, without the joins below.
    """
    among = batch if among is None else among
    if starts.isEmpty():
        return rebuild(batch, run_at, hot_rows, among, hashed)
    seen = starts.select(ID, "last_seen")
    is_newer = F.col("last_seen").isNull() | (position() > F.col("last_seen"))
    newer = batch.join(seen, ID, "left").filter(is_newer).drop("last_seen")
    # A replayed version may have been seen without being kept, so what was seen is carried along.
    open_rows = with_order(starts).withColumns({"_written": F.col("scd_updated_at"), "_seen": F.col("last_seen")})
    open_rows = open_rows.drop(*HISTORY_COLUMNS)
    chains = open_rows.unionByName(newer.withColumns({"_written": F.lit(None).cast("timestamp"), "_seen": _never()}))
    return _history_of(chains, run_at, hot_rows, among, hashed)


def extend(
    current: DataFrame, batch: DataFrame, run_at: datetime | Column, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """What a batch of newer versions adds: the versions it closes, and the whole new current set.

    Reads only current rows; rows closed earlier stay where they are. Versions at or before last_seen
    are left out, so a repeated batch changes nothing. Ids from late_ids() need apply(). A version is
    taken to keep its time: one delivered again under a later time counts as new here.
    """
    untouched, starts = _split_current(current, batch)
    return untouched.unionByName(_continue(starts, batch, _moment(run_at), hot_rows))


def late_ids(current: DataFrame, batch: DataFrame, earlier: DataFrame) -> DataFrame | None:
    """Ids for which the batch brings an unknown version older than one already seen; None if none.

    `earlier` are the deliveries before the batch. Repeats of the newest version, the usual overlap,
    are settled without them, and where the batch has nothing older they are not read at all.
    """
    if current.isEmpty():
        return None
    seen = current.select(ID, "last_seen")
    before = batch.join(seen, ID).filter(position() < F.col("last_seen"))
    older, count = settled_keys(before.select(ID, VERSION))
    if not count:
        return None
    known = earlier.select(ID, VERSION).join(older, [ID, VERSION], "left_semi")
    late, count = settled_keys(older.join(known, [ID, VERSION], "left_anti").select(ID))
    return late if count else None


def delta(
    current: DataFrame,
    batch: DataFrame,
    earlier: DataFrame,
    run_at: datetime | Column,
    hot_rows: int = HOT_ROWS,
    derived: DataFrame | None = None,
    touched: DataFrame | None = None,
    hashed: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of the ids in `batch` and `derived` only, and the late ids (None if there are none).

    For an id in order: the versions the batch closes and the new current one. For a late id: its whole
    rebuilt history, which replaces all that was stored for it. The same for the ids in `derived`, distinct and stored,
    whatever they had before; `touched`, which is needed with them, are the other ids of the batch.

    Ids with their whole history and the others go through the same joins and windows, so nothing delivered is read twice.
    """
    run_at = _moment(run_at)
    _, starts = _split_current(current, batch, touched)
    late = late_ids(starts, batch, earlier)
    if late is None and derived is None:
        return _continue(starts, batch, run_at, hot_rows, hashed=hashed), None
    whole = derived if late is None else late.select(ID) if derived is None else derived.unionByName(late.select(ID))
    arrived = earlier.withColumn("_new", F.lit(False)).unionByName(batch.withColumn("_new", F.lit(True)))
    marked = arrived.join(whole.select(ID, F.lit(True).alias("_whole")), ID, "left")
    wanted = marked.filter(F.col("_new") | F.col("_whole").isNotNull()).drop("_new", "_whole")
    on_time = starts if late is None else stored(starts.join(late, ID, "left_anti"))
    return _continue(on_time, wanted, run_at, hot_rows, arrived, hashed), late


def step(
    current: DataFrame,
    batch: DataFrame,
    earlier: DataFrame,
    run_at: datetime | Column,
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame | None]:
    """Like delta(), with the current rows of all other ids added."""
    untouched, _ = _split_current(current, batch)
    rows, late = delta(current, batch, earlier, run_at, hot_rows)
    return untouched.unionByName(rows), late


def apply_in_order(
    history: DataFrame,
    batch: DataFrame,
    earlier: DataFrame,
    run_at: datetime | Column,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The whole history after `batch`, by step()."""
    rows, late = step(current_rows(history), batch, earlier, run_at, hot_rows)
    closed = history.filter(~F.col("is_current"))
    if late is not None:
        closed = closed.join(late, ID, "left_anti")
    return closed.unionByName(rows)


# --- histories in run time --------------------------------------------------------------------


def first_load(deliveries: DataFrame, run_at: datetime | Column) -> DataFrame:
    """A history that starts with this run: the newest version of each id, valid from the run on."""
    run_at = _moment(run_at)
    return _opened(newest_versions(deliveries), run_at)


def _opened(newest: DataFrame, run_at: Column) -> DataFrame:
    return newest.withColumns(
        {
            "last_seen": position(),
            "is_current": F.lit(True),
            "valid_from": run_at,
            "valid_to": F.lit(None).cast("timestamp"),
            "scd_updated_at": run_at,
        }
    ).drop(*ORDER)


def merge(current: DataFrame, batch: DataFrame, run_at: datetime | Column) -> DataFrame:
    """Like extend(), in run time: a changed row ends at the run, its newest version starts there.

    Only the newest version of each id in the batch counts, and only if it is newer than what was
    seen. Absence from the batch does not end a row.
    """
    run_at = _moment(run_at)
    opened = _opened(newest_versions(batch), run_at)
    columns = [c for c in current.columns if c != ID]
    incoming = opened.select(ID, F.struct(*columns).alias("_new"))
    both = current.select(ID, F.struct(*columns).alias("_old")).join(incoming, ID, "left")

    newer = F.coalesce(F.col("_new.last_seen") > F.col("_old.last_seen"), F.lit(False))
    changed = newer & ~content(columns, "_new.").eqNullSafe(content(columns, "_old."))
    seen = F.col("_old").withField("last_seen", F.when(newer, F.col("_new.last_seen")).otherwise(F.col("_old.last_seen")))
    ended = (
        F.col("_old")
        .withField("is_current", F.lit(False))
        .withField("valid_to", run_at)
        .withField("scd_updated_at", run_at)
    )
    outcome = F.when(changed, F.array(ended, F.col("_new"))).otherwise(F.array(seen))
    known = both.select(ID, F.inline(outcome))
    unknown = opened.join(current.select(ID), ID, "left_anti")
    return known.unionByName(unknown)
