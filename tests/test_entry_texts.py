"""Records travel to their pages as text."""

from recordloom.sources import star_tables as star
from recordloom.specs import CONDITION


def test_records_are_stored_as_text_of_their_entries(spark, folder, monkeypatch):
    tables = [star.table(spark, folder, name) for name in ("lineitem", "orders", "part")]
    kept, stored = [], star.stored
    monkeypatch.setattr(star, "stored", lambda df: kept.append(df.dtypes) or stored(df))
    star.pages_of(star.conditions(*tables), CONDITION)
    assert kept == [[("entry", "string")]]
