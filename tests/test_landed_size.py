"""Landed pages are compressed."""

from pathlib import Path

from recordloom.operators.landing import land_pages
from recordloom.session import new_folder
from recordloom.sources import star_tables as star
from recordloom.sources.pages import read_page_texts
from recordloom.specs import ENCOUNTER


def test_landed_files_are_smaller_than_their_text(spark, folder):
    landing = new_folder(spark, "landing")
    path = land_pages(star.encounters(star.table(spark, folder, "orders")), landing, ENCOUNTER, star.DAY)
    texts = read_page_texts(spark, landing, ENCOUNTER, [star.DAY], one_per_line=True)
    held = sum(f.stat().st_size for f in Path(path.removeprefix("file:")).glob("part-*"))
    assert held * 2 < sum(len(r["value"]) for r in texts.select("value").collect())
