"""What Python workers hold: one function call per text and task, no words of a finished step."""

import pandas as pd
from pyspark.sql import functions as F

from recordloom.llm import jaccard_join, packing, quality
from recordloom.llm.queries import ready
from recordloom.llm.tokens import default_path, tokens

COLUMNS = "doc_id long, text string, lang string, source string"


def texts(spark):
    rows = [(i % 25, " ".join(f"w{(i % 25) * 7 + j}" for j in range(60)), "en", f"s{i % 2}") for i in range(50)]
    return spark.createDataFrame(rows + [(None, None, None, None)], COLUMNS)


def calls(df):
    """Python function calls in a plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.count("ArrowEvalPython")


def test_quality_scans_a_text_once_to_judge_it(spark):
    kept = quality.keep_good(texts(ready(spark)))
    assert calls(kept) == 1
    assert kept.count() == 50


def test_near_copies_scan_a_text_once_per_side(spark):
    one = jaccard_join.keep_one(texts(ready(spark)))
    assert calls(one) == 2  # rows that stay as they are, and one of each repeated row
    assert sorted(r["doc_id"] for r in one.filter(F.col("text").isNotNull()).collect()) == list(range(25))


def test_packing_groups_drop_cached_words():
    words = tokens(default_path())
    words.ids("some words of a step that has ended")
    assert words
    packing._pack(2048)(pd.DataFrame({"group": [0], "row": [0], "length": [5]}))
    assert not words
