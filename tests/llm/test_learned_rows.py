"""Learning counts every labelled row that is not held out."""

from pyspark.sql import functions as F

from recordloom.llm import language


def test_all_labelled_rows_are_learned_from(spark, monkeypatch):
    rows = spark.range(14_000).select(F.col("id").alias("doc_id"), F.lit("aa").alias("lang"), F.lit("word").alias("text"))
    kept, stored = [], language.stored
    monkeypatch.setattr(language, "stored", lambda df: kept.append(stored(df)) or kept[-1])
    language.learn(rows, rounds=0)
    assert kept[0].agg(F.sum("n")).first()[0] == rows.filter(~language.is_held_out()).count() > 10_000
