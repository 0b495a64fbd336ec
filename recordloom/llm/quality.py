"""Quality rules by robust multivariate outliers.

Each document that passes the base rules becomes a vector of four transformed rates. For each language and source the
minimum-covariance-determinant estimate of centre and scatter is found by concentration steps: distances under the
present estimate, then mean and covariance of the nearest three quarters, until the determinant falls no further. Two
starts are followed, medians with quartile ranges and mean with covariance; the smaller determinant wins. Languages and
the whole corpus get estimates in the same way, and each estimate is drawn towards the wider one as if that were PRIOR
further rows. A document is rejected when its Mahalanobis distance is beyond a far quantile of chi-square. Every step is
an aggregation over all vectors; only one row per group is ever turned into a matrix, by tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from recordloom.llm.text_stats import STATS_TYPE, text_counts
from recordloom.llm.tokens import forget
from recordloom.session import stored

LEAST_WORDS = 50
CORE = 0.75  # share of a group that the estimate rests on
FALL = 0.01  # of the logarithm of the determinant; a group stops when a step brings less
PRIOR = 50  # rows that the wider estimate counts for
BEYOND = 1e-3  # share of a normal population beyond the limit
VECTOR = ("v0", "v1", "v2", "v3")
# A ridge for statistics that are zero in most documents, whose own scatter is then zero or near it: log word length, log
# symbols, root shares of lines and words. Each statistic can go beyond the limit by itself.
FLOORS = (0.01, 0.02, 0.08, 0.08)
DIM = len(VECTOR)
PAIRS = [(i, j) for i in range(DIM) for j in range(i, DIM)]
ESTIMATE = [f"m{i}" for i in range(DIM)] + [f"s{i}{j}" for i, j in PAIRS]
PARAMETERS = [f"m{i}" for i in range(DIM)] + [f"p{i}{j}" for i, j in PAIRS]
KEYS = ("group_lang", "group_source")


def chi_square(x: float, freedom: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(freedom // 2))


def chi_square_quantile(share: float, freedom: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < share else (low, middle)
    return high


LIMIT = chi_square_quantile(1 - BEYOND, DIM)
# The nearest three quarters of a normal population spread less than all of it.
CONSISTENT = CORE / chi_square(chi_square_quantile(CORE, DIM), DIM + 2)


def _counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    forget()
    for column in batches:
        yield text_counts(column)


def with_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """`documents` with a struct `counts` in place of any column of that name.

    Spark would copy a deterministic function into each filter on its result: texts would be scanned twice, by two Python
    workers per core.
    """
    return documents.withColumn("counts", arrow_udf(_counts, STATS_TYPE).asNondeterministic()(F.col(text).cast("binary")))


def base_failed(counts: str = "counts") -> Column:
    n, repeated = F.col(f"{counts}.n_words"), F.col(f"{counts}.n_repeat_words")
    return (n < LEAST_WORDS) | (100 * repeated > 50 * n)


def vector(counts: str = "counts") -> list[Column]:
    c = {name: F.col(f"{counts}.{name}").cast("double") for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words")}
    words, lines = F.greatest(c["n_words"], F.lit(1.0)), F.greatest(c["n_lines"], F.lit(1.0))
    values = [F.log(F.greatest(c["word_chars"], F.lit(1.0)) / words), F.log1p(c["n_symbols"] / words), F.sqrt(c["n_dup_lines"] / lines), F.sqrt(c["n_repeat_words"] / words)]
    return [v.alias(name) for v, name in zip(values, VECTOR, strict=True)]


def distance() -> Column:
    """Squared Mahalanobis distance of the vector from the centre, by the columns of PARAMETERS."""
    away = [F.col(v) - F.col(f"m{i}") for i, v in enumerate(VECTOR)]
    terms = [(1 if i == j else 2) * away[i] * away[j] * F.col(f"p{i}{j}") for i, j in PAIRS]
    return sum(terms[1:], terms[0])


def _inverses(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """PARAMETERS and the logarithm of the determinant from ESTIMATE."""
    for rows in batches:
        scatter = np.zeros((len(rows), DIM, DIM))
        for i, j in PAIRS:
            scatter[:, i, j] = scatter[:, j, i] = rows[f"s{i}{j}"]
        scatter += np.diag(np.square(FLOORS))
        precision = np.linalg.inv(scatter)
        inverse = {f"p{i}{j}": precision[:, i, j] for i, j in PAIRS}
        yield rows.assign(det=np.linalg.slogdet(scatter)[1], **inverse)


def _parameters(estimates: DataFrame, *keys: str) -> DataFrame:
    columns = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in ESTIMATE]
    types = dict(estimates.dtypes)
    numbers = [*ESTIMATE, "det", *[f"p{i}{j}" for i, j in PAIRS]]
    schema = ", ".join([f"{k} {types[k]}" for k in keys] + [f"{c} double" for c in numbers])
    return estimates.select(*keys, *columns).mapInPandas(_inverses, schema)


def _moments(scale: float) -> list[Column]:
    means = [F.avg(v).alias(f"m{i}") for i, v in enumerate(VECTOR)]
    return means + [(F.covar_pop(VECTOR[i], VECTOR[j]) * scale).alias(f"s{i}{j}") for i, j in PAIRS]


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source")})


def _starts(every: DataFrame) -> DataFrame:
    """KEYS, start and ESTIMATE: medians with quartile ranges, and mean with covariance."""
    quartiles = [F.percentile_approx(v, [0.25, 0.5, 0.75], 10_000).alias(v) for v in VECTOR]
    measured = stored(every.groupBy(*KEYS).agg(*quartiles, *_moments(1.0)))
    spread = [F.pow((F.col(v)[2] - F.col(v)[0]) / 1.349, 2) for v in VECTOR]
    robust = [F.col(v)[1].alias(f"m{i}") for i, v in enumerate(VECTOR)]
    robust += [(spread[i] if i == j else F.lit(0.0)).alias(f"s{i}{j}") for i, j in PAIRS]
    first = measured.select(*KEYS, F.lit(0).alias("start"), *robust)
    return first.unionByName(measured.select(*KEYS, F.lit(1).alias("start"), *ESTIMATE))


def _concentrated(every: DataFrame) -> DataFrame:
    """KEYS and ESTIMATE of smallest determinant. Groups that have come to rest take no part in further steps."""
    place = [*KEYS, "start"]
    active = stored(_parameters(_starts(every), *place).withColumn("det", F.lit(float("inf"))))
    steps = [active]
    while not active.isEmpty():
        measured = every.join(active.select(*place, *PARAMETERS), list(KEYS)).withColumn("d2", distance())
        measured = measured.select(*place, *VECTOR, "d2")
        core = stored(measured.groupBy(*place).agg(F.percentile_approx("d2", CORE, 10_000).alias("core")))  # small: rows stay put
        near = measured.join(core, place).filter("d2 <= core")
        moved = _parameters(near.groupBy(*place).agg(*_moments(CONSISTENT)), *place)
        before = active.select(*place, F.col("det").alias("before"))
        active = stored(moved.join(before, place).filter(F.col("det") < F.col("before") - FALL).drop("before"))
        steps.append(active)
    estimate = F.min_by(F.struct(*ESTIMATE), F.struct("det", "start")).alias("e")
    return reduce(DataFrame.unionByName, steps).groupBy(*KEYS).agg(estimate).select(*KEYS, "e.*")


def _drawn(rows: DataFrame, wider: DataFrame, on: str) -> DataFrame:
    """`rows` (KEYS, n, ESTIMATE) drawn towards the row of `wider` with the same `on`."""
    side = wider.select(on, *[F.col(c).alias(f"_{c}") for c in ESTIMATE])
    mean = lambda c: (F.col("n") * F.col(c) + PRIOR * F.col(f"_{c}")) / (F.col("n") + PRIOR)
    return rows.join(side, on).select(*KEYS, "n", *[mean(c).alias(c) for c in ESTIMATE])


def fit(counted: DataFrame) -> DataFrame:
    """PARAMETERS per lang and source, from `counted` (lang, source, counts): one row for each pair that passes the base rules."""
    vectors = _keyed(counted.filter(~base_failed())).select("lang", "source", *vector())
    lang, source, none = F.concat(F.lit("l:"), "lang"), F.concat(F.lit("s:"), "source"), F.lit("")
    keys = [F.struct(a.alias(KEYS[0]), b.alias(KEYS[1])) for a, b in ((lang, source), (lang, none), (none, none))]
    every = stored(vectors.select(F.explode(F.array(*keys)).alias("key"), *VECTOR).select("key.*", *VECTOR))
    sizes = every.groupBy(*KEYS).agg(F.count("*").alias("n"))
    found = stored(_concentrated(every).join(sizes, list(KEYS)))
    whole = found.filter(f"{KEYS[0]} = ''").withColumn("corpus", F.lit(0))
    languages = found.filter(f"{KEYS[0]} <> '' and {KEYS[1]} = ''").withColumn("corpus", F.lit(0))
    languages = stored(_drawn(languages, whole, "corpus"))
    own = _drawn(found.filter(f"{KEYS[1]} <> ''"), languages, KEYS[0])
    fitted = stored(_parameters(own, *KEYS))
    names = [F.substring(k, 3, 1 << 30).alias(name) for k, name in zip(KEYS, ("lang", "source"), strict=True)]
    return fitted.select(*names, *PARAMETERS)


def judged(counted: DataFrame, parameters: DataFrame) -> DataFrame:
    """`counted` with base_failed, distance2 and kept."""
    names = ["_lang", "_source"]
    side = parameters.withColumnsRenamed({"lang": "_lang", "source": "_source"})
    keyed = counted.withColumns({f"_{c}": F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source")})
    keyed = keyed.withColumns({"base_failed": base_failed(), **{name: v for name, v in zip(VECTOR, vector(), strict=True)}})
    out = keyed.join(side, names, "left").withColumn("distance2", distance())
    out = out.withColumn("kept", ~F.col("base_failed") & (F.coalesce("distance2", F.lit(0.0)) <= LIMIT))
    return out.drop(*names, *VECTOR, *PARAMETERS)


def quality(documents: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed, kept and distance2 per row of `documents` (doc_id, text, lang, source).

    A null text counts as empty and fails the base rules, as every text below fifty words does. Null lang or source form
    groups of their own. Repeated rows are judged alike, each for itself.
    """
    counted = stored(with_counts(documents.select("doc_id", "lang", "source", "text")).drop("text"))
    result = judged(counted, fit(counted))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return result.select("doc_id", *[F.col(f"counts.{c}").alias(c) for c in names], "base_failed", "kept", "distance2")


def keep_good(documents: DataFrame) -> DataFrame:
    """`documents` without those that the rules reject. Texts are scanned twice and never shuffled.

    All columns come back as they were, whatever their names.
    """
    counted = stored(with_counts(documents.select("lang", "source", "text")).drop("text"))
    rows = documents.select("lang", "source", "text", F.struct("*").alias("document"))
    return judged(with_counts(rows), fit(counted)).filter("kept").select("document.*")
