"""Secrets in texts, told apart by who holds them. Built-in functions only.

Every text is scanned for spans of the kinds below. A span's value is hashed, and for each hash the distinct owners and
the distinct repositories that hold it are counted over the whole corpus. What many owners hold is an example that was
copied from somewhere; what one owner alone holds, and looks random, is taken to be live. The base kinds are reported
whatever the verdict; spans of the wider kinds only if they are live and touch no base span.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.session import stored

# The kinds in their order. The value is the last group. Runs that are too short are no match of the
# patterns for access and hex, which is the same as dropping them, because a run is always taken whole.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"(AKIA[A-Z0-9]{14,})"
HEX = r"([0-9a-f]{16,})"
# Public shapes of issued keys, and any long run that mixes cases and digits.
ISSUED = (
    r"(gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}"
    r"|AIza[A-Za-z0-9_-]{35}|eyJ[A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,}[.][A-Za-z0-9_-]{8,})"
)
LOOSE = r"([A-Za-z0-9+/_-]{24,})"
KINDS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "issued": ISSUED, "loose": LOOSE}
BASE = 3  # the first kinds
LEAST_ASSIGNED = 12  # characters of an assigned value
PLACEHOLDER = "(?i)example|sample|dummy|test|changeme|placeholder|your|redacted|xxxx|0000|1234|abcd"

DISTINCT_CHARACTERS = 10  # a value with fewer different ones does not look random
WIDE_OWNERS = 3  # owners from which a value is a copied example
SALTS = 4096
RUN = 500

SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _sums(values: Column) -> Column:
    zero = F.array().cast("array<int>")
    return F.aggregate(values, zero, lambda a, x: F.array_append(a, F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)) + x))


def running_sums(values: Column) -> Column:
    """Running sums of a non-empty array: within runs of RUN, then over the runs, so that a long array costs little more."""
    firsts = F.sequence(F.lit(1), F.size(values), F.lit(RUN))
    inner = F.transform(firsts, lambda at: _sums(F.slice(values, at, RUN)))
    ends = _sums(F.transform(inner, lambda r: F.element_at(r, -1)))
    before = F.concat(F.array(F.lit(0)), F.slice(ends, 1, F.size(ends) - 1))
    return F.flatten(F.zip_with(inner, before, lambda r, b: F.transform(r, lambda x: x + b)))


def spans(text: Column, kind: int, pattern: str) -> Column:
    """Leftmost non-overlapping matches: start and end in code points, and the value."""
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    sizes = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, w: F.length(g) + F.length(w))
    value = lambda w: F.regexp_extract(w, pattern, 1) if kind == 0 else w
    each = F.zip_with(
        found,
        running_sums(sizes),
        lambda w, end: F.struct((end - F.length(w)).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), value(w).alias("value")),
    )
    return F.when(F.size(gaps) > 1, each).otherwise(F.array().cast(SPAN)).cast(SPAN)


def looks_random(value: Column) -> Column:
    """Many different characters, a digit among them, and no word of an example."""
    varied = F.size(F.array_distinct(F.split(value, ""))) >= DISTINCT_CHARACTERS
    return varied & value.rlike("[0-9]") & ~value.rlike(PLACEHOLDER)


def scanned(documents: DataFrame, owner: str, repository: str) -> DataFrame:
    """One stored row per document: row, doc_id, owner, repository, base and more (arrays of spans)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    names = {name: spans(F.col("_text"), at, pattern) for at, (name, pattern) in enumerate(KINDS.items())}
    found = documents.select(
        "doc_id",
        F.coalesce(F.col(owner).cast("string"), F.lit("")).alias("owner"),
        F.coalesce(F.col(repository).cast("string"), F.lit("")).alias("repository"),
        text.alias("_text"),
    ).select("doc_id", "owner", "repository", *[c.alias(name) for name, c in names.items()])
    mixed = lambda s: s["value"].rlike("[0-9]") & s["value"].rlike("[a-z]") & s["value"].rlike("[A-Z]")
    long_enough = F.filter("assign", lambda s: F.length(s["value"]) >= LEAST_ASSIGNED)
    return stored(
        found.select(
            F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repository",
            F.array_sort(F.concat(long_enough, "access", "hex")).alias("base"),
            F.concat("issued", F.filter("loose", mixed)).alias("more"),
        )
    )


def ownership(candidates: DataFrame) -> DataFrame:
    """hash, n_owners and n_repositories for every hash of `candidates` (hash, owner, repository).

    A repository belongs to its owner, so distinct repositories are distinct pairs. Each step adds up before it shuffles
    and lowers a hash that is everywhere to one row per owner.
    """
    pairs = candidates.groupBy("hash", "owner", "repository").agg(F.lit(1).alias("one"))
    owners = pairs.groupBy("hash", "owner").agg(F.count("*").alias("n"))
    return owners.groupBy("hash").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repositories"))


def _text_of(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    line = lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, line), ",")


def _apart(live: DataFrame, base: DataFrame) -> DataFrame:
    """Spans of `live` (row, start, kind, end) that touch no base span of their row, nor an earlier one of `live`."""
    both = live.withColumn("is_base", F.lit(False)).unionByName(base.withColumn("is_base", F.lit(True)))
    order = [F.col("start"), F.col("is_base").desc(), F.col("kind"), F.col("end")]
    back = [F.col("start").desc(), F.col("is_base").asc(), F.col("kind").desc(), F.col("end").desc()]
    before, after = (Window.partitionBy("row").orderBy(*o).rowsBetween(Window.unboundedPreceding, -1) for o in (order, back))
    at_base = F.when(F.col("is_base"), F.col("start"))
    placed = both.withColumns({"_end": F.max("end").over(before), "_next": F.last(at_base, ignorenulls=True).over(after)})
    free = (F.coalesce("_end", F.lit(0)) <= F.col("start")) & (F.coalesce("_next", F.col("end")) >= F.col("end"))
    return placed.filter(~F.col("is_base") & free).select("row", "start", "kind", "end")


def secrets(documents: DataFrame, owner: str = "source", repository: str = "doc_id") -> DataFrame:
    """One row per row of `documents`: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_copied.

    n_live counts the spans of the row, of any kind, whose value one owner alone holds and which looks random; n_copied
    those whose value at least WIDE_OWNERS owners hold. A null text is empty; a null owner is an owner, a null repository
    a repository of each owner. Repeated rows are reported each, and are one repository. Extra columns play no part. An
    empty table gives no rows. Texts are read once and never shuffled; what moves is one row per span.
    """
    texts = scanned(documents, owner, repository)
    each = texts.select("row", "owner", "repository", F.explode(F.concat("base", "more")).alias("s"))
    salt = F.pmod(F.xxhash64("owner", "repository"), F.lit(SALTS)).cast("int")
    found = stored(
        each.select(
            "row", "owner", "repository", salt.alias("salt"), F.unhex(F.sha2("s.value", 256)).alias("hash"),
            looks_random(F.col("s.value")).alias("random"), "s.start", "s.kind", "s.end",
        )
    )
    # Verdicts go to the (hash, salt) pairs that occur: a hash of many documents is met in up to SALTS places.
    verdicts = found.select("hash", "salt").distinct().join(ownership(found), "hash")
    judged = stored(
        found.join(verdicts, ["hash", "salt"]).select(
            "row", "start", "kind", "end",
            ((F.col("n_owners") == 1) & F.col("random")).alias("live"),
            (F.col("n_owners") >= WIDE_OWNERS).alias("copied"),
        )
    )
    place = ["row", "start", "kind", "end"]
    extra = judged.filter((F.col("kind") >= BASE) & F.col("live")).select(*place)
    rows = extra.select("row").distinct()
    base = judged.filter(F.col("kind") < BASE).select(*place).join(rows, "row", "left_semi")
    span = F.struct("start", "kind", "end")
    added = _apart(extra, base).groupBy("row").agg(F.collect_list(span).alias("added"))
    totals = judged.groupBy("row").agg(F.count_if("live").alias("n_live"), F.count_if("copied").alias("n_copied"))
    slim = F.transform("base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    out = texts.join(totals, "row", "left").join(added, "row", "left").withColumn("slim", slim)
    every = F.when(F.col("added").isNull(), F.col("slim")).otherwise(F.array_sort(F.concat("slim", "added")))

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    counts = [number(kind).alias(f"n_{name}") for kind, name in enumerate(list(KINDS)[:BASE])]
    return out.select(
        "doc_id", *counts, F.sha2(_text_of(F.col("slim")), 256).alias("base_sha256"), _text_of(every).alias("spans"),
        F.coalesce("n_live", F.lit(0)).alias("n_live"), F.coalesce("n_copied", F.lit(0)).alias("n_copied"),
    )
