"""Spelling variants: words that differ by one inserted, deleted or replaced character, found by pivotal grams.

A word's bigrams are ordered by how rare they are among all words, equal ones from the left. Its prefix are the first
three; its pivots are two of them that share no character, with the least sum of frequencies, chosen by a dynamic
program over positions. One edit cannot touch both pivots. So of two near words, the one whose prefix ends earlier in
the order has a pivot that the edit left alone, and that gram is in the other's prefix. Where both prefixes end with the
same bigram, up to two more of that bigram may stand before it in the other word, so it is indexed for its first five
places.

Position limits: the edit lies on one side of that gram, the other side is equal letter by letter; and on the edited
side either its outer half or its inner half is equal as well. Pivots and prefix grams are therefore indexed under four
hashes: the gram, the whole untouched side and one half of the other. The half is taken by the pivot's word, and a word
in the index is listed under the halves of a side that is one letter shorter or longer, too. What meets is verified.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.session import stored

LEAST_LENGTH = 7
LEAST_COUNT = 2
ALTERED = 31  # runs whose hash this divides lose a letter
DOMINANCE = 10
PREFIX = 3
TIED = PREFIX + 2  # places of the prefix's last gram that are indexed: an edit makes two new ones at most
COUNTED = 200_000  # words a task counts before it hands them on
PIECE = 1 << 20  # bytes of a long text that are split at once
AT_ONCE = 1 << 17  # letters of words that are indexed at once

# Letters are ASCII letters and U+00C0 to U+00FF; in Latin-1 each is one byte. Only A-Z are lower-cased.
LETTER_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256))


def runs_of(text: str) -> Counter[bytes]:
    """Lower-cased runs of letters in Latin-1, and how often each occurs."""
    counts: Counter[bytes] = Counter()
    at = 0
    clean = text.encode("latin-1", "replace").translate(LETTER_BYTES)
    while at < len(clean):
        end = clean.find(b" ", at + PIECE)
        end = len(clean) if end < 0 else end
        counts.update(clean[at:end].split())
        at = end
    return counts


def altered(run: bytes, salt: int) -> bytes:
    """The word that a run stands for; `salt` is the CRC of the document's id and a colon."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), salt)
    if h % ALTERED:
        return run
    gap = h % len(run)
    return run[:gap] + run[gap + 1 :]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def flush() -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in counts], pa.string())
        out = pa.RecordBatch.from_arrays([words, pa.array(list(counts.values()), pa.int64())], ["word", "n"])
        counts.clear()
        return out

    for batch in batches:
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            salt = zlib.crc32(f"{doc_id}:".encode())
            for run, n in runs_of(text).items():
                word = altered(run, salt) if len(run) >= LEAST_LENGTH else b""
                if len(word) >= LEAST_LENGTH:
                    counts[word] += n
            if len(counts) > COUNTED:
                yield flush()
    if counts:
        yield flush()


def word_counts(documents: DataFrame) -> DataFrame:
    """word and n of all words long and frequent enough, stored."""
    texts = documents.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text").filter("text is not null")
    counted = texts.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return stored(counted.filter(F.col("n") >= LEAST_COUNT))


# --- the index --------------------------------------------------------------------------------


def _matrices(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Numbers of the words of each length, and their letters as rows of bytes, in parts that stay small."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        step = max(1, AT_ONCE // length)
        for low in range(0, len(rows), step):
            part = rows[low : low + step]
            text = "".join([words[i] for i in part.tolist()]).encode("latin-1")
            yield part, np.frombuffer(text, dtype=np.uint8).reshape(len(part), length)


def _grams(letters: np.ndarray) -> np.ndarray:
    return letters[:, :-1].astype(np.int64) * 256 + letters[:, 1:]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1 << 16, dtype=np.int64)
    for batch in batches:
        for _, letters in _matrices(batch.column(0).to_pylist()):
            total += np.bincount(_grams(letters).ravel(), minlength=1 << 16)
    grams = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(grams.astype(np.int32)), pa.array(total[grams])], ["gram", "n"])


def gram_frequencies(words: DataFrame) -> np.ndarray:
    """How often each bigram occurs in `words`; there are at most 90 x 90 kinds."""
    counted = words.select("word").mapInArrow(_count_grams, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    frequency = np.zeros(1 << 16, dtype=np.int64)
    for row in counted.collect():
        frequency[row["gram"]] = row["n"]
    return frequency


def pivots(cost: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of costs by position, the two positions at least two apart with the least sum; infinite costs are not taken.

    The best pair that ends at a position is its cost plus the least cost up to two before; that least is carried along.
    """
    rows = np.arange(len(cost))
    least = np.minimum.accumulate(cost, axis=1)
    total = np.full(cost.shape, np.inf)
    total[:, 2:] = cost[:, 2:] + least[:, :-2]
    second = total.argmin(axis=1)
    reach = np.where(np.arange(cost.shape[1]) <= second[:, None] - 2, cost, np.inf)
    first = reach.argmin(axis=1)
    assert np.isfinite(total[rows, second]).all()
    return first, second


_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SPREAD = np.uint64(0xBF58476D1CE4E5B9)


class Sides:
    """Hashes of parts of equally long words."""

    def __init__(self, letters: np.ndarray):
        self.length = letters.shape[1]
        self.sums = np.zeros((letters.shape[0], self.length + 1), dtype=np.uint64)
        for at in range(self.length):
            self.sums[:, at + 1] = self.sums[:, at] * _FACTOR + (letters[:, at].astype(np.uint64) + np.uint64(1))
        self.powers = np.ones(self.length + 1, dtype=np.uint64)
        self.powers[1:] = np.cumprod(np.full(self.length, _FACTOR, dtype=np.uint64))

    def part(self, rows: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.sums[rows, end] - self.sums[rows, start] * self.powers[end - start]

    def keys(self, rows: np.ndarray, at: np.ndarray, ahead: bool, inner: bool, half: np.ndarray) -> np.ndarray:
        """Hashes for the gram at position `at` and an edit after it (`ahead`) or before it, `half` letters known of that side."""
        zero, end = np.zeros_like(at), np.full_like(at, self.length)
        if inner:  # the half next to the gram is equal
            known = self.part(rows, zero, at + 2 + half) if ahead else self.part(rows, at - half, end)
            other = np.zeros(len(rows), dtype=np.uint64)
        elif ahead:
            known, other = self.part(rows, zero, at + 2), self.part(rows, end - half, end)
        else:
            known, other = self.part(rows, at, end), self.part(rows, zero, half)
        mixed = known
        for value in (other, half.astype(np.uint64), np.uint64(2 * ahead + inner)):
            mixed = (mixed ^ (mixed >> np.uint64(29))) * _SPREAD + value
        mixed = (mixed ^ (mixed >> np.uint64(32))) * _SPREAD
        return (mixed ^ (mixed >> np.uint64(29))).view(np.int64)


def _half(letters: np.ndarray, inner: bool) -> np.ndarray:
    """Letters of a side of that many which make its half: the inner half is the larger one."""
    return (letters + 1) // 2 if inner else letters // 2


def _entries(frequency: np.ndarray, indexed: bool):
    """Index entries of all prefix grams, or probes of the pivots: key, last (order of the prefix's end), word, n."""
    order = np.empty(len(frequency), dtype=np.int64)
    order[np.lexsort((np.arange(len(frequency)), frequency))] = np.arange(len(frequency))

    def of(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        grams, sides = _grams(letters), Sides(letters)
        ranks = order[grams]
        last = np.partition(ranks, PREFIX - 1, axis=1)[:, PREFIX - 1]
        rarer, tied = ranks < last[:, None], ranks == last[:, None]
        places = TIED if indexed else PREFIX - rarer.sum(axis=1, keepdims=True)
        in_prefix = rarer | (tied & (np.cumsum(tied, axis=1) <= places))
        if indexed:
            rows, at = np.nonzero(in_prefix)
        else:
            first, second = pivots(np.where(in_prefix, frequency[grams].astype(float), np.inf))
            rows, at = np.tile(np.arange(len(letters)), 2), np.concatenate([first, second])
        keys, owners = [], []
        for ahead in (False, True):
            side = sides.length - at - 2 if ahead else at
            for inner in (False, True):
                halves = [_half(side, inner)]
                if indexed:
                    halves += [_half(np.maximum(side - 1, 0), inner), _half(side + 1, inner)]
                for i, half in enumerate(halves):
                    new = half <= side
                    for earlier in halves[:i]:
                        new &= half != earlier
                    keys.append(sides.keys(rows[new], at[new], ahead, inner, half[new]))
                    owners.append(rows[new])
        owner = np.concatenate(owners)
        return np.concatenate(keys), owner, last[owner]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, n = batch.column(0), batch.column(1)
            for numbers, letters in _matrices(words.to_pylist()):
                key, owner, last = of(letters)
                taken = pa.array(numbers[owner])
                columns = [pa.array(key), pa.array(last.astype(np.int32)), words.take(taken), n.take(taken)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "last", "word", "n"])

    return run


ENTRY = "key long, last int, word string, n long"


def near_pairs(words: DataFrame) -> DataFrame:
    """a, n_a, b, n_b for every two near words of `words` (word, n), once each and in any direction; stored."""
    frequency = gram_frequencies(words)
    probes = words.mapInArrow(_entries(frequency, False), ENTRY).withColumnsRenamed({"word": "a", "n": "n_a", "last": "last_a"})
    index = words.mapInArrow(_entries(frequency, True), ENTRY).withColumnsRenamed({"word": "b", "n": "n_b", "last": "last_b"})
    # Where both prefixes end with the same gram, either word may be the one that probes. A word gives many more rows than
    # Spark reckons with for what a function returns, so neither side may be broadcast by that estimate.
    met = probes.hint("merge").join(index, "key").filter(
        "last_a <= last_b and a <> b and abs(length(a) - length(b)) <= 1 and levenshtein(a, b, 1) = 1"
    )
    ordered = met.select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
        F.when(F.col("a") < F.col("b"), F.col("n_a")).otherwise(F.col("n_b")).alias("n_a"),
        F.when(F.col("a") < F.col("b"), F.col("n_b")).otherwise(F.col("n_a")).alias("n_b"),
    )
    return stored(ordered.distinct())


# --- groups -----------------------------------------------------------------------------------


def _roots(forms: DataFrame) -> DataFrame:
    """word and root of every word that has a form, by pointer doubling.

    A form is DOMINANCE times as frequent as its word, so chains are short and have no cycles. The tables are a few times
    as large in memory as the compressed files that Spark judges them by, so they are not broadcast.
    """
    paths = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = paths.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = paths.join(onward.hint("merge"), "root", "left").select("word", F.coalesce("_next", "root").alias("root"), "_next")
        moved = stored(moved)
        done = moved.filter("_next is not null").isEmpty()
        paths = moved.drop("_next")
        if done:
            return paths


def variants(documents: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n for every word of `documents` (doc_id, text).

    A null text has no words; a null doc_id is hashed as an empty one. Repeated rows count as often as they occur. Words
    without near words are their own root. Other columns play no part; an empty table gives no rows. A word's near words
    never meet in one place but as sums.
    """
    words = word_counts(documents)
    pairs = near_pairs(words)
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))
    )
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    near = both.groupBy("word").agg(F.count("*").alias("n_near"), best)
    joined = words.join(near, "word", "left")
    is_form = -F.col("best.less") >= DOMINANCE * F.col("n")
    judged = stored(
        joined.select(
            "word", F.when(is_form, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        )
    )
    roots = _roots(judged.filter("form is not null"))
    return judged.join(roots.hint("merge"), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
