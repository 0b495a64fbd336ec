"""Language identification by unigram models over pieces, with all segmentations of a word summed.

Each language has a probability for every piece of one fixed public vocabulary. A word's probability is the sum, over
all ways to cut it into pieces, of the products of their probabilities (a forward pass over its characters); a text's is
the product over its words. The probabilities are learned by expectation maximisation: forward and backward passes give
the expected number of times each piece is used, summed by Spark, then divided by their total.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm.tokens import forget
from recordloom.session import stored

ROUNDS = 2
LEARNED = 31  # letters; longer words are learned from in parts of this many, and scored whole
SMOOTH = 0.05  # added to each piece's expected count
UNKNOWN = 1e-7  # probability of a letter that is no piece
SCALED = 16  # letters after which sums are scaled; each is at least UNKNOWN times the one before
FAR = 6.0  # spreads below the median of a language's texts at which a text is not of that language
LEAST_SPREAD = 0.05  # of logarithms per letter
CACHED_WORDS = 150_000
COUNTED_WORDS = 150_000
AT_ONCE = 60_000  # letters of words that are segmented together
TEXTS_AT_ONCE = 500
WORDS_AT_ONCE = 50_000

BEGIN = "▁"  # the vocabulary's mark of a word's begin
LETTERS = re.compile(r"[^\W\d_]+")
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_vocabulary(path: str) -> list[str]:
    """Lower-case pieces of letters, with or without the mark of a word's begin, in the order of the file."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    every = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return [p for p in dict.fromkeys(every) if LETTERS.fullmatch(p.removeprefix(BEGIN) or "a") and p == p.lower() and len(p) <= LEARNED + 1]


def _hashes(points: np.ndarray) -> np.ndarray:
    """Prefix hashes of rows of code points: one more column than points."""
    sums = np.zeros((points.shape[0], points.shape[1] + 1), dtype=np.uint64)
    for at in range(points.shape[1]):
        sums[:, at + 1] = sums[:, at] * _FACTOR + points[:, at]
    return sums


class Segmenter:
    """Finds the pieces of a vocabulary inside words, many words at once."""

    def __init__(self, pieces: list[str]):
        self.size = len(pieces)
        self.longest = max(map(len, pieces), default=1)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in range(1, self.longest + 1):
            numbers = np.array([i for i, p in enumerate(pieces) if len(p) == length], dtype=np.int64)
            if not len(numbers):
                continue
            points = np.array([[ord(c) for c in pieces[i]] for i in numbers], dtype=np.uint64)
            hashes = _hashes(points)[:, -1]
            order = np.argsort(hashes)
            self.by_length[length] = (hashes[order], numbers[order])
        self.powers = self._powers()

    def _powers(self) -> np.ndarray:
        powers = np.ones(self.longest + 1, dtype=np.uint64)
        powers[1:] = np.cumprod(np.full(self.longest, _FACTOR, dtype=np.uint64))
        return powers

    def groups(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows and code points (with the begin mark) of the words of each length."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        for length in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == length)
            text = "".join([words[i] for i in rows.tolist()])
            points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").reshape(len(rows), length)
            yield rows, np.concatenate([np.full((len(rows), 1), ord(BEGIN)), points], axis=1).astype(np.uint64)

    def chunks(self, words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The same in parts of at most AT_ONCE letters, or one word."""
        for rows, points in self.groups(words):
            step = max(1, AT_ONCE // points.shape[1])
            for low in range(0, len(rows), step):
                yield rows[low : low + step], points[low : low + step]

    def matches(self, points: np.ndarray) -> Iterator[list[tuple[int, np.ndarray]]]:
        """For each end in turn the lengths of pieces that end there, with their numbers in each row; `size` means none."""
        sums = _hashes(points)
        for end in range(1, points.shape[1] + 1):
            found = []
            for length in range(1, min(end, self.longest) + 1):
                if length not in self.by_length:
                    continue
                hashes, numbers = self.by_length[length]
                part = sums[:, end] - sums[:, end - length] * self.powers[length]
                at = np.minimum(np.searchsorted(hashes, part), len(hashes) - 1)
                hit = hashes[at] == part
                if length == 1 or hit.any():
                    found.append((length, np.where(hit, numbers[at], self.size)))
            yield found


def _probability(table: np.ndarray, length: int, numbers: np.ndarray) -> np.ndarray:
    return np.maximum(table[numbers], UNKNOWN) if length == 1 else table[numbers]


def _forward(found: list, table: np.ndarray, rows: int) -> list[np.ndarray]:
    """Sums over all segmentations of the first characters; the last row of `table` is for no piece."""
    sums = [np.ones(rows)]
    for end, pieces in enumerate(found, 1):
        total = np.zeros(rows)
        for length, numbers in pieces:
            total += sums[end - length] * _probability(table, length, numbers)
        sums.append(total)
    return sums


def with_none(table: np.ndarray) -> np.ndarray:
    return np.concatenate([table, np.zeros((1, table.shape[1]))])


def log_probabilities(segmenter: Segmenter, table: np.ndarray, words: list[str]) -> np.ndarray:
    """Words by languages. `table` is pieces by languages.

    Only the sums over the last characters, as many as the longest piece has, are held; before they get too small for
    floating point they are scaled up, so words may have any length.
    """
    full = with_none(table)
    out = np.zeros((len(words), table.shape[1]))
    for rows, points in segmenter.chunks(words):
        sums, scale = [np.ones((len(rows), table.shape[1]))], 0.0
        for end, pieces in enumerate(segmenter.matches(points), 1):
            total = np.zeros_like(sums[0])
            for length, numbers in pieces:
                total += sums[-length] * _probability(full, length, numbers)
            sums = [*sums[1 - segmenter.longest :], total] if segmenter.longest > 1 else [total]
            if end % SCALED == 0:
                sums, scale = [s / total for s in sums], scale + np.log(total)
        out[rows] = np.log(sums[-1]) + scale
    return out


def expected_counts(segmenter: Segmenter, probabilities: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected uses of each piece in words of one language that occur `counts` times."""
    full = with_none(probabilities[:, None])[:, 0]
    uses = np.zeros(segmenter.size + 1)
    for rows, points in segmenter.chunks(words):
        found = list(segmenter.matches(points))
        ahead = _forward(found, full, len(rows))
        behind = [np.zeros(len(rows)) for _ in found] + [counts[rows] / ahead[-1]]
        used, shares = [], []
        for end in range(len(found), 0, -1):
            for length, numbers in found[end - 1]:
                share = _probability(full, length, numbers) * behind[end]
                behind[end - length] += share
                used.append(numbers)
                shares.append(share * ahead[end - length])
        uses += np.bincount(np.concatenate(used), np.concatenate(shares), minlength=segmenter.size + 1)
    return uses[:-1]


def units(text: str) -> list[str]:
    """Lower-case runs of letters."""
    found = LETTERS.findall(text.lower())
    if not "".join(found).isalpha():  # numerals such as ½ pass for letters in the pattern
        found = [w for w in ("".join(filter(str.isalpha, w)) for w in found) if w]
    return found


def short_units(text: str) -> list[str]:
    """The same with very long ones in several parts, for learning."""
    found = units(text)
    if any(len(w) > LEARNED for w in found):
        found = [w[at : at + LEARNED] for w in found for at in range(0, len(w), LEARNED)]
    return found


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    forget()
    counts: Counter[tuple[str, str]] = Counter()

    def flush():
        keys = list(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array(list(counts.values()), pa.int64())],
            ["lang", "word", "n"],
        )

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            for word, n in Counter(short_units(text.as_py())).items():
                counts[lang, word] += n
            if len(counts) > COUNTED_WORDS:
                yield flush()
                counts.clear()
    if counts:
        yield flush()


def is_held_out(doc_id: str = "doc_id"):
    """The documents that learning never sees: a remainder of 2 of their id's CRC."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Model:
    """Languages in alphabetical order, pieces, and the probability of each piece in each language."""

    def __init__(self, languages: list[str], pieces: list[str], table: np.ndarray):
        self.languages, self.pieces, self.table = languages, pieces, table


def _is_learned(doc_id: str = "doc_id", lang: str = "lang", text: str = "text") -> Column:
    given = F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(doc_id).isNotNull()
    return given & ~is_held_out(doc_id)


def learn(documents: DataFrame, path: str | None = None, rounds: int = ROUNDS) -> Model:
    """A model from `text` and the non-null `lang` of all rows that are not held out.

    Tasks and shuffles hold words with their counts. The driver gets one number per piece and language: the vocabulary is
    fixed, the languages are few.
    """
    pieces = read_vocabulary(path or vocabulary_path())
    usable = documents.filter(_is_learned())
    languages = sorted(row["lang"] for row in usable.select("lang").distinct().collect())
    if not languages:
        return Model([], pieces, np.zeros((len(pieces), 0)))
    counted = usable.select("lang", "text").mapInArrow(_count_words, "lang string, word string, n long")
    counted = stored(counted.groupBy("lang", "word").agg(F.sum("n").alias("n")))

    start = 1.0 / (np.arange(len(pieces)) + 10.0)
    table = np.repeat((start / start.sum())[:, None], len(languages), axis=1)
    for _ in range(rounds):
        summed = counted.mapInPandas(_expectation(pieces, languages, table), "lang string, piece int, uses double")
        uses = np.full_like(table, SMOOTH)
        for row in summed.groupBy("lang", "piece").agg(F.sum("uses").alias("uses")).collect():
            uses[row["piece"], languages.index(row["lang"])] += row["uses"]
        table = uses / uses.sum(axis=0)
    return Model(languages, pieces, table)


def _expectation(pieces: list[str], languages: list[str], table: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        segmenter, total = Segmenter(pieces), np.zeros_like(table)
        held: list[pd.DataFrame] = []

        def add() -> None:
            for lang, part in pd.concat(held).groupby("lang"):
                at = languages.index(lang)
                total[:, at] += expected_counts(segmenter, table[:, at], part["word"].tolist(), part["n"].to_numpy(float))
            held.clear()

        for rows in batches:
            held.append(rows)
            if sum(map(len, held)) >= WORDS_AT_ONCE:
                add()
        if held:
            add()
        piece, lang = np.nonzero(total)
        yield pd.DataFrame({"lang": np.array(languages, dtype=object)[lang], "piece": piece.astype(np.int32), "uses": total[piece, lang]})

    return run


def _predict(model: Model, lengths: bool):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        forget()
        segmenter = Segmenter(model.pieces)
        known: dict[str, int] = {}
        scores = np.zeros((CACHED_WORDS, len(model.languages)))
        for column in batches:
            names, values, per_letter, letters = [], [], [], []
            for low in range(0, len(column), TEXTS_AT_ONCE):
                part = [units(t.as_py()) if t.is_valid else [] for t in column[low : low + TEXTS_AT_ONCE]]
                different = set().union(*part)
                new = list(different - known.keys())
                if len(known) + len(new) > len(scores):
                    known.clear()
                    new = list(different)
                    scores = scores if len(new) <= len(scores) else np.zeros((len(new), len(model.languages)))
                if new and model.languages:
                    scores[len(known) : len(known) + len(new)] = log_probabilities(segmenter, model.table, new)
                known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
                for words in part:
                    if not words or not model.languages:
                        names.append("und")
                        values.append(0.0)
                        if lengths:
                            per_letter.append(None)
                            letters.append(0)
                        continue
                    total = scores[list(map(known.__getitem__, words))].sum(axis=0)
                    best = int(total.argmax())
                    names.append(model.languages[best])
                    values.append(float(1 / np.exp(total - total[best]).sum()))
                    if lengths:
                        letters.append(sum(map(len, words)))
                        per_letter.append(float(total[best]) / letters[-1])
            columns = [pa.array(names, pa.string()), pa.array(values, pa.float64())]
            if lengths:
                columns += [pa.array(per_letter, pa.float64()), pa.array(letters, pa.int64())]
            yield pa.StructArray.from_arrays(columns, ["lang_pred", "score", "per_letter", "letters"][: len(columns)])

    return run


def predicted(documents: DataFrame, model: Model, text: str = "text", lengths: bool = False) -> DataFrame:
    """`documents` with a struct `language` (lang_pred, score; with `lengths` also per_letter, letters), from the whole text alone.

    per_letter is the logarithm of the text's probability in lang_pred, divided by its letters.

    A null text, or one without a letter, is `und` with score 0; so is every text when nothing could be learned. Equal
    scores go to the first language in the alphabet.
    """
    from pyspark.sql.functions import arrow_udf

    kind = "lang_pred string, score double" + (", per_letter double, letters long" if lengths else "")
    judge = arrow_udf(_typed(_predict(model, lengths)), kind)
    return documents.withColumn("language", judge(F.col(text)))


def _typed(function):
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return function(batches)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run


def identified(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score per row; a null doc_id is not held out and not learned from."""
    judged = predicted(documents.select("doc_id", "text"), learn(documents, path))
    return judged.select("doc_id", is_held_out().alias("held_out"), "language.lang_pred", "language.score")


def usual(judged: DataFrame) -> dict[str, tuple[float, float, float]]:
    """Per language the median and the spread of per_letter, and the median of letters, of all texts that were learned from.

    `judged` has lang, `language` with lengths, and `learned`, whether the model saw the row.
    """
    own = judged.filter("learned and language.lang_pred = lang")
    quartiles = F.percentile_approx("language.per_letter", [0.25, 0.5, 0.75], 1000).alias("q")
    rows = own.groupBy("lang").agg(quartiles, F.percentile_approx("language.letters", 0.5, 1000).alias("letters")).collect()
    return {r["lang"]: (r["q"][1], max((r["q"][2] - r["q"][0]) / 1.349, LEAST_SPREAD), float(r["letters"])) for r in rows}


def is_usual(of: dict[str, tuple[float, float, float]]) -> Column:
    """Whether a text is not far less probable, letter by letter, than those its language was learned from.

    Texts shorter than usual vary more, by the root of their length.
    """
    if not of:
        return F.lit(True)
    known = F.create_map(*[x for lang, v in of.items() for x in (F.lit(lang), F.array(*map(F.lit, v)))])[F.col("language.lang_pred")]
    wide = F.greatest(F.lit(1.0), F.sqrt(known[2] / F.col("language.letters")))
    return F.coalesce(F.col("language.per_letter") >= known[0] - FAR * known[1] * wide, F.lit(True))


def keep_identified(documents: DataFrame, least_score: float = 0.5, path: str | None = None) -> DataFrame:
    """`documents` without those whose language cannot be told, or was not learned.

    These are `und`, a score below `least_score`, and texts that are far less probable per letter than those learned from:
    the score only compares learned languages, and is near 1 for any long text. Model and limits come from all labelled
    rows that are not held out. Texts are judged where they are read and never shuffled. All columns come back as they were, whatever their names.
    """
    model = learn(documents, path)
    rows = documents.select(F.struct("*").alias("document"), "text", "lang", _is_learned().alias("learned"))
    judged = stored(predicted(rows, model, lengths=True).drop("text"))  # each text is judged once, for the limits and by them
    kept = judged.filter((F.col("language.lang_pred") != "und") & (F.col("language.score") >= least_score))
    return kept.filter(is_usual(usual(judged) if model.languages else {})).select("document.*")
