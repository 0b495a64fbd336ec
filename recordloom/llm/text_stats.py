"""Counts of a text that quality rules look at, by vectorised scans of whole texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from recordloom.llm.scan import blocks, span_hashes, word_spans

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct_words")
STATS_TYPE = "struct<" + ",".join(f"{c}:bigint" for c in COUNTS) + ">"

SYMBOL = np.zeros(256, dtype=bool)
SYMBOL[list(b"#*$%&|<>")] = True
NEWLINE = 0x0A
REPEATED_WINDOW = 3


def _repeated(values: np.ndarray) -> np.ndarray:
    """Whether each value occurs twice or more."""
    _, where, times = np.unique(values, return_inverse=True, return_counts=True)
    return times[where] > 1


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flags are set between neighbouring bounds."""
    sums = np.concatenate([[0], np.cumsum(flags)])
    return np.diff(sums[bounds])


def text_counts(column: pa.Array) -> pa.StructArray:
    """COUNTS of every text of a column of bytes; all zero for a null or empty one."""
    parts = []
    for first, last, buffer, bounds in blocks(column):
        starts, ends, before = word_spans(buffer, bounds)
        out = np.zeros((last - first, len(COUNTS)), dtype=np.int64)
        out[:, 0] = np.diff(before)
        points = np.concatenate([[0], np.cumsum((buffer & 0xC0) != 0x80)])
        chars = np.concatenate([[0], np.cumsum(points[ends] - points[starts])])
        out[:, 1] = np.diff(chars[before])
        out[:, 2] = _per_text(SYMBOL[buffer], bounds)

        # Lines: from the start of a text or after a newline, to the next newline or the end of the text.
        breaks = np.flatnonzero(buffer == NEWLINE)
        line_starts = np.union1d(bounds[:-1], breaks + 1)
        line_starts = line_starts[line_starts < bounds[-1]] if len(line_starts) else line_starts
        line_ends = np.append(line_starts[1:], bounds[-1] if len(line_starts) else 0)[: len(line_starts)]
        line_ends = line_ends - ((line_ends > line_starts) & np.isin(line_ends - 1, breaks, assume_unique=False))
        worded = np.searchsorted(starts, line_ends) > np.searchsorted(starts, line_starts)
        line_starts, line_ends = line_starts[worded], line_ends[worded]
        line_hash = span_hashes(buffer, line_starts, line_ends)
        lines_before = np.searchsorted(line_starts, bounds)
        out[:, 5] = np.diff(lines_before)

        words = span_hashes(buffer, starts, ends)
        for row in range(last - first):
            low, high = lines_before[row], lines_before[row + 1]
            if high - low > 1:
                out[row, 3] = high - low - len(np.unique(line_hash[low:high]))
            low, high = before[row], before[row + 1]
            if high > low:
                _, number = np.unique(words[low:high], return_inverse=True)
                count = int(number.max()) + 1
                out[row, 6] = count
                if high - low > REPEATED_WINDOW:
                    number = number.astype(np.uint64)
                    # Texts have fewer than 2**21 different words, or else the hash alone tells windows apart.
                    if count < 1 << 21:
                        windows = (number[:-2] << np.uint64(42)) | (number[1:-1] << np.uint64(21)) | number[2:]
                    else:
                        w = words[low:high]
                        windows = w[:-2] * np.uint64(3) + w[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + w[2:] * np.uint64(0x165667B19E3779F9)
                    again = _repeated(windows)
                    covered = np.zeros(high - low, dtype=bool)
                    for shift in range(REPEATED_WINDOW):
                        covered[shift : shift + len(again)] |= again
                    out[row, 4] = covered.sum()
        parts.append(out)
    table = np.concatenate(parts) if parts else np.zeros((0, len(COUNTS)), dtype=np.int64)
    return pa.StructArray.from_arrays([pa.array(table[:, i]) for i in range(len(COUNTS))], list(COUNTS))


def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for column in batches:
        yield text_counts(column)
