"""Quality rules: how much of a text lies inside repeated n-grams and repeated lines.

Words are runs of anything but ASCII white space. Words get dense numbers within a text, rolling hashes of
several n-gram lengths run over the numbers in numpy, and the characters under n-grams that occur twice or
more are summed. A longer n-gram can only repeat where the shorter one does, so each length looks only there.

Defined results: a null or empty text has zero words and fails the base rules; repeated rows each get their
row; columns other than the id and the text are ignored, whatever their names. Texts are processed one by one, whole.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, map_batches, text_column

SPACES = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
MULTIPLIER = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class QualityRules:
    """min_words and max_repeat_pct are the base; ngram_limits, by length, and line_limit are shares of word characters
    inside repeated n-grams and lines. They are set where no labelled good document of the tables goes."""

    min_words: int = 50
    max_repeat_pct: int = 50
    ngram_limits: tuple[tuple[int, float], ...] = ((4, 0.30), (5, 0.30), (6, 0.30), (8, 0.28), (10, 0.20))
    line_limit: float = 0.15


def repeated_windows(ids: np.ndarray, starts: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    """Which of the windows of n words at starts occur twice or more; equal hashes are compared word by word."""
    order = np.argsort(hashes, kind="stable")
    same = hashes[order[1:]] == hashes[order[:-1]]
    a, b = starts[order[1:]][same], starts[order[:-1]][same]
    for k in range(n):
        if not np.array_equal(ids[a + k], ids[b + k]):  # a collision: number the windows exactly instead
            rows = np.stack([ids[starts + i] for i in range(n)], axis=1)
            _, inverse, counts = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
            return counts[inverse.ravel()] > 1
    out = np.zeros(len(starts), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def covered(starts: np.ndarray, n: int, words: int) -> np.ndarray:
    """Which words lie in one of the windows of n words at starts."""
    edge = np.zeros(words + 1, np.int32)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + n, -1)
    return np.cumsum(edge[:-1]) > 0


def measure(text: str, lengths: tuple[int, ...]) -> tuple[int, int, int, int, int, int, dict[int, int]]:
    """Words, word characters, symbols, repeated lines, words in repeated 3-word windows, characters of repeated
    lines, and for each n-gram length the word characters inside repeated n-grams."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    n_words = len(words)
    word_chars = len(text) - sum(map(text.count, SPACES))
    n_symbols = sum(map(text.count, SYMBOLS))
    n_dup_lines = dup_line_chars = 0
    seen: set[bytes] = set()
    for line in data.split(b"\n"):
        if line.strip():
            if line in seen:
                n_dup_lines += 1
                dup_line_chars += sum(len(w.decode("utf-8", "surrogatepass")) for w in line.split())
            else:
                seen.add(line)
    chars_in = dict.fromkeys(lengths, 0)
    n_repeat = 0
    if n_words > 3:
        numbers: dict[bytes, int] = {}
        ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n_words)
        if len(numbers) < n_words:
            n_repeat = _repeats(words, ids, n_words, lengths, chars_in)
    return n_words, word_chars, n_symbols, n_dup_lines, n_repeat, dup_line_chars, chars_in


def _repeats(words: list[bytes], ids: np.ndarray, n_words: int, lengths: tuple[int, ...], chars_in: dict[int, int]) -> int:
    """Fills chars_in and returns the words in repeated 3-word windows."""
    mixed = (ids + 1).astype(np.uint64) * np.uint64(MULTIPLIER)
    mixed ^= mixed >> np.uint64(29)
    base = np.uint64(6364136223846793005)
    starts = np.arange(n_words - 2)
    rolling = (mixed[:-2] * base + mixed[1:-1]) * base + mixed[2:]
    hit = repeated_windows(ids, starts, rolling, 3)
    starts, rolling = starts[hit], rolling[hit]
    if not len(starts):
        return 0
    n_repeat = int(covered(starts, 3, n_words).sum())
    width = np.fromiter((len(w.decode("utf-8", "surrogatepass")) for w in words), np.int64, n_words)
    n = 3
    for length in sorted(lengths):
        while n < length and len(starts):
            inside = starts + n < n_words
            starts, rolling = starts[inside], rolling[inside]
            rolling = rolling * base + mixed[starts + n]
            n += 1
        if n < length or not len(starts):
            break
        hit = repeated_windows(ids, starts, rolling, n)
        starts, rolling = starts[hit], rolling[hit]
        chars_in[length] = int(width[covered(starts, n, n_words)].sum())
    return n_repeat


def quality(docs: DataFrame, rules: QualityRules = QualityRules(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: its measures, base_failed and kept. No shuffle; one pass in Arrow batches."""
    lengths = tuple(n for n, _ in rules.ngram_limits)
    fields = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "dup_line_chars", *(f"dup_{n}gram_chars" for n in lengths)]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [measure(t, lengths) for t in batch.column(1).to_pylist()]
        columns = [[r[k] for r in rows] for k in range(6)] + [[r[6][n] for r in rows] for n in lengths]
        return pa.record_batch([batch.column(0), *(pa.array(c, pa.int64()) for c in columns)], ["id", *fields])

    id_type = docs.schema[id_col].dataType.simpleString()
    out = map_batches(docs.select(column(id_col).alias("id"), text_column(text_col).alias("text")), run, f"id {id_type}, " + ", ".join(f"{f} long" for f in fields))
    base = (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.max_repeat_pct * F.col("n_words"))
    bad = F.col("dup_line_chars") > rules.line_limit * F.col("word_chars")
    for n, limit in rules.ngram_limits:
        bad |= F.col(f"dup_{n}gram_chars") > limit * F.col("word_chars")
    return out.withColumnRenamed("id", id_col).withColumn("base_failed", base).withColumn("kept", ~F.col("base_failed") & ~bad)
