"""Benchmark decontamination: rare n-gram seeds join training passages to test items, Smith-Waterman alignment scores them.

Words are lower-cased runs of word characters, so punctuation and line breaks don't count; they are compared by 64-bit
hashes, made in numpy over whole texts.

1. A first pass counts in how many documents each n-gram of the items occurs. The seeds of an item are those of its
   n-grams that occur, up to their median count: the rarest half at least, while common phrases seed nothing.
2. A second pass emits (document, seed, place) of the seeds in every whole text, which are joined to the items that
   have them. Both passes ask a bitmap of fixed size first; what it lets through by chance goes in the joins.
3. The hits of a document and an item are gathered along diagonals, and the stretches around them are aligned with the
   whole item, word by word. Only texts with hits are read again for this.

The score is that of the best local alignment as a share of the score of the item itself. An item counts as held from
`min_score` on, but from at least `full_words` words in a row, or what is worth as much: items of so many words or
fewer must be held whole, as parts of them occur by chance.

Defined results: null texts and items match nothing, as do items without words; items of equal text each match; a
document that holds an item twice gets one row, with the best and then first place; repeated documents get a row each;
extra columns come along in `drop_leaks` and are ignored in `find_leaks`, whatever their names. Items with fewer than
`n` words are looked for whole. What is collected to the driver is one bitmap.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Bitmap, bounded, column, fresh, keyed, map_batches, own_id, staged, text_column, worker_cache

MATCH, MISMATCH, GAP = 2, -1, -1
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class DecontamParams:
    n: int = 2
    min_score: float = 0.35
    full_words: int = 7

    def least(self, words: int) -> float:
        return max(self.min_score, min(1.0, self.full_words / words))


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h = h * MIX
    return h ^ (h >> np.uint64(32))


def word_points() -> np.ndarray:
    """For each code point whether it is a word character."""
    return np.fromiter((c == 95 or chr(c).isalnum() for c in range(0x110000)), bool, 0x110000)


def powers(n: int) -> np.ndarray:
    held = worker_cache("decontam powers", dict)
    if len(held.get(0, ())) < n:
        made = np.full(max(64, 1 << (n - 1).bit_length()), BASE)
        made[0] = 1
        held[0] = np.multiply.accumulate(made)
    return held[0]


def word_hashes(text: str) -> np.ndarray:
    """A hash for each word of a whole text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    inside = worker_cache("word points", word_points)[points]
    edge = np.diff(np.concatenate([[False], inside, [False]]).view(np.int8))
    sizes = np.flatnonzero(edge == -1) - np.flatnonzero(edge == 1)
    if not len(sizes):
        return np.empty(0, np.uint64)
    starts = np.cumsum(sizes) - sizes
    within = np.arange(int(sizes.sum())) - np.repeat(starts, sizes)
    return mixed(np.add.reduceat((points[inside].astype(np.uint64) + np.uint64(1)) * powers(int(sizes.max()))[within], starts))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n words."""
    size = len(words) - n + 1
    if size < 1:
        return np.empty(0, np.uint64)
    out = np.full(size, np.uint64(n))
    for k in range(n):
        out = out * BASE + words[k : k + size]
    return mixed(out)


def stretches(diagonals: list[int], size: int) -> Iterator[tuple[int, int]]:
    """Runs of diagonals that lie within half an item of the next, widened by half an item."""
    slack = size // 2 + 1
    lo = hi = diagonals[0]
    for d in diagonals[1:]:
        if d - hi > slack:
            yield lo - slack, hi + slack
            lo = d
        hi = d
    yield lo - slack, hi + slack


def align(text: np.ndarray, item: np.ndarray, start: int = 0) -> tuple[float, int, int]:
    """The best local alignment of item in text: its share of a full score, and the first and last word. A row of
    the matrix is one numpy step; gaps along the row come from a running maximum."""
    n = len(text)
    if not n:
        return 0.0, 0, 0
    ramp = np.arange(n, dtype=np.int64) * -GAP
    row = np.zeros(n + 1, np.int64)
    origin = np.arange(n + 1, dtype=np.int64)
    places = np.arange(n, dtype=np.int64)
    best, best_at, best_from = 0, 0, 0
    for w in item.tolist():
        over = row[:-1] + np.where(text == w, MATCH, MISMATCH)
        down = row[1:] + GAP
        take_down = down > over
        score = np.where(take_down, down, over)
        begin = np.where(take_down, origin[1:], origin[:-1])
        fresh = score <= 0
        score[fresh] = 0
        begin[fresh] = places[fresh] + 1
        lifted = score + ramp
        top = np.maximum.accumulate(lifted)
        came = np.maximum.accumulate(np.where(lifted == top, places, 0))
        gapped = top - ramp
        # A gap that brings nothing starts afresh.
        score = np.maximum(gapped, 0)
        begin = np.where(score > 0, begin[came], places + 1)
        row = np.concatenate([[0], score])
        origin = np.concatenate([[0], begin])
        j = int(score.argmax())
        if score[j] > best:
            best, best_at, best_from = int(score[j]), j, int(begin[j])
    return best / (MATCH * len(item)), start + best_from, start + best_at


def best_alignment(words: np.ndarray, item: np.ndarray, diagonals: list[int]) -> tuple[float, int, int]:
    """(score, first word, last word) of item in words, near the diagonals."""
    best = (0.0, 0, 0)
    for lo, hi in stretches(sorted(diagonals), len(item)):
        a, b = max(0, lo), min(len(words), hi + len(item))
        score = align(words[a:b], item, a)
        if score[0] > best[0]:
            best = score
    return best


def item_table(bench: DataFrame, item_col: str, item_text: str) -> DataFrame:
    """(q, item, words): q numbers the items that have words."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = [word_hashes(t).view(np.int64) for t in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array(words, pa.list_(pa.int64()))], ["item", "words"])

    rows = bench.select(column(item_col).alias("item"), text_column(item_text).alias("text"))
    made = map_batches(rows, run, f"item {bench.schema[item_col].dataType.simpleString()}, words array<bigint>").filter(F.size("words") > 0)
    return staged(made.withColumn("q", F.monotonically_increasing_id()), "decontam-items")


def item_grams(items: DataFrame, n: int) -> DataFrame:
    """(q, g, at, size): the n-grams of each item, or all of it if it is shorter."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        q, g, at, size = [], [], [], []
        for i, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            k = min(n, len(words))
            found = grams(np.array(words, np.int64).view(np.uint64), k).view(np.int64)
            q += [i] * len(found)
            g += found.tolist()
            at += range(len(found))
            size += [k] * len(found)
        return pa.record_batch([pa.array(c, pa.int64()) for c in (q, g, at, size)], ["q", "g", "at", "size"])

    return staged(map_batches(items.select("q", "words"), run, "q long, g long, at long, size long"), "decontam-grams")


def chosen_seeds(found: DataFrame, docs: DataFrame, sizes: list[int]) -> DataFrame:
    """(g, q, at): of the n-grams of an item that occur at all, those in no more documents than its median one."""
    known = Bitmap(found, "g")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        each = []
        for text in batch.column(0).to_pylist():
            words = word_hashes(text)
            g = np.concatenate([grams(words, k) for k in sizes])
            each.append(np.unique(g[known.has(g)]))
        g, n = np.unique(np.concatenate(each), return_counts=True)
        return pa.record_batch([pa.array(g.view(np.int64)), pa.array(n.astype(np.int64))], ["g", "n"])

    counted = map_batches(docs.select("text"), run, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
    rare = staged(found.join(counted, "g").select("g", "q", "at", "n"), "decontam-counted")
    middle = rare.select("q", "g", "n").distinct().groupBy("q").agg(F.expr("percentile(n, 0.5)").alias("middle"))
    return staged(rare.join(middle, "q").filter("n <= middle").select("g", "q", "at"), "decontam-seeds")


def leaks(docs: DataFrame, bench: DataFrame, p: DecontamParams, item_col: str, item_text: str) -> DataFrame:
    """(k, item, score, first_word, last_word) of docs with columns k, never twice the same, and text."""
    items = item_table(bench, item_col, item_text)
    found = item_grams(items, p.n)
    sizes = sorted(r["size"] for r in found.select("size").distinct().collect())  # at most n rows
    schema = f"k {docs.schema['k'].dataType.simpleString()}, item {items.schema['item'].dataType.simpleString()}, score double, first_word long, last_word long"
    if not sizes:
        return docs.sparkSession.createDataFrame([], schema)
    seeds = chosen_seeds(found, docs, sizes)
    known = Bitmap(seeds, "g")

    def seek(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, hashes, places = [], [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            words = word_hashes(text)
            for k in sizes:
                g = grams(words, k)
                at = np.flatnonzero(known.has(g))
                rows.append(np.full(len(at), i))
                hashes.append(g[at].view(np.int64))
                places.append(at)
        i, g, at = (np.concatenate(c) for c in (rows, hashes, places))
        return pa.record_batch([batch.column(0).take(pa.array(i)), pa.array(g), pa.array(at.astype(np.int64))], ["k", "g", "place"])

    hits = map_batches(docs.select("k", "text"), seek, f"k {docs.schema['k'].dataType.simpleString()}, g long, place long")
    diagonals = hits.join(bounded(seeds), "g").groupBy("k", "q").agg(F.collect_set(F.col("place") - F.col("at")).alias("diagonals"))
    asked = diagonals.join(bounded(items), "q").groupBy("k").agg(F.collect_list(F.struct("item", "words", "diagonals")).alias("asked"))
    asked = staged(asked, "decontam-asked")

    def score(batch: pa.RecordBatch) -> pa.RecordBatch:
        flat, rows, out = batch.column(2), [], []
        for i, text in enumerate(batch.column(1).to_pylist()):
            words = word_hashes(text)
            for j in range(flat.offsets[i].as_py(), flat.offsets[i + 1].as_py()):
                item = np.array(flat.values.field("words")[j].values).view(np.uint64)
                best = best_alignment(words, item, flat.values.field("diagonals")[j].as_py())
                if best[0] >= p.least(len(item)):
                    rows.append((i, j))
                    out.append(best)
        i, j = (pa.array([r[c] for r in rows], pa.int64()) for c in (0, 1))
        parts = zip(("score", "first_word", "last_word"), (pa.float64(), pa.int64(), pa.int64()), range(3), strict=True)
        return pa.record_batch([batch.column(0).take(i), flat.values.field("item").take(j), *(pa.array([r[c] for r in out], t) for _, t, c in parts)], schema_names)

    schema_names = ["k", "item", "score", "first_word", "last_word"]
    return map_batches(docs.select("k", "text").join(bounded(asked), "k"), score, schema)


def find_leaks(docs: DataFrame, bench: DataFrame, p: DecontamParams = DecontamParams(), id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row for each document and item that it holds: ids, score, first and last word of the passage."""
    rows = keyed(docs, id_col)
    found = leaks(rows.select("k", text_column(text_col, "row").alias("text")), bench, p, item_col, item_text)
    return found.select(own_id(rows, docs, id_col).alias(id_col), F.col("item").alias(fresh(item_col, [id_col])), "score", "first_word", "last_word")


def drop_leaks(docs: DataFrame, bench: DataFrame, p: DecontamParams = DecontamParams(), id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """docs without the rows that hold an item."""
    rows = keyed(docs, id_col)
    found = staged(leaks(rows.select("k", text_column(text_col, "row").alias("text")), bench, p, item_col, item_text).select("k").distinct(), "decontam-found")
    return rows.join(bounded(found), "k", "left_anti").select("row.*")
