"""Packing of tokenised documents into fixed-length sequences by minimum bin slack.

Texts become token ids on the executors; only lengths travel on. What decides a packing is how many pieces
there are of each length, at most `capacity` numbers however many documents there are. On the driver, each bin
starts with the longest length left; a subset-sum over the lengths left, held as bits of one integer, finds the
combination that fills the bin most, and that combination is removed as often as the counts allow. Pieces are
then numbered within their length (counts per task, prefix sums over tasks) and look their place up.

Ids come from the ranks form of the vocabulary by another library, which is four times as fast as the JSON form by
tokenizers; a test compares the two over all planes of Unicode and on random strings.

Defined results: a null text is empty and gives one piece of just the end id; repeated rows are packed each;
an empty table gives an empty result. A document longer than a sequence is cut so that only its first piece
may be shorter than `capacity`. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, staged, text_column, worker_cache

END_ID = 0


def tokenizer_file(name: str) -> str:
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def load_bpe(ranks_file: str):
    """The byte-level BPE of a ranks file; the string of the special token is that token, as in the JSON form."""
    import public_tokenizers
    import tiktoken

    with open(tokenizer_file(ranks_file), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={"<|endoftext|>": len(ranks)})


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def pieces(docs: DataFrame, capacity: int, ranks_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each piece; (block, length, nth) numbers the pieces that one task makes of one length."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        from pyspark import TaskContext

        bpe = worker_cache(f"bpe {ranks_file}", lambda: load_bpe(ranks_file))
        block, made = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [], [])
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(bpe.encode_to_numpy(text, allowed_special="all").astype("<u4"), np.uint32(END_ID)).astype("<u4")
                for k, (start, length) in enumerate(cut(len(ids), capacity)):
                    for column, v in zip(rows, (i, k, start, length, zlib.crc32(ids[start : start + length].tobytes()), made[length]), strict=True):
                        column.append(v)
                    made[length] += 1
            i, k, start, length, crc, nth = rows
            yield pa.record_batch([batch.column(0).take(pa.array(i, pa.int64())), pa.array(k, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc)), pa.array([block] * len(i), pa.int64()), pa.array(nth, pa.int64())], ["id", "piece", "start", "length", "ids_crc32", "block", "nth"])

    return docs.select(column(id_col).alias("id"), text_column(text_col).alias("text")).mapInArrow(run, f"id {id_type}, piece int, start long, length long, ids_crc32 long, block long, nth long")


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths, each at most counts[length] times, with the largest sum not over room. Bit s of
    an integer says that a sum s is reachable; ties prefer longer lengths."""
    reach, mask, stages = 1, (1 << (room + 1)) - 1, []
    for length in sorted(counts, reverse=True):
        if length > room:
            continue
        stages.append((length, reach))
        left, step = min(counts[length], room // length), 1
        while left > 0:  # multiplicities in binary parts
            take = min(step, left)
            reach |= (reach << (length * take)) & mask
            left -= take
            step *= 2
        if reach >> room & 1:
            break
    total, out = reach.bit_length() - 1, {}
    for length, before in reversed(stages):
        k = 0
        while not before >> total & 1:
            total -= length
            k += 1
        if k:
            out[length] = k
    return out


def minimum_bin_slack(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """(combination, times) until nothing is left."""
    left = {n: c for n, c in histogram.items() if c > 0}
    plan = []
    while left:
        longest = max(left)
        left[longest] -= 1
        bin_ = Counter(fullest({n: c for n, c in left.items() if c}, capacity - longest))
        left[longest] += 1
        bin_[longest] += 1
        times = min(left[n] // k for n, k in bin_.items())
        for n, k in bin_.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
        plan.append((dict(bin_), times))
    return plan


def places(plan: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, times in a bin, first sequence, offset in the bin) in rank order."""
    rows: dict[int, list] = {}
    used: Counter = Counter()
    sequence = 0
    for bin_, times in plan:
        offset = 0
        for length in sorted(bin_, reverse=True):
            k = bin_[length]
            rows.setdefault(length, []).append((used[length], k, sequence, offset))
            used[length] += k * times
            offset += k * length
        sequence += times
    return {n: np.array(r, np.int64) for n, r in rows.items()}


def pack(docs: DataFrame, capacity: int = 2048, ranks_file: str = "byte_bpe_50k.tiktoken", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each piece with its sequence_id and offset. Shuffles only counts by (task, length) and thin rows."""
    made = staged(pieces(docs, capacity, ranks_file, id_col, text_col), "pieces")
    counts = made.groupBy("block", "length").agg((F.max("nth") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(counts.select("block", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rank0")), "offsets")
    histogram = {r.length: r.n for r in offsets.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most `capacity` rows
    table = places(minimum_bin_slack(histogram, capacity))

    def place(batches):
        for batch in batches:
            length = batch.column(3).to_numpy()
            rank = batch.column(5).to_numpy()
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            order = np.argsort(length, kind="stable")
            for group in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                n = int(length[group[0]])
                rows = table[n]
                at = rows[np.searchsorted(rows[:, 0], rank[group], side="right") - 1]
                k = rank[group] - at[:, 0]
                sequence[group] = at[:, 2] + k // at[:, 1]
                offset[group] = at[:, 3] + k % at[:, 1] * n
            yield pa.record_batch([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])

    ranked = made.join(offsets.select("block", "length", "rank0").hint("merge"), ["block", "length"]).select("id", "piece", "start", "length", "ids_crc32", (F.col("rank0") + F.col("nth")).alias("rank"))
    id_type = docs.schema[id_col].dataType.simpleString()
    out = ranked.mapInArrow(place, f"id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
