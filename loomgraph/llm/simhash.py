"""SimHash near-duplicates: fingerprints, exact Hamming links through a vantage-point tree, connected components.

Fingerprints are made in one pass. Distinct fingerprints alone go on, so exact copies cost nothing more. A
vantage-point tree, fitted on a bounded sample, cuts the space into shards: a fingerprint lives in one shard and
also asks the later shards that its ball of the link radius reaches, which the triangle inequality tells from
its distance to each vantage point. A shard that holds more than `block` fingerprints is compared block by
block in tasks of their own. Within a task a further vantage-point tree prunes, and only a spanning star of each
local component leaves it, so what is emitted is linear in what was read. Stars are merged by alternating large
and small stars over DataFrames until nothing changes.

Defined results: a null text, an empty one or one without words has fingerprint zero, linked like any other;
repeated rows get equal results; null ids do not count as the smallest id unless a component has no other; extra
columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, map_batches, remove, staged, text_column

SEED = 42
#: Fingerprints that the tree of shards is fitted on, at most; every fingerprint is indexed.
SAMPLE = 8192
#: Fingerprints that a shard should hold, and that a task compares at once.
SHARD = 4096
BLOCK = 200_000
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str, width: int = 3) -> int:
    """64 bits: bit b is set if it is set in over half the hashes of the shingles, repeats included."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1 :].tolist(), strict=True)], np.uint64)
    return majority(hashes)


def majority(hashes: np.ndarray) -> int:
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = np.ascontiguousarray(hashes[k : k + (1 << 16)].astype("<u8")).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (ones * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): fp holds the 64 bits as a signed long."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64)
        return pa.record_batch([batch.column(0), pa.array(fps.view(np.int64))], ["id", "fp"])

    return map_batches(docs.select(column(id_col).alias("id"), text_column(text_col).alias("text")), run, f"id {id_type}, fp long")


def fit_tree(sample: np.ndarray, total: int, radius: int, shard: int = SHARD) -> list[tuple]:
    """Nodes (vantage point, threshold, inside, outside) or (None, leaf number). Inside is distance <= threshold.
    The threshold is the one near the median that the fewest sampled balls straddle."""
    nodes: list[tuple] = []
    leaves = 0
    scale = max(1.0, total / max(1, len(sample)))

    def grow(points: np.ndarray, depth: int) -> int:
        nonlocal leaves
        me = len(nodes)
        nodes.append(())
        best = None
        if len(points) * scale > shard and len(points) >= 8 and depth < 24:
            for vp in points[:: max(1, len(points) // 8)][:8]:
                d = np.sort(np.bitwise_count(points ^ vp).astype(np.int64))
                for t in np.unique(d[len(d) * 35 // 100 : len(d) * 65 // 100 + 1])[:-1] if d[0] != d[-1] else ():
                    inside = np.searchsorted(d, t, side="right")
                    straddle = np.searchsorted(d, t + radius, side="right") - np.searchsorted(d, t - radius, side="right")
                    cost = straddle + abs(len(d) - 2 * inside) / 2
                    if 0 < inside < len(d) and (best is None or cost < best[0]):
                        best = (cost, vp, int(t))
        if best is None or best[0] > 0.9 * len(points):
            nodes[me] = (None, leaves)
            leaves += 1
            return me
        _, vp, t = best
        near = np.bitwise_count(points ^ vp) <= t
        a = grow(points[near], depth + 1)
        b = grow(points[~near], depth + 1)
        nodes[me] = (vp, t, a, b)
        return me

    grow(sample, 0)
    return nodes


def route(nodes: list[tuple], fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, leaf, member): each row's own leaf, and the leaves its ball reaches that are numbered higher. A pair
    in two leaves thus meets once, in the higher one."""
    found: list[tuple[np.ndarray, int, np.ndarray]] = []
    todo = [(0, np.arange(len(fps)), np.ones(len(fps), bool))]
    while todo:
        at, rows, home = todo.pop()
        if not len(rows):
            continue
        node = nodes[at]
        if node[0] is None:
            found.append((rows, node[1], home))
            continue
        vp, t, a, b = node
        d = np.bitwise_count(fps[rows] ^ vp).astype(np.int64)
        for child, own, reach in ((a, d <= t, d <= t + radius), (b, d > t, d > t - radius)):
            todo.append((child, rows[reach], (home & own)[reach]))
    if not found:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, bool),)
    rows = np.concatenate([r for r, _, _ in found])
    leaf = np.concatenate([np.full(len(r), n, np.int64) for r, n, _ in found])
    member = np.concatenate([h for _, _, h in found])
    own = np.empty(len(fps), np.int64)
    own[rows[member]] = leaf[member]
    keep = member | (leaf > own[rows])
    return rows[keep], leaf[keep], member[keep]


class Forest:
    """Union-find over the rows of a task; the smaller row is the root."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        """Merges along all pairs at once: roots hook on smaller roots until all agree."""
        p = self.parent
        while len(a):
            ra, rb = self.roots(a), self.roots(b)
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            if not len(a):
                return
            np.minimum.at(p, np.maximum(ra, rb), np.minimum(ra, rb))

    def roots(self, x: np.ndarray) -> np.ndarray:
        p = self.parent
        r = p[x]
        while True:
            up = p[r]
            if np.array_equal(up, r):
                break
            r = up
        p[x] = r
        return r


def link_between(forest: Forest, fps: np.ndarray, left: np.ndarray, right: np.ndarray, radius: int, leaf: int = 1024) -> None:
    """Links every row of left with every row of right within radius. A vantage point splits both sides; no pair is
    lost, as left rows go wherever their ball reaches. Of a row's partners, one for each component is linked."""
    todo = [(left, right, 0)]
    while todo:
        l, r, depth = todo.pop()
        if not len(l) or not len(r):
            continue
        if min(len(l), len(r)) > leaf and depth < 40:
            vp = fps[r[(depth * 7919) % len(r)]]
            dr, dl = np.bitwise_count(fps[r] ^ vp).astype(np.int64), np.bitwise_count(fps[l] ^ vp).astype(np.int64)
            t = int(np.median(dr))
            inner, outer = r[dr <= t], r[dr > t]
            near, far = l[dl <= t + radius], l[dl > t - radius]
            if len(outer) and len(inner) and len(near) + len(far) < 1.9 * len(l):
                todo += [(near, inner, depth + 1), (far, outer, depth + 1)]
                continue
        step = max(1, (1 << 20) // len(r))
        for k in range(0, len(l), step):
            part = l[k : k + step]
            hit = np.bitwise_count(fps[part][:, None] ^ fps[r][None, :]) <= radius
            some = hit.any(axis=1)
            if not some.any():
                continue
            hit, part = hit[some], part[some]
            first = hit.argmax(axis=1)
            forest.link(part, r[first])
            roots = forest.roots(r)
            i, j = np.nonzero(hit & (roots[None, :] != roots[first][:, None]))
            forest.link(part[i], r[j])


def shard_links(distinct: DataFrame, radius: int, sample: int = SAMPLE, shard: int = SHARD, block: int = BLOCK) -> DataFrame:
    """(a, b): edges between fingerprints whose components are those of all pairs within radius."""
    total = distinct.count()
    rows = distinct.select("fp").orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()
    points = np.sort(np.array([r.fp for r in rows], np.int64)).view(np.uint64)
    tree = fit_tree(points[np.random.default_rng(SEED).permutation(len(points))], total, radius, shard)

    def home(batch: pa.RecordBatch) -> pa.RecordBatch:
        r, leaf, member = route(tree, batch.column(0).to_numpy().view(np.uint64), 0)
        return pa.record_batch([pa.array(leaf[member])], ["leaf"])

    sizes = map_batches(distinct.select("fp"), home, "leaf long").groupBy("leaf").count().collect()  # a row for each leaf
    blocks = {r["leaf"]: -(-r["count"] // block) for r in sizes}

    def deal(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = batch.column(0).to_numpy()
        r, leaf, member = route(tree, fps.view(np.uint64), radius)
        parts = np.array([blocks.get(n, 1) for n in leaf.tolist()], np.int64) if len(leaf) else np.empty(0, np.int64)
        # Member block p meets every block q >= p of its shard, and every asking row meets every member block.
        p = (fps[r].view(np.uint64) % np.uint64(1_000_003) % np.maximum(parts, 1).astype(np.uint64)).astype(np.int64)
        out: list[tuple] = []
        single = parts <= 1
        cols = [leaf[single], np.zeros(single.sum(), np.int64), np.zeros(single.sum(), np.int64), fps[r[single]], np.where(member[single], 0, 2)]
        for k in np.flatnonzero(~single).tolist():
            n, own = int(parts[k]), int(p[k])
            if member[k]:
                out += [(leaf[k], min(own, q), max(own, q), fps[r[k]], 0 if q >= own else 1) for q in range(n)]
            else:
                out += [(leaf[k], q, q, fps[r[k]], 2) for q in range(n)]
        if out:
            cols = [np.concatenate([c, np.array(x, np.int64)]) for c, x in zip(cols, zip(*out, strict=True), strict=True)]
        return pa.record_batch([pa.array(c.astype(np.int64)) for c in cols], ["leaf", "p", "q", "fp", "side"])

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        """Members of block p (side 0), of block q (side 1; if p is q, there is side 0 alone), and asking rows (2)."""
        fps = pdf.fp.to_numpy().view(np.uint64)
        side = pdf.side.to_numpy()
        members, others, asking = (np.flatnonzero(side == k) for k in range(3))
        forest = Forest(len(fps))
        if len(members) and (pdf.p.iloc[0] == pdf.q.iloc[0]):
            todo = [(members, members), (asking, members)]
        else:
            todo = [(members, others)]
        for l, r in todo:
            link_between(forest, fps, l, r, radius)
        rows = np.arange(len(fps))
        roots = forest.roots(rows)
        out = roots != rows
        return pd.DataFrame({"a": pdf.fp.to_numpy()[rows[out]], "b": pdf.fp.to_numpy()[roots[out]]})

    dealt = map_batches(distinct.select("fp"), deal, "leaf long, p long, q long, fp long, side long")
    return dealt.groupBy("leaf", "p", "q").applyInPandas(link, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): root is the smallest node of the component; nodes without edges have no row. Alternating large
    and small stars, each round staged in the shared folder."""
    spark = edges.sparkSession
    edges = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = None
    while True:
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").union(down).distinct()
        new = staged(small, "edges")
        remove(spark, edges.scratch_path)
        edges = new
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == mark:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = now


def near_duplicates(docs: DataFrame, radius: int = 2, width: int = 3, id_col: str = "doc_id", text_col: str = "text", **limits: int) -> DataFrame:
    """A row for each document: fingerprint (16 hex digits) and component_id, the smallest id reachable by links."""
    prints = staged(fingerprints(docs, width, id_col, text_col), "fingerprints")
    distinct = staged(prints.groupBy("fp").agg(F.min("id").alias("least")), "distinct")
    roots = components(shard_links(distinct, radius, **limits))
    grouped = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = grouped.join(least, "root").select("fp", "component_id")
    out = prints.join(classes, "fp")
    return out.select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
