"""SimHash near-duplicates with a similarity: links of word shingles at a Jaccard similarity, connected components.

Fingerprints of 64 bits tell documents of similarity 0.8 from others by up to some 16 bits, where a vantage-point tree
prunes nothing. So links within a few bits come from the tree, and an exact join under a prefix filter finds the rest;
all are verified on whole sets of shingles.

A document is the set of its shingles of `width` words, lower-cased (A-Z) and split at ASCII white space, as 64-bit
hashes in their numerical order. Equal sets are one node, so exact copies cost nothing more.

1. Fingerprints within `radius` bits are linked by the tree of `simhash`, and compared whole.
2. Each set posts the hashes of its prefix, which is longer than one common hash of two similar sets needs, so that
   they have several in common. Hashes that one set alone posts go, and then sets with fewer hashes left than any
   similar set would share with them; that is most long texts, which share a phrase with many others.
3. Each set is held against one set of each hash that it shares, under a length, a positional and a bitmap filter (two
   parity bitmaps differ in at most as many bits as the sets do in hashes); pairs that pass and meet often are compared
   whole and linked. With step 1, this settles dense groups with pairs in proportion to their size.
4. All pairs of a shared hash that are not linked yet, by whatever way, are compared whole too, under the same filters.
   Here every meeting counts, so pairs that meet less often than similar ones must can go. The sets of a hash are
   dealt into blocks of about `BLOCK`, and a task gets two blocks at once.
   Whole sets are made again from the texts of such pairs; else only prefixes are kept.

The filters drop no similar pair, so components are those of all pairs with similarity of at least `num / den`.

Defined results: a text with fewer words than `width` is one shingle; null, empty and blank texts are copies of each
other; repeated rows get equal results; extra columns come along, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Bitmap, bounded, column, keyed, map_batches, only, replace, staged, text_column
from .simhash import LOWER, SEED, components, majority, shard_links

#: 64-bit words of a parity bitmap.
BITMAP = 8
#: A set of so many hashes posts one more.
STEP = 10
#: Sets of one hash that are compared at once with as many others.
BLOCK = 4096


def all_shingles(text: str, width: int = 5) -> np.ndarray:
    """The shingles of a whole text as hashes, repeats included."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split()
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = len(words) - width + 1
    mixed = np.zeros(n, np.uint64)
    for j in range(width):
        mixed = (mixed ^ h[j : j + n]) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    return mixed


def shingles(text: str, width: int = 5) -> np.ndarray:
    """The distinct shingles of a whole text, sorted."""
    return np.unique(all_shingles(text, width).view(np.int64))


def bitmap(tokens: np.ndarray) -> bytes:
    odd = np.bincount(tokens.view(np.uint64) & np.uint64(64 * BITMAP - 1), minlength=64 * BITMAP) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def lists(made: list[np.ndarray]) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, made)]).astype(np.int32)), pa.array(np.concatenate(made)))


def shingle_sets(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(id, fp, sim, size, need, bits, prefix) of (id, text): fp is a hash of the whole set, sim the fingerprint, need how
    many hashes of the prefix a similar set has at least."""
    import xxhash

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        every = [all_shingles(t, width) for t in batch.column(1).to_pylist()]
        sims = np.array([majority(x) if len(x) else 0 for x in every], np.uint64).view(np.int64)
        made = [np.unique(x.view(np.int64)) for x in every]
        fps = np.array([xxhash.xxh64_intdigest(m.tobytes(), SEED) for m in made], np.uint64).view(np.int64)
        prefixes = lists([m[: posted(len(m), num, den)] for m in made])
        needs = [least_shared(len(m), num, den) for m in made]
        columns = [batch.column(0), pa.array(fps), pa.array(sims), pa.array([len(m) for m in made], pa.int64()), pa.array(needs, pa.int64()), pa.array([bitmap(m) for m in made], pa.binary()), prefixes]
        return pa.record_batch(columns, ["id", "fp", "sim", "size", "need", "bits", "prefix"])

    return map_batches(docs, run, f"id {docs.schema['id'].dataType.simpleString()}, fp long, sim long, size long, need long, bits binary, prefix array<bigint>")


def posted(size, num: int, den: int):
    """How many hashes sets of so many post."""
    return size - (size * num + (den - 1)) // den + 1 + size // STEP


def least_common(size: np.ndarray, num: int, den: int) -> np.ndarray:
    """The least overlap of two sets with so many shingles together."""
    return (size * num + (num + den - 1)) // (num + den)


def common_posts(x: np.ndarray, y: np.ndarray, num: int, den: int) -> np.ndarray:
    """How many hashes the prefixes of similar sets of x and y hashes have in common at least: beyond these, at most the
    longer of the two rests can be common, as hashes are in one order."""
    return least_common(x + y, num, den) - np.maximum(x - posted(x, num, den), y - posted(y, num, den))


def least_shared(size: int, num: int, den: int) -> int:
    """The same for the similar set of whatever size with which it is least."""
    others = np.arange((size * num + den - 1) // den, size * den // num + 1)
    return int(common_posts(np.int64(size), others, num, den).min()) if size else 0


def shared_posts(sets: DataFrame, shared: DataFrame) -> DataFrame:
    """(fp, size, need, i, token) of the posted hashes that sets share, and some by chance."""
    known = Bitmap(shared, "token", 24)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prefix = batch.column(3)
        tokens = prefix.flatten().to_numpy()
        counts = np.diff(prefix.offsets.to_numpy())
        row = np.repeat(np.arange(len(counts)), counts)
        place = np.arange(len(tokens)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = np.flatnonzero(known.has(tokens.view(np.uint64)))
        rows = pa.array(row[at])
        return pa.record_batch([*(batch.column(c).take(rows) for c in range(3)), pa.array(place[at].astype(np.int64)), pa.array(tokens[at])], ["fp", "size", "need", "i", "token"])

    return map_batches(sets.select("fp", "size", "need", "prefix"), run, "fp long, size long, need long, i long, token long")


def verified(pairs: DataFrame, docs: DataFrame, distinct: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """Those pairs (a, b) whose whole sets are similar."""
    ends = pairs.select(F.col("a").alias("fp")).union(pairs.select("b")).distinct()
    first = staged(ends.join(distinct, "fp").select("fp", F.col("least").alias("id")), "shingle-ends")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column(0), lists([shingles(t, width) for t in batch.column(1).to_pylist()])], ["fp", "tokens"])

    whole = staged(map_batches(docs.join(bounded(first), "id").select("fp", "text"), run, "fp long, tokens array<bigint>"), "shingle-whole")
    side = lambda c: whole.select(F.col("fp").alias(c), F.col("tokens").alias(f"{c}t"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    common = F.size(F.array_intersect("at", "bt"))
    return both.filter(common * (num + den) >= (F.size("at") + F.size("bt")) * num).select("a", "b")


def passing(x: dict[str, np.ndarray], y: dict[str, np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Which meetings of members x and y pass the filters, and how often such pairs must meet."""
    both = x["size"] + y["size"]
    least = least_common(both, num, den)
    ok = np.minimum(x["size"], y["size"]) * den >= np.maximum(x["size"], y["size"]) * num
    ok &= np.minimum(x["i"], y["i"]) + np.minimum(x["size"] - x["i"], y["size"] - y["i"]) >= least
    at = np.flatnonzero(ok)
    at = at[np.bitwise_count(x["bits"][at] ^ y["bits"][at]).sum(axis=1, dtype=np.int64) <= (both - 2 * least)[at]]
    return at, common_posts(x["size"][at], y["size"][at], num, den)


def members_of(flat: pa.StructArray) -> dict[str, np.ndarray]:
    out = {c: flat.field(c).to_numpy() for c in ("fp", "size", "i")}
    return out | {"bits": np.frombuffer(b"".join(flat.field("bits").to_pylist()), np.uint64).reshape(-1, BITMAP)}


def taken(x: dict[str, np.ndarray], at: np.ndarray) -> dict[str, np.ndarray]:
    return {c: v[at] for c, v in x.items()}


def pairs_of(met: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b, need = (np.concatenate([m[k] for m in met] or [np.empty(0, np.int64)]) for k in range(3))
    return pa.record_batch([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(need)], ["a", "b", "need"])


def near_pairs(prints: DataFrame, radius: int) -> DataFrame:
    """(a, b): sets (fp, sim) that the tree links within radius bits; with equal fingerprints, each with the smallest."""
    sims = staged(prints.groupBy("sim").agg(F.min("fp").alias("least")), "shingle-sims")
    edges = shard_links(sims.select(F.col("sim").alias("fp")), radius)
    side = lambda c: sims.select(F.col("sim").alias(c), F.col("least").alias(f"{c}fp"))
    near = edges.join(side("a"), "a").join(side("b"), "b").select(F.col("afp").alias("a"), F.col("bfp").alias("b"))
    same = prints.join(sims, "sim").filter("fp <> least").select(F.col("least").alias("a"), F.col("fp").alias("b"))
    return near.union(same).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def often(met: DataFrame) -> DataFrame:
    return met.groupBy("a", "b").agg(F.count("*").alias("n"), F.max("need").alias("need")).filter("n >= need").select("a", "b")


def star_pairs(members: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): each member of a hash with the smallest of that hash, if they pass the filters and meet often."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, y = (members_of(batch.column(c)) for c in (0, 1))
        at, need = passing(x, y, num, den)
        return pairs_of([(x["fp"][at], y["fp"][at], need)])

    one = F.struct("fp", "size", "i", "bits")
    centres = members.groupBy("token").agg(F.min(one).alias("c"))
    stars = members.select("token", one.alias("m")).join(centres.hint("merge"), "token").filter("m.fp <> c.fp").select("m", "c")
    return often(map_batches(stars, run, "a long, b long, need long"))


def open_pairs(rooted: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): pairs of members of one hash in different components that pass the filters and meet often."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        met = []
        for k in range(batch.num_rows):
            flat = batch.column(2)[k].values
            x, root, block = members_of(flat), flat.field("root").to_numpy(), flat.field("block").to_numpy()
            same = batch.column(0)[k].as_py() == batch.column(1)[k].as_py()
            rows = np.flatnonzero(block == batch.column(0)[k].as_py())
            step = max(1, (1 << 17) // len(block))
            for lo in range(0, len(rows), step):
                part = rows[lo : lo + step]
                i, j = np.nonzero((root[part, None] != root[None, :]) & ((part[:, None] < np.arange(len(block))[None, :]) if same else (block[part, None] != block[None, :])))
                i = part[i]
                at, need = passing(taken(x, i), taken(x, j), num, den)
                met.append((x["fp"][i[at]], x["fp"][j[at]], need))
        return pairs_of(met)

    sized = rooted.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = rooted.join(sized.filter("low <> high").select("token", "blocks").hint("merge"), "token").withColumn("block", F.pmod(F.xxhash64("fp"), "blocks").cast("int"))
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: F.struct(F.least("block", j).alias("one"), F.greatest("block", j).alias("two")))
    dealt = dealt.select("token", F.explode(others).alias("part"), F.struct("fp", "root", "size", "i", "bits", "block").alias("m"))
    groups = dealt.groupBy("token", "part").agg(F.collect_list("m").alias("members")).select("part.one", "part.two", "members")
    return often(map_batches(groups, run, "a long, b long, need long"))


def similar_documents(docs: DataFrame, width: int = 5, num: int = 4, den: int = 5, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each document: id and component_id, the smallest id of those that links of similar sets reach. Ids
    are neither null nor repeated."""
    docs = docs.select(F.col(id_col).alias("id"), text_column(text_col).alias("text"))
    sets = staged(shingle_sets(docs, width, num, den), "shingle-sets")
    distinct = staged(sets.groupBy("fp").agg(F.min("id").alias("least")), "shingle-distinct")
    firsts = sets.filter("size > 0").join(bounded(distinct, F.col("fp"), F.col("least").alias("id")), ["fp", "id"], "left_semi")
    posts = firsts.select("fp", F.explode("prefix").alias("token"))
    shared = staged(posts.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1").select("token"), "shingle-tokens")
    members = staged(shared_posts(firsts, shared).join(shared.hint("merge"), "token"), "shingle-shared")
    live = members.groupBy("fp", "need").agg(F.count("*").alias("n")).filter("n >= need").select("fp")
    maps = firsts.select("fp", "bits").join(live.hint("merge"), "fp")
    members = replace(members, members.select("token", "fp", "size", "i").join(maps.hint("merge"), "fp"), "shingle-members")

    near = near_pairs(firsts.select("fp", "sim"), radius)
    tried = staged(near.union(star_pairs(members, num, den)).distinct(), "shingle-tried")
    links = only(lambda: staged(verified(tried, docs, distinct, width, num, den), "shingle-links"))
    roots = only(lambda: staged(components(links).withColumnRenamed("node", "fp"), "shingle-roots"))
    rooted = members.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rest = staged(open_pairs(rooted, num, den).join(tried, ["a", "b"], "left_anti"), "shingle-open")
    if not rest.isEmpty():
        links = links.union(verified(rest, docs, distinct, width, num, den))
        roots = components(links).withColumnRenamed("node", "fp")

    grouped = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    classes = grouped.join(grouped.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return sets.select(F.col("id").alias(id_col), "fp").join(classes, "fp").select(id_col, "component_id")


def first_of_similar(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """docs without those that have a smaller id in their component."""
    rows = keyed(docs, id_col)
    classes = lambda: similar_documents(rows.select("k", column(text_col, "row").alias("text")), id_col="k", **how)
    first = only(lambda: staged(classes().filter(F.col("k").eqNullSafe(F.col("component_id"))).select("k"), "shingle-first"))
    return rows.join(bounded(first), "k", "left_semi").select("row.*")
