"""Line dedup: an exact set-similarity join over the lines of all documents, in DataFrame operations only.

A line is the set of its words, which are runs of anything but ASCII white space; case counts. A line goes if an
earlier line (by document, then by place) has a Jaccard similarity of at least `num / den` with it; a line without
words stays. All words are counted, by 64-bit hashes. A word's level is the logarithm of its count, or of that of the
most frequent word with which it shares one of 2^18 cells; words are ordered by level, then by hash, rarest first.

1. Equal sets meet in an aggregation on their signature, where the earliest stays; copies cost no pairs.
2. Each distinct set posts the keys of its prefix. Of two similar sets the smaller has a key of a shorter prefix in
   common with the prefix of the larger, so a join holds few places against more, under a length, a positional and a
   bitmap filter (two parity bitmaps differ in at most as many bits as the sets differ in words).
3. Keys that many sets of about one size post with the same next word would give too many pairs. Their sets are first
   held against the earliest sets of the key, a fixed number of them; only sets that this does not remove are joined with
   all earlier ones, under the same filters. Dense groups are settled by then. Which keys these are is told from the
   postings of every `SEEN`-th set, picked by hash; it decides only by which of the two ways a pair is found.
4. Pairs that are left are verified word by word.

A key has the level and 56 bits of the hash. Keys of two words may agree: places and numbers of common keys are then
over-estimated, so such words cost pairs to verify, and lose none.

Defined results: a null text stays null and an empty one empty; documents with equal ids are ordered among
themselves by an internal number, and each repeated row counts as a later document; a document of which all lines
go keeps the empty text; extra columns come along, whatever their names. Null ids come first.
"""

from __future__ import annotations

from functools import reduce
from operator import and_, or_

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, column, fresh, keyed, only, staged

CELL_BITS = 18
#: Levels for each doubling of a count.
OCTAVE = 4
#: Cells of posted keys; a bit for each tells the crowded ones.
POSTED_BITS = 22
HASH = (1 << 56) - 1
#: Sets of about one size that may post a key with the same next word before it is settled by its earliest sets.
MANY = 64
SEEN = 8
ANCHORS = 4
#: Parts of the keys that are posted one after the other, so that the postings of one part only are on disk.
PASSES = 4
PAIR = ("xk", "xat", "yk", "yat")
BITS = ("b0", "b1")
#: Words of a set up to which 64 parities tell different sets apart; only larger sets have the second bitmap.
LARGE = 64
#: Words of sets beyond which bitmaps are full, so that they let pairs through that have few words in common.
WIDE = 128
#: White space within a line.
SPACES = "\t\x0b\x0c\r"


def spaced(text: Column) -> Column:
    """text with all white space within lines as spaces."""
    has = reduce(or_, (F.contains(text, F.lit(c)) for c in SPACES))
    return F.when(has, F.translate(text, SPACES, " " * len(SPACES))).otherwise(text)


def words_of(line: Column) -> Column:
    return F.array_distinct(F.array_remove(F.split(line, " "), ""))


def hashes_of(line: Column) -> Column:
    """The hashes of the distinct words of a line."""
    return F.array_distinct(F.transform(F.array_remove(F.split(line, " "), ""), lambda w: F.xxhash64(w)))


def cell(h: Column, bits: int = CELL_BITS) -> Column:
    return h.bitwiseAND(F.lit((1 << bits) - 1))


def numbers(df: DataFrame, *columns: str) -> np.ndarray:
    """The rows of a table of bounded size, packed into a few strings for the way to the driver. They are written first,
    so that what they were counted from leaves the disk."""
    df = staged(df, "line-numbers")
    packed = df.groupBy(F.pmod(F.col(columns[0]), F.lit(64))).agg(F.concat_ws(",", F.collect_list(F.concat_ws(",", *columns))).alias("rows"))
    parts = [np.fromstring(r.rows, np.int64, sep=",") for r in packed.toLocalIterator()]
    return np.concatenate([np.empty(0, np.int64), *parts]).reshape(-1, len(columns))


def constant(values: np.ndarray, kind: str) -> Column:
    return F.split(F.lit(",".join(map(str, values.tolist()))), ",").cast(f"array<{kind}>")


def word_levels(docs: DataFrame) -> Column:
    """An array with the level of each cell, from exact counts of all words."""
    words = docs.select(F.explode(F.split(F.replace(spaced(F.col("text")), F.lit("\n"), F.lit(" ")), " ")).alias("w")).filter("w <> ''")
    counts = words.groupBy(F.xxhash64("w").alias("h")).count()
    level = F.least(F.lit(127), F.floor(F.log2("count") * OCTAVE)).cast("int")
    found = numbers(counts.filter("count > 1").groupBy(cell(F.col("h")).alias("cell")).agg(F.max(level).alias("level")), "cell", "level")
    levels = np.zeros(1 << CELL_BITS, np.int64)
    levels[found[:, 0]] = found[:, 1]
    return constant(levels, "bigint")


def crowded(sets: DataFrame, many: int, num: int, den: int):
    """A test of whether a posted key is in a cell with one that more than many sets of about one size post with the same
    next word, as far as every SEEN-th set tells. Sets of a dense group do; words that are just frequent, as most are in a
    large corpus, are followed by all kinds of words. Sets so small that all that match them are equal have no say."""
    seen = sets.filter((F.pmod(F.xxhash64("k", "at"), F.lit(SEEN)) == 0) & (F.col("size") * (den - num) >= num))
    after = F.concat(F.transform(F.slice("prefix", F.lit(2), F.size("prefix")), low), F.array("after"))
    keys = seen.select(F.floor(F.log("size") * 4.5).alias("sizes"), F.inline(F.arrays_zip(F.col("prefix").alias("key"), after.alias("next"))))
    keys = keys.select(cell(F.col("key"), POSTED_BITS).alias("cell"), F.xxhash64("sizes", "key", "next").alias("both"))
    cells = numbers(keys.groupBy("cell", "both").count().filter(F.col("count") * SEEN > many).select("cell").distinct(), "cell")[:, 0]
    words = np.zeros(1 << (POSTED_BITS - 6), np.uint64)
    np.bitwise_or.at(words, cells >> 6, np.uint64(1) << (cells & 63).astype(np.uint64))
    bits = constant(words.view(np.int64), "bigint")

    def test(key: Column) -> Column:
        at = cell(key, POSTED_BITS)
        return F.call_function("shiftright", F.get(bits, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")).bitwiseAND(F.lit(1)) == 1

    return test


def low(key: Column) -> Column:
    """31 bits of a key."""
    return key.bitwiseAND(F.lit((1 << 31) - 1)).cast("int")


def keys_of(hashes: Column, levels: Column) -> Column:
    """Keys in order, rarest words first: seven bits of level over 56 of hash; as many as there are hashes. Each cell has
    a level, but only arrays that Spark knows to be without nulls are sorted as plain longs."""

    def key(h: Column) -> Column:
        level = F.coalesce(F.get(levels, cell(h).cast("int")), F.lit(0).cast("bigint"))
        return F.shiftleft(level, 56).bitwiseOR(h.bitwiseAND(F.lit(HASH)))

    return F.sort_array(F.transform(hashes, key))


def bitmaps(hashes: Column) -> tuple[Column, Column]:
    """Two longs of parities by the six bits of a hash after its first: of all words, and of those whose first bit is set,
    which is zero for sets of up to LARGE words. The topmost bits are not in keys. What the two differ by is the parity of
    the other words."""
    none, one = F.lit(0).cast("bigint"), F.lit(1).cast("bigint")
    shifted = lambda x, h: F.call_function("shiftleft", x, F.shiftrightunsigned(h, 57).cast("int"))  # noqa: E731  # counts modulo 64
    every = F.aggregate(hashes, none, lambda acc, h: acc.bitwiseXOR(shifted(one, h)))
    upper = F.aggregate(hashes, none, lambda acc, h: acc.bitwiseXOR(shifted(F.shiftrightunsigned(h, 63), h)))
    return every, F.when(F.size(hashes) > LARGE, upper).otherwise(none)


def parities_apart() -> Column:
    """In how many parities x and y differ, by both bitmaps if both sets are large, else by that of all words."""
    differ = [F.col("x" + b).bitwiseXOR(F.col("y" + b)) for b in BITS]
    both = F.bit_count(differ[0].bitwiseXOR(differ[1])) + F.bit_count(differ[1])
    return F.when(F.least("xsize", "ysize") > LARGE, both).otherwise(F.bit_count(differ[0]))


def least_common(size: Column, num: int, den: int) -> Column:
    """The least overlap of two sets with so many words together."""
    return F.call_function("div", size * num + (num + den - 1), F.lit(num + den))


def may_match(num: int, den: int) -> Column:
    """Length, positional and bitmap filters for sizes, places of the shared word (from zero) and bitmaps of x and y. The
    positional one is for the first word that both have, and a pair is found at that, be it crowded or not."""
    xs, ys, xi, yi = (F.col(c) for c in ("xsize", "ysize", "xi", "yi"))
    least = least_common(xs + ys, num, den)
    return (F.least(xs, ys) * den >= F.greatest(xs, ys) * num) & (F.least(xs - xi, ys - yi) >= least) & (parities_apart() <= xs + ys - 2 * least)


def line_words(wanted: DataFrame, docs: DataFrame) -> DataFrame:
    """(k, at, words) of the lines (k, at) that are wanted; other texts are not split."""
    wanted = staged(wanted.distinct().groupBy("k").agg(F.collect_list("at").alias("wanted")), "line-wanted")
    parts = F.array(F.split(spaced(F.col("text")), "\n"))  # one element, so that a lambda can hold all lines
    picked = F.flatten(F.transform(parts, lambda p: F.transform("wanted", lambda at: F.struct(at.alias("at"), F.get(p, at).alias("line")))))
    lines = docs.join(bounded(wanted), "k").select("k", F.explode(picked).alias("x"))
    return staged(lines.select("k", "x.at", words_of(F.col("x.line")).alias("words")), "line-words")


def matches(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """(k, at) of the y of those pairs (xk, xat, yk, yat) whose sets of words are similar."""
    # In a group of copies most lines are settled by their earliest or nearest partner, so these come first.
    ends = (F.min(F.struct("xk", "xat")), F.max(F.struct("xk", "xat")))
    some = pairs.groupBy("yk", "yat").agg(F.array_distinct(F.array(*ends)).alias("x")).select("yk", "yat", F.explode("x").alias("x")).select("x.xk", "x.xat", "yk", "yat")
    gone = staged(similar(some, sets, num, den), "line-matches")
    rest = pairs.join(gone.select(F.col("k").alias("yk"), F.col("at").alias("yat")), ["yk", "yat"], "left_anti").select(*PAIR)
    return staged(gone.union(similar(rest, sets, num, den)), "line-matches")


def similar(pairs: DataFrame, words: DataFrame, num: int, den: int) -> DataFrame:
    """(k, at) of the y of those pairs whose sets of words are similar."""
    both = gathered(pairs, words, "words")
    x, y = F.get("words", F.lit(0)), F.get("words", F.lit(1))
    found = both.filter(F.size(F.array_intersect(x, y)) * (num + den) >= (F.size(x) + F.size(y)) * num)
    return found.select(F.col("yk").alias("k"), F.col("yat").alias("at")).distinct()


def gathered(pairs: DataFrame, lines: DataFrame, what: str) -> DataFrame:
    """pairs with a list of what lines (k, at, what) have of x and y, in any order. It goes to the pairs in one shuffle."""
    one, other = (F.struct(F.col(f"{c}k").alias("k"), F.col(f"{c}at").alias("at")) for c in "xy")
    ends = staged(pairs.select(*PAIR, F.inline(F.array(one, other))), "line-ends")
    return lines.join(bounded(ends), ["k", "at"]).groupBy(*PAIR).agg(F.collect_list(what).alias(what))


def posted(sets: DataFrame, *more: str) -> DataFrame:
    return sets.select("k", "at", "size", *BITS, *more, F.posexplode("prefix").alias("i", "key"))


def as_side(postings: DataFrame, side: str) -> DataFrame:
    return postings.select("key", *(F.col(c).alias(side + c) for c in postings.columns if c != "key"))


def posted_words(size: Column, num: int, den: int) -> Column:
    """How many words a set posts: of similar sets, the first common one is among these."""
    return size - F.call_function("div", size * num + (den - 1), F.lit(den)) + 1


def in_common(num: int, den: int) -> Column:
    """How many words the prefixes of x and y have in common at least, if they are similar. Where words are in one
    order, a prefix of one set and the rest of the other can share words for one of the two only; so beyond the words
    that the prefixes share, at most the longer of the two rests can be common."""
    x, y = F.col("xsize"), F.col("ysize")
    return least_common(x + y, num, den) - F.greatest(x - posted_words(x, num, den), y - posted_words(y, num, den))


def few_pairs(sets: DataFrame, is_many, num: int, den: int) -> DataFrame:
    """Pairs that meet at keys which are not crowded. The smaller set of a pair comes as x: with a set of its own size or
    more it has so many words in common that the first is among few. That test stays above the exchange, which serves
    both sides: the floor of a random number, always zero, keeps it from being pushed below, and what the join asks of
    either side is asked of both beforehand. Keys are dealt into passes by bits that neither cells nor levels are made
    of; each pass writes its pairs, and its postings go. Pairs of wide sets are held against the prefixes of both, as the
    words of such sets are long and the pairs that bitmaps leave of them grow as the square of the text."""
    whole = sets.filter(reduce(and_, (F.col(c).isNotNull() for c in ("k", "at", "size", *BITS, "prefix"))))
    prefixes = whole.filter(F.col("size") > WIDE).select("k", "at", F.struct("size", "prefix").alias("of"))
    met = [staged(meetings(posted(whole).filter(nth_pass(F.col("key"), n) & ~is_many(F.col("key"))), num, den), "line-close") for n in range(PASSES)]
    met = reduce(DataFrame.union, met)
    wide = alike_wide(met.filter("wide").select(*PAIR).distinct(), prefixes, num, den)
    return met.filter("NOT wide").select(*PAIR).union(staged(wide, "line-wide"))


def alike_wide(pairs: DataFrame, prefixes: DataFrame, num: int, den: int) -> DataFrame:
    """Those pairs whose prefixes have enough keys in common; prefixes has (k, at, of), of being size and prefix."""
    both = gathered(pairs, prefixes, "of")
    both = both.select(*PAIR, *(F.get("of", F.lit(n))[c].alias(s + c) for n, s in enumerate("xy") for c in ("size", "prefix")))
    return both.filter(enough_alike(num, den)).select(*PAIR)


def nth_pass(key: Column, n: int) -> Column:
    return F.pmod(F.shiftright(key, 32), F.lit(PASSES)) == n


def meetings(postings: DataFrame, num: int, den: int) -> DataFrame:
    """The different pairs, the earlier first, of postings with equal keys that pass the filters; wide tells whether both
    sets are."""
    postings = postings.filter(F.col("key").isNotNull()).repartition("key")
    x = as_side(postings, "x").filter(F.col("xi") <= F.col("xsize") - least_common(2 * F.col("xsize"), num, den) + F.floor(F.rand()))
    joined = x.join(as_side(postings, "y").hint("merge"), "key").filter((F.col("xsize") <= F.col("ysize")) & may_match(num, den))
    one, other = (F.struct(F.col(f"{c}k").alias("k"), F.col(f"{c}at").alias("at")) for c in "xy")
    wide = F.least("xsize", "ysize") > WIDE
    pairs = joined.filter(one != other).select(F.least(one, other).alias("x"), F.greatest(one, other).alias("y"), wide.alias("wide"))
    return pairs.select(*(F.col(f"{c[0]}.{c[1:]}").alias(c) for c in PAIR), "wide").distinct()


def enough_alike(num: int, den: int) -> Column:
    """Whether xprefix and yprefix have enough keys in common. Keys that x has twice count for as many as may be."""
    twice = F.size("xprefix") - F.size(F.array_distinct("xprefix"))
    return F.size(F.array_intersect("xprefix", "yprefix")) + twice >= in_common(num, den)


def crowd_pairs(x: DataFrame, y: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs that meet at crowded keys, x before y. Their postings carry the prefixes, so these are compared at once, and
    a pair is taken at the first crowded key that it has in common only."""
    once = F.get(F.array_intersect("xcrowd", "ycrowd"), F.lit(0)) == F.col("key")
    ordered = F.struct("xk", "xat") < F.struct("yk", "yat")
    return as_side(x, "x").join(as_side(y, "y"), "key").filter(may_match(num, den) & ordered).filter(enough_alike(num, den) & once).select(*PAIR)


def kept_lines(docs: DataFrame, num: int, den: int) -> DataFrame:
    """(k, at) of the lines with words that stay; docs has the order key k and the text, never null."""
    levels = word_levels(docs)
    lines = docs.select("k", F.posexplode(F.split(spaced(F.col("text")), "\n")).alias("at", "line"))
    hashed = lines.select("k", "at", hashes_of(F.col("line")).alias("h"))
    every, upper = bitmaps(F.col("h"))
    whole = hashed.select("k", "at", F.size("h").alias("size"), every.alias("b0"), upper.alias("b1"), keys_of(F.col("h"), levels).alias("t"))
    n = posted_words(F.col("size"), num, den).cast("int")
    after = F.coalesce(low(F.get("t", n)), F.lit(0))
    slim = whole.select("k", "at", "size", *BITS, F.xxhash64("t").alias("sign"), F.slice("t", F.lit(1), n).alias("prefix"), after.alias("after"))
    # Equal sets have equal signatures, sizes and bitmaps, made of all bits of the hashes but one or two; all their lines have the same prefix.
    sets = slim.groupBy("sign", "size", *BITS).agg(F.min(F.struct("k", "at")).alias("first"), F.first("prefix").alias("prefix"), F.first("after").alias("after"))
    # The filter comes after the table is written: before, it would be pushed down, and hashes would be made twice.
    sets = staged(sets.select("first.k", "first.at", F.col("size").cast("long").alias("size"), *BITS, "prefix", "after"), "line-sets").filter("size > 0")

    is_many = crowded(sets, MANY, num, den)
    # Few keys are crowded: they are told in compiled code, and lists of them are made for their sets only.
    crowd = posted(sets, "prefix").filter(is_many(F.col("key")))
    crowd = staged(crowd.withColumn("crowd", F.filter("prefix", is_many)), "line-crowd")
    anchors = crowd.groupBy("key", F.pmod(F.xxhash64("k", "at"), F.lit(ANCHORS))).agg(F.min(F.struct("k", "at", "size", "i", *BITS, "prefix", "crowd")).alias("a")).select("key", "a.*")
    pairs = only(lambda: staged(few_pairs(sets, is_many, num, den).union(crowd_pairs(anchors, crowd, num, den)).distinct(), "line-pairs"))
    ends = pairs.select(F.col("xk").alias("k"), F.col("xat").alias("at")).union(pairs.select("yk", "yat")).union(crowd.select("k", "at"))
    words = only(lambda: line_words(ends, docs))
    gone = only(lambda: matches(pairs, words, num, den))

    left = crowd.join(gone, ["k", "at"], "left_anti")
    far = staged(crowd_pairs(crowd, left, num, den).distinct().join(pairs, [*PAIR], "left_anti"), "line-far")
    gone = gone.union(only(lambda: matches(far, words, num, den)))
    return sets.select("k", "at").join(gone, ["k", "at"], "left_anti")


def dedup_lines(docs: DataFrame, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs without the lines that match an earlier line; n_removed and n_lines are added, with an underscore after the
    name where docs has such a column."""
    rows = keyed(docs, id_col)
    body = column(text_col, "row").cast("string")
    text = rows.select("k", body.alias("text")).filter("text IS NOT NULL")
    kept = only(lambda: staged(kept_lines(text, num, den).groupBy("k").agg(F.collect_set("at").alias("kept")), "line-kept"))
    out = rows.select("k", "row", F.split(body, "\n").alias("lines")).join(bounded(kept), "k", "left")
    stay = F.filter("lines", lambda line, i: F.coalesce(F.array_contains("kept", i), F.lit(False)) | (F.btrim(line, F.lit(f" {SPACES}")) == ""))
    out = out.select("row", "lines", stay.alias("stay")).withColumn("n", F.coalesce(F.size("lines"), F.lit(0)).cast("long"))
    out = out.withColumn("gone", F.col("n") - F.coalesce(F.size("stay"), F.lit(0)))
    left = F.when(F.col("gone") > 0, F.array_join("stay", "\n")).otherwise(body)
    names = [fresh(c, docs.columns) for c in ("n_removed", "n_lines")]
    return out.select(*((left if c == text_col else column(c, "row")).alias(c) for c in docs.columns), F.col("gone").alias(names[0]), F.col("n").alias(names[1]))
