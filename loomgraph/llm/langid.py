"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Character n-grams of one to three letters, words framed by a space, are hashed into a fixed number of columns. In how
many documents each column occurs is counted over all labelled rows. A sample of them, the rows of each language with
the smallest hashes of their ids, is turned into counts on the executors; the driver fits the weights with
follow-the-regularised-leader under elastic-net penalties and calibrates one temperature on rows the fit has not seen.
Every whole text is then scored in one pass without a shuffle.

The sample has at most `per_lang` rows a language, or `rows` in all if that is less, but `least` rows of any language;
no language is left out. The driver holds the counts of the sample and a weight for each column and language.

Defined results: `und` with score 0 for a null text, an empty one or one without a letter, and for every text if
no labelled row exists; ties go to the first language in sorted order; repeated rows get equal results; extra columns
come along, whatever their names, but columns called lang_pred and score are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, map_batches, staged, text_column, worker_cache

BITS = 15
CHUNK = 1 << 20
UNKNOWN = "und"


@dataclass(frozen=True)
class LangParams:
    per_lang: int = 400
    rows: int = 40_000
    least: int = 20
    epochs: int = 4
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1e-3
    l2: float = 1e-3


@dataclass
class LangModel:
    langs: list[str]
    idf: np.ndarray
    weights: np.ndarray  # a row for each column of the hash, and the last for the bias
    temperature: float


def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def counts(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """Columns and counts of the n-grams of a whole text; None if it has no letter."""
    is_letter = worker_cache("letters", letters)
    part, any_letter = None, False
    low = text.lower()
    carry = np.array([32], np.uint64)
    for k in range(0, len(low), CHUNK):
        points = np.frombuffer(low[k : k + CHUNK].encode("utf-32-le", "surrogatepass"), "<u4")
        letter = is_letter[points]
        points = np.where(letter, points, 32).astype(np.uint64)
        if k + CHUNK >= len(low):
            points = np.append(points, np.uint64(32))
        points = np.concatenate([carry, points])
        keep = np.ones(len(points), bool)
        keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
        points = points[keep]
        # Only n-grams that end in this chunk; single letters without spaces.
        old = len(carry)
        single, pairs, triples = points[old:], points[old - 1 :], points[max(0, old - 2) :]
        gram = triples[:-1] * np.uint64(0x1F123BB5) + triples[1:]
        found = [single[single != 32], pairs[:-1] * np.uint64(0x1F123BB5) + pairs[1:], gram[:-1] * np.uint64(0x9E3779B1) + triples[2:] + np.uint64(7)]
        columns = (np.concatenate(found) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)).astype(np.int64)
        part = part + np.bincount(columns, minlength=1 << BITS) if k else np.bincount(columns, minlength=1 << BITS)
        any_letter = any_letter or bool(letter.any())
        carry = points[-2:]
    if not any_letter:
        return None
    columns = np.flatnonzero(part)
    return columns, part[columns]


def vector(columns: np.ndarray, n: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = (1.0 + np.log(n)) * idf[columns]
    return v / np.sqrt(v @ v)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit(rows: list[tuple[str, np.ndarray, np.ndarray]], p: LangParams = LangParams(), df: np.ndarray | None = None, total: int = 0) -> LangModel:
    """rows: (language, columns, counts). Every fifth row calibrates only. df: in how many of total documents each column
    occurs; without it, that of rows."""
    langs = sorted({r[0] for r in rows})
    size = 1 << BITS
    if df is None:
        df, total = np.zeros(size), len(rows)
        for _, columns, _ in rows:
            df[columns] += 1
    idf = np.log((1 + total) / (1 + df)) + 1
    k = len(langs)
    z, n, w = np.zeros((size + 1, k)), np.zeros((size + 1, k)), np.zeros((size + 1, k))
    seen = [(langs.index(lang), np.append(c, size), np.append(vector(c, m, idf), 1.0)) for lang, c, m in rows]
    held, train = seen[::5], [x for i, x in enumerate(seen) if i % 5] or seen
    order = np.random.default_rng(7)
    for _ in range(p.epochs):
        for i in order.permutation(len(train)):
            y, c, v = train[i]
            zc, nc = z[c], n[c]
            wc = np.where(np.abs(zc) <= p.l1, 0.0, -(zc - np.sign(zc) * p.l1) / ((p.beta + np.sqrt(nc)) / p.alpha + p.l2))
            prob = softmax(v @ wc)
            prob[y] -= 1
            g = v[:, None] * prob
            sigma = (np.sqrt(nc + g * g) - np.sqrt(nc)) / p.alpha
            z[c] = zc + g - sigma * wc
            n[c] = nc + g * g
    w = np.where(np.abs(z) <= p.l1, 0.0, -(z - np.sign(z) * p.l1) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2))
    logits = np.array([v @ w[c] for _, c, v in held]) if held else np.zeros((0, k))
    truth = np.array([y for y, _, _ in held], int)

    miss = 1 / (len(truth) + 2)  # without this, a fit without an error would make every score 1

    def loss(log_t: float) -> float:
        prob = np.maximum(softmax(logits / np.exp(log_t)), 1e-12)
        right = np.log(prob[np.arange(len(truth)), truth])
        wrong = np.log(np.maximum(1 - prob[np.arange(len(truth)), truth], 1e-12))
        return -((1 - miss) * right + miss * wrong).mean() if len(truth) else 0.0

    grid = np.linspace(np.log(0.05), np.log(20), 241)
    return LangModel(langs, idf, w, float(np.exp(grid[int(np.argmin([loss(t) for t in grid]))])))


def document_counts(texts: DataFrame) -> np.ndarray:
    """In how many of the texts each column occurs; the last entry is the number of texts with a letter."""

    def run(batches):
        total = np.zeros((1 << BITS) + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                if (found := counts(text.as_py())) is not None:
                    total[found[0]] += 1
                    total[-1] += 1
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(at), pa.array(total[at])], ["at", "n"])

    found = texts.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()  # a row for each column at most
    out = np.zeros((1 << BITS) + 1, np.int64)
    out[found["at"].to_numpy()] = found["n"].to_numpy()
    return out


def train(labelled: DataFrame, p: LangParams = LangParams(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LangModel | None:
    """Fits on a sample of the rows of labelled, with document counts of all of them."""
    rows = labelled.select(F.xxhash64(column(id_col).cast("string")).alias("key"), column(text_col).cast("string").alias("text"), column(lang_col).cast("string").alias("lang")).filter("lang IS NOT NULL AND text IS NOT NULL")
    sizes = {r.lang: r["count"] for r in rows.groupBy("lang").count().collect()}  # a row for each language
    if not sizes:
        return None
    wanted = min(p.per_lang, max(p.least, p.rows // len(sizes)))
    # Somewhat more rows than wanted pass a bound on the hash; of these, the exact number is taken when they are counts.
    bounds = F.create_map(*(F.lit(x) for lang, n in sorted(sizes.items()) for x in (lang, min(1.0, (1.3 * wanted + 30) / n))))
    near = rows.filter(F.shiftrightunsigned("key", 1) / F.lit(float(1 << 63)) < F.element_at(bounds, F.col("lang")))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        found = [(i, c) for i, t in enumerate(batch.column(1).to_pylist()) if (c := counts(t)) is not None]
        if not found:
            return None
        at = pa.array([i for i, _ in found], pa.int64())
        return pa.record_batch([batch.column(0).take(at), batch.column(2).take(at), pa.array([c for _, (c, _) in found], pa.list_(pa.int32())), pa.array([n for _, (_, n) in found], pa.list_(pa.int32()))], ["key", "lang", "columns", "counts"])

    made = map_batches(near, run, "key long, lang string, columns array<int>, counts array<int>")
    first = Window.partitionBy("lang").orderBy(F.shiftrightunsigned("key", 1), F.xxhash64("columns", "counts"))
    made = staged(made.withColumn("nth", F.row_number().over(first)).filter(F.col("nth") <= wanted), "lang-sample").orderBy("nth", "lang").toArrow()
    got = [(made["lang"][i].as_py(), np.asarray(made["columns"][i].values), np.asarray(made["counts"][i].values)) for i in range(made.num_rows)]
    if not got:
        return None
    df = document_counts(rows.select("text"))
    return fit(got, p, df[:-1], int(df[-1]))


def predict(docs: DataFrame, model: LangModel | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns keep of docs (all, by default), lang_pred and score; one pass, no shuffle."""
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() not in ("lang_pred", "score")]
    row = F.struct(*(column(c) for c in keep)).alias("row")
    # Where the text is kept anyway, it is sent once.
    place = keep.index(text_col) if text_col in keep and docs.schema[text_col].dataType == T.StringType() else None
    sent = docs.select(row) if place is not None else docs.select(row, text_column(text_col).alias("text"))
    names = model.langs if model else []
    table = None
    if model:
        weights = model.weights.astype(np.float32)
        nonzero = np.flatnonzero(weights.any(axis=1)).astype(np.int32)
        table = (nonzero, weights[nonzero], model.idf.astype(np.float32), model.temperature)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, scores = [], []
        dense = None
        if table is not None:
            dense = np.zeros((len(table[2]) + 1, len(names)), np.float32)
            dense[table[0]] = table[1]
        for text in (batch.column(1) if place is None else batch.column(0).field(place)).to_pylist():
            got = counts(text) if dense is not None and text else None
            if got is None:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            columns, n = got
            prob = softmax((vector(columns, n, table[2]).astype(np.float64) @ dense[columns] + dense[-1]) / table[3])
            best = int(np.argmax(prob))
            langs.append(names[best])
            scores.append(float(min(1.0, max(0.0, prob[best]))))
        return pa.record_batch([batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["row", "lang_pred", "score"])

    schema = T.StructType([sent.schema["row"]]).add("lang_pred", "string").add("score", "double")
    return map_batches(sent, run, schema).select("row.*", "lang_pred", "score")


def held_out(id_col: str = "doc_id"):
    return F.crc32(column(id_col).cast("string").cast("binary")) % 4 == 2


def identify(docs: DataFrame, p: LangParams = LangParams(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Trains on the rows that are not held out and predicts all of them: id, held_out, lang_pred, score."""
    out = F.coalesce(held_out(id_col), F.lit(False))
    model = train(docs.filter(~out), p, id_col, text_col, lang_col)
    return predict(docs.select(column(id_col).alias("id"), out.alias("held_out"), column(text_col).alias("text")), model, "text", ["id", "held_out"]).withColumnRenamed("id", id_col)
