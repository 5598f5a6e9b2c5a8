"""Token counts under a unigram model, by dynamic programming that words with a common beginning share.

The pieces are those of a public vocabulary, which gives each a rank; the log-probability of a piece is Zipf's law
over the ranks. It is not fitted to the corpus, as tokenizers are never trained here. A word (a run of anything but
ASCII white space, led by the space mark) is split into the pieces of the greatest total score, of those the fewest; a
character without a piece costs a piece for each of its bytes.

A worker keeps a trie of the distinct words it has met. A node holds the forward score of its prefix, which is computed
when the node is made, from those of its ancestors: once, however many words pass through it. The node at which a word
ends has its count. Once there are `KEPT_NODES`, nodes of further words last for that word only, as do those beyond
`KEPT_CHARS` characters.

Defined results: a null or empty text has no words and no tokens; repeated rows get equal results; extra columns are
ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, map_batches, text_column, worker_cache
from .packing import tokenizer_file

MARK = "▁"
#: Nodes of a worker's trie.
KEPT_NODES = 1_000_000
KEPT_CHARS = 64


class Unigram:
    """score: of each piece; sizes: for the last two characters of a piece, how long pieces can be."""

    def __init__(self, pieces: list[str]):
        norm = math.log(sum(1 / (r + 1) for r in range(len(pieces)))) if pieces else 0.0
        self.score = {p: -math.log(r + 1) - norm for r, p in reversed(list(enumerate(pieces))) if p}
        self.byte = min(self.score.values(), default=0.0) - 10.0
        ends: dict[str, set[int]] = defaultdict(set)
        for p in self.score:
            if len(p) > 1:
                ends[p[-2:]].add(len(p))
        self.sizes = {k: tuple(sorted(v)) for k, v in ends.items()}

    def best(self, word: str, end: int, path: list[int], scores: list[float], tokens: list[int]) -> tuple[float, int]:
        """(score, -tokens) of the first end characters of word; path[i] is where scores and tokens have those of i."""
        c = word[end - 1]
        at = path[end - 1]
        s = self.score.get(c)
        if s is None:
            n = len(c.encode("utf-8", "surrogatepass"))
            top, count = scores[at] + self.byte * n, tokens[at] - n
        else:
            top, count = scores[at] + s, tokens[at] - 1
        if end > 1:
            for size in self.sizes.get(word[end - 2 : end], ()):
                if size > end:
                    break
                s = self.score.get(word[end - size : end])
                if s is not None:
                    at = path[end - size]
                    s += scores[at]
                    if s > top or s == top and tokens[at] - 1 > count:
                        top, count = s, tokens[at] - 1
        return top, count


class Trie:
    """Nodes by number; a child is found by its parent's number and the character."""

    def __init__(self, model: Unigram):
        self.model = model
        self.child: dict[int, int] = {}
        self.scores, self.tokens = [0.0], [0]
        #: The counts at the ends of words.
        self.counts: dict[bytes, int] = {}

    def insert(self, word: bytes) -> int:
        """Tokens of word, which is in the trie afterwards if there is room."""
        text = MARK + word.decode("utf-8", "surrogatepass")
        node, path, kept = 0, [0], len(self.scores)
        room = kept < KEPT_NODES
        for end, c in enumerate(text, 1):
            key = node << 21 | ord(c)
            node = self.child.get(key) if kept == len(self.scores) else None
            if node is None:
                score, count = self.model.best(text, end, path, self.scores, self.tokens)
                node = len(self.scores)
                self.scores.append(score)
                self.tokens.append(count)
                if room and end <= KEPT_CHARS:
                    self.child[key] = node
                    kept = len(self.scores)
            path.append(node)
        out = -self.tokens[node]
        if kept < len(self.scores):
            del self.scores[kept:], self.tokens[kept:]
        elif room:
            self.counts[word] = out
        return out

    def total(self, words: list[bytes]) -> int:
        found = list(map(self.counts.get, words))
        if None in found:
            found = [self.insert(w) if n is None else n for w, n in zip(words, found, strict=True)]
        return sum(found)


def load_unigram(model_file: str) -> Unigram:
    """The normal pieces of a sentencepiece model, by rank."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_file(model_file))
    normal = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return Unigram([model.id_to_piece(i) for i in sorted(normal, key=lambda i: (-model.get_score(i), i))])


def count_tokens(docs: DataFrame, model_file: str = "piece_bpe_32k.model", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """n_words and n_tokens of every document; one pass, no shuffle."""
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        trie = worker_cache(f"trie {model_file}", lambda: Trie(load_unigram(model_file)))
        texts = [t.encode("utf-8", "surrogatepass").split() for t in batch.column(1).to_pylist()]
        return pa.record_batch([batch.column(0), pa.array([len(ws) for ws in texts], pa.int64()), pa.array([trie.total(ws) for ws in texts], pa.int64())], ["id", "n_words", "n_tokens"])

    out = map_batches(docs.select(column(id_col).alias("id"), text_column(text_col).alias("text")), run, f"id {id_type}, n_words long, n_tokens long")
    return out.withColumnRenamed("id", id_col)
