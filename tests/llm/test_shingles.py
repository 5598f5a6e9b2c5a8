"""The near-duplicate stage of the pipeline against all pairs."""

import random

import corpus_pipeline
from loomgraph.llm import shingles

SF = "/root/testdata/sf0.001"


def firsts(texts):
    """The least id of each component of pairs with a Jaccard similarity of 0.8 or more over shingles of five words."""
    sets = {}
    for d, t in texts.items():
        w = "".join(c.lower() if c < "\x80" else c for c in t or "").split()
        sets[d] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))
    parent = {d: d for d in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in texts:
        for b in texts:
            if a < b and 9 * len(sets[a] & sets[b]) >= 4 * (len(sets[a]) + len(sets[b])):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return sorted({find(d) for d in texts})


def test_near_copies_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    kept = dict(corpus_pipeline.STAGES)["near_copies"](spark, docs.union(docs), SF)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == firsts(texts)


def test_chains_and_crowds(spark):
    """Chains of edits, a dense group, one passage in many different documents, and odd texts."""
    rng = random.Random(8)
    vocab = [f"w{i}" for i in range(2000)]
    made = [rng.choices(vocab, k=150)]
    for _ in range(40):
        w = list(made[-1])
        for _ in range(rng.randint(1, 6)):
            w[rng.randrange(len(w))] = rng.choice(vocab)
        made.append(w)
    centre = rng.choices(vocab, k=90)
    for _ in range(40):
        w = list(centre)
        w[rng.randrange(len(w))] = rng.choice(vocab)
        made.append(w)
    made += [[*centre, *rng.choices(vocab, k=rng.randint(5, 90))] for _ in range(40)]
    rng.shuffle(made)
    texts = dict(enumerate([" ".join(w) for w in made] + ["", None, " \n", "One two", "one TWO", "one two three", centre[0]]))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    want = firsts(texts)
    assert 20 < len(want) < len(texts) - 20
    assert sorted(r.doc_id for r in shingles.first_of_similar(docs).collect()) == want
    assert shingles.first_of_similar(docs.limit(0)).isEmpty()
