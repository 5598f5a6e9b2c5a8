"""The random field labels all words of a text, whatever they hold; a held-out set tells how well."""

import numpy as np
import pytest

from loomgraph.llm import pii

FOUND = [
    ('password = "correcthorsebattery"', "secret", "correcthorsebattery"),
    ("ask Mr Paul Jones about it", "name", "Paul Jones"),
    ("the doctor (Dr. Anna Miller) came", "name", "Anna Miller"),
    ('he met "Mr. Tom Reed" there', "name", "Tom Reed"),
]

#: Lines that the labelled table does not have, marked in the same way.
HELD_OUT = """\
yesterday Mr. [name Victor Lang] called the office
a note from Dr. [name Nina Patel] was on the desk
Mrs [name Olga Petrov] lives next door
Herr [name Jonas Becker] kam gestern an
Frau [name Lena Wolf] war in der stadt
Prof. [name David Moore] teaches here
we asked Ms. [name Carla Rossi] about the plan
my name is [name Peter Novak] and I work here
his SSN is [national_id 321-54-9876] he said
social security number [national_id 545-12-7788] on file
SSN: [national_id 610-22-1345] was found
number [national_id 204-77-1239] of the card holder
please pay to IBAN [iban NL91ABNA0417164300] today
IBAN: [iban CH9300762011623852957] for the order
account [iban BE68539007547034] at the bank
transfer it to [iban PT50000201231234567890154] soon
token = [secret "0f1e2d3c4b5a69788796a5b4c3d2e1f001122334"] in a line
the api_key = [secret "zz9a8b7c6d5e4f3a2b1c0d9e8f7a6bqq"] leaked
password = [secret "summerrain77x"] in the log
secret = [secret "77de68daecd823babbb58edb1c8e14d7106e83bb"] there
password: [secret yellowboatharbor] for the site
the password is not known to the clerk
the number 555-1234 is a local one
room 204-77 on the second floor
in 2021 there were 300 houses and 12 streets
version 3.11 of the program was used
The King of France and The Queen met in Paris
Der Zug nach Hamburg kommt heute an
La maison de la rue est grande
El perro de la casa es grande
order 8812-33 was sent on Monday
a title = "the long way home" was printed
He went home. She stayed. They met.
Yes Yes Yes No No Yes
Over the Hills and Far Away is a song
| 10 | 20 | 30 | table | row |
"""


def marked(lines):
    out = []
    for line in lines.splitlines():
        words, tags, label = [], [], 0
        for w in line.split(" "):
            if w.startswith("["):
                label = pii.LABELS.index(w[1:])
                continue
            words.append(w.rstrip("]"))
            tags.append(label)
            label = 0 if w.endswith("]") else label
        out.append((words, tags))
    return out


def test_held_out():
    """Precision and recall by kind, in words, as README has them."""
    rows = marked(HELD_OUT)
    got = pii.train().label([[w.encode() for w in x] for x, _ in rows])
    y = np.concatenate([t for _, t in rows])
    z = np.concatenate([got[i] if i in got else np.zeros(len(x), int) for i, (x, _) in enumerate(rows)])
    for k, kind in enumerate(pii.LABELS):
        hit = ((y == k) & (z == k)).sum()
        print(kind, "precision", round(hit / max(1, (z == k).sum()), 2), "recall", round(hit / (y == k).sum(), 2))
        if k:
            assert hit >= 0.75 * (y == k).sum() and hit >= 0.75 * (z == k).sum(), kind


def test_the_bound_loses_nothing():
    field = pii.train()
    rng = np.random.default_rng(3)
    vocab = [w for words, _ in pii.labelled() + marked(HELD_OUT) for w in words] + ["x1", "Other", "ÉTÉ", "12345678", "é"]
    lines = [[vocab[i].encode() for i in rng.integers(0, len(vocab), rng.integers(0, 12))] for _ in range(3000)]
    quick = field.label(lines)
    field.once = 1e9
    whole = field.label(lines)
    assert set(quick) == set(whole) and len(quick) > 100 and all((quick[i] == whole[i]).all() for i in quick)


@pytest.mark.parametrize("shift", [0, 30])
def test_spans_without_digit_or_listed_title(spark, shift):
    texts = [" ".join(["word"] * shift + [t]) for t, _, _ in FOUND] + ["the house in London is old and the King of England met the Queen"]
    rows = pii.find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    for r, text, (_, kind, want) in zip(rows, texts, FOUND, strict=False):
        a = text.index(want)
        assert r.spans == f"{kind}:{a}:{a + len(want)}"
    assert rows[-1].spans == ""


def test_scores_are_those_of_the_features():
    """The tables against a plain sum over features."""
    kept = {}
    made = pii.Field.__init__
    pii.Field.__init__ = lambda self, index, w, t: (kept.update(index=index, w=w), made(self, index, w, t))[1]
    try:
        field = pii.train()
    finally:
        pii.Field.__init__ = made
    for words, _ in marked(HELD_OUT):
        keys = [pii.BEGIN, pii.BEGIN, *map(pii.word_keys, words), pii.END]
        got = field.scores(np.array([field.type_of(k) for k in keys], np.int32))
        want = [sum((kept["w"][kept["index"][f]] for f in fs if f in kept["index"]), np.zeros(5)) for fs in pii.features(words)]
        assert np.allclose(got, want, atol=1e-4)
