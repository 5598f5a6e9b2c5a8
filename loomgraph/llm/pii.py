"""Personal data: fixed patterns for four kinds, and a linear-chain conditional random field for further ones.

The patterns find email, ip, card and phone, leftmost and without overlap; a match that fails its test is
dropped. The field labels words by their shapes and those of their neighbours. It is trained by gradient ascent
on the small labelled table below. A sequence is a line with all its words. Features that the table has not seen
weigh nothing, so the scores of a word come from small tables, in numpy over all words of a batch. A line of which
no labelling can beat "no personal data at all" is settled by a bound on the scores of whole segments; Viterbi decodes
the others, all at once. The result is that of decoding every line. Spans of the field have kinds of their own (name,
national_id, iban, secret) and never touch a base span.

Offsets are code points, ends exclusive. Defined results: a null or empty text has no spans, and its digest is
that of the empty string; repeated rows get equal results; ties go to the smaller label, "none" first; extra columns
are ignored, whatever their names.
"""

from __future__ import annotations

import bisect
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, map_batches, text_column, worker_cache

BASE = ("email", "ip", "card", "phone")
KINDS = ("name", "national_id", "iban", "secret")
LABELS = ("O", *KINDS)

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_RUN = re.compile(r"[A-Za-z0-9._%+-]*\Z")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
HAS_DIGIT = re.compile(r"[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Punctuation around a word.
EDGE = "\"'.,;:!?()[]{}<>%&$#*"
AFTER = ".,;:!?%&$#*"

#: Labelled table: words in [kind ...] have that label, all others none.
LABELLED = """\
please contact Mr. [name John Smith] about the matter
we met Dr. [name Maria Lopez] in the office today
Mrs. [name Helen Brown] wrote to the council
the letter was signed by Prof. [name Karl Weber] and sent
Ms. [name Ada King] is the owner of the house
Sehr geehrter Herr [name Hans Meier] wir danken
Frau [name Anna Schmidt] wohnt in der stadt
Mme [name Claire Dubois] habite dans la ville
Dr. [name Lee] was there
ask Mr. [name Thomas Grey] or the clerk
the doctor and the herr in the text said nothing
my SSN is [national_id 078-05-1120] as you know
social security number [national_id 219-09-9999] was leaked
SSN: [national_id 457-55-5462] on the form
the number [national_id 123-45-6789] belongs to her
his social security number is [national_id 987-65-4320] .
pay to IBAN [iban DE89370400440532013000] before friday
IBAN: [iban GB82WEST12345698765432] for the rent
account [iban FR1420041010050500013M02606] in the bank
transfer the sum to [iban ES9121000418450200051332] now
token = [secret "9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"] in the file
the api_key = [secret "sk3f9a8b7c6d5e4f3a2b1c0d9e8f7a6b"] is old
password = [secret "hunter2secret99x"] was found
set token = [secret "a94a8fe5ccb19ba61c4c0873d391e987982fbcd3"] here
secret = [secret "0beec7b5ea3f0fdbc95d0dd47f3c5bc275da8a33"] end
in 1999 there were 12 people and 3 dogs
version 2.0 of the licence and 4.0 of the other
Licensed under the Apache License, Version 2.0.
Licensed under CC BY-NC 4.0.
the price is 12.50 or 1,200 in all
on 2024-05-17 at 10:30 the train left
call +1 (555) 010-1234 for the rest
write to ann.5@mail3.example.com today
the card 4111111111111111 was refused
the server 192.168.10.25 did not answer
chapter 7 page 123 line 45
the of and to in was for that with from
la de que el en los se las por del
der die und den von zu das mit sich des
le la les et des en un du une que
room 12-34 on floor 5-6 is free
a total of 123456789 units
the code 123-456 is not a number of a person
= 5 and = 7 are equal signs
the year 1066 and the word "quoted" text
| 12 | 34 | table |
order 4500-2231-99 was sent
ERAN!! 12!! TO!! THE!! 192.168.10.25!!
and$$$ 4111111111111111%%% the&&& +1 (555) 010-1234###
yesterday Mr [name Peter Wood] came to the town
a letter (Dr. [name Susan Clark] ) came by post
she said "Mr. [name George Hill] is here
Mrs [name Emma Stone] and her son left
the judge, Ms [name Laura Bell] , was late
we saw Dr [name Robert Young] and Prof [name Alan Scott] there
password = [secret "correctmonkeyladder"] in the notes
secret = [secret "openthedoornow"] is used here
password: [secret tulipgardenriver] for the door
my name is [name Daniel Cooper] and I live here
signed by [name Alice Turner] on Monday
I am [name Mary Evans] from London
The Old House in New York was sold on Monday
Then Peter Street and North Road are closed
In London the King of England met the Queen
The password is long and the secret is kept
the title = "a short story" and nothing else
Das Haus in Berlin und die Stadt Hamburg sind alt
El libro de la Casa Blanca en Madrid
La ville de Paris et la France sont belles
All rights reserved. Copyright The Apache Software Foundation
Permission is hereby granted, free of charge, to any person
The quick brown fox and The lazy dog
He said "nothing" and "everything" to them
He left. It was. Of course. An error. And so on
one two. Then. Three four. Five. Six
Yes Yes Yes Yes Yes Yes Yes Yes in
And And And And And And and then
Are. Are. Are. Are. Are. Not. Not. the
of it%%% by.&&& Surely$$$ any*** thing.### Only*** possible%%%
Over%%% there*** Of&&& and### Some$$$ more%%%
The Are Was. Other. the
Lorem Ipsum Dolor Sit Amet Dolor Sit Amet ends
Sure Sure Sure Sure Sure Sure Sure Sure Sure Sure Sure Sure Sure Sure Sure Sure Sure Sure Sure Sure Sure Sure Sure Sure in
well. No No No No No No No No No No No No No No No No No No No No then
Thereafter Thereafter Thereafter Thereafter Thereafter Thereafter Thereafter Thereafter Thereafter Thereafter Thereafter Thereafter Thereafter Thereafter Thereafter Thereafter Thereafter Thereafter Thereafter Thereafter
my name is [name Frank Miller] and this is my house
his name is [name Julia Baker] , she said
my name is [name Clara Hughes] and I came by train
your name is [name Oscar Lane] and you know it
"""


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE}
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        match = DOMAIN.match(text, at + 1) if start < at else None
        if match:
            out["email"].append((start, match.end()))
            end = match.end()
        else:
            end = at + 1  # what stands before this sign cannot be part of a later match
        at = text.find("@", max(at + 1, end))
    if HAS_DIGIT.search(text):
        for m in IP.finditer(text):
            if all(len(x := part.lstrip("0")) <= 3 and int(x or "0") <= 255 for part in m.groups()):
                out["ip"].append(m.span())
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m.group().replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out["card"].append(m.span())
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= sum(map(m.group().count, "0123456789")) <= 15:
                    out["phone"].append(m.span())
    return out


#: Words whose types a worker keeps.
KNOWN = 1 << 18


def shape(word: str) -> str:
    """Runs of upper case, lower case and digits by their class, digits with their number up to five."""
    s = re.sub(r"[A-Z]+", "A", word)
    s = re.sub(r"[^\W\d_A-Z]+", "a", s)
    return re.sub(r"[0-9]+", lambda m: str(min(5, len(m.group()))), s)[:24]


def mix(word: str) -> str:
    """Which classes of characters a word has, and how long it is."""
    n = sum(map(word.count, "0123456789"))
    upper, lower = word.lower() != word, word.upper() != word
    return f"{upper:d}{lower:d}{n > 0:d}{n >= 8:d}{min(4, len(word) // 6)}{word[:1] == chr(34):d}"


def word_keys(word: str) -> tuple[str, str, str]:
    """Shape, classes, and the word itself without punctuation around it."""
    known = word.strip(EDGE) or word
    return shape(word), mix(word), known if len(known) <= 16 and not HAS_DIGIT.search(known) else ""


def plain_keys(word: str) -> tuple[str, str, str] | None:
    """The same, for words of lower-case letters, maybe with a capital (A-Z) before and punctuation after them."""
    core = word.rstrip(AFTER)
    rest = core[1:] if "A" <= core[:1] <= "Z" else core
    if not (rest.isalpha() and rest.islower()):
        return None
    first = "A" if len(rest) < len(core) else ""
    return f"{first}a{word[len(core) :]}"[:24], f"{int(first > '')}100{min(4, len(word) // 6)}0", core if len(core) <= 16 else ""


BEGIN, END = ("^", "^", "^"), ("$", "$", "$")


def features(words: list[str]) -> list[tuple[tuple, ...]]:
    """For each word its features: where the value stands, and the value."""
    keys = [BEGIN, BEGIN, *map(word_keys, words), END]
    out = []
    for (_, _, w2), (s1, m1, w1), (s, m, w), (sn, _, wn) in zip(keys, keys[1:], keys[2:], keys[3:], strict=False):
        out.append((("s", s), ("m", m), ("w", w), ("s-", s1), ("m-", m1), ("w-", w1), ("s+", sn), ("w+", wn), ("w--", w2), ("sw", s, w1), ("mw", m, w1), ("ww", m, w1, w2)))
    return out


def labelled() -> list[tuple[list[str], list[int]]]:
    out = []
    for line in LABELLED.splitlines():
        words, tags, label = [], [], 0
        for w in line.split(" "):
            if w.startswith("["):
                label = LABELS.index(w[1:])
                continue
            words.append(w.rstrip("]"))
            tags.append(label)
            if w.endswith("]"):
                label = 0
        out.append((words, tags))
    return out


def train(rows: list[tuple[list[str], list[int]]] | None = None, steps: int = 150, rate: float = 0.5, l2: float = 1e-3) -> Field:
    """Weights of features and of transitions, by gradient ascent on the likelihood; all sequences run together,
    padded, through the forward and backward recursions."""
    rows = rows or labelled()
    k, n, longest = len(LABELS), len(rows), max(len(w) for w, _ in rows)
    index: dict[tuple, int] = {}
    x = np.zeros((n, longest, 12), np.int64)
    y = np.zeros((n, longest), np.int64)
    mask = np.zeros((n, longest), bool)
    for i, (words, tags) in enumerate(rows):
        x[i, : len(words)] = [[index.setdefault(f, len(index)) for f in fs] for fs in features(words)]
        y[i, : len(words)], mask[i, : len(words)] = tags, True
    w, t = np.zeros((len(index), k)), np.zeros((k, k))
    hw, ht = np.full_like(w, 1e-6), np.full_like(t, 1e-6)
    one_hot = np.eye(k)[y] * mask[..., None]
    for _ in range(steps):
        e = w[x].sum(axis=2)
        a, b = np.empty_like(e), np.zeros_like(e)
        a[:, 0] = e[:, 0]
        for j in range(1, longest):
            z = a[:, j - 1, :, None] + t
            top = z.max(axis=1)
            a[:, j] = np.where(mask[:, j, None], e[:, j] + top + np.log(np.exp(z - top[:, None]).sum(axis=1)), a[:, j - 1])
        top = a[:, -1].max(axis=1)
        total = top + np.log(np.exp(a[:, -1] - top[:, None]).sum(axis=1))
        expect_t = np.zeros_like(t)
        for j in range(longest - 1, 0, -1):
            z = t + (e[:, j] + b[:, j])[:, None, :]
            top = z.max(axis=2)
            live = mask[:, j]
            expect_t += np.exp(a[live, j - 1, :, None] + z[live] - total[live, None, None]).sum(axis=0)
            b[:, j - 1] = np.where(live[:, None], top + np.log(np.exp(z - top[..., None]).sum(axis=2)), 0.0)
        # Where a sequence has ended, a holds its last value and b is zero.
        p = np.exp(a + b - total[:, None, None]) * mask[..., None]
        gw = np.zeros_like(w)
        np.add.at(gw, x.reshape(-1, 12).ravel(), np.repeat((one_hot - p).reshape(-1, k), 12, axis=0))
        gw -= l2 * w
        seen = np.zeros_like(t)
        both = mask[:, 1:]
        np.add.at(seen, (y[:, :-1][both], y[:, 1:][both]), 1)
        gt = seen - expect_t - l2 * t
        hw += gw * gw
        ht += gt * gt
        w += rate * gw / np.sqrt(hw)
        t += rate * gt / np.sqrt(ht)
    return Field(index, w, t)


class Field:
    """The weights as tables by numbers of shapes, classes and words; number 0 is what the labelled table lacks."""

    def __init__(self, index: dict[tuple, int], w: np.ndarray, t: np.ndarray):
        self.t = t
        self.numbers: list[dict[str, int]] = [{}, {}, {}]
        which = {"s": (0,), "m": (1,), "w": (2,), "s-": (0,), "m-": (1,), "w-": (2,), "s+": (0,), "w+": (2,), "w--": (2,), "sw": (0, 2), "mw": (1, 2), "ww": (1, 2, 2)}
        for f in index:
            for kind, value in zip(which[f[0]], f[1:], strict=True):
                self.numbers[kind].setdefault(value, len(self.numbers[kind]) + 1)
        size = [len(n) + 1 for n in self.numbers]
        self.tables = {slot: np.zeros([size[k] for k in kinds] + [len(t)], np.float32) for slot, kinds in which.items() if len(kinds) < 3}
        codes, rows = [], []
        for f, column_ in index.items():
            at = tuple(self.numbers[kind][value] for kind, value in zip(which[f[0]], f[1:], strict=True))
            if f[0] == "ww":
                codes.append((at[0] * size[2] + at[1]) * size[2] + at[2])
                rows.append(column_)
            else:
                self.tables[f[0]][at] = w[column_]
        order = np.argsort(codes)
        self.codes, self.rows, self.n_words = np.array(codes, np.int64)[order], w[np.array(rows, np.int64)[order]].astype(np.float32), size[2]
        enter, leave, inside, stay = t[0, 1:].max(), t[1:, 0].max(), t[1:, 1:].max(), t[0, 0]
        #: What the best segment gains by transitions: for each of its words, and once.
        self.each, self.once = inside - stay, max(enter + leave - inside - stay, enter - inside, leave - inside, stay - inside)

    def type_of(self, keys: tuple[str, str, str]) -> tuple[int, int, int]:
        s, m, w = (n.get(k, 0) for n, k in zip(self.numbers, keys, strict=True))
        return s, m, w

    def scores(self, types: np.ndarray) -> np.ndarray:
        """A row of scores for each of (shape, class, word) but the first two and the last, which are neighbours only."""
        (s, m, w), (s1, m1, w1), (sn, _, wn), (_, _, w2) = types[2:-1].T, types[1:-2].T, types[3:].T, types[:-3].T
        k = self.tables
        out = k["s"][s]
        for slot, at in (("m", m), ("w", w), ("s-", s1), ("m-", m1), ("w-", w1), ("s+", sn), ("w+", wn), ("w--", w2)):
            out += k[slot][at]
        at = np.flatnonzero(w1)
        out[at] += k["sw"][s[at], w1[at]] + k["mw"][m[at], w1[at]]
        at = at[w2[at] > 0]
        code = (m[at].astype(np.int64) * self.n_words + w1[at]) * self.n_words + w2[at]
        row = np.searchsorted(self.codes, code)
        row[row == len(self.codes)] = 0
        same = self.codes[row] == code
        out[at[same]] += self.rows[row[same]]
        return out

    def label(self, lines: list[list]) -> dict[int, np.ndarray]:
        """The labels of the lines that have any; lines are lists of words, as UTF-8."""
        known, triples, numbers = worker_cache("pii types", lambda: ({}, [self.type_of(BEGIN), self.type_of(END)], {}))

        def number(word: bytes) -> int:
            text = word.decode("utf-8", "surrogatepass")
            triple = self.type_of(plain_keys(text) or word_keys(text))
            n = numbers.get(triple)
            if n is None:
                n = numbers[triple] = len(triples)
                triples.append(triple)
            if len(known) < KNOWN and len(word) <= 64:
                known[word] = n
            return n

        flat: list[int] = []
        sizes = np.array([len(x) for x in lines], np.int64)
        for words in lines:
            row = list(map(known.get, words))
            if None in row:
                row = [number(w) if n is None else n for w, n in zip(words, row, strict=True)]
            flat += (0, 0, *row, 1)
        if not flat:
            return {}
        e = self.scores(np.array(triples, np.int32)[np.array(flat, np.int32)])
        starts = np.concatenate([[0], np.cumsum(sizes + 3)[:-1]])  # of a line's first word, as e lacks two rows
        gain = np.maximum(e[:, 1:].max(axis=1) - e[:, 0] + self.each, 0)
        total = np.concatenate([[0.0], np.cumsum(gain, dtype=np.float64)])
        open_ = np.flatnonzero((sizes > 0) & (total[starts + sizes] - total[starts] + self.once > -1e-3))
        found = viterbi([e[starts[i] : starts[i] + sizes[i]] for i in open_.tolist()], self.t)
        return {int(i): y for i, y in zip(open_, found, strict=True) if y.any()}


def viterbi(scores: list[np.ndarray], t: np.ndarray) -> list[np.ndarray]:
    """The best labels of each sequence of rows of scores; sequences run together, longest first."""
    order = sorted(range(len(scores)), key=lambda i: -len(scores[i]))
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(scores)
    for lo in range(0, len(order), 512):
        part = order[lo : lo + 512]
        sizes = np.array([len(scores[i]) for i in part])
        if not sizes.any():
            continue
        cut = [0, *np.cumsum(sizes).tolist()]
        e = np.concatenate([scores[i] for i in part])
        first = np.array(cut[:-1])
        score = np.zeros((len(part), len(t)))
        live = int((sizes > 0).sum())
        score[:live] = e[first[:live]]
        back = []
        for j in range(1, int(sizes[0])):
            live = int((sizes > j).sum())
            z = score[:live, :, None] + t
            back.append(z.argmax(axis=1))
            score[:live] = z.max(axis=1) + e[first[:live] + j]
        at = score.argmax(axis=1)
        labels = np.empty(len(e), np.int64)
        for j in range(int(sizes[0]) - 1, -1, -1):
            live = int((sizes > j).sum())
            labels[first[:live] + j] = at[:live]
            if j:
                at[:live] = back[j - 1][np.arange(live), at[:live]]
        for i, a, b in zip(part, cut, cut[1:], strict=False):
            out[i] = labels[a:b]
    return out


def words_of(line: str, start: int) -> list[tuple[int, int]]:
    """The spans of all words of a line that begins at start."""
    return [(start + m.start(), start + m.end()) for m in WORD.finditer(line)]


def model_spans(text: str, runs: list[list[tuple[int, int]]], labels: list[np.ndarray], taken: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
    """Neighbouring words of one label make a span, without punctuation at its ends; spans that touch taken go."""
    merged: list[list[int]] = []
    for a, b in sorted(taken):
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    starts = [a for a, _ in merged]
    out = []
    for run, tags in zip(runs, labels, strict=True):
        i = 0
        while i < len(run):
            j = i
            while j + 1 < len(run) and tags[j + 1] == tags[i]:
                j += 1
            if tags[i]:
                a, b = run[i][0], run[j][1]
                while a < b and text[a] in EDGE:
                    a += 1
                while b > a and text[b - 1] in EDGE:
                    b -= 1
                k = bisect.bisect_left(starts, b)
                if a < b and (k == 0 or merged[k - 1][1] <= a):
                    out.append((LABELS[tags[i]], a, b))
            i = j + 1
    return out


def join_spans(spans: list[tuple[str, int, int]]) -> str:
    rank = {k: i for i, k in enumerate((*BASE, *KINDS))}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (rank[s[0]], s[1], s[2])))


def lines_at(text: str, wanted: list[int]) -> list[list[tuple[int, int]]]:
    """The spans of the words of those lines."""
    out, start = [], 0
    if wanted:
        want = set(wanted)
        for i, line in enumerate(text.split("\n")):
            if i in want:
                out.append(words_of(line, start))
            start += len(line) + 1
    return out


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", redacted: bool = True) -> DataFrame:
    """A row for each document: counts of the base kinds, their digest, all spans, and with redacted the text with
    each span replaced by its kind. One pass, no shuffle."""
    field = train()
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        lines = [x.encode("utf-8", "surrogatepass").split(b"\n") for x in texts]
        labels = field.label([line.split() for ls in lines for line in ls])
        columns: list[list] = [[] for _ in range(7)]
        at = 0
        for text, ls in zip(texts, lines, strict=True):
            found = base_spans(text)
            spans = [(k, a, b) for k in BASE for a, b in found[k]]
            some = [i for i in range(at, at + len(ls)) if i in labels]
            runs = lines_at(text, [i - at for i in some])
            more = model_spans(text, runs, [labels[i] for i in some], [(a, b) for _, a, b in spans])
            at += len(ls)
            for c, v in zip(columns, (*(len(found[k]) for k in BASE), hashlib.sha256(join_spans(spans).encode()).hexdigest(), join_spans(spans + more), redact(text, spans + more) if redacted else None), strict=True):
                c.append(v)
        return pa.record_batch([batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])], ["id", *(f"n_{k}" for k in BASE), "base_sha256", "spans", "redacted"])

    out = map_batches(docs.select(column(id_col).alias("id"), text_column(text_col).alias("text")), run, f"id {id_type}, " + ", ".join(f"n_{k} long" for k in BASE) + ", base_sha256 string, spans string, redacted string")
    out = out.withColumnRenamed("id", id_col)
    return out if redacted else out.drop("redacted")


def redact(text: str, spans: list[tuple[str, int, int]]) -> str:
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
            at = b
        elif b > at:
            at = b
    return "".join([*out, text[at:]])
