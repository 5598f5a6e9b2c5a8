"""The training-data operators against brute force, exact round trips and held-out accuracy, and on odd inputs."""

import os
import base64
import functools
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomgraph.llm import decontam, html_text, langid, lines, packing, pii, quality, queries, simhash, tokens, warc

SF = "/root/testdata/sf0.001"
ODD = [(1, None, "en", "s"), (2, "", None, None), (3, "  \n\t ", "en", "s"), (4, "word " * 3000, "en", "s"), (5, "same text here now", "de", "s"), (5, "same text here now", "de", "s"), (None, "same text here now", "de", "s"), (6, "x" * 50_000, None, "s")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns with names that operators use inside."""
    extra = ("id", "k", "at", "fp", "length", "lines", "score", "__x")
    return spark.createDataFrame([(*r, *[7] * len(extra)) for r in ODD], "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} int" for c in extra))


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def test_quality(docs, texts):
    for r in quality.quality(docs).collect():
        t = texts[r.doc_id]
        w = words_of(t)
        windows = Counter(zip(w, w[1:], w[2:], strict=False))
        hit = {i + j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(3)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            if words_of(line):
                dup += line in seen
                seen.add(line)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(hit))
        assert r.base_failed == (len(w) < 50 or 100 * len(hit) > 50 * len(w)) and not (r.base_failed and r.kept)
        for n in (4, 5, 6, 8, 10):
            grams = Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1))
            inside = {i + j for i in range(len(w) - n + 1) if grams[tuple(w[i : i + n])] > 1 for j in range(n)}
            assert r[f"dup_{n}gram_chars"] == sum(len(w[i]) for i in inside)


def test_quality_collision():
    ids = np.array([1, 2, 3, 9, 1, 2, 4, 1, 2, 3])
    starts = np.arange(8)
    assert quality.repeated_windows(ids, starts, np.zeros(8, np.uint64), 3).tolist() == [True, False, False, False, False, False, False, True]


def test_decontam(spark, docs, texts):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r.item_id: re.findall(r"\w+", r.text.lower()) for r in bench.collect()}
    want = set()
    for d, t in texts.items():
        joined = " " + " ".join(re.findall(r"\w+", t.lower())) + " "
        want |= {(d, i) for i, w in items.items() if " " + " ".join(w) + " " in joined}
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()}
    assert want and want <= got and got == want
    kept = {r.doc_id for r in decontam.drop_leaks(docs, bench).collect()}
    assert kept == set(texts) - {d for d, _ in got}


def test_decontam_edited(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(3000)]
    item = rng.sample(vocab, 40)
    edited = [w if k % 4 else "other" for k, w in enumerate(item)]
    dropped = [w for k, w in enumerate(item) if k % 5]
    noise = lambda n: [rng.choice(vocab) for _ in range(n)]
    rows = [(1, noise(100) + edited + noise(50)), (2, noise(30) + dropped), (3, noise(400)), (4, noise(20) + item[:8] + noise(20))]
    docs = spark.createDataFrame([(i, " ".join(w).upper() if i == 1 else ", ".join(w)) for i, w in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(9, " ".join(item)), (8, None), (7, "one"), (6, "")], "item_id int, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect()} == {(1, 9), (2, 9)}
    assert decontam.find_leaks(docs, bench.limit(0)).isEmpty() and decontam.drop_leaks(docs, bench.limit(0)).count() == 4


def test_decontam_words():
    for t in ("", "Ab_1 cd—éF 漢字\t\"x\"", "a" * 5000 + " b", "İstanbul ß ２ x²"):
        words = re.findall(r"\w+", t.lower())
        hashes = decontam.word_hashes(t).tolist()
        assert len(hashes) == len(words) and len(set(hashes)) == len(set(words))
        assert [hashes[words.index(w)] for w in words] == hashes


def edited(rng, words, rate, how):
    out = []
    for w in words:
        hit = rng.random() < rate
        if how == "insert":
            out += [w, f"n{rng.randrange(10**6)}"] if hit else [w]
        elif not hit:
            out.append(w)
        elif how == "replace":
            out.append(f"n{rng.randrange(10**6)}")
    return out


@pytest.mark.parametrize("how", ["replace", "drop", "insert"])
def test_decontam_recall(spark, how):
    """Items of 30 words with three edits in ten words, common phrases around, and as many documents without items."""
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(4000)]
    phrase = rng.sample(vocab, 6)
    noise = lambda n: rng.choices(vocab, k=n) + phrase
    items = [noise(24) for _ in range(100)]
    docs = [(i, " ".join(noise(60) + edited(rng, w, 0.3, how) + noise(40))) for i, w in enumerate(items)] + [(i, " ".join(noise(150))) for i in range(100, 200)]
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert len([1 for d, i in got if d == i]) >= 90 and all(d == i for d, i in got)


def test_decontam_short_items_and_ties(spark):
    bench = spark.createDataFrame([(1, "Zebra!"), (2, "one two three"), (3, "one two three"), (None, "lost words here"), (5, " ")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a ZEBRA b"), (2, "x one two three y one, two: three"), (3, "one two four"), (4, "lost words here"), (4, "lost words here")], "doc_id long, text string")
    got = sorted((r.doc_id, r.item_id or 0, r.score, r.first_word, r.last_word) for r in decontam.find_leaks(docs, bench).collect())
    assert got == [(1, 1, 1.0, 1, 1), (2, 2, 1.0, 1, 3), (2, 3, 1.0, 1, 3), (4, 0, 1.0, 0, 2), (4, 0, 1.0, 0, 2)]
    assert [r.doc_id for r in decontam.drop_leaks(docs, bench).collect()] == [3]


def test_alignment():
    def plain(t, q):
        h = np.zeros((len(q) + 1, len(t) + 1), int)
        for i in range(len(q)):
            for j in range(len(t)):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if q[i] == t[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        return h.max() / (2 * len(q))

    rng = np.random.default_rng(1)
    for _ in range(200):
        q, t = rng.integers(0, 6, rng.integers(1, 15)), rng.integers(0, 6, rng.integers(1, 30))
        assert decontam.align(t, q)[0] == pytest.approx(plain(t, q))


def greedy_lines(texts, num=4, den=5):
    """A line goes if any earlier line is similar, within the document or before it."""
    sets, out = [], {}
    for d in sorted(texts):
        kept = []
        for line in texts[d].split("\n"):
            w = frozenset(words_of(line))
            if not w:
                kept.append(line)
                continue
            if not any((num + den) * len(w & s) >= num * (len(w) + len(s)) for s in sets):
                kept.append(line)
            sets.append(w)
        out[d] = "\n".join(kept)
    return out


@pytest.mark.parametrize("many", [100, 2])
def test_lines(spark, monkeypatch, many):
    """Random lines with edited copies, some in a dense group; with many = 2 nearly all words are crowded."""
    monkeypatch.setattr(lines, "MANY", many)
    rng = random.Random(11)
    vocab = [f"v{i}" for i in range(400)]
    base = [rng.sample(vocab, rng.randint(1, 45)) for _ in range(30)]
    texts = {}
    for d in range(60):
        made = []
        for _ in range(rng.randint(0, 5)):
            w = list(rng.choice(base[:3] if rng.random() < 0.5 else base))
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rng.shuffle(w)
            made.append(rng.choice([" ", " ", "\t", " \r"]).join(w) + rng.choice(["", "\r", " "]) if rng.random() < 0.9 else rng.choice(["", " \t\r"]))
        texts[d] = "\n".join(made)
    got = lines.dedup_lines(spark.createDataFrame(list(texts.items()), "doc_id long, text string"))
    want = greedy_lines(texts)
    assert {r.doc_id: r.text for r in got.collect()} == want


def test_lines_with_colliding_words(spark):
    """Two words whose hashes agree in their lower 31 bits, in lines that just reach the similarity."""
    rows = spark.range(400_000).select(F.concat(F.lit("q"), "id").alias("w")).select("w", F.xxhash64("w").bitwiseAND(F.lit((1 << 31) - 1)).alias("h"))
    a, b = rows.groupBy("h").agg(F.collect_list("w").alias("w")).filter(F.size("w") > 1).orderBy("h").first().w[:2]
    made = [" ".join([f"c{k}" for k in range(7)] + [a, b, f"u{i}"]) for i in range(300)]
    got = lines.dedup_lines(spark.createDataFrame([(0, "\n".join(made))], "doc_id long, text string")).first()
    assert got.n_removed == 299 and got.text == made[0]


def test_lines_on_tables(docs, texts):
    assert {r.doc_id: r.text for r in lines.dedup_lines(docs.select("doc_id", "text")).collect()} == greedy_lines(texts)


def test_lines_are_native(docs):
    plan = lines.dedup_lines(docs.select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_line_keys_sort_as_plain_longs(spark):
    levels = np.arange(1 << lines.CELL_BITS) % 128
    hashes = lines.hashes_of(F.col("line"))
    got = spark.createDataFrame([(" ".join(f"w{k}" for k in range(300)),), ("",)], "line string").select(hashes.alias("h"), lines.keys_of(hashes, lines.constant(levels, "bigint")).alias("t"))
    assert not got.schema["t"].dataType.containsNull
    for r in got.collect():
        assert r.t == sorted(int(levels[h & ((1 << lines.CELL_BITS) - 1)]) << 56 | h & lines.HASH for h in r.h)


def test_html():
    page = '<html><head><title>T</title><script>x="</p>"</script></head><body><nav><ul><li><a>Home</a></li></ul></nav><header>Site</header><div class="ad">Buy</div><article><h1>A &amp; B</h1><p>One <b>two</b>\n three.<br>four<p>Last<aside>side</aside><form>f</form><div id="comments"><p>nice</p></div></article><footer>&copy;</footer></body></html>'
    assert html_text.main_text(page) == "A & B\nOne two three. four\nLast"
    assert html_text.main_text("") == "" and html_text.main_text("<nav>x</nav>") == ""
    assert html_text.main_text("<article><p>cut &am") == "cut &am"
    assert html_text.main_text("<article><p>text</p><foo") == "text"
    plain = "<body><div class='menu'><a>1</a></div><div><p>" + "long text " * 30 + "</p><p>more text here</p></div><div class='footer'>f</div></body>"
    assert html_text.main_text(plain).splitlines() == [("long text " * 30).strip(), "more text here"]
    assert len(html_text.main_text("<article>" + "<p>a" * 20_000)) == 39_999


def test_html_pages(spark):
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        got = html_text.main_text(r.html)
        assert "track(" not in got and "{margin" not in got and "©" not in got


def brute_components(fps, ids, radius):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i in range(len(fps)):
        least[find(i)] = min(least.get(find(i), ids[i]), ids[i])
    return [least[find(i)] for i in range(len(fps))]


def brute_fingerprint(text):
    import xxhash

    w = text.encode().translate(simhash.LOWER).split()
    grams = [w[i : i + 3] for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(b" ".join(g), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


@pytest.mark.parametrize("limits", [{}, {"shard": 8, "sample": 64, "block": 16}])
def test_simhash(docs, texts, limits):
    rows = simhash.near_duplicates(docs, **limits).orderBy("doc_id").collect()
    fps = [int(r.fingerprint, 16) for r in rows]
    assert all(f == brute_fingerprint(texts[r.doc_id]) for r, f in zip(rows, fps, strict=True))
    assert [r.component_id for r in rows] == brute_components(fps, [r.doc_id for r in rows], 2)


def test_simhash_chains(spark):
    """Chains of links and a dense ball over many small shards."""
    rng = random.Random(2)
    fps = [rng.getrandbits(64)]
    for _ in range(80):
        fps.append(fps[-1] ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64))
    centre = rng.getrandbits(64)
    fps += [centre ^ 1 << rng.randrange(64) ^ (1 << rng.randrange(64) if rng.random() < 0.5 else 0) for _ in range(80)]
    fps = sorted({f - (1 << 64) if f >> 63 else f for f in fps})
    edges = simhash.shard_links(spark.createDataFrame([(f,) for f in fps], "fp long"), 2, sample=40, shard=6, block=10)
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    want = brute_components([f % 2**64 for f in fps], fps, 2)
    assert {f: got.get(f, f) for f in fps} == dict(zip(fps, want, strict=True))


def test_warc(spark, tmp_path):
    rows = [(1, "http://a", "same"), (2, "http://b\r\nX: y", "same"), (3, None, None), (4, "u", ""), (5, "u", "löng " * 50_000), (6, "u%0A", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r for r in warc.archive(pages, str(tmp_path / "w")).collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in got.items()} == {1: ("revisit", 6), 2: ("revisit", 6), 3: ("revisit", 4), 4: ("response", None), 5: ("response", None), 6: ("response", None)}
    for i, url, html in rows:
        payload = (html or "").encode()
        assert (got[i].url, got[i].payload_bytes, got[i].payload_digest) == (url, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
    least = {r.page_id: r.record_type for r in warc.archive(pages, str(tmp_path / "m"), min_payload=3).collect()}
    assert least[3] == least[4] == "response" and least[1] == "revisit"
    assert warc.archive(pages.limit(0), str(tmp_path / "e")).isEmpty()


def test_warc_frames(tmp_path):
    store, base = warc.file_system(str(tmp_path))
    bundle = warc.Bundle(store.open_output_stream(f"{base}/x.warc.zst", compression=None), frame_bytes=1000)
    data = [warc.record(i, f"u{i}", b"p" * (i * 37 % 900), None, False) for i in range(50)]
    places = [bundle.add(d) for d in data]
    bundle.close()
    source = store.open_input_file(f"{base}/x.warc.zst")
    table = warc.seek_table(source)
    for d, (frame, offset) in reversed(list(zip(data, places, strict=True))):
        assert warc.read_frame(source, table, frame)[offset : offset + len(d)] == d
    import zstandard

    raw = (tmp_path / "x.warc.zst").read_bytes()
    assert zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read() == b"".join(data)


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    def good(kind, m):
        digits = re.sub("[^0-9]", "", m)
        return kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m.split(".")) or kind == "card" and 16 <= len(digits) <= 19 and pii.luhn(digits) or kind == "phone" and 8 <= len(digits) <= 15

    return {k: [m.span() for m in re.finditer(p, text) if good(k, m.group())] for k, p in BASE.items()}


def test_pii_base(texts):
    for t in texts.values():
        assert pii.base_spans(t) == plain_spans(t)
    rng = random.Random(4)
    for _ in range(4000):
        t = "".join(rng.choice("a.@-1+ 2(4") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(t) == plain_spans(t), t
    assert pii.base_spans("1" * 200_000 + "a" * 200_000 + "@") == {k: [] for k in BASE}


def test_pii_model(spark):
    rows = pii.labelled()
    got = pii.train().label([[w.encode() for w in x] for x, _ in rows])
    assert [got[i].tolist() if i in got else [0] * len(x) for i, (x, _) in enumerate(rows)] == [y for _, y in rows]
    text = 'Call Mr. Paul Jones or use token = "ab12cd34ef56ab78cd90ef12ab34cd56ef78ab90" and 521-44-9821 as SSN, mail a.b@c.org.'
    r = pii.find_pii(spark.createDataFrame([(1, text), (2, None)], "doc_id long, text string")).orderBy("doc_id").collect()
    spans = [s.split(":") for s in r[0].spans.split(",")]
    assert spans[0][0] == "email" and r[0].n_email == 1 and "<email>" in r[0].redacted
    assert {text[int(a) : int(b)] for k, a, b in spans if k == "secret"} == {"ab12cd34ef56ab78cd90ef12ab34cd56ef78ab90"}
    assert r[1].base_sha256 == hashlib.sha256(b"").hexdigest() and r[1].spans == ""


def test_viterbi():
    rng = np.random.default_rng(5)
    t = rng.normal(size=(3, 3))
    seqs = [rng.normal(size=(n, 3)) for n in (0, 1, 5, 3, 6)]
    from itertools import product

    for e, got in zip(seqs, pii.viterbi(seqs, t), strict=True):
        best = max(product(range(3), repeat=len(e)), key=lambda y: sum(e[i, y[i]] for i in range(len(e))) + sum(t[a, b] for a, b in zip(y, y[1:], strict=False)))
        assert list(got) == list(best)


def test_tokens(docs, texts):
    model = tokens.load_unigram("piece_bpe_32k.model")
    longest = max(map(len, model.score))

    def plain(word):
        word, best = tokens.MARK + word, [(0.0, 0)]
        for i in range(1, len(word) + 1):
            found = [(best[j][0] + model.score[word[j:i]], best[j][1] - 1) for j in range(max(0, i - longest), i) if word[j:i] in model.score]
            if word[i - 1] not in model.score:
                n = len(word[i - 1].encode())
                found.append((best[i - 1][0] + model.byte * n, best[i - 1][1] - n))
            best.append(max(found))
        return -best[-1][1]

    for r in tokens.count_tokens(docs.filter("doc_id % 9 = 0")).collect():
        w = texts[r.doc_id].split()
        assert (r.n_words, r.n_tokens) == (len(w), sum(map(plain, w)))


def plain_pieces(text):
    """(piece, start, length, ids_crc32) of a document."""
    import public_tokenizers
    from tokenizers import Tokenizer

    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = np.array([*bpe.encode(text, add_special_tokens=False).ids, 0], "<u4")
    return [(k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(packing.cut(len(ids), 2048))]


def test_packing(docs, texts):
    rows = packing.pack(docs).toPandas()
    want = {(d, p[0]): p[1:] for d, t in texts.items() for p in plain_pieces(t)}
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows.itertuples()} == want
    rows = rows.sort_values(["sequence_id", "offset"])
    ends = rows.groupby("sequence_id").length.cumsum()
    assert (ends - rows.length == rows.offset).all() and ends.max() <= 2048
    assert rows.sequence_id.nunique() <= -(-int(rows.length.sum()) // 2048) + 1


def test_tokenizers_agree():
    import public_tokenizers
    from tokenizers import Tokenizer

    bpe, fast = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), packing.load_bpe("byte_bpe_50k.tiktoken")
    for c in range(0, 0x3000):
        t = f"a{chr(c)}a {chr(c)}1{chr(c)}'s  {chr(c)}"
        assert fast.encode_to_numpy(t, allowed_special="all").tolist() == bpe.encode(t, add_special_tokens=False).ids
    rng = random.Random(7)
    for c in range(0x3000, 0x110000, 97):
        t = f"a{chr(c)}b {chr(c)}{chr(c)}1 \n{chr(c)}"
        if not 0xD800 <= c < 0xE000:
            assert fast.encode_to_numpy(t, allowed_special="all").tolist() == bpe.encode(t, add_special_tokens=False).ids, hex(c)
    for _ in range(2000):
        t = "".join(rng.choice("ab Z'st09 \t\n\u00a0é漢😀\u0301.,-") for _ in range(rng.randint(0, 60)))
        assert fast.encode_to_numpy(t, allowed_special="all").tolist() == bpe.encode(t, add_special_tokens=False).ids, t
    t = "x<|endoftext|> y"
    assert fast.encode_to_numpy(t, allowed_special="all").tolist() == bpe.encode(t, add_special_tokens=False).ids


def test_bin_slack():
    rng = random.Random(6)
    for _ in range(200):
        room = rng.randint(1, 40)
        counts = {n: rng.randint(1, 3) for n in rng.sample(range(1, 30), 5)}
        sums = {0}
        for n, c in counts.items():
            sums = {s + n * k for s in sums for k in range(c + 1)}
        got = packing.fullest(counts, room)
        assert sum(n * k for n, k in got.items()) == max(s for s in sums if s <= room) and all(k <= counts[n] for n, k in got.items())
    histogram = {n: rng.randint(1, 50) for n in range(1, 60)}
    plan = packing.minimum_bin_slack(histogram, 64)
    used = Counter()
    for b, times in plan:
        assert sum(n * k for n, k in b.items()) <= 64
        for n, k in b.items():
            used[n] += k * times
    assert used == histogram


def test_langid(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    for r in got.itertuples():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = got[got.held_out]
    assert (held.lang_pred == held.lang).mean() > 0.95 and got.score.between(0, 1).all()


def test_langid_counts_in_chunks(monkeypatch):
    text = "Ab cd  éf! 12 x" * 40
    whole = langid.counts(text)
    monkeypatch.setattr(langid, "CHUNK", 7)
    part = langid.counts(text)
    assert whole[0].tolist() == part[0].tolist() and whole[1].tolist() == part[1].tolist()
    assert langid.counts("12 !?") is None


def test_langid_learns_from_all(spark):
    """Document counts are of all labelled rows, a rare language is not crowded out, and equal texts tie."""
    rows = [(i, ("alpha beta gamma " * 3 + str(i)), "aa") for i in range(900)] + [(i, "xenon krypton argon", "bb") for i in range(900, 912)] + [(2000, None, "aa"), (2001, "zz", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    df = langid.document_counts(docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("text"))
    assert df[-1] == 912 and df[:-1].max() == 912
    model = langid.train(docs, langid.LangParams(per_lang=50))
    assert model.langs == ["aa", "bb"]
    told = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    assert {told[i] for i in range(900)} == {"aa"} and {told[i] for i in range(900, 912)} == {"bb"} and told[2000] == "und"
    even = langid.LangModel(["aa", "bb"], model.idf, model.weights * 0, 1.0)
    assert {r.lang_pred for r in langid.predict(docs.filter("doc_id < 5"), even).collect()} == {"aa"}


def test_langid_step():
    """The regularised leader in plain form: each weight minimises what the sums of gradients and penalties say."""
    rng = np.random.default_rng(2)
    rows = [(lang, np.sort(rng.choice(40, 5, replace=False)), rng.integers(1, 4, 5)) for lang in "ab" * 10]
    p = langid.LangParams(epochs=1)
    got = langid.fit(rows, p)
    idf = got.idf
    langs, z, n = ["a", "b"], Counter(), Counter()
    weight = lambda c, k: 0.0 if abs(z[c, k]) <= p.l1 else -(z[c, k] - np.sign(z[c, k]) * p.l1) / ((p.beta + np.sqrt(n[c, k])) / p.alpha + p.l2)
    train = [x for i, x in enumerate(rows) if i % 5]
    for i in np.random.default_rng(7).permutation(len(train)):
        lang, columns, counts = train[i]
        v = dict(zip(columns.tolist(), langid.vector(columns, counts, idf), strict=True)) | {1 << langid.BITS: 1.0}
        w = {(c, k): weight(c, k) for c in v for k in range(2)}
        scores = np.array([sum(v[c] * w[c, k] for c in v) for k in range(2)])
        prob = np.exp(scores - scores.max()) / np.exp(scores - scores.max()).sum()
        for c in v:
            for k in range(2):
                g = v[c] * (prob[k] - (langs[k] == lang))
                sigma = (np.sqrt(n[c, k] + g * g) - np.sqrt(n[c, k])) / p.alpha
                z[c, k] += g - sigma * w[c, k]
                n[c, k] += g * g
    for c in {c for c, _ in z}:
        assert got.weights[c] == pytest.approx([weight(c, k) for k in range(2)])


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "u", "<p>" + "word " * 30_000), (4, "u", "<article><p>Text here.</p></article>"), (4, "u", "<article><p>Text here.</p></article>"), (None, "u", "<p>no id</p>")]
    extra = ("id", "html_", "sha", "kept", "refers_to", "text", "n", "digest")
    return spark.createDataFrame([(*r, *[7] * len(extra)) for r in rows], "page_id long, url string, html string, " + ", ".join(f"{c} int" for c in extra))


def test_odd_pages(spark, odd_pages, tmp_path):
    got = html_text.extract(odd_pages).collect()
    assert [(r.page_id, r.n_chars) for r in got] == [(1, 0), (2, 0), (3, 149_999), (4, 10), (4, 10), (None, 5)]
    back = warc.archive(odd_pages, str(tmp_path / "o")).collect()
    assert sorted((r.page_id or 0, r.record_type, r.refers_to) for r in back) == [(0, "response", None), (1, "revisit", 2), (2, "response", None), (3, "response", None), (4, "response", None), (4, "response", None)]
    assert html_text.extract(odd_pages.limit(0)).isEmpty() and warc.archive(odd_pages.limit(0), str(tmp_path / "n")).isEmpty()


def test_html_ratio_decides():
    """Pages without an article or telling classes: link lists and notes go, and the ratio is what tells."""
    links = "<div><a href=/>Home</a> <a href=/a>About us</a> <a href=/c>Contact</a></div>"
    long, more = "long text here " * 20, "more of the text " * 15
    page = f"<html><body>{links}<div><div><h1>A title</h1></div><p>{long}</p><p>Short one.</p><p>{more}</p><ul><li><a>One link</a></li><li><a>Two link</a></li><li><a>Three link</a></li><li><a>Four link</a></li><li><a>Five</a></li></ul></div><div>Copyright 2020 Example Inc.</div></body></html>"
    assert html_text.main_text(page).split("\n") == ["A title", long.strip(), "Short one.", more.strip()]
    table = f"<table><tr><td><a>x</a> <a>y</a></td></tr><tr><td><p>{long}</p><p>{more}</p></td></tr><tr><td>Buy now</td></tr></table>"
    assert html_text.main_text(table).split("\n") == [long.strip(), more.strip()]
    rows = html_text.page_lines(page)
    ratio = html_text.ratios(rows)
    assert not html_text.content(rows, ratio * 0).any()
    rng = np.random.default_rng(0)
    assert any((html_text.content(rows, rng.permutation(ratio)) != html_text.content(rows, ratio)).any() for _ in range(5))


def test_html_nesting_is_linear():
    import time

    began = time.time()
    assert html_text.main_text("<div>" * 8000 + "x text here" + "</div>" * 8000) == "x text here"
    html_text.main_text("<div>x" * 8000 + "</section></p>" * 8000)
    assert time.time() - began < 2


def test_dedup_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, 6), (2, "a b c", 7, 8)], "doc_id long, text string, n_lines int, N_REMOVED int")
    got = lines.dedup_lines(docs)
    assert got.columns == [*docs.columns, "n_removed_", "n_lines_"]
    assert sorted(map(tuple, got.collect())) == [(1, "a b c", 5, 6, 0, 1), (2, "", 7, 8, 1, 1)]


def test_odd_rows(spark, odd):
    n = len(ODD)
    q = quality.quality(odd).collect()
    assert len(q) == n and sorted(r.n_words for r in q) == [0, 0, 0, 1, 4, 4, 4, 3000]
    bench = spark.createDataFrame([(1, "same text here now")], "item_id long, text string")
    assert decontam.find_leaks(odd, bench).count() == 3 and decontam.drop_leaks(odd, bench).columns == odd.columns
    kept = lines.dedup_lines(odd)
    assert kept.columns == [*odd.columns, "n_removed", "n_lines"]
    # A null id comes first, so its line stays; both rows of document 5 lose theirs.
    assert [(r.doc_id, r.text) for r in kept.filter("text LIKE 'same%'").collect()] == [(None, "same text here now")]
    assert kept.filter("text IS NULL").count() == 1
    s = simhash.near_duplicates(odd).collect()
    assert len(s) == n
    assert {r.component_id for r in s if r.fingerprint == "0" * 16} == {1}
    p = pii.find_pii(odd).collect()
    assert len(p) == n
    assert sorted(r.n_tokens > 0 for r in tokens.count_tokens(odd).collect()) == [False] * 3 + [True] * 5
    packed = packing.pack(odd).collect()
    assert {r.length for r in packed if r.doc_id in (1, 2)} == {1}
    assert decontam.find_leaks(odd.withColumn("item_id", F.lit(1)), bench).columns[:2] == ["doc_id", "item_id"]
    lang = langid.identify(odd).collect()
    assert len(lang) == n and {r.doc_id for r in lang if r.lang_pred == "und"} >= {1, 2, 3}


def test_empty_tables(spark, docs):
    none = docs.limit(0)
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    for made in (quality.quality(none), decontam.find_leaks(none, bench), lines.dedup_lines(none), simhash.near_duplicates(none), pii.find_pii(none), tokens.count_tokens(none), packing.pack(none), langid.identify(none)):
        assert made.isEmpty()


def test_pipeline_stages(spark, docs, texts):
    bench_free = corpus_pipeline.STAGES
    assert [n for n, _ in bench_free] == ["language", "lines", "near_copies", "benchmark", "packing"]
    told = corpus_pipeline.language(spark, docs, SF)
    assert told.columns == docs.columns and {r.doc_id for r in told.collect()} == set(texts)
    odd = spark.createDataFrame([(1, None, None, "s", 0), (2, "12 34", "en", "s", 5), (3, texts[0], "fr", "s", 9)], docs.schema)
    assert {r.doc_id for r in corpus_pipeline.language(spark, odd, SF).collect()} == {3}
    less = corpus_pipeline.lines(spark, docs, SF)
    want = greedy_lines(texts)
    assert {r.doc_id: (r.text, r.n_chars) for r in less.collect()} == {d: (t, len(t)) for d, t in want.items()}


def test_pipeline(spark, docs, texts):
    """The whole pipeline against plain versions of its stages; only the language model is the operator's own."""
    from test_shingles import firsts

    told = langid.predict(docs, langid.train(docs)).collect()
    left = greedy_lines({r.doc_id: r.text for r in told if r.lang_pred != langid.UNKNOWN and r.score >= corpus_pipeline.MIN_SCORE})
    left = {d: left[d] for d in firsts(left)}
    items = [" " + " ".join(re.findall(r"\w+", r.text.lower())) + " " for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {d: t for d, t in left.items() if not any(i in " " + " ".join(re.findall(r"\w+", t.lower())) + " " for i in items)}
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert sorted(map(tuple, out.drop("sequence_id", "offset").collect())) == sorted((d, *p) for d, t in left.items() for p in plain_pieces(t))
    assert 0 < len(left) < len(texts)


ODD_NAMES = ("k", "row", "text_", "__k", "__text", "id", "item", "n_lines", "n_removed", "fp", "lang_pred", "score")


def test_pipeline_stages_on_odd_tables(spark, docs):
    """Empty tables, nulls, repeated rows, and columns named as operators name theirs."""
    extra = docs.limit(40).union(docs.limit(1)).union(spark.createDataFrame([(None, None, None, None, None), (None, "", "en", "s", 0)], docs.schema))
    extra = extra.withColumns({c: F.lit(i) for i, c in enumerate(ODD_NAMES)})
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, docs.limit(0), SF)
        assert none.isEmpty() and (name == "packing" or none.columns == docs.columns)
        out = stage(spark, extra, SF)
        assert out.count() > 0 and (name == "packing" or out.columns == extra.columns)
        if name not in ("packing", "language"):
            assert [out.first()[c] for c in ODD_NAMES] == list(range(len(ODD_NAMES)))


def test_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))


def test_line_postings_come_in_passes(spark, monkeypatch):
    """Each pass posts its own keys only, and together they find the pairs that one pass over all keys finds."""
    rows = [(i, j, 5, 0, 0, [((i * 7 + j + n) % 20) << 32 for n in range(2)]) for i in range(12) for j in range(2)]
    sets = spark.createDataFrame(rows, "k long, at int, size long, b0 long, b1 long, prefix array<long>")
    meetings, posted = lines.meetings, []

    def counted(postings, num, den):
        posted.append(postings.count())
        return meetings(postings, num, den)

    monkeypatch.setattr(lines, "meetings", counted)
    pairs = lambda: {tuple(r) for r in lines.few_pairs(sets, lambda key: F.lit(False), 4, 5).collect()}
    found = pairs()
    assert sum(posted) == 2 * len(rows) and max(posted) < len(rows)
    monkeypatch.setattr(lines, "PASSES", 1)
    assert found and found == pairs()


def test_line_bitmaps_of_small_and_large_sets(spark):
    """Parities never differ in more places than sets do in words; small sets have no second bitmap."""
    texts = [" ".join(f"w{n}" for n in range(a, a + size)) for size in (5, 60, 63, 64, 65, 66, 75, 120) for a in (0, 1, 3)]
    made = spark.createDataFrame(list(enumerate(texts)), "n long, line string").select("n", lines.hashes_of(F.col("line")).alias("h"))
    sets = made.select("n", F.size("h").alias("size"), "h", *(c.alias(b) for c, b in zip(lines.bitmaps(F.col("h")), lines.BITS, strict=True))).cache()
    x, y = (sets.select(*(F.col(c).alias(side + c) for c in sets.columns)) for side in "xy")
    apart = F.size(F.array_except("xh", "yh")) + F.size(F.array_except("yh", "xh"))
    rows = x.crossJoin(y).select("xsize", "ysize", apart.alias("apart"), lines.parities_apart().alias("bits")).collect()
    assert len(rows) == len(texts) ** 2 and all(r.bits <= r.apart and (r.apart - r.bits) % 2 == 0 for r in rows)
    assert {r.size > 64 for r in sets.filter("b1 <> 0").collect()} == {True} and sets.filter("size > 64 AND b1 = 0").isEmpty()


def test_line_dedup_leaves_little_scratch(spark):
    """Of what line dedup and near copies write on the way, only what their results are read from is left."""
    from loomgraph.llm.shingles import first_of_similar
    from loomgraph.runtime import made

    docs = spark.createDataFrame([(i, f"one two three four five six {i % 4}\nseven eight nine ten {i}") for i in range(20)], "doc_id long, text string")
    for run, left in ((lines.dedup_lines, "loom-line-kept"), (lambda d: first_of_similar(d, width=2, num=4, den=5), "loom-shingle-first")):
        with made() as paths:
            out = run(docs)
        there = [p for p in paths if os.path.exists(p.removeprefix("file:"))]
        assert len(paths) > 5 and len(there) == 1 and left in there[0]
        assert out.count() > 0


def test_line_words_that_are_just_frequent_are_not_crowded(spark, monkeypatch):
    """Many lines share a rare word and little else, small or wide ones; only those of a dense group are crowded, and pairs of
    wide sets that share few words are not written for their words to be compared."""
    rng, staged, rows = random.Random(5), lines.staged, {}
    vocab = [f"v{i}" for i in range(6000)]
    monkeypatch.setattr(lines, "staged", lambda df, name: rows.update({name: rows.get(name, 0) + (out := staged(df, name)).count()}) or out)
    few = [" ".join(["rare", *rng.sample(vocab[:900], 30)]) for _ in range(300)]
    wide = [" ".join(["seldom", *rng.sample(vocab, 399)]) for _ in range(60)]
    wide += [" ".join(wide[0].split()[:n]) for n in (380, 350, 300)]
    dense = [" ".join([*(f"d{i}" for i in range(30) if i not in (n % 30, n // 30)), f"u{n}"]) for n in range(200)]
    made = dict(enumerate(few + wide))
    docs = lambda texts: spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert {r.doc_id: r.text for r in lines.dedup_lines(docs(made)).collect()} == greedy_lines(made)
    assert rows["line-crowd"] == 0 and rows["line-close"] > rows["line-pairs"] and rows["line-pairs"] < 10
    rows.clear()
    made = dict(enumerate(few + dense))
    assert {r.doc_id: r.text for r in lines.dedup_lines(docs(made)).collect()} == greedy_lines(made)
    assert rows["line-crowd"] > 200
