"""Every operator against a plain version of it, on odd rows and on empty tables."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablehaul.llm import leaks, licenses, lines, minhash, packing, quality, secrets, suffixes, vectors, wavelet, words
from tablehaul.llm.queries import tokenizer
from tablehaul.llm.tokens import Encoder, split
from tablehaul.llm.words import slices
from tablehaul.shared import new_folder

SHAPE = "doc_id long, text string, n_lines long, id string, component_id long, kept string, label int"


def texts():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdé") for _ in range(rnd.randint(1, 6)))
    base = [word() for _ in range(300)]
    rows = [None, "", " \n\t", "one", "One two", "\n\n", "x" * 30000, "common line\n" * 5, "日本 語 x"]
    for _ in range(12):
        near = list(base)
        for _ in range(rnd.randint(0, 8)):
            near[rnd.randrange(300)] = word()
        rows.append(" ".join(near) + "\nCommon line \nend " + word())
    rows += [" ".join(word() for _ in range(rnd.randint(1, 400))) for _ in range(20)]
    rows += [rows[-1], rows[-1], " ".join(base[:150]) + " " + rows[-2]]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, 7, "x", 3, "k", 1) for i, t in enumerate(texts())]
    return spark.createDataFrame([*rows, (None, "common line", 1, "y", 2, "k", None)], SHAPE)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SHAPE)


def named(docs):
    return {i: t or "" for i, t in docs.select("doc_id", "text").collect() if i is not None}


def test_near_duplicates(docs, empty):
    sets = {}
    for i, t in named(docs).items():
        w = t.encode().lower().split()
        sets[i] = {tuple(w[k : k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set()
    group = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    group[a] = group[b] = min(group[a], group[b])
    got = {r.doc_id: r for r in minhash.near_duplicates(docs, shingle=3, percent=85).collect()}
    assert got.pop(None).kept
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {
        i: (len(sets[i]), group[i], group[i] == i) for i in sets
    }
    assert minhash.near_duplicates(empty).count() == 0


def test_tiles_and_salts_do_not_change_groups(docs, monkeypatch):
    before = sorted(map(str, minhash.near_duplicates(docs, shingle=3, percent=85).collect()))
    monkeypatch.setattr(minhash, "TILE", 2)
    monkeypatch.setattr(minhash, "COLUMNS", 7)
    assert sorted(map(str, minhash.near_duplicates(docs, shingle=3, percent=85).collect())) == before


def test_signature_estimates_similarity():
    rnd = np.random.default_rng(1)
    pool = rnd.integers(0, 2**63, 1400, dtype=np.uint64)
    two = minhash.signature([pool[:1000], pool[400:]], 512)
    assert abs((two[0] == two[1]).mean() - 600 / 1400) < 0.08


@pytest.mark.parametrize("name, spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_encoder_gives_the_ids_of_whole_texts(name, spaced):
    import pyarrow as pa
    from tokenizers import Tokenizer

    rnd = random.Random(2)
    parts = ["a", "B", "é", "é", " ", "  ", "\n", "\t", "'s", "don't", "12", "##", "\u0085", "\r\n", ".", "\x1c", "ΑΣ"]
    rows = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(800)] + [None]
    whole = Tokenizer.from_file(tokenizer(name))
    whole.encode_special_tokens = True
    own, got = Encoder(tokenizer(name), spaced), []
    for _, data, at in slices(pa.array(rows), 500):
        got += [x.tolist() for x in split(*own.encode(data, at))]
    assert got == [whole.encode(r or "", add_special_tokens=False).ids for r in rows]


@pytest.mark.parametrize("name, spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_encoder_maps_added_tokens_as_the_library_does(name, spaced):
    import pyarrow as pa
    from tokenizers import Tokenizer

    rnd = random.Random(7)
    parts = ["a", "End", " ", "\n", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endof", "text|>", "|>", "é", "\u0085"]
    rows = ["end<|endoftext|>next", "<|endof", "text|>", "<|endoftext", "|>"]
    rows += ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(400)]
    whole = Tokenizer.from_file(tokenizer(name))
    own, got = Encoder(tokenizer(name), spaced), []
    for _, data, at in slices(pa.array(rows), 500):
        got += [x.tolist() for x in split(*own.encode(data, at))]
    assert got == [whole.encode(r, add_special_tokens=False).ids for r in rows]


def test_token_files(spark, docs, empty):
    from tokenizers import Tokenizer

    path = new_folder(spark, "tokens")
    wavelet.write_tokens(docs, path, tokenizer("word_bpe_49k.json"), end_id=2, shard_ids=500)
    got = wavelet.read_tokens(spark, path).orderBy("start").collect()
    whole, start = Tokenizer.from_file(tokenizer("word_bpe_49k.json")), 0
    rows = docs.orderBy(F.col("doc_id").asc_nulls_first()).collect()
    for row, r in zip(rows, got, strict=True):
        ids = [*whole.encode(row.text or "", add_special_tokens=False).ids, 2]
        assert (r.doc_id, r.start, np.frombuffer(r.ids, "<u4").tolist()) == (row.doc_id, start, ids)
        start += len(ids)
    every = np.concatenate([np.frombuffer(r.ids, "<u4") for r in got])
    rnd = random.Random(6)
    asked = [0, len(every) - 1, len(every), -1, None, *(rnd.randrange(len(every)) for _ in range(300))]
    places = spark.createDataFrame([(p, 1) for p in asked], "place long, part int")
    want = {p: int(every[p]) for p in asked if p is not None and 0 <= p < len(every)}
    assert sorted(map(tuple, wavelet.tokens_at(spark, path, places).collect())) == sorted(want.items())
    tokens = [2, int(every[0]), int(every[50]), 49000, 70000, 2]
    counts = dict(wavelet.count_occurrences(spark, path, [*tokens, None]).collect())
    assert counts == {t: int((every == t).sum()) for t in tokens}
    found = sorted(map(tuple, wavelet.find_occurrences(spark, path, tokens).collect()), key=repr)
    ends = np.cumsum([r.n_tokens for r in got])
    doc = lambda p: int(np.searchsorted(ends, p, "right"))
    want = [
        (t, int(p), got[doc(p)].doc_id, int(p - got[doc(p)].start)) for t in set(tokens) for p in np.flatnonzero(every == t)
    ]
    assert found == sorted(want, key=repr)
    path = new_folder(spark, "tokens")
    wavelet.write_tokens(empty, path, tokenizer("word_bpe_49k.json"), end_id=2)
    assert wavelet.read_tokens(spark, path).count() == 0
    assert wavelet.tokens_at(spark, path, places).count() == wavelet.find_occurrences(spark, path, [2]).count() == 0
    assert [tuple(r) for r in wavelet.count_occurrences(spark, path, [2]).collect()] in ([], [(2, 0)])


def test_wavelet_matrix():
    rnd = random.Random(3)
    for n in (0, 1, 511, 512, 513, 3000):
        ids = np.array([min(rnd.randrange(40) ** 2, 1000) for _ in range(n)], np.uint32)
        m = wavelet.WaveletMatrix.build(ids, 10)
        assert (m.ids() == ids).all()
        for _ in range(40 if n else 0):
            at, a, b = rnd.randrange(n), rnd.randrange(n + 1), rnd.randrange(n + 1)
            v, (a, b) = int(ids[at]), sorted((a, b))
            assert m.access(at) == v
            assert m.count(v, a, b) == int((ids[a:b] == v).sum())
            places = np.flatnonzero(ids == v)
            nth = rnd.randrange(len(places))
            assert m.find(v, nth) == places[nth]
        assert m.count(1023) == m.count(5000) == 0


def plain_secrets(t):
    base, rich = [], []
    for m in re.finditer(r"""(?:password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A):
        base += [(m.start(), 0, m.end(), "assign")] * (len(m[1]) >= 8)
    base += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    base += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    for rank, kind in enumerate(secrets.CLASSES):
        for m in re.finditer(kind.pattern, t):
            if any(re.search(a, m[0]) for a in secrets.ALLOWED):
                continue
            s, spans = m[0] if rank else m[0].lower(), []
            listed = [(p.start(), p.end()) for p in re.finditer(secrets.ALLOWED_PARTS, m[0])]
            edges = [0, *(e for p in listed for e in p), len(s)]
            plain = [e for a, b in zip(edges[::2], edges[1::2]) if re.search(secrets.PLAIN, m[0][a:b]) for e in range(a, b)]
            for i in range(len(s) - kind.window + 1):
                if any(a < i + kind.window and i < b for a, b in listed):
                    continue
                counts = Counter(s[i : i + kind.window]).values()
                bits = math.log2(kind.window) - sum(n * math.log2(n) for n in counts) / kind.window
                if bits >= (kind.plain_bits if i in plain else kind.bits):
                    if spans and spans[-1][1] >= i:
                        spans[-1][1] = i + kind.window
                    else:
                        spans.append([i, i + kind.window])
            rich += [(m.start() + a, 3 + rank, m.start() + b, kind.name) for a, b in spans]
    listed = lambda spans: ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(spans))
    return hashlib.sha256(listed(base).encode()).hexdigest(), listed(base + rich)


def test_secrets(spark, docs, empty, plan):
    rnd = random.Random(3)
    parts = ["token", "secret", "=", ":", " ", '"', "AKIA", "ABCD1234EFGH5678", "é", "日", "0123456789abcdef" * 2, "deadbeef",
             "API_KEY", "password = ", "Zx8/+kQ9", "aB3dE5gH7jK9", "\n", "hunter2hunter2", "example"]
    parts += ["qWzKpLvTnBxRmJcH", "DfGsYuOaEiQwXz", "/Example/", "00000000", "changeme", "1234567890", "some/path/to/a/file"]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 20)))) for i in range(400)] + [(400, None)]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    found = secrets.secret_digest(secrets.find_secrets(made))
    assert "Python" not in plan(found) and "Arrow" not in plan(found)
    got = {r.doc_id: (r.base_sha256, r.spans) for r in found.collect()}
    assert got == {i: plain_secrets(t or "") for i, t in rows}
    assert secrets.find_secrets(docs).count() == docs.count()
    assert secrets.find_secrets(empty).count() == 0


def test_common_lines(docs, empty, plan):
    cut = lines.drop_common_lines(docs, min_docs=3)
    assert cut.columns == [*[c for c in docs.columns if c != "n_lines"], "n_lines", "n_dropped"]
    assert "Python" not in plan(cut)
    key = lambda s: s.strip(" \t\n\x0b\x0c\r").translate(str.maketrans(lines.UPPER, lines.LOWER))
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    seen = Counter(k for _, t in rows for k in {key(s) for s in t.split("\n")} if k)
    want = []
    for i, t in rows:
        kept = [s for s in t.split("\n") if seen[key(s)] < 3]
        want.append((i, "\n".join(kept), len(t.split("\n")), len(t.split("\n")) - len(kept)))
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in cut.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert lines.drop_common_lines(empty).count() == 0


def test_packing(docs, empty):
    rows = packing.pack(docs, tokenizer("byte_bpe_50k.json"), end_id=0, capacity=64).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        assert 4 * r.length == len(r.ids) and r.length
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert len(by_doc) == docs.count()
    for pieces in (*by_doc.values(), *by_sequence.values()):
        at = 0
        for start, length, *total in sorted(pieces):
            assert start == at
            at += length
        assert at == total[0] if total else at <= 64
    sizes = [sum(n for _, n in p) for p in by_sequence.values()]
    assert sum(0 if n & (n - 1) == 0 else 64 - n for n in sizes) < 0.03 * sum(sizes)
    assert packing.pack(empty, tokenizer("byte_bpe_50k.json"), end_id=0).count() == 0
    for n in range(1, 3000):
        assert sum(packing.cuts(n, 1024)) == n


def test_near_vectors(spark, empty):
    rnd = np.random.default_rng(5)
    rows = []
    for i in range(160):
        v = rnd.standard_normal(12)
        if rows and i % 2:
            v = np.array(rows[rnd.integers(len(rows))][1]) + 0.2 * rnd.standard_normal(12)
        rows.append((i, v.tolist(), int(i % 3)))
    odd = [(900, None, 1), (901, [0.0] * 12, 1), (902, [1.0, None] + [0.0] * 10, 1), (903, [float("nan")] * 12, 1),
           (904, rows[0][1], None), (905, [1.0], 1), (906, [2.0], 1), (907, [], 1), (None, rows[1][1], 1), (908, [1e300] * 12, 2)]
    made = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v, _ in rows}
    label = {i: k for i, _, k in rows}
    near = {i: {j for j in unit if i != j and label[i] == label[j] and unit[i] @ unit[j] >= 0.93} for i in unit}
    near |= {905: {906}, 906: {905}} | {i: set() for i in (900, 901, 902, 903, 904, 907, 908)}
    for tile in (2048, 3):
        got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(made, tile=tile).collect()}
        assert got.pop(None) == (0, None)
        least = {i: i for i in near}
        for _ in near:
            for i in near:
                least[i] = min([least[i], *(least[j] for j in near[i])])
        assert got == {i: (len(near[i]), least[i]) for i in near}
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_vectors(none).count() == 0


def test_suffix_array():
    rnd = random.Random(6)
    for _ in range(400):
        t = [rnd.randint(0, rnd.choice([1, 2, 5])) for _ in range(rnd.randint(0, 40))]
        order = suffixes.suffix_array(t)
        assert order == sorted(range(len(t)), key=lambda i: t[i:])
        shared = lambda a, b: next((k for k, (x, y) in enumerate(zip(t[a:], t[b:], strict=False)) if x != y), len(t) - max(a, b))
        want = [max([shared(i, j) for j in range(len(t)) if j != i], default=0) for i in range(len(t))]
        assert suffixes.common_prefixes(t, order) == want


@pytest.mark.parametrize("many", [1024, 1])
def test_repeats(docs, empty, many, monkeypatch):
    monkeypatch.setattr(suffixes, "MANY", many)
    raw = {i: t.encode() for i, t in named(docs).items()}
    seen = Counter(b[k : k + 400] for b in raw.values() for k in range(len(b) - 399))
    got = {r.doc_id: r for r in suffixes.drop_repeats(docs).collect()}
    assert got.pop(None).kept == b"common line"
    for i, b in raw.items():
        mark = bytearray(len(b))
        for k in range(len(b) - 399):
            if seen[b[k : k + 400]] > 1:
                mark[k : k + 400] = b"\1" * 400
        left = bytes(x for x, m in zip(b, mark, strict=True) if not m)
        assert (got[i].n_bytes, got[i].kept, got[i].kept_sha256) == (len(b), left, hashlib.sha256(left).hexdigest())
        assert sum(s.end - s.start for s in got[i].spans) == len(b) - len(left)
    assert suffixes.drop_repeats(empty).count() == 0


def test_leaks(spark, docs, empty):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("etaoinshr") for _ in range(5))
    items = [(i, " ".join(word() for _ in range(25)) + ". Answer " + " ".join(word() for _ in range(4))) for i in range(12)]
    kept = lambda t, every: " ".join(w if k % every or k > 24 else word() for k, w in enumerate(t.split()))
    rows = [(i, " ".join(word() for _ in range(60)) + " " + t.upper() + " " + word()) for i, t in items[:6]]
    rows += [(100 + i, word() + " " + kept(t, 3) + " " + word()) for i, t in items[:6]]
    rows += [(200 + i, " ".join(word() for _ in range(80)) + " " + " ".join(t.split()[:6])) for i, t in items]
    made = spark.createDataFrame([*rows, (300, None), (301, ""), (None, "x")], "doc_id long, text string")
    bench = spark.createDataFrame([*items, (50, None), (51, "too short"), (None, items[0][1])], "item_id long, text string")
    for size in (512, 5):
        got = {(r.doc_id, r.item_id) for r in leaks.benchmark_leaks(made, bench, block_items=size).collect()}
        assert got == {(i, i) for i, _ in items[:6]} | {(100 + i, i) for i, _ in items[:6]}
    assert leaks.benchmark_leaks(empty, bench).count() == 0
    assert leaks.benchmark_leaks(made, bench.where("false")).count() == 0
    assert leaks.common_subsequence([1, 2, 3, 4], [9, 1, 3, 4, 2]) == 3


def plain_leaks(rows, items, least=0.8, least_with_answer=0.5):
    """Every window of every text, widened on both sides, against every passage."""
    blocks = leaks.Passages([], [leaks._words_of(t).tolist() for _, t in items], [], np.zeros(0))
    found = {}
    for doc, text in rows:
        words = leaks._words_of(text).tolist()
        for k, (item, passage) in enumerate(items):
            own, answer, size = blocks.words[k], leaks._answer(passage).tolist(), blocks.window(k)
            for s in range(0, max(len(words) - size, 0) + int(leaks._step(size)), int(leaks._step(size))):
                a, b = max(0, s - size // 4), min(len(words), s + size + size // 4)
                share = leaks.common_subsequence(own, words[a:b]) / len(own)
                told = leaks.common_subsequence(answer, words[a:b]) == len(answer)
                if share >= least or share >= least_with_answer and told:
                    one = (share, told, a, b - a)
                    found[doc, item] = max(found.get((doc, item), one), one)
    return found


def test_no_accepted_leak_is_left_out(spark):
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("etaoinshr") for _ in range(6))
    pool = ["".join(p) for p in ("the", "and", "for", "was", "not", "are", "but", "had", "his", "her", "she", "him")]
    passage = lambda: [rnd.choice(pool) if k % 2 else word() for k in range(22)]
    split_up = [(passage(), [rnd.choice(pool) for _ in range(4)]) for _ in range(140)]
    items = [(i, " ".join(p) + ". " + " ".join(a)) for i, (p, a) in enumerate(split_up)]
    rows = [(i, " ".join(rnd.choice(pool) if rnd.random() < 0.4 else word() for _ in range(60))) for i in range(60)]
    for i, (p, a) in enumerate(split_up[:40]):
        told = " ".join(w if k % 2 or rnd.random() < 0.1 else word() for k, w in enumerate(p)) + " " + " ".join(a)
        rows.append((100 + i, " ".join(word() for _ in range(rnd.randint(0, 30))) + " " + told + " " + word()))
    want = plain_leaks(rows, items)
    assert {(100 + i, i) for i in range(40)} <= set(want)
    made = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    for rank in (leaks.RANK, 2):
        got = leaks.benchmark_leaks(made, bench, rank=rank).collect()
        assert {(r.doc_id, r.item_id): (r.share, r.answered, r.first_word, r.n_words) for r in got} == want


def test_leaks_spread_over_more_than_a_window(spark):
    own, other = [f"w{k}" for k in range(32)], iter(f"x{k}" for k in range(10000))
    some = lambda n: [next(other) for _ in range(n)]
    told = own[:10] + some(18) + own[16:]
    rows = [(at, " ".join(some(at) + told + some(40))) for at in range(24, 40)]
    bench = spark.createDataFrame([(1, " ".join(own))], "item_id long, text string")
    got = leaks.benchmark_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench).collect()
    assert {(r.doc_id, r.share) for r in got} == {(at, 26 / 32) for at, _ in rows}


def test_licenses(spark, docs, empty, plan):
    mit = licenses.NOTICES["MIT text"]
    rows = [(1, "été " * 500 + mit.upper() + " x" * 90), (2, "Released under\nthe MIT License. " * 3), (3, None), (4, ""),
            (5, " ".join(mit.split()[:20])), (6, mit.replace("software", "program", 1)), (7, "license"), (None, licenses.NOTICES["GPL-3.0"])]
    made = spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit("x"))
    found = licenses.find_licenses(made)
    assert "Python" not in plan(found)
    got = {(r.doc_id, r.license, r.first_word) for r in found.collect()}
    held = {(i, n) for i, n, _ in got}
    want = set()
    for i, t in rows:
        for name, notice in licenses.NOTICES.items():
            own, s = set(licenses._shingles(notice)), licenses._shingles(t or "")
            if any(len(own & set(s[k : k + len(own) + 2])) >= 0.8 * len(own) for k in range(len(s))):
                want.add((i, name))
    assert held == want and len(want) >= 3
    assert licenses.find_licenses(empty).count() == 0
    assert licenses.find_licenses(made, notices={}).count() == 0


def test_quality(spark, docs, empty):
    rnd = random.Random(9)
    good = lambda: " ".join("".join(rnd.choice("etaoin") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(5, 200))) + "."
    bad = lambda: " ".join(rnd.choice(["buy### ", "click$$$", "%%%%"]) for _ in range(rnd.randint(5, 200)))
    rows = [(i, good() if i % 4 else bad()) for i in range(400)]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    marks = [(i, int(i % 4 > 0)) for i in range(300)]
    labels = spark.createDataFrame([*marks, (5, None), (None, 1), (6, 9)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality.quality_scores(made, labels).collect()}
    assert all((got[i] >= 0.5) == (i % 4 > 0) for i in range(300, 400))
    scored = quality.quality_scores(docs, labels).collect()
    assert len(scored) == docs.count() and all(0 <= r.score <= 1 for r in scored)
    assert {r.score for r in quality.quality_scores(made, labels.where("false")).collect()} == {0.5}
    assert quality.quality_scores(empty, labels).count() == 0


def thue_morse(n):
    one = np.array([bin(i).count("1") % 2 for i in range(n)])
    return "".join("ab"[b] for b in one), "".join("ba"[b] for b in one)


@pytest.mark.parametrize("n", [64, 256, 1024, 4096])
def test_words_that_differ_in_a_regular_way_have_different_hashes(n):
    one, two = (np.frombuffer(t.encode(), np.uint8) for t in thue_morse(n))
    at, end = np.array([0]), np.array([n])
    assert words.span_hashes(one, at, end)[0] != words.span_hashes(two, at, end)[0]
    assert (words.digests(one, at, end) != words.digests(two, at, end)).any()


def test_span_hashes_depend_on_bytes_and_length_only():
    rnd = random.Random(3)
    spans = [bytes(rnd.choice(b"ab\0") for _ in range(n)) for n in [*range(0, 40), 255, 256, 257, 1000] for _ in range(3)]
    data = np.frombuffer(b"".join(spans + spans[::-1]), np.uint8)
    ends = np.cumsum([len(s) for s in spans + spans[::-1]])
    starts = ends - [len(s) for s in spans + spans[::-1]]
    got = words.span_hashes(data, starts, ends)
    assert got[: len(spans)].tolist() == got[len(spans) :][::-1].tolist()
    assert len(set(got.tolist())) == len(set(spans))
    upper = np.frombuffer(b"AbC abc", np.uint8)
    folded = words.span_hashes(upper, np.array([0, 4]), np.array([3, 7]))
    plain = words.span_hashes(upper, np.array([0, 4]), np.array([3, 7]), fold=False)
    assert folded[0] == folded[1] and plain[0] != plain[1]


@pytest.mark.parametrize("name, spaced", [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)])
def test_regular_pieces_keep_their_own_ids(name, spaced):
    import pyarrow as pa
    from tokenizers import Tokenizer

    rows = list(thue_morse(1024)) + list(thue_morse(64))
    whole, own, got = Tokenizer.from_file(tokenizer(name)), Encoder(tokenizer(name), spaced), []
    for _, data, at in slices(pa.array(rows)):
        got += [x.tolist() for x in split(*own.encode(data, at))]
    assert got == [whole.encode(r, add_special_tokens=False).ids for r in rows]


def test_regular_texts_are_no_copies(spark):
    docs = spark.createDataFrame(list(enumerate(thue_morse(1024))), "doc_id long, text string")
    assert [r.kept for r in minhash.near_duplicates(docs).collect()] == [True, True]
    assert {len(r.spans) for r in suffixes.drop_repeats(docs, length=400).collect()} == {1}  # each holds runs of the other


def test_repeats_of_rows_without_an_id_of_their_own(spark):
    rnd = random.Random(9)
    own = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    shared = own(600)
    rows = [(1, shared + own(300)), (2, own(900)), (1, own(900)), (None, own(50) + shared), (None, own(700)), (3, None)]
    rows += [(5, own(800))] * 2
    got = suffixes.drop_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    left = sorted(((r.doc_id, bytes(r.kept).decode()) for r in got), key=repr)
    cut = lambda t: t.replace(shared, "")
    want = [(i, cut(t or "") if i != 5 else "") for i, t in rows]
    assert [i for i, _ in left] == [i for i, _ in sorted(want, key=repr)]
    sizes = sorted(len(t) for _, t in left)
    assert all(abs(a - b) <= 8 for a, b in zip(sizes, sorted(len(t) for _, t in want), strict=True))
    named = spark.createDataFrame([(str(i), t) for i, t in rows], "doc_id string, text string")
    again = sorted(len(r.kept) for r in suffixes.drop_repeats(named).collect())
    assert again == sizes


def test_short_passages_are_found_word_for_word(spark):
    filler = "some other words of a longer text that is about nothing much at all"
    items = [(1, "What is the capital of France? Paris."), (2, "Paris"), (3, "the the"), (4, " .,"), (5, None), (None, "Rome")]
    items += [(6, "what is the capital of france paris"), (7, filler)]
    rows = [
        (1, f"{filler}; WHAT is the capital -- of france: paris!"), (2, "What is the capital of Spain? Paris."), (3, "the"),
        (4, "x the the the y the the"), (5, "Rome the"), (5, "the Paris"), (None, "capital of France? Paris."), (6, None), (7, ""),
    ]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(1, 1), (1, 6), (1, 2), (1, 7), (2, 2), (4, 3), (5, 2), (None, 2)}
    for size in (512, 2):
        got = leaks.benchmark_leaks(docs, bench, block_items=size).collect()
        assert {(r.doc_id, r.item_id) for r in got} == want and len(got) == len(want)
        assert {r.first_word for r in got if r.item_id == 3} == {1} and {r.n_words for r in got if r.item_id == 1} == {7}
    only = leaks.benchmark_leaks(docs, bench.where("item_id = 2")).collect()
    assert {r.doc_id for r in only} == {1, 2, 5, None}
