"""Phrases, token counts and resampling against plain versions, on odd rows and on empty tables."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tablehaul.llm import counts, grams, phrases, queries, resample
from tablehaul.llm.queries import tokenizer

SHAPE = (
    "doc_id long, text string, lang string, id string, n_words string, rank int, f int, phrase string, "
    "block int, term string, n_tokens string, n_bytes int, score string"
)
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows():
    rnd = random.Random(11)
    common = ["the", "of", "New", "York", "city", "a\x00b", "a", "été", "日本", "x-y", "don't", "word" * 5]
    rare = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 40))) for _ in range(300)]
    gaps = [" ", " ", " ", " ", "  ", "\t", ". ", ", ", "\n", "\r\n", "　", "\x85", " \x1c", "<|endoftext|>"]

    def text(n):
        parts = []
        for _ in range(n):
            words = ["new", "york", "city"] if rnd.random() < 0.1 else [rnd.choice(common if rnd.random() < 0.7 else rare)]
            for w in words:
                parts += [w, " " if len(words) > 1 else rnd.choice(gaps)]
        return "".join(parts)

    found = [(i, text(rnd.choice([1, 5, 19, 20, 60, 300])), rnd.choice(["en", "fr", None, "und"])) for i in range(80)]
    odd = [None, "", " ", "one", "\n\n", "x" * 40000, "ab " * 9000, "\x00<|endoftext|>", "<|endof", "text|>", "  lead", "tail \n "]
    found += [(100 + i, t, "en") for i, t in enumerate(odd)]
    return [*found, found[3], found[3], (None, found[5][1], "fr"), (None, "<|endoftext|>", None)]


@pytest.fixture(scope="module")
def docs(spark):
    made = [(i, t, lang, "x", "y", 1, 2, "z", 3, "t", "u", 4, "v") for i, t, lang in rows()]
    return spark.createDataFrame(made, SHAPE).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SHAPE)


def plain_phrases(found, min_count, top, percent):
    f, total = Counter(), Counter()
    for _, text, lang in found:
        lang = lang or "und"
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    made = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= min_count:
            cuts = [(1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            made[lang, p] = (a, *min(cuts))
    for (lang, p), (a, _, _) in list(made.items()):
        if len(p) == 3:
            for part in (p[:2], p[1:]):
                if (lang, part) in made and 100 * a >= percent * f[lang, part]:
                    made.pop((lang, part))
    out = []
    for lang in total:
        own = [(-s, -a, " ".join(p).encode(), p, k) for (own, p), (a, s, k) in made.items() if own == lang]
        for rank, (s, a, phrase, p, k) in enumerate(sorted(own)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, f[lang, p[:k]], f[lang, p[k:]], total[lang], -s))
    return sorted(out)


@pytest.mark.parametrize("top, wider", [(2000, 4), (4, 1), (7, 2), (1, 4)])
def test_phrases(docs, empty, monkeypatch, top, wider):
    monkeypatch.setattr(phrases, "WIDER", max(2, wider))
    got = sorted(map(tuple, phrases.mine_phrases(docs, min_count=4, top=top).collect()))
    assert got == plain_phrases(rows(), 4, top, 50)
    assert {len(r[2].split(" ")) for r in got} == {2, 3} or top < 5
    assert phrases.mine_phrases(empty).count() == 0


def test_phrases_behind_a_first_frontier(spark):
    """The best pairs are all parts of longer phrases, so the frontier has to move on."""
    rnd = random.Random(3)
    found = []
    for n in range(30):
        three = [f"{c}{n}" for c in "abc"]
        found += [(0, " ".join(three), "en")] * 6 + [(0, f"{three[0]} {three[1]}", "en")] * rnd.randint(0, 5)
    found += [(0, f"of {rnd.choice('pqrst')} and", "en") for _ in range(200)]
    docs = spark.createDataFrame(found, "doc_id long, text string, lang string")
    for top in (5, 12, 40):
        got = sorted(map(tuple, phrases.mine_phrases(docs, min_count=5, top=top).collect()))
        assert got == plain_phrases(found, 5, top, 50)


def test_a_full_filter_costs_counts_only(docs, monkeypatch):
    monkeypatch.setattr(phrases, "FILTER_BITS", 1 << 15)
    want = sorted(map(tuple, phrases.mine_phrases(docs, min_count=3, top=20).collect()))
    assert want == plain_phrases(rows(), 3, 20, 50)


def test_phrases_agree_with_their_sql(spark, docs, tmp_path):
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    with duckdb.connect() as db:
        db.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
        want = sorted(db.execute(queries.ORACLES["op11_phrases"]).fetchall())
    assert sorted(map(tuple, queries.op11_phrases(spark, str(tmp_path)).collect())) == want != []


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_counts_are_the_librarys(docs, empty, monkeypatch, name):
    from tokenizers import Tokenizer

    monkeypatch.setattr(counts, "BLOCK_BYTES", 5000)
    whole = Tokenizer.from_file(tokenizer(name))
    got = counts.count_tokens(docs, tokenizer(name)).collect()
    want = [(i, len((t or "").encode()), len(whole.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in rows()]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert counts.count_tokens(empty, tokenizer(name)).count() == 0


def test_token_counts_of_any_character():
    from tokenizers import Tokenizer

    whole, cutter = Tokenizer.from_file(tokenizer("byte_bpe_50k.json")), counts.PreTokens(tokenizer("byte_bpe_50k.json"))
    rnd = random.Random(5)
    marks = [chr(c) for c in [*range(0x300), *range(0x1680, 0x1690), *range(0x2000, 0x2070), 0x180E, 0x3000, 0xFEFF, 0x1F600, 0x1E5D0]]
    texts = ["".join(rnd.choice(marks + [" ", "\n", "a", "'s", "1"] * 60) for _ in range(60)) for _ in range(400)]
    terms, ends, which, times = counts._frequencies(cutter, texts)
    n = np.array([cutter.pieces(t) for t in terms])[which] * times
    got = [int(x.sum()) for x in np.split(n, ends[:-1])]
    assert got == [len(e.ids) for e in whole.encode_batch(texts, add_special_tokens=False)]


def plain_draw(found, target, percent=25):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))
        return len(words), [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]

    own = [features(t) for _, t, _ in found]
    s, t = Counter(b for _, f in own for b in f), Counter(b for x in target for b in features(x)[1])
    every, wanted = s.total() + 10000, t.total() + 10000
    gain = [math.floor(1000 * math.log((t[b] + 1) * every / ((s[b] + 1) * wanted))) for b in range(10000)]
    out = []
    for (i, _, _), (n, f) in zip(found, own, strict=True):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    drawn = percent * len(able) // 100
    ranked = [(*r, k if k <= drawn else None) for k, r in enumerate(able, 1)] + [(*r, None) for r in out if r[1] < 20]
    return sorted(ranked, key=repr)


def test_resampling(spark, docs, empty):
    texts = ["the city of New York", None, "", rows()[7][1]]
    target = spark.createDataFrame([(t, 1) for t in texts], "text string, id int")
    for percent in (25, 100):
        got = sorted(map(tuple, resample.resample(docs, target, percent=percent).collect()), key=repr)
        assert got == plain_draw(rows(), texts, percent)
    got = sorted(map(tuple, resample.resample(docs, target.limit(0)).collect()), key=repr)
    assert got == plain_draw(rows(), [])
    assert resample.resample(empty, target).count() == 0


def test_crcs_are_zlibs():
    rnd = np.random.default_rng(1)
    data = rnd.integers(0, 256, 20000, dtype=np.uint8)
    starts = np.sort(rnd.integers(0, 19000, 3000))
    ends = starts + np.where(rnd.random(3000) < 0.01, 900, rnd.integers(0, 30, 3000))
    for before in (b"", b"en "):
        got = grams.crc32s(data, starts, ends, before)
        assert got.tolist() == [zlib.crc32(before + data[s:e].tobytes()) for s, e in zip(starts, ends, strict=True)]


def test_runs_are_told_apart_by_their_bytes():
    words = [b"a", b"a\0", b"\0a", b"b" * 8, b"b" * 9, b"b" * 8 + b"\0", b"c" * 128, b"c" * 129, b"c" * 128 + b"d"]
    words += [bytes(w) for w in (b"abba" * 40, b"baab" * 40)]
    data = np.frombuffer(b"".join(words * 2), np.uint8)
    ends = np.cumsum([len(w) for w in words * 2])
    starts = ends - [len(w) for w in words * 2]
    number, member = grams.number_runs(data, starts, ends)
    assert number[: len(words)].tolist() == number[len(words) :].tolist()
    assert sorted(number[: len(words)].tolist()) == list(range(len(words))) and len(member) == len(words)
    assert [data[starts[m] : ends[m]].tobytes() for m in member[number]] == words * 2
