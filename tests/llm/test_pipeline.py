"""The stages of the pipeline on rows with null and repeated ids."""

import random

import pytest

import corpus_pipeline as pipeline

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def made(spark):
    return lambda rows: spark.createDataFrame([(i, t, "en", "x", len(t or "")) for i, t in rows], SHAPE)


def kept(df):
    assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=repr)


def sentence(rnd, n):
    return " ".join("".join(rnd.choice("etaoin") for _ in range(6)) for _ in range(n))


def test_quality_judges_every_row(spark, made, tmp_path):
    rnd = random.Random(1)
    good = lambda: sentence(rnd, rnd.randint(5, 200)) + "."
    bad = lambda: " ".join(rnd.choice(["buy### ", "click$$$", "%%%%"]) for _ in range(rnd.randint(5, 200)))
    rows = [(i, good() if i % 4 else bad()) for i in range(300)]
    marks = [(i, int(i % 4 > 0)) for i in range(300)]
    spark.createDataFrame(marks, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    odd = [(None, good()), (None, bad()), (900, good()), (900, bad()), (900, bad())]
    want = [r for r in rows if r[0] % 4] + [odd[0], odd[2]]
    assert kept(pipeline.quality(spark, made(rows + odd), str(tmp_path))) == sorted(want, key=repr)


def test_one_row_of_each_group_of_copies_stays(spark, made):
    rnd = random.Random(2)
    copied, again, nameless, own = (sentence(rnd, 40) for _ in range(4))
    rows = [(None, copied), (5, copied), (5, copied), (9, copied + " end"), (6, again), (6, again), (6, own)]
    rows += [(None, nameless), (None, nameless), (7, ""), (7, ""), (None, None)]
    want = [(5, copied), (6, again), (6, own), (None, nameless), (7, ""), (7, ""), (None, None)]
    assert kept(pipeline.near_copies(spark, made(rows), "")) == sorted(want, key=repr)
    whole = [(i, t) for i, (_, t) in enumerate(rows)]
    want = [whole[0], whole[4], whole[6], whole[7], *whole[9:]]
    assert kept(pipeline.near_copies(spark, made(whole[::-1]), "")) == sorted(want, key=repr)
    assert kept(pipeline.near_copies(spark, made([]), "")) == []


def test_leaks_go_with_any_id(spark, made, tmp_path):
    rnd = random.Random(3)
    passage = sentence(rnd, 20)
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    clean = [sentence(rnd, 30) for _ in range(3)]
    rows = [(None, passage), (1, clean[0] + " " + passage), (1, clean[1]), (None, clean[2]), (2, None)]
    want = [(1, clean[1]), (None, clean[2]), (2, None)]
    assert kept(pipeline.decontaminated(spark, made(rows), str(tmp_path))) == sorted(want, key=repr)
