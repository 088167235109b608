"""The queries against their SQL, and the whole pipeline on rows whose fate is known."""

import random

import duckdb
import numpy as np
import pytest

import corpus_pipeline as pipeline
from tablehaul.llm import quality
from tablehaul.llm.queries import ORACLES, QUERIES, tokenizer

SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def same(spark, name, folder):
    with duckdb.connect() as db:
        for table in ("documents", "embeddings"):
            db.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
        found = db.execute(ORACLES[name])
        columns = sorted(c[0] for c in found.description)
        want = sorted(map(repr, found.df()[columns].itertuples(index=False, name=None)))
    got = QUERIES[name](spark, folder).select(columns).toPandas()
    return sorted(map(repr, got.itertuples(index=False, name=None))) == want != []


@pytest.mark.parametrize("name", sorted(ORACLES))
@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_sql(spark, name, folder):
    assert same(spark, name, folder)


def words(rnd, n, letters="etaoinshrdlu"):
    return " ".join("".join(rnd.choice(letters) for _ in range(rnd.randint(3, 8))) for _ in range(n))


def test_a_run_of_the_pipeline(spark, tmp_path):
    """Good texts stay whole, bad ones, copies, leaks and common lines go, and what is left comes back from its ids."""
    from tokenizers import Tokenizer

    rnd = random.Random(12)
    good = {i: words(rnd, rnd.randint(60, 300)) + ".\n" + words(rnd, 40) + "." for i in range(120)}
    bad = {1000 + i: " ".join(rnd.choice(["$$$ click", "%%%%", "buy###", "@@@@ 1111"]) for _ in range(120)) for i in range(60)}
    common = "accept all cookies to go on reading"
    rows = dict(good) | bad
    for i in range(12):
        rows[i] = f"{good[i]}\n{common.upper()}  "
    rows[200] = good[50]
    rows[201] = good[51] + " end"
    passage = words(rnd, 30)
    rows[202] = words(rnd, 80) + ". " + passage + ". " + words(rnd, 80) + "."
    left = {i: t for i, t in good.items()}
    texts = [(i, t, "en", "x", len(t)) for i, t in rows.items()]
    spark.createDataFrame(texts, SHAPE).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(i, int(i < 1000)) for i in rows]
    spark.createDataFrame(marks, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = pipeline.run(spark, str(tmp_path)).toPandas()
    whole = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    assert set(got.doc_id) == set(left)
    for name, pieces in got.sort_values("start").groupby("doc_id"):
        ids = np.concatenate([np.frombuffer(p, "<u4") for p in pieces.ids])
        assert ids.tolist() == [*whole.encode(left[name], add_special_tokens=False).ids, 0]
        assert pieces.start.tolist() == (pieces.length.cumsum() - pieces.length).tolist()
    lengths = got.groupby("sequence_id").length.sum()
    assert lengths.max() <= 1024
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == (own.length.cumsum() - own.length).tolist()


def test_scores_are_those_of_a_plain_discriminant(spark):
    rnd = random.Random(13)
    rows, marks = [], []
    for i in range(400):
        fine = rnd.random() < 0.6
        text = words(rnd, rnd.randint(20, 120)) if fine else words(rnd, rnd.randint(20, 120), "xyz1#  ")
        rows.append((i, text if rnd.random() < 0.8 else text.upper()))
        marks.append((i, int(fine != (rnd.random() < 0.15))))
    import pyarrow as pa
    from tablehaul.llm.words import slices

    x = np.concatenate([quality.features(data, at) for _, data, at in slices(pa.array([t for _, t in rows]))])
    known = np.array([i % 3 > 0 for i, _ in rows])
    y = np.array([m for _, m in marks])
    centre, scale = x[known].mean(0), np.sqrt(np.maximum(x[known].var(0), 1e-6))
    size = np.expm1(x[:, -1:])
    z = (x - centre) / scale * (size / (size + quality.AVERAGE_WORDS))
    groups = [z[known & (y == k)] for k in (0, 1)]
    share = [len(g) / known.sum() for g in groups]
    covariances = [np.cov(g.T, bias=True) for g in groups]
    pooled = share[0] * covariances[0] + share[1] * covariances[1]
    densities = []
    for k in (0, 1):
        drawn = (1 - quality.TO_POOLED) * covariances[k] + quality.TO_POOLED * pooled
        n = len(drawn)
        whole = (1 - quality.TO_SPHERE) * drawn + quality.TO_SPHERE * np.trace(drawn) / n * np.eye(n) + 1e-6 * np.eye(n)
        away = z - groups[k].mean(0)
        distance = (away * np.linalg.solve(whole, away.T).T).sum(1)
        densities.append(np.log(share[k]) - 0.5 * distance - 0.5 * np.linalg.slogdet(whole)[1])
    want = 1 / (1 + np.exp(-np.clip(densities[1] - densities[0], -500, 500)))
    labels = spark.createDataFrame([m for m, k in zip(marks, known) if k], "doc_id long, quality int")
    got = dict(quality.quality_scores(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect())
    assert np.abs(np.array([got[i] for i, _ in rows]) - want).max() < 1e-6 and 0.05 < want.std()
