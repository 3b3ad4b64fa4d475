import numpy as np
from conftest import SF
from pyspark.sql import functions as F

from sparley.llm import ann, queries


def nearest(ids, x, query, k=20):
    score = ann.exact(x, x[query])
    order = np.lexsort((ids, -score))
    return [(int(ids[i]), float(score[i])) for i in order if i != query][:k]


def test_recall_and_scores(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float)
    found = {}
    for r in queries.op4_ann(spark, SF).collect():
        found.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        true, got = nearest(ids, x, q), [found[ids[q]][k] for k in sorted(found[ids[q]])]
        hits += len({i for i, _ in true} & {i for i, _ in got})
        total += len(true)
        at = {int(i): k for k, i in enumerate(ids)}
        assert all(s == ann.exact(x[[at[i]]], x[q])[0] for i, s in got)
        assert got == sorted(got, key=lambda p: (-p[1], p[0]))
    assert hits >= 0.9 * total


def test_recall_of_random_vectors_and_many_copies(spark):
    chance = np.random.Generator(np.random.PCG64(2))
    x = chance.normal(size=(3000, 32)) * chance.uniform(0.5, 2, size=(3000, 1))
    x[1000:2000] = x[1000]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 50 == 0, rerank=300).collect():
        got.setdefault(r["query_id"], []).append(r["vec_id"])
    ids = np.arange(len(x))
    hits = sum(len(set(got[q]) & {i for i, _ in nearest(ids, x, q)}) for q in got)
    assert len(got) == 60 and hits >= 0.9 * 20 * len(got)


def test_near_copies_in_a_full_run_are_told_apart():
    chance = np.random.Generator(np.random.PCG64(6))
    x = chance.normal(size=(ann.RUN, 64))
    x[::3] = x[0] + chance.normal(size=x[::3].shape) * 0.05 / 8
    x = x.astype(np.float32)
    ids, asked = np.arange(len(x)), np.arange(0, 3 * 16, 2)
    quantiser = ann.Quantiser.fit(x[: ann.SAMPLE].astype(float))
    for own, found, scores in ann.search_run(quantiser, ids, quantiser.encode(x), x, asked, x[asked], ann.NEAREST, ann.RERANK):
        assert list(zip(found.tolist(), scores.tolist(), strict=True)) == nearest(ids, x.astype(float), own)


def test_anisotropic_loss_lowers_the_parallel_error():
    chance = np.random.Generator(np.random.PCG64(4))
    x = chance.normal(size=(2000, 16))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    errors = []
    for threshold in (0.0, 0.4):
        q = ann.Quantiser.fit(x, threshold)
        packed = q.encode(x)
        codes = np.stack([packed & 15, packed >> 4], axis=2).reshape(len(x), -1)
        residual = x - q._decoded(codes).reshape(len(x), -1)
        errors.append(((residual * unit).sum(axis=1) ** 2).mean())
    assert errors[1] < 0.8 * errors[0]


def test_edge_cases(spark):
    rows = [(0, [1.0, 0.0], 0), (20, [1.0, 0.0], 1), (1, [2.0, 0.0], 2), (1, [2.0, 0.0], 3), (3, None, 4), (4, [0.0, 0.0], 5), (5, [float("nan"), 1.0], 6), (6, [None, 1.0], 7), (7, [float("inf"), 1.0], 8), (None, [1.0, 1.0], 9), (40, None, 10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in ann.search(df, F.col("vec_id") % 20 == 0).collect()}
    assert got == {(0, 1): (1, 2.0), (0, 2): (1, 2.0), (0, 3): (20, 1.0), (20, 1): (1, 2.0), (20, 2): (1, 2.0), (20, 3): (0, 1.0)}
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_vectors_of_several_lengths_search_among_their_own(spark):
    chance = np.random.Generator(np.random.PCG64(9))
    rows = [(k, chance.normal(size=3).tolist()) for k in range(200)] + [(k, chance.normal(size=2).tolist()) for k in range(1000, 1005)]
    for first in (rows, rows[::-1]):
        df = spark.createDataFrame(first, "vec_id long, embedding array<double>")
        got = {}
        for r in sorted(ann.search(df, F.col("vec_id") % 20 == 0).collect(), key=lambda r: r["rank"]):
            got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        own = np.arange(200), np.array([v for _, v in rows[:200]])
        assert all(got[q] == nearest(*own, q) for q in range(0, 200, 20))
        assert {i for i, _ in got[1000]} == {1001, 1002, 1003, 1004} and len(got) == 11


def test_recall_of_a_full_run(spark):
    chance = np.random.Generator(np.random.PCG64(8))
    x = chance.normal(size=(ann.RUN, 64)).astype(np.float32)
    ids, asked = np.arange(len(x)), np.arange(0, 40 * 20, 20)
    quantiser = ann.Quantiser.fit(x[: ann.SAMPLE].astype(float))
    codes, hits = quantiser.encode(x), 0
    # The candidates of the four-bit scan alone, before the exhaustive step for those that its bounds leave open.
    for own, table in zip(asked, quantiser.tables(x[asked].astype(float)), strict=True):
        rough = sum(t[c] for t, c in zip(table, codes.T, strict=True))
        best = np.argsort(-rough)[: ann.RERANK + 1]
        hits += len({i for i, _ in nearest(ids, x.astype(float), own)} & set(best.tolist()))
    assert hits >= 0.9 * 20 * len(asked)
