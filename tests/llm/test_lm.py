import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from sparley.llm import lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """The model in plain dictionaries."""
    text = {k: WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) + [None] for k, t in rows}
    train = [k for k in text if zlib.crc32(str(k).encode()) % 5 != 1]
    one, two, three = Counter(), Counter(), Counter()
    for k in train:
        s = ["<s>", *text[k]]
        one.update(s[1:])
        two.update(zip(s, s[1:], strict=False))
        three.update(zip(s, s[1:], s[2:], strict=False))
    n, v = sum(one.values()), len(one)
    seen, kinds = Counter(), Counter()
    for (a, _), c in two.items():
        seen[a] += c
        kinds[a] += 1
    three = {g: c for g, c in three.items() if c >= lm.LEAST_TRIPLES}
    rest = defaultdict(lambda: 1.0)
    for (a, b, _), c in three.items():
        rest[a, b] -= (c - lm.DISCOUNT) / two[a, b]
    p1 = lambda w: (one[w] + 0.5) / (n + 0.5 * (v + 1))

    def p2(a, w):
        return max(two[a, w] - lm.DISCOUNT, 0) / seen[a] + lm.DISCOUNT * kinds[a] / seen[a] * p1(w) if a in seen else p1(w)

    def p3(a, b, w):
        if (a, b) not in two:
            return p2(b, w)
        return max(three.get((a, b, w), 0) - lm.DISCOUNT, 0) / two[a, b] + rest[a, b] * p2(b, w)

    out = {}
    for k, s in text.items():
        full = ["<s>", *s]
        score = math.log10(p2("<s>", s[0])) + sum(math.log10(p3(*full[j - 2 : j + 1])) for j in range(2, len(full)))
        out[k] = (zlib.crc32(str(k).encode()) % 5 == 1, len(s), sum(one[w] > 0 for w in s), n, sum(math.log10(p1(w)) for w in s), score)
    return out


def test_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()] + [(10_000, None), (10_001, ""), (10_002, "the of the of the of unseenword"), (10_003, "Ab ab AB é")]
    want = brute(rows)
    for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        held, n, known, total, base, score = want[r["doc_id"]]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert r["base_score"] == pytest.approx(base, abs=1e-6)
        assert abs(r["score"] - score) <= 1e-3 * n  # quantised to steps of 1 / 2048


def test_triples_seen_once_count(spark, monkeypatch):
    monkeypatch.setattr(lm, "LEAST_TRIPLES", 1)  # brute() leaves none out
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 5 == 1)
    rows = [(k, "p q r p q s p q r") for k in range(held)] + [(held, "u v w x y z"), (200, "u v w x y z"), (201, "v w z u v x")]
    assert zlib.crc32(b"200") % 5 != 1
    want = brute(rows)
    for r in lm.score(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        assert abs(r["score"] - want[r["doc_id"]][-1]) <= 1e-3 * r["n_tokens"]


def test_edge_cases(spark):
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None), (2, "x " * 30_000)], "doc_id long, text string").selectExpr("*", "1 AS held_out", "2 AS score")
    got = lm.score(docs).collect()
    assert len(got) == 4 and all(r["base_score"] <= 0 and r["score"] <= 1e-9 for r in got)
    assert lm.score(docs.limit(0)).count() == 0


def test_without_training_rows_all_is_certain(spark):
    held = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 5 == 1)
    row = lm.score(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row["held_out"], row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"], row["score"]) == (True, 3, 0, 0, 0.0, 0.0)


def test_elias_fano_reads_and_finds():
    chance = np.random.Generator(np.random.PCG64(3))
    for top in (1, 7, 1000, 1 << 40, (1 << 63)):
        for n in (0, 1, 2, 63, 64, 65, 3000):
            values = np.sort(chance.integers(0, top, n, dtype=np.uint64))
            code = lm.EliasFano.of(values)
            assert (code.access(np.arange(n)) == values).all()
            distinct, first = np.unique(values, return_index=True)
            assert (code.find(distinct) == first).all()
            strange = np.setdiff1d(chance.integers(0, 2 * top, 200, dtype=np.uint64), distinct)
            assert (code.find(strange) == -1).all()


def test_probabilities_sum_to_one(spark):
    rows = [(k, t) for k, t in enumerate(["a b a b a c", "a b c", "b a b a b a", "c c a", "a b a", "a b"] * 2)]
    trie = lm.train(spark.createDataFrame(rows, "doc_id long, text string"), lm.fresh_dir(spark, "lm-test"), shards=3)
    import pyarrow as pa

    contexts = ["a b", "b a", "c", "a", "b"]
    for context in contexts:
        total = 0.0
        for w in ("a", "b", "c", "neverseen"):
            hashes, offsets = lm.tokens(pa.array([f"{context} {w}"]))
            ids = trie.word_ids(hashes)
            total += 10 ** lm.score_tokens(trie, ids, offsets, trie.word_counts(ids))[len(context.split())]
        hashes, offsets = lm.tokens(pa.array([context]))
        ids = trie.word_ids(hashes)
        total += 10 ** lm.score_tokens(trie, ids, offsets, trie.word_counts(ids))[-1]
        assert total == pytest.approx(1, abs=5e-3)
