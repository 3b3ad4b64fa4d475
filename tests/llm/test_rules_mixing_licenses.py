"""The native operators on small tables."""

import re

import pytest
from conftest import SF, rows_of
from pyspark.sql import functions as F

from sparley.llm import licenses, mixing, quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    inside = {k + j for k, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(inside), n < 50 or 100 * len(inside) > 50 * n)


PROSE = " ".join(f"word{k}" for k in range(120)) + "."
TEXTS = [None, "", " \n\t", "a b c a b c a b", "x\nx\n\nx \n", PROSE, PROSE + "\n" + "| ".join(["home"] * 9), "a|b " * 80, "é🎉 " * 60, "\x0b\x0cword\x1cother\x85x", "la la la la la " * 30, PROSE + "\nAll rights reserved.\n####", "k" * 100_000]


def test_base_counts(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = {r["doc_id"]: tuple(r[n] for n in names) for r in quality_rules.judge(docs).collect()}
    assert got == {k: base(t) for k, t in enumerate(TEXTS)}


def test_lines_go_and_documents_follow(spark):
    junk = "home | news | sport | more\n" * 3
    rows = [(1, PROSE, 9), (2, PROSE + "\n" + junk + "###\nClick here to subscribe\n", 9), (3, PROSE[:300] + "\n" + "### %%% $$$ word\n" * 60 + PROSE, 9), (4, None, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_chars int")
    assert rows_of(quality_rules.clean(docs).select("doc_id", "kept_chars")) == [(1, 9), (2, 9)]
    assert rows_of(quality_rules.clean(docs).filter("doc_id = 2").select("text")) == [(PROSE + "\n",)]
    assert quality_rules.judge(docs).filter("doc_id = 3").first()["kept"] is False
    assert quality_rules.clean(docs.limit(0)).count() == 0


def shares(spark, rows, **options):
    return mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), **options)


def test_mix_targets_and_limits(spark):
    rows = [(k, "w " * (1 + k % 50), f"s{k % 4}" if k % 4 else None) for k in range(2000)] + [(9000, "w " * 40, "aa"), (9001, None, "s1"), (9001, None, "s1"), (None, "w w", "s2")]
    got = shares(spark, rows, shard_words=2000).collect()
    assert len(got) == len(rows) and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    total, by = sum(r["size"] for r in got), {}
    for r in got:
        s = by.setdefault(r["source"], [0, 0, r["target"], r["source_size"]])
        s[0] += r["taken"]
        s[1] += r["size"]
    # By hand: aa (weight 5) is capped at 120 words; s1, s2, s3 weigh 2, 1, 5 and null, last, 2.
    assert by["aa"][2] == 120 and by["aa"][3] == 40
    rest = total - 120
    assert by["s1"][2] == pytest.approx(rest * 2 / 10) and by["s3"][2] == pytest.approx(rest * 5 / 10) and by[None][2] == pytest.approx(rest * 2 / 10)
    for taken, size, target, source_size in by.values():
        assert size == source_size and abs(taken - target) <= max(0.02 * target, 64)
    again = shares(spark, rows, shard_words=2000)
    assert rows_of(again.select("doc_id", "size", "taken")) == sorted(((r["doc_id"], r["size"], r["taken"]) for r in got), key=repr)


def test_apportionment_is_that_of_highest_quotients(spark):
    votes = [(k, 1, float(v), 137) for k, v in enumerate([340, 280, 160, 60, 15, 15, 3, 0])]
    got = mixing.apportion(spark.createDataFrame(votes, "o long, g int, v double, seats long"), "g", "v", "seats", "o")
    quotients = sorted(((-v / (2 * i + 1), k) for k, _, v, _ in votes for i in range(137) if v > 0))[:137]
    assert {r["o"]: r["quota"] for r in got.collect()} == {k: sum(j == k for _, j in quotients) for k, *_ in votes}


def words_of(df):
    n = F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0))
    return {r["source"]: r["n"] for r in df.groupBy("source").agg(F.sum(n).alias("n")).collect()}


def test_repeat_gives_each_source_the_words_of_the_mix(spark):
    rows = [(k, f"  {'é ' * (1 + k % 40)}end{k}\n\nlast\t", f"s{k % 4}" if k % 4 else None, 0) for k in range(300)]
    rows += [(9000, " ".join(f"long{k}" for k in range(6000)), "s1", 5), (9000, "twice the id", "s1", 5), (9000, "twice the id", "s1", 5), (None, "no id here", "s2", 5), (None, "nor here", "s2", 5), (7, None, "s1", 1), (8, " ", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int")
    taken = {r["source"]: r["t"] for r in mixing.mix(docs, shard_words=500).groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    out = mixing.repeat(docs, shard_words=500)
    assert words_of(out) == {s: t for s, t in taken.items() if t}
    texts = {}
    for k, text, source, _ in rows:
        texts.setdefault((k, source), []).append(text or "")
    whole = cut = 0
    for r in out.collect():
        own = texts[r["doc_id"], r["source"]]
        whole += r["text"] in own
        cut += r["text"] not in own
        assert any(r["text"] in t for t in own) and (r["text"] in own or r["n_chars"] == len(r["text"]))
    assert whole > 5 * cut > 0
    assert mixing.repeat(docs.limit(0)).count() == 0


def test_many_sources_and_shards(spark):
    rows = [(k, "w " * (1 + k % 7), f"site{k % 900}") for k in range(4000)]
    for options in ({"shard_words": 10}, {"shard_words": 3000}):
        got = shares(spark, rows, **options).collect()
        total = sum(r["size"] for r in got)
        by = {}
        for r in got:
            x = by.setdefault(r["source"], [0, r["target"], r["source_size"]])
            x[0] += r["taken"]
        # The level by hand: weights 5, 2, 1 by code point, filled up to three times the size.
        weights = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(sorted(by))}
        low, high = 0.0, float(total)
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(min(3 * x[2], weights[s] * mid) for s, x in by.items()) < total else (low, mid)
        assert len(by) == 900 and all(x[1] == pytest.approx(min(3 * x[2], weights[s] * low)) and abs(x[0] - x[1]) <= 2 * mixing.BLOCK for s, x in by.items())


def test_apportionment_among_all_is_that_within_a_group(spark):
    votes = [(k, 1, float(1 + k * k % 97), 500) for k in range(300)]
    df = spark.createDataFrame(votes, "o long, g int, v double, seats long")
    assert rows_of(mixing.apportion(df, None, "v", "seats", "o")) == rows_of(mixing.apportion(df, "g", "v", "seats", "o"))


def test_mix_edge_cases(spark):
    assert shares(spark, []).count() == 0
    assert rows_of(shares(spark, [(1, None, None), (2, "", "a")]).select("doc_id", "taken", "target")) == [(1, 0, 0.0), (2, 0, 0.0)]
    docs = spark.createDataFrame([(1, "w " * 100, "a", 5), (1, "w " * 100, "a", 5), (2, "w " * 100, "b", 6)], "doc_id long, text string, source string, size int")
    out = mixing.repeat(docs)
    assert out.columns == docs.columns and out.select(F.sum("size")).first()[0] > 0


def test_licences(spark):
    mit = licenses._MIT_GRANT
    wrapped = "/* Copyright (c) 2020 Someone\n * All Rights Reserved\n */\n" + mit.replace(" ", "\n", 40).replace("sublicense", "sub-licence").upper()
    rows = [(1, mit, 0), (2, wrapped, 0), (3, mit + " extra", 0), (4, None, 0), (5, "...", 0), (6, "Some text.\nReleased under the MIT Licence\nLicensed under the Apache License, version 2.0!", 0), (6, "Some text.\nReleased under the MIT Licence\nLicensed under the Apache License, version 2.0!", 0), (None, "x " * 50_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, digest int")
    got = [(r["doc_id"], r["license_id"], r["n_notices"], r["notices"]) for r in licenses.scan(docs).collect()]
    assert sorted(got, key=repr) == sorted([(1, "MIT", 0, ""), (2, "MIT", 0, ""), (3, None, 0, ""), (4, None, 0, ""), (5, None, 0, ""), (6, None, 2, "Apache-2.0,MIT"), (6, None, 2, "Apache-2.0,MIT"), (None, None, 0, "")], key=repr)
    assert licenses.scan(docs.limit(0)).count() == 0
    assert licenses.known(spark).groupBy("digest").count().filter("count > 1").count() == 0


def test_long_licences_are_known_by_their_digests(spark):
    import pathlib

    folder = pathlib.Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    if not all((folder / n).exists() for n in names):
        pytest.skip("this system has no licence texts")
    texts = {n: (folder / n).read_text() for n in names}
    rows = [(k, texts[n]) for k, n in enumerate(names)] + [(100 + k, "\n".join("// " + x.strip().upper() for x in texts[n].split("\n"))) for k, n in enumerate(names)] + [(200, texts["GPL-3"] + "and more")]
    got = {r["doc_id"]: r["license_id"] for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {k: i for k, i in enumerate(names.values())} | {100 + k: i for k, i in enumerate(names.values())} | {200: None}


def test_lines_are_hash_joined(spark):
    plan = licenses.scan(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "try_element_at" not in plan


def test_every_known_line_is_a_notice(spark):
    lines = [(k, i, t) for k, (i, t) in enumerate(licenses.LICENSES) if "\n" not in t]
    docs = spark.createDataFrame([(k, f"Some text.\n  {t.upper()}\nMore text.") for k, _, t in lines], "doc_id long, text string")
    got = {r["doc_id"]: (r["n_notices"], r["notices"]) for r in licenses.scan(docs).collect()}
    assert len(lines) > 100 and got == {k: (1, i) for k, i, _ in lines}
