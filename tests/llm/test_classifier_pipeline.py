import corpus_pipeline
import sentencepiece as library
from conftest import rows_of
from pyspark.sql import functions as F

from sparley.llm import mixing, quality_classifier, quality_rules, sentencepiece
from sparley.llm.common import hashed_words, materialise

SF = "/root/testdata/sf0.01"


def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_accuracy(spark):
    docs, labels = tables(spark)
    test = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    judged = quality_classifier.judge(docs, labels.filter(~test)).join(labels.filter(test), "doc_id")
    rows = judged.select("kept", "quality").collect()
    right = sum(r["kept"] == (r["quality"] == 1) for r in rows)
    good = [r["kept"] for r in rows if r["quality"] == 1]
    assert len(rows) > 60 and right >= 0.95 * len(rows) and sum(good) >= 0.98 * len(good)


def test_classifier_is_repeatable_and_keeps_columns(spark):
    docs, labels = tables(spark)
    once, again = (quality_classifier.judge(docs, labels).select("doc_id", "p_quality") for _ in range(2))
    assert rows_of(once) == rows_of(again)
    assert quality_classifier.keep(docs, labels).columns == docs.columns


def test_classifier_edge_cases(spark):
    docs, labels = tables(spark)
    odd = spark.createDataFrame([(-1, None, None, None, None), (-2, "", "xx", "?", -5), (None, "word " * 40_000, "en", "src0", 3), (-2, "", "xx", "?", -5)], docs.schema)
    got = quality_classifier.judge(docs.unionByName(odd).withColumns({"label": F.lit("clash"), "kept": F.lit("clash")}), labels)
    assert got.count() == docs.count() + 4 and got.filter("p_quality IS NULL OR p_quality < 0 OR p_quality > 1 OR label <> 'clash'").count() == 0
    nothing = quality_classifier.judge(docs, labels.limit(0))
    assert nothing.filter("kept AND p_quality = 1").count() == docs.count()
    assert quality_classifier.judge(docs.limit(0), labels).count() == 0
    assert quality_classifier.judge(docs.select("doc_id", "text"), labels).count() == docs.count()


def newton(xs, ys, ridge=0.05, steps=30):
    """The probability by logistic regression on columns of spread one, solved by elimination."""
    import math

    d, n = len(xs[0]), len(xs)
    means = [sum(x[j] for x in xs) / n for j in range(d)]
    spread = [max(math.sqrt(sum((x[j] - means[j]) ** 2 for x in xs) / n), 1e-9) for j in range(d)]
    rows = [[1.0, *(x[j] / spread[j] for j in range(d))] for x in xs]
    w = [0.0] * (d + 1)
    p_of = lambda z: 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))
    for _ in range(steps):
        p = [p_of(sum(a * b for a, b in zip(w, r, strict=True))) for r in rows]
        m = [[sum(r[i] * r[j] * q * (1 - q) for r, q in zip(rows, p, strict=True)) + (ridge if i == j else 0.0) for j in range(d + 1)] + [sum(r[i] * (q - y) for r, q, y in zip(rows, p, ys, strict=True)) + ridge * w[i]] for i in range(d + 1)]
        for i in range(d + 1):
            top = max(range(i, d + 1), key=lambda k: abs(m[k][i]))
            m[i], m[top] = m[top], m[i]
            for k in range(d + 1):
                if k != i:
                    f = m[k][i] / m[i][i]
                    m[k] = [a - f * b for a, b in zip(m[k], m[i], strict=True)]
        w = [a - m[i][d + 1] / m[i][i] for i, a in enumerate(w)]
    return lambda x: p_of(w[0] + sum(a * b / s for a, b, s in zip(w[1:], x, spread, strict=True)))


def plain_cotraining(docs, labels, rounds=quality_classifier.ROUNDS, sure=quality_classifier.SURE):
    """The method once more, document by document, with dicts instead of arrays; p_quality by doc_id."""
    import math
    import re
    import zlib

    import pyarrow as pa
    q = quality_classifier
    bucket_of = {}

    def bucket(word):
        if word not in bucket_of:
            bucket_of[word] = int(hashed_words(pa.array([word]))[0][0]) % q.WORD_BUCKETS
        return bucket_of[word]

    def features(row):
        text = row["text"] or ""
        words = [bucket(w) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
        data = text.encode()
        pairs = [data[k] << 8 | data[k + 1] for k in range(len(data) - 1)]
        again = [sum(any(words[i] == words[i - j] for j in range(1, back + 1) if i >= j) for i in range(len(words))) / max(len(words) + q.SHRINK, 1) for back in (1, 3)]
        n = row["n_chars"]
        meta = ["null" if row["source"] is None else f"={row['source']}", "null" if row["lang"] is None else f"={row['lang']}", "null" if n is None or n < 0 else str(int(2 * math.log2(n + 1)))]
        return {"id": row["doc_id"], "words": words, "pairs": pairs, "again": again, "meta": [zlib.crc32((c + v).encode()) % q.META_BUCKETS for c, v in zip(q.META, meta, strict=True)]}

    rows = [features(r) for r in docs]
    by_id = {r["id"]: r for r in rows}
    known = sorted((i for i in labels if i in by_id), key=lambda i: (i * 0x9E3779B97F4A7C15 & (1 << 64) - 1, i))
    held, learnt = known[::3], [i for k, i in enumerate(known) if k % 3]

    def count(chosen, part):
        out = {}
        for r in chosen:
            values = enumerate(r["meta"]) if part == "meta" else r[part]
            for v in values:
                out[v] = out.get(v, 0.0) + (1.0 if part == "meta" else 1.0 / len(r[part]))
        return out

    def ratio(good, bad, keys, size, add):
        total = [sum(c.get(k, 0.0) for k in keys) + add * size for c in (good, bad)]
        return lambda k: math.log((good.get(k, 0.0) + add) / total[0]) - math.log((bad.get(k, 0.0) + add) / total[1])

    def scaled(c, k):
        return {v: k * n for v, n in c.items()}

    def plus(a, b, k):
        return {v: a.get(v, 0.0) + k * b.get(v, 0.0) for v in a.keys() | b.keys()}

    told = {"text": ([], []), "meta": ([], [])}  # to either view, bad and good documents
    for turn in range(rounds + 1):
        sums = []
        for c in (0, 1):
            own = [by_id[i] for i in learnt if labels[i] == c]
            one = {}
            for part, view in (("words", "text"), ("pairs", "text"), ("meta", "meta")):
                extra = told[view][c]
                one[part] = plus(count(own, part), count(extra, part), min(1.0, len(own) / len(extra)) if extra else 0.0)
            sums.append(one)
        bad, good = sums
        words = ratio(scaled(good["words"], 100), scaled(bad["words"], 100), good["words"].keys() | bad["words"].keys(), q.WORD_BUCKETS, 1.0)
        pairs = ratio(scaled(good["pairs"], 100), scaled(bad["pairs"], 100), good["pairs"].keys() | bad["pairs"].keys(), q.BYTE_PAIRS, 0.05)
        met = [{v for v in good["meta"].keys() | bad["meta"].keys() if v[0] == k} for k in range(3)]
        metas = [ratio(good["meta"], bad["meta"], met[k], len(met[k]), 1.0) for k in range(3)]
        x = {r["id"]: [sum(map(words, r["words"])) / (len(r["words"]) + q.SHRINK), sum(map(pairs, r["pairs"])) / (len(r["pairs"]) + 5 * q.SHRINK), *r["again"]] for r in rows}
        m = {r["id"]: [sum(metas[k]((k, v)) for k, v in enumerate(r["meta"]) if (k, v) in met[k])] for r in rows}
        text = newton([x[i] for i in held], [labels[i] for i in held])
        meta = newton([m[i] for i in held], [labels[i] for i in held])
        if turn < rounds:
            free = [r for r in rows if r["id"] not in set(known)]
            told = {"text": ([r for r in free if meta(m[r["id"]]) <= 1 - sure], [r for r in free if meta(m[r["id"]]) >= sure]), "meta": ([r for r in free if text(x[r["id"]]) <= 1 - sure], [r for r in free if text(x[r["id"]]) >= sure])}
    logit = lambda p: math.log(min(max(p, 1e-6), 1 - 1e-6) / (1 - min(max(p, 1e-6), 1 - 1e-6)))
    views = {i: [logit(text(x[i])), logit(meta(m[i]))] for i in by_id}
    both = newton([views[i] for i in held], [labels[i] for i in held])
    return {i: both(views[i]) for i in by_id}, sum(map(len, told["text"])), sum(map(len, told["meta"]))


def test_matches_plain_cotraining(spark):
    import random

    chance = random.Random(7)
    rows, labels = [], {}
    for k in range(260):
        good = chance.random() < 0.7
        words = [chance.choice("the of plain clear sentence water house green".split()) if good or chance.random() < 0.3 else chance.choice("BUY!!! $$$ click click now xxx".split()) for _ in range(chance.randrange(5, 60))]
        rows.append((k, " ".join(words), chance.choice("en de".split()), f"src{chance.randrange(3) + (0 if good or chance.random() < 0.2 else 5)}", len(" ".join(words))))
        if k % 2:
            labels[k] = int(good)
    rows += [(1000, None, None, None, None), (1001, "", "xx", "src9", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    marks = spark.createDataFrame(list(labels.items()), "doc_id long, quality int")
    want, by_meta, by_text = plain_cotraining([r.asDict() for r in docs.collect()], labels)
    got = {r["doc_id"]: r["p_quality"] for r in quality_classifier.judge(docs, marks).collect()}
    assert by_text > 20 and by_meta > 0  # the views do exchange labels
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-3 for i in got)


def test_an_id_that_repeats_is_learnt_from_once(spark):
    docs, labels = tables(spark)
    one = labels.filter("quality = 0").first()["doc_id"]
    many = docs.unionByName(docs.filter(F.col("doc_id") == one).crossJoin(spark.range(3000)).drop("id"))
    once, again = (quality_classifier.judge(d, labels, rounds=0).select("doc_id", "p_quality").distinct() for d in (docs, many))
    assert rows_of(once) == rows_of(again)


def test_pipeline_stage_by_stage(spark):
    """Each stage against a reading of what it was given, and run() against the stages."""
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "quality_rules", "near_dedup", "mixing", "sentencepiece"]
    docs, labels = tables(spark)
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(materialise(stage(spark, steps[-1], SF), "test"))
    read, good, clean, single, mixed, encoded = steps
    for df in (good, clean, single, mixed):
        assert df.columns == read.columns
    assert rows_of(good.select("doc_id")) == rows_of(quality_classifier.judge(read, labels).filter("kept").select("doc_id"))
    judged = {r["doc_id"]: r for r in quality_rules.judge(good).collect()}
    assert rows_of(clean.select("doc_id", "text")) == sorted(((k, r["clean_text"]) for k, r in judged.items() if r["kept"]), key=repr)
    # Near-duplicates by all pairs of sets.
    from test_near_dedup import brute

    kept = [i for _, i, stays, _ in brute([(r["doc_id"], r["text"]) for r in clean.collect()]) if stays]
    assert sorted(r["doc_id"] for r in single.select("doc_id").collect()) == sorted(kept)
    # Every source has the words that the mix takes of it, of whole documents and excerpts.
    words = F.coalesce(F.regexp_count("text", F.lit(mixing.WORD)), F.lit(0))
    taken = {r["doc_id"]: (r["taken"], r["size"], r["target"], r["source"]) for r in mixing.mix(single).collect()}
    had = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.sum(words).alias("n")).collect()}
    assert had == {k: t for k, (t, *_) in taken.items() if t}
    by = {}
    for t, _, target, source in taken.values():
        x = by.setdefault(source, [0, target])
        x[0] += t
    assert all(abs(t - target) <= 2 * mixing.BLOCK for t, target in by.values())
    originals = {r["doc_id"]: r["text"] for r in single.collect()}
    assert all(r["text"] in originals[r["doc_id"]] for r in mixed.collect())
    model = library.SentencePieceProcessor(model_file=sentencepiece.MODEL)
    texts = sorted((r["doc_id"], model.encode(r["text"])) for r in mixed.collect())
    assert all(r["round_trip"] for r in encoded.collect())
    assert sorted((r["doc_id"], list(r["piece_ids"])) for r in encoded.collect()) == texts
    assert rows_of(corpus_pipeline.run(spark, SF).select("doc_id", "n_pieces")) == rows_of(encoded.select("doc_id", "n_pieces"))


def test_stages_take_odd_rows(spark):
    """Nulls in any column, empty and long texts, repeated rows and ids, extra columns."""
    docs, _ = tables(spark)
    long = " ".join(f"word{k % 977} of{k % 31}" for k in range(30_000))
    odd = [(None, None, None, None, None), (-1, None, "en", "src1", 3), (-1, "", "en", "src1", 3), (-1, long, None, None, None), (None, long + " more", "en", "src1", 5), (-2, long, "en", "src1", 5), (-2, long, "en", "src1", 5)]
    more = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumns({"kept": F.lit("mine"), "size": F.lit("mine"), "cid": F.lit("mine"), "n_words": F.lit("mine"), "taken": F.lit("mine")})
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, more, SF), "test")
        if name != "sentencepiece":
            assert out.columns == more.columns and out.filter("kept <> 'mine' OR size <> 'mine' OR cid <> 'mine' OR n_words <> 'mine' OR taken <> 'mine'").isEmpty()
        assert out.count() > 0
        if name == "near_dedup":
            assert out.filter("text IS NULL OR text = ''").count() == 3 and out.filter(F.length("text") > 100_000).count() == 1


def test_stages_take_empty_tables(spark):
    docs, _ = tables(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
