"""Mixing sources to target weights by Sainte-Laguë apportionment.

The mix is made of equal blocks of BLOCK words. Seats (blocks) go to sources by
highest quotients target / (2 i + 1), then, within a source, in the same way to its
areas of AREA shards, and within an area to its shards. A shard holds about SHARD_WORDS
words, so there are as many as a source needs. Each shard lines its documents up by a
seeded digest and takes its quota as whole passes over the line plus one run of blocks
from a seeded offset, so what a document gives is interval arithmetic and no block is
ever a row. Totals over all sources are added up range by range, not in one task.

`repeat` gives the documents themselves: whole ones, and where a run of blocks begins or
ends inside of one, an excerpt of the words that the mix takes, so that a source has the
words of its target and not the nearest sum of whole documents.

Defined results: a null source is one source, last in order; a null or blank text has
size 0 and is taken 0 times; repeated rows are documents of their own; a null doc_id has
its place by its text; equal quotients go to the source or shard that comes first; an
empty table gives an empty result. Extra columns are ignored by `mix` and kept by `repeat`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import FILE, ROW, WHITE, WORD, addressed, materialise

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BLOCK = 32
#: Words a shard holds about, and shards of an area.
SHARD_WORDS = 262_144
AREA = 4096
#: Areas of a source that a number of source and area has room for.
AREAS = 1 << 24


def sizes_of(docs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    id_ = F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(F.coalesce("text", F.lit("")))))
    return docs.select("doc_id", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), "source", id_.alias("id"), *keys)


def running(df: DataFrame, order: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """df with each sum (an SQL expression) over the rows before a row in `order`, which
    tells all rows apart. Rows are added up within ranges, and ranges by their totals."""
    ranges = materialise(df.repartitionByRange(*(F.expr(o) for o in order)).withColumn("range_", F.spark_partition_id()), "mix-ranges")
    inner = Window.partitionBy("range_").orderBy(*(F.expr(o) for o in order)).rowsBetween(Window.unboundedPreceding, -1)
    outer = Window.orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    totals = ranges.groupBy(F.col("range_").alias("of_")).agg(*(F.sum(F.expr(e)).alias(f"{n}_") for n, e in sums.items()))
    totals = totals.withColumnRenamed("of_", "range_").select("range_", *(F.coalesce(F.sum(f"{n}_").over(outer), F.lit(0)).alias(f"{n}_") for n in sums)).withColumnRenamed("range_", "of_")
    own = ranges.withColumns({n: F.coalesce(F.sum(F.expr(e)).over(inner), F.lit(0)) for n, e in sums.items()})
    return own.join(totals, F.col("range_") == F.col("of_")).withColumns({n: (F.col(n) + F.col(f"{n}_")).cast("long") for n in sums}).drop("range_", "of_", *(f"{n}_" for n in sums))


def targets(sizes: DataFrame, weights: Sequence[int], most: int) -> DataFrame:
    """A row for each source: source, s (its number), source_size, total and target.

    A source is capped at `most` times its size; as the sources fill up in the order of
    size / weight, the level at which the rest shares by weight is found in one pass.
    """
    weight = "CAST(element_at(array({}), CAST(before % {} + 1 AS INT)) AS BIGINT)".format(", ".join(map(str, weights)), len(weights))
    a = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    named = running(a.withColumn("last", F.col("source").isNull()), ["last", "source"], {"before": "1"})
    placed = materialise(named.selectExpr("source", "before + 1 AS s", "source_size", f"{weight} AS w", f"{most} * source_size AS cap").withColumn("fills", F.expr("cap / CAST(w AS DOUBLE)")), "mix-sources")
    filled = running(placed, ["fills", "s"], {"below": "cap", "lighter": "w"})
    totals = {"total": placed.agg(F.sum("source_size").cast("long")).scalar(), "all_w": placed.agg(F.sum("w")).scalar()}
    filled = materialise(filled.withColumns(totals).withColumn("share", F.expr("(total - below) / CAST(all_w - lighter AS DOUBLE)")), "mix-levels")
    # The level at which those that don't fill up share.
    level = filled.filter("share <= fills").agg(F.min(F.struct("fills", "s", "share")).alias("x")).select("x.share").scalar()
    return filled.withColumn("level", level).select("source", "s", "source_size", "total", F.expr("CASE WHEN fills < level THEN CAST(cap AS DOUBLE) ELSE w * level END").alias("target"))


def _allot(docs: DataFrame, keys: Sequence[str], weights: Sequence[int], most: int, block: int, seed: int, shard_words: int) -> DataFrame:
    """doc_id, source, size, source_size, target and keys of each row, how often the mix takes
    all of it (passes), and the spans of words that it takes besides: [from_1, to_1) where
    the shard's run meets it, [0, to_2) where the run has wrapped round."""
    spark = docs.sparkSession
    sizes = materialise(sizes_of(docs, keys), "mix-sizes")
    sources = targets(sizes, weights, most).withColumn("seats", F.expr(f"CAST(round(total / {float(block)}D) AS BIGINT)"))
    quotas = apportion(sources, None, "target", "seats", "s").withColumn("shards", F.expr(f"greatest(1L, CAST(ceil(source_size / {float(shard_words)}D) AS BIGINT))"))
    quotas = materialise(quotas.select("source", "s", "source_size", "target", "shards", F.col("quota").alias("source_quota")), "mix-quotas")
    carried = "".join(f", z.{k}" for k in keys)
    placed = spark.sql(
        f"""
        SELECT z.doc_id, z.source, z.size, q.s, q.source_size, q.target, q.source_quota, md5(concat('{seed}:', z.id)) AS m, q.shards{carried}
        FROM {{sizes}} z JOIN {{q}} q ON z.source <=> q.source""",
        sizes=sizes,
        q=quotas,
    ).selectExpr("*", "CAST(conv(substr(m, 1, 15), 16, 10) AS BIGINT) % shards AS shard")
    totals = placed.groupBy("s", "shard").agg(F.sum("size").cast("long").alias("shard_size"), F.first("source_quota").alias("seats"))
    totals = materialise(totals.withColumns({"votes": F.col("shard_size").cast("double"), "area": F.expr(f"s * {AREAS} + shard DIV {AREA}")}), "mix-shards")
    areas = totals.groupBy("s", "area").agg(F.sum("votes").alias("votes"), F.first("seats").alias("seats"))
    areas = apportion(areas, "s", "votes", "seats", "area").select(F.col("area").alias("of"), F.col("quota").alias("seats"))
    shares = apportion(totals.drop("seats").join(areas, F.col("area") == F.col("of")).drop("of"), "area", "votes", "seats", "shard")
    # Documents without words have no place in a line.
    line = spark.sql(
        "SELECT *, CAST(sum(size) OVER (PARTITION BY s, shard ORDER BY m, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS begin FROM {placed} WHERE size > 0",
        placed=placed,
    )
    # A shard's quota in words, never over `most` passes; its run starts at a seeded block and wraps round.
    names = ", ".join(["doc_id", "source", "size", "source_size", "target", *keys])
    return spark.sql(
        f"""
        WITH q AS (SELECT s AS qs, shard AS qshard, shard_size, least(quota * {block}, {most} * shard_size) AS quota_words FROM {{shares}}),
        x AS (SELECT l.*, shard_size, quota_words DIV shard_size AS whole, quota_words % shard_size AS run,
                     (CAST(conv(substr(md5(concat('{seed}/', CAST(s AS STRING), '/', CAST(shard AS STRING))), 1, 7), 16, 10) AS BIGINT)
                      % greatest(1, shard_size DIV {block})) * {block} AS off
              FROM {{line}} l JOIN q ON l.s = q.qs AND l.shard = q.qshard)
        SELECT {names}, CAST(whole AS BIGINT) AS passes,
               CAST(greatest(0, off - begin) AS BIGINT) AS from_1, CAST(least(size, off + run - begin) AS BIGINT) AS to_1,
               CAST(least(size, off + run - shard_size - begin) AS BIGINT) AS to_2
        FROM x
        UNION ALL SELECT {names}, 0L, 0L, 0L, 0L FROM {{placed}} WHERE size = 0""",
        shares=shares,
        line=line,
        placed=placed,
    )


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS, block: int = BLOCK, seed: int = 17, shard_words: int = SHARD_WORDS) -> DataFrame:
    """doc_id, source, size, source_size, target and taken, from docs' doc_id, text and source."""
    taken = F.expr("passes * size + greatest(0L, to_1 - from_1) + greatest(0L, to_2)").alias("taken")
    return _allot(docs, (), weights, most, block, seed, shard_words).select("doc_id", "source", "size", "source_size", "target", taken)


def apportion(parties: DataFrame, by: str | None, votes: str, seats: str, order: str) -> DataFrame:
    """The parties with a column quota: Sainte-Laguë's seats within each group `by`, or, without
    one, among all of them, who may be more than a task should rank.

    votes: a double; seats: the group's seats, the same in each of its rows; order: a
    number unique within the group, smaller first where quotients are equal.
    """
    spark = parties.sparkSession
    if by:
        parties = spark.sql(f"SELECT *, sum({votes}) OVER (PARTITION BY {by}) AS all_, count(*) OVER (PARTITION BY {by}) AS n_ FROM {{parties}}", parties=parties)
    else:
        parties = materialise(parties, "mix-parties")
        parties = parties.withColumns({"all_": parties.agg(F.sum(votes)).scalar(), "n_": parties.agg(F.count("*")).scalar()})
    base = spark.sql(
        f"""
        WITH b AS (SELECT *, CASE WHEN all_ > 0 THEN CAST(ceil((n_ / 2D + 1) * ({votes} / all_)) AS BIGINT) + 1 ELSE 0 END AS reach_ FROM {{parties}})
        SELECT *, CASE WHEN all_ > 0 THEN greatest(0L, CAST(round({seats} * ({votes} / all_)) AS BIGINT) - reach_) ELSE 0 END AS low_ FROM b""",
        parties=parties,
    )
    if by:
        base = spark.sql(f"SELECT *, {seats} - sum(low_) OVER (PARTITION BY {by}) AS open_ FROM {{base}}", base=base)
    else:
        base = materialise(base, "mix-parties")
        base = base.withColumn("lows_", base.agg(F.sum("low_")).scalar()).withColumn("open_", F.expr(f"{seats} - lows_")).drop("lows_")
    bids = spark.sql(f"SELECT *, -({votes} / (2 * (low_ + i_) + 1)) AS bid_ FROM (SELECT *, explode(sequence(0L, 2 * reach_ + 1)) AS i_ FROM {{base}} WHERE {votes} > 0)", base=base)
    if by:
        bids = spark.sql(f"SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY bid_, {order}) - 1 AS place_ FROM {{bids}}", bids=bids)
    else:
        bids = running(bids, ["bid_", order], {"place_": "1"})
    won = bids.filter("place_ < open_").groupBy(F.expr(f"{by or 0} AS by_"), F.expr(f"{order} AS order_")).agg(F.count("*").alias("got_"))
    joined = base.join(won, F.expr(f"{by or 0} = by_ AND {order} = order_"), "left")
    return joined.withColumn("quota", F.col("low_") + F.coalesce("got_", F.lit(0))).drop("all_", "n_", "reach_", "low_", "open_", "by_", "order_", "got_")


def repeat(docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS, block: int = BLOCK, seed: int = 17, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Each row of docs as often as the mix takes it: whole, and as an excerpt where the mix
    takes a part of its words. The same columns as docs; n_chars is counted anew for excerpts."""
    rows = addressed(docs)
    taken = _allot(rows, (FILE, ROW), weights, most, block, seed, shard_words)
    whole = F.expr("passes + CAST(to_1 - from_1 = size AS BIGINT) + CAST(to_2 = size AS BIGINT)").cast("int")
    parts = F.filter(
        F.array(F.struct(F.col("from_1").alias("a"), F.col("to_1").alias("b")), F.struct(F.lit(0).cast("long").alias("a"), F.col("to_2").alias("b"))),
        lambda x: (x.b > x.a) & (x.b - x.a < F.col("size")),
    )
    spans = F.concat(F.array_repeat(F.struct(F.lit(-1).cast("long").alias("a"), F.lit(-1).cast("long").alias("b")), whole), parts)
    taken = taken.filter("size > 0").select(F.col(FILE).alias("__mix_file"), F.col(ROW).alias("__mix_row"), spans.alias("__mix_spans")).filter(F.size("__mix_spans") > 0)
    joined = rows.join(taken, (F.col(FILE) == F.col("__mix_file")) & (F.col(ROW) == F.col("__mix_row"))).withColumn("__mix_span", F.explode("__mix_spans"))
    a, b = F.col("__mix_span.a"), F.col("__mix_span.b")
    words = F.split(F.ltrim("text", F.lit(WHITE)), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")  # with the white space behind them
    excerpt = F.rtrim(F.array_join(F.slice(words, (a + 1).cast("int"), (b - a).cast("int")), ""), F.lit(WHITE))
    own = {c: F.col(c) for c in docs.columns} | {"text": F.when(a < 0, F.col("text")).otherwise(excerpt)}
    if "n_chars" in own:
        own["n_chars"] = F.when(a < 0, F.col("n_chars")).otherwise(F.length(excerpt).cast(docs.schema["n_chars"].dataType))
    return joined.select(*(v.alias(c) for c, v in own.items()))
