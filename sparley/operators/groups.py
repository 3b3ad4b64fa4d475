"""Grouping, ordering and distribution operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import col, number


def counts(df: DataFrame, *keys: str, nulls: bool = True) -> DataFrame:
    """Rows of each group; null is a group unless nulls is false."""
    for key in () if nulls else keys:
        df = df.filter(F.col(key).isNotNull())
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def shares(df: DataFrame, *keys: str) -> DataFrame:
    """Counts and each group's share of all rows."""
    found = counts(df, *keys)
    return found.select(*keys, "n", (F.col("n") / found.agg(F.sum("n")).scalar()).alias("share"))


def top(df: DataFrame, key: str, k: int) -> DataFrame:
    """The k most frequent values, smaller ones first among equals."""
    return counts(df, key).orderBy(F.desc("n"), key).limit(k)


def largest(df: DataFrame, value: str, k: int, *ties: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(value), *ties).limit(k)


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in an explicit order."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def flag_duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df with n_copies, the rows that share its key, all members alike.

    Counted by aggregation and joined back: a key with very many rows is summed before
    the shuffle and its rows can be split among tasks.
    """
    many = df.groupBy(*(F.col(k).alias(f"_{i}") for i, k in enumerate(keys))).agg(F.count("*").alias("_n")).filter("_n > 1")
    same = [F.col(k).eqNullSafe(F.col(f"_{i}")) for i, k in enumerate(keys)]
    return df.join(many, same, "left").select(*df.columns, F.coalesce("_n", F.lit(1)).cast("long").alias("n_copies"))


def duplicate_profile(df: DataFrame, keys: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """For each key that repeats: its rows, and whether each attribute is the same in all."""
    same = [(F.count_distinct(F.coalesce(F.col(a).cast("string"), F.lit("\u0000"))) == 1).alias(f"same_{a}") for a in attributes]
    return df.groupBy(*keys).agg(F.count("*").alias("n"), *same).filter("n > 1")


def multiplicities(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many keys have how many rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("size")).groupBy("size").agg(F.count("*").alias("groups"))


def continuity(df: DataFrame, group: str, order: str) -> DataFrame:
    """Per group: numbers, missing and repeated ones between the least and the greatest,
    values that are no whole numbers, and whether anything is wrong."""
    at = F.col("_at")
    found = df.select(group, number(order).alias("_at")).groupBy(group).agg(
        F.count("*").alias("n"),
        F.count_if(at.isNull() | (at != F.floor(at))).alias("not_numbers"),
        F.min(at).cast("long").alias("low"),
        F.max(at).cast("long").alias("high"),
        F.count_distinct(at).alias("distinct"),
    )
    missing = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("distinct"), F.lit(0))
    out = found.withColumn("missing", missing).withColumn("repeated", F.col("n") - F.col("not_numbers") - F.col("distinct"))
    return out.withColumn("gap", (F.col("missing") > 0) | (F.col("repeated") > 0)).drop("distinct")


def month_gaps(df: DataFrame, date: str, least: int = 3) -> DataFrame:
    """Runs of at least so many months without a row between two that have some."""
    months = df.select(F.trunc(F.col(date).cast("date"), "MM").alias("month")).filter("month IS NOT NULL").distinct()
    before = F.lag("month").over(Window.orderBy("month"))  # one row a month
    gaps = months.select("month", before.alias("before")).withColumn("gap", F.floor(F.months_between("month", "before")).cast("int") - 1)
    return gaps.filter(F.col("gap") >= least).select(F.add_months("before", 1).alias("first_month"), F.add_months("month", -1).alias("last_month"), "gap")


def several_values(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one value, and these in order."""
    return df.filter(F.col(value).isNotNull()).groupBy(key).agg(F.array_sort(F.collect_set(value)).alias("found")).filter(F.size("found") > 1).select(key, F.size("found").cast("long").alias("n_values"), F.array_join("found", "|").alias("found_values"))


def shortest(df: DataFrame, key: str, value: str) -> DataFrame:
    """Each key's shortest value; of equals the smaller by code points."""
    best = F.min(F.struct(F.length(value).alias("l"), F.col(value).alias("v")))
    return df.filter(F.col(value).isNotNull()).groupBy(key).agg(best["v"].alias("canonical"))


def canonical_names(df: DataFrame, key: str, name: str, title: str) -> DataFrame:
    """Names become their key's shortest one; what stood before it fills an empty title."""
    base = shortest(df.filter(F.col(key).isNotNull()), key, name).withColumnRenamed(key, "_key")
    out = df.join(base, F.col(key) == F.col("_key"), "left")
    front = F.rtrim(F.substring(name, 1, F.length(name) - F.length("canonical")))
    leads = F.col(name).endswith(F.col("canonical")) & (front != "")
    return out.withColumn(title, F.coalesce(title, F.when(leads, front))).withColumn(name, F.coalesce("canonical", name)).drop("_key", "canonical")


def usual(df: DataFrame, key: str, value: str) -> DataFrame:
    """Each key's most frequent value; of equals the smallest."""
    return df.filter(F.col(value).isNotNull()).groupBy(key).agg(F.mode(value, deterministic=True).alias("usual"))


def spread(df: DataFrame, key: str, value: str) -> DataFrame:
    """Count, mean, least, greatest and exact quartiles of a number for each group."""
    q = lambda p: F.percentile(value, p)
    return df.groupBy(key).agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("deviation"), F.min(value).alias("low"), q(0.25).alias("q1"), q(0.5).alias("median"), q(0.75).alias("q3"), F.max(value).alias("high"))


def size_outliers(df: DataFrame, group: str, times: float = 3.0) -> DataFrame:
    """Groups larger than the third quartile of sizes and `times` the distance of the
    quartiles, which are cut to whole numbers."""
    sizes = df.groupBy(group).agg(F.count("*").alias("size"))
    q1, q3 = (F.floor(F.percentile("size", p)) for p in (0.25, 0.75))
    return sizes.filter(F.col("size") > sizes.agg(q3 + times * (q3 - q1)).scalar())


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str]) -> DataFrame:
    """Counts by row and given column values, 0 where there are none."""
    return df.groupBy(row).pivot(column, list(values)).agg(F.count(F.lit(1))).na.fill(0)


def leading_digits(df: DataFrame, value: str | Column) -> DataFrame:
    """Counts of first digits against what a logarithmic distribution has."""
    digit = F.regexp_extract(F.format_string("%.6e", F.abs(col(value).cast("double"))), "^([1-9])", 1)
    found = df.select(F.nullif(digit, F.lit("")).cast("int").alias("digit")).filter("digit IS NOT NULL").groupBy("digit").agg(F.count("*").alias("n"))
    return found.select("digit", "n", (F.col("n") / found.agg(F.sum("n")).scalar()).alias("share"), F.log10(1 + 1 / F.col("digit")).alias("expected"))


def middle(df: DataFrame, value: str, *ties: str, few: int = 100_000) -> DataFrame:
    """The row in the middle by a number (the later of two); ties order it in full. Nulls come first."""
    return nth(df, df.count() // 2, [value, *ties], few)


def nth(df: DataFrame, place: int, order: Sequence[str], few: int = 100_000) -> DataFrame:
    """The row at a place (from 0) in the order of columns.

    Counts of rows up to approximate quantiles narrow the rows down, column by column, until
    at most `few` are left to be sorted. Bounds are values, so it doesn't matter how tasks
    split the rows.
    """
    left = df
    for c in order:
        none = left.agg(F.count_if(F.col(c).isNull()).alias("n")).first()["n"]
        if place < none:
            left = left.filter(F.col(c).isNull())
            continue
        left, place = left.filter(F.col(c).isNotNull()), place - none
        if not isinstance(df.schema[c].dataType, T.NumericType):
            break
        while True:
            known = left.agg(F.percentile_approx(c, [k / 64 for k in range(1, 65)], 10_000).alias("q"), F.count("*").alias("n"), F.min(c).alias("low"), F.max(c).alias("high")).first()
            if known["n"] <= few:
                return left.orderBy(*order).offset(place).limit(1)
            if known["low"] == known["high"]:
                break  # the next column decides
            bounds = sorted({*known["q"], known["high"]})
            upto = left.agg(*(F.count_if(F.col(c) <= F.lit(b)).alias(f"n{k}") for k, b in enumerate(bounds)), *(F.count_if(F.col(c) < F.lit(b)).alias(f"m{k}") for k, b in enumerate(bounds))).first()
            k = next(k for k in range(len(bounds)) if upto[f"n{k}"] > place)
            if upto[f"m{k}"] <= place:  # the bound's own value
                left, place = left.filter(F.col(c) == F.lit(bounds[k])), place - upto[f"m{k}"]
                break
            below = upto[f"n{k - 1}"] if k else 0
            left = left.filter(F.col(c) < F.lit(bounds[k]))
            left, place = (left.filter(F.col(c) > F.lit(bounds[k - 1])) if k else left), place - below
    return left.orderBy(*order).offset(place).limit(1)


def hash_sample(df: DataFrame, key: str, k: int) -> DataFrame:
    """k keys in the order of their digest: the same ones on every run and layout."""
    return df.select(key).distinct().orderBy(F.md5(F.col(key).cast("string")), key).limit(k)
