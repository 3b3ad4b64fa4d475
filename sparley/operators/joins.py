"""Lookups, interval links and changes between versions of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import flag
from .groups import dedup_first


def lookup_fill(facts: DataFrame, dim: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Sequence[str] = (), only: Column | None = None) -> DataFrame:
    """Null columns of facts are filled from the first row of a dimension with their key;
    `only` limits which rows are. The planner broadcasts the dimension where its size allows."""
    first = dedup_first(dim.select(*dict.fromkeys([*keys, *columns, *order])), keys, list(order) or list(keys))
    first = first.select(*(F.col(k).alias(f"_k_{k}") for k in keys), *(F.col(c).alias(f"_d_{c}") for c in columns))
    same = [facts[k] == first[f"_k_{k}"] for k in keys]
    out = facts.join(first, same, "left")
    for c in columns:
        new = F.col(f"_d_{c}") if only is None else F.when(only, F.col(f"_d_{c}"))
        out = out.withColumn(c, F.coalesce(facts[c], new) if c in facts.columns else new)
    return out.drop(*first.columns)


def two_stage_match(facts: DataFrame, dim: DataFrame, first: tuple[Column, Column], second: tuple[Sequence[Column], Sequence[Column]], columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """facts with columns of the dimension by one key, or else by a second one, and which
    of the two matched (direct, fallback, null). Dimension rows are the first of their key."""
    direct = dedup_first(dim.withColumn("_key", first[1]), ["_key"], order).select("_key", *(F.col(c).alias(f"_1_{c}") for c in columns), F.lit("direct").alias("_1"))
    parts = [f"_p{i}" for i in range(len(second[1]))]
    fallback = dedup_first(dim.withColumns(dict(zip(parts, second[1], strict=True))), parts, order).select(*parts, *(F.col(c).alias(f"_2_{c}") for c in columns), F.lit("fallback").alias("_2"))
    out = facts.join(direct, first[0] == F.col("_key"), "left")
    # A row that matched already finds nothing in the second join.
    out = out.join(fallback, [*(a == F.col(p) for a, p in zip(second[0], parts, strict=True)), F.col("_1").isNull()], "left")
    result = {c: F.when(F.col("_1").isNotNull(), F.col(f"_1_{c}")).otherwise(F.col(f"_2_{c}")) for c in columns}
    return out.select(*facts.columns, *(v.alias(c) for c, v in result.items()), F.coalesce("_1", "_2").alias("matched"))


def yes_no(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Y and N columns as booleans, unmatched ones false."""
    return df.withColumns({new: flag(old) for new, old in columns.items()})


def interval_link(facts: DataFrame, panel: DataFrame, name: str, detail: str, date: str, unit: Sequence[str], order: str, p_name: str, p_detail: str, start: str, end: str, p_order: str, columns: Sequence[str]) -> DataFrame:
    """Links facts to the panel row of their name that fits best.

    Each unit (of facts' columns) decides once, by its first row in `order`: a panel row of
    the same detail whose interval has the date; then one by date alone; then by detail
    alone; then the only row of that name. In a tier the first panel row wins. An interval
    without a start has no date, one without an end goes on.
    """
    decides = dedup_first(facts.select(*dict.fromkeys([*unit, name, detail, date, order])), unit, [order]).drop(order)
    rows = panel.select(F.col(p_name).alias("_n"), F.col(p_detail).alias("_d"), F.col(start).alias("_s"), F.coalesce(F.col(end), F.lit("2099-12-31").cast("date")).alias("_e"), F.col(p_order).alias("_o"), *(F.col(c).alias(f"_c_{c}") for c in columns))
    alone = panel.groupBy(F.col(p_name).alias("_n")).agg(F.count("*").alias("_count"))
    by_date = F.col(date).between(F.col("_s"), F.col("_e"))
    by_detail = F.col(detail) == F.col("_d")
    tier = F.when(by_date & by_detail, 1).when(by_date, 2).when(by_detail, 3).when(F.col("_count") == 1, 4)
    candidates = decides.join(rows.join(alone, "_n"), F.col(name) == F.col("_n")).withColumn("_tier", tier).filter("_tier IS NOT NULL")
    best = candidates.withColumn("_rank", F.row_number().over(Window.partitionBy(*unit).orderBy("_tier", "_o"))).filter("_rank = 1")
    best = best.select(*(F.col(u).alias(f"_u_{u}") for u in unit), F.col("_tier").alias("tier"), *(F.col(f"_c_{c}").alias(c) for c in columns))
    return facts.join(best, [facts[u] == best[f"_u_{u}"] for u in unit], "left").drop(*(f"_u_{u}" for u in unit))


def range_value(date: Column, ranges: Sequence[tuple], value: int = 0) -> Column:
    """A value of the first closed range (..., first day, last day) that has the date, or null."""
    out = None
    for row in ranges:
        inside = date.between(F.lit(row[-2]).cast("date"), F.lit(row[-1]).cast("date"))
        out = F.when(inside, F.lit(row[value])) if out is None else out.when(inside, F.lit(row[value]))
    return out


def append_new(base: DataFrame, batch: DataFrame, key: str) -> DataFrame:
    """base and those rows of the batch whose key it doesn't have; base's columns, in order.

    Columns that the batch lacks are null, its others go; types are cast, null where they can't be.
    """
    fresh = batch.join(base.select(F.col(key).alias("_key")).distinct(), batch[key].cast(base.schema[key].dataType) == F.col("_key"), "left_anti")
    aligned = fresh.select(*((fresh[f.name].try_cast(f.dataType) if f.name in fresh.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in base.schema.fields))
    return base.unionByName(aligned)


def key_difference(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys of either side and where they are: left, right or both."""
    a = left.select(key).distinct().withColumn("_l", F.lit(1))
    b = right.select(key).distinct().withColumn("_r", F.lit(1))
    side = F.when(F.col("_l").isNull(), "right").when(F.col("_r").isNull(), "left").otherwise("both")
    return a.join(b, key, "full").select(key, side.alias("side"))


def distribution_change(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Counts of each value in two tables, 0 where it is missing, and the change."""
    a = before.groupBy(F.col(key).alias("_a")).agg(F.count("*").alias("n_before"))
    b = after.groupBy(F.col(key).alias("_b")).agg(F.count("*").alias("n_after"))
    out = a.join(b, F.col("_a").eqNullSafe(F.col("_b")), "full").select(F.coalesce("_a", "_b").alias(key), F.coalesce("n_before", F.lit(0)).cast("long").alias("n_before"), F.coalesce("n_after", F.lit(0)).cast("long").alias("n_after"))
    return out.withColumn("change", F.col("n_after") - F.col("n_before"))


def changed_values(before: DataFrame, after: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Rows of equal keys (the first of repeated ones by value) whose value differs, counted by
    old and new value. Keys compare as strings."""
    def one(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*(F.col(k).cast("string").alias(k) for k in keys)).agg(F.min(value).alias(name))

    both = one(before, "old_value").join(one(after, "new_value"), list(keys))
    return both.filter("old_value IS DISTINCT FROM new_value").groupBy("old_value", "new_value").agg(F.count("*").alias("n"))


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of child whose key parent lacks."""
    return child.join(parent.select(key).distinct(), key, "left_anti")


def having(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows of df whose key is among those of `keys`, once each."""
    return df.join(keys.select(key).distinct(), key, "left_semi")


def side_by_side(rows: DataFrame, other: DataFrame, keys: Sequence[str], columns: Sequence[str], mark: str) -> DataFrame:
    """All rows with columns of another version of them, named <column>_<mark>; null where it
    lacks their key. Keys compare as strings; of repeated ones the other's first by value."""
    first = other.groupBy(*(F.col(k).cast("string").alias(f"_{k}") for k in keys)).agg(F.min(F.struct(*columns)).alias("_x"))
    joined_ = rows.join(first, [F.col(k).cast("string") == F.col(f"_{k}") for k in keys], "left")
    return joined_.select(*rows.columns, *(F.col("_x")[c].alias(f"{c}_{mark}") for c in columns))
