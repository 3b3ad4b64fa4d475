"""Adjacent pairs of ordered records: question and answer dyads and what is checked of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import number
from ..functions.fixed_values import LEGISLATOR_ROLES, NONLEGISLATOR_ROLES


def following(df: DataFrame, group: str, order: str, carried: Sequence[str]) -> DataFrame:
    """Each row with a struct `next` of the row after it in its group.

    Rows order by their numeric value; those without one are dropped, not paired. One
    shuffle by group, and only the carried columns travel twice.
    """
    ordered = df.withColumn("_at", number(order)).filter("_at IS NOT NULL")
    w = Window.partitionBy(group).orderBy("_at", order)
    return ordered.withColumn("next", F.lead(F.struct(*carried)).over(w)).drop("_at")


def direction(role: Column, next_role: Column, asks: Sequence[str], answers: Sequence[str]) -> Column:
    """question, answer or null; a neutral role next to either breaks the pair."""
    return F.when(role.isin(*asks) & next_role.isin(*answers), "question").when(role.isin(*answers) & next_role.isin(*asks), "answer")


def dyads(df: DataFrame, group: str, order: str, role: str, asks: Sequence[str] = LEGISLATOR_ROLES, answers: Sequence[str] = NONLEGISLATOR_ROLES, context: Sequence[str] = (), leg: dict[str, str] | None = None, witness: dict[str, str] | None = None) -> DataFrame:
    """One row for each adjacent pair of an asking and an answering record.

    context: columns taken from the asking side. leg, witness: result names and source
    columns of either side. The result is in no order; `order` of the asking side is kept.
    """
    leg, witness = leg or {}, witness or {}
    sources = list(dict.fromkeys([order, role, *context, *leg.values(), *witness.values()]))
    paired = following(df.select(group, *sources), group, order, sources)
    way = direction(F.col(role), F.col("next")[role], asks, answers)
    pairs = paired.withColumn("direction", way).filter("direction IS NOT NULL")
    asking = lambda c: F.when(F.col("direction") == "question", F.col(c)).otherwise(F.col("next")[c])
    telling = lambda c: F.when(F.col("direction") == "question", F.col("next")[c]).otherwise(F.col(c))
    return pairs.select(
        group,
        asking(order).alias(order),
        *(asking(c).alias(c) for c in context),
        *(asking(c).alias(n) for n, c in leg.items()),
        *(telling(c).alias(n) for n, c in witness.items()),
        "direction",
    )


def recount(df: DataFrame, actual: DataFrame, group: str, order: str, role: str, asks=LEGISLATOR_ROLES, answers=NONLEGISLATOR_ROLES) -> DataFrame:
    """Pairs that each group should have against those it has, 0 where a side lacks the group."""
    expected = dyads(df, group, order, role, asks, answers).groupBy(group).agg(F.count("*").alias("expected"))
    there = actual.groupBy(group).agg(F.count("*").alias("actual"))
    out = expected.join(there, group, "full").na.fill(0, ["expected", "actual"])
    return out.withColumn("difference", F.col("actual") - F.col("expected"))


def transitions(df: DataFrame, group: str, order: str, role: str) -> DataFrame:
    """How often a role follows another."""
    return following(df, group, order, [role]).filter("next IS NOT NULL").groupBy(F.col(role).alias("from_role"), F.col("next")[role].alias("to_role")).agg(F.count("*").alias("n"))


def sidedness(df: DataFrame, group: str, role: str, asks=LEGISLATOR_ROLES, answers=NONLEGISLATOR_ROLES) -> DataFrame:
    """Which sides speak in each group: both, leg_only, nonleg_only or neither."""
    has = lambda roles: F.coalesce(F.bool_or(F.col(role).isin(*roles)), F.lit(False))
    sides = df.groupBy(group).agg(has(asks).alias("leg"), has(answers).alias("non"))
    label = F.when(F.col("leg") & F.col("non"), "both").when(F.col("leg"), "leg_only").when(F.col("non"), "nonleg_only").otherwise("neither")
    return sides.select(group, label.alias("sides"))


def aligned(expected: DataFrame, actual: DataFrame, group: str, order: str, compare: Sequence[str], first: int = 5) -> DataFrame:
    """The first pairs of each group side by side, and whether the compared columns agree."""
    def placed(df: DataFrame, mark: str) -> DataFrame:
        at = F.row_number().over(Window.partitionBy(group).orderBy(number(order), "direction"))
        return df.withColumn("place", at).filter(F.col("place") <= first).select(group, "place", *(F.col(c).alias(f"{mark}_{c}") for c in compare))

    both = placed(expected, "e").join(placed(actual, "a"), [group, "place"], "full")
    same = F.lit(True)
    for c in compare:
        same = same & F.col(f"e_{c}").eqNullSafe(F.col(f"a_{c}"))
    return both.select(group, "place", same.alias("same"))
