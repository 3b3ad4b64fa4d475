"""Checks of speeches and dyads as one report: check, status, value, message.

Scalars of a table come from one aggregation; keyed checks from one grouping each.
Everything is computed on all rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.expr import is_blank, parse_date, strip
from ..operators import groups, joins, pairs

STATUSES = ("PASS", "WARN", "FAIL")


@dataclass(frozen=True)
class Domain:
    terms: tuple = V.TERMS
    hearing_types: tuple = V.HEARING_TYPES
    legislators: tuple = V.LEGISLATOR_ROLES
    others: tuple = V.NONLEGISLATOR_ROLES
    neutral: tuple = V.NEUTRAL_ROLES
    committees: tuple = V.COMMITTEE_KEYS
    #: First and last year of each term, for dates a year off at most.
    years: tuple = tuple((t, 2000 + 4 * (t - 16), 2004 + 4 * (t - 16)) for t in V.TERMS)

    @property
    def roles(self) -> tuple:
        return self.legislators + self.others + self.neutral


def _report(row: DataFrame, checks: Sequence[tuple[str, Column, Column | None, Column | None]]) -> DataFrame:
    """A frame of one row as a row for each check: name, value, when it fails, when it warns."""
    def one(name: str, value: Column, fails: Column | None, warns: Column | None) -> Column:
        status = F.lit("PASS")
        if warns is not None:
            status = F.when(warns, "WARN").otherwise(status)
        if fails is not None:
            status = F.when(fails, "FAIL").otherwise(status)
        return F.struct(F.lit(name).alias("check"), status.alias("status"), F.round(F.coalesce(value.cast("double"), F.lit(0.0)), 6).alias("value"))

    return row.select(F.inline(F.array(*(one(*c) for c in checks))))


def _share(condition: Column) -> Column:
    """The share of rows that meet a condition, 0 of none."""
    return F.coalesce(F.avg(F.coalesce(condition, F.lit(False)).cast("double")), F.lit(0.0))


def _count(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def schema_checks(df: DataFrame, required: Sequence[str], prefix: str) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    extra = [c for c in df.columns if c not in required]
    rows = [(f"{prefix}_schema_required", "FAIL" if missing else "PASS", float(len(missing)), ", ".join(missing)), (f"{prefix}_schema_extra", "WARN" if extra else "PASS", float(len(extra)), ", ".join(extra))]
    return df.sparkSession.createDataFrame(rows, "check string, status string, value double, message string")


def validate_speeches(s: DataFrame, domain: Domain = Domain()) -> DataFrame:
    leg, c = F.col("role").isin(*domain.legislators), F.col
    member = ~is_blank("member_id", ("", "nan", "None"))
    date = parse_date("date")
    year_off = F.lit(False)
    for term, low, high in domain.years:
        year_off = year_off | ((c("term") == term) & ~F.year(date).between(low - 1, high + 1))
    length = F.length(F.coalesce(c("speech_text"), F.lit("")))
    row = s.agg(
        F.count("*").alias("n"),
        F.count_distinct(F.when(c("term").isin(*domain.terms), c("term"))).alias("terms"),
        F.count_distinct(F.when(~c("hearing_type").isin(*domain.hearing_types), c("hearing_type"))).alias("types_unknown"),
        F.count_distinct(F.when(c("hearing_type").isin(*domain.hearing_types), c("hearing_type"))).alias("types"),
        _count(~c("role").isin(*domain.roles)).alias("roles_unknown"),
        _share(leg).alias("leg"),
        _count(~c("committee_key").isin(*domain.committees)).alias("committees_unknown"),
        _share(c("committee_key") == "other").alias("committees_other"),
        _count(member & ~leg).alias("member_not_leg"),
        _count(leg & ~member).alias("leg_no_member"),
        _count(leg).alias("legs"),
        _share(date.isNotNull()).alias("dates"),
        _share(year_off).alias("year_off"),
        _share(is_blank("speech_text", ("",))).alias("empty"),
        _share(length < 10).alias("short"),
        _share(is_blank("person_name", ("",))).alias("unnamed"),
        _share(c("role").isin("other", "unknown")).alias("unclassified"),
        _count((c("role") == "chair") & ~c("speaker").contains("위원장")).alias("chair_keyword"),
        _count((c("role") == "minister") & ~c("speaker").contains("장관")).alias("minister_keyword"),
        _count((c("role") == "chair") & c("speaker").rlike("공사장|공단장|청장")).alias("chair_leak"),
        _count(c("role") == "committee_staff").alias("staff"),
        F.count_distinct("committee").alias("raw"),
        F.count_distinct(F.when(c("committee_key") == "other", c("committee"))).alias("unmapped"),
    )
    scalars = _report(
        row,
        [
            ("speech_row_count", c("n"), c("n") == 0, None),
            ("speech_terms", c("terms"), c("terms") < len(domain.terms), None),
            ("speech_hearing_types", c("types"), None, (c("types") < len(domain.hearing_types)) | (c("types_unknown") > 0)),
            ("speech_roles_unknown", c("roles_unknown"), None, c("roles_unknown") > 0),
            ("speech_role_balance", c("leg"), None, ~c("leg").between(0.3, 0.7)),
            ("speech_committees_unknown", c("committees_unknown"), None, c("committees_unknown") > 0),
            ("speech_committees_other", c("committees_other"), None, c("committees_other") > 0.05),
            ("speech_memberid_role", c("member_not_leg"), c("member_not_leg") > 0, None),
            ("speech_leg_without_memberid", c("leg_no_member"), None, c("leg_no_member") > 0.3 * c("legs")),
            ("speech_date_parsing", c("dates"), None, c("dates") < 0.8),
            ("speech_date_term_range", c("year_off"), None, c("year_off") > 0.05),
            ("speech_empty_text", c("empty"), None, c("empty") > 0.01),
            ("speech_short_text", c("short"), None, c("short") > 0.1),
            ("speech_empty_person_name", c("unnamed"), None, c("unnamed") > 0.01),
            ("classify_unclassified", c("unclassified"), None, c("unclassified") > 0.05),
            ("classify_chair_keyword", c("chair_keyword"), None, c("chair_keyword") > 0),
            ("classify_minister_keyword", c("minister_keyword"), None, c("minister_keyword") > 0),
            ("classify_gov_chair_leak", c("chair_leak"), None, c("chair_leak") > 0),
            ("classify_staff_count", c("staff"), None, None),
            ("committee_raw_count", c("raw"), None, None),
            ("committee_unmapped", c("unmapped"), None, c("unmapped") > 0),
        ],
    )
    copies = s.groupBy("meeting_id", "speech_order").agg(F.count("*").alias("k")).agg(F.coalesce(F.sum(F.when(F.col("k") > 1, F.col("k"))), F.lit(0)).alias("dups"), F.coalesce(F.sum("k"), F.lit(0)).alias("n"))
    gaps = groups.continuity(s, "meeting_id", "speech_order").agg(_share(F.col("gap")).alias("gaps"), _count(F.col("not_numbers") > 0).alias("bad"))
    keys = s.filter("committee_key IS NOT NULL").groupBy("meeting_id").agg(F.count_distinct("committee_key").alias("k")).agg(_count(F.col("k") > 1).alias("several"))
    keyed = [
        _report(copies, [("speech_duplicates", c("dups"), c("dups") >= F.greatest(0.01 * c("n"), F.lit(1e-9)), c("dups") > 0)]),
        _report(gaps, [("speech_order_continuity", c("gaps"), None, c("gaps") > 0.2), ("speech_order_numbers", c("bad"), None, c("bad") > 0)]),
        _report(keys, [("committee_meeting_consistency", c("several"), None, c("several") > 0)]),
    ]
    for part in keyed:
        scalars = scalars.unionByName(part)
    return scalars


def validate_dyads(d: DataFrame, domain: Domain = Domain()) -> DataFrame:
    c = F.col
    empty = ("leg_speech", "witness_speech", "leg_name", "witness_name")
    row = d.agg(
        F.count("*").alias("n"),
        _count(c("direction") == "question").alias("q"),
        _count(c("direction") == "answer").alias("a"),
        _count(~c("direction").isin(*V.DIRECTIONS)).alias("directions_unknown"),
        _count(c("witness_role").isin(*domain.legislators)).alias("leg_witness"),
        _count(~c("witness_role").isin(*domain.others)).alias("witness_unknown"),
        *(_share(is_blank(e, ("",))).alias(e) for e in empty),
        _count(strip("leg_name") == strip("witness_name")).alias("self"),
        F.count_distinct(F.when(c("term").isin(*domain.terms), c("term"))).alias("terms"),
        F.count_distinct(F.when(~c("committee_key").isin(*domain.committees), c("committee_key"))).alias("committees_unknown"),
    )
    return _report(
        row,
        [
            ("dyad_row_count", c("n"), c("n") == 0, None),
            ("dyad_directions", c("directions_unknown"), (c("directions_unknown") > 0) | (c("q") == 0) | (c("a") == 0), None),
            ("dyad_direction_balance", F.try_divide(F.least("q", "a"), F.greatest("q", "a")), None, ~F.coalesce(F.try_divide(F.least("q", "a"), F.greatest("q", "a")) > 0.8, F.lit(False))),
            ("dyad_witness_not_legislator", c("leg_witness"), c("leg_witness") > 0, None),
            ("dyad_witness_roles", c("witness_unknown"), None, c("witness_unknown") > 0),
            ("dyad_empty_leg_speech", c("leg_speech"), None, c("leg_speech") > 0.01),
            ("dyad_empty_witness_speech", c("witness_speech"), None, c("witness_speech") > 0.01),
            ("dyad_empty_leg_name", c("leg_name"), None, c("leg_name") > 0),
            ("dyad_empty_witness_name", c("witness_name"), None, c("witness_name") > 0),
            ("dyad_self_pairing", c("self"), None, c("self") > 0),
            ("dyad_terms", c("terms"), c("terms") < len(domain.terms), None),
            ("dyad_committees_unknown", c("committees_unknown"), None, c("committees_unknown") > 0),
        ],
    )


def validate_cross(s: DataFrame, d: DataFrame, domain: Domain = Domain()) -> DataFrame:
    c = F.col
    sizes = s.agg(F.count("*").alias("s")).withColumn("d", d.agg(F.count("*")).scalar())
    orphan = joins.orphans(d.select("meeting_id").distinct(), s, "meeting_id").agg(F.count("*").alias("orphans"))
    ratios = s.groupBy("term").agg(F.count("*").alias("s")).join(d.groupBy("term").agg(F.count("*").alias("d")), "term").agg((F.max(c("d") / c("s")) - F.min(c("d") / c("s"))).alias("range"))
    recounted = pairs.recount(s, d, "meeting_id", "speech_order", "role", domain.legislators, domain.others).agg(_count(c("difference") != 0).alias("off"))
    out = _report(sizes, [("cross_dyad_lt_speech", c("d") / c("s"), c("d") >= c("s"), None)])
    for part in (
        _report(orphan, [("cross_dyad_meetings_in_speeches", c("orphans"), c("orphans") > 0, None)]),
        _report(ratios, [("cross_term_ratio_variance", c("range"), None, c("range") > 0.3)]),
        _report(recounted, [("cross_dyad_formation", c("off"), c("off") >= 10, c("off") > 0)]),
    ):
        out = out.unionByName(part)
    return out


def distributions(s: DataFrame, d: DataFrame) -> DataFrame:
    """check, key, n: the counts that reports list: terms, types, roles, committees, witnesses.
    A table's rows are turned into an entry a column and counted in one aggregation."""
    def counted(df: DataFrame, columns: dict[str, str]) -> DataFrame:
        entries = F.array(*(F.struct(F.lit(name).alias("check"), F.col(key).cast("string").alias("key")) for name, key in columns.items()))
        return df.select(F.inline(entries)).filter("key IS NOT NULL").groupBy("check", "key").agg(F.count("*").alias("n"))

    speeches = {"speech_term": "term", "speech_hearing_type": "hearing_type", "speech_role": "role", "committee_key": "committee_key"}
    return counted(s, speeches).unionByName(counted(d, {"dyad_term": "term", "dyad_witness_role": "witness_role", "dyad_direction": "direction"}))


def details(s: DataFrame, d: DataFrame, domain: Domain = Domain(), examples: int = 5, top: int = 20) -> DataFrame:
    """check, key, value: what is behind the checks: terms that dyads lack and committee keys
    that nobody knows, dyads a speech by term, shares of hearing types in either table, the
    most frequent unclassified speakers, raw committees without a key, examples of meetings
    with several keys and of pairs with oneself (the first by name)."""
    c = F.col

    def row(df: DataFrame, check: str, key: Column, value: Column) -> DataFrame:
        return df.select(F.lit(check).alias("check"), key.cast("string").alias("key"), F.round(value.cast("double"), 6).alias("value"))

    terms = s.sparkSession.createDataFrame([(t,) for t in domain.terms], "term int")
    lacking = terms.join(d.select("term").distinct(), "term", "left_anti")
    ratios = s.groupBy("term").agg(F.count("*").alias("s")).join(d.groupBy("term").agg(F.count("*").alias("d")), "term")
    known = ~c("committee_key").isin(*domain.committees)
    several = s.filter("committee_key IS NOT NULL").groupBy("meeting_id").agg(F.count_distinct("committee_key").alias("k")).filter("k > 1").orderBy("meeting_id").limit(examples)
    own = d.filter(strip("leg_name") == strip("witness_name")).groupBy(F.concat_ws("/", "meeting_id", "leg_name", "witness_role").alias("key")).agg(F.count("*").alias("n")).orderBy("key").limit(examples)
    parts = [
        row(lacking, "dyad_terms_missing", c("term"), F.lit(1)),
        row(groups.counts(d.filter(known), "committee_key"), "dyad_committees_unknown", c("committee_key"), c("n")),
        row(groups.counts(s.filter(known), "committee_key"), "speech_committees_unknown", c("committee_key"), c("n")),
        row(ratios, "cross_term_ratio", c("term"), c("d") / c("s")),
        row(groups.shares(s, "hearing_type"), "speech_hearing_type_share", c("hearing_type"), c("share")),
        row(groups.shares(d, "hearing_type"), "dyad_hearing_type_share", c("hearing_type"), c("share")),
        row(groups.top(s.filter(c("role").isin("other", "unknown")), "speaker", top), "classify_unclassified_top", c("speaker"), c("n")),
        row(groups.counts(s.filter("committee_key = 'other'"), "committee"), "committee_unmapped", c("committee"), c("n")),
        row(several, "committee_several_keys", c("meeting_id"), c("k")),
        row(own, "dyad_self_pairing", c("key"), c("n")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def validate(s: DataFrame, d: DataFrame, domain: Domain = Domain()) -> DataFrame:
    """The whole report; message is empty but for schema checks."""
    parts = validate_speeches(s, domain).unionByName(validate_dyads(d, domain)).unionByName(validate_cross(s, d, domain))
    schemas = schema_checks(s, V.SPEECH_COLUMNS, "speech").unionByName(schema_checks(d, V.DYAD_COLUMNS, "dyad"))
    return schemas.unionByName(parts.withColumn("message", F.lit("")))


def tally(checks: DataFrame) -> DataFrame:
    return groups.counts(checks, "status")
