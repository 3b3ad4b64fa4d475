"""From raw speeches to enriched speeches and dyads, as one lazy plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions import rules
from ..functions.expr import date_text, normalize_text, null_if_blank, padded, parse_date
from ..operators import groups, joins, pairs
from ..sources import datasets

LEG = {"leg_name": "person_name", "leg_speaker_raw": "speaker", "leg_member_uid": "_uid", "leg_party": "party", "leg_ruling_status": "ruling_status", "leg_seniority": "seniority", "leg_gender": "gender", "leg_speech": "speech_text"}
WITNESS = {"witness_name": "person_name", "witness_speaker_raw": "speaker", "witness_role": "role", "witness_affiliation": "affiliation_raw", "witness_ministry_normalized": "ministry_normalized", "witness_dual_office": "dual_office", "witness_admin": "admin", "witness_admin_ideology": "admin_ideology", "witness_speech": "speech_text"}
FLAGS = ("is_hearing", "is_public_hearing", "is_inquiry", "is_sitting", "begin_time", "end_time", "download_url")
CONTEXT = ("term", "committee", "committee_key", "hearing_type", "date", "agenda")
DYADS = ("meeting_id", *CONTEXT, "leg_name", "leg_speaker_raw", "leg_member_uid", "leg_party", "leg_ruling_status", "leg_seniority", "leg_gender", "witness_name", "witness_speaker_raw", "witness_role", "witness_affiliation", "witness_ministry_normalized", "witness_dual_office", "witness_admin", "witness_admin_ideology", "direction", "leg_speech", "witness_speech")


def aligned(df: DataFrame) -> DataFrame:
    """The speeches schema: missing columns null, types cast where they can be."""
    return df.select(*((F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in datasets.schema(datasets.SPEECHES).fields))


def classified(scraped: DataFrame, committee_key: str | None = None) -> DataFrame:
    """Scraped rows as speeches: roles from labels, an existing name kept, a constant committee key."""
    found = rules.classify_speaker("speaker", "member_id")
    out = aligned(scraped).withColumn("_c", found)
    name = F.coalesce(null_if_blank("person_name", ("", "nan")), F.col("_c.person"))
    out = out.withColumns({"role": F.col("_c.role"), "person_name": name, "affiliation_raw": F.coalesce("affiliation_raw", "_c.affiliation")})
    if committee_key:
        out = out.withColumn("committee_key", F.lit(committee_key))
    return out.withColumn("member_uid", F.coalesce("member_uid", "member_id")).drop("_c")


def cleaned(s: DataFrame) -> DataFrame:
    """Identity, name, title, text and date rules, in their order; one row for each key."""
    s = s.withColumn("member_id", null_if_blank("member_id"))
    s = s.withColumn("role", rules.repair_role("role", "speaker", "member_id"))
    s = s.withColumn("role", rules.reclassify_other("role", "speaker"))
    s = groups.dedup_first(s, ["meeting_id", "speech_order"], ["speaker", "speech_text"])
    s = s.withColumn("person_name", rules.recover_name("person_name", "speaker"))
    s = s.withColumn("_t", rules.extract_title("person_name")).withColumns({"person_name": F.col("_t.name"), "person_title": F.coalesce("person_title", "_t.title")}).drop("_t")
    s = s.withColumn("_m", rules.move_bad_title("person_title", "affiliation_raw")).withColumns({"person_title": F.col("_m.title"), "affiliation_raw": F.col("_m.affiliation")}).drop("_m")
    s = s.withColumn("_n", rules.split_name("person_name", "affiliation_raw", "member_id")).withColumns({"person_name": F.col("_n.person_name"), "affiliation_raw": F.col("_n.affiliation")}).drop("_n")
    s = s.withColumns({"speech_text": normalize_text("speech_text"), "date": date_text("date"), "ruling_status": F.nullif(F.col("ruling_status"), F.lit(""))})
    s = s.withColumn("committee_key", F.coalesce("committee_key", F.when(F.col("committee").isNotNull(), rules.committee_key("committee"))))
    s = groups.canonical_names(rules.disambiguate(s.drop("member_uid")), "member_uid", "person_name", "person_title")
    return rules.homogenize(s, ["gender", "party", "ruling_status"])


def with_members(s: DataFrame, members: DataFrame, legislators_only: bool = True) -> DataFrame:
    """Member metadata by name and term, where it is null, and the name that was found as
    name_clean; legislators only, unless told not to."""
    dim = members.withColumnRenamed("name", "person_name").withColumn("name_clean", F.col("person_name"))
    only = F.col("role").isin(*V.LEGISLATOR_ROLES) if legislators_only else None
    return joins.lookup_fill(s, dim, ["person_name", "term"], ["party", "ruling_status", "seniority", "gender", "naas_cd", "name_clean"], only=only)


def with_conferences(s: DataFrame, details: DataFrame) -> DataFrame:
    """Meeting flags, times and link by padded id, or by date and committee."""
    names = {"HR_HRG_YN": "is_hearing", "PBHRG_YN": "is_public_hearing", "HRG_YN": "is_inquiry", "SITG_YN": "is_sitting"}
    columns = [*names, "BG_PTM", "ED_PTM", "DOWN_URL"]
    out = joins.two_stage_match(
        s, details,
        (padded("meeting_id"), padded("CONF_ID")),
        ([F.col("date"), F.col("committee")], [F.col("CONF_DT"), F.col("CMIT_NM")]),
        columns, ["CONF_ID"],
    )
    return joins.yes_no(out, {new: old for old, new in names.items()}).withColumnsRenamed({"BG_PTM": "begin_time", "ED_PTM": "end_time", "DOWN_URL": "download_url"}).drop(*names, "matched")


def with_new_conferences(s: DataFrame, old: DataFrame, details: DataFrame) -> DataFrame:
    """Flags, times and links for the meetings that an older version lacks; others keep theirs."""
    fresh = with_conferences(joins.orphans(s, old, "meeting_id").drop(*FLAGS), details)
    return joins.having(s, old, "meeting_id").unionByName(fresh, allowMissingColumns=True)


def verify(old: DataFrame, new: DataFrame) -> DataFrame:
    """item, value, n: rows and meetings of two versions, meetings that the new one added or
    lost, and the speeches and meetings that are new by hearing type. What there is to know
    of a version that was built already, instead of building it again."""
    keys = joins.key_difference(old, new, "meeting_id").groupBy("side").agg(F.count("*").alias("n"))
    side = lambda of, name: keys.agg(F.coalesce(F.sum(F.when(F.col("side").isin(*of), F.col("n"))), F.lit(0)).cast("long").alias("n")).select(F.lit(name).alias("item"), F.lit(None).cast("string").alias("value"), "n")
    rows = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("item"), F.lit(None).cast("string").alias("value"), "n")
    fresh = joins.orphans(new, old, "meeting_id").groupBy(F.col("hearing_type").alias("value")).agg(F.count("*").alias("speeches"), F.count_distinct("meeting_id").alias("meetings"))
    kinds = fresh.select(F.inline(F.array(*(F.struct(F.lit(f"new {c}").alias("item"), F.col("value"), F.col(c).alias("n")) for c in ("speeches", "meetings")))))
    out = rows(old, "old speeches").unionByName(rows(new, "new speeches in all"))
    for of, name in ((("left", "both"), "old meetings"), (("right", "both"), "new meetings in all"), (("right",), "added meetings"), (("left",), "lost meetings")):
        out = out.unionByName(side(of, name))
    return out.unionByName(kinds)


def with_ministers(s: DataFrame, panel: DataFrame) -> DataFrame:
    """Ministries of government roles; office, administration and ideology of ministers, from
    the panel row that fits each person and meeting best, or else from the date."""
    s = s.withColumns({"ministry_normalized": rules.ministry_of("role", "affiliation_raw"), "person_name": rules.fix_name("person_name")})
    s = s.drop("dual_office", "admin", "admin_ideology").withColumns({"_day": parse_date("date"), "_at": F.col("speech_order").try_cast("double")})
    ministers = F.coalesce(F.col("role").isin(*V.PANEL_ROLES), F.lit(False))
    ordered = panel if "panel_order" in panel.columns else panel.withColumn("panel_order", F.monotonically_increasing_id())
    linked = joins.interval_link(
        s.filter(ministers), ordered, "person_name", "ministry_normalized", "_day", ["person_name", "meeting_id"], "_at",
        "name", "ministry", "start", "end", "panel_order", ["dual_office", "admin", "admin_ideology"],
    )
    inferred = {c: F.when(F.col("tier").isNull(), joins.range_value(F.col("_day"), V.ADMINISTRATIONS, k)) for k, c in enumerate(("admin", "admin_ideology"))}
    linked = linked.withColumns({c: F.coalesce(F.col(c), v) for c, v in inferred.items()})
    rest = s.filter(~ministers)
    return linked.drop("tier").unionByName(rest, allowMissingColumns=True).drop("_day", "_at")


def dyads(s: DataFrame) -> DataFrame:
    """Question and answer pairs in numeric order of speeches, context from the legislator's."""
    keyed = s.withColumn("_uid", F.coalesce("member_uid", "member_id"))
    return pairs.dyads(keyed, "meeting_id", "speech_order", "role", context=CONTEXT, leg=LEG, witness=WITNESS).select(*DYADS)


def dyads_for_new(s: DataFrame, old: DataFrame) -> DataFrame:
    """The old dyads and those of meetings that have none yet."""
    fresh = s.join(old.select("meeting_id").distinct(), "meeting_id", "left_anti")
    return old.unionByName(dyads(fresh))


def build(spark, speeches: DataFrame, out: str, members: DataFrame | None = None, panel: DataFrame | None = None, details: DataFrame | None = None, dry_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """Writes enriched speeches and their dyads under `out`; returns both. The dyads come from
    the written speeches, so rules run once."""
    s = cleaned(aligned(speeches))
    if members is not None:
        s = with_members(s, members)
    if panel is not None:
        s = with_ministers(s, panel)
    if details is not None:
        s = with_conferences(s, details)
    path = f"{out}/speeches.parquet"
    if datasets.write_table(s, path, dry_run):
        s = spark.read.parquet(path)
    d = dyads(s)
    datasets.write_table(d, f"{out}/dyads.parquet", dry_run)
    return s, d
