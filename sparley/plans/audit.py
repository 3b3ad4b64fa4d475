"""A deep audit in ten phases, each a report of severity, check, key and value; a failing
phase becomes a CRITICAL finding of its own and the others go on.

All checks run on all rows. A check without a rule in LEVELS is information.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as V
from ..functions.expr import SOLID, SPACE, first_match, first_pattern, is_blank, parse_date, strip
from ..operators import groups, joins, pairs
from ..sources.datasets import use_checkpoints

#: Traces of a wrong decoding.
MOJIBAKE = ("â€™", "â€œ", "â€\u009d", "Ã¤|Ã¶|Ã¼", r"\x00", r"\\u[0-9a-f]{4}", "�")
HTML_TAG = "<[a-zA-Z/][^>]*>"
HANGUL = "[가-힣]"
#: Terms in which a committee existed.
COMMITTEE_TERMS = {"education_science": (18, 19), "education_culture": (20, 21, 22), "culture_media": (18, 19)}


#: When a check's value is worse than OK, the worst first.
LEVELS: dict[str, tuple[tuple[str, str], ...]] = {
    "date_parse_rate": (("ISSUE", "value < 0.99"), ("WARN", "value < 1")),
    "date_out_of_term": (("ISSUE", "value > 0"),),
    "date_blank": (("ISSUE", "value > 0"),),
    "date_month_gap": (("WARN", "value > 0"),),
    "meeting_several_dates": (("ISSUE", "value > 0"),),
    "id_not_numeric": (("WARN", "value > 0"),),
    "id_several_names": (("ISSUE", "value > 1"),),
    "id_other_role": (("ISSUE", "value > 0"),),
    "name_in_speaker": (("ISSUE", "value < 0.95"), ("WARN", "value < 0.99")),
    "name_blank": (("ISSUE", "value >= 100"), ("WARN", "value > 0")),
    "other_speeches": (("WARN", "value > 0"),),
    "chair_share": (("WARN", "value < 0.05 OR value > 0.35"),),
    "minister_odd_label": (("WARN", "value > 0"),),
    "meeting_gaps": (("WARN", "value > 0"),),
    "meeting_singletons": (("ISSUE", "value >= 100"), ("WARN", "value > 0")),
    "meeting_several_committee": (("ISSUE", "value > 0"),),
    "meeting_several_term": (("ISSUE", "value > 0"),),
    "meeting_several_hearing_type": (("ISSUE", "value > 0"),),
    "meeting_several_date": (("ISSUE", "value > 0"),),
    "text_mojibake": (("ISSUE", "value > 0"),),
    "text_markup": (("WARN", "value > 0"),),
    "text_repeated_in_meeting": (("WARN", "value > 0"),),
    "text_loose_share": (("WARN", "value > 0.01"),),
    "text_foreign": (("WARN", "value > 0"),),
    "committee_unexpected_term": (("WARN", "value > 0"),),
    "dyad_count_off_share": (("ISSUE", "value >= 0.01"), ("WARN", "value > 0")),
    "dyad_self_same_speaker": (("WARN", "value > 0"),),
    "dyad_self_homonyms": (("WARN", "value > 0"),),
    "dyad_orphan_meetings": (("CRITICAL", "value > 0"),),
    "gender_several": (("ISSUE", "value > 0"),),
    "naas_cd_several": (("WARN", "value > 0"),),
    "seniority_highest": (("WARN", "value > 15"),),
    "party_other_role": (("WARN", "value > 0"),),
    "dyad_text_off_share": (("ISSUE", "value >= 0.01"), ("WARN", "value > 0")),
}
SEVERITIES = ("OK", "INFO", "WARN", "ISSUE", "CRITICAL")


def severity() -> Column:
    """Of the columns check and value."""
    cases = " ".join(f"WHEN check = '{c}' AND ({when}) THEN '{level}'" for c, rules in LEVELS.items() for level, when in rules)
    known = ", ".join(f"'{c}'" for c in LEVELS)
    return F.expr(f"CASE {cases} WHEN check IN ({known}) THEN 'OK' ELSE 'INFO' END")


def _rows(df: DataFrame, check: str, key: str | None, value: str) -> DataFrame:
    return df.select(F.lit(check).alias("check"), (F.col(key) if key else F.lit(None)).cast("string").alias("key"), F.col(value).cast("double").alias("value"))


def _union(parts: Iterable[DataFrame]) -> DataFrame:
    first, *rest = parts
    for p in rest:
        first = first.unionByName(p)
    return first


def text_quality(df: DataFrame, text: str, group: str, script: str = HANGUL) -> DataFrame:
    """Per group: rows, and those with mojibake, markup, doubled spaces, very short texts and
    texts of over 20 characters of which under a tenth is of the expected script."""
    t = F.coalesce(F.col(text), F.lit(""))
    letters = F.regexp_count(t, F.lit(script))
    return df.groupBy(group).agg(
        F.count("*").alias("n"),
        F.count_if(t.rlike("|".join(MOJIBAKE))).alias("mojibake"),
        F.count_if(t.rlike(HTML_TAG)).alias("markup"),
        F.count_if(t.contains("  ") | t.startswith(" ")).alias("loose_spaces"),
        F.count_if(F.length(t) < 10).alias("short"),
        F.count_if((F.length(t) > 20) & (letters < 0.1 * F.length(t))).alias("foreign"),
    )


def repeated_texts(df: DataFrame, group: str, text: str, least: int = 30) -> DataFrame:
    """Texts over a length that a group has more than once, as rows beyond the first."""
    long = df.filter(F.length(text) > least).groupBy(group, F.md5(text).alias("digest")).agg(F.count("*").alias("n")).filter("n > 1")
    return long.groupBy(group).agg(F.sum(F.col("n") - 1).cast("long").alias("extra"))


def out_of_range(df: DataFrame, key: str, date: str, ranges: DataFrame, days: int = 30) -> DataFrame:
    """Rows of each key outside its closed range of dates, `days` of grace on both sides."""
    r = ranges.select(F.col(key).alias("_k"), F.date_sub("first_day", days).alias("_a"), F.date_add("last_day", days).alias("_b"))
    bad = df.join(r, F.col(key) == F.col("_k")).filter(~F.col(date).cast("date").between(F.col("_a"), F.col("_b")))
    return bad.groupBy(key).agg(F.count("*").alias("n"), F.min(F.col(date).cast("date")).alias("first_day"), F.max(F.col(date).cast("date")).alias("last_day"))


def _top(df: DataFrame, check: str, key: str, k: int) -> DataFrame:
    return _rows(groups.top(df.withColumn("_top", F.col(key).cast("string")), "_top", k), check, "_top", "n")


def _joined(*columns: str) -> Column:
    return F.concat_ws("/", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns))


def _each(df: DataFrame, check: str, *columns: str, value: Column | None = None) -> DataFrame:
    return _rows(df.groupBy(_joined(*columns).alias("key")).agg((F.count("*") if value is None else value).alias("n")), check, "key", "n")


def _meetings_with(s: DataFrame, column: str) -> DataFrame:
    return s.groupBy("meeting_id").agg(F.count_distinct(column).alias("k")).agg(F.count_if(F.col("k") > 1).alias("k"))


def phase1(s: DataFrame, d: DataFrame) -> DataFrame:
    """Dates: how many parse, those outside of their term, blanks, months without a meeting,
    each term's first and last day (as days since 1970), meetings of several dates."""
    dated = s.withColumn("_d", parse_date("date"))
    one = dated.agg(F.avg(F.col("_d").isNotNull().cast("double")).alias("parsed"), F.count_if(is_blank("date")).alias("blank"))
    ranges = s.sparkSession.createDataFrame(list(V.TERM_DAYS), "term int, first_day string, last_day string").withColumns({c: F.col(c).cast("date") for c in ("first_day", "last_day")})
    out = out_of_range(dated, "term", "_d", ranges)
    days = dated.filter("_d IS NOT NULL").groupBy("term").agg(F.unix_date(F.min("_d")).alias("low"), F.unix_date(F.max("_d")).alias("high"))
    return _union([_rows(one, "date_parse_rate", None, "parsed"), _rows(out, "date_out_of_term", "term", "n"), _rows(one, "date_blank", None, "blank"), _rows(groups.month_gaps(dated, "_d"), "date_month_gap", "first_month", "gap"), _rows(days, "date_first_day", "term", "low"), _rows(days, "date_last_day", "term", "high"), _rows(_meetings_with(s, "date"), "meeting_several_dates", None, "k")])


def phase2(s: DataFrame, d: DataFrame) -> DataFrame:
    """Identities: ids and names that don't belong together, names that labels don't have,
    how many terms legislators span."""
    members = s.filter(~is_blank("member_id")).withColumns({"member_id": strip("member_id"), "person_name": strip("person_name")})
    odd = members.filter(~F.col("member_id").rlike("^[0-9]+$")).agg(F.count_distinct("member_id").alias("n"))
    names, ids = groups.several_values(members, "member_id", "person_name"), groups.several_values(members, "person_name", "member_id")
    legislators = F.col("role").isin(*V.LEGISLATOR_ROLES)
    spans = members.filter(legislators).groupBy("member_id").agg(F.count_distinct("term").alias("terms"))
    wrong = members.filter(~legislators).agg(F.count("*").alias("n"))
    named = s.filter(~is_blank("person_name"))
    inside = named.agg(F.avg(F.coalesce(F.contains(F.col("speaker"), F.col("person_name")), F.lit(False)).cast("double")).alias("n"))
    blank = s.agg(F.count_if(is_blank("person_name")).alias("n"))
    return _union([_rows(odd, "id_not_numeric", None, "n"), _rows(names, "id_several_names", "member_id", "n_values"), _rows(ids, "name_several_ids", "person_name", "n_values"), _each(spans, "id_terms", "terms"), _rows(wrong, "id_other_role", None, "n"), _rows(inside, "name_in_speaker", None, "n"), _rows(blank, "name_blank", None, "n")])


def phase3(s: DataFrame, d: DataFrame) -> DataFrame:
    """Roles: speakers without a role of their own and what it could be, speakers of several
    roles, chairs' share by term, roles by hearing type, labels of ministers."""
    other = s.filter("role = 'other'")
    suggested = groups.top(other, "speaker", 100).withColumn("role", first_pattern("speaker", V.SUGGESTED_ROLES)).filter("role IS NOT NULL").withColumn("key", F.concat_ws(" > ", "speaker", "role"))
    chairs = s.filter(F.col("role").isin(*V.LEGISLATOR_ROLES)).groupBy("term").agg(F.avg((F.col("role") == "chair").cast("double")).alias("share"))
    many = s.groupBy("speaker").agg(F.count("*").alias("n"), F.count_distinct("role").alias("roles")).filter("n >= 10 AND roles > 1")
    label = strip("speaker")
    kinds = s.filter("role = 'minister'").withColumn("kind", first_match([(label.rlike(rf"장관{SPACE}+{SOLID}"), "named"), (label.rlike("장관$"), "unnamed"), (label.contains("장관"), "other label")], "no keyword"))
    odd = kinds.agg(F.count_if(F.col("kind").isin("other label", "no keyword")).alias("n"))
    return _union([_rows(other.agg(F.count("*").alias("n")), "other_speeches", None, "n"), _top(other, "other_speaker", "speaker", 50), _rows(suggested, "other_suggested", "key", "n"), _rows(many, "speaker_several_roles", "speaker", "roles"), _rows(chairs, "chair_share", "term", "share"), _each(s, "type_role", "hearing_type", "role"), _each(kinds, "minister_label", "kind"), _rows(odd, "minister_odd_label", None, "n")])


def phase4(s: DataFrame, d: DataFrame) -> DataFrame:
    """Meetings: gaps, singletons, sizes, several values of what should be one, who speaks."""
    gaps = groups.continuity(s, "meeting_id", "speech_order").agg(F.count_if("gap").alias("n"), F.count_if(F.col("not_numbers") > 0).alias("bad"))
    sizes = s.groupBy("meeting_id").agg(F.count("*").alias("size"))
    stats = sizes.agg(F.count_if(F.col("size") == 1).alias("single"), F.avg("size").alias("mean"), *(F.percentile("size", p).alias(f"q{int(100 * p)}") for p in (0.25, 0.5, 0.75)), F.max("size").alias("largest"))
    mixed = [_rows(_meetings_with(s, c), f"meeting_several_{c}", None, "k") for c in ("committee", "term", "hearing_type", "date")]
    return _union([
        _rows(gaps, "meeting_gaps", None, "n"), _rows(gaps, "meeting_odd_order", None, "bad"), _rows(stats, "meeting_singletons", None, "single"),
        *(_rows(stats, f"meeting_size_{c}", None, c) for c in ("mean", "q25", "q50", "q75", "largest")), _rows(groups.size_outliers(s, "meeting_id"), "meeting_large", "meeting_id", "size"), *mixed,
        _each(pairs.sidedness(s, "meeting_id", "role"), "meeting_sides", "sides"), _each(s, "meetings", "term", value=F.count_distinct("meeting_id")),
    ])


def phase5(s: DataFrame, d: DataFrame) -> DataFrame:
    """Texts: traces of wrong decoding and markup, lengths by role, extremes, short and
    repeated ones, loose spaces, other scripts."""
    quality = text_quality(s, "speech_text", "role")
    long = s.withColumn("_l", F.length("speech_text"))
    lengths = groups.spread(long, "role", "_l")
    top = long.agg(F.percentile("_l", 0.999).alias("p"))
    largest = groups.largest(long.withColumn("key", _joined("meeting_id", "speech_order")).select("key", "_l"), "_l", 10, "key")
    short = long.filter("_l < 10")
    loose = quality.agg((F.sum("loose_spaces") / F.sum("n")).alias("share"))
    repeated = repeated_texts(s, "meeting_id", "speech_text").agg(F.count("*").alias("n"))
    return _union([
        *(_rows(quality, f"text_{c}", "role", c) for c in ("mojibake", "markup", "short", "foreign")), *(_rows(lengths, f"text_length_{c}", "role", c) for c in ("mean", "median", "high")),
        _rows(top, "text_p999_length", None, "p"), _rows(largest, "text_longest", "key", "_l"), _top(short, "text_short_top", "speech_text", 30), _rows(repeated, "text_repeated_in_meeting", None, "n"), _rows(loose, "text_loose_share", None, "share"),
    ])


def phase6(s: DataFrame, d: DataFrame) -> DataFrame:
    """Committees: raw names of a key, keys by term and hearing type, terms that a committee
    didn't exist in, subcommittees."""
    raw = s.groupBy("committee_key").agg(F.count_distinct("committee").alias("n"))
    wrong = F.lit(False)
    for key, terms in COMMITTEE_TERMS.items():
        wrong = wrong | ((F.col("committee_key") == key) & ~F.col("term").isin(*terms))
    parts = s.filter(F.col("committee").rlike(V.SUBCOMMITTEE))
    return _union([_rows(raw, "committee_raw_names", "committee_key", "n"), _each(s, "committee_mapping", "committee", "committee_key"), _each(s, "committee_term", "committee_key", "term"), _each(s.filter(wrong), "committee_unexpected_term", "committee_key", "term"), _each(parts, "committee_sub", "committee_key"), _each(s, "committee_type_meetings", "committee_key", "hearing_type", value=F.count_distinct("meeting_id"))])


def phase7(s: DataFrame, d: DataFrame) -> DataFrame:
    """Dyads: the recount of every meeting, pairs with oneself and with homonyms, one-sided
    meetings, meetings that speeches lack, roles that pair more or less often than they speak."""
    off = pairs.recount(s, d, "meeting_id", "speech_order", "role").agg(F.count_if(F.col("difference") != 0).alias("n"), F.avg((F.col("difference") != 0).cast("double")).alias("share"))
    own = F.col("leg_name") == F.col("witness_name")
    same = F.col("leg_speaker_raw").eqNullSafe(F.col("witness_speaker_raw"))
    selves = d.agg(F.count_if(own & same).alias("same"), F.count_if(own & ~same).alias("other"))
    ratio = d.groupBy("meeting_id").agg(F.count("*").alias("n"), F.avg((F.col("direction") == "question").cast("double")).alias("q")).filter("n >= 10 AND (q < 0.2 OR q > 0.8)").agg(F.count("*").alias("n"))
    lost = joins.orphans(d.select("meeting_id").distinct(), s, "meeting_id").agg(F.count("*").alias("n"))
    answering = s.filter(F.col("role").isin(*V.NONLEGISLATOR_ROLES))
    change = joins.distribution_change(answering, d.select(F.col("witness_role").alias("role")), "role").withColumn("ratio", F.try_divide("n_after", "n_before"))
    return _union([_rows(off, "dyad_count_off", None, "n"), _rows(off, "dyad_count_off_share", None, "share"), _rows(selves, "dyad_self_same_speaker", None, "same"), _rows(selves, "dyad_self_homonyms", None, "other"), _rows(ratio, "dyad_one_sided", None, "n"), _rows(lost, "dyad_orphan_meetings", None, "n"), _rows(change, "dyad_role_ratio", "role", "ratio")])


def phase8(s: DataFrame, d: DataFrame) -> DataFrame:
    """Further columns, where there are any: values, several of a member, ranges."""
    have = [c for c in ("gender", "party", "ruling_status", "seniority", "session", "sub_session", "naas_cd", "name_clean") if c in s.columns]
    members = s.filter(~is_blank("member_id"))
    parts = [_rows(s.agg(F.lit(len(have)).alias("n")), "columns_present", None, "n")]
    if "gender" in have:
        parts += [_each(s, "gender_values", "gender"), _rows(groups.several_values(members, "member_id", "gender").agg(F.count("*").alias("n")), "gender_several", None, "n")]
    if "party" in have:
        filled = ~is_blank("party", ("",)) & ~F.col("role").isin(*V.LEGISLATOR_ROLES)
        parts += [_top(members, "party_top", "party", 30), _rows(s.agg(F.count_if(filled).alias("n")), "party_other_role", None, "n")]
    if "ruling_status" in have:
        parts.append(_each(s, "ruling_status_values", "ruling_status"))
    if "seniority" in have:
        one = members.agg(F.min("seniority").alias("low"), F.max("seniority").alias("high"), F.avg("seniority").alias("mean"), F.avg(F.col("seniority").isNull().cast("double")).alias("none"))
        parts += [_rows(one, "seniority_lowest", None, "low"), _rows(one, "seniority_highest", None, "high"), _rows(one, "seniority_mean", None, "mean"), _rows(one, "seniority_null_share", None, "none")]
    if "session" in have:
        parts.append(_each(s, "sessions", "term", value=F.count_distinct("session")))
    if "naas_cd" in have:
        parts.append(_rows(groups.several_values(members, "member_id", "naas_cd").agg(F.count("*").alias("n")), "naas_cd_several", None, "n"))
    return _union(parts)


def phase9(s: DataFrame, d: DataFrame) -> DataFrame:
    """Each meeting's first five pairs by position against those formed anew, where dyads have
    the order of the asking side; all pairs of a meeting regardless of order, where they don't."""
    made = pairs.dyads(s, "meeting_id", "speech_order", "role", leg={"leg_speech": "speech_text"}, witness={"witness_speech": "speech_text"})
    if "speech_order" in d.columns:
        row = pairs.aligned(made, d, "meeting_id", "speech_order", ["direction", "leg_speech", "witness_speech"]).agg(F.count_if(~F.col("same")).alias("n"), F.avg((~F.col("same")).cast("double")).alias("share"))
    else:
        text = F.md5(F.concat_ws("\u0001", "leg_speech", "witness_speech")).alias("t")
        per = lambda df, n: df.groupBy("meeting_id", "direction", text).agg(F.count("*").alias(n))
        both = per(made, "a").join(per(d, "b"), ["meeting_id", "direction", "t"], "full").na.fill(0, ["a", "b"])
        row = both.agg(F.sum(F.abs(F.col("a") - F.col("b"))).alias("n"), (F.sum(F.abs(F.col("a") - F.col("b"))) / F.sum(F.greatest("a", "b"))).alias("share"))
    return _union([_rows(row, "dyad_text_off", None, "n"), _rows(row, "dyad_text_off_share", None, "share")])


def phase10(s: DataFrame, d: DataFrame) -> DataFrame:
    """Numbers as a whole: first digits of meeting sizes, speeches of legislators, meetings and
    speeches of terms, the last term, the committee that meets in private, audits' share."""
    digits = groups.leading_digits(s.groupBy("meeting_id").agg(F.count("*").alias("n")), "n")
    people = s.filter(F.col("role").isin(*V.LEGISLATOR_ROLES) & ~is_blank("member_id")).groupBy("member_id").agg(F.count("*").alias("n"))
    quartiles = people.agg(*(F.percentile("n", p).alias(f"q{int(100 * p)}") for p in (0.25, 0.5, 0.75)), F.avg("n").alias("mean"))
    last = s.filter(F.col("term") == max(V.TERMS)).agg(F.count("*").alias("n"), F.count_distinct("meeting_id").alias("m"))
    private = s.filter("committee_key = 'intelligence'").agg(F.count("*").alias("n"), F.count_distinct("meeting_id").alias("m"))
    audits, usual = F.count_if(F.col("hearing_type") == "국정감사"), F.count_if(F.col("hearing_type") == "상임위원회")
    ratio = s.groupBy("term").agg(F.try_divide(audits, audits + usual).alias("share"))
    return _union([
        _rows(digits, "first_digit_share", "digit", "share"), *(_rows(quartiles, f"speeches_per_legislator_{q}", None, q) for q in ("q25", "q50", "q75", "mean")), _rows(groups.largest(people, "n", 10, "member_id"), "legislator_top", "member_id", "n"),
        _each(s, "term_speeches", "term"), _each(s, "term_meetings", "term", value=F.count_distinct("meeting_id")), _rows(last, "last_term_speeches", None, "n"), _rows(last, "last_term_meetings", None, "m"),
        _rows(private, "intelligence_speeches", None, "n"), _rows(private, "intelligence_meetings", None, "m"), _rows(ratio, "audit_share", "term", "share"),
    ])


PHASES: dict[int, Callable[[DataFrame, DataFrame], DataFrame]] = {1: phase1, 2: phase2, 3: phase3, 4: phase4, 5: phase5, 6: phase6, 7: phase7, 8: phase8, 9: phase9, 10: phase10}


def audit(s: DataFrame, d: DataFrame, phases: Iterable[int] = tuple(PHASES)) -> DataFrame:
    """phase, severity, check, key, value. Each phase is run by itself and its report kept by a
    checkpoint, so that one that fails is a row CRITICAL and the others go on."""
    spark, parts = s.sparkSession, []
    use_checkpoints(spark)
    for k in phases:
        try:
            found = PHASES[k](s, d).select(F.lit(k).alias("phase"), severity().alias("severity"), "check", "key", F.round("value", 6).alias("value"))
            parts.append(found.checkpoint(eager=True))
        except Exception as error:  # a finding, not the audit's end
            parts.append(spark.createDataFrame([(k, "CRITICAL", f"phase{k}_error", str(error)[:300], None)], "phase int, severity string, check string, key string, value double"))
    return _union(parts)


def exit_status(found: DataFrame) -> int:
    """2 where a finding is critical, 1 where one is an issue, else 0."""
    worst = {r["severity"] for r in found.select("severity").distinct().collect()}
    return 2 if "CRITICAL" in worst else int("ISSUE" in worst)


def investigate(old: DataFrame, new: DataFrame, d: DataFrame) -> DataFrame:
    """Why versions differ: role changes, duplicate profiles, transitions, recounts of both."""
    changes = joins.changed_values(old, new, ["meeting_id", "speech_order"], "role").withColumn("key", F.concat_ws(" > ", "old_value", "new_value"))
    profile = groups.duplicate_profile(new, ["meeting_id", "speech_order"], ["role", "speaker", "speech_text", "hearing_type"])
    same = profile.agg(F.count("*").alias("n"), *(F.avg(F.col(f"same_{a}").cast("double")).alias(a) for a in ("role", "speaker", "speech_text", "hearing_type")))
    steps = pairs.transitions(new, "meeting_id", "speech_order", "role").withColumn("key", F.concat_ws(" > ", "from_role", "to_role"))
    parts = [_rows(changes, "role_change", "key", "n"), _rows(same, "duplicate_keys", None, "n"), *(_rows(same, f"duplicates_same_{a}", None, a) for a in ("role", "speaker", "speech_text", "hearing_type")), _rows(steps, "transition", "key", "n")]
    for name, df in (("old", old), ("new", new)):
        diff = pairs.recount(df, d, "meeting_id", "speech_order", "role").filter("difference <> 0")
        stats = diff.agg(F.count("*").alias("n"), F.avg("difference").alias("mean"), F.percentile("difference", 0.5).alias("median"), F.min("difference").alias("low"), F.max("difference").alias("high"))
        parts += [_rows(stats, f"recount_{name}_{c}", None, c) for c in ("n", "mean", "median", "low", "high")]
    return _union(parts)
