"""Rules on transcript records: roles, names, titles, ministries, identities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed_values as V
from .expr import col, extract, first_match, first_pattern, is_blank, joined, mapped, null_if_blank, strip

HANGUL_NAME = "[가-힣]{2,4}"
PARTY_MARK = r"\([가-힣새한비국평]\)"


def classify_speaker(speaker: Column | str, member_id: Column | str, rules: Sequence[tuple[str, str, str, str]] = V.SPEAKER_RULES) -> Column:
    """struct(role, person, affiliation) by the first rule that a label meets.

    A rule has a role, a keyword pattern (MEMBER: the row has a member id), where the
    person is (after the last keyword, the last word, the label without a word, the whole)
    and what the affiliation is (the text before the first keyword, the whole, nothing).
    """
    name = strip(F.coalesce(col(speaker), F.lit("")))
    last_word = F.element_at(F.split(name, r"[\s\p{Z}]+"), -1)

    def person(keyword: str, where: str) -> Column:
        kind, _, argument = where.partition(":")
        return {
            "after": lambda: strip(F.regexp_replace(name, f".*({argument or keyword})[\\s\\p{{Z}}]*", "")),
            "without": lambda: strip(F.regexp_replace(name, argument, "")),
            "last": lambda: last_word,
            "whole": lambda: name,
        }[kind]()

    def result(role: str, who: Column, affiliation: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), who.alias("person"), affiliation.alias("affiliation"))

    cases = [(name == "", result("unknown", F.lit(""), F.lit("")))]
    for role, keyword, where, what in rules:
        met = ~is_blank(member_id, ("", "nan", "0")) if keyword == "MEMBER" else name.rlike(keyword)
        affiliation = {"whole": name, "none": F.lit(""), "before": strip(F.regexp_replace(name, f"({keyword}).*", ""))}[what]
        cases.append((met, result(role, person(keyword, where), affiliation)))
    return first_match(cases, result("other", name, name))


def extract_title(person_name: Column | str) -> Column:
    """struct(name, title): a title in front of a name, and an honorific behind it, come off
    where something is left of the name."""
    name = strip(col(person_name))
    bare = lambda prefix: strip(F.substring(name, len(prefix) + 1, 1 << 20))
    fits = [(name.startswith(p) & (bare(p) != ""), bare(p), title) for p, title in V.TITLE_PREFIXES]
    rest = first_match(((c, n) for c, n, _ in fits), name)
    title = first_match((c, t) for c, _, t in fits)
    behind = "|".join(V.NAME_SUFFIXES)
    short = strip(F.regexp_replace(rest, f" ?({behind})$", ""))
    return F.struct(F.when(short != "", short).otherwise(rest).alias("name"), title.alias("title"))


def reclassify_other(role: Column | str, speaker: Column | str, rules: Sequence[tuple[str, str]] = V.OTHER_RULES + V.OTHER_RULES_MORE) -> Column:
    return F.when(col(role) == "other", F.coalesce(first_pattern(speaker, rules), col(role))).otherwise(col(role))


def repair_role(role: Column | str, speaker: Column | str, member_id: Column | str) -> Column:
    """Members whose role isn't a legislator's are chairs or legislators; acting ministers get their role."""
    member = ~is_blank(member_id) & ~F.coalesce(col(role).isin(*V.LEGISLATOR_ROLES), F.lit(False))
    chair = F.coalesce(col(speaker).contains("위원장"), F.lit(False))
    return first_match([(member & chair, "chair"), (member, "legislator"), ((col(role) == "minister") & col(speaker).contains("장관직무대리"), "minister_acting")], col(role))


def normalize_ministry(raw: Column | str) -> Column:
    """The ministry that a title names; null for blanks and for what isn't a ministry."""
    text = strip(col(raw))
    garbage = text.rlike(V.MINISTRY_GARBAGE)
    out = text
    for pattern, put in V.MINISTRY_STEPS:
        pattern = pattern.replace(r"\S", r"[^\s\p{Z}]").replace(r"\s", r"[\s\p{Z}]").replace(r"[^[\s\p{Z}]\p{Z}]", r"[^\s\p{Z}]")
        out = F.regexp_replace(out, pattern, "$1" if put else "")
    out = mapped(strip(out), V.MINISTRY_TYPOS)
    out = mapped(strip(F.regexp_replace(out, "제[12]$", "")), V.MINISTRY_HISTORY)
    long = (F.length(out) >= 10) & ~out.rlike(V.MINISTRY_ENDINGS)
    return F.when(~F.coalesce(garbage | out.rlike(V.MINISTRY_REJECT) | long | (out == ""), F.lit(True)), out)


def ministry_of(role: Column | str, affiliation: Column | str) -> Column:
    return F.when(col(role).isin(*V.GOVERNMENT_ROLES), normalize_ministry(affiliation))


def fix_name(name: Column | str) -> Column:
    return mapped(name, V.NAME_TYPOS)


def recover_name(person_name: Column | str, speaker: Column | str) -> Column:
    """A missing name, from a label of a name and a title."""
    return F.when(is_blank(person_name, ("", "nan")), F.coalesce(extract(strip(col(speaker)), rf"^({HANGUL_NAME})[\s\p{{Z}}]+(위원장|위원|의원|장관)"), col(person_name))).otherwise(col(person_name))


def move_bad_title(title: Column | str, affiliation: Column | str) -> Column:
    """struct(title, affiliation): a title that is none goes in front of the affiliation."""
    bad = col(title).isNotNull() & ~col(title).isin(*V.PERSON_TITLES)
    return F.struct(F.when(~bad, col(title)).alias("title"), F.when(bad, joined(title, F.when(strip(affiliation) != "", col(affiliation)))).otherwise(col(affiliation)).alias("affiliation"))


def split_name(person_name: Column | str, affiliation: Column | str, member_id: Column | str) -> Column:
    """struct(person_name, affiliation): for people without a member id, a name of two to
    four syllables at the end of a longer text is split from what stands before it."""
    name = col(person_name)
    skip = is_blank(name, ("", "nan", "None")) | name.rlike(f"^{HANGUL_NAME}({PARTY_MARK})?$") | name.rlike("^[가-힣]?0+$|^O+$") | name.rlike("[a-zA-Z]")
    marked, plain = rf"(.+?)[\s\p{{Z}}]*({HANGUL_NAME}{PARTY_MARK})$", rf"(.+?)[\s\p{{Z}}]*({HANGUL_NAME})$"
    front = strip(F.coalesce(extract(name, marked, 1), extract(name, plain, 1)))
    own = F.coalesce(extract(name, marked, 2), extract(name, plain, 2))
    split = ~skip & col(member_id).isNull() & own.isNotNull()
    old = null_if_blank(affiliation, ("", "nan", "None"))
    return F.struct(
        F.when(split, own).otherwise(name).alias("person_name"),
        F.when(split & (front != ""), joined(front, old)).otherwise(col(affiliation)).alias("affiliation"),
    )


def committee_key(committee: Column | str, table: Sequence[tuple[str, str]] = V.COMMITTEES, default: str = "other") -> Column:
    """The key of a committee, whatever subcommittee follows its name."""
    main = strip(F.regexp_replace(col(committee), "-.*$", ""))
    return first_match([(main == name, key) for name, key in table], default)


def disambiguate(df: DataFrame, homonyms: Sequence[tuple[str, str, str]] = V.HOMONYMS, member: str = "member_id", code: str = "naas_cd", term: str = "term") -> DataFrame:
    """df with member_uid: ids that two people share are told apart by a code, a missing one
    being the most frequent of that id and term (the smallest of equals)."""
    shared = sorted({m for m, _, _ in homonyms})
    usual = df.filter(F.col(member).isin(shared) & F.col(code).isNotNull()).groupBy(F.col(member).alias("_m"), F.col(term).alias("_t")).agg(F.mode(code, deterministic=True).alias("_usual"))
    joined_ = df.join(usual, F.col(member).eqNullSafe(F.col("_m")) & F.col(term).eqNullSafe(F.col("_t")), "left")
    own = F.coalesce(F.col(code), F.col("_usual"))
    uid = first_match([((F.col(member) == m) & (own == c), u) for m, c, u in homonyms], F.col(member))
    return joined_.withColumn("member_uid", uid).drop("_m", "_t", "_usual")


def homogenize(df: DataFrame, columns: Sequence[str], uids: Sequence[str] = tuple(u for _, _, u in V.HOMONYMS), uid: str = "member_uid") -> DataFrame:
    """Values that differ within one of the told-apart ids become its most frequent one; nulls stay."""
    modes = df.filter(F.col(uid).isin(*uids)).groupBy(F.col(uid).alias("_u")).agg(*(F.mode(c, deterministic=True).alias(f"_{c}") for c in columns))
    out = df.join(modes, F.col(uid) == F.col("_u"), "left")
    for c in columns:
        out = out.withColumn(c, F.when(F.col(c).isNotNull(), F.coalesce(F.col(f"_{c}"), F.col(c))))
    return out.drop("_u", *(f"_{c}" for c in columns))
