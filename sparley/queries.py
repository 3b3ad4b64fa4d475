"""Queries of the library on the driver's tables, each with DuckDB SQL of its own.

Conversations stand in for transcripts: conv_id, turn, role and text are a meeting, its
order, a speaker's role and the speech; user asks, assistant answers, system is neutral.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import fixed_values as V
from .functions import rules
from .functions.expr import date_text, first_match, joined, normalize_text, null_if_blank, padded
from .operators import groups, joins, pairs
from .plans import audit, build, validation
from .sources import datasets
from .streaming import append

ASKS, ANSWERS = ("user",), ("assistant",)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def keep(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return keep


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Reading and summaries


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def load_filtered(spark, sf_dir):
    return datasets.scan(read(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_totalprice"], o_orderstatus="F", o_orderpriority="1-URGENT", o_custkey=None)


@query("""
SELECT 'rows' AS item, CAST(NULL AS VARCHAR) AS value, count(*) AS n FROM orders
UNION ALL SELECT 'distinct o_orderstatus', NULL, count(DISTINCT o_orderstatus) FROM orders
UNION ALL SELECT 'by o_orderstatus', o_orderstatus, count(*) FROM orders GROUP BY 2
UNION ALL SELECT 'distinct o_orderpriority', NULL, count(DISTINCT o_orderpriority) FROM orders
UNION ALL SELECT 'by o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2""")
def info_by_group(spark, sf_dir):
    return datasets.summary(read(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


# Adjacent pairs

_PAIRS = """
nx AS (SELECT conv_id, turn, role, text, lead(turn) OVER w AS turn2, lead(role) OVER w AS role2, lead(text) OVER w AS text2 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
dy AS (SELECT conv_id, CASE WHEN role = 'user' THEN turn ELSE turn2 END AS turn, CASE WHEN role = 'user' THEN 'question' ELSE 'answer' END AS direction,
              CASE WHEN role = 'user' THEN text ELSE text2 END AS leg_speech, CASE WHEN role = 'user' THEN text2 ELSE text END AS witness_speech
       FROM nx WHERE (role = 'user' AND role2 = 'assistant') OR (role = 'assistant' AND role2 = 'user'))"""


def _dyads(spark, sf_dir):
    return pairs.dyads(read(spark, sf_dir, "conversations"), "conv_id", "turn", "role", ASKS, ANSWERS, leg={"leg_speech": "text"}, witness={"witness_speech": "text"})


@query(f"WITH {_PAIRS} SELECT * FROM dy")
def dyads(spark, sf_dir):
    return _dyads(spark, sf_dir)


@query(f"WITH {_PAIRS} SELECT conv_id, count(*) AS n, count(*) FILTER (direction = 'question') AS questions, count(*) FILTER (direction = 'question') / count(*)::DOUBLE AS question_share FROM dy GROUP BY conv_id")
def dyad_direction_balance(spark, sf_dir):
    asked = F.count_if(F.col("direction") == "question")
    return _dyads(spark, sf_dir).groupBy("conv_id").agg(F.count("*").alias("n"), asked.alias("questions"), (asked / F.count("*")).alias("question_share"))


@query(f"""
WITH {_PAIRS}, a AS (SELECT conv_id, count(*) AS actual FROM (SELECT conv_id FROM dy UNION ALL SELECT conv_id FROM dy WHERE conv_id % 7 = 0 UNION ALL SELECT -conv_id - 1 FROM dy WHERE conv_id % 11 = 0) GROUP BY 1), e AS (SELECT conv_id, count(*) AS expected FROM dy GROUP BY 1)
SELECT conv_id, coalesce(expected, 0) AS expected, coalesce(actual, 0) AS actual, coalesce(actual, 0) - coalesce(expected, 0) AS difference FROM e FULL JOIN a USING (conv_id)""")
def dyad_recount(spark, sf_dir):
    """Against all dyads and planted faults: those of every seventh conversation twice, and some
    of conversations that don't exist."""
    made = _dyads(spark, sf_dir).select("conv_id")
    there = made.unionByName(made.filter("conv_id % 7 = 0")).unionByName(made.filter("conv_id % 11 = 0").select((-F.col("conv_id") - 1).alias("conv_id")))
    return pairs.recount(read(spark, sf_dir, "conversations"), there, "conv_id", "turn", "role", ASKS, ANSWERS)


@query(f"WITH {_PAIRS} SELECT role AS from_role, role2 AS to_role, count(*) AS n FROM nx WHERE turn2 IS NOT NULL GROUP BY ALL")
def transitions(spark, sf_dir):
    return pairs.transitions(read(spark, sf_dir, "conversations"), "conv_id", "turn", "role")


@query("SELECT conv_id, CASE WHEN bool_or(role = 'user') AND bool_or(role = 'assistant') THEN 'both' WHEN bool_or(role = 'user') THEN 'leg_only' WHEN bool_or(role = 'assistant') THEN 'nonleg_only' ELSE 'neither' END AS sides FROM conversations GROUP BY 1")
def sidedness(spark, sf_dir):
    return pairs.sidedness(read(spark, sf_dir, "conversations"), "conv_id", "role", ASKS, ANSWERS)


_DAMAGED = "CASE WHEN conv_id % 5 = 1 THEN concat(leg_speech, '!') ELSE leg_speech END"


@query(f"""
WITH {_PAIRS}, a AS (SELECT conv_id, turn, CASE WHEN conv_id % 7 = 2 THEN 'answer' ELSE direction END AS direction, {_DAMAGED} AS leg_speech FROM dy UNION ALL SELECT conv_id, -1, 'question', 'one more' FROM dy WHERE conv_id % 9 = 3 GROUP BY 1),
e AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, direction) AS place FROM dy), f AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, direction, leg_speech) AS place FROM a)
SELECT conv_id, CAST(place AS INT) AS place, e.direction IS NOT DISTINCT FROM f.direction AND e.leg_speech IS NOT DISTINCT FROM f.leg_speech AS same
FROM (SELECT * FROM e WHERE place <= 5) e FULL JOIN (SELECT * FROM f WHERE place <= 5) f USING (conv_id, place)""")
def dyad_alignment(spark, sf_dir):
    """Against dyads with damaged texts and directions, and some that shift all behind them."""
    made = _dyads(spark, sf_dir).select("conv_id", "turn", "direction", "leg_speech")
    damaged = made.withColumns({"direction": F.when(F.col("conv_id") % 7 == 2, "answer").otherwise(F.col("direction")), "leg_speech": F.expr(_DAMAGED)})
    more = made.filter("conv_id % 9 = 3").select("conv_id").distinct().select("conv_id", F.lit(-1).cast("long").alias("turn"), F.lit("question").alias("direction"), F.lit("one more").alias("leg_speech"))
    return pairs.aligned(made, damaged.unionByName(more), "conv_id", "turn", ["direction", "leg_speech"])


# Groups and order


@query("SELECT event_id, user_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) = 1")
def dedup_first(spark, sf_dir):
    return groups.dedup_first(read(spark, sf_dir, "events"), ["user_id", "event_type"], ["ts", "event_id"]).select("event_id", "user_id", "event_type")


@query("SELECT doc_id, count(*) OVER (PARTITION BY text) AS n_copies FROM documents")
def dup_groups(spark, sf_dir):
    return groups.flag_duplicates(read(spark, sf_dir, "documents").select("doc_id", F.xxhash64("text").alias("h"), F.md5("text").alias("m")), ["h", "m"]).select("doc_id", "n_copies")


@query("SELECT md5(text) AS digest, count(*) AS n, count(DISTINCT lang) = 1 AS same_lang, count(DISTINCT source) = 1 AS same_source FROM documents GROUP BY 1 HAVING count(*) > 1")
def dup_profile(spark, sf_dir):
    return groups.duplicate_profile(read(spark, sf_dir, "documents").withColumn("digest", F.md5("text")), ["digest"], ["lang", "source"])


@query("SELECT size, count(*) AS groups FROM (SELECT count(*) AS size FROM lineitem GROUP BY l_orderkey) GROUP BY size")
def multiplicities(spark, sf_dir):
    return groups.multiplicities(read(spark, sf_dir, "lineitem"), ["l_orderkey"])


@query("""
SELECT l_orderkey, n, 0::BIGINT AS not_numbers, low, high, missing, repeated, missing > 0 OR repeated > 0 AS gap FROM (
  SELECT l_orderkey, count(*) AS n, min(l_linenumber)::BIGINT AS low, max(l_linenumber)::BIGINT AS high,
         max(l_linenumber)::BIGINT - min(l_linenumber) + 1 - count(DISTINCT l_linenumber) AS missing, count(*) - count(DISTINCT l_linenumber) AS repeated
  FROM (SELECT l_orderkey, CASE WHEN l_quantity <= 5 THEN l_linenumber + 1 ELSE l_linenumber END AS l_linenumber FROM lineitem) GROUP BY 1)""")
def turn_continuity(spark, sf_dir):
    """Line numbers of small quantities are one too high, which leaves gaps and repeats."""
    number = F.when(F.col("l_quantity") <= 5, F.col("l_linenumber") + 1).otherwise(F.col("l_linenumber"))
    return groups.continuity(read(spark, sf_dir, "lineitem").select("l_orderkey", number.alias("l_linenumber")), "l_orderkey", "l_linenumber")


@query("SELECT l_orderkey, len(f) AS n_values, array_to_string(f, '|') AS found_values FROM (SELECT l_orderkey, list_sort(list(DISTINCT l_returnflag)) AS f FROM lineitem GROUP BY 1) WHERE len(f) > 1")
def meta_consistency(spark, sf_dir):
    return groups.several_values(read(spark, sf_dir, "lineitem"), "l_orderkey", "l_returnflag")


@query("""
WITH m AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS month FROM orders UNION SELECT DISTINCT (date_trunc('year', o_orderdate) - INTERVAL 40 YEAR)::DATE FROM orders),
g AS (SELECT lag(month) OVER (ORDER BY month) AS b, month, datediff('month', lag(month) OVER (ORDER BY month), month) - 1 AS gap FROM m)
SELECT (b + INTERVAL 1 MONTH)::DATE AS first_month, (month - INTERVAL 1 MONTH)::DATE AS last_month, CAST(gap AS INT) AS gap FROM g WHERE gap >= 3""")
def month_gaps(spark, sf_dir):
    """Over all orders and, forty years earlier, the first of each of their years, so there are gaps."""
    days = read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    early = days.select(F.add_months(F.trunc("day", "year"), -480).alias("day"))
    return groups.month_gaps(days.unionByName(early), "day")


@query("SELECT p_brand, first(p_name ORDER BY length(p_name), p_name) AS canonical FROM part GROUP BY 1")
def canonical_shortest(spark, sf_dir):
    return groups.shortest(read(spark, sf_dir, "part"), "p_brand", "p_name")


@query("SELECT p_brand, p_type AS usual FROM (SELECT p_brand, p_type, row_number() OVER (PARTITION BY p_brand ORDER BY count(*) DESC, p_type) AS r FROM part GROUP BY p_brand, p_type) WHERE r = 1")
def mode_per_group(spark, sf_dir):
    return groups.usual(read(spark, sf_dir, "part"), "p_brand", "p_type")


@query("""
SELECT l_shipdate_year AS year, n, round(mean, 6) AS mean, round(deviation, 6) AS deviation, low, q1, median, q3, high FROM (
  SELECT year(l_shipdate)::INT AS l_shipdate_year, count(*) AS n, avg(l_quantity) AS mean, stddev_pop(l_quantity) AS deviation, min(l_quantity) AS low,
         quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.5) AS median, quantile_cont(l_quantity, 0.75) AS q3, max(l_quantity) AS high FROM lineitem GROUP BY 1)""")
def group_stats(spark, sf_dir):
    out = groups.spread(read(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate")), "year", "l_quantity")
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "deviation")})


@query("""
WITH s AS (SELECT user_id, count(*) AS size FROM events GROUP BY 1), f AS (SELECT floor(quantile_cont(size, 0.25)) AS q1, floor(quantile_cont(size, 0.75)) AS q3 FROM s)
SELECT user_id, size FROM s, f WHERE size > q3 + 0.5 * (q3 - q1)""")
def size_outliers(spark, sf_dir):
    return groups.size_outliers(read(spark, sf_dir, "events"), "user_id", 0.5)


@query("SELECT quantile_cont(length(text), 0.999) AS p999, max(length(text))::BIGINT AS longest, avg(length(text)) AS mean FROM documents")
def p999_length(spark, sf_dir):
    n = F.length("text")
    return read(spark, sf_dir, "documents").agg(F.percentile(n, 0.999).alias("p999"), F.max(n).cast("long").alias("longest"), F.avg(n).alias("mean"))


@query("SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS \"F\", count(*) FILTER (l_linestatus = 'O') AS \"O\" FROM lineitem GROUP BY 1")
def crosstab(spark, sf_dir):
    return groups.crosstab(read(spark, sf_dir, "lineitem"), "l_returnflag", "l_linestatus", ["F", "O"])


@query("SELECT p_type, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, p_type LIMIT 20")
def top_k(spark, sf_dir):
    return groups.top(read(spark, sf_dir, "part"), "p_type", 20)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def largest_k(spark, sf_dir):
    return groups.largest(read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", 10, "o_orderkey")


@query("SELECT o_orderpriority, count(*) AS n, count(*) / (SELECT count(*) FROM orders)::DOUBLE AS share FROM orders GROUP BY 1")
def normalized_counts(spark, sf_dir):
    return groups.shares(read(spark, sf_dir, "orders"), "o_orderpriority")


@query("""
WITH d AS (SELECT CAST(regexp_extract(format('{:.6e}', abs(c_acctbal)), '^([1-9])', 1) AS INT) AS digit FROM customer WHERE regexp_matches(format('{:.6e}', abs(c_acctbal)), '^[1-9]')),
c AS (SELECT digit, count(*) AS n FROM d GROUP BY 1)
SELECT digit, n, n / (SELECT sum(n) FROM c)::DOUBLE AS share, round(log10(1 + 1.0::DOUBLE / digit), 9) AS expected FROM c""")
def benford(spark, sf_dir):
    return groups.leading_digits(read(spark, sf_dir, "customer"), "c_acctbal").withColumn("expected", F.round("expected", 9))


@query("SELECT o_custkey, count(*) AS n, count(DISTINCT o_orderstatus) AS statuses FROM orders GROUP BY 1")
def per_entity_stats(spark, sf_dir):
    return read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n"), F.count_distinct("o_orderstatus").alias("statuses"))


@query("SELECT o_orderkey, o_totalprice FROM (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS r, count(*) OVER () AS n FROM orders) WHERE r = n // 2")
def middle_row(spark, sf_dir):
    return groups.middle(read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey")


@query("SELECT o_custkey FROM (SELECT DISTINCT o_custkey FROM orders) ORDER BY md5(o_custkey::VARCHAR), o_custkey LIMIT 50")
def key_sample(spark, sf_dir):
    return groups.hash_sample(read(spark, sf_dir, "orders"), "o_custkey", 50)


# Rules. Labels are put together from fixed samples by key, so that every rule is met.


def _sample(key: str, values: tuple) -> str:
    """SQL of both engines: a value by key."""
    cases = " ".join(f"WHEN {k} THEN {'NULL' if v is None else repr(v)}" for k, v in enumerate(values))
    return f"CASE {key} % {len(values)} {cases} END"


_SPEAKERS = ("소위원장 홍길동", "홍길동위원", "국방부장관후보자 홍길동", "국무총리후보자 홍길동", "국무총리 김총명", "", "국토교통부장관 홍길동", "기획재정부제1차관 박차분", "증인 이증언", "진술인 최진술", "참고인 정참고", "수석전문위원 한전문", "대법관후보자 오대법", "경찰청장 강경찰", "감사원장 유감사", "헌법재판소사무처장 문헌법", "중앙선거관리위원회사무총장 배선거", "국회사무총장 조국회", "기획조정실장 윤기획", "한국은행총재 임은행", "한국방송공사사장 서방송", "서울대학교 교수 황교수", "육군참모총장 남육군", "학교장 심학교", "주식회사 가나다", "홍길동", None, "환경노동위원장대리 고환경")
_S = _sample("c_custkey", _SPEAKERS)
_ID = _sample("c_custkey", (None, None, None, "", None, "0", None, None, None, "1234", None, "nan", None))
_SQL_STRIP = r"regexp_replace({}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def _classify_sql(name: str, member: str, rules_=V.SPEAKER_RULES) -> str:
    """The cascade as one CASE a column, written for DuckDB."""
    cols = {"role": [], "person": [], "affiliation": []}
    strip = _SQL_STRIP.format
    for role, keyword, where, what in rules_:
        when = f"{member} IS NOT NULL AND {strip(member)} NOT IN ('', 'nan', '0')" if keyword == "MEMBER" else f"regexp_matches({name}, '{keyword}')"
        kind, _, argument = where.partition(":")
        who = {
            "after": strip(f"regexp_replace({name}, '.*({argument or keyword})[\\s\\p{{Z}}]*', '', 'g')"),
            "without": strip(f"regexp_replace({name}, '{argument}', '', 'g')"),
            "last": f"regexp_extract({name}, '[^\\s\\p{{Z}}]+$')",
            "whole": name,
        }[kind]
        place = {"whole": name, "none": "''", "before": strip(f"regexp_replace({name}, '({keyword}).*', '', 'g')")}[what]
        for c, v in (("role", f"'{role}'"), ("person", who), ("affiliation", place)):
            cols[c].append(f"WHEN {when} THEN {v}")
    ends = {"role": ("'unknown'", "'other'"), "person": ("''", name), "affiliation": ("''", name)}
    return ", ".join(f"CASE WHEN {name} = '' THEN {ends[c][0]} {' '.join(v)} ELSE {ends[c][1]} END AS {c}" for c, v in cols.items())


@query(f"WITH t AS (SELECT c_custkey, coalesce({_S}, '') AS s, {_ID} AS m FROM customer), u AS (SELECT c_custkey, {_SQL_STRIP.format('s')} AS n, m FROM t) SELECT c_custkey, {_classify_sql('n', 'm')} FROM u")
def classify_cascade(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.expr(_S).alias("s"), F.expr(_ID).alias("m"))
    return rows.select("c_custkey", rules.classify_speaker("s", "m").alias("r")).select("c_custkey", "r.role", "r.person", "r.affiliation")


@query(f"WITH t AS (SELECT c_custkey, coalesce({_S}, '') AS s, {_ID} AS m FROM customer), u AS (SELECT c_custkey, {_SQL_STRIP.format('s')} AS n, m FROM t) SELECT c_custkey, {_classify_sql('n', 'm', V.SPEAKER_RULES_ALL)} FROM u")
def classify_all_roles(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.expr(_S).alias("s"), F.expr(_ID).alias("m"))
    return rows.select("c_custkey", rules.classify_speaker("s", "m", V.SPEAKER_RULES_ALL).alias("r")).select("c_custkey", "r.role", "r.person", "r.affiliation")


_OTHER = "CASE WHEN c_custkey % 2 = 0 THEN 'other' ELSE 'witness' END"


@query(f"WITH t AS (SELECT c_custkey, {_S} AS s, {_OTHER} AS r FROM customer) SELECT c_custkey, CASE WHEN r <> 'other' THEN r {' '.join(f'''WHEN regexp_matches(s, '{p}') THEN '{label}' ''' for p, label in V.OTHER_RULES + V.OTHER_RULES_MORE)} ELSE r END AS role FROM t")
def reclass_regex(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.expr(_S).alias("s"), F.expr(_OTHER).alias("r"))
    return rows.select("c_custkey", rules.reclassify_other("r", "s").alias("role"))


_ROLE = _sample("c_custkey", ("minister", "legislator", "witness", "chair", None, "other", "minister"))


@query(f"""
WITH t AS (SELECT c_custkey, {_S} AS s, {_ROLE} AS r, {_ID} AS m FROM customer),
u AS (SELECT *, m IS NOT NULL AND {_SQL_STRIP.format('m')} NOT IN ('', 'nan', 'None', 'NaN', '0', '<NA>') AND coalesce(r NOT IN ('legislator', 'chair'), true) AS fix FROM t)
SELECT c_custkey, CASE WHEN fix AND coalesce(contains(s, '위원장'), false) THEN 'chair' WHEN fix THEN 'legislator' WHEN r = 'minister' AND contains(s, '장관직무대리') THEN 'minister_acting' ELSE r END AS role FROM u""")
def role_repair(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.expr(_S).alias("s"), F.expr(_ROLE).alias("r"), F.expr(_ID).alias("m"))
    return rows.select("c_custkey", rules.repair_role("r", "s", "m").alias("role"))


_NAMES = ("직무대행 홍길동", "대리", "반장직무대리 김반장", "홍길동 의원", "홍길동위원님", "위윈장대리 박대리", " 이수진(비) ", "의원", None, "대리위 최대리")
_N = _sample("s_suppkey", _NAMES)


def _title_sql() -> str:
    strip = _SQL_STRIP.format
    fits = [(f"starts_with(n, '{p}') AND {strip(f'substr(n, {len(p) + 1})')} <> ''", strip(f"substr(n, {len(p) + 1})"), t) for p, t in V.TITLE_PREFIXES]
    name = "CASE " + " ".join(f"WHEN {c} THEN {n}" for c, n, _ in fits) + " ELSE n END"
    title = "CASE " + " ".join(f"WHEN {c} THEN '{t}'" for c, _, t in fits) + " END"
    short = strip("regexp_replace(r, ' ?(의원|위원님)$', '')")
    return f"WITH t AS (SELECT s_suppkey, {_N} AS raw FROM supplier), u AS (SELECT s_suppkey, {strip('raw')} AS n FROM t), v AS (SELECT s_suppkey, {name} AS r, {title} AS title FROM u) SELECT s_suppkey, CASE WHEN {short} <> '' THEN {short} ELSE r END AS name, title FROM v"


@query(_title_sql())
def extract_title(spark, sf_dir):
    rows = read(spark, sf_dir, "supplier").select("s_suppkey", F.expr(_N).alias("n"))
    return rows.select("s_suppkey", rules.extract_title("n").alias("r")).select("s_suppkey", "r.name", "r.title")


_PEOPLE = ("안전센터 서헌식", "홍길동", "김OO", "O", "John Smith", "환경부 이수진(비)", "", None, "문화재청문화재정책국장 엄승용", "가나다라마바사")
_PLACES = (None, "소방청", "")


@query(f"""
WITH t AS (SELECT s_suppkey, {_sample('s_suppkey', _PEOPLE)} AS n, {_sample('s_suppkey', _PLACES)} AS a FROM supplier),
u AS (SELECT *, NOT (n IS NULL OR {_SQL_STRIP.format('n')} IN ('', 'nan', 'None') OR regexp_matches(n, '^[가-힣]{{2,4}}(\\([가-힣새한비국평]\\))?$') OR regexp_matches(n, '^[가-힣]?0+$|^O+$') OR regexp_matches(n, '[a-zA-Z]')) AS open,
      CASE WHEN regexp_matches(n, '.[\\s\\p{{Z}}]*[가-힣]{{2,4}}\\([가-힣새한비국평]\\)$') THEN '[가-힣]{{2,4}}\\([가-힣새한비국평]\\)' ELSE '[가-힣]{{2,4}}' END AS kind FROM t),
v AS (SELECT *, CASE WHEN kind LIKE '%새한%' THEN regexp_extract(n, '^(.+?)[\\s\\p{{Z}}]*([가-힣]{{2,4}}\\([가-힣새한비국평]\\))$', 2) ELSE regexp_extract(n, '^(.+?)[\\s\\p{{Z}}]*([가-힣]{{2,4}})$', 2) END AS own,
      CASE WHEN kind LIKE '%새한%' THEN regexp_extract(n, '^(.+?)[\\s\\p{{Z}}]*([가-힣]{{2,4}}\\([가-힣새한비국평]\\))$', 1) ELSE regexp_extract(n, '^(.+?)[\\s\\p{{Z}}]*([가-힣]{{2,4}})$', 1) END AS front FROM u)
SELECT s_suppkey, CASE WHEN open AND own <> '' THEN own ELSE n END AS person_name,
       CASE WHEN open AND own <> '' THEN trim(front || ' ' || coalesce(a, '')) ELSE a END AS affiliation FROM v""")
def name_cleanup(spark, sf_dir):
    rows = read(spark, sf_dir, "supplier").select("s_suppkey", F.expr(_sample("s_suppkey", _PEOPLE)).alias("n"), F.expr(_sample("s_suppkey", _PLACES)).alias("a"), F.lit(None).cast("string").alias("m"))
    return rows.select("s_suppkey", rules.split_name("n", "a", "m").alias("r")).select("s_suppkey", "r.person_name", "r.affiliation")


_MINISTRIES = ("국토교통부장관 김현미", "여성부", "법부무", "한국토지공사", "보건복지부차관 권덕철", "부총리겸재정경제부장관 이헌재", "보 해양수산부", "정책보좌관 통일부", "기획재정부제1차관", "실장 국무총리실장 권태신", "국가보훈처장 박승춘", "서울특별시지방경찰", "리본부", "", None, "특임", "매우긴이름의알수없는기관이름", "과학기술정보통신부장관정책보좌관 진성오", "보건복지부2", "어업자원관 농림수산식품부")


def _ministry_sql() -> str:
    out = "t"
    for pattern, put in V.MINISTRY_STEPS:
        pattern = pattern.replace(r"\S", r"[^\x01\p{Z}]").replace(r"\s", r"[\s\p{Z}]").replace(r"\x01", r"\s")
        out = f"regexp_replace({out}, '{pattern}', '{chr(92)}1', 'g')" if put else f"regexp_replace({out}, '{pattern}', '', 'g')"
    case = lambda x, table: f"CASE {x} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in table) + f" ELSE {x} END"
    strip = _SQL_STRIP.format
    return f"""
WITH a AS (SELECT s_suppkey, {_sample('s_suppkey', _MINISTRIES)} AS raw FROM supplier), b AS (SELECT s_suppkey, {strip('raw')} AS t FROM a),
c AS (SELECT s_suppkey, t, {strip(out)} AS o FROM b), d AS (SELECT s_suppkey, t, {case('o', V.MINISTRY_TYPOS)} AS o FROM c),
e AS (SELECT s_suppkey, t, {strip("regexp_replace(o, '제[12]$', '')")} AS o FROM d), f AS (SELECT s_suppkey, t, {case('o', V.MINISTRY_HISTORY)} AS o FROM e)
SELECT s_suppkey, CASE WHEN regexp_matches(t, '{V.MINISTRY_GARBAGE}') OR regexp_matches(o, '{V.MINISTRY_REJECT}') OR (length(o) >= 10 AND NOT regexp_matches(o, '{V.MINISTRY_ENDINGS}')) OR o = '' THEN NULL ELSE o END AS ministry FROM f"""


@query(_ministry_sql())
def ministry_norm(spark, sf_dir):
    rows = read(spark, sf_dir, "supplier").select("s_suppkey", F.expr(_sample("s_suppkey", _MINISTRIES)).alias("raw"))
    return rows.select("s_suppkey", rules.normalize_ministry("raw").alias("ministry"))


@query(f"SELECT doc_id, {_SQL_STRIP.format(chr(32).join(['regexp_replace(text,', chr(39) + '  +' + chr(39) + ',', chr(39) + ' ' + chr(39) + ',', chr(39) + 'g' + chr(39) + ')']))} AS text FROM documents")
def text_normalize(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", normalize_text("text").alias("text"))


_DATES = "CASE o_orderkey % 5 WHEN 0 THEN {0} || '(화)' WHEN 1 THEN {1} WHEN 2 THEN {2} WHEN 3 THEN {3} ELSE 'bad ' || o_orderkey END"
_SPARK_DATES = _DATES.format("date_format(o_orderdate, 'yyyy년M월d일')", "date_format(o_orderdate, 'yyyy年 M月 d日')", "date_format(o_orderdate, 'yyyy-MM-dd')", "date_format(o_orderdate, 'yyyyMMdd')")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN 'bad ' || o_orderkey ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders")
def date_parse_multi(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", date_text(F.expr(_SPARK_DATES)).alias("day"))


_CODES = _sample("event_id", ("7407", "", " ", "nan", None, "0", "None", "x 1", "<NA>", "806"))


@query(f"SELECT event_id, CASE WHEN v IS NULL OR trim(v) IN ('', 'nan', 'None', 'NaN', '0', '<NA>') THEN NULL ELSE v END AS code, lpad(event_id::VARCHAR, greatest(6, length(event_id::VARCHAR))::INT, '0') AS padded FROM (SELECT event_id, {_CODES} AS v FROM events)")
def sentinel_null(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_id", null_if_blank(F.expr(_CODES)).alias("code"), padded("event_id").alias("padded"))


_MEMBER = _sample("c_custkey", ("7407", "6182", "806", "878", "55"))
_CODE = _sample("c_custkey", ("E6S73230", None, "DTG4846A", "9UW75767", "Z", "0W194007", "FJ03481D", "KA04352K", None, "ZC87486D", "BQS2021C"))


@query(f"""
WITH t AS (SELECT c_custkey, {_MEMBER} AS m, {_CODE} AS c, c_nationkey % 4 AS term FROM customer),
u AS (SELECT m, term, c FROM (SELECT m, term, c, row_number() OVER (PARTITION BY m, term ORDER BY count(*) DESC, c) AS r FROM t WHERE c IS NOT NULL GROUP BY m, term, c) WHERE r = 1)
SELECT c_custkey, t.m AS member_id, CASE {' '.join(f"WHEN t.m = '{m}' AND coalesce(t.c, u.c) = '{c}' THEN '{x}'" for m, c, x in V.HOMONYMS)} ELSE t.m END AS member_uid
FROM t LEFT JOIN u ON t.m = u.m AND t.term = u.term""")
def uid_disambiguate(spark, sf_dir):
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.expr(_MEMBER).alias("member_id"), F.expr(_CODE).alias("naas_cd"), (F.col("c_nationkey") % 4).alias("term"))
    return rules.disambiguate(rows).select("c_custkey", "member_id", "member_uid")


_COMMITTEES = ("국방위원회", "교육과학기술위원회-법안심사소위", "행정안전위원회", "행정안전위원회-예결소위", "문화체육관광방송통신위원회", "특별한위원회", None, "정보위원회 ")
_C = _sample("p_partkey", _COMMITTEES)


@query(f"""
SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN 'defense' WHEN 1 THEN 'education_science' WHEN 2 THEN 'public_admin' WHEN 3 THEN 'public_admin' WHEN 4 THEN 'culture_media' WHEN 7 THEN 'intelligence' ELSE 'other' END AS committee_key,
       trim(p_name || ' ' || p_type) AS label FROM part""")
def committee_harmonize(spark, sf_dir):
    """Keys written by hand, not taken from the table of names."""
    rows = read(spark, sf_dir, "part").withColumn("c", F.expr(_C))
    return rows.select("p_partkey", rules.committee_key("c").alias("committee_key"), joined("p_name", "p_type").alias("label"))


_LABELS = ("김부겸 위원장", "여성가족부 장관", "홍길동 의원입니다", "나 위원", "국회사무처")


@query(f"""
WITH t AS (SELECT s_suppkey, {_sample('s_suppkey', ('', None, 'nan', '이름'))} AS n, {_sample('s_suppkey', _LABELS)} AS s FROM supplier)
SELECT s_suppkey, CASE WHEN n IS NULL OR trim(n) IN ('', 'nan') THEN coalesce(nullif(regexp_extract(s, '^([가-힣]{{2,4}})\\s+(위원장|위원|의원|장관)', 1), ''), n) ELSE n END AS person_name FROM t""")
def name_recovery(spark, sf_dir):
    rows = read(spark, sf_dir, "supplier").select("s_suppkey", F.expr(_sample("s_suppkey", ("", None, "nan", "이름"))).alias("n"), F.expr(_sample("s_suppkey", _LABELS)).alias("s"))
    return rows.select("s_suppkey", rules.recover_name("n", "s").alias("person_name"))


_TITLES = ("대리", "차관", None, "반장", "국장 직무")


@query(f"""
WITH t AS (SELECT s_suppkey, {_sample('s_suppkey', _TITLES)} AS t, {_sample('s_suppkey', _PLACES)} AS a FROM supplier),
u AS (SELECT *, t IS NOT NULL AND t NOT IN ({', '.join(map(repr, V.PERSON_TITLES))}) AS bad FROM t)
SELECT s_suppkey, CASE WHEN NOT bad THEN t END AS title, CASE WHEN bad THEN trim(t || ' ' || coalesce(a, '')) ELSE a END AS affiliation FROM u""")
def title_move(spark, sf_dir):
    rows = read(spark, sf_dir, "supplier").select("s_suppkey", F.expr(_sample("s_suppkey", _TITLES)).alias("t"), F.expr(_sample("s_suppkey", _PLACES)).alias("a"))
    return rows.select("s_suppkey", rules.move_bad_title("t", "a").alias("r")).select("s_suppkey", "r.title", "r.affiliation")


_UID = _sample("c_custkey", ("7407_A", "806_B", "55", None))


@query(f"""
WITH t AS (SELECT c_custkey, {_UID} AS u, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS party FROM customer),
m AS (SELECT u, party FROM (SELECT u, party, row_number() OVER (PARTITION BY u ORDER BY count(*) DESC, party) AS r FROM t WHERE party IS NOT NULL AND u IN ('7407_A', '806_B') GROUP BY u, party) WHERE r = 1)
SELECT c_custkey, CASE WHEN t.party IS NOT NULL THEN coalesce(m.party, t.party) END AS party FROM t LEFT JOIN m ON t.u = m.u""")
def homogenize_modes(spark, sf_dir):
    party = F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment"))
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.expr(_UID).alias("member_uid"), party.alias("party"))
    return rules.homogenize(rows, ["party"]).select("c_custkey", "party")


_BANDS = _sample("c_custkey", ("minister", "witness", "agency_head", None))


@query(f"""
WITH t AS (SELECT c_custkey, {_BANDS} AS r, {_sample('c_custkey', ('법부무', '여성부', '한국은행', '졍종환', ''))} AS a, {_sample('c_custkey', ('백영희', '정종환', None))} AS n, {_sample('c_custkey', ('', '여', '야', None))} AS s FROM customer)
SELECT c_custkey, CASE WHEN r IN ('minister', 'agency_head') THEN CASE a WHEN '법부무' THEN '법무부' WHEN '여성부' THEN '여성가족부' WHEN '졍종환' THEN a END END AS ministry,
       CASE n WHEN '백영희' THEN '백희영' ELSE n END AS person_name, nullif(s, '') AS ruling_status FROM t""")
def panel_cleaning(spark, sf_dir):
    """Ministries of government roles alone, misspelt names, empty party status."""
    rows = read(spark, sf_dir, "customer").select("c_custkey", F.expr(_BANDS).alias("r"), F.expr(_sample("c_custkey", ("법부무", "여성부", "한국은행", "졍종환", ""))).alias("a"), F.expr(_sample("c_custkey", ("백영희", "정종환", None))).alias("n"), F.expr(_sample("c_custkey", ("", "여", "야", None))).alias("s"))
    return rows.select("c_custkey", rules.ministry_of("r", "a").alias("ministry"), rules.fix_name("n").alias("person_name"), F.nullif(F.col("s"), F.lit("")).alias("ruling_status"))


# Joins and versions


@query("SELECT d.doc_id, d.source, coalesce(l.quality, -1) AS quality, l.toxic FROM documents d LEFT JOIN (SELECT doc_id, min(quality) AS quality, min(toxic) AS toxic FROM labels GROUP BY 1) l USING (doc_id)")
def lookup_enrich(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "source")
    out = joins.lookup_fill(docs, read(spark, sf_dir, "labels"), ["doc_id"], ["quality", "toxic"], ["quality", "toxic"])
    return out.withColumn("quality", F.coalesce("quality", F.lit(-1)))


@query("""
WITH k AS (SELECT CASE WHEN c_acctbal < 2000 THEN -c_custkey ELSE c_custkey END AS c_custkey, c_mktsegment, c_nationkey FROM customer),
f AS (SELECT c_nationkey, first(c_mktsegment ORDER BY c_custkey) AS seg FROM k GROUP BY 1)
SELECT o_orderkey, coalesce(k.c_mktsegment, f.seg) AS c_mktsegment, CASE WHEN k.c_custkey IS NOT NULL THEN 'direct' WHEN f.seg IS NOT NULL THEN 'fallback' END AS matched, coalesce(coalesce(k.c_mktsegment, f.seg) = 'BUILDING', false) AS building
FROM orders LEFT JOIN k ON o_custkey = k.c_custkey LEFT JOIN f ON f.c_nationkey = o_custkey % 40""")
def two_stage_match(spark, sf_dir):
    """Orders to all customers by key, but keys of low balances are wrong, and so by a made-up nation key."""
    key = F.when(F.col("c_acctbal") < 2000, -F.col("c_custkey")).otherwise(F.col("c_custkey")).alias("c_custkey")
    details = read(spark, sf_dir, "customer").select(key, "c_mktsegment", "c_nationkey")
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    out = joins.two_stage_match(orders, details, (F.col("o_custkey"), F.col("c_custkey")), ([F.col("o_custkey") % 40], [F.col("c_nationkey")]), ["c_mktsegment"], ["c_custkey"])
    return out.withColumn("building", F.coalesce(F.col("c_mktsegment") == "BUILDING", F.lit(False))).drop("o_custkey")


_PANEL = "SELECT n_nationkey * 10 + k AS panel_order, n_nationkey % 5 AS seg, CASE WHEN (n_nationkey + k) % 2 = 0 THEN '1-URGENT' ELSE '5-LOW' END AS detail, make_date(1993 + (n_nationkey + k) % 5, 1, 1) AS first_day, CASE WHEN k = 2 THEN NULL ELSE make_date(1994 + (n_nationkey + k) % 5, 6, 30) END AS last_day FROM nation, (VALUES (0), (1), (2)) AS v(k)"


@query(f"""
WITH p AS ({_PANEL}), o AS (SELECT o_orderkey, o_custkey, o_custkey % 6 AS seg, o_orderpriority AS detail, o_orderdate::DATE AS day FROM orders),
d AS (SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY seg, o_custkey ORDER BY o_orderkey) = 1),
c AS (SELECT seg, count(*) AS k FROM p GROUP BY 1),
j AS (SELECT d.seg, d.o_custkey, p.panel_order, CASE WHEN day BETWEEN first_day AND coalesce(last_day, DATE '2099-12-31') AND d.detail = p.detail THEN 1 WHEN day BETWEEN first_day AND coalesce(last_day, DATE '2099-12-31') THEN 2 WHEN d.detail = p.detail THEN 3 WHEN k = 1 THEN 4 END AS tier FROM d JOIN p USING (seg) JOIN c USING (seg)),
b AS (SELECT * FROM j WHERE tier IS NOT NULL QUALIFY row_number() OVER (PARTITION BY seg, o_custkey ORDER BY tier, panel_order) = 1)
SELECT o.o_orderkey, b.tier, b.panel_order AS chosen FROM o LEFT JOIN b ON o.seg = b.seg AND o.o_custkey = b.o_custkey""")
def interval_link(spark, sf_dir):
    read(spark, sf_dir, "nation").createOrReplaceTempView("nation")
    panel = spark.sql(_PANEL).withColumn("chosen", F.col("panel_order"))
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", (F.col("o_custkey") % 6).alias("seg"), F.col("o_orderpriority").alias("detail"), F.col("o_orderdate").cast("date").alias("day"))
    out = joins.interval_link(orders, panel, "seg", "detail", "day", ["seg", "o_custkey"], "o_orderkey", "seg", "detail", "first_day", "last_day", "panel_order", ["chosen"])
    return out.select("o_orderkey", "tier", "chosen")


_RANGES = (("first", "1992-01-01", "1993-06-30"), ("second", "1994-01-01", "1995-12-31"), ("third", "1996-01-01", "2099-12-31"))


@query(f"SELECT o_orderkey, CASE {' '.join(f'''WHEN o_orderdate::DATE BETWEEN DATE '{a}' AND DATE '{b}' THEN '{n}' ''' for n, a, b in _RANGES)} END AS period FROM orders")
def range_bucket(spark, sf_dir):
    return read(spark, sf_dir, "orders").select("o_orderkey", joins.range_value(F.col("o_orderdate").cast("date"), _RANGES).alias("period"))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_orderkey, o_custkey, NULL FROM orders WHERE o_orderstatus IS DISTINCT FROM 'F'")
def append_no_overlap(spark, sf_dir):
    """To the finished orders all others: the batch has every order, its price is missing, another column too many."""
    orders = read(spark, sf_dir, "orders")
    base = orders.filter("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_totalprice")
    batch = orders.select(F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_custkey", "o_orderstatus")
    return joins.append_new(base, batch, "o_orderkey")


@query("SELECT coalesce(a.k, b.k) AS o_custkey, CASE WHEN a.k IS NULL THEN 'right' WHEN b.k IS NULL THEN 'left' ELSE 'both' END AS side FROM (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F') a FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'O') b ON a.k = b.k")
def key_diff(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    return joins.key_difference(orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus = 'O'"), "o_custkey")


@query("SELECT o_orderpriority, count(*) FILTER (o_orderdate < DATE '1995-01-01') AS n_before, count(*) FILTER (o_orderdate >= DATE '1995-01-01') AS n_after, count(*) FILTER (o_orderdate >= DATE '1995-01-01') - count(*) FILTER (o_orderdate < DATE '1995-01-01') AS change FROM orders GROUP BY 1")
def dist_diff(spark, sf_dir):
    orders = read(spark, sf_dir, "orders")
    return joins.distribution_change(orders.filter("o_orderdate < DATE '1995-01-01'"), orders.filter("o_orderdate >= DATE '1995-01-01'"), "o_orderpriority")


@query("SELECT l_returnflag AS old_value, l_linestatus AS new_value, count(*) AS n FROM (SELECT l_orderkey, l_linenumber, min(l_returnflag) AS l_returnflag, min(l_linestatus) AS l_linestatus FROM lineitem GROUP BY 1, 2) WHERE l_returnflag IS DISTINCT FROM l_linestatus GROUP BY ALL")
def role_changes(spark, sf_dir):
    items = read(spark, sf_dir, "lineitem")
    return joins.changed_values(items.select("l_orderkey", "l_linenumber", F.col("l_returnflag").alias("v")), items.select("l_orderkey", "l_linenumber", F.col("l_linestatus").alias("v")), ["l_orderkey", "l_linenumber"], "v")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O')")
def orphan_rows(spark, sf_dir):
    parents = read(spark, sf_dir, "orders").filter("o_orderstatus <> 'O'").select(F.col("o_orderkey").alias("l_orderkey"))
    return joins.orphans(read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), parents, "l_orderkey")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def semi_join(spark, sf_dir):
    urgent = read(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("l_orderkey"))
    return joins.having(read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"), urgent, "l_orderkey")


@query("""
SELECT a.conv_id, a.turn, a.role, o.role AS role_old FROM conversations a
LEFT JOIN (SELECT conv_id, turn, min(CASE WHEN turn = 0 THEN 'other' ELSE role END) AS role FROM conversations WHERE role <> 'system' GROUP BY 1, 2) o USING (conv_id, turn)""")
def versions_side_by_side(spark, sf_dir):
    """All turns beside an older version that has other roles at the start and lacks the neutral ones."""
    new = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    old = new.filter("role <> 'system'").withColumn("role", F.when(F.col("turn") == 0, "other").otherwise(F.col("role")))
    return joins.side_by_side(new, old, ["conv_id", "turn"], ["role"], "old")


_KINDS = "CASE WHEN conv_id % 3 = 0 THEN 'a' ELSE 'b' END"


@query(f"""
WITH n AS (SELECT conv_id, {_KINDS} AS t FROM conversations), o AS (SELECT conv_id FROM conversations WHERE role = 'system' UNION ALL SELECT -1),
added AS (SELECT conv_id, t FROM n WHERE conv_id NOT IN (SELECT conv_id FROM o))
SELECT 'old speeches' AS item, CAST(NULL AS VARCHAR) AS value, count(*) AS n FROM o UNION ALL SELECT 'new speeches in all', NULL, count(*) FROM n
UNION ALL SELECT 'old meetings', NULL, count(DISTINCT conv_id) FROM o UNION ALL SELECT 'new meetings in all', NULL, count(DISTINCT conv_id) FROM n
UNION ALL SELECT 'added meetings', NULL, count(DISTINCT conv_id) FROM added UNION ALL SELECT 'lost meetings', NULL, count(DISTINCT conv_id) FROM o WHERE conv_id NOT IN (SELECT conv_id FROM n)
UNION ALL SELECT 'new speeches', t, count(*) FROM added GROUP BY 2 UNION ALL SELECT 'new meetings', t, count(DISTINCT conv_id) FROM added GROUP BY 2""")
def verify_version(spark, sf_dir):
    """All conversations against a version of those that have a system turn, and one that is lost."""
    new = read(spark, sf_dir, "conversations").select(F.col("conv_id").alias("meeting_id"), "role", F.expr(_KINDS).alias("hearing_type"))
    old = new.filter("role = 'system'").select("meeting_id").unionByName(spark.sql("SELECT -1L AS meeting_id"))
    return build.verify(old, new)


@query("""
SELECT conv_id::VARCHAR AS meeting_id, turn, CASE WHEN role = 'system' THEN 'kept' WHEN known THEN 'u' || conv_id END AS download_url, CASE WHEN role <> 'system' THEN known AND conv_id % 3 = 0 END AS is_hearing
FROM (SELECT conv_id, turn, CASE WHEN bool_or(role = 'system') OVER (PARTITION BY conv_id) THEN 'system' ELSE 'new' END AS role, conv_id % 4 <> 1 AS known FROM conversations)""")
def new_meeting_flags(spark, sf_dir):
    """Details for the conversations that an older version, of those with a system turn, lacks."""
    turns = read(spark, sf_dir, "conversations")
    old = turns.filter("role = 'system'").select(F.col("conv_id").cast("string").alias("meeting_id")).distinct()
    s = turns.select(F.col("conv_id").cast("string").alias("meeting_id"), "turn", F.lit("x").alias("date"), F.lit("y").alias("committee"), F.lit("kept").alias("download_url"))
    ids = turns.select("conv_id").distinct().filter("conv_id % 4 <> 1")
    details = ids.selectExpr("CAST(conv_id AS STRING) AS CONF_ID", "'d' AS CONF_DT", "'c' AS CMIT_NM", "IF(conv_id % 3 = 0, 'Y', 'N') AS HR_HRG_YN", "'N' AS PBHRG_YN", "'N' AS HRG_YN", "'N' AS SITG_YN", "'' AS BG_PTM", "'' AS ED_PTM", "concat('u', conv_id) AS DOWN_URL")
    return build.with_new_conferences(s, old, details).select("meeting_id", "turn", "download_url", "is_hearing")


# Sources and sinks


@query("SELECT conv_id, turn, role, text FROM conversations")
def csv_round_trip(spark, sf_dir):
    """Conversations exported as CSV, with their quotes and line ends, and read back by a schema."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    path = datasets.scratch(spark, "csv")
    datasets.export(turns, path, "csv", single=False)
    return datasets.read_csv(spark, path, turns.schema)


@query("SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders")
def parquet_sink(spark, sf_dir):
    """Orders written as zstd Parquet by priority and read back."""
    path = datasets.scratch(spark, "parquet")
    datasets.write_table(read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"), path, partition_by=["o_orderpriority"])
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")


@query(f"WITH {_PAIRS} SELECT conv_id, count(*) AS n FROM dy GROUP BY 1")
def stream_append(spark, sf_dir):
    """Conversations that come twice in a stream and are appended, with their dyads, once."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    source, table, made, state = (datasets.scratch(spark, x) for x in ("stream", "table", "dyads", "state"))
    derive = {made: lambda df: pairs.dyads(df, "conv_id", "turn", "role", ASKS, ANSWERS)}
    for _ in range(2):
        turns.write.mode("append").parquet(source)
        append.run(spark.readStream.schema(turns.schema).parquet(source), table, "conv_id", state, derive).awaitTermination()
    return spark.read.parquet(made).groupBy("conv_id").agg(F.count("*").alias("n"))


# Text and audits


@query("""
SELECT source, count(*) AS n, count(*) FILTER (regexp_matches(text, 'â€™|â€œ|Ã¤|Ã¶|Ã¼|\\\\u[0-9a-f]{4}|�')) AS mojibake, count(*) FILTER (regexp_matches(text, '<[a-zA-Z/][^>]*>')) AS markup,
       count(*) FILTER (contains(text, '  ') OR starts_with(text, ' ')) AS loose_spaces, count(*) FILTER (length(text) < 10) AS short,
       count(*) FILTER (length(text) > 20 AND len(regexp_extract_all(text, '[a-z]')) < 0.1 * length(text)) AS "foreign" FROM documents GROUP BY 1""")
def text_audit(spark, sf_dir):
    return audit.text_quality(read(spark, sf_dir, "documents"), "text", "source", "[a-z]")


@query("SELECT page_id, len(regexp_extract_all(html, '<[a-zA-Z/][^>]*>')) AS n_tags, length(html) AS n_chars FROM pages WHERE regexp_matches(html, '<[a-zA-Z/][^>]*>')")
def html_remnants(spark, sf_dir):
    pages = read(spark, sf_dir, "pages").filter(F.col("html").rlike(audit.HTML_TAG))
    return pages.select("page_id", F.regexp_count("html", F.lit(audit.HTML_TAG)).cast("long").alias("n_tags"), F.length("html").cast("long").alias("n_chars"))


@query("SELECT lang, CAST(sum(n - 1) AS BIGINT) AS extra FROM (SELECT lang, text, count(*) AS n FROM documents WHERE length(text) > 30 GROUP BY ALL HAVING count(*) > 1) GROUP BY 1")
def intra_dups(spark, sf_dir):
    return audit.repeated_texts(read(spark, sf_dir, "documents"), "lang", "text")


@query("""
WITH r AS (SELECT * FROM (VALUES ('F', DATE '1992-03-01', DATE '1994-12-31'), ('O', DATE '1995-07-01', DATE '1998-06-30')) AS v(o_orderstatus, a, b))
SELECT o_orderstatus, count(*) AS n, min(o_orderdate::DATE) AS first_day, max(o_orderdate::DATE) AS last_day FROM orders JOIN r USING (o_orderstatus)
WHERE NOT o_orderdate::DATE BETWEEN a - INTERVAL 30 DAY AND b + INTERVAL 30 DAY GROUP BY 1""")
def term_range(spark, sf_dir):
    ranges = spark.sql("SELECT * FROM VALUES ('F', DATE '1992-03-01', DATE '1994-12-31'), ('O', DATE '1995-07-01', DATE '1998-06-30') AS v(o_orderstatus, first_day, last_day)")
    return audit.out_of_range(read(spark, sf_dir, "orders"), "o_orderstatus", "o_orderdate", ranges)


@query(f"""
WITH {_PAIRS}, s AS (SELECT CASE role WHEN 'user' THEN 'legislator' WHEN 'assistant' THEN 'witness' ELSE 'committee_staff' END AS role, conv_id FROM conversations)
SELECT 'speech_term' AS "check", (16 + conv_id % 7)::VARCHAR AS key, count(*) AS n FROM s GROUP BY 2 UNION ALL SELECT 'speech_hearing_type', '상임위원회', count(*) FROM s UNION ALL SELECT 'speech_role', role, count(*) FROM s GROUP BY 2
UNION ALL SELECT 'committee_key', 'political_affairs', count(*) FROM s UNION ALL SELECT 'dyad_term', (16 + conv_id % 7)::VARCHAR, count(*) FROM dy GROUP BY 2 UNION ALL SELECT 'dyad_witness_role', 'witness', count(*) FROM dy
UNION ALL SELECT 'dyad_direction', direction, count(*) FROM dy GROUP BY 2""")
def report_distributions(spark, sf_dir):
    return validation.distributions(*_transcript(spark, sf_dir))


def _transcript(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Conversations in the schema of speeches, and the dyads formed of them."""
    role = first_match([(F.col("role") == "user", "legislator"), (F.col("role") == "assistant", "witness")], "committee_staff")
    s = read(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("meeting_id"), (16 + F.col("conv_id") % 7).alias("term"), F.lit("정무위원회").alias("committee"), F.lit("political_affairs").alias("committee_key"),
        F.lit("상임위원회").alias("hearing_type"), F.concat((2000 + 4 * (F.col("conv_id") % 7)).cast("string"), F.lit("-06-01")).alias("date"), F.lit("agenda").alias("agenda"),
        F.concat(F.lit("화자 "), F.col("role")).alias("speaker"), F.when(F.col("role") == "user", F.col("conv_id").cast("string")).alias("member_id"), F.col("turn").cast("string").alias("speech_order"),
        role.alias("role"), F.col("role").alias("person_name"), F.lit(None).cast("string").alias("affiliation_raw"), F.col("text").alias("speech_text"),
    )
    sides = {"leg_name": "person_name", "leg_speaker_raw": "speaker", "leg_speech": "speech_text"}
    told = {"witness_name": "person_name", "witness_speaker_raw": "speaker", "witness_role": "role", "witness_affiliation": "affiliation_raw", "witness_speech": "speech_text"}
    return s, pairs.dyads(s, "meeting_id", "speech_order", "role", context=["term", "committee", "committee_key", "hearing_type", "date", "agenda"], leg=sides, witness=told)


_CHECKS = f"""
WITH {_PAIRS}, c AS (SELECT count(*) AS n, avg((role = 'user')::INT) AS leg, avg((length(text) < 10)::INT) AS short, avg((trim(text) = '')::INT) AS empty FROM conversations),
d AS (SELECT count(*) AS n, count(*) FILTER (direction = 'question') AS q, count(*) FILTER (direction = 'answer') AS a, avg((trim(leg_speech) = '')::INT) AS el, avg((trim(witness_speech) = '')::INT) AS ew FROM dy),
g AS (SELECT avg((hi - lo + 1 <> k OR k <> n)::INT) AS gaps FROM (SELECT max(turn) AS hi, min(turn) AS lo, count(DISTINCT turn) AS k, count(*) AS n FROM conversations GROUP BY conv_id)),
u AS (SELECT coalesce(sum(k) FILTER (k > 1), 0) AS dups FROM (SELECT count(*) AS k FROM conversations GROUP BY conv_id, turn)),
t AS (SELECT max(r) - min(r) AS spread FROM (SELECT (SELECT count(*) FROM dy WHERE conv_id % 7 = m) / count(*)::DOUBLE AS r FROM (SELECT conv_id % 7 AS m FROM conversations) GROUP BY m HAVING (SELECT count(*) FROM dy WHERE conv_id % 7 = m) > 0))
SELECT 'speech_row_count' AS "check", CASE WHEN n = 0 THEN 'FAIL' ELSE 'PASS' END AS status, n::DOUBLE AS value FROM c
UNION ALL SELECT 'speech_role_balance', CASE WHEN leg BETWEEN 0.3 AND 0.7 THEN 'PASS' ELSE 'WARN' END, round(leg, 6) FROM c
UNION ALL SELECT 'speech_short_text', CASE WHEN short > 0.1 THEN 'WARN' ELSE 'PASS' END, round(short, 6) FROM c
UNION ALL SELECT 'speech_empty_text', CASE WHEN empty > 0.01 THEN 'WARN' ELSE 'PASS' END, round(empty, 6) FROM c
UNION ALL SELECT 'speech_order_continuity', CASE WHEN gaps > 0.2 THEN 'WARN' ELSE 'PASS' END, round(gaps, 6) FROM g
UNION ALL SELECT 'speech_duplicates', CASE WHEN dups = 0 THEN 'PASS' WHEN dups < 0.01 * n THEN 'WARN' ELSE 'FAIL' END, dups::DOUBLE FROM u, c
UNION ALL SELECT 'dyad_row_count', CASE WHEN n = 0 THEN 'FAIL' ELSE 'PASS' END, n::DOUBLE FROM d
UNION ALL SELECT 'dyad_direction_balance', CASE WHEN least(q, a) > 0.8 * greatest(q, a) THEN 'PASS' ELSE 'WARN' END, round(least(q, a) / greatest(q, a)::DOUBLE, 6) FROM d
UNION ALL SELECT 'dyad_empty_leg_speech', CASE WHEN el > 0.01 THEN 'WARN' ELSE 'PASS' END, round(el, 6) FROM d
UNION ALL SELECT 'dyad_empty_witness_speech', CASE WHEN ew > 0.01 THEN 'WARN' ELSE 'PASS' END, round(ew, 6) FROM d
UNION ALL SELECT 'dyad_self_pairing', 'PASS', 0 UNION ALL SELECT 'dyad_witness_not_legislator', 'PASS', 0 UNION ALL SELECT 'cross_dyad_formation', 'PASS', 0 UNION ALL SELECT 'cross_dyad_meetings_in_speeches', 'PASS', 0
UNION ALL SELECT 'cross_dyad_lt_speech', CASE WHEN d.n >= c.n THEN 'FAIL' ELSE 'PASS' END, round(d.n / c.n::DOUBLE, 6) FROM c, d
UNION ALL SELECT 'cross_term_ratio_variance', CASE WHEN spread > 0.3 THEN 'WARN' ELSE 'PASS' END, round(spread, 6) FROM t
UNION ALL SELECT 'speech_terms', 'PASS', 7 UNION ALL SELECT 'speech_hearing_types', 'WARN', 1 UNION ALL SELECT 'speech_roles_unknown', 'PASS', 0 UNION ALL SELECT 'speech_committees_unknown', 'PASS', 0
UNION ALL SELECT 'speech_committees_other', 'PASS', 0 UNION ALL SELECT 'speech_memberid_role', 'PASS', 0 UNION ALL SELECT 'speech_leg_without_memberid', 'PASS', 0 UNION ALL SELECT 'speech_date_parsing', 'PASS', 1
UNION ALL SELECT 'speech_date_term_range', 'PASS', 0 UNION ALL SELECT 'speech_empty_person_name', 'PASS', 0 UNION ALL SELECT 'classify_unclassified', 'PASS', 0 UNION ALL SELECT 'classify_chair_keyword', 'PASS', 0
UNION ALL SELECT 'classify_minister_keyword', 'PASS', 0 UNION ALL SELECT 'classify_gov_chair_leak', 'PASS', 0 UNION ALL SELECT 'speech_order_numbers', 'PASS', 0 UNION ALL SELECT 'committee_meeting_consistency', 'PASS', 0
UNION ALL SELECT 'dyad_terms', CASE WHEN count(DISTINCT conv_id % 7) < 7 THEN 'FAIL' ELSE 'PASS' END, count(DISTINCT conv_id % 7) FROM dy UNION ALL SELECT 'dyad_committees_unknown', 'PASS', 0 UNION ALL SELECT 'classify_staff_count', 'PASS', count(*) FROM conversations WHERE role NOT IN ('user', 'assistant')
UNION ALL SELECT 'committee_raw_count', 'PASS', 1 UNION ALL SELECT 'committee_unmapped', 'PASS', 0
UNION ALL SELECT 'dyad_directions', 'PASS', 0 UNION ALL SELECT 'dyad_witness_roles', 'PASS', 0 UNION ALL SELECT 'dyad_empty_leg_name', 'PASS', 0 UNION ALL SELECT 'dyad_empty_witness_name', 'PASS', 0
UNION ALL SELECT 'speech_schema_required', 'PASS', 0 UNION ALL SELECT 'speech_schema_extra', 'PASS', 0 UNION ALL SELECT 'dyad_schema_required', 'PASS', 0 UNION ALL SELECT 'dyad_schema_extra', 'WARN', 1"""


@query(_CHECKS)
def validation_report(spark, sf_dir):
    return validation.validate(*_transcript(spark, sf_dir)).select("check", "status", "value")


# The same checks where there is something to find: faults are planted in the transcript by key,
# in SQL that both engines read; the dyads are formed of it and damaged.

_P = "CASE conv_id % 9 WHEN 0 THEN '김하나' WHEN 1 THEN '이두리' WHEN 2 THEN '박세리' WHEN 3 THEN '최네모' WHEN 4 THEN '정다섯' WHEN 5 THEN '강여섯' WHEN 6 THEN '조일곱' WHEN 7 THEN '윤여덟' ELSE '장아홉' END"
_W = "CASE conv_id % 4 WHEN 0 THEN '김하나' WHEN 1 THEN '임열' WHEN 2 THEN '한백' ELSE '오천' END"
_DAY = "concat({} + 4 * (conv_id % 7), '-06-', lpad(concat('', 1 + conv_id % 28), 2, '0'))"
_FAULTY = f"""
SELECT conv_id, concat('m', conv_id) AS meeting_id, CAST(16 + conv_id % 7 AS INT) AS term,
       CASE conv_id % 5 WHEN 0 THEN '정무위원회' WHEN 1 THEN '정무위원회-법안심사소위' WHEN 2 THEN '교육문화체육관광위원회' WHEN 3 THEN '교육과학기술위원회' ELSE '기타위원회' END AS committee,
       CASE WHEN conv_id % 11 = 2 AND turn = 1 THEN 'intelligence' WHEN conv_id % 31 = 3 THEN 'no such key' WHEN conv_id % 5 < 2 THEN 'political_affairs' WHEN conv_id % 5 = 2 THEN 'education_culture' WHEN conv_id % 5 = 3 THEN 'education_science' ELSE 'other' END AS committee_key,
       CASE WHEN conv_id % 13 = 4 THEN '임시회의' WHEN conv_id % 3 = 0 THEN '국정감사' WHEN conv_id % 3 = 1 THEN '상임위원회' ELSE '국회본회의' END AS hearing_type,
       CASE WHEN conv_id % 17 = 5 THEN 'bad' WHEN conv_id % 19 = 6 THEN '1999-01-01' WHEN conv_id % 37 = 9 THEN '' WHEN conv_id % 23 = 7 AND turn = 2 THEN {_DAY.format(2001)} ELSE {_DAY.format(2000)} END AS date,
       'agenda' AS agenda,
       CASE role WHEN 'user' THEN CASE WHEN conv_id % 4 = 1 THEN concat('위원장 ', {_P}) ELSE concat({_P}, '위원') END
                 WHEN 'assistant' THEN CASE conv_id % 6 WHEN 0 THEN concat('법무부장관 ', {_W}) WHEN 1 THEN concat('증인 ', {_W}) WHEN 2 THEN concat('교수 ', {_W}) WHEN 3 THEN '장관' WHEN 4 THEN concat('장관석 청장', {_W}) ELSE concat('회장 ', {_W}) END
                 ELSE '수석전문위원 한전문' END AS speaker,
       CASE WHEN role = 'user' THEN CASE WHEN conv_id % 29 = 8 THEN 'X9' WHEN conv_id % 41 = 10 THEN 'nan' ELSE concat('', conv_id % 9) END WHEN role = 'assistant' AND conv_id % 27 = 11 THEN '77' END AS member_id,
       CASE WHEN conv_id % 33 = 12 AND turn >= 2 THEN concat('', turn + 1) WHEN conv_id % 35 = 13 AND turn = 1 THEN 'x' ELSE concat('', turn) END AS speech_order,
       CASE role WHEN 'user' THEN CASE WHEN conv_id % 4 = 1 THEN 'chair' ELSE 'legislator' END
                 WHEN 'assistant' THEN CASE conv_id % 6 WHEN 0 THEN 'minister' WHEN 1 THEN 'witness' WHEN 2 THEN 'other' WHEN 3 THEN 'minister' WHEN 4 THEN 'minister' ELSE 'org_head' END
                 ELSE CASE WHEN conv_id % 15 = 14 THEN 'no such role' ELSE 'committee_staff' END END AS role,
       CASE role WHEN 'user' THEN CASE WHEN conv_id % 43 = 15 THEN '다른이' ELSE {_P} END WHEN 'assistant' THEN {_W} ELSE '' END AS person_name,
       CASE WHEN role = 'assistant' THEN '법무부' END AS affiliation_raw,
       CASE WHEN conv_id % 21 = 16 AND turn = 0 THEN '' WHEN conv_id % 25 = 17 THEN concat('<b>  ', text) WHEN conv_id % 39 = 18 THEN 'â€™ 가나다라마바사아자차카타파하' WHEN conv_id % 45 = 19 THEN 'the same text, said again and again' WHEN conv_id % 22 = 20 THEN '예' ELSE text END AS speech_text,
       CASE WHEN role = 'user' THEN CASE WHEN conv_id % 47 = 21 THEN '?' WHEN conv_id % 9 < 4 THEN '남' ELSE '여' END END AS gender,
       CASE WHEN role = 'user' THEN concat('당', conv_id % 3) WHEN conv_id % 49 = 22 THEN '당9' END AS party,
       CASE WHEN role = 'user' THEN CASE WHEN conv_id % 2 = 0 THEN 'ruling' ELSE 'opposition' END END AS ruling_status,
       CASE WHEN role = 'user' THEN CAST(CASE WHEN conv_id % 51 = 23 THEN 20 ELSE 1 + conv_id % 5 END AS DOUBLE) END AS seniority,
       concat('', conv_id % 10) AS session, CASE WHEN role = 'user' THEN concat('N', conv_id % 9) END AS naas_cd
FROM conversations"""
_LOST = "CASE WHEN CAST(substr(meeting_id, 2) AS BIGINT) % 53 = 24 THEN 'lost' ELSE meeting_id END"
_CHANGED = "CASE WHEN CAST(substr(meeting_id, 2) AS BIGINT) % 27 = 25 THEN concat(leg_speech, '!') ELSE leg_speech END"
_STAYS = "NOT (CAST(substr(meeting_id, 2) AS BIGINT) % 26 = 1 AND direction = 'answer')"


def _faulty(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    s = spark.sql(_FAULTY.replace("FROM conversations", "FROM {conversations}"), conversations=read(spark, sf_dir, "conversations")).drop("conv_id")
    leg = {"leg_name": "person_name", "leg_speaker_raw": "speaker", "leg_speech": "speech_text"}
    witness = {"witness_name": "person_name", "witness_speaker_raw": "speaker", "witness_role": "role", "witness_affiliation": "affiliation_raw", "witness_speech": "speech_text"}
    d = pairs.dyads(s, "meeting_id", "speech_order", "role", context=["term", "committee", "committee_key", "hearing_type", "date", "agenda"], leg=leg, witness=witness)
    return s, d.filter(_STAYS).withColumns({"leg_speech": F.expr(_CHANGED), "meeting_id": F.expr(_LOST)})


def _list(values) -> str:
    return "(" + ", ".join(map(repr, values)) + ")"


_ASK, _TELL = _list(V.LEGISLATOR_ROLES), _list(V.NONLEGISLATOR_ROLES)
_WITNESS_SIDE = ("person_name", "speaker", "role", "speech_text")
_FAULTY_SQL = f"""
s AS ({_FAULTY}),
o AS (SELECT *, TRY_CAST(speech_order AS DOUBLE) AS spot FROM s WHERE TRY_CAST(speech_order AS DOUBLE) IS NOT NULL),
nx AS (SELECT *, {", ".join(f"lead({c}) OVER w AS {c}2" for c in (*_WITNESS_SIDE, "speech_order", "term", "committee_key", "hearing_type"))} FROM o WINDOW w AS (PARTITION BY meeting_id ORDER BY spot, speech_order)),
way AS (SELECT *, CASE WHEN role IN {_ASK} AND role2 IN {_TELL} THEN 'question' WHEN role IN {_TELL} AND role2 IN {_ASK} THEN 'answer' END AS direction FROM nx),
made AS (SELECT meeting_id, direction, CASE direction WHEN 'question' THEN speech_order ELSE speech_order2 END AS speech_order,
                CASE direction WHEN 'question' THEN term ELSE term2 END AS term, CASE direction WHEN 'question' THEN committee_key ELSE committee_key2 END AS committee_key, CASE direction WHEN 'question' THEN hearing_type ELSE hearing_type2 END AS hearing_type,
                CASE direction WHEN 'question' THEN person_name ELSE person_name2 END AS leg_name, CASE direction WHEN 'question' THEN speaker ELSE speaker2 END AS leg_speaker_raw, CASE direction WHEN 'question' THEN speech_text ELSE speech_text2 END AS leg_speech,
                CASE direction WHEN 'question' THEN person_name2 ELSE person_name END AS witness_name, CASE direction WHEN 'question' THEN speaker2 ELSE speaker END AS witness_speaker_raw, CASE direction WHEN 'question' THEN role2 ELSE role END AS witness_role,
                CASE direction WHEN 'question' THEN speech_text2 ELSE speech_text END AS witness_speech FROM way WHERE direction IS NOT NULL),
d AS (SELECT * REPLACE ({_CHANGED} AS leg_speech, {_LOST} AS meeting_id) FROM made WHERE {_STAYS}),
mem AS (SELECT * REPLACE (trim(member_id) AS member_id) FROM s WHERE member_id IS NOT NULL AND trim(member_id) NOT IN ('', 'nan', 'None', 'NaN', '0', '<NA>')),
dt AS (SELECT *, TRY_CAST(date AS DATE) AS day FROM s)"""


def _counts(phase: int, check: str, key: str, of: str = "s", value: str = "count(*)") -> str:
    return f"SELECT {phase} AS phase, '{check}' AS \"check\", {key} AS key, {value} AS value FROM {of} GROUP BY ALL"


def _value(phase: int, check: str, value: str, of: str = "s") -> str:
    return f"SELECT {phase}, '{check}', NULL, {value} FROM {of}"


def _both(*columns: str) -> str:
    return " || '/' || ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns)


def _most(phase: int, check: str, key: str, k: int, of: str) -> str:
    return f"SELECT {phase}, '{check}', key, n FROM (SELECT CAST({key} AS VARCHAR) AS key, count(*) AS n FROM {of} GROUP BY 1 ORDER BY n DESC, key NULLS FIRST LIMIT {k})"


def _severals(column: str, group: str = "meeting_id", of: str = "s") -> str:
    return f"(SELECT {group} FROM {of} GROUP BY 1 HAVING count(DISTINCT {column}) > 1)"


def _audit_sql() -> str:
    terms = ", ".join(f"({t}, DATE '{a}', DATE '{b}')" for t, a, b in V.TERM_DAYS)
    suggested = " ".join(f"WHEN regexp_matches(speaker, '{p}') THEN '{r}'" for p, r in V.SUGGESTED_ROLES)
    mojibake = "â€™|â€œ|Ã¤|Ã¶|Ã¼|\\\\u[0-9a-f]{4}|�"
    sizes = "(SELECT meeting_id, count(*) AS size FROM s GROUP BY 1)"
    order = "(SELECT meeting_id, max(v) AS hi, min(v) AS lo, count(DISTINCT v) AS k, count(*) AS n, count(*) FILTER (v IS NULL) AS bad FROM (SELECT meeting_id, TRY_CAST(speech_order AS DOUBLE) AS v FROM s) GROUP BY 1)"
    recount = "(SELECT coalesce(a.n, 0) AS a, coalesce(e.n, 0) AS e FROM (SELECT meeting_id, count(*) AS n FROM d GROUP BY 1) a FULL JOIN (SELECT meeting_id, count(*) AS n FROM made GROUP BY 1) e USING (meeting_id))"
    people = f"(SELECT member_id, count(*) AS n FROM mem WHERE role IN {_ASK} GROUP BY 1)"
    wrong = " OR ".join(f"(committee_key = '{k}' AND term NOT IN {_list(t)})" for k, t in audit.COMMITTEE_TERMS.items())
    placed = lambda t: f"(SELECT * FROM (SELECT meeting_id, direction, leg_speech, witness_speech, row_number() OVER (PARTITION BY meeting_id ORDER BY TRY_CAST(speech_order AS DOUBLE), direction) AS place FROM {t}) WHERE place <= 5)"
    aligned = f"(SELECT e.direction IS NOT DISTINCT FROM a.direction AND e.leg_speech IS NOT DISTINCT FROM a.leg_speech AND e.witness_speech IS NOT DISTINCT FROM a.witness_speech AS same FROM {placed('made')} e FULL JOIN {placed('d')} a USING (meeting_id, place))"
    months = "(SELECT month, lag(month) OVER (ORDER BY month) AS b FROM (SELECT DISTINCT date_trunc('month', day)::DATE AS month FROM dt WHERE day IS NOT NULL))"
    lengths = "(SELECT role, length(speech_text) AS l FROM s)"
    quality = {"mojibake": f"regexp_matches(speech_text, '{mojibake}')", "markup": "regexp_matches(speech_text, '<[a-zA-Z/][^>]*>')", "short": "length(speech_text) < 10", "foreign": "length(speech_text) > 20 AND len(regexp_extract_all(speech_text, '[가-힣]')) < 0.1 * length(speech_text)"}
    parts = [
        _counts(1, "date_last_day", "CAST(term AS VARCHAR)", "dt WHERE day IS NOT NULL", "datediff('day', DATE '1970-01-01', max(day))::DOUBLE"),
        _counts(1, "date_first_day", "CAST(term AS VARCHAR)", "dt WHERE day IS NOT NULL", "datediff('day', DATE '1970-01-01', min(day))"),
        _value(1, "date_parse_rate", "avg((day IS NOT NULL)::INT)", "dt"),
        _counts(1, "date_out_of_term", "CAST(dt.term AS VARCHAR)", f"dt JOIN (VALUES {terms}) AS r(term, a, b) ON dt.term = r.term WHERE day NOT BETWEEN a - INTERVAL 30 DAY AND b + INTERVAL 30 DAY"),
        _value(1, "date_blank", "count(*) FILTER (trim(date) = '')"),
        f"SELECT 1, 'date_month_gap', CAST((b + INTERVAL 1 MONTH)::DATE AS VARCHAR), datediff('month', b, month) - 1 FROM {months} WHERE datediff('month', b, month) - 1 >= 3",
        _value(1, "meeting_several_dates", "count(*)", _severals("date")),
        _value(2, "id_not_numeric", "count(DISTINCT member_id)", "mem WHERE NOT regexp_matches(member_id, '^[0-9]+$')"),
        "SELECT 2, 'id_several_names', member_id, count(DISTINCT person_name) FROM mem GROUP BY 3 HAVING count(DISTINCT person_name) > 1",
        "SELECT 2, 'name_several_ids', person_name, count(DISTINCT member_id) FROM mem GROUP BY 3 HAVING count(DISTINCT member_id) > 1",
        f"SELECT 2, 'id_terms', CAST(k AS VARCHAR), count(*) FROM (SELECT count(DISTINCT term) AS k FROM mem WHERE role IN {_ASK} GROUP BY member_id) GROUP BY 3",
        _value(2, "id_other_role", "count(*)", f"mem WHERE role NOT IN {_ASK}"),
        _value(2, "name_in_speaker", "avg(contains(speaker, person_name)::INT)", "s WHERE person_name <> ''"),
        _value(2, "name_blank", "count(*)", "s WHERE person_name = ''"),
        _value(3, "other_speeches", "count(*)", "s WHERE role = 'other'"),
        _most(3, "other_speaker", "speaker", 50, "s WHERE role = 'other'"),
        f"SELECT 3, 'other_suggested', speaker || ' > ' || r, n FROM (SELECT speaker, CASE {suggested} END AS r, n FROM (SELECT speaker, count(*) AS n FROM s WHERE role = 'other' GROUP BY 1 ORDER BY n DESC, speaker LIMIT 100)) WHERE r IS NOT NULL",
        "SELECT 3, 'speaker_several_roles', speaker, count(DISTINCT role) FROM s GROUP BY 3 HAVING count(*) >= 10 AND count(DISTINCT role) > 1",
        _counts(3, "chair_share", "CAST(term AS VARCHAR)", f"s WHERE role IN {_ASK}", "avg((role = 'chair')::INT)"),
        _counts(3, "type_role", _both("hearing_type", "role")),
        _counts(3, "minister_label", "CASE WHEN regexp_matches(speaker, '장관\\s+\\S') THEN 'named' WHEN regexp_matches(speaker, '장관$') THEN 'unnamed' WHEN contains(speaker, '장관') THEN 'other label' ELSE 'no keyword' END", "s WHERE role = 'minister'"),
        _value(3, "minister_odd_label", "count(*)", "s WHERE role = 'minister' AND NOT regexp_matches(speaker, '장관\\s+\\S|장관$')"),
        _value(4, "meeting_gaps", "count(*)", f"{order} WHERE hi - lo + 1 > k OR n - bad > k"),
        _value(4, "meeting_odd_order", "count(*)", f"{order} WHERE bad > 0"),
        _value(4, "meeting_singletons", "count(*)", f"{sizes} WHERE size = 1"),
        *(_value(4, f"meeting_size_{c}", v, sizes) for c, v in (("mean", "avg(size)"), ("q25", "quantile_cont(size, 0.25)"), ("q50", "quantile_cont(size, 0.5)"), ("q75", "quantile_cont(size, 0.75)"), ("largest", "max(size)"))),
        f"SELECT 4, 'meeting_large', meeting_id, size FROM {sizes} WHERE size > (SELECT floor(quantile_cont(size, 0.75)) + 3 * (floor(quantile_cont(size, 0.75)) - floor(quantile_cont(size, 0.25))) FROM {sizes})",
        *(_value(4, f"meeting_several_{c}", "count(*)", _severals(c)) for c in ("committee", "term", "hearing_type", "date")),
        f"SELECT 4, 'meeting_sides', CASE WHEN a AND b THEN 'both' WHEN a THEN 'leg_only' WHEN b THEN 'nonleg_only' ELSE 'neither' END, count(*) FROM (SELECT bool_or(role IN {_ASK}) AS a, bool_or(role IN {_TELL}) AS b FROM s GROUP BY meeting_id) GROUP BY 3",
        _counts(4, "meetings", "CAST(term AS VARCHAR)", value="count(DISTINCT meeting_id)"),
        *(_counts(5, f"text_{c}", "role", value=f"count(*) FILTER ({v})") for c, v in quality.items()),
        *(_counts(5, f"text_length_{c}", "role", lengths, v) for c, v in (("mean", "avg(l)"), ("median", "quantile_cont(l, 0.5)"), ("high", "max(l)"))),
        _value(5, "text_p999_length", "quantile_cont(l, 0.999)", lengths),
        f"SELECT 5, 'text_longest', key, l FROM (SELECT {_both('meeting_id', 'speech_order')} AS key, length(speech_text) AS l FROM s ORDER BY l DESC, key LIMIT 10)",
        _most(5, "text_short_top", "speech_text", 30, "s WHERE length(speech_text) < 10"),
        _value(5, "text_repeated_in_meeting", "count(DISTINCT meeting_id)", "(SELECT meeting_id FROM s WHERE length(speech_text) > 30 GROUP BY meeting_id, speech_text HAVING count(*) > 1)"),
        _value(5, "text_loose_share", "avg((contains(speech_text, '  ') OR starts_with(speech_text, ' '))::INT)"),
        _counts(6, "committee_raw_names", "committee_key", value="count(DISTINCT committee)"),
        _counts(6, "committee_mapping", _both("committee", "committee_key")),
        _counts(6, "committee_term", _both("committee_key", "term")),
        _counts(6, "committee_unexpected_term", _both("committee_key", "term"), f"s WHERE {wrong}"),
        _counts(6, "committee_sub", "committee_key", f"s WHERE regexp_matches(committee, '{V.SUBCOMMITTEE}')"),
        _counts(6, "committee_type_meetings", _both("committee_key", "hearing_type"), value="count(DISTINCT meeting_id)"),
        _value(7, "dyad_count_off", "count(*) FILTER (a <> e)", recount),
        _value(7, "dyad_count_off_share", "avg((a <> e)::INT)", recount),
        _value(7, "dyad_self_same_speaker", "count(*) FILTER (leg_name = witness_name AND leg_speaker_raw = witness_speaker_raw)", "d"),
        _value(7, "dyad_self_homonyms", "count(*) FILTER (leg_name = witness_name AND leg_speaker_raw <> witness_speaker_raw)", "d"),
        _value(7, "dyad_one_sided", "count(*)", "(SELECT avg((direction = 'question')::INT) AS q FROM d GROUP BY meeting_id HAVING count(*) >= 10) WHERE q < 0.2 OR q > 0.8"),
        _value(7, "dyad_orphan_meetings", "count(DISTINCT meeting_id)", "d WHERE meeting_id NOT IN (SELECT meeting_id FROM s)"),
        f"SELECT 7, 'dyad_role_ratio', coalesce(x.role, y.role), CASE WHEN coalesce(x.n, 0) > 0 THEN coalesce(y.n, 0) / x.n END FROM (SELECT role, count(*)::DOUBLE AS n FROM s WHERE role IN {_TELL} GROUP BY 1) x FULL JOIN (SELECT witness_role AS role, count(*)::DOUBLE AS n FROM d GROUP BY 1) y USING (role)",
        "SELECT 8, 'columns_present', NULL, 6",
        _counts(8, "gender_values", "coalesce(gender, '')"),
        _value(8, "gender_several", "count(*)", _severals("gender", "member_id", "mem")),
        _most(8, "party_top", "party", 30, "mem"),
        _value(8, "party_other_role", "count(*)", f"s WHERE party IS NOT NULL AND role NOT IN {_ASK}"),
        _counts(8, "ruling_status_values", "coalesce(ruling_status, '')"),
        *(_value(8, f"seniority_{c}", v, "mem") for c, v in (("lowest", "min(seniority)"), ("highest", "max(seniority)"), ("mean", "avg(seniority)"), ("null_share", "avg((seniority IS NULL)::INT)"))),
        _counts(8, "sessions", "CAST(term AS VARCHAR)", value="count(DISTINCT session)"),
        _value(8, "naas_cd_several", "count(*)", _severals("naas_cd", "member_id", "mem")),
        _value(9, "dyad_text_off", "count(*) FILTER (NOT same)", aligned),
        _value(9, "dyad_text_off_share", "avg((NOT same)::INT)", aligned),
        f"SELECT 10, 'first_digit_share', left(size::VARCHAR, 1), count(*) / (SELECT count(*) FROM {sizes})::DOUBLE FROM {sizes} GROUP BY 3",
        *(_value(10, f"speeches_per_legislator_{c}", v, people) for c, v in (("q25", "quantile_cont(n, 0.25)"), ("q50", "quantile_cont(n, 0.5)"), ("q75", "quantile_cont(n, 0.75)"), ("mean", "avg(n)"))),
        f"SELECT 10, 'legislator_top', member_id, n FROM (SELECT * FROM {people} ORDER BY n DESC, member_id LIMIT 10)",
        _counts(10, "term_speeches", "CAST(term AS VARCHAR)"),
        _counts(10, "term_meetings", "CAST(term AS VARCHAR)", value="count(DISTINCT meeting_id)"),
        _value(10, "last_term_speeches", "count(*)", "s WHERE term = 22"),
        _value(10, "last_term_meetings", "count(DISTINCT meeting_id)", "s WHERE term = 22"),
        _value(10, "intelligence_speeches", "count(*)", "s WHERE committee_key = 'intelligence'"),
        _value(10, "intelligence_meetings", "count(DISTINCT meeting_id)", "s WHERE committee_key = 'intelligence'"),
        _counts(10, "audit_share", "CAST(term AS VARCHAR)", value="count(*) FILTER (hearing_type = '국정감사') / nullif(count(*) FILTER (hearing_type IN ('국정감사', '상임위원회')), 0)::DOUBLE"),
    ]
    found = "\nUNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)
    cases = " ".join(f"WHEN \"check\" = '{c}' AND ({when}) THEN '{level}'" for c, rules_ in audit.LEVELS.items() for level, when in rules_)
    return f"""WITH {_FAULTY_SQL}, f AS ({found})
SELECT CAST(phase AS INT) AS phase, CASE {cases} WHEN "check" IN {_list(audit.LEVELS)} THEN 'OK' ELSE 'INFO' END AS severity, "check", key, round(CAST(value AS DOUBLE), 6) AS value FROM f"""


@query(_audit_sql())
def audit_report(spark, sf_dir):
    """All ten phases on the transcript with planted faults."""
    return audit.audit(*_faulty(spark, sf_dir))


@query(f"""
WITH {_FAULTY_SQL}, terms AS (SELECT unnest({list(V.TERMS)}) AS term)
SELECT 'dyad_terms_missing' AS "check", CAST(term AS VARCHAR) AS key, 1.0::DOUBLE AS value FROM terms WHERE term NOT IN (SELECT term FROM d)
UNION ALL SELECT 'dyad_committees_unknown', committee_key, count(*) FROM d WHERE committee_key NOT IN {_list(V.COMMITTEE_KEYS)} GROUP BY 2
UNION ALL SELECT 'speech_committees_unknown', committee_key, count(*) FROM s WHERE committee_key NOT IN {_list(V.COMMITTEE_KEYS)} GROUP BY 2
UNION ALL SELECT 'cross_term_ratio', CAST(a.term AS VARCHAR), round(b.n / a.n, 6) FROM (SELECT term, count(*)::DOUBLE AS n FROM s GROUP BY 1) a JOIN (SELECT term, count(*)::DOUBLE AS n FROM d GROUP BY 1) b USING (term)
UNION ALL SELECT 'speech_hearing_type_share', hearing_type, round(count(*) / (SELECT count(*) FROM s)::DOUBLE, 6) FROM s GROUP BY 2
UNION ALL SELECT 'dyad_hearing_type_share', hearing_type, round(count(*) / (SELECT count(*) FROM d)::DOUBLE, 6) FROM d GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'classify_unclassified_top', speaker, count(*) AS n FROM s WHERE role IN ('other', 'unknown') GROUP BY 2 ORDER BY n DESC, speaker LIMIT 20)
UNION ALL SELECT 'committee_unmapped', committee, count(*) FROM s WHERE committee_key = 'other' GROUP BY 2
UNION ALL SELECT * FROM (SELECT 'committee_several_keys', meeting_id, count(DISTINCT committee_key) FROM s GROUP BY 2 HAVING count(DISTINCT committee_key) > 1 ORDER BY meeting_id LIMIT 5)
UNION ALL SELECT * FROM (SELECT 'dyad_self_pairing', meeting_id || '/' || leg_name || '/' || witness_role AS key, count(*) FROM d WHERE leg_name = witness_name GROUP BY 2 ORDER BY key LIMIT 5)""")
def validation_details(spark, sf_dir):
    return validation.details(*_faulty(spark, sf_dir))


def investigation(spark, sf_dir):
    s, d = _transcript(spark, sf_dir)
    old = s.withColumn("role", F.when(F.col("speech_order") == "0", F.lit("other")).otherwise(F.col("role")))
    return audit.investigate(old, s, d)


QUERIES |= {"investigation": investigation}
