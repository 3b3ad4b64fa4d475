"""Queries of the llm operators on the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, chat, licenses, lm, mixing, near_dedup, quality_classifier, quality_rules, sentencepiece, warc
from .common import fresh_dir, table

W = r"[^\x20\x09-\x0D]+"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_dir(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), folder)
    return warc.read_archive(spark, folder)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.group(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "kept_chars", "base_failed", "kept")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.sql(f"SELECT -1L AS conv_id, turn, role, '{said}' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    return chat.read_digests(chat.format_conversations(turns.unionByName(own), fresh_dir(spark, "chat")))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_classifier.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "p_text", "p_meta", "p_quality", "kept")


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op10_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_warc": op1_warc,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_near_dedup": op3_near_dedup,
    "op4_ann": op4_ann,
    "op5_quality_rules": op5_quality_rules,
    "op6_chat": op6_chat,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_mixing": op8_mixing,
    "op9_licenses": op9_licenses,
    "op10_lm": op10_lm,
}

_CHARS = "length(translate({}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), ''))"

_MARKS = quality_rules.MARKS

OP5_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
a AS (SELECT doc_id, t, regexp_extract_all(t, '{W}') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{W}')) AS ls FROM d),
g AS (SELECT doc_id, i, ws[i] AS x, ws[i + 1] AS y, ws[i + 2] AS z FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM a)),
h AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, x, y, z) AS n FROM g),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM h, (VALUES (0), (1), (2)) AS v(k) WHERE n > 1 GROUP BY doc_id),
l AS (SELECT doc_id, unnest(ls) AS line FROM a),
m AS (SELECT doc_id, {_CHARS.format("line")} AS chars, line,
             length(line) - length(translate(line, '{_MARKS}', '')) + len(regexp_extract_all(line, '[!?]{{2,}}')) AS marks,
             length(line) - length(translate(line, '{quality_rules.NAVIGATION}', '')) AS seps, len(regexp_extract_all(line, '{W}')) AS words FROM l),
k AS (SELECT doc_id, CAST(sum(chars) AS BIGINT) AS kept_chars FROM m
      WHERE regexp_matches(line, '[\\p{{L}}\\p{{N}}]') AND marks <= {quality_rules.MOST_MARKS} * chars
        AND (regexp_matches(line, '{quality_rules.CLOSING.replace("'", "''")}') OR words > {quality_rules.OPEN_WORDS})
        AND NOT (seps >= {quality_rules.SEPARATORS} AND seps * {quality_rules.SEPARATOR_WORDS} >= words)
        AND NOT (length(line) <= {quality_rules.BOILERPLATE_CHARS} AND ({" OR ".join("contains(lower(line), '" + x.replace("'", "''") + "')" for x in quality_rules.BOILERPLATE)}))
      GROUP BY doc_id),
o AS (SELECT a.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST({_CHARS.format("t")} AS BIGINT) AS word_chars,
             CAST(length(t) - length(translate(t, '{quality_rules.SYMBOLS}', '')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, coalesce(kept_chars, 0) AS kept_chars
      FROM a LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM o)
SELECT *, NOT base_failed AND kept_chars >= {quality_rules.LEAST_KEPT} * word_chars AS kept FROM f"""


def _hex(text: str, digits: int) -> str:
    return f"CAST(('0x' || substr(md5({text}), 1, {digits})) AS BIGINT)"


def _seats(parties: str, by: str, votes: str, seats: str, order: str, name: str) -> str:
    return f"""
{name}a AS (SELECT *, sum({votes}) OVER (PARTITION BY {by}) AS all_, count(*) OVER (PARTITION BY {by}) AS n_ FROM {parties}),
{name}b AS (SELECT *, CASE WHEN all_ > 0 THEN CAST(ceil((n_ / 2.0::DOUBLE + 1) * ({votes} / all_)) AS BIGINT) + 1 ELSE 0 END AS reach_ FROM {name}a),
{name}c AS (SELECT *, CASE WHEN all_ > 0 THEN greatest(0, CAST(round({seats} * ({votes} / all_)) AS BIGINT) - reach_) ELSE 0 END AS low_ FROM {name}b),
{name}d AS (SELECT *, {seats} - sum(low_) OVER (PARTITION BY {by}) AS open_ FROM {name}c),
{name}e AS (SELECT *, unnest(range(0, 2 * reach_ + 2)) AS i_ FROM {name}d WHERE {votes} > 0),
{name}f AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY {votes} / (2 * (low_ + i_) + 1) DESC, {order}) AS r_ FROM {name}e),
{name}g AS (SELECT {by} AS by_, {order} AS order_, count(*) AS got_ FROM {name}f WHERE r_ <= open_ GROUP BY ALL),
{name} AS (SELECT {name}d.*, CAST(low_ + coalesce(got_, 0) AS BIGINT) AS quota FROM {name}d LEFT JOIN {name}g ON by_ = {by} AND order_ = {order})"""


OP8_SQL = f"""
WITH sizes AS (SELECT doc_id, CAST(coalesce(len(regexp_extract_all(text, '{W}')), 0) AS BIGINT) AS size, source, coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, ''))) AS id FROM documents),
s1 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sizes GROUP BY source),
s2 AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS s FROM s1),
s3 AS (SELECT *, {list(mixing.WEIGHTS)}[(s - 1) % {len(mixing.WEIGHTS)} + 1] AS w, {mixing.MOST_REPEATS} * source_size AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM s2),
s4 AS (SELECT *, cap / CAST(w AS DOUBLE) AS fills,
              CAST(coalesce(sum(cap) OVER (ORDER BY cap / CAST(w AS DOUBLE), s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS below,
              CAST(sum(w) OVER (ORDER BY cap / CAST(w AS DOUBLE), s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS rest FROM s3),
s5 AS (SELECT *, (total - below) / CAST(rest AS DOUBLE) AS l FROM s4),
s6 AS (SELECT *, (SELECT l FROM s5 WHERE l <= fills ORDER BY fills, s LIMIT 1) AS level FROM s5),
s7 AS (SELECT source, s, source_size, CASE WHEN fills < level THEN CAST(cap AS DOUBLE) ELSE w * level END AS target, 1 AS one,
              CAST(round(total / {float(mixing.BLOCK)}::DOUBLE) AS BIGINT) AS seats,
              greatest(1, CAST(ceil(source_size / {float(mixing.SHARD_WORDS)}::DOUBLE) AS BIGINT)) AS shards FROM s6),
{_seats("s7", "one", "target", "seats", "s", "p")},
placed AS (SELECT z.doc_id, z.size, p.s, p.source_size, p.target, p.quota AS source_quota, md5('17:' || z.id) AS m, {_hex("'17:' || z.id", 15)} % p.shards AS shard
           FROM sizes z JOIN p ON z.source IS NOT DISTINCT FROM p.source),
t AS (SELECT s, shard, s * {mixing.AREAS} + shard // {mixing.AREA} AS area, CAST(sum(size) AS BIGINT) AS shard_size, first(source_quota) AS seats, CAST(sum(size) AS DOUBLE) AS votes FROM placed GROUP BY s, shard),
r AS (SELECT s, area, sum(votes) AS votes, first(seats) AS seats FROM t GROUP BY s, area),
{_seats("r", "s", "votes", "seats", "area", "v")},
ta AS (SELECT t.s, t.shard, t.area, t.shard_size, t.votes, v.quota AS seats FROM t JOIN v ON t.area = v.area),
{_seats("ta", "area", "votes", "seats", "shard", "u")},
line AS (SELECT *, CAST(sum(size) OVER (PARTITION BY s, shard ORDER BY m, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) - size AS b FROM placed),
q AS (SELECT s AS qs, shard AS qshard, shard_size, least(quota * {mixing.BLOCK}, {mixing.MOST_REPEATS} * shard_size) AS words FROM u),
x AS (SELECT l.*, shard_size, CASE WHEN shard_size > 0 THEN words // shard_size ELSE 0 END AS passes,
             CASE WHEN shard_size > 0 THEN words % shard_size ELSE 0 END AS run,
             CASE WHEN shard_size > 0 THEN ({_hex("'17/' || CAST(s AS VARCHAR) || '/' || CAST(shard AS VARCHAR)", 7)} % greatest(1, shard_size // {mixing.BLOCK})) * {mixing.BLOCK} ELSE 0 END AS off
      FROM line l JOIN q ON l.s = qs AND l.shard = qshard)
SELECT doc_id, size, source_size, target,
       CAST(passes * size + greatest(0, least(b + size, off + run) - greatest(b, off)) + greatest(0, least(b + size, off + run - shard_size) - b) AS BIGINT) AS taken
FROM x"""

OP1_SQL = f"""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
t AS (SELECT *, CASE WHEN payload_bytes >= {warc.LEAST_REVISIT} THEN max(page_id) OVER (PARTITION BY payload_digest) END AS top FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN top IS NOT NULL AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM top THEN top END AS refers_to FROM t"""


def _escapes(column: str) -> str:
    """Characters that escaping adds: one for each backslash and each control string."""
    def quoted(x: str) -> str:
        return " || ".join("chr(10)" if c == "\n" else f"'{c}'" for c in x.partition("\n")[:2] if c)

    controls = [c.removesuffix("\n") for c in chat.CONTROLS]
    return " + ".join([f"(length({column}) - length(replace({column}, chr(92), '')))"] + [f"(length({column}) - length(replace({column}, {quoted(c)}, ''))) // {len(c)}" for c in controls])


OP6_SQL = f"""
WITH t AS (SELECT conv_id, turn, role, text FROM conversations
           UNION ALL SELECT -1, k, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) AS v(k, r)),
u AS (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM t),
f AS (SELECT *, {len(chat.TURN + chat.TEXT + chat.END)} + length(r) + length(x) + {_escapes("r")} + {_escapes("x")} AS chars FROM u)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn, r, x)) AS turns_sha256,
       CAST(coalesce(sum(length(x)) FILTER (r = '{chat.LOSS_ROLE}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(x, '' ORDER BY turn, r, x) FILTER (r = '{chat.LOSS_ROLE}'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM f GROUP BY conv_id"""

OP3_SQL = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{W}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(ws, i, i + 4) AS x FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, CAST(len(ws) > 0 AS INT) + 1))) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS MATERIALIZED (SELECT a, b FROM shared JOIN n p ON a = p.doc_id JOIN n q ON b = q.doc_id WHERE 100 * k >= {near_dedup.LINK_PERCENT} * (p.n + q.n - k)),
reach AS (SELECT doc_id AS v, doc_id AS r FROM documents UNION SELECT l.b, r FROM reach JOIN links l ON l.a = v),
c AS (SELECT v AS doc_id, min(r) AS component_id FROM reach GROUP BY v)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN c ON c.doc_id = d.doc_id"""



def _canonical(text: str) -> str:
    out = f"translate(coalesce({text}, ''), '{licenses.UPPER}', '{licenses.LOWER}')"
    out = f"regexp_replace({out}, '{licenses.COPYRIGHT_LINE}', ' ', 'g')"
    out = f"(' ' || trim(regexp_replace({out}, '{licenses.PUNCTUATION}', ' ', 'g'), ' '))"
    for a, b in licenses.SPELLINGS:
        out = f"replace({out}, '{a}', '{b}')"
    return f"sha256(trim({out}, ' '))"


_KNOWN = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in licenses.LICENSES)
_DIGESTS = ", ".join(f"('{i}', '{d}')" for i, d in licenses.DIGESTS)
OP9_SQL = f"""
WITH known AS (SELECT digest, min(i) AS license_id FROM (SELECT {_canonical("t")} AS digest, i FROM (VALUES {_KNOWN}) AS v(i, t) UNION ALL SELECT d, i FROM (VALUES {_DIGESTS}) AS w(i, d)) GROUP BY 1),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
notices AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT license_id, ',' ORDER BY license_id) AS notices
            FROM lines JOIN known ON {_canonical("line")} = digest GROUP BY doc_id),
whole AS (SELECT doc_id, {_canonical("text")} AS text_digest FROM documents)
SELECT whole.doc_id, text_digest, license_id, CAST(coalesce(n, 0) AS BIGINT) AS n_notices, coalesce(notices, '') AS notices
FROM whole LEFT JOIN known ON digest = text_digest LEFT JOIN notices USING (doc_id)"""

#: The exact neighbours, which the search finds on the test tables.
OP4_SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
ok AS (SELECT vec_id, x FROM v WHERE list_bool_and(list_transform(x, lambda c: c IS NOT NULL AND isfinite(c))) AND list_bool_or(list_transform(x, lambda c: c <> 0))),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x) AS score FROM ok q JOIN ok c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20"""

ORACLES = {"op4_ann": OP4_SQL, "op9_licenses": OP9_SQL, "op1_warc": OP1_SQL, "op3_near_dedup": OP3_SQL, "op6_chat": OP6_SQL, "op5_quality_rules": OP5_SQL, "op8_mixing": OP8_SQL}
