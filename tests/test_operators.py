"""Pairs, groups, joins, sources and plans on small tables."""

import json
import random

import pytest
from conftest import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sparley.operators import groups, joins, pairs
from sparley.plans import audit, build, validation
from sparley.sources import datasets

L, N, X = "legislator", "witness", "other"


def made(roles):
    """Pairs in plain Python."""
    out = []
    for a, b in zip(roles, roles[1:], strict=False):
        if a in (L, "chair") and b in (N, "minister"):
            out.append("question")
        elif a in (N, "minister") and b in (L, "chair"):
            out.append("answer")
    return sorted(out)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from([L, "chair", N, "minister", X, "committee_staff"]), max_size=14), min_size=1, max_size=4))
def test_dyads_match_plain_python(spark, meetings):
    rows = [(f"m{m}", str(k), r) for m, roles in enumerate(meetings) for k, r in enumerate(roles)] or [("m", "0", X)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "meeting_id string, speech_order string, role string")
    got = pairs.dyads(df, "meeting_id", "speech_order", "role").groupBy("meeting_id").agg(F.sort_array(F.collect_list("direction")).alias("d"))
    assert {r["meeting_id"]: r["d"] for r in got.collect()} == {f"m{m}": made(r) for m, r in enumerate(meetings) if made(r)}


def test_dyads_order_numerically_and_drop_bad_orders(spark):
    rows = [("m", "10", L), ("m", "2", N), ("m", "1", L), ("m", "x", N), ("m", None, N)]
    got = pairs.dyads(spark.createDataFrame(rows, "g string, o string, r string"), "g", "o", "r", leg={"leg": "o"}, witness={"wit": "o"})
    assert rows_of(got.select("leg", "wit", "direction")) == [("answer", "10", "2"), ("question", "1", "2")]


def test_one_exchange_for_dyads(spark):
    df = spark.range(100).selectExpr("CAST(id % 7 AS STRING) AS g", "CAST(id AS STRING) AS o", "'legislator' AS r")
    plan = pairs.dyads(df, "g", "o", "r")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "Python" not in plan


def test_continuity(spark):
    rows = [("a", "1"), ("a", "2"), ("a", "4"), ("b", "1"), ("b", "1"), ("c", "x"), ("c", "3")]
    got = groups.continuity(spark.createDataFrame(rows, "g string, o string"), "g", "o").select("g", "missing", "repeated", "not_numbers", "gap")
    assert rows_of(got.select("g", "missing", "repeated", "not_numbers")) == [("a", 1, 0, 0), ("b", 0, 0, 1), ("c", 0, 1, 0)]


def test_month_gap(spark):
    df = spark.createDataFrame([("2001-01-05",), ("2001-05-09",), ("2001-07-01",)], "d string")
    assert [tuple(map(str, r)) for r in groups.month_gaps(df, "d").collect()] == [("2001-02-01", "2001-04-01", "3")]


def test_canonical_names(spark):
    df = spark.createDataFrame([(1, "홍길동", None), (1, "대리홍길동", None), (1, "대리홍길동", "반장"), (None, "x", None)], "k int, n string, t string")
    assert rows_of(groups.canonical_names(df, "k", "n", "t")) == sorted([(1, "홍길동", None), (1, "홍길동", "대리"), (1, "홍길동", "반장"), (None, "x", None)], key=repr)


def test_interval_tiers(spark):
    panel = spark.createDataFrame([("A", "X", "2001-01-01", "2002-12-31", 1), ("A", "Y", "2003-01-01", None, 2), ("B", "Z", None, None, 3)], "n string, m string, s string, e string, o int").withColumns({"s": F.col("s").cast("date"), "e": F.col("e").cast("date"), "v": F.col("o")})
    facts = spark.createDataFrame([("A", "Y", "2001-06-01", "m1", 1), ("A", "X", "2001-06-01", "m2", 1), ("A", "Y", "1999-01-01", "m3", 1), ("A", "Q", "1999-01-01", "m4", 1), ("B", "Q", "1999-01-01", "m5", 1)], "p string, min string, d string, meet string, at int").withColumn("d", F.col("d").cast("date"))
    got = joins.interval_link(facts, panel, "p", "min", "d", ["p", "meet"], "at", "n", "m", "s", "e", "o", ["v"])
    assert rows_of(got.select("meet", "tier", "v")) == [("m1", 2, 1), ("m2", 1, 1), ("m3", 3, 2), ("m4", None, None), ("m5", 4, 3)]


def test_append_is_idempotent(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    batch = spark.createDataFrame([("2", "x"), ("3", "c")], "k string, w string")
    once = joins.append_new(base, batch, "k")
    assert rows_of(once) == rows_of(joins.append_new(once, batch, "k")) == [(1, "a"), (2, "b"), (3, None)]


def test_duplicates(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "i int, k string")
    assert rows_of(groups.flag_duplicates(df, ["k"]).select("i", "n_copies")) == [(1, 2), (2, 2), (3, 1)]
    first = groups.dedup_first(df, ["k"], ["i"])
    assert rows_of(first) == rows_of(groups.dedup_first(first, ["k"], ["i"])) == [(1, None), (3, "a")]


def test_empty_tables(spark):
    df = spark.createDataFrame([], "g string, o string, r string, v double")
    assert pairs.dyads(df, "g", "o", "r").count() == pairs.transitions(df, "g", "o", "r").count() == 0
    assert groups.shares(df, "g").count() == groups.size_outliers(df, "g").count() == groups.month_gaps(df, "o").count() == 0


def test_loader(spark, tmp_path):
    df = spark.createDataFrame([("a", 20, "국정감사"), ("b", 21, None)], "meeting_id string, term long, hearing_type string")
    df.write.parquet(datasets.path_of("speeches", "v9", str(tmp_path)))
    assert rows_of(datasets.load_speeches(spark, root=str(tmp_path), term=20, columns=["meeting_id"])) == [("a",)]
    assert datasets.load_speeches(spark, root=str(tmp_path), hearing_type="none").count() == 0
    with pytest.raises(FileNotFoundError):
        datasets.resolve(spark, root=str(tmp_path))
    plan = datasets.load_speeches(spark, root=str(tmp_path), term=20, columns=["meeting_id"])._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(term,20)" in plan and "ReadSchema: struct<meeting_id:string,term:bigint>" in plan


def test_meeting_folders(spark, tmp_path):
    for name in ("m1", "m2", "m3"):
        (tmp_path / name).mkdir()
    for name in ("m1", "m2"):
        (tmp_path / name / "minutes.csv").write_text('﻿speaker,text\n홍길동,"a, b"\n', encoding="utf-8")
    assert rows_of(datasets.read_meetings(spark, str(tmp_path))) == [("m1", "홍길동", "a, b"), ("m2", "홍길동", "a, b")]
    with pytest.raises(FileNotFoundError):
        datasets.read_meetings(spark, str(tmp_path / "none"))


def test_build_and_checks(spark, tmp_path):
    rows = [("1", 20, "국정감사", "2017-03-01", "위원장 김위원", "11", str(k), r, "김위원", "text " + "x" * 20) for k, r in enumerate([L, "minister", L, "witness"])]
    speeches = spark.createDataFrame(rows, "meeting_id string, term int, hearing_type string, date string, speaker string, member_id string, speech_order string, role string, person_name string, speech_text string")
    speeches = speeches.withColumns({"member_id": F.when(F.col("role") == L, F.col("member_id")), "affiliation_raw": F.lit("법부무")})
    panel = spark.createDataFrame([("김위원", "법무부", "2016-01-01", "2018-01-01", True, "박근혜", "Conservative")], "name string, ministry string, start string, end string, dual_office boolean, admin string, admin_ideology string").withColumns({c: F.col(c).cast("date") for c in ("start", "end")})
    s, d = build.build(spark, speeches, str(tmp_path / "out"), panel=panel)
    assert set(datasets.SPEECHES) <= set(s.columns) and tuple(d.columns) == build.DYADS
    assert rows_of(s.filter("role = 'minister'").select("ministry_normalized", "admin", "dual_office")) == [("박근혜", True, "법무부")]
    assert d.count() == 3
    report = {r["check"]: r["status"] for r in validation.validate(s, d).collect()}
    assert report["cross_dyad_formation"] == "PASS" and report["speech_duplicates"] == "PASS" and report["dyad_schema_required"] == "PASS"
    assert datasets.write_report(validation.validate(s, d), str(tmp_path / "report.json")) == 1
    assert json.loads((tmp_path / "report.json").read_text())["summary"]["FAIL"] >= 1
    found = audit.audit(s, d)
    assert found.filter("severity = 'CRITICAL'").count() == 0 and {r["phase"] for r in found.select("phase").distinct().collect()} == set(range(1, 11))
    assert audit.exit_status(found) == 0
    datasets.write_findings(found, str(tmp_path / "audit.json"), {"version": "x"})
    told = json.loads((tmp_path / "audit.json").read_text())
    assert told["summary"]["total"] == len(told["findings"]) == found.count() and told["timestamp"]


def test_a_phase_that_fails_while_it_runs_is_a_finding(spark):
    s = spark.createDataFrame([("m", "1", "legislator")], "meeting_id string, speech_order string, role string")
    fails = F.udf(lambda x: 1 // 0, "int")
    phases = audit.PHASES | {5: lambda s, d: audit._rows(s.select(fails("role").alias("v")), "never", None, "v"), 6: lambda s, d: audit._rows(s.agg(F.count("*").alias("n")), "date_blank", None, "n")}
    old, audit.PHASES = audit.PHASES, phases
    try:
        found = audit.audit(s, s, (5, 6))
    finally:
        audit.PHASES = old
    assert sorted((r["phase"], r["severity"], r["check"]) for r in found.collect()) == [(5, "CRITICAL", "phase5_error"), (6, "ISSUE", "date_blank")]
    assert audit.exit_status(found) == 2


def test_middle_of_wide_rows_and_ties(spark):
    chance = random.Random(4)
    rows = [(k, chance.randrange(-1000, 1000)) for k in range(30_000)]
    df = spark.createDataFrame(rows, "k long, v long").repartition(7, "k").withColumn("wide", F.repeat(F.lit("x"), 2000))
    want = sorted(rows, key=lambda r: (r[1], r[0]))[15_000]
    for few in (100_000, 50, 1):
        got = groups.middle(df, "v", "k", few=few).collect()
        assert [(r["k"], r["v"]) for r in got] == [want] and len(got[0]["wide"]) == 2000
    ties = spark.createDataFrame([(k, 5.0, None) for k in range(1000)], "k long, v double, n long")
    assert groups.middle(ties, "n", "v", "k", few=10).first()["k"] == 500
    assert groups.middle(ties.limit(0), "v", "k").count() == 0


def test_versions(spark):
    old = spark.createDataFrame([("a", "x"), ("a", "x"), ("b", "x")], "meeting_id string, hearing_type string")
    new = spark.createDataFrame([("a", "x"), ("c", "y"), ("c", "y"), ("d", "x")], "meeting_id string, hearing_type string")
    got = {(r["item"], r["value"]): r["n"] for r in build.verify(old, new).collect()}
    assert got == {("old speeches", None): 3, ("new speeches in all", None): 4, ("old meetings", None): 2, ("new meetings in all", None): 3, ("added meetings", None): 2, ("lost meetings", None): 1, ("new speeches", "y"): 2, ("new meetings", "y"): 1, ("new speeches", "x"): 1, ("new meetings", "x"): 1}


def test_command_line_builds_and_verifies(spark, tmp_path, capsys):
    from sparley import cli

    rows = [("1", 20, "국정감사", "2017-03-01", "위원장 김위원", "11", str(k), r, "김위원", "text") for k, r in enumerate([L, N, L])]
    spark.createDataFrame(rows, "meeting_id string, term int, hearing_type string, date string, speaker string, member_id string, speech_order string, role string, person_name string, speech_text string").write.parquet(str(tmp_path / "raw"))
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    assert cli.main(["build", "--speeches", raw, "-o", out, "--dry-run"]) == 0 and not (tmp_path / "out").exists()
    assert cli.main(["build", "--speeches", raw, "-o", out]) == 0
    assert cli.main(["verify", "--old", raw, "--new", f"{out}/speeches.parquet"]) == 0
    assert cli.main(["verify", "--old", raw, "--new", str(tmp_path / "none")]) == 1
    at = ["--speeches", f"{out}/speeches.parquet", "--dyads", f"{out}/dyads.parquet"]
    assert cli.main(["validate", "--report", str(tmp_path / "r.json"), *at]) == 1
    assert cli.main(["audit", "--phase", "4,7", "--report", str(tmp_path / "a.json"), *at]) in (0, 1)
    assert {f["phase"] for f in json.loads((tmp_path / "a.json").read_text())["findings"]} == {4, 7}


def test_stream_appends_new_meetings_once(spark, tmp_path):
    from sparley.streaming import append

    schema = "meeting_id string, speech_order string, role string"
    source, table, derived = str(tmp_path / "in"), str(tmp_path / "table"), str(tmp_path / "dyads")
    make = {derived: lambda df: pairs.dyads(df, "meeting_id", "speech_order", "role")}

    def take():
        append.run(spark.readStream.schema(schema).parquet(source), table, "meeting_id", str(tmp_path / "state"), make).awaitTermination()

    spark.createDataFrame([("a", "1", L), ("a", "2", N)], schema).coalesce(1).write.parquet(source)
    take()
    spark.createDataFrame([("a", "1", L), ("b", "1", N), ("b", "2", L)], schema).coalesce(1).write.mode("append").parquet(source)
    take()
    take()
    assert rows_of(spark.read.parquet(table).groupBy("meeting_id").count()) == [(2, "a"), (2, "b")]
    assert spark.read.parquet(derived).count() == 2


def test_download_is_whole_and_cached(tmp_path):
    source = tmp_path / "server" / "v9"
    source.mkdir(parents=True)
    for name in datasets.FILES.values():
        (source / name.format(version="v9")).write_bytes(b"x" * 100)
    base, root = f"file://{tmp_path}/server", str(tmp_path / "cache")
    paths = datasets.download(base, root=root)
    assert all(open(p, "rb").read() == b"x" * 100 for p in paths.values())
    assert not datasets.fetch("file:///nowhere", paths["speeches"])
    with pytest.raises(OSError):
        datasets.fetch("file:///nowhere", str(tmp_path / "a" / "b"))
    assert list((tmp_path / "a").iterdir()) == []


def test_command_line(spark, tmp_path, capsys):
    from sparley import cli

    df = spark.createDataFrame([("a", 20, "국정감사"), ("b", 21, None)], "meeting_id string, term long, hearing_type string")
    df.write.parquet(datasets.path_of("speeches", "v9", str(tmp_path)))
    assert cli.main(["--root", str(tmp_path), "info"]) == 0
    assert cli.main(["--root", str(tmp_path), "export", "--term", "20", "-o", str(tmp_path / "out")]) == 0
    assert "1 rows" in capsys.readouterr().out
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 1


def test_members_fill_legislators_only(spark):
    s = spark.createDataFrame([("김", 20, "legislator", None), ("김", 20, "witness", None), ("이", 20, "chair", "kept"), ("박", 20, "chair", None)], "person_name string, term int, role string, party string")
    members = spark.createDataFrame([("김", 20, "first"), ("이", 20, "other")], "name string, term int, party string")
    for c in ("ruling_status", "gender", "naas_cd"):
        s, members = s.withColumn(c, F.lit(None).cast("string")), members.withColumn(c, F.lit("x"))
    s, members = s.withColumn("seniority", F.lit(None).cast("double")).withColumn("name_clean", F.lit(None).cast("string")), members.withColumn("seniority", F.lit(2.0))
    got = build.with_members(s, members)
    assert rows_of(got.filter("name_clean IS NOT NULL").select("name_clean", "role")) == [("김", "legislator"), ("이", "chair")]
    assert rows_of(got.select("party", "person_name", "role")) == sorted([("first", "김", "legislator"), (None, "김", "witness"), ("kept", "이", "chair"), (None, "박", "chair")], key=repr)
    assert build.with_members(s, members, legislators_only=False).filter("party IS NULL").count() == 1


def test_conferences_match_by_id_then_by_day(spark):
    s = spark.createDataFrame([("12345", "2001-01-01", "A"), ("9", "2001-01-02", "B"), ("8", "2001-01-03", "C")], "meeting_id string, date string, committee string")
    details = spark.createDataFrame([("012345", "x", "x", "Y", "N", None, "Y", "10:00", None, "u1"), ("000001", "2001-01-02", "B", "N", "Y", "Y", "N", None, None, "u2"), ("000002", "2001-01-02", "B", "Y", "Y", "Y", "Y", None, None, "u3")], "CONF_ID string, CONF_DT string, CMIT_NM string, HR_HRG_YN string, PBHRG_YN string, HRG_YN string, SITG_YN string, BG_PTM string, ED_PTM string, DOWN_URL string")
    got = build.with_conferences(s, details)
    assert rows_of(got.select("download_url", "is_hearing", "is_public_hearing", "meeting_id")) == sorted([("u1", True, False, "12345"), ("u2", False, True, "9"), (None, False, False, "8")], key=repr)


def test_scraped_rows_are_classified_and_new_meetings_paired(spark):
    scraped = spark.createDataFrame([("m1", "위원장 김위원", None, "1", "q"), ("m1", "법무부장관 이법무", None, "2", "a"), ("m1", "박의원", "77", "3", "r")], "meeting_id string, speaker string, member_id string, speech_order string, speech_text string")
    s = build.classified(scraped, "judiciary")
    assert rows_of(s.select("committee_key", "person_name", "role")) == sorted([("judiciary", "김위원", "chair"), ("judiciary", "이법무", "minister"), ("judiciary", "박의원", "legislator")], key=repr)
    once = build.dyads_for_new(s, build.dyads(s.limit(0)))
    assert rows_of(once) == rows_of(build.dyads_for_new(s, once)) and once.count() == 2
