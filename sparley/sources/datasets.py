"""Versioned datasets, directory and CSV sources, and sinks."""

from __future__ import annotations

import datetime
import json
import os
import shutil
import urllib.request
import uuid
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LATEST = "v9"
#: File names of a version.
FILES = {"speeches": "all_speeches_16_22_{version}.parquet", "dyads": "dyads_16_22_{version}.parquet"}
ROOT_VARIABLE = "SPARLEY_DATA"

_LONGS, _DOUBLES, _FLAGS = ("term",), ("seniority", "leg_seniority"), ("dual_office", "witness_dual_office")
SPEECHES = ("meeting_id", "term", "committee", "committee_key", "hearing_type", "session", "sub_session", "date", "agenda", "speaker", "member_id", "member_uid", "speech_order", "role", "person_name", "person_title", "affiliation_raw", "speech_text", "name_clean", "party", "ruling_status", "seniority", "gender", "naas_cd", "ministry_normalized", "dual_office", "admin", "admin_ideology")


def schema(columns: Sequence[str]) -> T.StructType:
    """The types of transcript columns: strings but for terms, seniority and flags."""
    kinds = {c: T.LongType() for c in _LONGS} | {c: T.DoubleType() for c in _DOUBLES} | {c: T.BooleanType() for c in _FLAGS}
    return T.StructType([T.StructField(c, kinds.get(c, T.StringType())) for c in columns])


def path_of(dataset: str, version: str = LATEST, root: str | None = None) -> str:
    """Where a dataset's version is: root (or the variable's value), version, file."""
    if dataset not in FILES:
        raise ValueError(f"no dataset {dataset!r}; there are {', '.join(FILES)}")
    root = root or os.environ.get(ROOT_VARIABLE) or os.path.join(os.path.expanduser("~"), ".cache", "sparley")
    return f"{root.rstrip('/')}/{version}/{FILES[dataset].format(version=version)}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on any file system that Spark reads."""
    jvm = spark.sparkContext._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    return file.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(file)


def scratch(spark: SparkSession, what: str) -> str:
    """A fresh folder for a table of this application's own, where checkpoints go."""
    use_checkpoints(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{what}-{uuid.uuid4().hex}"


def use_checkpoints(spark: SparkSession) -> None:
    """Has checkpoints written to the folder of spark.checkpoint.dir; on one machine, where the
    session names none, to one of this user's."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    found = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the cluster shares")
    context.setCheckpointDir(found or "file:///tmp/checkpoints/sparley")


def read_optional(spark: SparkSession, path: str, missing: str = "fail") -> DataFrame | None:
    """A Parquet table; where it is missing: fail, or none."""
    if exists(spark, path):
        return spark.read.parquet(path)
    if missing == "fail":
        raise FileNotFoundError(path)
    return None


def fetch(url: str, path: str, chunk: int = 8 << 20) -> bool:
    """Copies a URL to a local file unless it is there; returns whether it did.

    The file appears whole or not at all: it is written beside its place and moved.
    """
    target = Path(path)
    if target.exists():
        return False
    target.parent.mkdir(parents=True, exist_ok=True)
    part = target.with_name(f"{target.name}.{uuid.uuid4().hex}.part")
    try:
        with urllib.request.urlopen(url) as source, part.open("wb") as out:
            shutil.copyfileobj(source, out, chunk)
        part.replace(target)
    finally:
        part.unlink(missing_ok=True)
    return True


def download(base_url: str, version: str = LATEST, root: str | None = None) -> dict[str, str]:
    """Fetches a version's files from <base_url>/<version>/; returns their paths."""
    paths = {name: path_of(name, version, root) for name in FILES}
    for path in paths.values():
        fetch(f"{base_url.rstrip('/')}/{version}/{path.rpartition('/')[2]}", path)
    return paths


def scan(df: DataFrame, columns: Sequence[str] | None = None, **equal) -> DataFrame:
    """Rows where each given column has its value, None meaning any; then the columns.

    Filter columns need not be selected. Both reach the Parquet scan.
    """
    for name, value in equal.items():
        if value is not None:
            df = df.filter(F.col(name) == F.lit(value))
    return df.select(*columns) if columns is not None else df


def load(spark: SparkSession, dataset: str, *, version: str = LATEST, term: int | None = None, hearing_type: str | None = None, columns: Sequence[str] | None = None, root: str | None = None) -> DataFrame:
    return scan(read_optional(spark, path_of(dataset, version, root)), columns, term=term, hearing_type=hearing_type)


def load_speeches(spark: SparkSession, **options) -> DataFrame:
    return load(spark, "speeches", **options)


def load_dyads(spark: SparkSession, **options) -> DataFrame:
    return load(spark, "dyads", **options)


def resolve(spark: SparkSession, version: str = LATEST, root: str | None = None) -> dict[str, str]:
    """The paths of a version's datasets; fails naming those that aren't there."""
    paths = {name: path_of(name, version, root) for name in FILES}
    lacking = [p for p in paths.values() if not exists(spark, p)]
    if lacking:
        raise FileNotFoundError(", ".join(lacking))
    return paths


def summary(df: DataFrame, *groups: str) -> DataFrame:
    """item, value, n: all rows, distinct values of each group column (nulls don't count),
    and rows of each value (null is one). One scan of the group columns: grouping sets count
    all, and what is left to do is done on their few rows."""
    if not groups:
        return df.agg(F.count("*").alias("n")).select(F.lit("rows").alias("item"), F.lit(None).cast("string").alias("value"), "n")
    entries = F.array(*(F.struct(F.lit(g).alias("g"), F.col(g).cast("string").alias("value")) for g in groups))
    counted = df.select(F.inline(entries)).groupBy("g", "value").agg(F.count("*").alias("n"))
    named = counted.select(F.concat(F.lit("by "), "g").alias("item"), "value", "n")
    several = F.array(*(F.lit(g) for g in groups))
    some = df.sparkSession.range(1).select(F.explode(several).alias("of")).join(counted.filter("value IS NOT NULL").groupBy("g").agg(F.count("*").alias("k")), F.col("of") == F.col("g"), "left")
    distinct = some.select(F.concat(F.lit("distinct "), "of").alias("item"), F.lit(None).cast("string").alias("value"), F.coalesce("k", F.lit(0)).cast("long").alias("n"))
    rows = counted.filter(F.col("g") == groups[0]).agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n")).select(F.lit("rows").alias("item"), F.lit(None).cast("string").alias("value"), "n")
    return rows.unionByName(distinct).unionByName(named)


def columns_of(spark: SparkSession, path: str) -> list[str]:
    """Column names from the schema alone."""
    return spark.read.parquet(path).columns


def read_csv(spark: SparkSession, path: str, kinds: T.StructType | None = None) -> DataFrame:
    """A CSV file with a header; without a schema all columns are strings."""
    reader = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"')
    return (reader.schema(kinds) if kinds else reader).csv(path)


def read_meetings(spark: SparkSession, folder: str, file: str = "minutes.csv") -> DataFrame:
    """All <folder>/<meeting>/minutes.csv files, with the directory's name as meeting_id.
    Directories without the file are skipped, damaged files too; none at all is an error."""
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("encoding", "UTF-8").option("ignoreCorruptFiles", True)
    try:
        df = reader.csv(f"{folder.rstrip('/')}/*/{file}")
    except Exception as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"no {file} under {folder}") from error
        raise
    df = df.withColumnsRenamed({c: c.lstrip("﻿") for c in df.columns})
    return df.withColumn("meeting_id", F.regexp_extract(F.col("_metadata.file_path"), f"([^/]+)/{file.replace('.', '[.]')}$", 1))


def write_table(df: DataFrame, path: str, dry_run: bool = False, compression: str = "zstd", partition_by: Sequence[str] = ()) -> bool:
    """Writes Parquet, or not in a dry run; returns whether it wrote."""
    if not dry_run:
        df.write.mode("overwrite").partitionBy(*partition_by).option("compression", compression).parquet(path)
    return not dry_run


def export(df: DataFrame, path: str, form: str = "csv", single: bool = True) -> None:
    """Exports as CSV with a header, or Parquet. A single file is written by one task; leave
    `single` off for what one task shouldn't write."""
    out = (df.coalesce(1) if single else df).write.mode("overwrite")
    out.option("header", True).csv(path) if form == "csv" else out.parquet(path)


def write_findings(found: DataFrame, path: str, metadata: Mapping[str, object] | None = None) -> None:
    """Writes an audit as JSON: {timestamp, summary by severity, findings, metadata}."""
    rows = [row.asDict(recursive=True) for row in found.collect()]
    tally: dict[str, int] = {}
    for row in rows:
        tally[row["severity"]] = tally.get(row["severity"], 0) + 1
    now = datetime.datetime.now(datetime.UTC).isoformat(timespec="seconds")
    with open(path, "w", encoding="utf-8") as out:
        json.dump({"timestamp": now, "summary": tally | {"total": len(rows)}, "findings": rows, "metadata": dict(metadata or {})}, out, ensure_ascii=False, indent=2, default=str)


def write_report(checks: DataFrame, path: str, metadata: Mapping[str, object] | None = None) -> int:
    """Writes {summary, checks, metadata} as JSON; returns 1 if a check failed, else 0.
    Reports have a row for each check."""
    rows = [row.asDict(recursive=True) for row in checks.collect()]
    tally: dict[str, int] = {}
    for row in rows:
        tally[row["status"]] = tally.get(row["status"], 0) + 1
    with open(path, "w", encoding="utf-8") as out:
        json.dump({"summary": tally | {"total": len(rows)}, "checks": rows, "metadata": dict(metadata or {})}, out, ensure_ascii=False, indent=2, default=str)
    return int("FAIL" in tally)
