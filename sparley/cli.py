"""python -m sparley {resolve,download,info,export,build,enrich,verify,validate,audit}"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans import audit, build, validation
from .sources import datasets


def tables(spark: SparkSession, options: argparse.Namespace, at: dict) -> tuple[DataFrame, DataFrame]:
    """Speeches and dyads: those that are named, or the version's."""
    return tuple(spark.read.parquet(path) if (path := getattr(options, name)) else datasets.load(spark, name, **at) for name in ("speeches", "dyads"))


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="sparley", description=__doc__)
    parser.add_argument("--version", default=datasets.LATEST)
    parser.add_argument("--root")
    commands = parser.add_subparsers(dest="command", required=True)
    commands.add_parser("resolve", help="paths of a version's datasets")
    commands.add_parser("download", help="files of a version from a server").add_argument("--base-url", required=True)
    commands.add_parser("info", help="rows by term and hearing type")
    export = commands.add_parser("export", help="filtered rows to CSV or Parquet")
    export.add_argument("--dataset", choices=sorted(datasets.FILES), default="speeches")
    export.add_argument("--term", type=int)
    export.add_argument("--hearing-type")
    export.add_argument("--format", choices=["csv", "parquet"], default="csv")
    export.add_argument("-o", "--output", required=True)
    phases = commands.add_parser("audit", help="the deep audit, or some of its phases")
    phases.add_argument("--phase", default="all", help="numbers joined by commas, or all")
    phases.add_argument("--report", help="a file for the findings as JSON")
    validate = commands.add_parser("validate", help="checks of speeches and dyads")
    validate.add_argument("--report", required=True)
    for command in (validate, phases):
        command.add_argument("--speeches", help="the table, where it isn't the version's")
        command.add_argument("--dyads")
    make = commands.add_parser("build", help="enriched speeches and dyads of raw speeches")
    make.add_argument("--speeches", required=True)
    make.add_argument("-o", "--output", required=True)
    make.add_argument("--dry-run", action="store_true", help="plan and count, write nothing")
    add = commands.add_parser("enrich", help="conference details for speeches")
    add.add_argument("--speeches", required=True)
    add.add_argument("-o", "--output", required=True)
    for command, names in ((make, ("members", "panel", "details")), (add, ("details",))):
        for name in names:
            command.add_argument(f"--{name}", required=command is add, help="CSV")
    check = commands.add_parser("verify", help="what a version has that an older one hasn't")
    check.add_argument("--old", required=True)
    check.add_argument("--new", required=True)
    options = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("sparley").getOrCreate()
    at = {"version": options.version, "root": options.root}
    if options.command == "resolve":
        for name, path in datasets.resolve(spark, **at).items():
            print(name, path)
    elif options.command == "download":
        for name, path in datasets.download(options.base_url, **at).items():
            print(name, path)
    elif options.command == "audit":
        chosen = tuple(audit.PHASES) if options.phase == "all" else tuple(map(int, options.phase.split(",")))
        found = audit.audit(*tables(spark, options, at), chosen)
        found.orderBy("phase", "check", "key").show(100_000, truncate=False)
        if options.report:
            datasets.write_findings(found, options.report, at)
        return audit.exit_status(found)
    elif options.command == "build":
        side = {n: datasets.read_csv(spark, path) for n in ("members", "panel", "details") if (path := getattr(options, n))}
        if "panel" in side:
            side["panel"] = side["panel"].withColumns({"start": F.col("start").try_cast("date"), "end": F.col("end").try_cast("date"), "dual_office": F.col("dual_office").try_cast("boolean")})
        if "members" in side:
            side["members"] = side["members"].withColumns({"term": F.col("term").try_cast("long"), "seniority": F.col("seniority").try_cast("double")})
        s, d = build.build(spark, spark.read.parquet(options.speeches), options.output, dry_run=options.dry_run, **side)
        print(f"{s.count()} speeches, {d.count()} dyads{', not written' if options.dry_run else ''}")
    elif options.command == "enrich":
        out = build.with_conferences(spark.read.parquet(options.speeches), datasets.read_csv(spark, options.details))
        datasets.write_table(out, options.output)
    elif options.command == "verify":
        if not datasets.exists(spark, options.new):
            return 1
        found = build.verify(spark.read.parquet(options.old), spark.read.parquet(options.new))
        found.show(1000, truncate=False)
        return int(found.filter("item = 'lost meetings' AND n > 0").count() > 0)
    elif options.command == "info":
        datasets.summary(datasets.load(spark, "speeches", **at), "term", "hearing_type").show(1000, truncate=False)
    elif options.command == "export":
        df = datasets.load(spark, options.dataset, term=options.term, hearing_type=options.hearing_type, **at)
        datasets.export(df, options.output, options.format)
        print(f"{df.count()} rows")
    else:
        checks = validation.validate(*tables(spark, options, at))
        return datasets.write_report(checks, options.report, at)
    return 0


if __name__ == "__main__":
    sys.exit(main())
