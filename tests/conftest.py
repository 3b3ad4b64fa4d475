import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, float):
        return None if value != value else float(f"{value:.9g}")
    return value


def rows_of(df) -> list[tuple]:
    names = sorted(df.columns)
    return sorted((tuple(plain(r[n]) for n in names) for r in df.collect()), key=repr)


def oracle_rows(sql: str) -> list[tuple]:
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    table = con.sql(sql).to_arrow_table()
    names = sorted(table.column_names)
    return sorted((tuple(plain(v) for v in r) for r in zip(*(table.column(n).to_pylist() for n in names), strict=True)), key=repr)
