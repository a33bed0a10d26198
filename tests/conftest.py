import os
import sys
from pathlib import Path

os.environ.setdefault("OMP_NUM_THREADS", "1")
sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb
import pytest
from pyspark.sql import SparkSession

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for path in Path(SMALL).glob("*.parquet"):
        files = f"{path}/*" if path.is_dir() else str(path)
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{files}')")
    return connection


@pytest.fixture(scope="session")
def same(spark, duck):
    """Whether a query and its SQL give the same rows, whatever their order."""

    def check(query, sql):
        got, want = query(spark, SMALL).toPandas(), duck.sql(sql).df()
        columns = sorted(got.columns)
        assert columns == sorted(want.columns)
        text = lambda d: d[columns].astype(str).sort_values(columns).reset_index(drop=True)
        assert len(got) == len(want)
        assert text(got).equals(text(want))

    return check
