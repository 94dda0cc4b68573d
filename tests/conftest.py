import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "3g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def compare(spark):
    """Rows of a query and of its SQL over small tables (0, 1: the smallest, ten times as many rows), as sorted lists of texts.

    Numbers are compared as they come: a query that gives fractions rounds them itself.
    """
    import glob

    import duckdb

    cons = []
    for folder in DATA:
        cons.append(duckdb.connect())
        for path in glob.glob(f"{folder}/*.parquet"):
            cons[-1].execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")

    def run(query, sql, size=0):
        con = cons[size]

        def text(x):
            if x is None or x != x:
                return "~"
            return repr(float(x) + 0.0) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)

        got = query(spark, DATA[size])
        cols = sorted(got.columns)
        rel = con.sql(sql)
        assert sorted(rel.columns) == cols
        left = sorted(tuple(text(r[c]) for c in cols) for r in got.collect())
        right = sorted(tuple(text(x) for x in r) for r in rel.select(*[f'"{c}"' for c in cols]).fetchall())
        return left, right

    return run
