import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark():
    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def same(df, relation) -> None:
    """Equal rows, whatever their order; doubles to nine digits."""
    cols = sorted(df.columns)
    names = [d[0] for d in relation.description]
    assert sorted(names) == cols
    put = lambda v: round(v, 9) if isinstance(v, float) else v
    ours = sorted(repr(tuple(put(r[c]) for c in cols)) for r in df.collect())
    theirs = sorted(repr(tuple(put(r[names.index(c)]) for c in cols)) for r in relation.fetchall())
    assert ours == theirs
