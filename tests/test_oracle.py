"""Every query of the library proper against its SQL on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest

from expatlas.plans import registry

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def norm(v):
    if isinstance(v, float):
        return "nan" if v != v else float(f"{v:.8g}")
    if isinstance(v, list | tuple):
        return tuple(norm(x) for x in v)
    return float(f"{float(v):.8g}") if type(v).__name__ == "Decimal" else v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_same_as_sql(spark, con, name):
    df = registry.QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    found = con.execute(registry.ORACLE_SQL[name])
    names = [x[0] for x in found.description]
    assert cols == sorted(names)
    want = Counter(tuple(norm(r[names.index(c)]) for c in cols) for r in found.fetchall())
    assert Counter(tuple(norm(r[c]) for c in cols) for r in df.collect()) == want


def test_empty_tables(spark):
    from expatlas.operators import intervals, normalize, relational

    nothing = spark.createDataFrame([], "chrom string, start long, stop long, name string")
    assert intervals.islands(nothing, ["chrom"]).count() == 0
    assert intervals.segment(nothing, ["chrom"], "name").count() == 0
    assert normalize.cpm(spark.createDataFrame([], "group_id long, feature_id long, count long")).count() == 0
    assert relational.sample_n(nothing, 3, "name").count() == 0
