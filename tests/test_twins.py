"""Every query with a SQL twin gives the twin's rows; the others give rows."""

import math

import duckdb
import pytest

from tidewater.plans import PLANS, TWINS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SLOW = {"experiment_summary", "gap_stat", "cluster_indices"}


@pytest.fixture(scope="module")
def sql(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)


@pytest.mark.parametrize("key", sorted(TWINS))
def test_twin(spark, data, sql, key):
    cols, got = spark_rows(PLANS[key](spark, data))
    found = sql.execute(TWINS[key])
    names = [c[0] for c in found.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = sorted((tuple(plain(r[i]) for i in at) for r in found.fetchall()), key=repr)
    assert [tuple(map(_num, r)) for r in got] == [tuple(map(_num, r)) for r in want]


def _num(v):
    return float(v) if isinstance(v, int) or (hasattr(v, "as_integer_ratio") and not isinstance(v, float)) else v


@pytest.mark.parametrize("key", sorted(set(PLANS) - set(TWINS) - SLOW))
def test_rows_only(spark, data, key):
    assert PLANS[key](spark, data).limit(1).count() == 1
