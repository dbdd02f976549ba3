"""The physical plans stay the ones that hold at scale."""

import pytest

from tidewater.plans import PLANS

FAST_JOINS = ["join_contains", "fuzzy_join_distance", "fuzzy_join_ratio", "join_chain", "economy_by_nation", "pr_curve"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", FAST_JOINS)
def test_no_product(spark, data, key):
    text = plan_of(PLANS[key](spark, data))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("key", ["running_score", "line_runs", "split_exact", "sample_stride", "zip_rows"])
def test_no_window_over_everything(spark, data, key):
    text = plan_of(PLANS[key](spark, data))
    assert "Exchange SinglePartition" not in text


def test_scan_reads_only_what_it_needs(spark, data):
    text = PLANS["economy_by_nation"](spark, data)._jdf.queryExecution().toString()
    scan = [line for line in text.splitlines() if "FileScan" in line and "orders" in line][0]
    assert "o_orderpriority" not in scan and "GreaterThanOrEqual(o_orderdate" in scan


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


class _Context:
    master, applicationId = "spark://host:7077", "app-1"


class _Session:
    """Just enough of a session to ask for its shared folder."""

    sparkContext = _Context()

    def __init__(self, named):
        self.conf = {"spark.checkpoint.dir": named} if named else {}


def test_shared_folder_is_read_from_the_session(spark):
    from tidewater.session import shared_dir

    assert shared_dir(_Session("hdfs://x/y/")) == "hdfs://x/y"
    with pytest.raises(RuntimeError):
        shared_dir(_Session(None))
    assert shared_dir(spark) == shared_dir(spark)
