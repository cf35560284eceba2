import datetime
import glob

import pytest
from pyspark.sql import functions as F

from fixtures import views


@pytest.fixture
def folder(spark, tmp_path):
    """200 lines of 40 orders and their customers, each table in one file."""
    lines = [(k, k * n % 61 + 1, n % 7 + 1, n, float(n), 10.0 * k + n, datetime.datetime(1995, 1, n)) for k in range(1, 41) for n in range(1, 6)]
    orders = [(k, k % 9, "FOP"[k % 3], 100.0 * k, datetime.datetime(1995, 1, 1), "1-URGENT") for k in range(1, 41)]
    customers = [(c, c, "BUILDING") for c in range(9)]
    for name, rows, schema in (
        ("lineitem", lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp"),
        ("orders", orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        ("customer", customers, "c_custkey bigint, c_nationkey bigint, c_mktsegment string"),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("name", ["holdings", "positions"])
def test_wide_rows_are_written_without_being_dealt_out(spark, folder, monkeypatch, name):
    plans, settled = [], views.settled

    def seen(rows, *args):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return settled(rows, *args)

    monkeypatch.setattr(views, "settled", seen)
    getattr(views, name)(spark, folder).count()
    assert len(plans) == 1 and "RoundRobin" not in plans[0] and "SortMergeJoin" in plans[0]


def test_holdings_of_a_fund_stand_together(spark, folder):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one file
    try:
        views.holdings(spark, folder)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    placed = views.holdings(spark, folder).select("portfolio_id", F.input_file_name().alias("file")).distinct().collect()
    assert len({r.portfolio_id for r in placed}) == len(placed) > 5 and len({r.file for r in placed}) > 1


def test_text_parts_are_compressed_and_read_back_whole(spark, folder):
    path = views.text_file(spark, folder, "tpt_0.csv", lambda s, d: views.tpt_text(s, d, 0))
    assert glob.glob(f"{path}/*") and all(p.endswith(".csv.gz") for p in glob.glob(f"{path}/*.csv*"))
    want = views.holdings(spark, folder).filter("holding_ord.l_partkey % 3 <> 0").count()
    assert spark.read.csv(path, header=True).count() == want
