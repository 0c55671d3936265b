"""What a run moves and writes as its tables grow."""

import gzip
import os
import re

import pytest

from strata import session
from strata.plans import analytics, quality
from strata.plans import warehouse as W
from strata.schemas import BRONZE
from strata.sources.csv import read_csv
from strata.sources.store import LayerStore

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def own_partitions(spark):
    yield
    for k in (session._OURS, session._INITIAL):
        spark.conf.unset(k)


def test_customer_keys_need_no_other_tables(spark, tmpdir_path):
    w = W.Warehouse(spark, SF, store=LayerStore(spark, root=tmpdir_path))
    assert quality.check_customer_key_unique(w).count() == 0
    loaded = {t for layer, t in w.store._tables if layer in ("bronze_staged", "silver")}
    assert loaded == {"crm_cust_info", "erp_cust_az12", "erp_loc_a101"}
    assert w.load_silver().filter("status = 'loaded'").count() == 7     # the others follow


def test_partitions_follow_the_rows(spark, tmpdir_path, monkeypatch, own_partitions):
    few = W.Warehouse(spark, SF, store=LayerStore(spark, root=f"{tmpdir_path}/few"))
    want = few.rfm_raw().collect(), few.kpi_summary().collect(), few.product_performance().collect()
    assert few.store._tables["gold", "fact_sales"]["buckets"][0] == session.partitions(spark) == 8
    monkeypatch.setattr(W, "PART_ROWS", 300)
    many = W.Warehouse(spark, SF, store=LayerStore(spark, root=f"{tmpdir_path}/many"))
    parts = session.partitions(spark)
    rows = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    assert parts == -(-rows // 300) > 8
    got = many.rfm_raw().collect(), many.kpi_summary().collect(), many.product_performance().collect()
    assert [sorted(map(str, g)) for g in got] == [sorted(map(str, x)) for x in want]
    assert many.store._tables["gold", "fact_sales"]["buckets"][0] == parts


def test_a_session_keeps_its_own_partitions(spark, own_partitions):
    spark.conf.set(session._INITIAL, "16")
    session.enough_partitions(spark, 10_000, 10)
    assert spark.conf.get(session._INITIAL) == "16" and session.partitions(spark) == 16


def test_shared_orders_travel_without_the_names(spark, tmpdir_path):
    """Products of one name: their orders are sent with one key, not with the
    names, and the order counts are those of the names."""
    w = W.Warehouse(spark, SF, store=LayerStore(spark, root=tmpdir_path))
    df = analytics.product_sales(w.sales_by_product(), w.products_keyed())
    text = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(group_key#\d+L, _order", text)
    assert not re.search(r"hashpartitioning\(product_name", text)


def test_compressed_extracts_have_headers_of_their_own(spark, tmpdir_path):
    os.makedirs(f"{tmpdir_path}/x.csv")
    for name, text in (("a.csv.gz", "cid,bdate,gen\nA,2000-01-01,F\n"), ("b.csv.gz", "gen,cid,bdate\nM,B,2001-01-01\n")):
        with gzip.open(f"{tmpdir_path}/x.csv/{name}", "wt") as fh:
            fh.write(text)
    got = read_csv(spark, f"{tmpdir_path}/x.csv", BRONZE["erp_cust_az12"])
    assert sorted((r.cid, str(r.bdate), r.gen) for r in got.collect()) == [
        ("A", "2000-01-01", "F"), ("B", "2001-01-01", "M")]
