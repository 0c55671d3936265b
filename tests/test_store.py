"""Run folders: counts taken while writing, buckets, the run log, publication."""

import os
import threading

import pytest
from pyspark.sql import functions as F

from strata.schemas import TABLES
from strata.sources.bronze import BATCH, LoadFailed, audit
from strata.sources.csv import SOURCE_FILES
from strata.sources.publication import Publication, PublishConflict
from strata.sources.store import LayerStore, create_text, read_text, write_text

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = spark.conf.get(keys[0])
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    spark.conf.set(keys[0], old)
    spark.conf.unset(keys[1])


# ---------------------------------------------------------------- small files
def test_small_files_are_replaced_or_created_in_one_step(spark, tmpdir_path):
    path = f"{tmpdir_path}/a/f.json"
    write_text(spark, path, "one")
    assert create_text(spark, path, "two") is False and read_text(spark, path) == "one"
    assert create_text(spark, f"{tmpdir_path}/a/g.json", "new") is True
    stop, seen = threading.Event(), set()

    def reader():
        while not stop.is_set():
            seen.add(read_text(spark, path))

    t = threading.Thread(target=reader)
    t.start()
    for k in range(60):
        write_text(spark, path, "x" * (k % 2) + "one")
    stop.set()
    t.join()
    assert seen <= {"one", "xone"} and None not in seen
    assert sorted(n for n in os.listdir(f"{tmpdir_path}/a") if n.endswith(".json")) == ["f.json", "g.json"]
    assert not [n for n in os.listdir(f"{tmpdir_path}/a") if n.endswith(".tmp")]


def test_only_one_writer_creates(spark, tmpdir_path):
    won = []
    go = threading.Barrier(8)

    def one(k):
        go.wait()
        won.append(create_text(spark, f"{tmpdir_path}/v1.json", f"writer {k}"))

    threads = [threading.Thread(target=one, args=(k,)) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(won) == [False] * 7 + [True]


# ---------------------------------------------------------------- counts while writing
def test_counts_are_taken_while_writing(spark, tmpdir_path):
    store = LayerStore(spark, root=tmpdir_path)
    rows = spark.range(1000).withColumn("g", F.col("id") % 7)
    want = {"rows": F.count(F.lit(1)), "odd": F.count_if(F.col("id") % 2 == 1)}
    store.write(rows, "silver", "plain", observe=want)
    store.write(rows, "silver", "dealt", observe=want, buckets=("g",))
    store.write(rows.filter("id < 0"), "silver", "none", observe=want)
    for t, n in (("plain", 1000), ("dealt", 1000), ("none", 0)):
        assert store.metrics("silver", t) == {"rows": n, "odd": n // 2}
    again = LayerStore(spark, root=tmpdir_path, run_id=store.run_id)
    assert again.metrics("silver", "plain") == {"rows": 1000, "odd": 500}


def test_row_level_checks_scan_nothing(spark):
    """Only what needs other rows of a table reads it."""
    from strata.plans import quality
    from strata.plans.warehouse import warehouse
    w = warehouse(spark, SF)
    w.gold("fact_sales")
    for fn in (quality.report_bronze_counts, quality.report_bronze_null_keys, quality.report_whitespace,
               quality.bronze_load_audit, quality.silver_load_audit):
        assert "FileScan" not in plan(fn(w))
    scans = [line for line in plan(quality.data_quality_report(w)).splitlines() if "FileScan" in line]
    assert not any(t in line for line in scans for t in ("prd_cost", "sls_sales", "bdate", "prd_nm", "sales_amount"))
    # the counts are those of a scan
    assert w.counted("silver", "crm_sales_details")["rows"] == w.silver("crm_sales_details").count()
    for (layer, table) in quality.ROW_CHECKS:
        df = w.bronze(table) if layer == "bronze" else w.silver(table) if layer == "silver" else w.gold(table)
        for name, c in quality.row_checks(layer, table, w.as_of).items():
            assert w.counted(layer, table)[name] == df.filter(c).count(), name


# ---------------------------------------------------------------- buckets
def test_bucketed_tables_join_without_a_shuffle(spark, tmpdir_path, no_broadcast):
    store = LayerStore(spark, root=tmpdir_path)
    fact = spark.range(4000).select((F.col("id") % 97).alias("k"), (F.col("id") % 2).cast("int").alias("s"), "id")
    dim = spark.range(97).select(F.col("id").alias("k"), F.explode(F.array(F.lit(0), F.lit(1))).alias("s"))
    store.write(fact, "gold", "fact", buckets=("k", "s"), hidden=("s",))
    store.write(dim.withColumn("name", F.col("k").cast("string")), "gold", "dim", buckets=("k", "s"))
    assert store.columns("gold", "fact") == ["k", "id"]
    for st in (store, LayerStore(spark, root=tmpdir_path, run_id=store.run_id)):
        j = st.read("gold", "fact").groupBy("k", "s").agg(F.count("*").alias("n")).join(
            st.read("gold", "dim"), ["k", "s"])
        assert "Exchange" not in plan(j)
        assert j.agg(F.sum("n")).first()[0] == 4000
    # another session's catalog does not know the table: it is registered again from the manifest
    db = f"strata_{store.run_id}"
    spark.sql(f"DROP DATABASE {db} CASCADE")
    later = LayerStore(spark, root=tmpdir_path, run_id=store.run_id)
    assert later.read("gold", "fact").count() == 4000
    assert "Exchange" not in plan(later.read("gold", "fact").groupBy("k", "s").count())


# ---------------------------------------------------------------- run log
def _land(spark, folder):
    from strata.sources.bronze import land_sources
    from strata.sources.fixtures import source_table
    land_sources(spark, {t: source_table(spark, SF, t) for t in TABLES}, folder, "")


def test_failed_table_is_logged_and_resumed_alone(spark, tmpdir_path):
    from strata.plans.warehouse import Warehouse
    landing, root = f"{tmpdir_path}/in", f"{tmpdir_path}/ckpt"
    _land(spark, landing)
    broken = os.path.join(landing, SOURCE_FILES["erp_loc_a101"], "part-extra.csv")
    with open(broken, "w") as fh:
        fh.write("cid,cntry,what\nA,B,C\n")
    w = Warehouse.from_csv(spark, landing, store=LayerStore(spark, root=root))
    with pytest.raises(LoadFailed, match="erp_loc_a101.*unknown columns"):
        w.load_bronze()
    rows = {r.table_name: r for r in w.load_audit("bronze").collect()}
    assert [rows[t].status for t in TABLES] == ["loaded"] * 4 + ["failed", "loaded"]
    assert "unknown columns" in rows["erp_loc_a101"].error and rows["erp_loc_a101"].row_count == 0
    assert rows[BATCH].status == "failed"
    assert rows[BATCH].row_count == sum(rows[t].row_count for t in TABLES) > 0
    with pytest.raises(LoadFailed):
        w.load_silver()                       # nothing is built on half a load

    os.remove(broken)
    again = Warehouse.from_csv(spark, landing, store=LayerStore(spark, root=root, run_id=w.store.run_id))
    before = len(again.store.events())
    audit_rows = {r.table_name: r for r in again.load_bronze().collect()}
    assert all(audit_rows[t].status == "loaded" and audit_rows[t].error is None for t in [*TABLES, BATCH]
               if t != BATCH) and audit_rows[BATCH].status == "loaded"
    new = [(e["table"], e["status"]) for e in again.store.events()[before:]]
    assert new == [("erp_loc_a101", "loaded"), (BATCH, "loaded")]
    assert [e["status"] for e in again.store.events() if e["table"] == "erp_loc_a101"] == ["failed", "failed", "loaded"]
    assert again.load_silver().filter("status = 'loaded'").count() == 7

    with open(os.path.join(landing, SOURCE_FILES["erp_cust_az12"], "part-late.csv"), "w") as fh:
        fh.write("cid,bdate,gen\nX,2000-01-01,F\n")
    with pytest.raises(ValueError, match="another erp_cust_az12"):
        Warehouse.from_csv(spark, landing, store=LayerStore(spark, root=root, run_id=w.store.run_id))


def test_missing_extract_fails_its_table_only(spark, tmpdir_path):
    from strata.plans.warehouse import Warehouse
    import shutil
    landing = f"{tmpdir_path}/in"
    _land(spark, landing)
    shutil.move(os.path.join(landing, SOURCE_FILES["crm_prd_info"]), f"{tmpdir_path}/elsewhere.csv")
    w = Warehouse.from_csv(spark, landing, store=LayerStore(spark, root=f"{tmpdir_path}/ckpt"))
    with pytest.raises(LoadFailed, match="crm_prd_info"):
        w.load_bronze()
    got = {r.table_name: r.status for r in audit(w.store, "bronze").collect()}
    assert [t for t in TABLES if got[t] == "failed"] == ["crm_prd_info"]


# ---------------------------------------------------------------- publication
def _publish(spark, root, n, expected):
    """A run with two tables of n rows, published."""
    store = LayerStore(spark, root=root)
    tables = {}
    for t in ("a", "b"):
        store.write(spark.range(n).select(F.col("id"), F.lit(n).alias("n")), "gold", t)
        tables[f"gold.{t}"] = {"path": store.path("gold", t), "columns": ["id", "n"], "where": None,
                               "schema": store.schema("gold", t).jsonValue()}
    store.publish()
    return Publication(spark, root).publish({"run_id": store.run_id, "tables": tables}, expected)


def test_reader_never_sees_a_missing_or_mixed_version(spark, tmpdir_path):
    assert Publication(spark, tmpdir_path).open() is None
    _publish(spark, tmpdir_path, 10, 0)
    stop, seen, wrong = threading.Event(), [], []

    def reader():
        while not stop.is_set():
            try:
                s = Publication(spark, tmpdir_path).open()
                a = s.table("gold.a").agg(F.count("*"), F.max("n")).first()
                b = s.table("gold.b").agg(F.count("*"), F.max("n")).first()
                if not (a == b and a[0] == a[1]):
                    wrong.append((s.version, a, b))
                seen.append(s.version)
            except Exception as e:
                wrong.append(repr(e))

    t = threading.Thread(target=reader)
    t.start()
    for k in (1, 2, 3):
        _publish(spark, tmpdir_path, 10 + k, k)
    while seen[-1:] != [4] and not wrong:
        pass
    stop.set()
    t.join()
    assert not wrong and seen == sorted(seen) and seen[-1] == 4


def test_late_publisher_gets_an_error(spark, tmpdir_path):
    _publish(spark, tmpdir_path, 1, 0)
    _publish(spark, tmpdir_path, 2, 1)
    with pytest.raises(PublishConflict):
        _publish(spark, tmpdir_path, 3, 1)
    p = Publication(spark, tmpdir_path)
    assert p.versions() == [1, 2] and p.open().table("gold.a").count() == 2
    assert p.open(1).table("gold.a").count() == 1           # a pinned reader keeps its version
    with pytest.raises(KeyError):
        p.open(9)
    with pytest.raises(KeyError, match="gold.a"):
        p.open().table("gold.c")


def test_warehouse_publishes_all_layers(spark, tmpdir_path):
    from strata.plans.warehouse import Warehouse
    w = Warehouse(spark, SF, store=LayerStore(spark, root=tmpdir_path))
    assert w.publish() == 1
    s = Publication(spark, tmpdir_path).open()
    assert len(s.names()) == 15 and s.run_id == w.store.run_id
    assert s.table("gold.fact_sales").columns == w.gold("fact_sales").columns
    assert s.table("gold.fact_sales").count() == w.gold("fact_sales").count()
    assert s.table("bronze.crm_cust_info").count() == w.bronze("crm_cust_info").count()
    with pytest.raises(PublishConflict):
        w.publish(expected=0)
    other = Warehouse(spark, SF, store=LayerStore(spark, root=tmpdir_path), as_of="2026-02-01")
    assert other.publish(expected=1) == 2
    assert w.store.retire_older_runs(keep=1, spare=(other.store.run_id,)) == []
    assert Publication(spark, tmpdir_path).open().table("silver.crm_prd_info").count() > 0
