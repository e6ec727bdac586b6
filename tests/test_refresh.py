"""Whole-lake refresh from landing CSV to Gold, SQL views, and the job CLI."""

import datetime as dt
import os
import threading
import time
from functools import partial

import pytest

from stratum.__main__ import main as cli
from stratum.plans import refresh
from stratum.sources import retail, storage
from stratum.sources.tables import read_snapshot
from stratum.streaming import silver

from scans import settings
from sf_dirs import SF_SMALL


def test_full_refresh_and_views(spark, lake):
    refresh.stage_landing(retail.landing_frames(spark, SF_SMALL), lake, parallel=3)
    out = refresh.full_refresh(spark, lake, ingest_ts=dt.datetime(2024, 1, 1),
                               calendar_start="2016-01-01", calendar_end="2016-03-01", parallel=3)
    assert set(out) == {"dim_customers", "dim_products", "dim_sellers", "dim_dates", "fact_sales",
                        "fact_seller_performance", "fact_product_performance", "fact_payment_summary"}
    orders = spark.read.parquet(SF_SMALL + "/orders.parquet").count()
    assert read_snapshot(spark, out["fact_sales"]).count() == orders
    assert read_snapshot(spark, out["dim_dates"]).count() == 61
    assert read_snapshot(spark, out["dim_customers"]).columns == [
        "customer_id", "customer_unique_id", "customer_city", "customer_state",
        "customer_zip_code_prefix"]
    views = refresh.register_views(spark, lake)
    assert "silver_orders" in views and "gold_fact_sales" in views
    n = spark.sql("SELECT count(*) AS n FROM silver_orders").first().n
    assert n == orders
    assert "_ingest_ts" in spark.table("bronze_order_items").columns

    # a second refresh with no new landing files changes nothing
    before = sorted(tuple(r) for r in read_snapshot(spark, out["fact_sales"]).collect())
    refresh.full_refresh(spark, lake, calendar_start="2016-01-01", calendar_end="2016-03-01")
    after = sorted(tuple(r) for r in read_snapshot(spark, out["fact_sales"]).collect())
    assert before == after

    # the job CLI's Gold step over the same lake
    cli(["--lake", lake.root, "gold", "--calendar-start", "2016-01-01",
         "--calendar-end", "2016-01-10", "--parallel", "2"])
    assert read_snapshot(spark, out["dim_dates"]).count() == 10
    assert read_snapshot(spark, out["fact_sales"]).count() == orders


def test_cli_steps(spark, lake):
    refresh.stage_landing({"sellers": retail.landing_frames(spark, SF_SMALL)["sellers"]}, lake)
    cli(["--lake", lake.root, "bronze", "--dataset", "sellers"])
    cli(["--lake", lake.root, "silver", "--dataset", "sellers"])
    got = silver.read_silver(spark, "sellers", lake).count()
    assert got == spark.read.parquet(SF_SMALL + "/supplier.parquet").count()


def test_catalog_lake(spark, lake):
    from stratum.session import Lake
    cat = Lake(lake.root + "-cat", databases="t_catlake_")
    try:
        refresh.stage_landing(retail.landing_frames(spark, SF_SMALL), cat, parallel=3)
        out = refresh.full_refresh(spark, cat, calendar_start="2016-01-01",
                                   calendar_end="2016-01-31", parallel=3)
        assert out["fact_sales"] == "t_catlake_gold.fact_sales"
        orders = spark.read.parquet(SF_SMALL + "/orders.parquet").count()
        assert spark.table("t_catlake_gold.fact_sales").count() == orders
        assert spark.table("t_catlake_silver.orders").count() == orders
        assert spark.table("t_catlake_gold.dim_dates").count() == 31
        location = spark.sql("DESCRIBE DATABASE t_catlake_silver").collect()
        assert any(cat.root in str(r) for r in location)
        # a second drop for one dataset upserts into the catalog table
        frames = retail.landing_frames(spark, SF_SMALL)
        refresh.stage_landing({"orders": frames["orders"].limit(5)}, cat)
        refresh.full_refresh(spark, cat, calendar_start="2016-01-01", calendar_end="2016-01-31")
        assert silver.read_silver(spark, "orders", cat).count() == orders
    finally:
        for layer in ("bronze", "silver", "gold"):
            spark.sql(f"DROP DATABASE IF EXISTS t_catlake_{layer} CASCADE")


def test_cli_catalog_mode(spark, lake):
    refresh.stage_landing({"products": retail.landing_frames(spark, SF_SMALL)["products"]}, lake)
    try:
        cli(["--lake", lake.root, "--databases", "t_cli_", "bronze", "--dataset", "products"])
        cli(["--lake", lake.root, "--databases", "t_cli_", "silver", "--dataset", "products"])
        assert spark.table("t_cli_silver.products").count() == \
            spark.read.parquet(SF_SMALL + "/part.parquet").count()
    finally:
        for layer in ("bronze", "silver", "gold"):
            spark.sql(f"DROP DATABASE IF EXISTS t_cli_{layer} CASCADE")


def test_rebuild_compact_and_single_gold_table(spark, lake):
    frames = retail.landing_frames(spark, SF_SMALL)
    refresh.stage_landing({n: frames[n] for n in ("customers", "sellers")}, lake)
    base = ["--lake", lake.root]
    cli([*base, "bronze", "--dataset", "customers", "--dataset", "sellers", "--max-files-per-trigger", "1"])
    cli([*base, "silver", "--dataset", "customers", "--dataset", "sellers", "--parallel", "2"])
    before = sorted(map(tuple, refresh.business_columns(silver.read_silver(spark, "customers", lake)).collect()))
    cli([*base, "rebuild", "--dataset", "customers"])
    cli([*base, "compact", "--dataset", "customers"])
    assert sorted(map(tuple, refresh.business_columns(silver.read_silver(spark, "customers", lake)).collect())) == before
    cli([*base, "gold", "--table", "dim_customers"])       # the other Silver tables do not exist
    assert refresh.read_gold(spark, lake, "dim_customers").count() == len(before)
    cli([*base, "gold", "--table", "dim_dates"])
    days = refresh.read_gold(spark, lake, "dim_dates")
    assert str(days.agg({"date_id": "min"}).first()[0]) == "2016-01-01"
    cli([*base, "gold", "--table", "dim_dates", "--calendar-end", "2016-01-31"])
    assert refresh.read_gold(spark, lake, "dim_dates").count() == 31
    with pytest.raises(ValueError, match="fact_nothing"):
        cli([*base, "gold", "--table", "fact_nothing"])
    with pytest.raises(SystemExit):                        # a step refuses what it would not honour
        cli([*base, "silver", "--calendar-start", "2016-01-01"])


def test_own_specs_and_schema_names(spark, lake, tmp_path):
    for layer, text in (
            ("bronze", "file: {format: csv, header: true}\ntarget: {schema: raw, table: readings_in}\n"),
            ("silver", "source: {schema: raw, table: readings_in}\ntarget: {schema: clean, table: readings}\n"
                       "schema:\n  - {column: id, type: int, nullable: false}\n"
                       "  - {column: v, type: double, nullable: true}\nkeys: {primary_keys: id}\n"),
            ("gold", "source: {schema: clean, table: readings}\ntarget: {schema: mart, table: ids}\ncolumns: [id]\n")):
        (tmp_path / layer).mkdir()
        (tmp_path / layer / ("ids.yaml" if layer == "gold" else "readings.yaml")).write_text(text)
    spark.createDataFrame([("1", "2.5"), ("2", "3")], "id string, v string").write.option("header", True).csv(lake.landing("readings"))
    base = ["--lake", lake.root, "--conf", str(tmp_path)]
    for step in ("bronze", "silver"):
        cli([*base, step])
    cli([*base, "gold", "--table", "ids"])
    assert sorted(r.id for r in refresh.read_gold(spark, lake, "ids", tmp_path).collect()) == [1, 2]
    assert sorted(n for n in os.listdir(lake.root) if not n.startswith("_")) == ["clean", "landing", "mart", "raw"]
    names = refresh.register_views(spark, lake, tmp_path)
    assert names == ["raw_readings_in", "clean_readings", "mart_ids"]
    assert spark.sql("SELECT sum(v) AS s FROM clean_readings").first().s == 5.5


def test_scratch_folder_only_on_a_local_master():
    from types import SimpleNamespace

    from stratum.session import ensure_checkpoint_dir
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda k, d: d),
        sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(cluster)


# ------------------------------------------------------------ disk of a refresh


def _shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(k).getName() for k in range(files.size()))
    return {n for n in names if n.startswith("shuffle_")}


def _written(lake, *parts):
    return [f for _, _, files in os.walk(os.path.join(lake.root.removeprefix("file://"), *parts))
            for f in files if f.startswith("part-")]


def test_a_refresh_leaves_no_shuffle_files_and_compresses_its_tables(spark, lake):
    spark._jvm.System.gc()                                 # files of other tests are not removed meanwhile
    time.sleep(1)
    before = _shuffle_files(spark)
    refresh.stage_landing(retail.landing_frames(spark, SF_SMALL), lake, parallel=2)
    refresh.full_refresh(spark, lake, parallel=2)
    until = time.monotonic() + 20                          # they are removed in the background
    while (left := _shuffle_files(spark) - before) and time.monotonic() < until:
        time.sleep(0.2)
    assert not left
    assert all(f.endswith(".csv.gz") for f in _written(lake, "landing") + _written(lake, "_archive"))
    for layer in ("bronze", "silver", "gold"):
        files = [f for f in _written(lake, layer) if f.endswith(".parquet")]
        assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert not [n for n in os.listdir(lake.root) if "unsorted" in n]
    for k in refresh.THRIFTY_CONF:
        assert spark.conf.get(k, None) is None             # the session is as it was


def test_settings_of_the_session_are_kept(spark):
    key = "spark.sql.parquet.compression.codec"
    with settings(spark, **{key: "gzip"}), refresh.thrifty(spark):
        assert spark.conf.get(key) == "gzip"
    with pytest.raises(RuntimeError), refresh.thrifty(spark):
        assert spark.conf.get(key) == "zstd"
        raise RuntimeError("lost")
    assert spark.conf.get(key, None) is None


def test_facts_are_joined_and_sorted_in_two_statements(spark, lake, monkeypatch):
    """What the joins have shuffled is gone when the sort shuffles."""
    refresh.stage_landing(retail.landing_frames(spark, SF_SMALL), lake, parallel=3)
    refresh.full_refresh(spark, lake, parallel=3)
    plans, write = {}, storage.write_snapshot

    def kept(df, path, *more):
        plans[path.rpartition("/")[2]] = df._jdf.queryExecution().optimizedPlan().toString()
        return write(df, path, *more)

    monkeypatch.setattr(storage, "write_snapshot", kept)
    sorted_alone = ["fact_sales", "fact_product_performance", "fact_payment_summary"]
    refresh.build_gold(spark, lake, names=sorted_alone)
    assert sorted(plans) == sorted(sorted_alone)
    assert all("Sort [" in p and "Join" not in p for p in plans.values())

    def dies(df, path, *more):
        raise RuntimeError("lost before the sort")

    before = sorted(map(tuple, refresh.read_gold(spark, lake, "fact_sales").collect()))
    monkeypatch.setattr(storage, "write_snapshot", dies)
    with pytest.raises(RuntimeError, match="before the sort"):
        refresh.build_gold(spark, lake, names=["fact_sales"])
    assert not [n for n in os.listdir(lake.root) if "unsorted" in n]
    assert sorted(map(tuple, refresh.read_gold(spark, lake, "fact_sales").collect())) == before


def test_a_step_that_fills_the_cluster_runs_alone():
    lock, at_work, seen = threading.Lock(), set(), {}

    def step(name):
        with lock:
            at_work.add(name)
        time.sleep(0.3)
        with lock:
            seen[name] = set(at_work)
            at_work.remove(name)
        return name

    names = ["small", "large", "tiny", "huge"]
    assert refresh.run_all([partial(step, n) for n in names], 4, [40, 101, 60, 500], 100) == names
    assert seen["large"] == {"large"} and seen["huge"] == {"huge"}
    assert seen["small"] | seen["tiny"] == {"small", "tiny"}
    seen.clear()
    refresh.run_all([partial(step, n) for n in names], 4)
    assert any(len(s) == 4 for s in seen.values())         # without sizes, all at once
    with pytest.raises(ZeroDivisionError):                 # a failed step makes room
        refresh.run_all([lambda: 1 / 0, partial(step, "next")], 2, [500, 500], 100)
    assert "next" in seen


def test_no_gold_table_is_written_beside_the_shuffle_files_of_another(spark, lake, monkeypatch):
    """Every Gold table of a refresh, read back through the views."""
    refresh.stage_landing(retail.landing_frames(spark, SF_SMALL), lake, parallel=3)
    spark._jvm.System.gc()
    time.sleep(1)
    before, write, found = _shuffle_files(spark), storage.write_snapshot, {}

    def kept(df, path, *more):
        until = time.monotonic() + 20                      # removed in the background
        while (left := _shuffle_files(spark) - before) and time.monotonic() < until:
            time.sleep(0.2)
        if "/gold/" in path:
            found[path.rpartition("/")[2]] = len(left)
        return write(df, path, *more)

    monkeypatch.setattr(storage, "write_snapshot", kept)
    refresh.full_refresh(spark, lake)
    assert found == {n: 0 for n in refresh.gold_tables()}
    assert {f"gold_{n}" for n in refresh.gold_tables()} <= set(refresh.register_views(spark, lake))
    rows = {n: spark.table(f"gold_{n}").count() for n in refresh.gold_tables()}
    orders, items = (spark.read.parquet(f"{SF_SMALL}/{t}.parquet") for t in ("orders", "lineitem"))
    assert rows["fact_sales"] == orders.count()
    assert rows["fact_payment_summary"] == items.select("l_orderkey").distinct().count()
    assert rows["fact_product_performance"] == items.select("l_orderkey", "l_linenumber").distinct().count()
