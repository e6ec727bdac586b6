"""The keyed table: contract, replays, crashes at every step, schema changes,
compaction and cost."""

import os

import pytest
from pyspark.sql import functions as F

from stratum.operators import upsert as upsert_module
from stratum.operators.upsert import KeyedTable, upsert
from stratum.sources import storage

from scans import scanned

COLS = "k string, v int, ver int"


@pytest.fixture()
def table(spark, lake):
    return KeyedTable(spark, f"{lake.root}/silver/t")


def frame(spark, rows, cols=COLS):
    return spark.createDataFrame(rows, cols)


def rows(table):
    return sorted(map(tuple, table.read().collect()))


def data_bytes(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_insert_replace_and_replay(spark, table):
    assert not table.exists()
    table.upsert(frame(spark, [("a", 1, 1), ("b", 2, 1), ("c", 3, 1)]), ["k"], "w-0")
    assert rows(table) == [("a", 1, 1), ("b", 2, 1), ("c", 3, 1)]
    table.upsert(frame(spark, [("b", 20, 2), ("d", 4, 2)]), ["k"], "w-1")
    want = [("a", 1, 1), ("b", 20, 2), ("c", 3, 1), ("d", 4, 2)]
    assert rows(table) == want
    table.upsert(frame(spark, [("b", 20, 2), ("d", 4, 2)]), ["k"], "w-1")
    assert rows(table) == want


def test_later_batch_wins_without_a_version(spark, table):
    table.upsert(frame(spark, [("a", 1, 5)]), ["k"])
    table.upsert(frame(spark, [("a", 2, 3)]), ["k"])
    assert rows(table) == [("a", 2, 3)]


@pytest.mark.parametrize("fold", [False, True])
def test_version_guard(spark, table, fold):
    table.upsert(frame(spark, [("a", 1, 5), ("b", 1, 1)]), ["k"], version_column="ver")
    if fold:
        table.compact()
    table.upsert(frame(spark, [("a", 2, 3), ("b", 2, 2), ("c", 9, None)]), ["k"], version_column="ver")
    assert rows(table) == [("a", 1, 5), ("b", 2, 2), ("c", 9, None)]
    table.compact()
    assert rows(table) == [("a", 1, 5), ("b", 2, 2), ("c", 9, None)]
    with pytest.raises(ValueError, match="version column ver"):
        table.upsert(frame(spark, [("a", 2, 3)]), ["k"])


def test_composite_and_null_keys(spark, table):
    cols = "o string, i int, v int"
    table.upsert(frame(spark, [("x", 1, 1), ("x", 2, 1), (None, 1, 1)], cols), ["o", "i"])
    table.compact()
    table.upsert(frame(spark, [("x", 2, 9), ("y", 1, 1), (None, 1, 7)], cols), ["o", "i"])
    assert sorted(rows_of(table), key=str) == sorted([("x", 1, 1), ("x", 2, 9), ("y", 1, 1), (None, 1, 7)], key=str)


def rows_of(table):
    return list(map(tuple, table.read().collect()))


def test_repeated_keys_fold_on_create_as_on_update(spark, table):
    table.upsert(frame(spark, [("a", 1, 1), ("a", 5, 0), ("a", 5, 1)]), ["k"])
    assert rows(table) == [("a", 5, 1)]
    table.upsert(frame(spark, [("a", 9, 1), ("a", 2, 7)]), ["k"], order=[F.col("ver").desc()])
    assert rows(table) == [("a", 2, 7)]


# --------------------------------------------------------------- crashes


def lose_marker(path):
    """The state after a write that died before its commit."""
    os.remove(f"{path}/_SUCCESS")


def change_paths(table):
    return [p for _, _, p in table._all_changes()]


def test_crash_inside_a_change(spark, table):
    many = [(f"k{i}", i, 1) for i in range(200)]
    table.upsert(frame(spark, many), ["k"], "w-0")
    table.upsert(frame(spark, [("k3", -3, 2)]), ["k"], "w-1")
    lose_marker(change_paths(table)[-1])
    assert rows(table) == sorted(many)                      # as before the write
    table.upsert(frame(spark, [("k3", -3, 2)]), ["k"], "w-1")
    assert rows(table) == sorted([r for r in many if r[0] != "k3"] + [("k3", -3, 2)])
    assert len(change_paths(table)) == 2                    # the replay took its place


def test_crash_inside_the_first_write(spark, table):
    table.upsert(frame(spark, [("a", 1, 1)]), ["k"], "w-0")
    lose_marker(change_paths(table)[0])
    assert rows(table) == []
    table.upsert(frame(spark, [("a", 1, 1)]), ["k"], "w-0")
    assert rows(table) == [("a", 1, 1)]


def test_crash_between_layout_and_data(spark, table):
    table.create(frame(spark, []).schema, ["k"])
    assert table.exists() and rows(table) == []
    with pytest.raises(ValueError, match="keys"):
        table.upsert(frame(spark, [("a", 1, 1)]), ["v"])
    table.upsert(frame(spark, [("a", 1, 1)]), ["k"])
    assert rows(table) == [("a", 1, 1)]


def test_crash_inside_a_compaction(spark, table):
    table.upsert(frame(spark, [("a", 1, 1), ("b", 1, 1)]), ["k"])
    table.compact()
    table.upsert(frame(spark, [("b", 2, 1)]), ["k"])
    table.compact()
    lose_marker(table.state().base)
    assert rows(table) == [("a", 1, 1), ("b", 2, 1)]        # the base and change before it are still there
    table.compact()
    assert rows(table) == [("a", 1, 1), ("b", 2, 1)]


def test_other_errors_are_not_taken_for_absence(spark, table):
    table.upsert(frame(spark, [("a", 1, 1)]), ["k"])
    [path] = change_paths(table)
    for f in os.listdir(path):
        if f.endswith(".parquet"):
            with open(f"{path}/{f}", "wb") as fh:
                fh.write(b"damaged")
    with pytest.raises(Exception):
        table.read().collect()
    with pytest.raises(Exception):
        table.compact()
    assert table.state().base is None


def test_foreign_files_are_not_replaced(spark, table):
    os.makedirs(table.path)
    with open(f"{table.path}/keep.txt", "w") as fh:
        fh.write("x")
    with pytest.raises(ValueError, match="not replaced"):
        table.upsert(frame(spark, [("a", 1, 1)]), ["k"])
    assert os.listdir(table.path) == ["keep.txt"]


# ---------------------------------------------------------------- schema


def test_missing_column_keeps_the_stored_value(spark, table):
    table.upsert(frame(spark, [("a", 1, 7), ("b", 2, 8)]), ["k"])
    table.upsert(frame(spark, [("a", 10), ("c", 30)], "k string, v int"), ["k"])
    assert rows(table) == [("a", 10, 7), ("b", 2, 8), ("c", 30, None)]


def test_new_column_is_refused_or_added(spark, table):
    table.upsert(frame(spark, [("a", 1, 7), ("b", 2, 8)]), ["k"])
    wide = frame(spark, [("a", 10, 9, "x")], COLS + ", more string")
    with pytest.raises(ValueError, match="more is unknown"):
        table.upsert(wide, ["k"])
    assert rows(table) == [("a", 1, 7), ("b", 2, 8)]
    table.upsert(wide, ["k"], evolve=True)
    assert table.read().columns == ["k", "v", "ver", "more"]
    assert rows(table) == [("a", 10, 9, "x"), ("b", 2, 8, None)]


@pytest.mark.parametrize("cols", ["k string, v bigint, ver int", "k int, v int, ver int", "v int, ver int"])
def test_changed_types_and_lost_keys_are_refused(spark, table, cols):
    table.upsert(frame(spark, [("a", 1, 7)]), ["k"])
    with pytest.raises(ValueError, match="does not fit"):
        table.upsert(frame(spark, [], cols), ["k"])
    assert rows(table) == [("a", 1, 7)]


# ------------------------------------------------------------------ cost


def test_small_batch_writes_little(spark, table):
    table.upsert(spark.range(100_000).selectExpr("cast(id as string) k", "cast(id as int) v", "1 ver"), ["k"])
    table.compact()
    before = data_bytes(table.path)
    table.upsert(spark.range(1_000).selectExpr("cast(id * 100 as string) k", "-1 v", "2 ver"), ["k"])
    assert data_bytes(table.path) - before < 0.05 * before
    got = table.read()
    assert got.count() == 100_000 and got.where("v = -1").count() == 1_000


def test_reading_orders_changes_alone(spark, table):
    table.upsert(spark.range(1_000).selectExpr("cast(id as string) k", "cast(id as int) v", "1 ver"), ["k"])
    table.compact()
    table.upsert(frame(spark, [("7", -7, 2)]), ["k"])
    plan = table.read()._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window"):plan.index("Window") + plan[plan.index("Window"):].index("Relation")]
    assert "LeftAnti" in plan and "base" not in window
    assert "base" not in table.query(table.state()).split("row_number")[1].split("_rn = 1")[0]


def test_growing_changes_are_folded(spark, table):
    base = frame(spark, [(f"k{i}", i, 1) for i in range(50)])
    table.upsert(base, ["k"])
    for n in range(40):
        table.upsert(frame(spark, [(f"k{n}", -n, 2)]), ["k"], f"w-{n}")
    assert table.state().base is not None
    assert len(table.state().changes) < 40
    assert dict((k, v) for k, v, _ in rows(table)) == {f"k{i}": -i if i < 40 else i for i in range(50)}
    # What older bases replaced is gone; the last one's inputs are still there for running readers.
    assert len(storage.numbered(spark, table.path, "base")) <= 2


def test_rows_are_spread_by_size(spark, table):
    """No constant in the layout: as many write tasks as the bytes ask for."""
    adaptive = "spark.sql.adaptive."
    small = {"spark.sql.shuffle.partitions": "64", adaptive + "advisoryPartitionSizeInBytes": "8k",
             adaptive + "coalescePartitions.minPartitionSize": "4k"}
    old = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        table.upsert(spark.range(60_000).selectExpr("cast(id as string) k", "cast(id as int) v", "1 ver"), ["k"])
        table.compact()
        files = [f for f in os.listdir(table.state().base) if f.endswith(".parquet")]
        assert len(files) > 16
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_snapshot_stays_until_the_next_is_complete(spark, lake):
    path = f"{lake.root}/gold/g"
    storage.write_snapshot(spark.range(3), path)

    @F.udf("bigint")
    def fail(x):
        raise RuntimeError("injected")

    with pytest.raises(Exception):
        storage.write_snapshot(spark.range(5).select(fail("id").alias("id")), path)
    assert spark.read.parquet(storage.live_snapshot(spark, path)).count() == 3
    for n in (7, 9):
        storage.write_snapshot(spark.range(n), path)
    assert spark.read.parquet(storage.live_snapshot(spark, path)).count() == 9
    assert len([n for n in storage.names(spark, path) if n.startswith("snapshot=")]) == 2


def test_function_form(spark, table):
    upsert(frame(spark, [("a", 1, 1)]), table.path, ["k"], origin="x")
    assert rows(table) == [("a", 1, 1)]


# ------------------------------------------------- replays and key buckets


def test_torn_write_replayed_after_others_and_a_fold(spark, table):
    """The replay of a write that died comes after what was written since, and is not lost."""
    many = spark.range(20_000).selectExpr("cast(id as string) k", "cast(id as int) v", "1 ver")
    late = frame(spark, [("99999", 1, 9), ("5", -1, 9)])
    table.upsert(many, ["k"], "w-0")
    table.upsert(late, ["k"], "w-1")
    lose_marker(change_paths(table)[-1])
    table.upsert(frame(spark, [("5", -2, 9), ("6", -2, 9)]), ["k"], "w-2")
    table.compact()
    table.upsert(late, ["k"], "w-1")
    got = {k: v for k, v, _ in rows(table)}
    assert len(got) == 20_001 and (got["99999"], got["5"], got["6"]) == (1, -1, -2)
    table.compact()
    assert {k: v for k, v, _ in rows(table)} == got


def test_torn_write_without_a_fold(spark, table):
    table.upsert(spark.range(2_000).selectExpr("cast(id as string) k", "0 v", "1 ver"), ["k"], "w-0")
    table.upsert(frame(spark, [("a", 1, 1)]), ["k"], "w-1")
    lose_marker(change_paths(table)[-1])
    table.upsert(frame(spark, [("a", 2, 1)]), ["k"], "w-2")
    assert ("a", 2, 1) in rows(table)
    table.upsert(frame(spark, [("a", 1, 1)]), ["k"], "w-1")
    assert ("a", 1, 1) in rows(table) and ("a", 2, 1) not in rows(table)


def test_committed_replay_keeps_its_number(spark, table):
    table.upsert(spark.range(2_000).selectExpr("cast(id as string) k", "0 v", "1 ver"), ["k"], "w-0")
    letters = lambda: [r for r in rows(table) if r[0].isalpha()]
    table.upsert(frame(spark, [("a", 1, 1), ("b", 1, 1)]), ["k"], "w-1")
    table.upsert(frame(spark, [("a", 2, 1)]), ["k"], "w-2")
    table.upsert(frame(spark, [("a", 7, 1), ("b", 7, 1)]), ["k"], "w-1")     # replaces its rows, at its place
    assert letters() == [("a", 2, 1), ("b", 7, 1)]
    lose_marker([p for p in change_paths(table) if p.endswith("~1")][0])      # a replay that dies changes nothing
    assert letters() == [("a", 2, 1), ("b", 1, 1)]
    table.compact()
    table.upsert(frame(spark, [("c", 3, 1)]), ["k"], "w-3")
    for origin in ("w-1", "w-2"):
        table.upsert(frame(spark, [("a", 9, 1)]), ["k"], origin)              # folded: known
    table.compact()
    table.upsert(frame(spark, [("d", 4, 1)]), ["k"], "w-4")
    table.compact()
    table.upsert(frame(spark, [("a", 9, 1)]), ["k"], "w-1")
    assert letters() == [("a", 2, 1), ("b", 1, 1), ("c", 3, 1), ("d", 4, 1)]


@pytest.fixture()
def cut(spark, lake):
    """A table whose base has 16 buckets or more."""
    t = KeyedTable(spark, f"{lake.root}/silver/cut", bucket_bytes=16 << 10)
    t.upsert(spark.range(40_000).selectExpr("cast(id as string) k", "cast(id as int) v", "5 ver"), ["k"], version_column="ver")
    t.compact()
    assert t.state().buckets >= 16
    return t



def test_reads_touch_the_changed_buckets_alone(spark, cut):
    cut.upsert(frame(spark, [("7", -7, 6), ("x", 1, 6)]), ["k"], version_column="ver")
    plan = cut.read()._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan
    filters = [f for f in plan.splitlines() if "_bucket" in f and "Filter" in f]
    changed = {r[0] for r in spark.sql("SELECT DISTINCT CAST(pmod(xxhash64(k), %d) AS INT) FROM VALUES ('7'), ('x') t(k)"
                                       % cut.state().buckets).collect()}
    assert len(changed) <= 2 and len(filters) == 2                            # these buckets, and all others
    got = {k: v for k, v, _ in rows(cut)}
    assert len(got) == 40_001 and got["7"] == -7 and got["8"] == 8 and got["x"] == 1


def test_small_buckets_do_not_grow_in_number_with_the_table(spark, lake, monkeypatch):
    """Buckets of 64 bytes, had there been no bound, would be thousands."""
    monkeypatch.setattr(upsert_module, "MOST_BUCKETS", 8, raising=False)
    t = KeyedTable(spark, f"{lake.root}/silver/small", bucket_bytes=64)
    t.upsert(spark.range(2_000).selectExpr("if(id = 0, null, cast(id as string)) k", "cast(id as int) v", "5 ver"),
             ["k"], version_column="ver")
    t.compact()
    assert t.state().buckets == 8
    t.upsert(frame(spark, [("7", -7, 6), ("8", -8, 4), (None, -1, 6)]), ["k"], version_column="ver")
    got = {k: v for k, v, _ in t.read().collect()}
    assert len(got) == 2_000 and (got["7"], got["8"], got["9"], got[None]) == (-7, 8, 9, -1)
    monkeypatch.setattr(upsert_module, "BUCKET_BYTES", 1 << 10, raising=False)
    t.compact()                                              # full-sized buckets are as many as it takes
    assert t.state().buckets > 8


def base_bytes_read(spark, cut, batch):
    """Bytes of the base's files in which the stored values of a batch are looked up."""
    return scanned(spark, cut._beside_stored(batch, cut.layout(), ["ver"]), "filesSize", "/base=")


def test_lookups_read_the_buckets_of_the_batch(spark, cut):
    total = data_bytes(cut.state().base)
    few = frame(spark, [("7", 0, 0)])
    assert 0 < base_bytes_read(spark, cut, few) < 0.15 * total
    cut.upsert(frame(spark, [("7", -1, 4), ("8", -1, 6), ("y", 1, None)]), ["k"], version_column="ver")
    got = {k: v for k, v, _ in rows(cut)}
    assert (got["7"], got["8"], got["y"]) == (7, -1, 1)
    cut.upsert(frame(spark, [("8", 6), ("z", 6)], "k string, ver int"), ["k"], version_column="ver")
    got = {k: v for k, v, _ in rows(cut)}
    assert got["8"] == -1 and got["z"] is None and len(got) == 40_002
    cut.compact()
    assert {k: v for k, v, _ in rows(cut)} == got
    few = spark.range(3).selectExpr("cast(id as string) k", "0 v", "0 ver")
    assert base_bytes_read(spark, cut, few) < 0.4 * total
