"""Bronze ingest and Silver refine on small landing CSV files (two runs)."""

import datetime as dt
import json
import os
from dataclasses import replace

import pytest
from pyspark.errors import StreamingQueryException

from stratum.sources.tables import read_bronze
from stratum.specs import load_spec
from stratum.streaming import bronze, silver

HEADER = ("customer_id,customer_unique_id,customer_zip_code_prefix,"
          "customer_city,customer_state\n")


def _drop(lake, dataset, name, text):
    d = lake.landing(dataset)
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w", encoding="utf-8") as fh:
        fh.write(text)


def _bronze_rows(spark, lake, table):
    return read_bronze(spark, f"{lake.root}/bronze/{table}")


def test_csv_dialect_rescue_and_provenance(spark, lake):
    _drop(lake, "customers", "a.csv", HEADER + (
        'c1,u1,01409,"Sao ""Paulo"", centro\nnorte",SP\n'
        "c2,u2,2000,Rio,RJ,EXTRA\n"
        "c3,u3\n"
        "c4,u4,  3000  ,  Recife ,PE\n"))
    ts = dt.datetime(2024, 1, 2, 3, 4, 5)
    bronze.ingest(spark, "customers", lake, ingest_ts=ts)
    rows = {r.customer_id: r for r in _bronze_rows(spark, lake, "customers").collect()}
    assert set(rows) == {"c1", "c2", "c3", "c4"}
    assert rows["c1"].customer_city == 'Sao "Paulo", centro\nnorte'
    assert rows["c1"].customer_zip_code_prefix == "01409"
    assert rows["c1"]._rescued_data is None
    assert rows["c2"]._rescued_data is not None and "EXTRA" in rows["c2"]._rescued_data
    assert rows["c3"]._rescued_data is not None
    assert rows["c4"].customer_city == "Recife"
    assert all(r._ingest_ts == ts for r in rows.values())
    assert all(r._source_file_path.endswith("a.csv") for r in rows.values())


def test_second_run_without_new_file_adds_nothing(spark, lake):
    _drop(lake, "customers", "a.csv", HEADER + "c1,u1,1,x,SP\n")
    bronze.ingest(spark, "customers", lake)
    assert _bronze_rows(spark, lake, "customers").count() == 1
    bronze.ingest(spark, "customers", lake)
    assert _bronze_rows(spark, lake, "customers").count() == 1
    _drop(lake, "customers", "b.csv", HEADER + "c2,u2,2,y,RJ\n")
    bronze.ingest(spark, "customers", lake)
    assert _bronze_rows(spark, lake, "customers").count() == 2


REORDERED = ("customer_unique_id,customer_id,customer_zip_code_prefix,customer_city,customer_state\n"
             "u1,c1,1,x,SP\n")


def test_reordered_header_is_read_by_name(spark, lake):
    _drop(lake, "customers", "a.csv", REORDERED)
    bronze.ingest(spark, "customers", lake)
    row = _bronze_rows(spark, lake, "customers").first()
    assert (row.customer_id, row.customer_unique_id, row._rescued_data) == ("c1", "u1", None)


def test_reordered_header_stops_a_stream_by_position(spark, lake):
    spec = load_spec("customers", "bronze")
    spec = replace(spec, by_name=False, options={**spec.options, "enforceSchema": "false"})
    _drop(lake, "customers", "a.csv", REORDERED)
    with pytest.raises(StreamingQueryException):
        bronze.ingest(spark, spec, lake)


def test_misfit_fields_are_kept_one_by_one(spark, lake):
    """Files of four headers in one micro-batch: extra, missing, reordered and repeated columns."""
    text = {"a.csv": "customer_id,customer_city,extra,customer_state\nc1,Rio,e1,RJ\nc2,Rio,,RJ\n",
            "b [x] +{y}.csv": HEADER + "c3,u3,3,x,SP,more,\"a \"\"b\"\",\nc\"\nc4,u4\nc5,u5,5,y,SP\n",
            "c.csv": "\"customer_state\", customer_id,customer_id,_c3\nBA,c6,again,three,four\n",
            "d.csv": "customer_id,customer_city,extra,customer_state\nc7,\"two\nlines\",e7,PE\n",
            "empty.csv": "", "header.csv": HEADER}
    for name, content in text.items():
        _drop(lake, "customers", name, content)
    bronze.ingest(spark, "customers", lake)
    rows = {r.customer_id: r for r in _bronze_rows(spark, lake, "customers").collect()}
    kept = {k: json.loads(r._rescued_data) if r._rescued_data else None for k, r in rows.items()}
    assert kept == {"c1": {"extra": "e1"}, "c2": None, "c3": {"_c5": "more", "_c6": 'a "b",\nc'}, "c4": {"_line": "c4,u4"},
                    "c5": None, "c6": {"customer_id": "again", "_c3": "three", "_c4": "four"}, "c7": {"extra": "e7"}}
    assert rows["c7"].customer_city == "two\nlines" and rows["c7"].customer_zip_code_prefix is None
    assert rows["c3"].customer_state == "SP" and rows["c6"].customer_state == "BA"
    assert rows["c3"]._source_file_path.endswith("/customers/b%20%5Bx%5D%20+%7By%7D.csv")


def test_very_long_line_is_kept_whole_too(spark, lake):
    line = "c1,u1,1,x,SP," + ",".join(f"s{i}" for i in range(100))
    _drop(lake, "customers", "a.csv", HEADER + line + "\n")
    bronze.ingest(spark, "customers", lake)
    kept = json.loads(_bronze_rows(spark, lake, "customers").first()._rescued_data)
    assert kept["_c5"] == "s0" and kept["_line"] == line


def _batches(lake, table):
    return sorted(n for n in os.listdir(f"{lake.root}/bronze/{table}") if n.startswith("batch="))


def test_micro_batches_bounded_by_bytes(spark, lake):
    spec = replace(load_spec("customers", "bronze"), max_bytes_per_trigger=200)
    for n in range(6):
        _drop(lake, "customers", f"{n}.csv", HEADER + f"c{n},u{n},1,x,SP\n")     # about 90 bytes each
    bronze.ingest(spark, spec, lake)
    assert len(_batches(lake, "customers")) == 3
    assert _bronze_rows(spark, lake, "customers").count() == 6
    assert load_spec("orders", "bronze").max_bytes_per_trigger == 64 << 30
    assert "_spark_metadata" not in os.listdir(f"{lake.root}/bronze/customers")


def test_processed_files_leave_the_landing_folder(spark, lake):
    for n in range(3):
        _drop(lake, "customers", f"{n}.csv", HEADER + f"c{n},u{n},1,x,SP\n")
        bronze.ingest(spark, "customers", lake)
    assert len(os.listdir(lake.landing("customers"))) <= 1          # the last run's file is cleaned by the next
    assert _bronze_rows(spark, lake, "customers").count() == 3
    moved = [f for _, _, fs in os.walk(f"{lake.root}/_archive") for f in fs if f.endswith(".csv")]
    assert len(moved) >= 2


def test_unfinished_batches_are_not_read(spark, lake):
    from stratum.sources import storage
    path = f"{lake.root}/bronze/t"
    rows = spark.range(100).repartition(3)
    storage.append_batch(rows, path, "q-0")
    rows.write.parquet(f"{path}/_staging/q-1")                       # written, not yet moved
    assert read_bronze(spark, path).count() == 100
    one = [f for f in os.listdir(f"{path}/_staging/q-1") if f.endswith(".parquet")][0]
    storage.move(spark, f"{path}/_staging/q-1/{one}", f"{path}/batch=q-1")
    assert read_bronze(spark, path).count() == 100
    for _ in range(2):
        storage.append_batch(spark.range(7), path, "q-1")            # goes on with what was written
        assert read_bronze(spark, path).count() == 200
    os.makedirs(f"{path}/_staging/q-2")                              # died while writing
    storage.append_batch(rows, path, "q-2")
    assert read_bronze(spark, path).count() == 300
    with pytest.raises(ValueError, match="no complete table"):
        read_bronze(spark, path + "-none")


def test_silver_refine_dedup_upsert_two_runs(spark, lake):
    _drop(lake, "customers", "a.csv", HEADER + (
        "c1,u1,01409,Sao Paulo,SP\n"
        "c2,u2,2000,Rio,RJ\n"
        "c2,u2,2001,Rio,RJ\n"           # same key twice in one file
        ",u9,1,x,SP\n"                  # empty required column
        "c3,,1,x,SP\n"))                # empty required column
    bronze.ingest(spark, "customers", lake, ingest_ts=dt.datetime(2024, 1, 1))
    silver.refine_stream(spark, "customers", lake, run_id="run-1")
    t = silver.read_silver(spark, "customers", lake)
    got = {r.customer_id: r for r in t.collect()}
    assert set(got) == {"c1", "c2"}
    assert got["c1"].customer_zip_code_prefix == 1409       # int zip loses the leading zero
    assert got["c2"].customer_zip_code_prefix == 2001       # tie on version: larger value wins
    assert got["c1"]._run_id == "run-1"
    assert {"_ingest_ts", "_source_file_path", "_rescued_data", "_processed_ts", "_run_id"} <= set(t.columns)

    # a second drop corrects c1 and adds c4; c2 untouched
    _drop(lake, "customers", "b.csv", HEADER + "c1,u1,5555,Campinas,SP\nc4,u4,7,y,BA\n")
    bronze.ingest(spark, "customers", lake, ingest_ts=dt.datetime(2024, 1, 2))
    silver.refine_stream(spark, "customers", lake, run_id="run-2")
    got = {r.customer_id: r for r in silver.read_silver(spark, "customers", lake).collect()}
    assert set(got) == {"c1", "c2", "c4"}
    assert got["c1"].customer_city == "Campinas" and got["c1"]._run_id == "run-2"
    assert got["c2"].customer_zip_code_prefix == 2001 and got["c2"]._run_id == "run-1"

    # nothing new: the table is unchanged
    silver.refine_stream(spark, "customers", lake, run_id="run-3")
    again = {r.customer_id: r._run_id for r in silver.read_silver(spark, "customers", lake).collect()}
    assert again == {"c1": "run-2", "c2": "run-1", "c4": "run-2"}

    # rebuild from Bronze gives the same business content
    silver.rebuild(spark, "customers", lake, run_id="rebuild")
    rebuilt = {r.customer_id: (r.customer_city, r.customer_zip_code_prefix)
               for r in silver.read_silver(spark, "customers", lake).collect()}
    assert rebuilt == {k: (v.customer_city, v.customer_zip_code_prefix) for k, v in got.items()}


def test_cast_modes(spark, lake):
    _drop(lake, "customers", "a.csv", HEADER + "c1,u1,notanumber,x,SP\nc2,u2,12,y,RJ\n")
    bronze.ingest(spark, "customers", lake)
    strict = load_spec("customers", "silver")
    with pytest.raises(StreamingQueryException):
        silver.refine_stream(spark, strict, lake)

    lenient = replace(load_spec("customers", "silver"), on_cast_error="null")
    lake2 = type(lake)(lake.root + "-lenient")
    _drop(lake2, "customers", "a.csv", HEADER + "c1,u1,notanumber,x,SP\nc2,u2,12,y,RJ\n")
    bronze.ingest(spark, "customers", lake2)
    silver.refine_stream(spark, lenient, lake2)
    got = {r.customer_id: r.customer_zip_code_prefix
           for r in silver.read_silver(spark, "customers", lake2).collect()}
    assert got == {"c1": None, "c2": 12}


def test_failed_batch_is_replayed_idempotently(spark, lake):
    from stratum.operators.refine import refine
    from stratum.sources.tables import read_bronze_stream
    from stratum.streaming.sinks import foreach_batch_stream

    _drop(lake, "customers", "a.csv", HEADER + "c1,u1,1,x,SP\nc2,u2,2,y,RJ\nc1,u1,3,z,SP\n")
    bronze.ingest(spark, "customers", lake, ingest_ts=dt.datetime(2024, 1, 1))
    spec = load_spec("customers", "silver")
    target = lake.path(spec.target)
    ckpt = lake.checkpoint(spec.target)
    process = silver.upsert_batch(spec, target)
    calls = []

    def crash_after_write(df, origin):
        process(df, origin)
        calls.append(origin.rpartition("-")[2])
        raise RuntimeError("driver lost after the write")

    stream = lambda: refine(read_bronze_stream(spark, lake.path(spec.source), 10), spec, "r")
    with pytest.raises(StreamingQueryException):
        foreach_batch_stream(stream(), ckpt, crash_after_write)
    assert calls == ["0"]
    foreach_batch_stream(stream(), ckpt, process)      # replays batch 0
    got = sorted((r.customer_id, r.customer_zip_code_prefix)
                 for r in silver.read_silver(spark, "customers", lake).collect())
    assert got == [("c1", 3), ("c2", 2)]
    assert _bronze_rows(spark, lake, "customers").count() == 3


def test_one_file_per_micro_batch_later_file_wins(spark, lake):
    _drop(lake, "customers", "a.csv", HEADER + "c1,u1,1,first,SP\nc2,u2,2,x,RJ\n")
    bronze.ingest(spark, "customers", lake, ingest_ts=dt.datetime(2024, 1, 1))
    _drop(lake, "customers", "b.csv", HEADER + "c1,u1,9,second,SP\n")
    bronze.ingest(spark, "customers", lake, ingest_ts=dt.datetime(2024, 1, 2))
    # two Bronze files -> two micro-batches in one drain
    silver.refine_stream(spark, "customers", lake, max_files_per_trigger=1)
    got = {r.customer_id: r.customer_city for r in silver.read_silver(spark, "customers", lake).collect()}
    assert got == {"c1": "second", "c2": "x"}


def test_json_landing_through_a_new_spec(spark, lake, tmp_path):
    """Adding a dataset needs only specs: a JSON-lines source, new keys."""
    (tmp_path / "bronze").mkdir()
    (tmp_path / "silver").mkdir()
    (tmp_path / "bronze" / "events.yaml").write_text(
        "file: {format: json, rescued_data_column: _rescued_data}\n"
        "target: {schema: bronze, table: events}\n")
    (tmp_path / "silver" / "events.yaml").write_text(
        "source: {schema: bronze, table: events}\n"
        "target: {schema: silver, table: events}\n"
        "schema:\n"
        "  - {column: event_id, type: long, nullable: false}\n"
        "  - {column: kind, type: string, nullable: true}\n"
        "  - {column: amount, type: double, nullable: true}\n"
        "keys: {primary_keys: event_id}\n")
    land = lake.landing("events")
    os.makedirs(land)
    with open(os.path.join(land, "e1.json"), "w") as fh:
        fh.write('{"event_id": 1, "kind": "a", "amount": 1.5}\n'
                 '{"event_id": 2, "kind": "b", "amount": 2}\n'
                 '{"event_id": 1, "kind": "z", "amount": 3.25}\n'
                 'not json\n')
    b = load_spec("events", "bronze", conf=tmp_path)
    s = load_spec("events", "silver", conf=tmp_path)
    bronze.ingest(spark, b, lake, landing=land)
    assert _bronze_rows(spark, lake, "events").filter("_rescued_data is not null").count() == 1
    silver.refine_stream(spark, s, lake)
    got = {r.event_id: (r.kind, r.amount) for r in silver.read_silver(spark, s, lake).collect()}
    assert got == {1: ("z", 3.25), 2: ("b", 2.0)}


def test_version_guard_option_through_the_stream(spark, lake):
    spec = replace(load_spec("customers", "silver"), version_guard=True)
    _drop(lake, "customers", "a.csv", HEADER + "c1,u1,1,newer,SP\n")
    bronze.ingest(spark, "customers", lake, ingest_ts=dt.datetime(2024, 5, 1))
    silver.refine_stream(spark, spec, lake)
    # a late drop carrying an older version of c1, and a new key
    _drop(lake, "customers", "b.csv", HEADER + "c1,u1,2,older,SP\nc2,u2,3,x,RJ\n")
    bronze.ingest(spark, "customers", lake, ingest_ts=dt.datetime(2024, 4, 1))
    silver.refine_stream(spark, spec, lake)
    got = {r.customer_id: r.customer_city for r in silver.read_silver(spark, spec, lake).collect()}
    assert got == {"c1": "newer", "c2": "x"}


def test_batch_read_with_the_bronze_dialect(spark, lake):
    from stratum.sources.files import read_files
    _drop(lake, "customers", "a.csv", HEADER + 'c1,u1,01409,"a, ""b""",SP\nc2,u2\n')
    spec = load_spec("customers", "bronze")
    df = read_files(spark, lake.landing("customers"), spec.file_format, spec.options, spec.landing_schema)
    rows = {r.customer_id: r for r in df.collect()}
    assert rows["c1"].customer_city == 'a, "b"' and rows["c1"]._rescued_data is None
    assert rows["c2"]._rescued_data is not None


def test_back_dated_file_is_ingested(spark, lake):
    _drop(lake, "customers", "a.csv", HEADER + "c1,u1,1,x,SP\n")
    bronze.ingest(spark, "customers", lake)
    _drop(lake, "customers", "b.csv", HEADER + "c2,u2,2,x,SP\n")
    old = dt.datetime.now().timestamp() - 400 * 86_400
    os.utime(os.path.join(lake.landing("customers"), "b.csv"), (old, old))
    bronze.ingest(spark, "customers", lake)
    _drop(lake, "customers", "c.csv", HEADER + "c3,u3,3,x,SP\n")
    bronze.ingest(spark, "customers", lake)
    assert {r.customer_id for r in _bronze_rows(spark, lake, "customers").collect()} == {"c1", "c2", "c3"}
    silver.refine_stream(spark, "customers", lake)
    assert silver.read_silver(spark, "customers", lake).count() == 3


def test_later_file_of_one_run_wins(spark, lake):
    _drop(lake, "customers", "a.csv", HEADER + "c1,u9,9,zzz,ZZ\n")
    _drop(lake, "customers", "b.csv", HEADER + "c1,u1,1,aaa,AA\n")       # every value smaller
    bronze.ingest(spark, "customers", lake)
    silver.refine_stream(spark, "customers", lake)
    assert silver.read_silver(spark, "customers", lake).first().customer_city == "aaa"


def test_batch_without_rows_changes_nothing(spark, lake):
    _drop(lake, "customers", "a.csv", HEADER + ",u1,1,x,SP\n")            # no key: nothing is left
    bronze.ingest(spark, "customers", lake)
    silver.refine_stream(spark, "customers", lake)
    with pytest.raises(ValueError, match="no keyed table"):
        silver.read_silver(spark, "customers", lake)
    _drop(lake, "customers", "b.csv", HEADER + "c1,u1,1,x,SP\n")
    bronze.ingest(spark, "customers", lake)
    silver.refine_stream(spark, "customers", lake)
    assert silver.read_silver(spark, "customers", lake).count() == 1


def test_empty_batch_reaches_the_short_circuit(spark, lake, monkeypatch):
    """A batch whose rows all lack a required column is handed over empty, and makes no write."""
    spec = load_spec("customers", "silver")
    sizes, path = [], lake.path(spec.target)
    process = silver.upsert_batch(spec, path)

    def watched(spec, path):
        def run(batch, origin):
            sizes.append(batch.count())
            process(batch, origin)
        return run

    monkeypatch.setattr(silver, "upsert_batch", watched)
    for text in ("c1,u1,1,x,SP\n", ",u1,1,x,SP\n,u2,1,x,SP\n"):
        _drop(lake, "customers", f"{len(sizes)}.csv", HEADER + text)
        bronze.ingest(spark, "customers", lake)
        silver.refine_stream(spark, "customers", lake)
    assert sizes == [1, 0] and len(os.listdir(f"{path}/changes")) == 1


def test_new_checkpoint_is_a_new_origin(spark, lake):
    """Batch 0 of a stream that starts anew must not overwrite batch 0 of the old one."""
    from stratum.operators.refine import refine
    from stratum.sources.tables import read_bronze_stream
    from stratum.streaming.sinks import foreach_batch_stream
    spec = load_spec("customers", "silver")
    _drop(lake, "customers", "a.csv", HEADER + "c1,u1,1,x,SP\n")
    bronze.ingest(spark, "customers", lake)
    seen = []
    for ckpt in ("one", "two"):
        stream = refine(read_bronze_stream(spark, lake.path(spec.source), 10), spec, "r")
        foreach_batch_stream(stream, f"{lake.root}/ckpt/{ckpt}", lambda df, origin: seen.append(origin))
    assert len(set(seen)) == 2 and all(o.endswith("-0") for o in seen)
