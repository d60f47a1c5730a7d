"""Streaming jobs: incremental runs, replays, oversize files, staged batches."""

import os

import pytest
from pyspark.sql import functions as F

from strata.operators import payload
from strata.queries.inputs import scratch_schema
from strata.sources import tables
from strata.streaming import bronze, silver

SCHEMA = "tx_id STRING, amount DOUBLE, tx_time STRING"


def land(folder, name, text):
    path = f"{folder}/landing/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)


class Job:
    def __init__(self, spark, folder, schema, **options):
        self.spark, self.folder, self.raw = spark, folder, f"{schema}.raw"
        self.max_bytes = options.pop("max_bytes", 1000)
        self.spec = silver.SilverTable("tx", f"{schema}.tx", SCHEMA, rules=["amount > 0"], buckets=4, **options)

    def run(self, checkpoint="checkpoints"):
        bronze.ingest_raw(self.spark, f"{self.folder}/landing", self.raw, f"{self.folder}/{checkpoint}/raw", "raw",
                          max_bytes=self.max_bytes, timeout=300)
        return silver.from_bronze(self.spark, self.raw, self.spec, f"{self.folder}/{checkpoint}/silver", timeout=300)

    def good(self):
        return sorted(((r.tx_id, r.amount) for r in tables.read(self.spark, self.spec.target).collect()), key=str)

    def bad(self):
        return sorted((str(r.tx_id), r.failure_reasons[0]) for r in
                      tables.read(self.spark, self.spec.quarantine).collect())


@pytest.mark.parametrize("staged", [False, True])
def test_runs_are_incremental_and_latest_wins(spark, folder, staged):
    job = Job(spark, folder, scratch_schema(spark, "inc"), file_format="json", merge_key="tx_id",
              order_by=["tx_time"], stage=f"{folder}/stage" if staged else None)
    land(folder, "a.json", '{"tx_id":"a","amount":1,"tx_time":"1"}\n{"tx_id":"a","amount":2,"tx_time":"2"}\n'
                           '{"tx_id":"b","amount":-1}\nbroken\n')
    assert job.run() == [{"valid_rows": 2, "quarantined_rows": 2}]
    assert job.good() == [("a", 2.0)] and len(job.bad()) == 2
    assert job.run() == []
    land(folder, "deep/b.json", '{"tx_id":"a","amount":9,"tx_time":"3"}\n{"tx_id":"c","amount":3}\n')
    land(folder, "other.csv", "tx_id,amount\nx,5\n")
    assert job.run() == [{"valid_rows": 2, "quarantined_rows": 0}]
    assert job.good() == [("a", 9.0), ("c", 3.0)] and len(job.bad()) == 2
    raw = spark.table(job.raw)
    assert raw.count() == 3 and raw.filter("payload IS NULL").count() == 0
    assert set(raw.columns) >= {"payload", "file_format", "ingested_at", "source_file", "_pipeline_run_id",
                                "_processed_at", "_run_mode", "_user"}


def test_a_lost_silver_checkpoint_replays_into_the_same_state(spark, folder):
    job = Job(spark, folder, scratch_schema(spark, "lost"), file_format="json")
    land(folder, "a.json", '{"tx_id":"a","amount":1}\n{"tx_id":null,"amount":2}\n{"tx_id":"c","amount":0}\n')
    job.run()
    before = job.good(), job.bad()
    silver.from_bronze(spark, job.raw, job.spec, f"{folder}/fresh", timeout=300)
    assert (job.good(), job.bad()) == before and len(before[0]) == 2


@pytest.mark.parametrize("keyed", [False, True])
def test_a_replay_of_many_batches_in_one_leaves_no_row_twice(spark, folder, keyed):
    job = Job(spark, folder, scratch_schema(spark, "again"), file_format="json", merge_key="tx_id" if keyed else None)
    for name in ("a", "b", "c"):
        land(folder, f"{name}.json", f'{{"tx_id":"{name}","amount":1}}\n{{"tx_id":null,"amount":2}}\n'
                                     f'{{"tx_id":"{name}","amount":0}}\n{{"tx_id":"{name}","amount":0}}\n')
        assert len(job.run()) == 1
    before = job.good(), job.bad()
    assert len(before[0]) == 6 and len(before[1]) == 6
    tables.fold(spark, job.spec.quarantine, "tx")
    assert job.run("replayed") == [{"valid_rows": 6, "quarantined_rows": 6}]
    assert (job.good(), job.bad()) == before
    land(folder, "d.json", '{"tx_id":"d","amount":0}\n')
    job.run()
    # The replay has ended: what the first checkpoint goes on to write stays.
    assert (job.good(), len(job.bad())) == (before[0], 7)


def test_a_replay_that_failed_ends_with_the_next_run(spark, folder, monkeypatch):
    job = Job(spark, folder, scratch_schema(spark, "lost"), file_format="json")
    for name in ("a", "b"):
        land(folder, f"{name}.json", f'{{"tx_id":"{name}","amount":1}}\n{{"tx_id":"{name}","amount":0}}\n')
        job.run()
    before = job.good(), job.bad()
    append = tables.append_batch

    def broken(*args, **kwargs):
        append(*args, **kwargs)
        raise RuntimeError("lost right after the write")

    monkeypatch.setattr(tables, "append_batch", broken)
    with pytest.raises(Exception, match="lost right after"):
        silver.from_bronze(spark, job.raw, job.spec, f"{folder}/fresh", timeout=300)
    monkeypatch.setattr(tables, "append_batch", append)
    silver.from_bronze(spark, job.raw, job.spec, f"{folder}/fresh", timeout=300)
    assert (job.good(), job.bad()) == before


def test_the_silver_query_replays_its_streams(spark, folder, monkeypatch):
    from strata.queries import streams
    empty = {"region": "r_regionkey INT, r_name STRING", "nation": "n_nationkey INT, n_regionkey INT",
             "customer": "c_custkey INT, c_nationkey INT",
             "orders": "o_orderkey INT, o_custkey INT, o_orderstatus STRING, o_orderpriority STRING, o_totalprice DOUBLE, "
                       "o_orderdate TIMESTAMP_NTZ"}
    rows = {"region": "(1, 'N')", "nation": "(1, 1)", "customer": "(1, 1)",
            "orders": "(1, 1, 'F', '1', 5.0, TIMESTAMP_NTZ'2020-01-01'), (2, 1, 'F', '5-LOW', 5.0, TIMESTAMP_NTZ'2020-01-01'), "
                      "(3, 1, 'O', '5-LOW', 5.0, TIMESTAMP_NTZ'2020-01-01')"}
    for name, schema in empty.items():
        names = ", ".join(c.split()[0] for c in schema.split(", "))
        types = ", ".join(f"CAST({c.split()[0]} AS {c.split()[1]})" for c in schema.split(", "))
        spark.sql(f"SELECT {types} FROM VALUES {rows[name]} AS t({names})").toDF(*names.split(", ")).write.parquet(
            f"{folder}/{name}.parquet")
    runs, batches = [], []
    read, ingest = silver.from_bronze, bronze.ingest_raw
    monkeypatch.setattr(silver, "from_bronze", lambda *a, **k: runs.append(a[3]) or batches.append(read(*a, **k)))
    monkeypatch.setattr(bronze, "ingest_raw", lambda *a, **k: runs.append(a[3]) or ingest(*a, **k))
    found = sorted(streams._silver(spark, folder).select("tx_id", "amount").collect(), key=str)
    # Once for each drop, and once more from a checkpoint that has seen nothing, over all rows of both drops.
    assert len(runs) == 6 and len(set(runs)) == 4
    assert [sum(b[0].values()) for b in batches] == [3, 4, 7]
    # The first order, corrected and new; the second, bad at first and then corrected and new (bad); the third, bad.
    assert [tuple(r) for r in found] == [("NEW-1", 5.0), ("NEW-2", None), ("TXN-1", 1.5), ("TXN-2", 1.5), ("TXN-2", None),
                                         ("TXN-3", -99.99)]


def test_a_failed_batch_is_repeated_whole(spark, folder, monkeypatch):
    job = Job(spark, folder, scratch_schema(spark, "fail"), file_format="json", merge_key="tx_id")
    land(folder, "a.json", '{"tx_id":"a","amount":1}\n{"tx_id":null,"amount":2}\n{"tx_id":"c","amount":0}\n')
    upsert = tables.upsert

    def broken(*args, **kwargs):
        upsert(*args, **kwargs)
        raise RuntimeError("lost right after the write")

    monkeypatch.setattr(tables, "upsert", broken)
    with pytest.raises(Exception, match="lost right after"):
        job.run()
    monkeypatch.setattr(tables, "upsert", upsert)
    job.run()
    assert job.good() == [("a", 1.0), (None, 2.0)]
    assert job.bad() == [("c", "amount > 0")]


def test_oversize_csv_over_many_batches(spark, folder):
    job = Job(spark, folder, scratch_schema(spark, "big"), file_format="csv", merge_key="tx_id", max_bytes=200,
              batch_bytes=1)
    expected = []
    for name, header in (("one", "tx_id,amount"), ("two", "amount,tx_id")):
        rows = [(f"{name}{i}", float(i + 1)) for i in range(300)]
        expected += rows
        land(folder, f"{name}.csv", header + "\n" + "\n".join(
            f"{k},{v}" if header.startswith("tx") else f"{v},{k}" for k, v in rows))
    land(folder, "small.csv", "amount,tx_id\n7,small\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        batches = job.run()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(batches) > 2
    assert job.good() == sorted([*expected, ("small", 7.0)], key=str) and job.bad() == []


def test_typed_files_skip_the_payload_detour(spark, folder):
    schema = scratch_schema(spark, "typed")
    spark.createDataFrame([("a", 1.0), ("b", -1.0)], "tx_id STRING, amount DOUBLE").write.parquet(
        f"{folder}/landing/p")
    spec = silver.SilverTable("tx", f"{schema}.tx", SCHEMA, "parquet", rules=["amount > 0"], merge_key="tx_id")
    done = silver.from_typed_files(spark, f"{folder}/landing", spec, f"{folder}/ck", timeout=300)
    assert done == [{"valid_rows": 1, "quarantined_rows": 1}]
    row = tables.read(spark, spec.target).first()
    assert (row.tx_id, row.tx_time) == ("a", None) and row.source_file.endswith(".parquet")


def test_typed_bronze_widens_and_old_rows_are_null(spark, folder):
    target = f"{scratch_schema(spark, 'widen')}.t"
    spark.createDataFrame([(1, "a")], "id INT, v STRING").write.parquet(f"{folder}/landing/p1")
    bronze.ingest_typed(spark, f"{folder}/landing", "id INT, v STRING", target, f"{folder}/ck", "typed", timeout=300)
    spark.createDataFrame([(2, "b", 3)], "id INT, v STRING, extra INT").write.parquet(f"{folder}/landing/p2")
    bronze.ingest_typed(spark, f"{folder}/landing", "id INT, v STRING, extra INT", target, f"{folder}/ck", "typed",
                        timeout=300)
    rows = tables.read(spark, target).select("id", "v", "extra").orderBy("id").collect()
    assert [tuple(r) for r in rows] == [(1, "a", None), (2, "b", 3)]


def test_unknown_formats_are_refused(spark):
    with pytest.raises(ValueError):
        silver.parsed(spark.sql("SELECT '' AS payload, 'xml' AS file_format"), silver.SilverTable("x", "x", SCHEMA, "xml"))


def test_a_stream_that_takes_too_long_is_stopped(spark, folder):
    land(folder, "a.json", "{}")
    with pytest.raises(TimeoutError):
        bronze.ingest_raw(spark, f"{folder}/landing", f"{scratch_schema(spark, 'slow')}.raw", f"{folder}/ck", "raw",
                          timeout=0.001)


def test_a_reader_of_one_format_opens_no_payload_of_another(spark, folder):
    job = Job(spark, folder, scratch_schema(spark, "parted"), file_format="json")
    land(folder, "a.json", '{"tx_id":"a","amount":1}\n')
    land(folder, "b.csv", "tx_id,amount\nx,5\n")
    land(folder, "no_extension", "text")
    assert job.run() == [{"valid_rows": 1, "quarantined_rows": 0}]
    raw = spark.table(job.raw)
    assert raw.count() == 3
    files = raw.select("file_format", F.input_file_name().alias("f")).collect()
    assert all(f"file_format={r.file_format}/" in r.f for r in files if r.file_format)
    scan = payload.of_format(raw, "json")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(file_format" in scan
    land(folder, "c.json", '{"tx_id":"c","amount":2}\n')
    land(folder, "d.csv", "tx_id,amount\ny,5\n")
    assert job.run() == [{"valid_rows": 1, "quarantined_rows": 0}]
    assert job.good() == [("a", 1.0), ("c", 2.0)] and spark.table(job.raw).count() == 5
