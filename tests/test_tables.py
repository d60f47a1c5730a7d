"""Merges and catalog tables."""

import pytest
from pyspark.sql import functions as F

from strata.operators import merge
from strata.queries.inputs import scratch_schema
from strata.sources import tables

SCHEMA = "id INT, v STRING, t INT"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def as_sorted(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=str)


def test_latest_wins_and_ties_are_stable(spark):
    df = frame(spark, (1, "a", 1), (1, "b", 2), (1, "c", 2), (2, None, None), (2, "z", None))
    assert as_sorted(merge.latest_per_key(df, "id", ["t"])) == [(1, "c", 2), (2, "z", None)]


def test_upsert_replaces_inserts_and_passes_null_keys(spark):
    target = frame(spark, (1, "old", 0), (2, "old", 0), (None, "old", 0))
    source = frame(spark, (2, "new", 1), (2, "newer", 2), (3, "new", 1), (None, "new", 1), (None, "new", 1))
    assert as_sorted(merge.upsert(target, source, "id", ["t"])) == as_sorted(frame(
        spark, (1, "old", 0), (2, "newer", 2), (3, "new", 1), (None, "old", 0), (None, "new", 1), (None, "new", 1)))


def test_upsert_keeps_columns_of_either_side(spark):
    target, source = frame(spark, (1, "old", 7), (2, "old", 8)), spark.createDataFrame([(1, "new")], "id INT, v STRING")
    merged = merge.upsert(target, source.withColumn("extra", F.lit("x")), "id")
    assert as_sorted(merged, "id", "v", "t", "extra") == [(1, "new", 7, "x"), (2, "old", 8, None)]


def test_map_columns_can_be_merged(spark):
    df = spark.sql("SELECT 1 AS id, map('a', 1) AS m, 2 AS t UNION ALL SELECT 1, map('b', 2), 3")
    assert merge.latest_per_key(df, "id", ["t"]).first().m == {"b": 2}


def test_upsert_table_touches_only_the_buckets_of_its_keys(spark):
    name = f"{scratch_schema(spark, 'buckets')}.t"
    tables.upsert(spark, frame(spark, *[(i, "a", 0) for i in range(64)]), name, "id", 0, buckets=16)
    before = {r.f: r.p for r in spark.table(name).select(F.input_file_name().alias("f"), F.col("_part").alias("p"))
              .distinct().collect()}
    tables.upsert(spark, frame(spark, (5, "b", 1)), name, "id", 1)
    after = {r.f: r.p for r in spark.table(name).select(F.input_file_name().alias("f"), F.col("_part").alias("p"))
             .distinct().collect()}
    changed = {after[f] for f in set(after) - set(before)}
    assert len(changed) == 1
    assert as_sorted(tables.read(spark, name).filter("v = 'b'")) == [(5, "b", 1)]
    assert tables.read(spark, name).count() == 64


def test_replayed_batches_change_nothing_even_without_keys(spark):
    name = f"{scratch_schema(spark, 'replay')}.t"
    batch = frame(spark, (1, "a", 0), (None, "n", 0), (None, "n", 0))
    for batch_id in (0, 1, 1, 1):
        tables.upsert(spark, batch, name, "id", batch_id, buckets=4)
    assert as_sorted(tables.read(spark, name)) == as_sorted(frame(spark, (1, "a", 0), *[(None, "n", 0)] * 4))
    plain = f"{name}_plain"
    for batch_id, writer in ((0, "x"), (0, "x"), (1, "x"), (0, "y")):
        tables.append_batch(spark, batch, plain, batch_id, writer)
    assert tables.read(spark, plain).count() == 9
    assert tables.batch_part(2**31 - 1, "x") > -(2**63) and tables.batch_part(0) == -1


def test_an_upsert_rewrites_only_the_files_of_its_keys(spark):
    # 100,000 keys that came in ten batches; 500 keys of one of them, and 50 new ones.
    name = f"{scratch_schema(spark, 'runs')}.t"
    for batch_id in range(10):
        rows = spark.range(batch_id * 10_000, (batch_id + 1) * 10_000).selectExpr("id", "'a' AS v", "0 AS t")
        tables.upsert(spark, rows, name, "id", batch_id, buckets=4, run_rows=1000)
    before = _files(spark, name)
    assert spark.table(name).groupBy("_part").count().agg(F.max("count")).first()[0] < 2000
    changes = spark.range(30_000, 30_500).union(spark.range(100_000, 100_050)).selectExpr("id", "'b' AS v", "1 AS t")
    tables.upsert(spark, changes, name, "id", 10, run_rows=1000)
    after = _files(spark, name)
    assert len(before) > 80 and len(before & after) > 0.8 * len(before)
    found = tables.read(spark, name)
    assert found.count() == 100_050 and found.filter("v = 'b'").count() == 550
    assert found.select("id").distinct().count() == 100_050


def test_growing_divides_only_the_buckets_that_split(spark, monkeypatch):
    name = f"{scratch_schema(spark, 'grow')}.t"
    rows = spark.range(400).selectExpr("id", "'a' AS v", "0 AS t")
    tables.upsert(spark, rows, name, "id", 0, buckets=4, run_rows=60)
    before = _files(spark, name)
    tables.grow(spark, name, "id", 5)
    assert tables.bucket_counts(spark, name) == (5, 4)
    assert 0.5 * len(before) < len(before & _files(spark, name)) < len(before)
    # A driver lost amid a growth: the next upsert brings it to its end.
    with monkeypatch.context() as patch:
        patch.setattr(tables, "overwrite_parts", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            tables.grow(spark, name, "id", 11)
    tables.upsert(spark, rows.filter("id % 2 = 0").union(spark.range(400, 450).selectExpr("id", "'a'", "0")), name, "id", 1)
    assert tables.bucket_counts(spark, name) == (11, 4)
    found = spark.table(name)
    assert found.count() == 450 and found.select("id").distinct().count() == 450
    assert found.filter(F.col("_part") % tables.RUN != tables._bucket("id", 11, 4)).count() == 0
    with pytest.raises(ValueError, match="cannot be brought"):
        tables.grow(spark, name, "id", 3)


def test_tables_widen(spark):
    schema = scratch_schema(spark, "widen")
    tables.append(spark, frame(spark, (1, "a", 0)), f"{schema}.a")
    tables.append(spark, spark.createDataFrame([("x", 2)], "extra STRING, id INT"), f"{schema}.a")
    assert as_sorted(tables.read(spark, f"{schema}.a")) == [(1, "a", 0, None), (2, None, None, "x")]
    tables.upsert(spark, frame(spark, (1, "a", 5)), f"{schema}.u", "id", 0, buckets=2)
    tables.upsert(spark, spark.createDataFrame([(1, "b", "x")], "id INT, v STRING, extra STRING"), f"{schema}.u",
                  "id", 1)
    assert as_sorted(tables.read(spark, f"{schema}.u"), "id", "v", "t", "extra") == [(1, "b", 5, "x")]


def test_replace_swaps_versions_and_shapes(spark):
    name = f"{scratch_schema(spark, 'swap')}.t"
    tables.replace(spark, frame(spark, (1, "a", 0)), name)
    first = tables._location(spark, name)
    tables.replace(spark, frame(spark, (2, "b", 0)), name, cluster_by=["id"])
    assert tables._location(spark, name) != first
    assert as_sorted(spark.table(name)) == [(2, "b", 0)]
    # A new version may be computed from the table itself.
    tables.replace(spark, tables.read(spark, name).withColumn("w", F.lit(1)), name)
    assert as_sorted(spark.table(name)) == [(2, "b", 0, 1)]
    tables.drop(spark, name)
    assert not tables.exists(spark, name)


def test_replace_takes_over_a_managed_table(spark):
    name = f"{scratch_schema(spark, 'managed')}.t"
    frame(spark, (1, "a", 0)).write.saveAsTable(name)
    tables.replace(spark, frame(spark, (2, "b", 0)), name)
    assert as_sorted(spark.table(name)) == [(2, "b", 0)]


def test_clustering_spreads_a_hot_value(spark, folder):
    df = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.write_clustered(df, f"{folder}/c", ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    back = spark.read.parquet(f"{folder}/c")
    files = back.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), F.min("k"), F.max("k")).collect()
    assert back.count() == 200_000
    assert max(f.n for f in files) < 200_000 / len(files) * 1.6
    assert sum(f["min(k)"] <= 7 <= f["max(k)"] for f in files) >= 3
    assert sum(f["min(k)"] <= 500 <= f["max(k)"] for f in files) == 1


def test_interleaved_clustering_serves_every_column(spark, folder):
    df = spark.range(100_000).select(
        F.concat(F.lit("customer-"), F.pmod(F.xxhash64("id"), F.lit(977)).cast("string")).alias("c"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.hash("id"), F.lit(365)).cast("int")).alias("d"),
        F.col("id").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    shares = {}
    try:
        for interleave in (False, True):
            path = f"{folder}/{interleave}"
            tables.write_clustered(df, path, ["c", "d"], interleave)
            back = spark.read.parquet(path)
            assert back.columns == ["c", "d", "v"] and back.count() == 100_000
            files = back.groupBy(F.input_file_name()).agg(
                F.min("c"), F.max("c"), F.min("d").cast("string"), F.max("d").cast("string")).collect()
            shares[interleave] = [sum(f[1] <= "customer-500" <= f[2] for f in files) / len(files),
                                  sum(f[3] <= "2024-06-01" <= f[4] for f in files) / len(files)]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert shares[False][1] > 0.9
    assert max(shares[True]) < 0.4


def test_interleaving_accepts_all_types_and_nulls(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, 'a', DATE'2024-01-01', TIMESTAMP_NTZ'2024-01-01 00:00:00', 1.5),
                      (NULL, NULL, NULL, NULL, NULL) AS t(a, b, c, d, e)""")
    assert tables.clustered(df, ["a", "b", "c", "d", "e"], interleave=True).count() == 2
    assert tables.clustered(df.filter("false"), ["a", "b"], interleave=True).count() == 0


@pytest.mark.parametrize("batches", [3])
def test_upserts_agree_with_a_dictionary(spark, batches):
    import random
    rng, state, loose = random.Random(3), {}, 0
    name = f"{scratch_schema(spark, 'model')}.t"
    for batch_id in range(batches):
        rows = [(rng.choice([None, *range(40)]), rng.choice("abc"), rng.randint(0, 9)) for _ in range(60)]
        best = {}
        for row in rows:
            if row[0] is None:
                loose += 1
            elif row[0] not in best or (row[2], row[1]) > (best[row[0]][2], best[row[0]][1]):
                best[row[0]] = row
        # A stored row that is later by t stays, whichever batch it came in; at a tie the new one wins.
        state.update({k: row for k, row in best.items() if k not in state or row[2] >= state[k][2]})
        tables.upsert(spark, frame(spark, *rows), name, "id", batch_id, ["t"], buckets=5)
    found = tables.read(spark, name)
    assert as_sorted(found.dropna(subset=["id"])) == sorted(state.values(), key=str)
    assert found.filter("id IS NULL").count() == loose


def test_lossy_appends_are_refused_and_nested_names_quoted(spark):
    from strata.queries.inputs import scratch_schema
    name = f"{scratch_schema(spark, 'lossy')}.t"
    tables.append(spark, spark.sql("SELECT 1 AS a, named_struct('x-y', 2) AS s"), name)
    with pytest.raises(ValueError, match="without loss"):
        tables.append(spark, spark.sql("SELECT 1.9D AS a, named_struct('x-y', 2) AS s"), name)
    tables.append(spark, spark.sql("SELECT CAST(7 AS SMALLINT) AS a"), name)
    assert sorted(r.a for r in tables.read(spark, name).collect()) == [1, 7]


def test_too_many_interleaved_columns_are_refused(spark):
    df = spark.range(3).selectExpr(*[f"id AS c{k}" for k in range(13)])
    with pytest.raises(ValueError, match="at most 12"):
        tables.clustered(df, df.columns, interleave=True)


def _files(spark, name):
    return {r[0] for r in spark.table(name).select(F.input_file_name()).distinct().collect()}


def test_a_driver_lost_amid_an_upsert_loses_no_row(spark, monkeypatch):
    name = f"{scratch_schema(spark, 'crash')}.t"
    tables.upsert(spark, frame(spark, *[(i, "a", 0) for i in range(60)], (None, "n", 0)), name, "id", 0, buckets=8)
    batch = frame(spark, *[(i, "b", 1) for i in range(0, 80, 3)], (None, "m", 0))
    expected = sorted([(i, "b", 1) for i in range(0, 80, 3)] + [(i, "a", 0) for i in range(60) if i % 3]
                      + [(None, "n", 0), (None, "m", 0)], key=str)
    session = type(spark)
    run = session.sql
    for allowed in (0, 2, 4, 6):
        done = []

        def failing(self, text, *args, **kwargs):
            if text.startswith("ALTER TABLE") and ("SET LOCATION" in text or " ADD PARTITION" in text):
                if len(done) == allowed:
                    raise RuntimeError("lost")
                done.append(text)
            return run(self, text, *args, **kwargs)

        monkeypatch.setattr(session, "sql", failing)
        with pytest.raises(RuntimeError, match="lost"):
            tables.upsert(spark, batch, name, "id", 1)
        monkeypatch.setattr(session, "sql", run)
        # Every row is there, old or new; NULL keys and new ids may be missing until the replay.
        assert {r.id for r in tables.read(spark, name).collect()} >= set(range(60))
    tables.upsert(spark, batch, name, "id", 1)
    assert as_sorted(tables.read(spark, name)) == expected


def test_old_versions_are_bounded(spark):
    import os
    schema = scratch_schema(spark, "bounded")
    for batch_id in range(5):
        tables.upsert(spark, frame(spark, (1, str(batch_id), 0)), f"{schema}.u", "id", batch_id, buckets=4)
        tables.replace(spark, frame(spark, (1, str(batch_id), 0)), f"{schema}.r")
    assert as_sorted(tables.read(spark, f"{schema}.u")) == as_sorted(spark.table(f"{schema}.r")) == [(1, "4", 0)]
    root = tables._location(spark, f"{schema}.u").removeprefix("file:")
    assert sum(len([d for d in dirs if d.startswith("_part=")]) for _, dirs, _ in os.walk(root)) == 2
    root = os.path.dirname(tables._location(spark, f"{schema}.r").removeprefix("file:"))
    assert len(os.listdir(root)) == 2


def test_merge_tables_are_clustered_within_their_parts(spark):
    name = f"{scratch_schema(spark, 'ranges')}.t"
    df = spark.range(40_000).select("id", F.pmod(F.xxhash64("id"), F.lit(1000)).alias("c"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        tables.upsert(spark, df, name, "id", buckets=2, cluster_by=["c"])
        tables.append_batch(spark, df, f"{name}_loose", 0, cluster_by=["c"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for table, least in ((name, 4), (f"{name}_loose", 4)):
        files = spark.table(table).groupBy(F.input_file_name()).agg(F.min("c"), F.max("c")).collect()
        assert len(files) >= least and sum(f[1] <= 500 <= f[2] for f in files) <= len(files) / 2
        assert tables.read(spark, table).count() == 40_000


def test_many_batches_fold_into_few_partitions(spark):
    from strata.queries.inputs import scratch_schema
    name = f"{scratch_schema(spark, 'fold')}.t"
    batch = lambda b: spark.range(b * 10, b * 10 + 10).selectExpr("id", f"{b} AS b")
    for b in range(20):
        tables.append_batch(spark, batch(b), name, b, "it's")
    tables.append_batch(spark, batch(500), name, 5, "other")
    assert tables.fold(spark, name, "it's", rows=100) == 17     # 19 batches in two partitions; the newest stays
    assert len(tables._parts(spark, name)) == 4
    ids = lambda: sorted(r.id for r in tables.read(spark, name).collect())
    expected = [*range(200), *range(5000, 5010)]
    assert ids() == expected
    for b in (0, 17, 19):
        tables.append_batch(spark, batch(b), name, b, "it's")
    assert ids() == expected
    tables.append_batch(spark, batch(20), name, 20, "it's")
    assert tables.fold(spark, name, "it's", rows=10_000) == 2 and len(tables._parts(spark, name)) == 3
    assert ids() == sorted([*expected, *range(200, 210)])
    assert tables._folded(spark, name) == {"it's": ["0-19"]}


def test_a_lost_fold_is_finished_by_the_next_append(spark, monkeypatch):
    from strata.queries.inputs import scratch_schema
    name = f"{scratch_schema(spark, 'lost')}.t"
    for b in range(4):
        tables.append_batch(spark, spark.range(b, b + 1), name, b)
    plain = tables._finish_folding
    calls = []

    def lost(session, table):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return plain(session, table)

    monkeypatch.setattr(tables, "_finish_folding", lost)
    with pytest.raises(RuntimeError):
        tables.fold(spark, name)
    monkeypatch.setattr(tables, "_finish_folding", plain)
    assert sorted(r.id for r in tables.read(spark, name).collect()) == [0, 1, 2, 3]
    tables.append_batch(spark, spark.range(1, 2), name, 1)
    assert sorted(r.id for r in tables.read(spark, name).collect()) == [0, 1, 2, 3]
    assert len(tables._parts(spark, name)) == 2


def test_a_write_of_many_runs_lists_old_versions_once(spark, monkeypatch):
    # Each rewrite of a run retires its older folders; one listing serves all runs of the write, not one per run.
    name = f"{scratch_schema(spark, 'retire')}.t"
    rows = spark.range(0, 3000).selectExpr("id", "'a' AS v", "0 AS t")
    tables.upsert(spark, rows, name, "id", 0, buckets=2, run_rows=100)
    calls = []
    monkeypatch.setattr(tables, "_retire", lambda s, pattern: calls.append(pattern))
    for batch_id, v in ((1, "b"), (2, "c"), (3, "d")):
        tables.upsert(spark, rows.selectExpr("id", f"'{v}' AS v", "1 AS t"), name, "id", batch_id, run_rows=100)
    assert calls == []
    root = f"{tables._location(spark, name).rstrip('/')}/_batches"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/*/_part=*")
    found = [s.getPath().getName() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)]
    parts = {p for p in found}
    assert len(parts) > 20 and all(found.count(p) == tables.KEPT_VERSIONS for p in parts)
    result = tables.read(spark, name)
    assert result.count() == 3000 and result.filter("v = 'd'").count() == 3000


def test_upsert_joins_never_broadcast_the_batch(spark, folder):
    # The keys of a batch and of the table grow with the input: a broadcast of them fails at size. Read from Parquet,
    # as tables are, small frames have sizes that would let Spark plan a broadcast.
    from strata.sources.tables import _hit_counts

    def stored(rows, schema, name):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    keys = stored([(0, 1), (0, 2), (1, 3)], "_at long, k long", "keys")
    latest = stored([(1, 5), (4, 6)], "k long, t long", "latest")
    target = stored([(1, 7), (3, 1)], "k long, t long", "target")
    for df in (_hit_counts(keys, latest, "k"), merge.later_rows(target, latest, "k", ["t"], "source")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan, plan
    assert sorted(map(tuple, _hit_counts(keys, latest, "k").collect())) == [(0, 2, 1), (1, 1, 0)]
    assert [r.k for r in merge.later_rows(target, latest, "k", ["t"], "source").collect()] == [1]


def test_many_small_runs_are_read_and_written_by_tasks_of_their_own_number(spark, monkeypatch):
    # Some 200 runs of a few rows: as AQE goes by bytes, one task wrote a file for each of them.
    name = f"{scratch_schema(spark, 'runs')}.t"
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit(0).alias("v"))
    tables.upsert(spark, rows, name, "k", 0, buckets=2, run_rows=5)
    tables.upsert(spark, rows.filter("k % 2 = 0").withColumn("v", F.lit(1)), name, "k", 1, run_rows=5)
    files = [f.rsplit("/", 3)[1:] for f in spark.table(name).inputFiles()]
    newest = max(batch for batch, _, _ in files)
    tasks = {file.split("-")[1] for batch, _, file in files if batch == newest}
    assert len(files) > 100 and len(tasks) > 5
    assert tables.read(spark, name).groupBy((F.col("k") % 2).alias("odd"), "v").count().orderBy("odd").collect() == [
        (0, 1, 500), (1, 0, 500)]
    scan = spark.table(name).filter(tables._among(tables._parts(spark, name)))
    with monkeypatch.context() as patch:
        patch.setattr(tables, "READ_BYTES", 1)
        assert tables._packed(scan, 200).rdd.getNumPartitions() == scan.rdd.getNumPartitions()
    assert tables._packed(scan, 200).rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
