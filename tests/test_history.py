"""Neighbours, versions and lookups against a plain in-memory model."""

import datetime
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strata.operators import history
from strata.operators.adjacent import adjacent, chunked, last_known

BASE = datetime.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def feed():
    """One key holds over half of all rows; one key is NULL; values may be NULL; some chunks are empty."""
    rng = random.Random(11)
    rows = []
    for i in range(900):
        key = rng.choice([1, 1, 1, 2, 3, None])
        hour = rng.choice([rng.randint(0, 400), rng.randint(0, 30)])
        rows.append((key, BASE + datetime.timedelta(hours=hour), i, rng.choice(["a", "b", None])))
    return rows


@pytest.fixture(scope="module")
def events(spark, feed):
    return spark.createDataFrame(feed, "k INT, ts TIMESTAMP_NTZ, id INT, v STRING").repartition(5)


def by_key(feed):
    groups = {}
    for row in sorted(feed, key=lambda r: (r[1], r[2])):
        groups.setdefault(row[0], []).append(row)
    return groups


@pytest.mark.parametrize("unit", ["hour", "day", "year"])
@pytest.mark.parametrize("ahead", [False, True])
def test_adjacent_equals_the_plain_window(events, unit, ahead):
    w = Window.partitionBy("k").orderBy("ts", "id")
    plain = events.withColumn("p", (F.lead if ahead else F.lag)("v").over(w))
    chunked = adjacent(events, ["k"], ["ts", "id"], F.col("v"), "p", ahead, unit)
    assert chunked.columns == plain.columns
    assert sorted(map(str, chunked.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("unit", ["hour", "day", "year"])
def test_last_known_equals_the_plain_window(events, unit):
    w = Window.partitionBy("k").orderBy("ts", "id")
    plain = events.withColumn("p", F.last("v", ignorenulls=True).over(w))
    chunked = last_known(events, ["k"], ["ts", "id"], F.col("v"), "p", unit)
    assert sorted(map(str, chunked.collect())) == sorted(map(str, plain.collect()))


@pytest.mark.parametrize("chunk_rows", [7, 100, 10_000])
def test_chunks_by_count_equal_the_plain_window(events, feed, chunk_rows):
    w = Window.partitionBy("k").orderBy("ts", "id")
    text = lambda df: sorted(map(str, df.collect()))
    for ahead in (False, True):
        plain = events.withColumn("p", (F.lead if ahead else F.lag)("v").over(w))
        assert text(adjacent(events, ["k"], ["ts", "id"], F.col("v"), "p", ahead, chunk_rows=chunk_rows)) == text(plain)
    plain = events.withColumn("p", F.last("v", ignorenulls=True).over(w))
    assert text(last_known(events, ["k"], ["ts", "id"], F.col("v"), "p", chunk_rows=chunk_rows)) == text(plain)
    rows = [tuple(r) for r in history.scd2(events, ["k"], ["v"], ["ts", "id"], chunk_rows=chunk_rows).collect()]
    assert sorted(rows, key=str) == sorted(versions(feed), key=str)


def test_a_busy_instant_is_cut_at_equal_counts(spark):
    # One key, one instant, a million rows: many chunks of like size, and the versions of a plain window.
    rows = spark.range(1_000_000).select(F.lit(1).alias("k"), F.lit(BASE).cast("timestamp_ntz").alias("ts"), "id",
                                         F.expr("id div 1000").alias("v"))
    cut, several = chunked(rows, ["k"], ["ts", "id"], chunk_rows=50_000)
    sizes = [r["count"] for r in cut.groupBy("_chunk").count().collect()]
    assert several and len(sizes) >= 15 and sum(sizes) == 1_000_000 and max(sizes) < 150_000
    found = history.scd2(rows, ["k"], ["v"], ["ts", "id"], chunk_rows=50_000)
    assert found.count() == 1000 and found.agg(F.min(F.expr("id = v * 1000"))).first()[0]


def versions(feed):
    found = []
    for key, rows in by_key(feed).items():
        opened = [r for i, r in enumerate(rows) if i == 0 or r[3] != rows[i - 1][3]]
        for i, r in enumerate(opened):
            found.append((key, r[3], r[1], r[2], opened[i + 1][1] if i + 1 < len(opened) else None))
    return found


def test_versions(events, feed):
    rows = [tuple(r) for r in history.scd2(events, ["k"], ["v"], ["ts", "id"]).collect()]
    assert sorted(rows, key=str) == sorted(versions(feed), key=str)


def test_batches_of_changes_in_any_order_give_the_same_history(spark, events, feed):
    # With all values tracked every event opens a version, so nothing is lost between batches.
    tracked = ["v", "n"]
    feed_n = events.withColumn("n", F.col("id")).filter("k IS NOT NULL")
    merged = history.scd2(feed_n.filter("id % 3 = 1"), ["k"], tracked, ["ts", "id"])
    for rest in (2, 0):
        merged = history.scd2_merge(merged, feed_n.filter(f"id % 3 = {rest} AND k <> 3"), ["k"], tracked, ["ts", "id"])
    expected = history.scd2(feed_n.filter("id % 3 = 1 OR k <> 3"), ["k"], tracked, ["ts", "id"])
    assert sorted(map(str, merged.collect())) == sorted(map(str, expected.collect()))


def test_state_at_an_instant(events, feed):
    instant = BASE + datetime.timedelta(hours=100)
    stored = history.scd2(events, ["k"], ["v"], ["ts", "id"])
    found = {r.k: r.v for r in history.state_at(stored, F.lit(instant).cast("timestamp_ntz")).collect()}
    expected = {k: [r for r in rows if r[1] <= instant][-1][3] for k, rows in by_key(feed).items()}
    assert found == expected


def test_lookup_as_of_each_fact(spark, events, feed):
    rng = random.Random(5)
    facts = [(i, rng.choice([1, 2, 3, None, 9]), BASE + datetime.timedelta(hours=rng.randint(-50, 500), minutes=30))
             for i in range(300)]
    df = spark.createDataFrame(facts, "fact INT, k INT, ts TIMESTAMP_NTZ")
    stored = history.scd2(events, ["k"], ["v"], ["ts", "id"])
    found = {r.fact: (r.k, r.v, r["__start_at"]) for r in history.as_of(
        df, stored, ["k"], "ts", ["v", "__start_at"], unit="day").collect()}
    all_versions = versions(feed)
    for fact, key, time in facts:
        hits = [v for v in all_versions if v[0] == key and v[2] <= time and (v[4] is None or v[4] > time)]
        assert len(hits) <= 1
        assert found[fact] == ((key, hits[0][1], hits[0][2]) if hits else (key, None, None))


def test_lookup_respects_closed_versions(spark):
    stored = spark.createDataFrame(
        [(1, "a", BASE, BASE + datetime.timedelta(hours=1))],
        "k INT, v STRING, __start_at TIMESTAMP_NTZ, __end_at TIMESTAMP_NTZ")
    facts = spark.createDataFrame([(1, BASE), (1, BASE + datetime.timedelta(hours=1))], "k INT, ts TIMESTAMP_NTZ")
    assert [r.v for r in history.as_of(facts, stored, ["k"], "ts", ["v"]).orderBy("ts").collect()] == ["a", None]


def test_a_stored_history_equals_the_full_rebuild(spark):
    import random

    from strata.queries.inputs import scratch_schema
    from strata.sources import history_tables, tables
    rng = random.Random(5)
    rows = [(rng.choice(["a", "b", None]), rng.choice("xy"), f"2024-01-0{rng.randint(1, 5)} 00:00:00", i)
            for i in range(60)]
    schema = "k STRING, s STRING, ts STRING, n INT"
    typed = lambda part: spark.createDataFrame(part, schema).withColumn("ts", F.col("ts").cast("timestamp"))
    name = f"{scratch_schema(spark, 'stored')}.h"
    rng.shuffle(rows)
    for part in (rows[:20], rows[20:45], rows[20:45], rows[45:], []):
        history_tables.merge(spark, typed(part), name, ["k"], ["s"], ["ts", "n"], buckets=3)
    found = tables.read(spark, name)
    full = history.scd2(typed(rows), ["k"], ["s"], ["ts", "n"]).select(found.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, full.collect()))


def _typed(spark, rows):
    schema = "k STRING, s STRING, ts STRING, n INT"
    return spark.createDataFrame(rows, schema).withColumn("ts", F.col("ts").cast("timestamp"))


@pytest.mark.parametrize("seed", range(2))
def test_late_changes_in_any_order_give_the_full_rebuild(spark, seed):
    from strata.queries.inputs import scratch_schema
    from strata.sources import history_tables, tables
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "a", "b", None]), rng.choice(["x", "y", None]),
             f"2024-{rng.randint(1, 12):02}-{rng.randint(1, 3):02} 00:00:00", i) for i in range(72)]
    rng.shuffle(rows)
    name = f"{scratch_schema(spark, 'late')}.h"
    for k in range(0, 72, 24):
        history_tables.merge(spark, _typed(spark, rows[k:k + 24]), name, ["k"], ["s"], ["ts", "n"], buckets=2)
        found = tables.read(spark, name)
        full = history.scd2(_typed(spark, rows[:k + 24]), ["k"], ["s"], ["ts", "n"]).select(found.columns)
        assert sorted(map(str, found.collect())) == sorted(map(str, full.collect()))
    assert tables.read(spark, history_tables.changes_of(name)).count() == 72


def test_a_late_change_reads_and_writes_its_neighbourhood_only(spark, monkeypatch):
    from strata.queries.inputs import scratch_schema
    from strata.sources import history_tables, tables
    rows = [(k, "xy"[i // 5 % 2], str(BASE + datetime.timedelta(days=i)), i) for k in "abcd" for i in range(400)]
    name = f"{scratch_schema(spark, 'near')}.h"
    history_tables.merge(spark, _typed(spark, rows), name, ["k"], ["s"], ["ts", "n"], buckets=2)
    files = lambda: {r[0] for r in spark.read.table(name).select("_metadata.file_path").distinct().collect()}
    before = files()
    read = []
    plain = history_tables.segment_changes

    def counted(*args):
        read.append(plain(*args))
        return read[-1]

    monkeypatch.setattr(history_tables, "segment_changes", counted)
    late = [("a", "z", str(BASE + datetime.timedelta(days=102, hours=5)), 1000)]
    history_tables.merge(spark, _typed(spark, late), name, ["k"], ["s"], ["ts", "n"])
    assert read[0].count() == 11     # the five changes of either neighbour, and the late one
    after = files()
    assert len(before - after) <= 2 < len(before & after)
    found = tables.read(spark, name)
    full = history.scd2(_typed(spark, rows + late), ["k"], ["s"], ["ts", "n"]).select(found.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, full.collect()))
    history_tables.merge(spark, _typed(spark, late), name, ["k"], ["s"], ["ts", "n"])
    assert len(read) == 1 and files() == after     # a replay finds nothing new


def test_a_history_half_written_is_completed_by_the_replay(spark, monkeypatch):
    from strata.queries.inputs import scratch_schema
    from strata.sources import history_tables, tables
    rows = [("a", "xy"[i // 40 % 2], str(BASE + datetime.timedelta(days=i)), i) for i in range(400)]
    # One interrupts a version, one brings two together across slices.
    late = [("a", "z", str(BASE + datetime.timedelta(days=50, hours=5)), 1000),
            ("a", "y", str(BASE + datetime.timedelta(days=119, hours=5)), 1001)]
    full = history.scd2(_typed(spark, rows + late), ["k"], ["s"], ["ts", "n"])
    plain = tables.overwrite_parts
    for lost in (lambda r: F.col("_part") < r, lambda r: F.col("_part") >= r):
        name = f"{scratch_schema(spark, 'half')}.h"
        history_tables.merge(spark, _typed(spark, rows), name, ["k"], ["s"], ["ts", "n"], buckets=1)

        def half(session, df, table):
            parts = sorted(r[0] for r in df.select("_part").distinct().collect())
            plain(session, df.filter(lost(parts[len(parts) // 2])), table)
            raise RuntimeError("lost")

        monkeypatch.setattr(tables, "overwrite_parts", half)
        with pytest.raises(RuntimeError):
            history_tables.merge(spark, _typed(spark, late), name, ["k"], ["s"], ["ts", "n"])
        monkeypatch.setattr(tables, "overwrite_parts", plain)
        history_tables.merge(spark, _typed(spark, late), name, ["k"], ["s"], ["ts", "n"])
        found = tables.read(spark, name)
        assert sorted(map(str, found.collect())) == sorted(map(str, full.select(found.columns).collect()))
