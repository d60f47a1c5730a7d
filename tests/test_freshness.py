"""Merged lag sketches against exact ranks."""

import datetime
import random

from pyspark.sql import functions as F

from strata.operators import freshness

BASE = datetime.datetime(2024, 1, 1)


def rows_of(n, seed):
    rng = random.Random(seed)
    return [(rng.choice("ab"), BASE, BASE + datetime.timedelta(milliseconds=int(rng.lognormvariate(8, 2)) - 500)) for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "g STRING, at TIMESTAMP_NTZ, come TIMESTAMP_NTZ")


def test_ranks_of_many_merged_batches(spark):
    batches = [rows_of(700, seed) for seed in range(12)]
    sketches = [freshness.sketch_lags(frame(spark, b), "at", "come", ["g"]) for b in batches]
    # Merged by threes first: merges of merges.
    halves = []
    for k in range(0, 12, 3):
        part = sketches[k].union(sketches[k + 1]).union(sketches[k + 2])
        halves.append(freshness.merge_sketches(part, ["g"]))
    whole = halves[0].union(halves[1]).union(halves[2]).union(halves[3])
    lags = {g: sorted((c - a) // datetime.timedelta(milliseconds=1) for b in batches for h, a, c in b if h == g) for g in "ab"}
    found = freshness.quantiles(whole, ["g"], [0.0, 0.5, 0.9, 0.99, 1.0]).collect()
    assert len(found) == 10
    for r in found:
        exact, n = lags[r.g], len(lags[r.g])
        assert (r.rows, r.known, r.least, r.greatest) == (n, n, exact[0], exact[-1])
        assert sum(x < r.lag for x in exact) / n <= r["rank"] + 0.01
        assert sum(x <= r.lag for x in exact) / n >= r["rank"] - 0.01
    for limit in (-10_000, 0, 3000, 10 ** 9):
        for r in freshness.within(whole, limit, ["g"]).collect():
            exact = lags[r.g]
            assert abs(r.share - sum(x <= limit for x in exact) / len(exact)) <= 0.01


def test_groups_without_times_and_no_rows(spark):
    rows = frame(spark, [("a", None, BASE), ("a", BASE, None), ("b", BASE, BASE)])
    found = {r.g: r for r in freshness.quantiles(freshness.sketch_lags(rows, "at", "come", ["g"]), ["g"], [0.5]).collect()}
    assert (found["a"].rows, found["a"].known, found["a"].lag, found["b"].lag) == (2, 0, None, 0)
    none = freshness.sketch_lags(rows.limit(0), "at", F.current_timestamp(), ["g"])
    assert freshness.quantiles(none, ["g"]).collect() == []
    whole = freshness.quantiles(freshness.sketch_lags(rows.limit(0), "at", "come"), (), [0.5]).collect()
    assert [(r.rows, r.lag) for r in whole] == [(0, None)]
