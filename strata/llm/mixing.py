"""Mixing sources to target weights by a low-discrepancy schedule, in DataFrame operations only.

The mix is a sequence of slots of equal tokens. Slot i stands at the golden-ratio point frac((i + 1/2) * phi); the point
is mapped through the cumulative target shares to a source, so every stretch of the schedule has each source close to
its share. The k-th slot of a source takes its k-th block of tokens from the source's documents, shuffled by a hash and
laid end to end (again from the start when a source is used more than once). A source's blocks have equal size: its
target divided by its slots.

Targets: all tokens are shared out by weight; no source gets more than ``most`` times its size, and what is over goes to
the others by weight (water filling, solved in closed form over the sorted ratios of cap and weight).

Nothing is gathered in one task: positions in a source, and the ranks of slots, are running sums in two levels (sums per
bucket, then within the bucket), so that a source with a third of all rows is spread over its buckets. Points meet
shares by an equality join on cells of the unit interval.

Edge cases: null and empty texts have size 0 and are not taken; a null source is a source of its own, last in order;
repeated rows are documents of their own; a source without tokens has target 0; an empty table has an empty schedule;
ties in the shuffle are broken by id and size (equal ones are interchangeable).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from strata.llm.components import stored
from strata.llm.frames import col

GOLDEN = 0.6180339887498949  # (sqrt 5 - 1) / 2
SLOT_TOKENS = 512
WEIGHTS = (5, 2, 1)
MOST = 3
CELLS = 1024
BUCKET_ROWS = 4096
SLOT_BUCKET = 1 << 14


def size_of(text: Column) -> Column:
    """Number of words that are separated by ASCII white space (space, tab to carriage return); null: 0."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]++")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source, source_size, weight, target, share_from, share_to`` from one row per source (nulls last).

    The source table holds one row per source; its windows are over that table alone.
    """
    everything = W.orderBy(F.col("source").asc_nulls_last())
    table = F.array(*map(F.lit, weights))
    weighed = sizes.withColumn("weight", F.get(table, (F.row_number().over(everything) - 1) % len(weights)))
    capped = F.lit(most) * F.col("source_size")
    rising = W.orderBy((capped / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before, rest = rising.rowsBetween(W.unboundedPreceding, -1), rising.rowsBetween(0, W.unboundedFollowing)
    whole = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    # Level if this source and all with a larger ratio were uncapped. It rises up to the first source that stays below
    # its cap and falls from there on, so the greatest that fits is the level of the mix.
    level = (F.sum("source_size").over(whole) - F.coalesce(F.sum(capped).over(before), F.lit(0))) / F.sum(
        "weight").over(rest)
    tried = weighed.withColumn("level", level).withColumn("fits", F.col("level") * F.col("weight") <= capped)
    solved = tried.withColumn("at", F.max(F.when(F.col("fits"), F.col("level"))).over(whole))
    aimed = solved.withColumn("target", F.least(F.coalesce(F.col("at") * F.col("weight"), capped.cast("double")),
                                                capped.cast("double")))
    total = F.sum("target").over(whole)
    upto = F.sum("target").over(everything.rowsBetween(W.unboundedPreceding, 0))
    return aimed.select("source", "source_size", "weight", "target",
                        F.coalesce(F.try_divide(upto - F.col("target"), total), F.lit(0.0)).alias("share_from"),
                        F.coalesce(F.try_divide(upto, total), F.lit(0.0)).alias("share_to"))


def schedule(aims: DataFrame, slot_tokens: int = SLOT_TOKENS) -> DataFrame:
    """``slot, source, rank``: which source each slot takes from, and the how-manieth of that source it is (from 0).

    Sources that have a target but are too small for a slot get one after all others.
    """
    spark = aims.sparkSession
    total = aims.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first().n
    n = -(-total // slot_tokens)
    cells = aims.filter("share_to > share_from").withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("share_from") * CELLS), F.least(F.floor(F.col("share_to") * CELLS), F.lit(CELLS - 1)))))
    x = (F.col("id") + 0.5) * GOLDEN
    points = spark.range(n).select(F.col("id").alias("slot"), (x - F.floor(x)).alias("point"))
    points = points.withColumn("cell", F.least(F.floor(F.col("point") * CELLS), F.lit(CELLS - 1)))
    # The last source takes what rounding leaves above its end.
    last = aims.agg(F.max("share_to").alias("m")).first().m
    placed = points.join(cells, "cell").filter(
        (F.col("point") >= F.col("share_from")) & ((F.col("point") < F.col("share_to")) | (F.col("share_to") >= (last or 0.0)))
    ).select("slot", "source", F.floor(F.col("slot") / SLOT_BUCKET).alias("part"))
    none = aims.filter("target >= 0.5").join(placed.select(F.col("source").alias("s")).distinct(),
                                             F.col("source").eqNullSafe(F.col("s")), "left_anti")
    order = W.orderBy(F.col("source").asc_nulls_last())
    late = none.select((F.row_number().over(order) + (n - 1)).cast("long").alias("slot"), "source").withColumn(
        "part", F.lit(n // SLOT_BUCKET + 1).cast("long"))
    placed = placed.unionByName(late)
    counts = placed.groupBy("source", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(W.partitionBy("source").orderBy("part")) - F.col("n")
    within = F.row_number().over(W.partitionBy("source", "part").orderBy("slot"))
    counts = counts.select(F.col("source").alias("s"), F.col("part").alias("p"), before.alias("before"))
    return placed.withColumn("k", within).join(
        counts, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))).select(
        "slot", "source", (F.col("before") + F.col("k") - 1).alias("rank"))


def laid_out(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """Add ``begin``: tokens of the source before the document, in shuffled order, and the columns of its source's plan.

    ``docs``: ``doc_id, source, size``. ``plan``: one row per source, named ``s``; it is joined to the bucket sums, so
    documents meet it by source and bucket, and a source with a third of all rows stays spread.
    """
    # A bucket holds some thousand documents: their number follows the input.
    buckets = max(16, docs.count() // BUCKET_ROWS)
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    rows = docs.withColumn("key", key).withColumn(
        "bucket", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("long") * buckets / F.lit(1 << 32)))
    sums = rows.groupBy("source", "bucket").agg(F.sum("size").alias("n"))
    before = F.sum("n").over(W.partitionBy("source").orderBy("bucket")) - F.col("n")
    sums = sums.withColumn("before", before).join(plan, F.col("source").eqNullSafe(F.col("s"))).drop(
        "source", "n").withColumnRenamed("bucket", "b")
    order = W.partitionBy("source", "bucket").orderBy("key", F.col("doc_id").asc_nulls_last(), "size")
    within = F.sum("size").over(order.rowsBetween(W.unboundedPreceding, 0)) - F.col("size")
    return rows.withColumn("within", within).join(
        sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b"))).withColumn(
        "begin", F.col("before") + F.col("within")).drop("key", "bucket", "within", "s", "b", "before")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, slot_tokens: int = SLOT_TOKENS,
        text: str = "text", source: str = "source", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """The documents with their place in the mix, and the pieces of which the mix is made.

    First: ``doc_id, source, size, source_size, target, begin``. Second: ``slot, source, rank, begin, size, doc_id,
    piece``: in slot order, ``piece`` tokens of a document (a row per slot and document it meets).
    """
    rows = docs.select(col(doc_id).alias("doc_id"), col(source).alias("source"), size_of(col(text)).alias("size"))
    rows = stored(rows, "sizes")  # texts are read once; all else is about ids and sizes
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = targets(sizes, weights, most)
    slots = schedule(aims, slot_tokens)
    used = slots.groupBy("source").agg(F.count("*").alias("slots"))
    plan = aims.join(used.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    plan = plan.withColumn("take", F.round("target").cast("long")).select(
        F.col("source").alias("s"), "source_size", "target", "slots", "take")
    placed = laid_out(rows, plan)
    z, begin, size = F.col("source_size"), F.col("begin"), F.col("size")
    # Blocks: the first r have q + 1 tokens, the others q.
    q, r = F.expr("take div slots"), F.expr("take % slots")
    wide = r * (q + 1)
    block = lambda x: F.when(x < wide, F.floor(x / (q + 1))).otherwise(r + F.floor((x - wide) / F.greatest(q, F.lit(1))))
    start = lambda k: k * q + F.least(k, r)
    rounds = F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("round")
    laid = placed.filter("size > 0 AND slots > 0").select("*", rounds).withColumn(
        "from", F.col("round") * z + begin).withColumn("to", F.least(F.col("from") + size, F.col("take")))
    laid = laid.filter(F.col("from") < F.col("to")).withColumns(
        {"b0": block(F.col("from")).cast("long"), "b1": block(F.col("to") - 1).cast("long")})
    pieces = laid.withColumn("rank", F.explode(F.sequence("b0", "b1"))).withColumn(
        "piece", F.least("to", start(F.col("rank") + 1)) - F.greatest("from", start(F.col("rank"))))
    slots = slots.select("slot", F.col("source").alias("s"), F.col("rank").alias("r"))
    pieces = pieces.join(slots, F.col("source").eqNullSafe(F.col("s")) & (F.col("rank") == F.col("r"))).select(
        "slot", "source", "rank", "begin", "size", "doc_id", "piece")
    return placed.select("doc_id", "source", "size", "source_size", "target", "begin"), pieces


def taken(docs: DataFrame, **options) -> DataFrame:
    """``doc_id, size, source_size, target, taken``: what the mix takes of each document, repeats counted."""
    placed, pieces = mix(docs, **options)
    # Begin tells the documents of a source apart, whatever their ids; those of size 0 are in no piece.
    sums = pieces.groupBy(F.col("source").alias("s"), F.col("begin").alias("b")).agg(F.sum("piece").alias("taken"))
    found = placed.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("begin") == F.col("b"))
                        & (F.col("size") > 0), "left")
    return found.select("doc_id", "source", "size", "source_size", "target",
                        F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
