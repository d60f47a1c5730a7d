"""The prefix trie of conversations by van Emde Boas recursion.

Sequences are cut at half depth, the prefixes that end at the cut get names, the upper trie and the lower forests are
built alike and at the same time, and the totals of the lower forests are grafted onto the upper trie. Halves are halved
again. The halvings inside a piece of ``PIECE`` turns are done in memory, a piece at a time; above them whole pieces are
the symbols of a sequence that is cut in the same way. So a conversation of n turns takes log(n) / log(``PIECE``) rounds
of Spark jobs, and no task holds more of it than a piece, however long it is.

Names are SHA-256 digests: of role and text for a turn, of the names of the two parts for a sequence that was cut. All
sequences of one length are cut at the same places, so equal names mean equal sequences. Texts are read once and not moved.

A node belongs to its smallest member. A member's own nodes are the end of its path, so what lies below a node within a
forest is the own nodes of all its members there, less those of its smallest member above the node: sums that are
combined before the shuffle, where a node with very many members costs one row a task.

Edge cases: null roles and texts count as empty; null turns come first, turns that tie stand in the order of their
digests; rows without a conversation id belong to no conversation; repeated rows are turns of their own; an empty table
gives an empty result (there is no root without a member); other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.components import stored
from strata.llm.frames import col

PIECE = 64
SHARED_TURNS = 9
GROUP = 5
IDS = 1 << 16


def _digest(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


# --- sequences --------------------------------------------------------------------------------------------------------

def sequences(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """``conv_id, depth, symbol, n_bytes``: every turn by its place (from 1), its name and the bytes of its text.

    Turns are put in order by ranges of (conversation, turn), so a conversation of any length is spread over tasks; the
    places that a task counts are shifted by what the tasks before it hold of the same conversation.
    """
    who, said = F.coalesce(col(role), F.lit("")), F.coalesce(col(text), F.lit(""))
    turns = conversations.filter(col(conv_id).isNotNull()).select(
        col(conv_id).cast("long").alias("conv_id"), col(turn).alias("turn"),
        _digest(F.octet_length(who).cast("string").cast("binary"), F.lit(":").cast("binary"), who.cast("binary"),
                said.cast("binary")).alias("symbol"), F.octet_length(said).cast("long").alias("n_bytes"))
    order = ["conv_id", F.col("turn").asc_nulls_first(), "symbol"]
    ranged = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "symbol", "n_bytes")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, done = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            starts = np.concatenate([[0], np.flatnonzero(ids[1:] != ids[:-1]) + 1])
            before = np.zeros(len(starts), np.int64)
            before[0] = done if ids[0] == last else 0
            rank = np.arange(len(ids)) - np.repeat(starts - before, np.diff([*starts, len(ids)])) + 1
            last, done = ids[-1], int(rank[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(len(ids), part)), pa.array(rank)],
                                             ["conv_id", "symbol", "n_bytes", "part", "rank"])

    placed = stored(ranged.mapInArrow(number, "conv_id long, symbol binary, n_bytes long, part long, rank long"), "turns")
    runs = placed.groupBy("conv_id", "part").agg(F.max("rank").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # Only conversations that lie across a border of the ranges: a row or two for each border.
    shifts = runs.withColumn("shift", F.sum("n").over(earlier)).filter("shift > 0").select("conv_id", "part", "shift")
    return placed.join(shifts, ["conv_id", "part"], "left").select(
        "conv_id", (F.col("rank") + F.coalesce("shift", F.lit(0))).alias("depth"), "symbol", "n_bytes")


def crossed(conversations: DataFrame, group: int = GROUP, shared: int = SHARED_TURNS) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt to share beginnings: the first h turns of the conversation c - c % ``group``, then c's own
    after its first h, where h is the CRC-32 of c's digits modulo ``shared``. Returns the turns, as :func:`sequences`
    does, and the ids of all conversations (one may have no turns left)."""
    turns = stored(sequences(conversations), "places")
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared).alias("h")
    plans = sizes.select("conv_id", h, (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    given = sizes.select(F.col("conv_id").alias("base"), F.least("n", F.lit(shared - 1)).alias("given"))
    plans = stored(plans.join(given, "base", "left").withColumn("given", F.least("h", F.coalesce("given", F.lit(0)))), "plans")
    own = turns.join(plans.select("conv_id", "h", "given"), "conv_id").filter(F.col("depth") > F.col("h")).select(
        "conv_id", (F.col("depth") - F.col("h") + F.col("given")).alias("depth"), "symbol", "n_bytes")
    # At most shared - 1 turns of a base go to at most 2 * group - 1 conversations.
    lent = turns.filter(F.col("depth") < shared).withColumnRenamed("conv_id", "base").join(
        plans.select("conv_id", "base", "given"), "base").filter(F.col("depth") <= F.col("given"))
    return own.unionByName(lent.select(*own.columns)), plans.select("conv_id")


# --- names ------------------------------------------------------------------------------------------------------------

def halves(symbols: list[bytes]) -> list[bytes]:
    """Names of all prefixes: those of the upper half, and those of the lower half behind the name of the cut."""
    if len(symbols) == 1:
        return [sha256(b"\0" + symbols[0]).digest()]
    cut = 1 << (len(symbols) - 1).bit_length() - 1
    upper, lower = halves(symbols[:cut]), halves(symbols[cut:])
    return upper + [sha256(b"\1" + upper[-1] + x).digest() for x in lower]


def named(turns: DataFrame, piece: int = PIECE) -> DataFrame:
    """``conv_id, depth, symbol, name, parent``: the names of each prefix and of the one before it (null at depth 1)."""
    pieces = turns.groupBy("conv_id", F.expr(f"(depth - 1) div {piece}").alias("piece")).agg(
        F.sort_array(F.collect_list(F.struct("depth", "symbol"))).alias("turns"))

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [halves(x) for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.binary()))],
                                             ["conv_id", "piece", "symbols", "names"])

    inner = stored(pieces.select("conv_id", "piece", F.col("turns.symbol").alias("symbols")).mapInArrow(
        name, "conv_id long, piece long, symbols array<binary>, names array<binary>"), "pieces")
    # Whole pieces are the symbols of the upper sequence; a last one that is not whole has nothing below it.
    upper = inner.filter(F.size("names") == piece).select(
        "conv_id", (F.col("piece") + 1).alias("depth"), F.element_at("names", -1).alias("symbol"))
    at, before, names = F.col("cut"), F.col("last"), F.col("names")
    if inner.filter("piece > 0").isEmpty():
        inner = inner.withColumns({"cut": F.lit(None).cast("binary"), "last": F.lit(None).cast("binary")})
    else:
        above = named(upper, piece)
        # The name of the last prefix of a piece, as the piece itself gives it.
        last = F.when(F.col("parent").isNull(), F.col("symbol")).otherwise(_below(F.col("parent"), F.col("symbol")))
        above = above.select("conv_id", F.col("depth").alias("piece"), F.col("name").alias("cut"), last.alias("last"))
        inner = inner.join(above, ["conv_id", "piece"], "left")
    whole = F.when(at.isNull(), names).otherwise(F.transform(names, lambda x: _below(at, x)))
    whole = inner.select("conv_id", "piece", "symbols", whole.alias("names"), before.alias("last"))
    return whole.select("conv_id", "piece", "symbols", "names", "last", F.posexplode("names").alias("k", "name")).select(
        "conv_id", (F.col("piece") * piece + F.col("k") + 1).alias("depth"), F.col("symbols")[F.col("k")].alias("symbol"),
        "name", F.when(F.col("k") == 0, F.col("last")).otherwise(F.get("names", F.col("k") - 1)).alias("parent"))


def _below(cut: Column, name: Column) -> Column:
    return _digest(F.lit(b"\2"), cut, name)


# --- totals -----------------------------------------------------------------------------------------------------------

def totals(paths: DataFrame, own: DataFrame, sums: list[str], piece: int = PIECE) -> DataFrame:
    """``name`` and, for each of ``sums``, its total over the subtree of every node.

    ``paths`` has ``conv_id, depth, name`` for every prefix, the root at depth 0; ``own`` the same for each node's
    smallest member, with the node's own values.
    """
    forest = F.expr(f"depth div {piece}").alias("forest")
    own = own.withColumn("forest", forest)
    if not own.filter("forest > 0").isEmpty():
        # Upper trie: each cut node (the last above a forest) with what the forest below it holds.
        cuts = paths.filter((F.col("depth") + 1) % piece == 0).select(
            "conv_id", F.expr(f"(depth + 1) div {piece}").alias("forest"), F.col("name").alias("cut"))
        below = own.join(cuts, ["conv_id", "forest"]).groupBy("cut").agg(*[F.sum(s).alias(s) for s in sums])
        upper = own.filter((F.col("depth") + 1) % piece == 0).select("conv_id", "forest", "name")
        upper = stored(upper.join(below.withColumnRenamed("cut", "name"), "name").select(
            "conv_id", F.col("forest").alias("depth"), "name", *sums), "cuts")
        chains = cuts.select("conv_id", (F.col("forest") - 1).alias("depth"), F.col("cut").alias("name"))
        grafts = totals(chains, upper, sums, piece).select("name", *[F.col(s).alias(f"graft_{s}") for s in sums])
        own = own.join(grafts, "name", "left").select("conv_id", "depth", "name", "forest", *[
            (F.col(s) + F.coalesce(f"graft_{s}", F.lit(0))).alias(s) for s in sums])
    own = stored(own, "own")
    # A member has at most ``piece`` nodes of its own in a forest.
    above = Window.partitionBy("conv_id", "forest").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    gone = own.select("name", *[F.coalesce(F.sum(s).over(above), F.lit(0)).alias(f"gone_{s}") for s in sums])
    weights = own.groupBy("conv_id", "forest").agg(*[F.sum(s).alias(s) for s in sums])
    gathered = paths.withColumn("forest", forest).join(weights, ["conv_id", "forest"]).groupBy("name").agg(
        *[F.sum(s).alias(s) for s in sums])
    return gathered.join(gone, "name").select("name", *[(F.col(s) - F.col(f"gone_{s}")).alias(s) for s in sums])


def ends(paths: DataFrame) -> DataFrame:
    """``name, ends_sha256``: of the conversations that end at a node, the digits in numeric order, comma-joined.

    Ids are joined to pieces of text where ranges of them lie, so a node at which very many conversations end is spread
    over tasks; only finished pieces meet in one task, which hashes them one after another (SHA-256 has no other way).
    """
    last = paths.groupBy("conv_id").agg(F.max_by("name", "depth").alias("name"))
    ranged = last.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id").select("name", "conv_id")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            starts = [k for k in range(len(names)) if k == 0 or names[k] != names[k - 1]]
            cuts = sorted({*starts, *range(0, len(names), IDS), len(names)})
            runs = list(zip(cuts[:-1], cuts[1:], strict=True))
            yield pa.RecordBatch.from_arrays([
                pa.array([names[a] for a, _ in runs], pa.binary()), pa.array([ids[a] for a, _ in runs], pa.int64()),
                pa.array([",".join(map(str, ids[a:b])) for a, b in runs], pa.string())], ["name", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state = None, sha256()
        for batch in batches:
            done = []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key == name:
                    state.update(b",")
                else:
                    if name is not None:
                        done.append((name, state.hexdigest()))
                    name, state = key, sha256()
                state.update(ids.encode())
            yield _pairs(done)
        if name is not None:
            yield _pairs([(name, state.hexdigest())])

    def _pairs(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                           pa.array([r[1] for r in rows], pa.string())], ["name", "ends_sha256"])

    pieces = ranged.mapInArrow(join, "name binary, first long, ids string")
    ordered = pieces.repartition("name").sortWithinPartitions("name", "first").select("name", "ids")
    return ordered.mapInArrow(hashed, "name binary, ends_sha256 string")


# --- nodes ------------------------------------------------------------------------------------------------------------

def nodes(talks: tuple[DataFrame, DataFrame], piece: int = PIECE) -> DataFrame:
    """One row per node of the trie of sequences (turns and ids, see :func:`crossed`): ``conv_id`` (smallest member),
    ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens`` (over its subtree, bytes of the last text for
    each member but one) and ``ends_sha256``."""
    turns, ids = talks
    turns = stored(turns, "sequences")
    known = named(turns.select("conv_id", "depth", "symbol"), piece)
    top = F.lit(sha256(b"root").digest())
    paths = known.join(turns.select("conv_id", "depth", "n_bytes"), ["conv_id", "depth"]).select(
        "conv_id", "depth", "name", F.coalesce("parent", top).alias("parent"), "n_bytes")
    start = ids.select("conv_id", F.lit(0).cast("long").alias("depth"), top.alias("name"),
                       F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("n_bytes"))
    paths = stored(paths.unionByName(start), "paths")
    found = stored(paths.groupBy("name").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("depth").alias("depth"),
        F.min("parent").alias("parent"), F.min("n_bytes").alias("n_bytes")), "nodes")
    children = found.groupBy(F.col("parent").alias("name")).agg(F.count("*").alias("n_children"))
    found = stored(found.join(children, "name", "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0))), "nodes")
    own = found.select("conv_id", "depth", "name", (F.col("n_children") == 0).cast("long").alias("n_leaves"),
                       ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("saved_tokens"))
    summed = totals(paths.select("conv_id", "depth", "name"), own, ["n_leaves", "saved_tokens"], piece)
    parents = found.select(F.col("name").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    out = found.join(summed, "name").join(ends(paths), "name", "left").join(parents, "parent", "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce(
        "ends_sha256", F.lit(sha256(b"").hexdigest())).alias("ends_sha256"))
