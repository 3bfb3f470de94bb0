"""Prefix trie of conversations by van Emde Boas recursion.

A trie of height 2^k is cut at half its depth: the sequences' upper halves make the upper
trie, and under every distinct upper half hangs a lower trie. Both kinds are cut again, all
blocks of one height in parallel, down to single turns:

* bottom up, the content of every whole block of 2^k turns gets a name made from the
  names of its halves;
* top down, every cut names its prefixes: the name of a block's start and of its upper half
  make the name of the prefix that ends at the cut, the root of a lower trie;
* bottom up again, the totals of all lower tries of one height are grafted: each is
  added to the nodes of the upper half above its root.

So log2(depth) rounds do, whatever the depth. A turn takes part in a round as one row
of 128-bit names, whose texts stay in the input; a long conversation is many rows with keys of their own,
and a prefix that many conversations share is reduced in each task before any shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise.llm.store import Scratch
from meterwise.session import shuffle_width

#: Rows of one sequence that may share a join key, as a power of two.
CHUNK = 12
#: Ids in one piece of a node's list of ends.
PIECE = 4096
NAME = ["a", "b"]
TOTALS = ["n_children", "n_leaves", "saved"]


def _name(*cols: str) -> list[Column]:
    """Two 64-bit halves of a name."""
    return [F.xxhash64(*cols).alias("a"), F.xxhash64(F.lit(11), *cols, F.lit(13)).alias("b")]


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def numbered_turns(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """``turns`` (conv_id, turn and more) with ``pos``, from 0, the turn's place in its conversation,
    and ``n``, the conversation's number of turns.

    A distributed sort numbers the rows of each partition; partitions then add up, so no
    conversation has to fit in a task. Equal turns are ordered by the turn's name.
    """
    keys = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("a"), F.col("b"), F.col("tie")]
    placed = scratch.stage(
        turns.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(shuffle_width(turns), *keys)
        .sortWithinPartitions(*keys).select(*turns.columns, F.spark_partition_id().alias("pid"),
                                            F.monotonically_increasing_id().alias("at")), "sorted")
    # One row for each conversation and partition.
    parts = placed.groupBy("conv_id", "pid").agg(F.min("at").alias("first"), F.count("*").alias("here"))
    each = Window.partitionBy("conv_id")
    before = each.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("conv_id", "pid", (F.coalesce(F.sum("here").over(before), F.lit(0)) - F.col("first")).alias("shift"),
                         F.sum("here").over(each).alias("n"))
    return placed.join(parts, ["conv_id", "pid"]).select(*turns.columns, (F.col("at") + F.col("shift")).alias("pos"), "n")


def rebuilt(turns: DataFrame, group: int, longest: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: (conv_id, length) and their turns (conv_id, pos, a, b, bytes, length).

    Conversation c starts with the first h turns of c - c % group and goes on with its own after its
    first h, h = crc32(c as text) % (longest + 1).
    """
    rows = scratch.stage(numbered_turns(turns, scratch), "numbered")
    heads = (rows.filter((F.col("conv_id") % group == 0) & (F.col("pos") < longest)).groupBy("conv_id")
             .agg(F.array_sort(F.collect_list(F.struct("pos", *NAME, "bytes"))).alias("turns")))  # at most `longest` turns
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (longest + 1)
    plan = (rows.filter("pos = 0").select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
            .join(heads.withColumnRenamed("conv_id", "base"), "base", "left")
            .withColumn("head", F.coalesce(F.slice("turns", F.lit(1), F.col("h").cast("int")), F.array()))
            .withColumn("taken", F.size("head"))
            .select("conv_id", "n", "h", "head", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")))
    plan = scratch.stage(plan, "plan")
    # A long conversation's turns are dealt out by chunks, and its plan to each of them.
    chunks = plan.filter("n > h").select("conv_id", "h", "taken", "length", F.explode(
        F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("n") - 1, CHUNK))).alias("chunk"))
    own = (rows.withColumn("chunk", F.shiftright("pos", CHUNK)).join(chunks, ["conv_id", "chunk"]).filter("pos >= h")
           .select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), *NAME, "bytes", "length"))
    first = plan.select("conv_id", "length", F.posexplode("head").alias("pos", "t")).select(
        "conv_id", F.col("pos").cast("long").alias("pos"), "t.a", "t.b", "t.bytes", "length")
    return plan.select("conv_id", "length"), scratch.stage(own.unionByName(first), "turns")


def prefixes(sequences: DataFrame, turns: DataFrame, height: int, scratch: Scratch) -> DataFrame:
    """Every prefix of every sequence: (conv_id, depth, length, a, b, bytes), named by cuts at half depth.

    ``height`` is the power of two above the greatest length.
    """
    # Names of whole blocks of 2^k turns, from those of their halves.
    blocks = [turns.select("conv_id", F.col("pos").alias("block"), "length", *NAME, "bytes")]
    for k in range(1, height):
        up = F.shiftright("block", 1)
        odd = F.col("block") % 2 == 1
        part = [F.max(F.when(side, F.col(c))).alias(f"{c}{i}") for i, side in enumerate((~odd, odd)) for c in (*NAME, "bytes")]
        whole = (blocks[-1].filter(F.col("length") >= F.shiftleft(up + 1, k)).groupBy("conv_id", up.alias("block"), "length").agg(*part)
                 .select("conv_id", "block", "length", *_name("a0", "b0", "a1", "b1"), F.col("bytes1").alias("bytes")))
        blocks.append(scratch.stage(whole, f"blocks-{k}"))
    # Cuts, from the highest block down: the prefix at a block's middle from the one at its start.
    root = sequences.select("conv_id", F.lit(0).cast("long").alias("depth"), "length", *(F.lit(0).cast("long").alias(c) for c in NAME),
                            F.lit(0).cast("long").alias("bytes"))
    found = [root]
    for k in range(height, 0, -1):
        half = 1 << (k - 1)
        starts = _union(found).filter(F.col("length") >= F.col("depth") + half).select(
            "conv_id", "depth", F.col("a").alias("pa"), F.col("b").alias("pb"))
        upper = blocks[k - 1].filter("block % 2 = 0").select("conv_id", F.shiftleft("block", k - 1).alias("depth"), "length",
                                                             F.col("a").alias("ua"), F.col("b").alias("ub"), "bytes")
        cut = starts.join(upper, ["conv_id", "depth"]).select("conv_id", (F.col("depth") + half).alias("depth"), "length",
                                                              *_name("pa", "pb", "ua", "ub"), "bytes")
        found.append(scratch.stage(cut, f"cut-{k}"))
    return _union(found)


def _round(depth: Column) -> Column:
    """The round in which a node is the root of a grafted lower trie: trailing zeros of its depth, and one."""
    return F.bit_count(depth.bitwiseAND(-depth) - 1) + 1


def subtree_totals(nodes: DataFrame, paths: DataFrame, height: int, scratch: Scratch) -> DataFrame:
    """(depth, a, b, n_leaves, saved) rows whose sums by node are the totals of its subtree.

    ``nodes`` has a node's own values and its first member conv_id; ``paths`` every prefix of every sequence.
    Round k grafts the tries of height 2^(k-1) whose roots are the lower halves' of blocks of 2^k:
    what they hold goes to the nodes in the half above, found on the path of the root's first member.
    """
    values = ["n_leaves", "saved"]
    grafted = [nodes.select("depth", *NAME, *values, "conv_id")]
    for k in range(1, height + 1):
        half, small = k - 1, min(k - 1, CHUNK)
        tries = _union([g.filter((F.col("depth") > 0) & (_round(F.col("depth")) == k)) for g in grafted])
        tries = tries.groupBy("depth", *NAME).agg(*(F.sum(c).alias(c) for c in values), F.max("conv_id").alias("conv_id"))
        # The half above, in chunks of 2^small nodes, each with a key of its own.
        above = F.shiftleft(F.shiftright("depth", half) - 1, half - small)
        tries = tries.select("conv_id", *values, F.explode(F.sequence(above, above + (1 << (half - small)) - 1)).alias("chunk"))
        upper = (paths.filter((F.shiftright("depth", half) % 2 == 0) & (F.col("length") >= F.shiftleft(F.shiftright("depth", half) + 1, half)))
                 .select("conv_id", "depth", *NAME, F.shiftright("depth", small).alias("chunk")))
        more = upper.join(tries, ["conv_id", "chunk"]).groupBy("depth", *NAME).agg(*(F.sum(c).alias(c) for c in values))
        grafted.append(scratch.stage(more.withColumn("conv_id", F.lit(None).cast("long")), f"graft-{k}"))
    return _union(grafted).drop("conv_id")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one node's sorted ids as comma-joined pieces."""
    key, first, ids = None, 0, []

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([key[0]], pa.int64()), pa.array([key[1]], pa.int64()), pa.array([key[2]], pa.int64()),
             pa.array([first], pa.int64()), pa.array([",".join(map(str, ids))])], names=["depth", *NAME, "first", "piece"])

    for batch in batches:
        for *k, conv in zip(*(c.to_pylist() for c in batch.columns)):
            if key is not None and (k != key or len(ids) == PIECE):
                yield out()
                ids = []
            if not ids:
                first = conv
            key = k
            ids.append(conv)
    if ids:
        yield out()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's pieces, read in order; one digest is open at a time."""
    key, digest = None, None
    done: list[list] = [[], [], [], []]

    def close():
        for column, value in zip(done, (*key, digest.hexdigest())):
            column.append(value)

    for batch in batches:
        for d, a, b, piece in zip(*(c.to_pylist() for c in batch.columns)):
            if (d, a, b) != key:
                if key is not None:
                    close()
                key, digest = (d, a, b), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(piece.encode())
        yield _hash_batch(done)
        done = [[], [], [], []]
    if key is not None:
        close()
        yield _hash_batch(done)


def _hash_batch(done: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in done[:3]), pa.array(done[3], pa.string())],
                                      names=["depth", *NAME, "ends_sha256"])


def ends_hashes(ends: DataFrame) -> DataFrame:
    """(depth, a, b, ends_sha256) of the (depth, a, b, conv_id) rows: SHA-256 of a node's ids, ascending, joined by commas.

    The ids are sorted over all tasks, so a node's list may span several; only its pieces meet in one task.
    """
    keys = ["depth", *NAME]
    pieces = (ends.repartitionByRange(shuffle_width(ends), *keys, "conv_id").sortWithinPartitions(*keys, "conv_id")
              .mapInArrow(_pieces, "depth long, a long, b long, first long, piece string"))
    return (pieces.repartition(*keys).sortWithinPartitions(*keys, "first").drop("first")
            .mapInArrow(_hashes, "depth long, a long, b long, ends_sha256 string"))


def conversation_trie(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                      text_col: str = "text", group: int = 5, longest: int = 8) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations: ``conv_id`` (its smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``.

    A conversation c is rebuilt as in :func:`rebuilt`, so those of a group share openings. Saved tokens
    are the UTF-8 bytes of a node's last text that all members but one repeat, summed over its subtree.

    * a null role or text is the empty one; a null turn comes before the others; equal turns are
      ordered by the md5 of role and text, and equal rows are turns of their own;
    * rows without an id are left out; an id whose rebuilt conversation has no turn belongs to the root alone;
    * an empty table has no node, not even the root; other columns are ignored.
    """
    spark = conversations.sparkSession
    scratch, kept = Scratch(spark, "prefix-trie"), Scratch(spark, "prefix-trie-result")
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))
    turn = [F.conv(F.substring(digest, at, 15), 16, 10).cast("long").alias(c) for at, c in ((1, "a"), (16, "b"))]
    turns = conversations.filter(F.col(f"`{id_col}`").isNotNull()).select(
        F.col(f"`{id_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), *turn,
        F.octet_length(text).cast("long").alias("bytes"))
    sequences, rows = rebuilt(turns, group, longest, scratch)
    deepest = sequences.agg(F.max("length")).first()[0]
    height = int(deepest or 0).bit_length()
    paths = prefixes(sequences, rows, height, scratch)

    key = ["depth", *NAME]
    nodes = paths.groupBy(*key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"),
                                    F.sum((F.col("length") == F.col("depth")).cast("long")).alias("n_ends"), F.max("bytes").alias("bytes"))
    nodes = scratch.stage(nodes.select(*key, "conv_id", "n_convs", (F.col("n_ends") == F.col("n_convs")).cast("long").alias("n_leaves"),
                                       ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved")), "nodes")
    totals = subtree_totals(nodes, paths, height, scratch)
    # A node's parent is the prefix of its first member one turn shorter.
    parents = scratch.stage(
        nodes.filter("depth > 0").select("conv_id", (F.col("depth") - 1).alias("depth"))
        .join(paths.select("conv_id", *key), ["conv_id", "depth"]), "parents")
    named = scratch.stage(parents.join(nodes.select(*key, F.col("conv_id").alias("parent_conv_id")), key)
                          .select("conv_id", (F.col("depth") + 1).alias("depth"), "parent_conv_id"), "named")
    none = {c: F.lit(0).cast("long") for c in TOTALS}
    children = parents.groupBy(*key).agg(F.count("*").alias("n_children"))
    added = totals.withColumn("n_children", none["n_children"]).unionByName(
        children.withColumns({c: none[c] for c in ("n_leaves", "saved")}))
    summed = added.groupBy(*key).agg(*(F.sum(c).alias(c) for c in TOTALS))
    ends = ends_hashes(paths.filter("depth = length").select(*key, "conv_id"))
    found = (nodes.select(*key, "conv_id", "n_convs").join(summed, key).join(ends, key, "left")
             .join(named, ["conv_id", "depth"], "left")
             .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                     F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256")))
    found = kept.stage(found, "nodes", keep=True)
    scratch.clear()
    return found
