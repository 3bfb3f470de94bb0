"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

A source that should supply ``target`` of its ``source_size`` words takes each of
its documents target / source_size times: a whole number of copies and a
fraction. The fractions are rounded dependently: two documents with fractional
probabilities of a further copy exchange word mass at random, so that one of them
becomes 0 or 1 and the source's expected words stay exactly as they were. Every
document keeps its expected number of copies, yet a source's total varies by no
more than a part of one document.

Pairs are made in a reduction tree. Each source's documents are dealt by hash
into chunks of about 64, which are worked through from the largest document to
the smallest; a chunk leaves one document that is still fractional. These meet
in chunks of the next level, until a source has one chunk; its last document is
rounded to the nearer side, and the words this is off by are made up within that
chunk. A hot source only has more chunks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwise.llm.quality_rules import WORD
from meterwise.llm.store import Scratch

WEIGHTS = (5, 2, 1)
CHUNK = 64


def source_targets(sizes: DataFrame, scratch: Scratch, weights: tuple[int, ...] = WEIGHTS,
                   percent: int = 150, most: int = 2) -> DataFrame:
    """``(source, source_size, n_docs, target)`` for documents' ``(source, size)``.

    The sources, by code point with null last, weigh ``weights`` in turn and share
    ``percent`` of all words; a target stops at ``most`` times its source's size,
    and the excess is shared again by weight until no source is above.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"),
                                         F.sum((F.col("size") > 0).cast("long")).alias("n_docs"))
    # Rank in source order: rank within a range partition, after the partitions before it.
    width = int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = scratch.stage(totals.repartitionByRange(width, F.col("source").asc_nulls_last())
                          .withColumn("part", F.spark_partition_id()), "sources")
    parts = dealt.groupBy("part").count()
    # One row for each partition, so this unpartitioned window is bounded by the shuffle width.
    before = parts.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    ranked = dealt.withColumn("place", place).join(before, "part")
    turn = F.pmod(F.col("before") + F.col("place") - 1, F.lit(len(weights))).cast("int") + 1
    weighed = scratch.stage(ranked.select("source", "source_size", "n_docs", F.element_at(
        F.array(*map(F.lit, weights)), turn).cast("double").alias("weight")), "weights")

    # A source is full when most * size <= level * weight; the level is what the others get for each weight.
    everything = weighed.agg(F.sum("source_size")).first()[0] or 0
    level = None
    while True:
        full = F.lit(False) if level is None else most * F.col("source_size") <= F.lit(level) * F.col("weight")
        one = weighed.agg(F.sum(F.when(full, most * F.col("source_size"))).alias("words"),
                          F.sum(F.when(~full, F.col("weight"))).alias("weight")).first()
        new = (percent * everything / 100 - (one["words"] or 0)) / one["weight"] if one["weight"] else level or 0.0
        if level is not None and new <= level:
            break
        level = new
    target = F.least(F.col("source_size") * float(most), F.lit(float(level)) * F.col("weight"))
    return scratch.stage(weighed.select("source", "source_size", "n_docs", target.alias("target")), "targets")


def _emit(state: Column, item: Column, copy: Column) -> Column:
    done = F.struct(item["doc_id"].alias("doc_id"), item["ordinal"].alias("ordinal"), item["size"].alias("size"), copy.alias("copy"))
    return F.concat(state["done"], F.array(done))


def _chain(items: Column, seed: int, level: int) -> Column:
    """Pivotal rounding along ``items`` (neg_size, key, doc_id, ordinal, size, mass), fractional ones.

    The state holds the documents that became 0 or 1 and the fractional one left, if any.
    """
    item_type = "struct<doc_id:bigint,ordinal:bigint,size:bigint,mass:double>"
    start = F.struct(F.array().cast("array<struct<doc_id:bigint,ordinal:bigint,size:bigint,copy:int>>").alias("done"),
                     F.lit(None).cast(item_type).alias("rest"))

    def meet(state: Column, x: Column) -> Column:
        c = state["rest"]
        new = F.struct(x["doc_id"].alias("doc_id"), x["ordinal"].alias("ordinal"), x["size"].alias("size"), x["mass"].alias("mass"))

        def with_mass(item: Column, mass: Column) -> Column:
            return F.struct(item["doc_id"].alias("doc_id"), item["ordinal"].alias("ordinal"), item["size"].alias("size"),
                            mass.alias("mass"))

        room_c, room_x = c["size"] - c["mass"], x["size"] - x["mass"]
        up, down = F.least(room_c, x["mass"]), F.least(c["mass"], room_x)
        # The rest gains `up` words with probability down / (up + down), or else loses `down`.
        chance = F.pmod(F.xxhash64(c["doc_id"], c["ordinal"], x["doc_id"], x["ordinal"], F.lit(seed), F.lit(level)),
                        F.lit(1 << 40)) / float(1 << 40)
        gains = chance * (up + down) < down
        one, zero = F.lit(1), F.lit(0)
        pair = (F.when(gains & (room_c <= x["mass"]), F.struct(_emit(state, c, one).alias("done"), with_mass(x, x["mass"] - room_c).alias("rest")))
                .when(gains, F.struct(_emit(state, x, zero).alias("done"), with_mass(c, c["mass"] + x["mass"]).alias("rest")))
                .when(c["mass"] <= room_x, F.struct(_emit(state, c, zero).alias("done"), with_mass(x, x["mass"] + c["mass"]).alias("rest")))
                .otherwise(F.struct(_emit(state, x, one).alias("done"), with_mass(c, c["mass"] - room_x).alias("rest"))))
        return F.when(c.isNull(), F.struct(state["done"].alias("done"), new.alias("rest"))).otherwise(pair)

    return F.aggregate(items, start, meet)


def _settle(s: Column) -> Column:
    """Round the source's last fractional document to the nearer side; the words this
    is off by are made up by its chunk's documents, the largest that fit first."""
    rest = s["rest"]
    near = (2 * rest["mass"] >= rest["size"]).cast("int")
    off = rest["mass"] - near * rest["size"]
    done_type = "array<struct<doc_id:bigint,ordinal:bigint,size:bigint,copy:int>>"
    order = F.array_sort(s["done"], lambda a, b: F.when(a["size"] > b["size"], -1).when(a["size"] < b["size"], 1).otherwise(0))

    def step(state: Column, d: Column) -> Column:
        add = (d["copy"] == 0) & (d["size"] <= state["off"])
        cut = (d["copy"] == 1) & (d["size"] <= -state["off"])
        copy = F.when(add, 1).when(cut, 0).otherwise(d["copy"])
        left = state["off"] - (copy - d["copy"]) * d["size"]
        return F.struct(_emit(state, d, copy).alias("done"), left.alias("off"))

    made_up = F.aggregate(order, F.struct(F.array().cast(done_type).alias("done"), off.alias("off")), step)
    return F.when(rest.isNull(), s).otherwise(
        F.struct(_emit(made_up, rest, near).alias("done"), F.lit(None).cast(
            "struct<doc_id:bigint,ordinal:bigint,size:bigint,mass:double>").alias("rest")))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                seed: int = 0) -> DataFrame:
    """One row per document: what a mix of all sources takes of it.

    Returns ``doc_id, source, size, source_size, target, copies, taken``: ``size`` in
    words, ``copies`` 0 to 2, ``taken`` = copies * size. Equal input gives equal output
    in any partitioning.

    * null or empty text: size 0, no copies;
    * a null source is a source of its own, the last in order;
    * repeated rows are documents of their own, told apart by a number; a null id
      is an id like another;
    * an empty table gives an empty result; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    size = F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    sizes = scratch.stage(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                      F.col(source_col).cast("string").alias("source"), size.alias("size")), "sizes")
    targets = source_targets(sizes, scratch)
    # Rows alike in all that matters get a number, so that every row can round on its own.
    numbered = (sizes.groupBy("source", "doc_id", "size").count()
                .select("source", "doc_id", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)).alias("ordinal")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    planned = (numbered.alias("d").join(targets.alias("t"), F.expr("d.source <=> t.source"))
               .select("d.source", "doc_id", "ordinal", "size", "source_size", "target", "n_docs", rate.alias("rate"))
               .withColumn("whole", F.floor(F.col("rate") + 1e-9)).withColumn("part", F.greatest(F.col("rate") - F.col("whole"), F.lit(0.0))))
    planned = Scratch(docs.sparkSession, "mixing-plan").stage(planned, "plan", keep=True)

    open_ = planned.filter("size > 0 AND part > 1e-9").select(
        "source", "doc_id", "ordinal", "size", (F.col("size") * F.col("part")).alias("mass"), F.col("n_docs").alias("left"))
    largest = targets.agg(F.max("n_docs")).first()[0] or 0
    decided = None
    level = 0
    while largest:
        chunks = F.ceil(F.col("left") / CHUNK)
        key = F.xxhash64("doc_id", "ordinal", F.lit(seed), F.lit(level))
        dealt = open_.withColumn("chunk", F.pmod(key, chunks))
        item = F.struct((-F.col("size")).alias("neg"), key.alias("key"), "doc_id", "ordinal", "size", "mass")
        rounded = scratch.stage(dealt.groupBy("source", "chunk").agg(
            F.sort_array(F.collect_list(item)).alias("items"), F.first(chunks).alias("left"))
            .select("source", "left", _chain(F.col("items"), seed, level).alias("s"))
            .select("source", "left", F.when(F.col("left") == 1, _settle(F.col("s"))).otherwise(F.col("s")).alias("s")),
            f"level{level}")
        done = rounded.select("source", F.explode("s.done").alias("d")).select("source", "d.*")
        decided = done if decided is None else decided.unionByName(done)
        open_ = rounded.select("source", "s.rest.*", "left").filter("size IS NOT NULL")
        # A source with one chunk is settled and goes; `largest` is the most chunks any has.
        largest, level = math.ceil(largest / CHUNK), level + 1
        if largest == 1:
            break
    if decided is None:
        decided = planned.limit(0).select("source", "doc_id", "ordinal", "size", F.lit(0).alias("copy"))
    same = [F.expr(f"p.{c} <=> e.{c}") for c in ("source", "doc_id", "ordinal", "size")]
    joined = planned.alias("p").join(decided.filter("copy > 0").alias("e"), same, "left")
    copies = F.when(F.col("p.size") > 0, F.col("p.whole") + F.coalesce("e.copy", F.lit(0))).otherwise(0).cast("long")
    result = joined.select("p.doc_id", "p.source", "p.size", "p.source_size", "p.target", copies.alias("copies"),
                           (copies * F.col("p.size")).alias("taken"))
    result = Scratch(docs.sparkSession, "mixing-result").stage(result, "result", keep=True)
    scratch.clear()
    return result
