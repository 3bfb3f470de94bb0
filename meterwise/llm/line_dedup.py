"""Line deduplication within an edit bound, by a deletion-neighbourhood join.

A line goes when an earlier line of the corpus (by document id, then line
number) has the same words, or, for lines of ``near_min_words`` words and more,
words within one edit (a word replaced, inserted or deleted).

Near lines are found by emitting every variant of a line, the line itself and
the line without each one of its words, as a hashed key. Two lines of equal
length are within one edit exactly when they share the variant without word p;
lines whose lengths differ by one, exactly when a variant of the longer equals
the whole shorter one. So all members of a bucket (variant, p) are within the
bound of one another, and comparing each with the bucket's earliest line decides
it: work is linear in the bucket, whatever its size. Matches are verified on the
words.

Before that a filter leaves lines that can have no partner out of the join,
without loss: with one edit, either the first or the last h words stay the same,
where h is half the shorter line's length. Lines that share such a half with no
other line emit no variants.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm import wordhash as W
from meterwise.llm.packed import ROWS, packed, small_batches, unpack_texts
from meterwise.llm.store import Scratch

U = np.uint64
LENGTH, HEAD, TAIL = (U(x) for x in (0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))
ADDED = ["n_lines", "n_exact", "n_near", "emptied"]
#: Limits for a whole corpus. Lines with any word go when equal; under 5 words one edit
#: is no likeness (it turns any one-word line into any other), so they go only then.
WHOLE = {"min_words": 1, "near_min_words": 5}


class _Sums:
    """Polynomial hashes of ranges of a hash sequence, from prefix sums."""

    def __init__(self, hasher: W.Hasher, hashes: np.ndarray):
        n = len(hashes)
        if n + 1 > len(hasher.pow):
            hasher._powers(max(n + 1, W.BLOCK))
        self.inv = hasher.inv
        self.total = np.zeros(n + 1, dtype=U)
        np.cumsum(hashes * hasher.pow[:n], out=self.total[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return (self.total[stop] - self.total[start]) * self.inv[start]


def _line_features(min_words: int, near_min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.Hasher()
        for batch in batches:
            for a, b, data, offsets in W.slices(batch.column(2)):
                starts, _, hashes, first = hasher.words(data, offsets)
                row = np.repeat(np.arange(b - a), np.diff(first))
                breaks = np.flatnonzero(data == 10)
                line = np.searchsorted(breaks, starts) - np.searchsorted(breaks, offsets[:-1])[row]
                fresh = np.ones(len(starts), dtype=bool)
                fresh[1:] = (row[1:] != row[:-1]) | (line[1:] != line[:-1])
                begin = np.flatnonzero(fresh)
                end = np.append(begin[1:], len(starts)).astype(np.int64)
                n = end - begin
                ok = n >= min_words
                begin, end, n = begin[ok], end[ok], n[ok]
                sums = _Sums(hasher, hashes)
                h = W.mix(sums.of(begin, end) + n.astype(U) * LENGTH)
                keys = []
                for half in (n // 2, (n - 1) // 2):
                    size = half.astype(U) * LENGTH
                    keys += [W.mix(sums.of(begin, begin + half) + size + HEAD), W.mix(sums.of(end - half, end) + size + TAIL)]
                take, short = pa.array(row[begin] + a), n < near_min_words
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(line[begin].astype(np.int32)),
                     pa.array(W.signed(h)), pa.array(n.astype(np.int32)), *(pa.array(W.signed(k), mask=short) for k in keys)],
                    names=["ord", "rk", "line_no", "h", "n", "k0", "k1", "k2", "k3"])
    return run


def _pick_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The wanted lines' texts (input: ord, rk, packed text, wanted)."""
    for batch in batches:
        out = {k: [] for k in ("ord", "rk", "line_no", "h", "line")}
        for o, rk, text, wanted in zip(*(batch.column(i).to_pylist() for i in (0, 1)), unpack_texts(batch.column(2)),
                                       batch.column(3).to_pylist()):
            lines = text.split("\n")
            for w in wanted:
                for k, v in zip(out, (o, rk, w["line_no"], w["h"], lines[w["line_no"]])):
                    out[k].append(v)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out["ord"], pa.int64()), pa.array(out["rk"], pa.int64()), pa.array(out["line_no"], pa.int32()),
             pa.array(out["h"], pa.int64()), pa.array(out["line"], pa.string())], names=list(out))


def _variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every line without each one of its words (input: ord, rk, line_no, h, line)."""
    hasher = W.Hasher()
    for batch in batches:
        for a, b, data, offsets in W.slices(batch.column(4), W.BLOCK // 4):
            _, _, hashes, first = hasher.words(data, offsets)
            n = np.diff(first)
            row = np.repeat(np.arange(b - a), n)
            at = np.arange(len(hashes))
            sums = _Sums(hasher, hashes)
            begin, end = first[:-1][row], first[1:][row]
            # Words after the deleted one move one place to the left.
            rest = sums.of(at + 1, end) * hasher.pow[at - begin - 1] if len(at) else np.zeros(0, U)
            alone = at == begin
            rest[alone] = sums.of(at + 1, end)[alone]
            v = W.mix(sums.of(begin, at) + rest + (n[row] - 1).astype(U) * LENGTH)
            take = pa.array(row + a)
            yield pa.RecordBatch.from_arrays(
                [pa.array(W.signed(v)), pa.array((at - begin).astype(np.int32)), *(batch.column(i).take(take) for i in range(4))],
                names=["v", "p", "ord", "rk", "line_no", "h"])


def within_one_edit(x: list[str], y: list[str]) -> bool:
    """Whether one word replaced, inserted or deleted turns ``x`` into ``y`` (or none)."""
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1:
        return False
    at = next((i for i, (a, b) in enumerate(zip(x, y)) if a != b), len(x))
    return x[at + 1:] == y[at + 1:] if len(x) == len(y) else x[at:] == y[at + 1:]


def line_words(line: str) -> list[str]:
    for c in "\t\n\x0b\x0c\r":
        line = line.replace(c, " ")
    return [w for w in line.split(" ") if w]


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ok = [within_one_edit(line_words(x), line_words(y))
              for x, y in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0)], names=["h"]).filter(pa.array(ok, pa.bool_()))


def _without(packed_texts: pa.Array, gone: pa.Array) -> pa.Array:
    """Texts without the lines of the given numbers, their number of lines, and whether a word is left."""
    kind = pa.struct([("text", pa.string()), ("n_lines", pa.int64()), ("left", pa.bool_())])
    out, parts = [], []
    for text, numbers in zip(unpack_texts(packed_texts), gone):
        n = 0 if text is None else text.count("\n") + 1
        numbers = set(numbers.as_py() or ())
        if numbers and text is not None:
            text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in numbers)
        out.append({"text": text, "n_lines": n, "left": bool(text and text.strip(" \t\n\x0b\x0c\r"))})
        if len(out) == ROWS:
            parts.append(pa.array(out, kind))
            out = []
    done = pa.concat_arrays([*parts, pa.array(out, kind)])
    pa.default_memory_pool().release_unused()
    return done


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_words: int = 5, near_min_words: int = 10) -> DataFrame:
    """``docs`` with repeated lines taken out of the text, and four more columns.

    ``n_lines`` (lines of the text), ``n_exact`` and ``n_near`` (lines taken out as
    equal to, or within one word edit of, an earlier line), ``emptied`` (lines were
    taken out and no word is left). Lines of fewer than ``min_words`` words are
    never taken out, of fewer than ``near_min_words`` only when equal. The registered
    query and the pipeline use the limits in ``WHOLE``.

    * null text stays null, empty text stays empty (``n_lines`` 0 and 1);
    * ties: rows equal in id and text share their positions and keep or lose alike;
      among rows with one id, the order is that of a hash of the text;
    * a null id comes after all ids;
    * an empty table gives an empty result; every other column passes through, and
      one named like an added column is replaced.
    """
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "line-dedup")
    others = [c for c in docs.columns if c not in [*ADDED, text_col]]
    text = F.col(f"`{text_col}`").cast("string")
    slim = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(2**63 - 1)).alias("ord"),
                       F.xxhash64(text).alias("rk"), text.alias("text"))
    lines = scratch.stage(slim.filter("text IS NOT NULL").mapInArrow(
        _line_features(min_words, near_min_words), "ord long, rk long, line_no int, h long, n int, k0 long, k1 long, k2 long, k3 long"), "lines")
    place = F.struct("ord", "rk", "line_no")
    distinct = scratch.stage(lines.groupBy("h").agg(
        F.min(place).alias("first"), F.count("*").alias("times"), F.min("n").alias("n"),
        *(F.min(k).alias(k) for k in ("k0", "k1", "k2", "k3"))), "distinct")

    # Lines that share a half with another line, and their words.
    long = distinct.filter(F.col("n") >= near_min_words)
    halves = long.select("h", F.explode(F.array_distinct(F.array("k0", "k1", "k2", "k3"))).alias("key"))
    shared = halves.groupBy("key").agg(F.min("h").alias("a"), F.max("h").alias("b")).filter("a < b").select("key")
    paired = halves.join(shared, "key", "left_semi").select("h").distinct()
    wanted = (long.join(paired, "h", "left_semi").select("first.ord", "first.rk", "first.line_no", "h")
              .groupBy("ord", "rk").agg(F.collect_list(F.struct("line_no", "h")).alias("wanted")))
    texts = scratch.stage(slim.filter("text IS NOT NULL").select("ord", "rk", packed(F.col("text")).alias("text"))
                          .join(wanted, ["ord", "rk"]).select("ord", "rk", "text", "wanted").mapInArrow(
        _pick_lines, "ord long, rk long, line_no int, h long, line string").dropDuplicates(["h"]), "paired")

    # Variants: equal ones at one place, and those equal to a whole line.
    variants = scratch.stage(texts.mapInArrow(_variants, "v long, p int, ord long, rk long, line_no int, h long"), "variants")
    lead = (variants.groupBy("v", "p").agg(F.min(F.struct(place, "h")).alias("lead"), F.count("*").alias("c"))
            .filter("c > 1").select("v", "p", F.col("lead.h").alias("witness")))
    replaced = variants.join(lead, ["v", "p"]).filter("h <> witness").select("h", "witness")
    whole = texts.select(F.col("h").alias("v"), place.alias("whole"))
    inserted = (variants.join(whole, "v").select(
        F.when(place > F.col("whole"), F.struct(F.col("h").alias("h"), F.col("v").alias("witness")))
        .otherwise(F.struct(F.col("v").alias("h"), F.col("h").alias("witness"))).alias("x")).select("x.h", "x.witness"))
    found = replaced.unionByName(inserted).groupBy("h").agg(F.min("witness").alias("witness"))
    words = texts.select("h", "line")
    near = scratch.stage(
        found.join(words, "h").join(words.select(F.col("h").alias("witness"), F.col("line").alias("other")), "witness")
        .select("h", "line", "other").mapInArrow(_verify, "h long").distinct(), "near")

    # Occurrences to take out, as line numbers of each row.
    again = (distinct.join(near.withColumn("near", F.lit(True)), "h", "left")
             .filter("near OR times > 1").select("h", "first", F.coalesce("near", F.lit(False)).alias("near")))
    gone = (lines.select("ord", "rk", "line_no", "h").join(again, "h").filter(F.col("near") | (place > F.col("first")))
            .groupBy("ord", "rk", "line_no").agg(F.max(F.when(place > F.col("first"), 0).otherwise(1)).alias("near"))
            .groupBy("ord", "rk").agg(F.collect_list("line_no").alias("gone"), F.sum("near").alias("n_near")))
    gone = Scratch(spark, "line-dedup-result").stage(gone, "gone")
    scratch.clear()

    rows = docs.select(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in others)).alias("row"),
                       F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(2**63 - 1)).alias("ord"),
                       F.xxhash64(text).alias("rk"), packed(text).alias("text"))
    cleaned = rows.join(gone, ["ord", "rk"], "left").withColumn(
        "new", F.arrow_udf(_without, "struct<text:string,n_lines:long,left:boolean>")("text", "gone"))
    n_gone = F.coalesce(F.size("gone"), F.lit(0)).cast("long")
    n_near = F.coalesce("n_near", F.lit(0)).cast("long")
    return cleaned.select(
        *(F.col("new.text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c not in ADDED),
        F.col("new.n_lines").alias("n_lines"), (n_gone - n_near).alias("n_exact"), n_near.alias("n_near"),
        ((n_gone > 0) & ~F.col("new.left")).alias("emptied"))
