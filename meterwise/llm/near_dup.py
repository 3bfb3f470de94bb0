"""MinHash near-duplicate groups through a multi-index Hamming join.

Every document becomes the set of its distinct word shingles; 60 minimum hashes
of the set, 16 bits each, form its signature. Two signatures differ in about
60 * (1 - similarity) symbols. The signature is split into 12 chunks of 5
symbols: of two signatures that differ in at most 23 symbols, some chunk differs
in at most one (pigeonhole), so the join enumerates the allowed chunk errors,
one masked symbol in each chunk, and joins on 12 * 5 = 60 keys. All pairs with a
signature distance up to 23 meet, and a pair at similarity 0.75 meets with
probability 0.99999 whatever its distance. Links are confirmed on the full sets.

Groups of any size stay linear. Documents with equal sets share one vertex.
Buckets are then contracted in rounds: in each bucket the smallest vertex of
every component is compared with that of the bucket's first component, and
components merge, until no round merges any more. What is left are buckets that
hold several components. A vertex with fewer than 75 % of its shingles in any other
vertex left can have no link and goes, and so do buckets that hold one component after that. The others carry their sets into the last join (a set
of more than ``SAMPLE`` shingles as a sample of its hashes, the same rate for sets of like size), which
so gives out little more than links across components. Comparing what a bucket has left is still
quadratic in its components; giving out pairs isn't.

Links are exact where found. A linked pair is lost with a probability of about 0.00001 by its
signature, and by the bound of the finer sketch, five standard deviations off; a sampled set's bound is six off.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm import wordhash as W
from meterwise.llm.graph import components
from meterwise.llm.packed import packed, small_batches, unpack_texts
from meterwise.llm.store import Scratch

HASHES, CHUNK = 60, 5
#: A finer sketch for pairs that met: the least hash in each of 256 bins of the set, 4 bits
#: each (0: empty bin), 16 to a long. Of the bins that either set fills, at most this share
#: (in thousandths, and one more) may differ; a pair at similarity 0.75 differs in 234 on
#: average with a standard deviation of 27 at most, less for sets of under 1000 shingles.
BINS, MAX_DIFFERENT = 256, 340
#: Hashes of a set that go into the last join.
SAMPLE = 1024
SKETCH = [f"s{i}" for i in range(BINS // 16)]
U = np.uint64

FEATURES = f"doc_id long, n_shingles long, fp1 long, fp2 long, {', '.join(f'{c} long' for c in SKETCH)}, keys array<long>"


def shingle_sets(hasher: W.Hasher, data: np.ndarray, offsets: np.ndarray, width: int):
    """Sorted distinct shingle hashes of the rows, and each row's bounds in them."""
    _, _, words, first = hasher.words(data, offsets)
    counts = np.diff(first)
    mult = W.constants(width, 11)
    n = len(words)
    full = np.zeros(n, dtype=U)
    m = max(0, n - width + 1)
    for j in range(width if m else 0):
        full[:m] += words[j:j + m] * mult[j]
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    out = np.zeros(int(sizes.sum()), dtype=U)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    for r in np.flatnonzero(counts):
        a, b, k = first[r], bounds[r], counts[r]
        if k >= width:
            out[b:bounds[r + 1]] = full[a:a + k - width + 1]
        else:
            out[b] = (words[a:a + k] * mult[:k]).sum() ^ mult[k]
    out = W.mix(out)
    for r in np.flatnonzero(sizes > 1):
        out[bounds[r]:bounds[r + 1]].sort()
    fresh = np.ones(len(out), dtype=bool)
    fresh[1:] = out[1:] != out[:-1]
    fresh[bounds[:-1][sizes > 0]] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    return out[fresh], kept[bounds]


def signatures(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """16-bit symbols, one row for each set; ``starts`` are the sets' first positions."""
    mult, add = W.constants(HASHES, 23), W.constants(HASHES, 29)
    out = np.empty((len(starts), HASHES), dtype=U)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat(sets * mult[k] + add[k], starts)
    return W.mix(out + add) & U(0xFFFF)


def sketches(sets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The packed bins of each set, one row of longs for each."""
    row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(sets))))
    h = W.mix(sets + U(3))
    least = np.full(len(starts) * BINS, 2**64 - 1, dtype=U)
    np.minimum.at(least, row * BINS + (h & U(BINS - 1)).astype(np.int64), h >> U(8))
    symbol = np.where(least == U(2**64 - 1), U(0), W.mix(least) % U(15) + U(1)).reshape(len(starts), -1, 16)
    out = np.zeros(symbol.shape[:2], dtype=U)
    for k in range(16):
        out = (out << U(4)) | symbol[:, :, k]
    return out


def chunk_keys(sig: np.ndarray) -> np.ndarray:
    """Hashed keys of every chunk with each one of its symbols masked."""
    chunks = sig.reshape(len(sig), HASHES // CHUNK, CHUNK)
    keys = np.empty((len(sig), HASHES // CHUNK, CHUNK), dtype=U)
    for j in range(CHUNK):
        rest = [k for k in range(CHUNK) if k != j]
        packed = np.zeros(chunks.shape[:2], dtype=U)
        for k in rest:
            packed = (packed << U(16)) | chunks[:, :, k]
        keys[:, :, j] = packed
    return W.mix(keys.reshape(len(sig), HASHES) + W.constants(HASHES, 31))


def _features(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.Hasher(lower=True)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a, b, data, offsets in W.slices(texts):
                sets, bounds = shingle_sets(hasher, data, offsets, width)
                sizes = np.diff(bounds)
                some = np.flatnonzero(sizes)
                cols = {c: np.zeros(b - a, dtype=np.int64) for c in ("fp1", "fp2", *SKETCH)}
                offs = np.concatenate([[0], np.cumsum(np.where(sizes > 0, HASHES, 0))]).astype(np.int32)
                keys = np.zeros(0, dtype=np.int64)
                if len(some):
                    starts = bounds[:-1][some]
                    sig = signatures(sets, starts)
                    keys = W.signed(chunk_keys(sig).reshape(-1))
                    cols["fp1"][some] = W.signed(np.add.reduceat(W.mix(sets + U(1)), starts))
                    cols["fp2"][some] = W.signed(np.bitwise_xor.reduceat(W.mix(sets + U(2)), starts))
                    packed = sketches(sets, starts)
                    for k, c in enumerate(SKETCH):
                        cols[c][some] = W.signed(packed[:, k])
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(sizes.astype(np.int64)), *(pa.array(c) for c in cols.values()),
                     pa.ListArray.from_arrays(pa.array(offs), pa.array(keys))],
                    names=["doc_id", "n_shingles", *cols, "keys"])
    return run


def _confirm(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.Hasher(lower=True)
        for batch in (b.slice(at, 256) for b in batches for at in range(0, len(b), 256)):
            ok = np.zeros(len(batch), dtype=bool)
            sides = []
            for col in (2, 3):
                sets = []
                for _, _, data, offsets in W.slices(pa.array(list(unpack_texts(batch.column(col))), pa.string())):
                    s, bounds = shingle_sets(hasher, data, offsets, width)
                    sets += [s[bounds[r]:bounds[r + 1]] for r in range(len(offsets) - 1)]
                sides.append(sets)
            for i, (x, y) in enumerate(zip(*sides)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok[i] = len(x) > 0 and len(y) > 0 and 100 * both >= percent * (len(x) + len(y) - both)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["u", "v"]).filter(pa.array(ok))
    return run


def _shingle_rows(width: int):
    """(node, shingle) rows of (node, packed text) rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.Hasher(lower=True)
        for batch in (b.slice(at, 256) for b in batches for at in range(0, len(b), 256)):
            for a, b, data, offsets in W.slices(pa.array(list(unpack_texts(batch.column(1))), pa.string())):
                sets, bounds = shingle_sets(hasher, data, offsets, width)
                take = pa.array(np.repeat(np.arange(a, b), np.diff(bounds)))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), pa.array(W.signed(sets))], names=["node", "x"])
    return run


def _samples(width: int):
    """(node, level, lost, sample) of (node, packed text) rows: the low 32 bits of the set's hashes divisible by 2^level.

    ``level`` is the least that leaves at most ``SAMPLE`` of a set on average; ``lost`` counts equal low bits.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = W.Hasher(lower=True)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                levels, lost, samples = [], [], []
                for _, _, data, offsets in W.slices(pa.array(list(unpack_texts(part.column(1))), pa.string())):
                    sets, bounds = shingle_sets(hasher, data, offsets, width)
                    for r in range(len(offsets) - 1):
                        one = sets[bounds[r]:bounds[r + 1]]
                        level = max(0, (len(one) - 1) // SAMPLE).bit_length()
                        one = one[(one & U((1 << level) - 1)) == 0]
                        low = np.unique((one >> U(level)).astype(np.uint32).view(np.int32))
                        levels.append(level)
                        lost.append(len(one) - len(low))
                        samples.append(low.tolist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(levels, pa.int32()), pa.array(lost, pa.int32()), pa.array(samples, pa.list_(pa.int32()))],
                    names=["node", "level", "lost", "sample"])
    return run


def _overlap(percent: int):
    """Whether the sets of rows x and y can have the overlap of a link: exact for sets that aren't sampled.

    A link needs percent / (100 + percent) of both sizes together. Samples of unlike level compare at the
    higher one, whose hashes are those of the lower level divisible by more.
    """
    sizes = F.col("x.n_shingles") + F.col("y.n_shingles")
    same = F.col("x.level") == F.col("y.level")
    common = F.size(F.array_intersect("x.sample", "y.sample")) + F.col("x.lost") + F.col("y.lost")
    expected = percent * sizes / (100 + percent) / F.pow(F.lit(2.0), F.greatest("x.level", "y.level"))
    sampled = F.greatest("x.level", "y.level") > 0
    return F.when(~sampled, (100 + percent) * common >= percent * sizes).otherwise(
        ~same | (common + 6 * F.sqrt(expected) >= expected))


def _filled(x):
    """Number of 4-bit symbols of a long that aren't 0, on the JVM."""
    y = x.bitwiseOR(F.shiftrightunsigned(x, 1))
    y = y.bitwiseOR(F.shiftrightunsigned(y, 2))
    return F.bit_count(y.bitwiseAND(F.lit(0x1111111111111111)))


def _close(percent: int):
    """The size bound and the sketch bound for rows x and y."""
    small, large = (f("x.n_shingles", "y.n_shingles") for f in (F.least, F.greatest))
    pairs = [(F.col(f"x.{c}"), F.col(f"y.{c}")) for c in SKETCH]
    different = reduce(add, (_filled(a.bitwiseXOR(b)) for a, b in pairs))
    either = reduce(add, (_filled(a.bitwiseOR(b)) for a, b in pairs))
    return (100 * small >= percent * large) & (1000 * different <= MAX_DIFFERENT * either + 1000)


def _renamed(labels: DataFrame, node: str, comp: str) -> DataFrame:
    return labels.select(F.col("node").alias(node), F.col("comp").alias(comp))


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          width: int = 5, percent: int = 75) -> DataFrame:
    """One row per document: its id, shingle count, component and whether it is the one kept.

    Returns ``doc_id, n_shingles, component_id, kept``. Documents are linked when
    100 * |intersection| >= percent * |union| of their shingle sets; ``component_id``
    is the smallest id reachable. The signature bounds are set for ``percent`` >= 75.

    * null, empty or blank text: no shingles, its own component, kept;
    * fewer than ``width`` words: the whole sequence is the one shingle;
    * repeated rows: rows with one id are one vertex, so they share a component;
    * a null id takes no part in linking: component null, kept true;
    * an empty table gives an empty result; other columns are ignored.
    """
    if percent < 75:
        raise ValueError("the signature bounds hold for a similarity of 75 % or more")
    spark = docs.sparkSession
    small_batches(spark)
    scratch = Scratch(spark, "near-dup")
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    features = scratch.stage(slim.mapInArrow(_features(width), FEATURES), "features")

    linked = features.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    same = scratch.stage(linked.groupBy("fp1", "fp2", "n_shingles").agg(F.min("doc_id").alias("node")), "sets")
    # One vertex for each distinct set: the smallest id that has it.
    vertices = (linked.select(F.col("doc_id").alias("node"), "keys")
                .join(same.select("node").distinct(), "node", "left_semi"))
    keyed = vertices.select("node", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("last")).filter("lead < last")
    rows = scratch.stage(keyed.join(shared.select("key", "lead"), "key").distinct(), "rows")

    # Written, so that its size is known: while it's under Spark's threshold, the joins that pick
    # the vertices' sketches and texts shuffle neither.
    involved = scratch.stage(rows.select("node").distinct(), "involved")
    sketch = scratch.stage(linked.select(F.col("doc_id").alias("node"), "n_shingles", *SKETCH, "keys")
                           .join(involved, "node", "left_semi").distinct(), "sketches")
    texts = scratch.stage(slim.filter("text IS NOT NULL").select(F.col("doc_id").alias("node"), packed(F.col("text")).alias("text"))
                          .join(involved, "node", "left_semi"), "texts")

    def bounded_pairs(pairs: DataFrame) -> DataFrame:
        """The (u, v) pairs that pass the bounds."""
        x, y = sketch.alias("x"), sketch.alias("y")
        return (pairs.join(x, F.col("u") == F.col("x.node")).join(y, F.col("v") == F.col("y.node"))
                .filter(_close(percent)).select("u", "v"))

    def confirmed(pairs: DataFrame) -> DataFrame:
        """The (u, v) pairs whose sets are similar enough, compared in full."""
        with_u = pairs.join(texts.select(F.col("node").alias("u"), F.col("text").alias("text_u")), "u")
        with_v = with_u.join(texts.select(F.col("node").alias("v"), F.col("text").alias("text_v")), "v")
        return (with_v.select("u", "v", "text_u", "text_v")
                .mapInArrow(_confirm(width, percent), "u long, v long").distinct())

    def merged(labels: DataFrame | None, pairs: DataFrame) -> tuple[DataFrame, int]:
        """Labels after linking ``pairs`` (of vertices), and how many components went."""
        edges = scratch.stage(confirmed(pairs), "links")
        if labels is not None:
            edges = (edges.join(_renamed(labels, "u", "cu"), "u", "left").join(_renamed(labels, "v", "cv"), "v", "left")
                     .select(F.coalesce("cu", "u").alias("u"), F.coalesce("cv", "v").alias("v")))
        moves = components(edges, scratch)
        if labels is None:
            new = moves
        else:
            new = (labels.join(_renamed(moves, "comp", "to"), "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
                   .unionByName(moves.join(labels, "node", "left_anti")))
        new = scratch.stage(new, "labels")
        return new, moves.count()

    # First round: every vertex with the smallest vertex of its buckets.
    labels, gone = merged(None, bounded_pairs(rows.groupBy(F.col("node").alias("u")).agg(F.min("lead").alias("v")).filter("v < u")))
    active = rows.select("key", "node")
    while True:
        placed = (active.join(labels, "node", "left")
                  .select("key", "node", F.coalesce("comp", "node").alias("comp")))
        mixed = placed.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 < c1")
        placed = scratch.stage(placed.join(mixed.select("key", "c0"), "key"), "mixed")
        active = placed.select("key", "node")
        if not gone:
            break
        reps = placed.groupBy("key", "comp", "c0").agg(F.min("node").alias("rep"), F.max("node").alias("top"))
        leads = reps.filter("comp = c0").select("key", F.col("rep").alias("v0"), F.col("top").alias("v1"))
        across = reps.filter("comp <> c0").join(leads, "key")
        labels, gone = merged(labels, bounded_pairs(across.select(F.explode(F.array(
            F.struct(F.col("rep").alias("u"), F.col("v0").alias("v")),
            F.struct(F.col("top").alias("u"), F.col("v1").alias("v")))).alias("p")).select("p.u", "p.v").distinct()))

    # The rest: pairs across components of one bucket that pass the bounds. A vertex that
    # shares too few of its shingles with all the others left can have no link: it goes.
    left = texts.join(placed.select("node").distinct(), "node", "left_semi")
    alone = (left.mapInArrow(_shingle_rows(width), "node long, x long").groupBy("x")
             .agg(F.min("node").alias("node"), F.max("node").alias("other")).filter("node = other")
             .groupBy("node").agg(F.count("*").alias("alone")))
    # An id of several texts stands for their sets together, so nothing is known to be alone in it. The join
    # comes after the counts, where it reads a row for each vertex (Spark would move a semi-join below them).
    several_texts = texts.groupBy("node").count().filter("count > 1").select("node", F.lit(0).alias("unknown"))
    bounded = (sketch.join(alone, "node", "left").join(several_texts, "node", "left")
               .withColumn("shared", F.col("n_shingles") - F.coalesce("unknown", "alone", F.lit(0))).drop("unknown")
               .filter(100 * F.col("shared") >= percent * F.col("n_shingles")))
    sets = left.mapInArrow(_samples(width), "node long, level int, lost int, sample array<int>")
    bounded = scratch.stage(bounded.join(sets, "node"), "bounded")
    # Buckets that hold one component once those went have no pair to give: they go before the sets, which a vertex
    # carries into every bucket it is in, are shuffled. Both sides of the join name the same columns as not null,
    # so that Spark shuffles them once.
    near = scratch.stage(placed.select("key", "node", "comp").join(bounded.select("node").distinct(), "node", "left_semi"), "near")
    several = near.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).filter("c0 < c1").select("key")
    near = scratch.stage(near.join(several, "key", "left_semi"), "near-mixed")
    side = near.join(bounded, "node").filter("keys IS NOT NULL")
    # A pair meets in several buckets; only its first one gives it out.
    first = F.array_position(F.zip_with("x.keys", "y.keys", lambda a, b: a == b), True)
    rest = (side.alias("x").join(side.alias("y"), (F.col("x.key") == F.col("y.key"))
                                 & (F.col("x.comp") < F.col("y.comp")) & _close(percent)
                                 & ((100 + percent) * F.least("x.shared", "y.shared")
                                    >= percent * (F.col("x.n_shingles") + F.col("y.n_shingles")))
                                 & (first == F.array_position("x.keys", F.col("x.key"))) & _overlap(percent))
            .select(F.col("x.node").alias("u"), F.col("y.node").alias("v")).distinct())
    labels, _ = merged(labels, rest)

    # Documents -> set -> vertex -> component; rows with one id are one vertex.
    final = Scratch(spark, "near-dup-result")
    by_set = (same.join(labels, "node", "left")
              .select("fp1", "fp2", "n_shingles", F.coalesce("comp", "node").alias("set_comp")))
    placed = final.stage(features.select("doc_id", "n_shingles", "fp1", "fp2")
                         .join(by_set, ["fp1", "fp2", "n_shingles"], "left")
                         .select("doc_id", "n_shingles", F.coalesce("set_comp", "doc_id").alias("comp")), "placed", keep=True)
    # Only ids that repeat can tie two components together.
    tied = (placed.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("comp").alias("v"), F.max("comp").alias("u"))
            .filter("v < u"))
    if not tied.isEmpty():
        several = placed.join(tied.select("doc_id", "v"), "doc_id").select(F.col("comp").alias("u"), "v")
        onto = final.stage(components(several, final), "tied", keep=True)
        placed = (placed.join(_renamed(onto, "comp", "to"), "comp", "left")
                  .select("doc_id", "n_shingles", F.coalesce("to", "comp").alias("comp")))
    scratch.clear()
    return placed.select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("comp")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("comp"), F.lit(True)).alias("kept"))
