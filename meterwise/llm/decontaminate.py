"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark items (questions and answers) are normalised to lower-case words; each
run of ``window`` words of an item, or the whole of a shorter one, is one
pattern of the automaton. Every document is normalised the same way and scanned
once; matches are mapped back to words and to character offsets of the original
text.

Its letters are word numbers, so a window is as many nodes as it has words (at most ten,
about 40 bytes each). It looks for a letter among all that start a window, one by one, whenever no
match is under way, so it gets only the stretches of a document in which every two neighbours
are neighbours in some window too: no window reaches beyond one. The automaton is broadcast, so its size is bounded: a benchmark that could
make more than ``max_nodes`` nodes is dealt into blocks, and the documents are
scanned once per block; each pass but the last is written, so a task holds one automaton.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import islice, repeat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm.store import Scratch

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
# The same words in UTF-8: A-Z folded, every separator (all are ASCII) a space.
TO_WORDS = bytes(FOLD.get(c, c) if c > 0x7F or re.match(WORD, chr(FOLD.get(c, c))) else 0x20 for c in range(256))
SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
SPAN_TYPE = "array<struct<first:int,last:int>>"
SCAN_TYPE = f"struct<n_words:long,spans:{SPAN_TYPE},items:array<long>>"
ADDED = ["n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated", "spans"]


def normal_words(text: str | None) -> list[str]:
    return WORD.findall(text.translate(FOLD)) if text else []


def item_windows(text: str | None, window: int) -> set[tuple[str, ...]]:
    words = normal_words(text)
    if not words:
        return set()
    return {tuple(words[i:i + window]) for i in range(max(1, len(words) - window + 1))}


def build_automaton(items: list[tuple[int | None, str | None]], window: int):
    """The items' words (UTF-8) as numbers from 1, and the automaton of their windows over these numbers;
    a pattern's value is (its words, its item ids). Then, for :func:`stretches`, the pairs of neighbours in
    windows, the words that are a window alone, and the least length of the other windows (none: 0)."""
    import ahocorasick

    owners: dict[tuple, set] = {}
    numbers: dict[str, int] = {}
    for item, text in items:
        for w in item_windows(text, window):
            owners.setdefault(tuple(numbers.setdefault(x.encode(), len(numbers) + 1) for x in w), set()).add(item)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for w, ids in owners.items():
        automaton.add_word(w, (len(w), tuple(i for i in ids if i is not None)))
    automaton.make_automaton()
    pairs = {p for w in owners for p in zip(w, w[1:])}
    alone = {w[0] for w in owners if len(w) == 1}
    return numbers, automaton, pairs, alone, min((len(w) for w in owners if len(w) > 1), default=0)


def stretches(known: list[int], pairs: set, alone: set, least: int) -> Iterator[tuple[int, tuple[int, ...]]]:
    """Parts of ``known`` (word numbers, 0: in no item) that can hold a window, each with its first position."""
    if least:
        paired = bytes(map(pairs.__contains__, zip(known, islice(known, 1, None))))
        for run in re.finditer(b"\x01{%d,}" % (least - 1), paired):
            yield run.start(), tuple(known[run.start():run.end() + 1])
    if alone and not alone.isdisjoint(known):
        for at, x in enumerate(known):
            if x in alone:
                yield at, (x,)


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted word ranges (both ends included) without overlap."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(x) for x in out]


def scan(numbers: dict[bytes, int], automaton, pairs: set, alone: set, least: int, text: str | None):
    """Number of words, word ranges that are hit, and the items that occur in ``text``."""
    words = text.encode().translate(TO_WORDS).split() if text else []
    hits, items = [], set()
    for at, part in stretches(list(map(numbers.get, words, repeat(0))), pairs, alone, least):
        for end, (n, ids) in automaton.iter(part):
            first, last = at + end - n + 1, at + end
            if hits and hits[-1][0] <= first <= hits[-1][1] + 1:
                hits[-1] = (hits[-1][0], max(hits[-1][1], last))
            else:
                hits.append((first, last))
            items.update(ids)
    return len(words), merge_spans(hits), items


def _scanner(shared):
    def run(texts: pa.Array) -> pa.Array:
        windows = shared.value
        n_words, spans, items = [], [], []
        for at in range(len(texts)):
            n, hit, found = scan(*windows, texts[at].as_py())
            n_words.append(n)
            spans.append([{"first": a, "last": b} for a, b in hit])
            items.append(sorted(found))
        return pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), pa.array(spans, SPANS), pa.array(items, pa.list_(pa.int64()))],
                                          names=["n_words", "spans", "items"])
    return run


def _merged(first, last):
    """Word ranges of two scans as one list without overlap, on the JVM."""
    ranges = F.array_sort(F.concat(first, last))
    start = F.array().cast(SPAN_TYPE)
    return F.aggregate(ranges, start, lambda acc, s: F.when(
        (F.size(acc) > 0) & (s["first"] <= F.get(acc, F.size(acc) - 1)["last"] + 1),
        F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(
            F.get(acc, F.size(acc) - 1)["first"].alias("first"),
            F.greatest(F.get(acc, F.size(acc) - 1)["last"], s["last"]).alias("last")))))
        .otherwise(F.concat(acc, F.array(s))))


def find_benchmark_text(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = 10,
                        max_nodes: int = 1_000_000) -> DataFrame:
    """``docs`` and, for each row, the benchmark text found in it.

    Adds ``n_words``, ``n_hit`` (words inside an occurrence of a window),
    ``n_items``, ``items`` (sorted ids), ``items_sha256`` (of the ids sorted as
    strings and joined by commas), ``contaminated`` (n_hit > 0) and ``spans`` (merged
    word ranges, both ends included; :func:`original_offsets` gives characters).

    * null, empty or word-free texts: no words, no hits; such items: no windows;
    * an item id on several rows (a question and its answer) is one item; an item
      without an id can hit words but is not counted or listed;
    * an empty benchmark leaves every document clean; empty ``docs`` give no rows;
    * repeated rows are scanned alike; a column named like an added one is replaced.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    # At most bytes / 2 + 1 words, each the start of a window of as many nodes as it has words.
    size = items.agg(F.sum(F.octet_length("text") / 2 + 1)).first()[0] or 0
    blocks = max(1, math.ceil(size * window / max_nodes))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    kept = [c for c in docs.columns if c not in ADDED]
    found = docs.select(F.struct(F.lit(0).alias("_"), *(F.col(f"`{c}`") for c in kept)).alias("row"),
                        F.col(f"`{text_col}`").cast("string").alias("text"),
                        F.lit(0).cast("long").alias("n_words"), F.array().cast(SPAN_TYPE).alias("spans"),
                        F.array().cast("array<long>").alias("items"))
    old, new = Scratch(spark, "decontaminate"), Scratch(spark, "decontaminate")
    for b in range(blocks):
        # One block of items comes to the driver at once.
        rows = [(r.item_id, r.text) for r in items.filter(F.col("block") == b).toLocalIterator()]
        shared = spark.sparkContext.broadcast(build_automaton(rows, window))
        found = found.withColumn("scan", F.arrow_udf(_scanner(shared), SCAN_TYPE)("text")).select(
            "row", "text", F.col("scan.n_words").alias("n_words"),
            (_merged(F.col("spans"), F.col("scan.spans")) if b else F.col("scan.spans")).alias("spans"),
            (F.array_sort(F.array_union("items", "scan.items")) if b else F.col("scan.items")).alias("items"))
        if b < blocks - 1:  # a written table between passes: a task holds one automaton
            found = new.stage(found, f"pass-{b}", keep=b == blocks - 2)
            shared.destroy()
            old.clear()
            old, new = new, Scratch(spark, "decontaminate")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    ids = F.array_join(F.array_sort(F.col("items").cast("array<string>")), ",")
    found = found.withColumn("n_hit", n_hit)
    return found.select(
        *(F.col(f"row.`{c}`").alias(c) for c in kept), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        "items", F.sha2(ids.cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"), "spans")


def original_offsets(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character ranges of ``text`` (end excluded) for merged word ranges."""
    words = [m.span() for m in WORD.finditer(text.translate(FOLD))]
    return [(words[a][0], words[b][1]) for a, b in spans]
