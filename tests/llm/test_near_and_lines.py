"""Near-duplicate groups and line dedup against brute force, and their defined corner cases."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from meterwise.llm import line_dedup as L
from meterwise.llm import near_dup as N
from meterwise.llm import wordhash as W
from meterwise.llm.graph import components
from meterwise.llm.store import Scratch

SCHEMA = "doc_id long, text string, n_shingles string, gone int"


def words(text, low=False):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "") if low else text or "")


def brute_groups(rows):
    sets = []
    for _, text in rows:
        w = words(text, True)
        sets.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = {d: d for d, _ in rows if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (a, _) in enumerate(rows):
        for j, (b, _) in enumerate(rows[:i]):
            both = len(sets[i] & sets[j])
            if a is not None and b is not None and both and 100 * both >= 75 * len(sets[i] | sets[j]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return [(d, len(s), None if d is None else find(d), d is None or find(d) == d) for (d, _), s in zip(rows, sets)]


def corpus(seed=1, n=60):
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(200)]
    base = [[rnd.choice(vocabulary) for _ in range(rnd.randint(20, 120))] for _ in range(n // 4)]
    rows = []
    for i in range(n):
        w = list(rnd.choice(base))
        for _ in range(rnd.choice([0, 0, 1, 2, 4, 8])):
            w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        rows.append((1000 - i, " ".join(w)))
    return rows


def test_groups_equal_brute_force(spark):
    rows = corpus() + [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "oNE  two"), (6, "three"), (None, "one two"),
                       (7, "x " * 3000), (8, "x " * 5000), (9, "É" * 70000), (1000, corpus()[0][1])]
    got = N.near_duplicate_groups(spark.createDataFrame([(*r, "z", 1) for r in rows], SCHEMA)).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute_groups(rows), key=key)


def test_rows_of_one_id_are_one_vertex(spark):
    rows = [(1, "a b c d e f"), (2, "g h i j k l"), (2, "a b c d e f"), (3, "g h i j k l")]
    got = {(r.doc_id, r.component_id) for r in N.near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 1), (2, 1), (3, 1)}


def test_large_group_of_near_copies_is_one_component(spark):
    base = [f"v{i}" for i in range(300)]
    rows = [(i, " ".join(base[:i] + ["edit"] + base[i + 1:])) for i in range(250)]
    got = N.near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0} and sum(r.kept for r in got) == 1


def test_sets_are_shuffled_once_and_only_for_buckets_of_several_components(spark, monkeypatch):
    staged = {}
    stage = Scratch.stage
    monkeypatch.setattr(Scratch, "clear", lambda self: None)

    def spy(self, df, name, keep=False):
        staged[name] = df
        return stage(self, df, name, keep)
    monkeypatch.setattr(Scratch, "stage", spy)
    N.near_duplicate_groups(spark.createDataFrame(corpus(), "doc_id long, text string")).collect()
    assert not staged["near-mixed"].groupBy("key").agg(F.count_distinct("comp").alias("n")).filter("n < 2").count()
    # Both sides of the last join ask for the same not-null columns, so that one shuffle serves both.
    plan = staged["links"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("isnotnull(keys") == 2


def test_low_similarity_is_refused(spark):
    with pytest.raises(ValueError):
        N.near_duplicate_groups(spark.createDataFrame([], "doc_id long, text string"), percent=50)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert N.near_duplicate_groups(docs).count() == 0
    assert L.dedup_lines(docs).count() == 0


def test_sketch_bound_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(3)
    for n in (4, 12, 150, 1200):
        for _ in range(100):
            x = np.sort(rng.integers(0, 2**63, n).astype(np.uint64))
            y = np.sort(rng.permutation(x)[:int(np.ceil(0.75 * n))])
            s = N.sketches(np.concatenate([x, y]), np.array([0, n]))
            nibbles = lambda v: sum(int(q) >> k & 15 > 0 for q in v for k in range(0, 64, 4))
            assert 1000 * nibbles(s[0] ^ s[1]) <= N.MAX_DIFFERENT * nibbles(s[0] | s[1]) + 1000


def test_components(spark):
    rnd = random.Random(5)
    edges = [(rnd.randrange(80), rnd.randrange(80)) for _ in range(50)] + [(i, i + 1) for i in range(200, 260)]
    root = list(range(300))
    for _ in range(300):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.comp for r in components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "t")).collect()}
    assert got == {i: root[i] for i in {x for e in edges for x in e} if root[i] != i}


def test_word_hashes_are_the_same_in_any_block(monkeypatch):
    text = ("Ab  é\tcd\n" * 50 + "x" * 100 + " ") * 3
    def run(block):
        monkeypatch.setattr(W, "BLOCK", block)
        h = W.Hasher(lower=True)
        return [x.tolist() for _, _, d, o in W.slices(pa.array([text, None, "", text]), 1 << 20) for x in h.words(d, o)]
    assert run(64) == run(1 << 20)
    assert len(run(64)[0]) == 2 * len(words(text))


def brute_lines(rows, min_words=5, near_min=10):
    first, order, by_size, near = {}, [], defaultdict(list), set()
    for d, t in rows:
        for i, line in enumerate((t or "").split("\n")):
            w = tuple(words(line))
            if len(w) >= min_words and w not in first:
                first[w] = (d, i)
                order.append(w)
    for w in order:
        if len(w) >= near_min:
            if any(L.within_one_edit(list(w), list(x)) for n in (-1, 0, 1) for x in by_size[len(w) + n]):
                near.add(w)
            by_size[len(w)].append(w)
    out = []
    for d, t in rows:
        kept, exact, close = [], 0, 0
        for i, line in enumerate((t or "").split("\n")):
            w = tuple(words(line))
            if len(w) >= min_words and first[w] != (d, i):
                exact += 1
            elif w in near:
                close += 1
            else:
                kept.append(line)
        out.append((d, 0 if t is None else len(t.split("\n")), exact, close, None if t is None else "\n".join(kept)))
    return out


def test_lines_equal_brute_force(spark):
    rnd = random.Random(2)
    base = [" ".join(rnd.choice("abcdefgh") * 2 for _ in range(rnd.randint(3, 14))) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rnd.randint(1, 8)):
            w = rnd.choice(base).split()
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                at = rnd.randrange(len(w) + 1)
                rnd.choice([lambda: w.insert(at, "new"), lambda: w.__setitem__(slice(at, at + 1), ["other"]),
                            lambda: w.__delitem__(slice(at, at + 1))])()
            lines.append(rnd.choice(["  ", "\t"]).join(w))
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n\n"), (103, "t " * 4000), (104, "t " * 4001)]
    got = L.dedup_lines(spark.createDataFrame([(*r, "s", 5) for r in rows], SCHEMA))
    assert got.columns == ["doc_id", "text", "n_shingles", "gone", "n_lines", "n_exact", "n_near", "emptied"]
    found = sorted((r.doc_id, r.n_lines, r.n_exact, r.n_near, r.text) for r in got.collect())
    assert found == brute_lines(rows)
    assert {(r.n_shingles, r.gone) for r in got.collect()} == {("s", 5)}


def test_whole_texts_go_to_python_in_small_batches(spark):
    from meterwise.llm.packed import BATCH

    def sizes(batches):
        yield pa.RecordBatch.from_arrays([pa.array([max(len(b) for b in batches)], pa.int64())], names=["n"])
    old = {key: spark.conf.get(key) for key in BATCH}
    try:
        for key in BATCH:
            spark.conf.unset(key)
        L.dedup_lines(spark.createDataFrame([], SCHEMA))
        assert spark.range(5000).coalesce(1).mapInArrow(sizes, "n long").first().n <= 1000
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
        L.dedup_lines(spark.createDataFrame([], SCHEMA))
        assert spark.range(5000).coalesce(1).mapInArrow(sizes, "n long").first().n <= 10
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_lines_of_repeated_rows_and_null_ids(spark):
    line = "one two three four five six"
    rows = [(1, line), (1, line), (None, line), (2, line + "\nshort")]
    got = sorted(((r.doc_id or 0, r.text, r.emptied) for r in L.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == [(0, "", True), (1, line, False), (1, line, False), (2, "short", False)]


def test_short_lines_of_the_query_and_the_pipeline(spark, out):
    import corpus_pipeline as P
    from meterwise.llm.queries import QUERIES

    rnd = random.Random(4)
    rows = [(i, "\n".join(" ".join(rnd.choice("abcd") for _ in range(rnd.choice([0, 1, 2, 3, 4, 5, 7, 9, 10, 11]))) for _ in range(6)))
            for i in range(60)]
    rows += [(100, "Les.\none two three four five"), (101, "Les.\none two three four changed"), (102, "Les. \nkept"), (103, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{out}/documents.parquet")
    found = sorted((r.doc_id, r.n_lines, r.n_exact, r.n_near, r.text) for r in QUERIES["op7_line_dedup"](spark, out).collect())
    expected = brute_lines(rows, 1, 5)
    assert found == expected and expected[-4:-1] == [(100, 2, 0, 0, rows[-4][1]), (101, 2, 1, 1, ""), (102, 2, 1, 0, "kept")]
    docs = spark.read.parquet(f"{out}/documents.parquet")
    left = {r.doc_id: r.text for r in P.lines(spark, docs, out).collect()}
    assert left == {d: t for d, _, exact, near, t in expected if not exact + near or (t and t.strip())}
