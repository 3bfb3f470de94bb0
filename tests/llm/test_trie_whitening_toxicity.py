"""Operators 11 to 13 against brute force, and their corner cases."""

import hashlib
import os
import random
import subprocess
import sys
import zlib

import numpy as np
import pytest

from meterwise.llm import toxicity as X
from meterwise.llm import whitening as V
from meterwise.llm.prefix_trie import conversation_trie

TURNS = "conv_id long, turn long, role string, text string, depth int"


def brute_trie(rows):
    """Nodes of the rebuilt conversations, straight from the definition."""
    own = {}
    for c, turn, role, text, _ in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    key = lambda t: (t[0], t[1], hashlib.md5(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).hexdigest())
    own = {c: [(r, t) for _, _, r, t in sorted(ts, key=key)] for c, ts in own.items()}
    seqs = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        seqs[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    members = {}
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    out = {}
    for k, ids in members.items():
        below = [(n, m) for n, m in members.items() if n[:len(k)] == k]
        leaf = lambda n: not any(len(m) == len(n) + 1 and m[:len(n)] == n for m in members)
        ends = sorted(c for c in ids if len(seqs[c]) == len(k))
        out[(min(ids), len(k))] = (min(members[k[:-1]]) if k else None, len(ids), sum(len(m) == len(k) + 1 and m[:len(k)] == k for m in members),
                                   sum(leaf(n) for n, _ in below), sum((len(m) - 1) * len(n[-1][1].encode()) for n, m in below if n),
                                   hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
    return out


def trie(spark, rows):
    found = conversation_trie(spark.createDataFrame(rows, TURNS)).collect()
    got = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in found}
    assert len(got) == len(found)
    return got


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_brute_force(spark, seed, monkeypatch):
    from meterwise.llm import prefix_trie
    monkeypatch.setattr(prefix_trie, "CHUNK", 1)
    monkeypatch.setattr(prefix_trie, "PIECE", 3)
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-5, 60), 45):
        for t in range(rnd.choice([1, 2, 3, 5, 9, 14])):
            rows.append((c, rnd.choice([t, t, t, None, 0]), rnd.choice(["user", "user", None, ""]), rnd.choice(["a", "a", "é", "", None, "bb"]), 1))
    rows += [(7, t, "user", "a", 0) for t in range(37)] + [rows[0], rows[0], (None, 1, "user", "x", 0)]
    assert trie(spark, rows) == brute_trie(rows)


def test_trie_of_copies_and_long_texts(spark):
    rows = [(5 * i, t, "user", "x" * 20000 if t == 2 else "same", 0) for i in range(200) for t in range(10)]
    assert trie(spark, rows) == brute_trie(rows)
    assert conversation_trie(spark.createDataFrame([], TURNS)).count() == 0


VECTORS = "vec_id long, embedding array<float>, n int, w string"


@pytest.mark.parametrize("weights", ["counts", "one"])
def test_whitening_equals_dense_version(spark, weights):
    rng = np.random.default_rng(3)
    base = (rng.normal(size=(300, 6)) @ rng.normal(size=(6, 6))).astype(np.float32)
    rows = [(i, v.tolist(), 1, "x") for i, v in enumerate(base)] + [(1000 + i, base[0].tolist(), 1, "x") for i in range(150)]
    bad = [(1, None, 1, "x"), (2, [1.0] * 5 + [None], 1, None), (3, [float("nan")] + [0.0] * 5, None, "x"), (4, [float("inf")] * 6, 1, "x"),
           (5, [], 1, "x"), (6, [1.0] * 4, 1, "x"), (7, [3e38] * 6, 1, "x")]
    rows += [(None, base[1].tolist(), 1, "x")]
    found = V.whiten_embeddings(spark.createDataFrame(rows + bad, VECTORS), components=4, weights=weights).collect()
    assert sorted((r.vec_id is None, r.vec_id) for r in found if r.vec_id is not None) == sorted((False, r[0]) for r in rows if r[0] is not None)
    x = np.floor(64 * np.array([r[1] for r in rows], np.float32).astype(float)).astype(np.int64) + 1_000_000
    fit = x if weights == "counts" else np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    z = fit - s / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    order = np.argsort(-values)[:4]
    want = {r[0]: (a - s / n) @ vectors[:, order] / np.sqrt(values[order]) for r, a in zip(rows, x)}
    deviation = {r[0]: int(((n * a - s) ** 2).sum()) for r, a in zip(rows, x)}
    sign = np.sign(sum(np.array(r.whitened) * want[r.vec_id] for r in found))
    for r in found:
        assert r.n == n and r.deviation == deviation[r.vec_id] and r.identity_error < 1e-9
        assert np.array(r.whitened) * sign == pytest.approx(want[r.vec_id], abs=1e-9)
        assert r.explained == pytest.approx(values[order] / values.sum(), rel=1e-9)


def test_whitening_of_nothing_and_of_equal_vectors(spark):
    none = spark.createDataFrame([(1, None, 1, "")], VECTORS)
    assert V.whiten_embeddings(none).count() == 0 and V.whiten_embeddings(none.limit(0)).count() == 0
    same = V.whiten_embeddings(spark.createDataFrame([(i, [1.0, 2.0], 1, "") for i in range(3)], VECTORS)).collect()
    assert [(r.n, r.deviation, list(r.whitened)) for r in same] == [(3, 0, [])] * 3


def test_exact_sums_beyond_64_bits():
    x = np.array([[1 << 39, 0], [-(1 << 39), 5]], np.int64)
    sums = [s * 10**9 for s in (0, 5)]
    parts = V.Grid(2 * 10**9, sums).parts()
    want = [[2 * 10**9 * int(v) - s for v, s in zip(row, sums)] for row in x]
    assert [[int(v) for v in row] for row in V.centred(x, parts)] == want
    assert V._sums_of_squares(V.centred(x, parts)) == [None, None]


def toxic_rows(rnd, n):
    roots = ["grumble", "snarfle", "blighter"]
    word = lambda: "".join(rnd.choice("aeioutnrs") for _ in range(rnd.randint(2, 7)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rnd.randint(5, 120))]
        if i % 3 == 0:
            root = rnd.choice(roots)
            for _ in range(2):  # a misspelling of its own
                at = rnd.randrange(len(root))
                words.insert(rnd.randrange(len(words)), root[:at] + rnd.choice("xzq") + root[at + (rnd.random() < 0.5):])
        rows.append((i, " ".join(words), i % 3 == 0))
    return rows


def test_toxicity_of_unseen_misspellings(spark):
    rows = toxic_rows(random.Random(4), 900)
    docs = spark.createDataFrame([(i, t, "s", 9) for i, t, _ in rows] + [(10_001, None, "s", 1), (10_002, "", "s", 1), (None, rows[0][1], "s", 1)],
                                 "doc_id long, text string, source string, score int")
    labels = spark.createDataFrame([(i, int(x)) for i, _, x in rows] + [(None, 1), (3, None), (0, 1), (0, 1)], "doc_id long, toxic int")
    found = {r.doc_id: r for r in X.score_toxicity(docs, labels).collect()}
    held = [(found[i].predicted, int(x)) for i, _, x in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(found[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _, _ in rows)
    assert sum(a == b for a, b in held) >= 0.95 * len(held)
    assert found[None].score == found[0].score and found[10_001].score == found[10_002].score < 0.7


def test_toxicity_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert [(r.score, r.predicted) for r in X.score_toxicity(docs, labels).collect()] == [(0.0, 0)] * 2
    assert X.score_toxicity(docs.limit(0), labels).count() == 0


def test_held_out_labels_teach_nothing(spark):
    rows = toxic_rows(random.Random(6), 200)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    first, second = ([(i, int(x) if zlib.crc32(str(i).encode()) % 3 != 1 else flip) for i, _, x in rows] for flip in (0, 1))
    scores = [{r.doc_id: r.score for r in X.score_toxicity(docs, spark.createDataFrame(x, "doc_id long, toxic int")).collect()} for x in (first, second)]
    assert scores[0] == scores[1]


def test_subwords_are_those_of_the_definition(monkeypatch):
    words = ["Idiot", "a", "né", "xyzzyx"]
    word, bucket = X.subwords(X.word_codes("  ".join(words) + "\n"))
    for i, w in enumerate(words):
        marked = f"<{w}>"
        grams = sum(max(0, len(marked) - n + 1) for n in X.GRAMS)
        assert (word == i).sum() == grams + 1
        alone = X.subwords(X.word_codes(w))[1]
        assert sorted(bucket[word == i]) == sorted(alone)
    part = np.random.default_rng(1).normal(size=X.BUCKETS).astype(np.float32)
    text = " ".join(["idiot", "ok"] * 500) + " " + "w" * 700
    score = X.text_score(part, 0.1, text)
    monkeypatch.setattr(X, "BLOCK", 50)
    assert X.text_score(part, 0.1, text) == score


def test_queries_run_without_the_package_on_executors(tmp_path):
    """From another folder, with workers that can't import the package."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from meterwise.llm.queries import QUERIES
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").getOrCreate())
def probe(_):
    try:
        import meterwise
        return ["there"]
    except ImportError:
        return ["absent"]
assert spark.sparkContext.parallelize([1], 1).mapPartitions(probe).collect() == ["absent"]
for name, run in sorted(QUERIES.items()):
    assert run(spark, "/root/testdata/sf0.001").count() > 0, name
print("all ran", len(QUERIES))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert f"all ran 13" in done.stdout, done.stderr[-3000:]
