"""Toxicity by averaged subword embeddings and a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (3 to 5, with its ends marked) and itself, hashed
to ``BUCKETS`` rows of an embedding matrix; a piece of a text is the average of its words'
averages, and a linear softmax over two classes judges it. A misspelt word that was never
seen shares most of its n-grams, so their vectors judge it too. A text is cut into
pieces of ``PIECE`` words, so that a few words weigh the same in a short text and in a
long one; its score is its worst piece's. Embeddings and softmax are trained together from the texts' labels:
the pieces of a text share its loss by a softmax over their own logits, which starts as the plain
average and sharpens as the model learns which pieces a label is about.

The model is fitted on a bounded sample of labelled rows: ``per_class`` texts of each class of at
most ``max_chars`` characters. Scoring reads whole texts. Since averaging and the softmax's difference
of logits are both linear, a bucket's part in a logit is one number: what
executors get is that vector, a plain array of 1 MB.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.llm import wordhash as W

U = np.uint64
GRAMS = (3, 4, 5)
BUCKETS = 1 << 18
DIM = 8
PIECE = 4
BLOCK = 1 << 18
BLANKS = [0x20, *range(0x09, 0x0E)]
ADDED = ["held_out", "score", "predicted"]


def word_codes(text: str) -> np.ndarray:
    """Code points + 1 of the lower-cased text, one 0 before, between and after its words."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(U) + U(1)
    codes[np.isin(codes, np.array(BLANKS, U) + U(1))] = 0
    codes = np.concatenate([np.zeros(1, U), codes, np.zeros(1, U)])
    return codes[(codes != 0) | np.concatenate([[True], codes[:-1] != 0])]


def subwords(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every n-gram and every whole word of ``codes``."""
    blank = np.flatnonzero(codes == 0)
    if len(blank) < 2:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    size = np.diff(blank) - 1
    word = np.repeat(np.arange(len(size)), size + 1)  # of each position but the last
    end = blank[1:][word]  # the blank after the position's word
    at = np.arange(len(word))
    words, buckets = [], []
    rolled = codes.copy()
    for n in range(2, GRAMS[-1] + 1):
        rolled = rolled[:-1] * U(0x100000001B3) + codes[n - 1:]
        if n in GRAMS:
            inside = np.flatnonzero(at[:len(rolled)] + n - 1 <= end[:len(rolled)])
            words.append(word[inside])
            buckets.append(W.mix(rolled[inside] + U(n)) & U(BUCKETS - 1))
    whole = np.add.reduceat(W.mix(codes[:-1] + (at - blank[word]).astype(U) * U(W.BASE)), blank[:-1])
    words.append(np.arange(len(size)))
    buckets.append(W.mix(whole) & U(BUCKETS - 1))
    return np.concatenate(words), np.concatenate(buckets).astype(np.int64)


def blocks(text: str | None) -> Iterator[str]:
    """The whole text in blocks that end between words (a longer word is one block)."""
    text, at = text or "", 0
    while at < len(text):
        stop = at + BLOCK
        while stop < len(text) and ord(text[stop]) not in BLANKS:
            stop += 1
        yield text[at:stop]
        at = stop


def word_logits(part: np.ndarray, text: str) -> np.ndarray:
    """Average over each word's subwords of their part in the logit."""
    word, bucket = subwords(word_codes(text))
    if not len(word):
        return np.zeros(0)
    return np.bincount(word, weights=part[bucket]) / np.bincount(word)


def piece_starts(n: int) -> np.ndarray:
    """First words of the pieces of a text of ``n`` words: equal pieces of at most ``PIECE``."""
    k = -(-n // PIECE)
    return np.arange(k) * n // max(k, 1)


def text_score(part: np.ndarray, bias: float, text: str | None) -> float:
    found = [word_logits(part, b) for b in blocks(text)]
    words = np.concatenate(found) if found else np.zeros(0)
    worst = 0.0
    if len(words):
        starts = piece_starts(len(words))
        worst = float((np.add.reduceat(words, starts) / np.diff(np.append(starts, len(words)))).max())
    return float(1 / (1 + np.exp(-np.clip(worst + bias, -500, 500))))


def train(texts: list[str | None], toxic: list[bool], min_texts: int = 8, rounds: int = 150, rate: float = 0.2,
          seed: int = 13) -> tuple[np.ndarray, float] | None:
    """Each bucket's part in the logit and the bias; None unless both classes have a text.

    Buckets of fewer than ``min_texts`` texts keep the zero vector. Steepest descent with momentum on the
    class-balanced loss, from a fixed seed; a step moves the entry with the largest slope by ``rate``, so
    subwords that many texts of one class share lead and rare ones hardly move. With z = x W + b, the slope of a
    bucket's vector is a number times the difference of W's columns, so one number a bucket is summed.
    """
    y = np.array(toxic, float)
    if not len(y) or y.min() == y.max():
        return None
    # Distinct words once; every text as word numbers, cut into pieces.
    vocabulary: dict[str, int] = {}
    tokens, piece, owner = [], [], []
    for i, text in enumerate(texts):
        words = [w for w in (text or "").lower().translate({b: " " for b in BLANKS}).split(" ") if w]
        starts = set(piece_starts(len(words)).tolist())
        if not words:
            owner.append(i)
        for j, w in enumerate(words):
            if j in starts:
                owner.append(i)
            tokens.append(vocabulary.setdefault(w, len(vocabulary)))
            piece.append(len(owner) - 1)
    tokens, piece, owner = (np.array(a, np.int64) for a in (tokens, piece, owner))
    first = np.searchsorted(owner, np.arange(len(y)))  # every text has a piece
    word, bucket = subwords(word_codes(" ".join(vocabulary)))
    grams = np.maximum(np.bincount(word, minlength=len(vocabulary)), 1)
    sizes = np.maximum(np.bincount(piece, minlength=len(owner)), 1)
    common = _common(tokens, owner[piece], word, bucket, min_texts)
    word, bucket = word[common[bucket]], bucket[common[bucket]]
    used, bucket = np.unique(bucket, return_inverse=True)
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))

    rng = np.random.default_rng(seed)
    model = {"e": rng.uniform(-1, 1, (len(used), DIM)) / 1000, "w": rng.uniform(-1, 1, (DIM, 2)) / DIM, "b": np.zeros(2)}
    pace = {k: np.zeros_like(v) for k, v in model.items()}
    sides = np.array([-1.0, 1.0])
    for t in range(1, rounds + 1):
        apart = model["w"] @ sides
        words = np.bincount(word, (model["e"] @ apart)[bucket], len(vocabulary)) / grams
        gap = np.bincount(piece, words[tokens], len(owner)) / sizes + model["b"] @ sides
        top = np.maximum.reduceat(gap, first)
        weight = np.exp(gap - top[owner])
        weight /= np.add.reduceat(weight, first)[owner]
        pooled = np.add.reduceat(weight * gap, first)
        error = (1 / (1 + np.exp(-np.clip(pooled, -30, 30))) - y) * share
        down = weight * (1 + gap - pooled[owner]) * error[owner]
        back = np.bincount(tokens, (down / sizes)[piece], len(vocabulary)) / grams
        back = np.bincount(bucket, back[word], len(used))
        slopes = {"e": np.outer(back, apart), "w": np.outer(model["e"].T @ back, sides), "b": down.sum() * sides}
        for k, g in slopes.items():
            pace[k] += 0.1 * (g - pace[k])
            model[k] -= rate * (1 - t / (rounds + 1)) * pace[k] / max(np.abs(pace[k]).max(initial=0), 1e-12)
    part = np.zeros(BUCKETS, np.float32)
    part[used] = model["e"] @ model["w"] @ sides
    return part, float(model["b"] @ sides)


def _common(tokens: np.ndarray, text: np.ndarray, word: np.ndarray, bucket: np.ndarray, least: int) -> np.ndarray:
    """Which buckets occur in at least ``least`` texts; ``word`` and ``bucket`` are the words' subwords."""
    seen = np.unique(text * (tokens.max(initial=0) + 1) + tokens)
    order = np.argsort(word, kind="stable")
    word, bucket = word[order], bucket[order]
    start = np.searchsorted(word, np.arange(tokens.max(initial=0) + 2))
    counts = np.zeros(BUCKETS, np.int64)
    for block in np.array_split(seen, max(1, len(seen) // 100_000)):
        t, w = np.divmod(block, tokens.max(initial=0) + 1)
        n = start[w + 1] - start[w]
        at = np.repeat(start[w] - np.cumsum(n) + n, n) + np.arange(n.sum())
        pair = np.unique(np.repeat(t, n) * BUCKETS + bucket[at])
        counts += np.bincount(pair % BUCKETS, minlength=BUCKETS)
    return counts >= least


def training_sample(votes: DataFrame, texts: DataFrame, per_class: int) -> tuple[list[str | None], list[bool]]:
    """Up to ``per_class`` texts of each class in the order of their key's hash.

    ``votes`` has one row for each ``key``, with ``toxic``; ``texts`` has ``key`` and ``text``. Keys are chosen
    by hash at the rate that gives a little more than wanted, so their number is bounded, and an id
    on several rows gives one text: a bounded number of texts moves at all.
    """
    n = {r.toxic: r["count"] for r in votes.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return [], []
    wanted = per_class + 4 * per_class ** 0.5 + 10
    at = F.pmod(F.xxhash64("key", F.lit(29)), F.lit(1 << 30))
    limit = F.when(F.col("toxic"), wanted / n[True]).otherwise(wanted / n[False])
    chosen = F.broadcast(votes.filter(at / float(1 << 30) < limit).select("key", "toxic", at.alias("at")))
    rows = texts.join(chosen, "key").groupBy("key", "toxic", "at").agg(F.min_by("text", F.xxhash64("text")).alias("text")).collect()
    out, toxic = [], []
    for kind in (False, True):
        for r in sorted((r for r in rows if r.toxic == kind), key=lambda r: (r.at, r.key))[:per_class]:
            out.append(r.text)
            toxic.append(kind)
    return out, toxic


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "toxic", per_class: int = 1500, max_chars: int = 8000,
                   threshold: float = 0.7) -> DataFrame:
    """``docs`` with ``held_out`` (crc32 of the id as text, modulo 3, is 1), ``score`` and ``predicted``.

    ``labels`` has the id and ``label_col`` (0 or 1); the mean of an id's labels counts, 1 from one half on.
    Held-out rows teach nothing; a score looks at the text alone. ``predicted`` is 1 where score >= ``threshold``.

    * null, empty or blank text: the score of no words (the softmax's bias alone);
    * a null id: not held out, and never labelled;
    * an id on several rows teaches once, with the text of the least hash; repeated rows get equal scores;
    * labels of one class only, or none: score 0 everywhere;
    * an empty table gives an empty result; every other column passes through, and one named like
      an added column is replaced.
    """
    spark = docs.sparkSession
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`").cast("string")
    def tested(k: Column) -> Column:
        return F.coalesce(F.crc32(k.cast("string").cast("binary")) % 3 == 1, F.lit(False))

    held_out = tested(key)
    votes = (labels.select(F.col(f"`{id_col}`").cast("long").alias("key"), F.col(f"`{label_col}`").cast("double").alias("vote"))
             .filter(F.col("key").isNotNull() & F.col("vote").isNotNull() & ~tested(F.col("key")))
             .groupBy("key").agg((F.avg("vote") >= 0.5).alias("toxic")))
    short = docs.select(key.cast("long").alias("key"), text.alias("text")).filter(F.coalesce(F.length("text"), F.lit(0)) <= max_chars)
    model = train(*training_sample(votes, short, per_class))
    shared = spark.sparkContext.broadcast(model)

    def score(texts: pa.Array) -> pa.Array:
        found = shared.value
        return pa.array([text_score(*found, t) if found else 0.0 for t in texts.to_pylist()], pa.float64())

    kept = [c for c in docs.columns if c not in ADDED]
    scored = docs.select(*(F.col(f"`{c}`") for c in kept), held_out.alias("held_out"),
                         F.arrow_udf(score, "double")(text).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
