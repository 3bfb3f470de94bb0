"""Language identification by string-kernel classification.

Two texts are compared by the blended-spectrum presence kernel: the number of
character n-grams of lengths 1 to 4 (hashed) that both contain, divided by the
root of the product of their own numbers. A text longer than ``PIECE`` characters is
cut into equal pieces and stands for the mean of their rows, scaled to length 1, so that
no text is so long that it holds every hashed n-gram. A bounded set of landmark texts gives
Nystroem features, K(x, landmarks) K(landmarks, landmarks)^(-1/2), on which one
ridge regression against the rest is fitted for each language. Whole texts are
scored in batches: a matrix of n-gram weights times the landmarks' matrix, times
the weights.

The classifier is fitted on a bounded sample of labelled rows, ``per_language``
for each language, in the order of a hash of the key; the first of them are the
landmarks. The bound does not depend on the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.llm import wordhash as W

U = np.uint64
GRAMS = (1, 2, 3, 4)
BINS = 1 << 14
BATCH = 64
BLOCK = 1 << 18
PIECE = 1 << 12
Row = tuple[np.ndarray, np.ndarray]


class Grams:
    """Presence of hashed character n-grams; letters only, lower case, other runs as one blank."""

    def __init__(self, low: np.ndarray | None = None):
        self.low = self.letters() if low is None else low

    @staticmethod
    def letters() -> np.ndarray:
        """The lower-case code point of every letter, 0 for all that is no letter."""
        points = [chr(i) for i in range(0x110000)]
        letter = np.fromiter((c.isalpha() for c in points), bool, len(points))
        low = np.zeros(len(points), dtype=np.uint32)
        for i in np.flatnonzero(letter):
            lowered = points[i].lower()
            low[i] = ord(lowered) if len(lowered) == 1 else i
        return low

    def bins(self, text: str | None) -> np.ndarray | None:
        """Sorted distinct bins of a whole text; None if it has no letter."""
        found = np.zeros(BINS, dtype=bool)
        some, tail = False, np.zeros(0, dtype=np.uint32)
        text = text or ""
        for at in range(0, len(text), BLOCK):
            part = text[at:at + BLOCK].encode("utf-32-le", "surrogatepass")
            codes = np.concatenate([tail, self.low[np.frombuffer(part, np.uint32)]])
            # Runs of other characters become one blank (code 0).
            codes = codes[(codes != 0) | np.concatenate([[True], codes[:-1] != 0])]
            some = some or bool(codes.any())
            hashed = np.zeros(len(codes), dtype=U)
            for n in range(1, GRAMS[-1] + 1):
                m = len(codes) - n + 1
                if m <= 0:
                    break
                hashed = hashed[:m] * U(0x100000001B3) + codes[n - 1:].astype(U) + U(1)
                if n in GRAMS:
                    found[(W.mix(hashed + U(n)) & U(BINS - 1)).astype(np.int64)] = True
            tail = codes[-(GRAMS[-1] - 1):]
        return np.flatnonzero(found) if some else None

    def row(self, text: str | None) -> Row | None:
        """Bins and weights of a whole text, of length 1; None if it has no letter."""
        text = text or ""
        total, n = np.zeros(BINS), -(-len(text) // PIECE)
        for i in range(n):
            # Each piece goes on to the end of the n-grams that start in it.
            bins = self.bins(text[i * len(text) // n:(i + 1) * len(text) // n + GRAMS[-1] - 1])
            if bins is not None:
                total[bins] += 1 / np.sqrt(len(bins))
        bins = np.flatnonzero(total)
        return (bins, (total[bins] / np.linalg.norm(total)).astype(np.float32)) if len(bins) else None


def _matrix(rows: list[Row]) -> np.ndarray:
    x = np.zeros((len(rows), BINS), dtype=np.float32)
    for i, (bins, weights) in enumerate(rows):
        x[i, bins] = weights
    return x


class Classifier:
    """Landmarks (BINS x m, scaled), weights (m x languages), intercepts and language names."""

    def __init__(self, landmarks: np.ndarray, weights: np.ndarray, intercept: np.ndarray, names: list[str]):
        self.landmarks, self.weights, self.intercept, self.names = landmarks, weights, intercept, names

    def scores(self, rows: list[Row]) -> np.ndarray:
        """One score for each text and language, near 1 for the right one and 0 for the others."""
        return (_matrix(rows) @ self.landmarks) @ self.weights + self.intercept


def fit(samples: list[tuple[str, Row]], landmarks_per_language: int = 32, ridge: float = 1e-2) -> Classifier | None:
    """The classifier for (language, row) samples; None without samples."""
    names = sorted({lang for lang, _ in samples})
    if not names:
        return None
    seen: dict[str, int] = {}
    chosen = []
    for lang, row in samples:
        seen[lang] = seen.get(lang, 0) + 1
        if seen[lang] <= landmarks_per_language:
            chosen.append(row)
    marks = np.ascontiguousarray(_matrix(chosen).T)
    values, vectors = np.linalg.eigh((marks.T @ marks).astype(np.float64))
    keep = values > 1e-6 * values.max()
    root = (vectors[:, keep] / np.sqrt(values[keep])) @ vectors[:, keep].T
    features = []
    for at in range(0, len(samples), BATCH):
        features.append(_matrix([row for _, row in samples[at:at + BATCH]]) @ marks @ root)
    z = np.concatenate(features)
    y = np.array([[float(lang == name) for name in names] for lang, _ in samples])
    mean, base = z.mean(axis=0), y.mean(axis=0)
    gram = (z - mean).T @ (z - mean) / len(z) + ridge * np.eye(z.shape[1])
    w = np.linalg.solve(gram, (z - mean).T @ (y - base) / len(z))
    return Classifier(marks, root @ w, base - mean @ w, names)


def _sample_rows(letters):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(letters.value)
        for batch in batches:
            rows = [grams.row(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([None if r is None else r[0].tolist() for r in rows], pa.list_(pa.int32())),
                 pa.array([None if r is None else r[1].tolist() for r in rows], pa.list_(pa.float32())), batch.column(2)],
                names=["lang", "bins", "weights", "at"])
    return run


def training_sample(labelled: DataFrame, per_language: int, letters=None) -> list[tuple[str, Row]]:
    """Up to ``per_language`` texts of each language, in the order of their key's hash, as (language, row).

    ``labelled`` has ``key``, ``text`` and ``lang``. A first pass counts the languages; the second
    reads only rows whose hash is below the share that gives a little more than wanted.
    The counts come to the driver, as the model does that has a column for each language.
    """
    counts = {r.lang: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return []
    wanted = per_language + 4 * per_language ** 0.5 + 10
    share = F.create_map(*(F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, wanted / n)))
    at = F.pmod(F.xxhash64(F.col("key"), F.lit(17)), F.lit(1 << 30))
    picked = labelled.filter(at / float(1 << 30) < F.element_at(share, F.col("lang")))
    letters = letters or labelled.sparkSession.sparkContext.broadcast(Grams.letters())
    rows = picked.select("lang", "text", at.alias("at")).mapInArrow(
        _sample_rows(letters), "lang string, bins array<int>, weights array<float>, at long").filter("bins IS NOT NULL").collect()
    by_lang: dict[str, list] = {}
    for r in rows:
        by_lang.setdefault(r.lang, []).append((r.at, r.bins, r.weights))
    return [(lang, (np.array(b), np.array(w, dtype=np.float32)))
            for lang, found in sorted(by_lang.items()) for _, b, w in sorted(found)[:per_language]]


def _predictor(letters, shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, model = Grams(letters.value), Classifier(*shared.value) if shared.value else None
        for batch in batches:
            texts = batch.column(1)
            for at in range(0, len(batch), BATCH):
                rows = [grams.row(t) for t in texts.slice(at, BATCH).to_pylist()]
                some = [i for i, r in enumerate(rows) if r is not None] if model else []
                names, scores = ["und"] * len(rows), np.zeros(len(rows))
                if some:
                    s = model.scores([rows[i] for i in some])
                    for i, best, score in zip(some, s.argmax(axis=1), s.max(axis=1)):
                        names[i], scores[i] = model.names[best], min(1.0, max(0.0, float(score)))
                part = batch.slice(at, BATCH)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(names), pa.array(scores)],
                                                 names=["doc_id", "held_out", "lang_pred", "score"])
    return run


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       per_language: int = 256) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row.

    Rows whose crc32 of the id (as text) is divisible by 5 are held out; the rest
    with a language teach. A prediction looks at the text alone.

    * null text, or text without a letter: ``und``, score 0 (so is every text if no
      row teaches);
    * a null id counts as empty text in the crc, so it is held out;
    * repeated rows get equal predictions; an empty table gives an empty result;
      other columns are ignored.
    """
    spark = docs.sparkSession
    held_out = F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(True))
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                       held_out.alias("held_out"), F.col(lang_col).cast("string").alias("lang"))
    teach = slim.filter("NOT held_out AND lang IS NOT NULL AND text IS NOT NULL")
    # Broadcasts hold plain arrays: an instance of a class would need the package on the executors.
    letters = spark.sparkContext.broadcast(Grams.letters())
    model = fit(training_sample(teach.select(F.col("doc_id").alias("key"), "text", "lang"), per_language, letters))
    shared = spark.sparkContext.broadcast(model and (model.landmarks, model.weights, model.intercept, model.names))
    return slim.select("doc_id", "text", "held_out").mapInArrow(
        _predictor(letters, shared), "doc_id long, held_out boolean, lang_pred string, score double")
