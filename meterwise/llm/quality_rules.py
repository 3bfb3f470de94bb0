"""Quality rules combined by weak supervision, in DataFrame functions only.

Each rule looks at counts of a document and votes good (1), bad (-1) or abstains
(0). How far a rule can be trusted is not set by hand: expectation-maximisation
estimates each rule's accuracy, the chance that a vote it gives is right, and the
posterior probability of good replaces an all-rules-must-pass filter. An
abstention is no evidence.

EM needs only the number of documents for each combination of votes, at most
3 to the number of rules rows however many documents there are; each iteration
is one aggregate over that table. The documents themselves are read once.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwise.llm.store import Scratch

#: Word separators are space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper"]
#: Belief before any vote: each rule's accuracy, counted as PRIOR_WEIGHT further votes
#: for each vote given, and the share of good documents, which stays as given (rules
#: that mostly abstain on good documents can't tell it).
ACCURACY, PRIOR_WEIGHT, GOOD = 0.9, 1.0, 0.6


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` and the six counts of each whole text (null counts as empty)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    step = docs.withColumn("_text", text)
    step = step.withColumn("_hash", F.transform(F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)))
    step = step.withColumn("_n", F.size("_hash").cast("long"))
    # A window is five consecutive words; its hash stands for it within its document.
    h = F.col("_hash")
    step = step.withColumn("_win", F.when(F.col("_n") >= 5, F.transform(
        F.sequence(F.lit(0), (F.greatest(F.col("_n"), F.lit(5)) - 5).cast("int")),
        lambda i: F.xxhash64(h[i], h[i + 1], h[i + 2], h[i + 3], h[i + 4]))))
    # Only documents with a repeated window sort theirs: (hash, position), equal hashes side by side.
    step = step.withColumn("_pairs", F.when(
        F.size(F.array_distinct("_win")) < F.size("_win"),
        F.sort_array(F.transform("_win", lambda x, i: F.struct(x.alias("x"), i.alias("i"))))))
    pairs = F.col("_pairs")
    step = step.withColumn("_at", F.sort_array(F.transform(F.filter(
        pairs, lambda p, i: ((i > 0) & (F.get(pairs, i - 1)["x"] == p["x"]))
        | F.coalesce(F.get(pairs, i + 1)["x"] == p["x"], F.lit(False))), lambda p: p["i"])))
    at = F.col("_at")
    # Words covered by the windows: each adds its distance to the next one, five at most.
    covered = F.aggregate(F.transform(at, lambda p, i: F.least(F.lit(5), F.coalesce(F.get(at, i + 1) - p, F.lit(5)))),
                          F.lit(0).cast("long"), lambda a, x: a + x)
    step = step.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: F.rlike(x, F.lit(WORD))))
    t = F.col("_text")

    def only(pattern: str) -> Column:
        return F.length(F.regexp_replace(t, pattern, "")).cast("long")

    counted = step.select(
        *(F.col(f"`{c}`") for c in docs.columns if c not in COUNTS),
        F.col("_n").alias("n_words"), only(GAP).alias("word_chars"), only(r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        only(r"[^\p{Lu}]+").alias("n_upper"))
    return counted


def _vote(bad: Column, good: Column | None = None) -> Column:
    vote = F.when(bad, F.lit(-1))
    return (vote if good is None else vote.when(good, F.lit(1))).otherwise(F.lit(0))


def rules() -> dict[str, Column]:
    """The rules by name; each is a vote on the counts.

    Most look for one fault and vote bad or abstain; text free of symbols also
    gets a good vote.
    """
    n, chars, symbols = (F.col(c) for c in ("n_words", "word_chars", "n_symbols"))
    return {
        "length": _vote(n < 10),
        "word_length": _vote((n > 0) & ~chars.between(2 * n, 14 * n)),
        "symbols": _vote(10 * symbols > n, (n > 0) & (50 * symbols <= n)),
        "capitals": _vote(100 * F.col("n_upper") > 40 * chars),
        "repeats": _vote(100 * F.col("n_repeat_words") > 10 * n),
        "lines": _vote(10 * F.col("n_dup_lines") > n),
    }


def _posterior(accuracy: dict[str, float]) -> Column:
    log_odds = F.lit(math.log(GOOD) - math.log1p(-GOOD))
    for rule, a in accuracy.items():
        log_odds = log_odds + F.col(rule) * F.lit(math.log(a) - math.log1p(-a))
    return 1 / (1 + F.exp(-log_odds))


def fit_votes(patterns: DataFrame, names: list[str], tol: float = 1e-3) -> dict[str, float]:
    """EM over the ``count`` of each combination of votes, until no accuracy changes by ``tol``.

    Returns each rule's accuracy; the one to start from where a rule gave no votes.
    """
    accuracy = dict.fromkeys(names, ACCURACY)
    while True:
        p, n = _posterior(accuracy), F.col("count")
        one = patterns.select("count", *names, p.alias("p")).agg(
            *(F.sum(n * F.abs(r)).alias(f"{r}_all") for r in names),
            *(F.sum(n * F.when(F.col(r) > 0, F.col("p")).when(F.col(r) < 0, 1 - F.col("p")).otherwise(0.0)).alias(f"{r}_right")
              for r in names)).first()
        before = accuracy
        accuracy = {r: (one[f"{r}_right"] / one[f"{r}_all"] + PRIOR_WEIGHT * ACCURACY) / (1 + PRIOR_WEIGHT)
                    if one[f"{r}_all"] else ACCURACY for r in names}
        if max(abs(accuracy[r] - before[r]) for r in names) < tol:
            return accuracy


def quality_by_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """One row per document: its id, the counts, each rule's vote, ``quality`` and ``kept``.

    ``base_failed``: fewer than 10 words, or more than 20 % of the words in
    repeated five-word windows. ``kept`` is false for those, and the rules are fitted
    on the others; for them it tells whether the posterior probability ``quality`` reaches ``threshold``.

    * null or empty text: all counts 0, base failed, not kept;
    * repeated rows and rows with equal or null ids are each judged by themselves;
    * an empty table gives an empty result; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "quality-rules")
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    votes = rules()
    names = [f"vote_{r}" for r in votes]
    counted = with_counts(slim).drop("text")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    voted = scratch.stage(counted.select("doc_id", *COUNTS, failed.alias("base_failed"), *(v.cast("int").alias(f"vote_{r}") for r, v in votes.items())),
                          "votes", keep=True)
    patterns = scratch.stage(voted.filter("NOT base_failed").groupBy(*names).count(), "patterns")
    accuracy = fit_votes(patterns, names)
    scratch.clear()
    return voted.withColumn("quality", _posterior(accuracy)).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= threshold))
