"""Greedy word-piece token counts with a linear longest-match automaton.

The vocabulary is a trie. Every node has a failure link and the number of tokens
popped on following it: if no longer match goes on from a node, the longest
tokens that its characters must be cut into are known in advance, and so is the
node for the characters left over. A word is then read once, character by
character, adding popped counts; no piece is ever built, and no character is
read twice, however long the word.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Stands before every word in the vocabulary's tokens (a fixed value of the file format).
WORD_START = "▁"
SCHEMA = "doc_id long, n_words long, n_tokens long, n_unknown_words long"


def load_vocabulary(path: str) -> list[str]:
    """The ordinary pieces of a SentencePiece model (control, unknown and byte pieces left out)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


class LongestMatch:
    """The automaton of a vocabulary: for each node its children, failure link (or -1) and popped count."""

    def __init__(self, vocabulary: list[str], start: str = WORD_START):
        self.start = start
        self.children: list[dict[str, int]] = [{}]
        is_token = [False]
        for token in vocabulary:
            node = 0
            for c in token:
                node = self.children[node].setdefault(c, len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    is_token.append(False)
            if node:
                is_token[node] = True
        self.fail, self.popped = [-1] * len(self.children), [0] * len(self.children)
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for c, node in self.children[parent].items():
                queue.append(node)
                if is_token[node]:  # the whole path is one token
                    self.fail[node], self.popped[node] = 0, 1
                    continue
                at, count = self.fail[parent], self.popped[parent]
                while at >= 0 and c not in self.children[at]:
                    count += self.popped[at]
                    at = self.fail[at]
                if at >= 0:
                    self.fail[node], self.popped[node] = self.children[at][c], count

    def parts(self) -> tuple:
        """Plain data, for a broadcast: an instance would need the package on the executors."""
        return self.start, self.children, self.fail, self.popped

    @classmethod
    def of(cls, parts: tuple) -> LongestMatch:
        found = cls.__new__(cls)
        found.start, found.children, found.fail, found.popped = parts
        return found

    def count(self, word: str) -> int:
        """Tokens of the greedy longest-match cut of ``word``; -1 if it has none."""
        children, fail, popped = self.children, self.fail, self.popped
        node = tokens = 0
        for c in self.start + word:
            while (after := children[node].get(c)) is None:
                if fail[node] < 0:
                    return -1
                tokens += popped[node]
                node = fail[node]
            node = after
        while node:
            if fail[node] < 0:
                return -1
            tokens += popped[node]
            node = fail[node]
        return tokens


def _counter(shared, cache_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = LongestMatch.of(shared.value)
        known: dict[str, int] = {}
        for batch in batches:
            out = {"n_words": [], "n_tokens": [], "n_unknown_words": []}
            for text in batch.column(1).to_pylist():
                n = tokens = unknown = 0
                for m in WORD.finditer(text or ""):
                    word = m[0]
                    k = known.get(word)
                    if k is None:
                        k = automaton.count(word)
                        if len(word) <= 40:
                            if len(known) >= cache_words:
                                known.clear()
                            known[word] = k
                    n += 1
                    if k < 0:
                        unknown += 1
                        tokens += 1
                    else:
                        tokens += k
                for name, value in zip(out, (n, tokens, unknown)):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in out.values())], names=["doc_id", *out])
    return run


def token_counts(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text",
                 cache_words: int = 200_000) -> DataFrame:
    """``doc_id, n_words, n_tokens, n_unknown_words`` for every row.

    Words are runs of other characters than space and controls 9 to 13, of any
    length. A word that the vocabulary can't spell is one unknown token. The
    automaton is broadcast: its size is that of the vocabulary, whatever the data.

    * null, empty or blank text: all counts 0;
    * repeated rows are counted each; a null id stays null;
    * an empty table gives an empty result; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(LongestMatch(vocabulary).parts())
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(_counter(shared, cache_words), SCHEMA)
