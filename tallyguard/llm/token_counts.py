"""Greedy word-piece counts with a linear longest-match automaton.

The vocabulary is a trie of bytes. A word is a space and its bytes, and its pieces are
the longest entries from the left. Every trie node has a failure link, the node for
what follows the pieces that can be cut off it, and the number of these pieces. So a
word is read once, byte by byte, and its length in pieces is a sum of such numbers;
no piece is ever built.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyguard.llm.common import whole_text

LIMIT = 300_000  # words whose counts a worker keeps, about 50 MB: the first seen, and so the common ones
_OPEN: dict[tuple, "Automaton"] = {}


def rank_file(path: str) -> list[bytes]:
    """The entries of a file with a base64 entry and a number on each line."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class Automaton:
    """Counts of greedy longest-match pieces over ``vocabulary``; a byte that no entry begins with is one piece."""

    def __init__(self, vocabulary):
        step: dict[int, int] = {}  # (node << 8 | byte) -> node; 0 is the root
        ends, nodes = set(), 1
        vocabulary = {*vocabulary, *(bytes([b]) for b in range(256))}
        for entry in vocabulary:
            node = 0
            for byte in entry:
                nxt = step.get(node << 8 | byte)
                if nxt is None:
                    nxt = step[node << 8 | byte] = nodes
                    nodes += 1
                node = nxt
            ends.add(node)
        # nodes by depth: an entry's bytes were added in order, but a shorter one may come later
        level, order = [0], []
        children: dict[int, list[int]] = {}
        for key, child in step.items():
            children.setdefault(key >> 8, []).append(key)
        while level:
            following = [k for n in level for k in children.get(n, ())]
            order += following
            level = [step[k] for k in following]
        fail, pops = [0] * nodes, [0] * nodes
        for key in order:
            parent, byte, node = key >> 8, key & 255, step[key]
            if node in ends:
                fail[node], pops[node] = 0, 1
                continue
            at, popped = fail[parent], pops[parent]
            while (nxt := step.get(at << 8 | byte)) is None:
                popped += pops[at]
                at = fail[at]
            fail[node], pops[node] = nxt, popped
        self.step, self.fail, self.pops = step, fail, pops
        self.kept: dict[bytes, int] = {}

    def pieces(self, word: bytes) -> int:
        """How many pieces the greedy longest match cuts ``word`` into."""
        step, fail, pops = self.step.get, self.fail, self.pops
        node = count = 0
        for byte in word:
            while (nxt := step(node << 8 | byte)) is None:
                count += pops[node]
                node = fail[node]
            node = nxt
        while node:
            count += pops[node]
            node = fail[node]
        return count

    def count(self, words: list[bytes]) -> int:
        """The pieces of all ``words``, each with a space before it."""
        kept = self.kept
        found = list(map(kept.get, words))
        if None not in found:
            return sum(found)
        total = 0
        for word, n in zip(words, found):
            if n is None:
                n = kept.get(word)
                if n is None:
                    n = self.pieces(b" " + word)
                    if len(kept) < LIMIT and len(word) <= 64:
                        kept[word] = n
            total += n
        return total


def automaton(path: str) -> Automaton:
    """The worker's automaton for a vocabulary file."""
    if path not in _OPEN:
        _OPEN[path] = Automaton(rank_file(path))
    return _OPEN[path]


def token_counts(docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_tokens) for every row of ``docs``.

    Words are maximal runs outside [\\x20\\x09-\\x0D]; ``vocabulary`` is a rank file on every
    machine. A null or empty text has no words and no tokens. Other columns are not read.
    """
    def run(batches):
        auto = automaton(vocabulary)
        for batch in batches:
            n_words, n_tokens = [], []
            for t in batch.column(1).to_pylist():
                words = t.encode("utf-8", "surrogatepass").split()
                n_words.append(len(words))
                n_tokens.append(auto.count(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                ["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), whole_text(text).alias("text")).mapInArrow(
        run, "doc_id long, n_words long, n_tokens long")
