"""Subword-bag classifier: character n-gram embeddings averaged into a linear softmax, trained jointly in numpy.

A word is the bag of its character n-grams (with marks at both ends) and itself; its
vector is the mean of their embeddings, so a misspelling never seen shares most of
the vector of the word it distorts. A run without white space longer than a word may be is
read as overlapping words. A text is read as windows of its words in their order, repeats included; a
window is the mean of its words (with zero vectors up to the window's size where the
text has fewer), and a linear softmax over that mean gives class probabilities. Embeddings and softmax
are learnt together by Adam on the cross-entropy. Only training takes each word of a text once, where it first occurs.

Once trained, embeddings times softmax weights is one row of class logits per
n-gram bucket: that table is what scoring ships (``BUCKETS`` x classes floats).
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np

from tallyguard.llm.common import kept

BUCKETS = 1 << 18
DIM = 4
SHORT, LONG = 3, 6  # n-gram lengths
SEEN_IN = 3         # texts of the sample that a word must occur in to be trained on
LONGEST = 40        # bytes of a word; longer runs are cut into overlapping words
OVERLAP = 20        # bytes that such words share at least
CACHE = 150_000      # words whose logits a worker keeps from text to text, the first seen


def words_of(text: str) -> list[str]:
    """The lower-cased words between white space, in their order and with repeats; see ``pieces_of``."""
    words = text.lower().split()
    if 4 * max(map(len, words), default=0) > LONGEST:  # a character has up to four bytes
        words = [p for w in words for p in (pieces_of(w) if 4 * len(w) > LONGEST else (w,))]
    return words


def pieces_of(run: str) -> list[str]:
    """A run of up to ``LONGEST`` bytes itself, a longer one as words of so many that overlap and don't cut characters."""
    if len(run) <= LONGEST and run.isascii():
        return [run]
    raw = run.encode("utf-8", "surrogatepass")
    if len(raw) <= LONGEST:
        return [run]
    pieces, a = [], 0
    while True:
        b = min(a + LONGEST, len(raw))
        while b < len(raw) and raw[b] & 0xC0 == 0x80:
            b -= 1
        pieces.append(raw[a:b].decode("utf-8", "surrogatepass"))
        if b == len(raw):
            return pieces
        a = b - OVERLAP
        while raw[a] & 0xC0 == 0x80:
            a -= 1


def _gram_parts(words: list[str]):
    """(word numbers, buckets) of the words themselves, then of the n-grams of their UTF-8 bytes for each n."""
    raw = [w.encode("utf-8", "surrogatepass") for w in words]
    yield np.arange(len(words)), np.array([zlib.crc32(r, 7) & (BUCKETS - 1) for r in raw], dtype=np.int64)
    marked = [b"<%s>" % r for r in raw]
    data = np.frombuffer(b"".join(marked), dtype=np.uint8).astype(np.uint64)
    sizes = np.array([len(m) for m in marked])
    word = np.repeat(np.arange(len(words)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(data))  # bytes from here to the word's end
    h = data
    for n in range(2, LONG + 1):
        if len(h) < 2:
            break
        h = h[:-1] * np.uint64(1_000_003) + data[n - 1:]
        if n >= SHORT:
            ok = left[:len(h)] >= n
            mixed = (h[ok] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            yield word[:len(h)][ok], (mixed >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, how many per word) of every word, word by word."""
    owner, found = (np.concatenate(x) for x in zip(*_gram_parts(words)))
    order = np.argsort(owner, kind="stable")
    return found[order], np.bincount(owner, minlength=len(words))


class _Bags:
    """Texts as windows of word numbers, and words as n-gram buckets."""

    def __init__(self, texts: list[str], window: int):
        # a text teaches a word once: learnt from all repeats, fewer misspelt words of held-out texts are found
        texts = [list(dict.fromkeys(words_of(text))) for text in texts]
        seen = Counter(w for words in texts for w in words)
        numbers: dict[str, int] = {"": 0}
        flat, starts, owner = [], [], []
        for t, words in enumerate(texts):
            ids = [numbers.setdefault(w, len(numbers)) for w in words if seen[w] >= SEEN_IN] or [0]
            for a in window_starts(len(ids), window):
                starts.append(len(flat))
                owner.append(t)
                flat += ids[a:a + window] if window else ids
        self.flat, self.starts, self.owner = np.array(flat), np.array(starts), np.array(owner)
        self.sizes = np.diff(np.append(self.starts, len(flat)))
        self.shares = (1 / np.full(len(starts), window) if window else 1 / self.sizes).astype(np.float32)
        self.gram, self.word_sizes = grams(list(numbers))
        self.word_starts = np.cumsum(self.word_sizes) - self.word_sizes

    def forward(self, emb):
        words = np.add.reduceat(emb[self.gram], self.word_starts, axis=0) / self.word_sizes[:, None].astype(np.float32)
        return np.add.reduceat(words[self.flat], self.starts, axis=0) * self.shares[:, None]

    def backward(self, grad):
        """The gradient of the embeddings from that of the windows."""
        at = np.repeat((grad * self.shares[:, None]).astype(np.float32), self.sizes, axis=0)
        words = _sum_rows(self.flat, at, len(self.word_sizes)) / self.word_sizes[:, None]
        return _sum_rows(self.gram, np.repeat(words, self.word_sizes, axis=0), BUCKETS)


def _sum_rows(index, rows, n):
    return np.stack([np.bincount(index, rows[:, k], n) for k in range(rows.shape[1])], axis=1).astype(np.float32)


def window_starts(n: int, window: int) -> list[int]:
    """Where windows of a text of ``n`` words begin: half overlapping, the last one whole."""
    if not window or n <= window:
        return [0]
    return [*range(0, n - window, window // 2), n - window]


class Model:
    """Class logits per n-gram bucket, and biases."""

    def __init__(self, table: np.ndarray, bias: np.ndarray, window: int):
        self.table, self.bias, self.window = table, bias, window

    def word_rows(self, words: list[str]) -> np.ndarray:
        """Logits of words, without the biases."""
        total, count = np.zeros((len(words), self.table.shape[1])), np.zeros(len(words))
        for owner, bucket in _gram_parts(words):
            count += np.bincount(owner, minlength=len(words))
            for k in range(total.shape[1]):
                total[:, k] += np.bincount(owner, self.table[bucket, k], len(words))
        return total / count[:, None]

    def logits(self, text: str) -> np.ndarray:
        """Logits of every window of a text: one row per window, one column per class."""
        return self.many([text])[0]

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """``logits`` of several texts; words not seen before are hashed together."""
        words = [words_of(t) or [""] for t in texts]
        cache = kept(_Cache, self)
        numbers = cache.numbers
        if len(numbers) > CACHE:
            for w in list(numbers)[CACHE // 2:]:
                del numbers[w]
        first, numbers.new = len(numbers), []
        found = [np.fromiter(map(numbers.__getitem__, ws), np.int64, len(ws)) for ws in words]
        if numbers.new:
            if len(numbers) > len(cache.rows):
                grown = np.zeros((2 * len(numbers), self.table.shape[1]), np.float32)
                grown[:first] = cache.rows[:first]
                cache.rows = grown
            for i in range(0, len(numbers.new), 20_000):
                part = numbers.new[i:i + 20_000]
                cache.rows[first + i:first + i + len(part)] = self.word_rows(part)
        return [self._means(cache.rows[ids]) for ids in found]

    def _means(self, rows):
        if not self.window or len(rows) <= self.window:
            return rows.sum(axis=0, keepdims=True, dtype=np.float64) / (self.window or len(rows)) + self.bias
        total = np.concatenate([np.zeros((1, rows.shape[1])), np.cumsum(rows, axis=0, dtype=np.float64)])
        starts = np.array(window_starts(len(rows), self.window))
        return (total[starts + self.window] - total[starts]) / self.window + self.bias


class Numbers(dict):
    """Numbers words in the order in which they are first asked for; ``new`` lists those numbered since it was set."""

    new: list[str] = []

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number


class _Cache:
    """Logits of the words that a model has met in this worker."""

    def __init__(self, model: Model):
        self.model = model
        self.numbers = Numbers()
        self.rows = np.zeros((1024, model.table.shape[1]), np.float32)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[int], classes: int, window: int = 0, rounds: int = 60,
          rate: float = 0.1, decay: float = 1e-6, seed: int = 11) -> Model:
    """Fit on whole texts. With a window, a text of class 0 is every one of its windows, and a text of
    another class the window that speaks most for it so far (all its windows in the first rounds)."""
    bags = _Bags(texts, window)
    rng = np.random.default_rng(seed)
    emb = (rng.random((BUCKETS, DIM), dtype=np.float32) - 0.5) / DIM
    out = rng.normal(0, 0.3, (DIM, classes)).astype(np.float32)
    bias = np.zeros(classes, np.float32)
    y_text = np.array(labels)
    y = y_text[bags.owner]
    params, first, second = [emb, out, bias], [], []
    for p in params:
        first.append(np.zeros_like(p))
        second.append(np.zeros_like(p))
    for step in range(1, rounds + 1):
        hidden = bags.forward(emb)
        p = softmax(hidden @ out + bias)
        weight = np.ones(len(y))
        if window and step > rounds // 4:
            own = p[np.arange(len(y)), y]
            order = np.lexsort((own, bags.owner))
            last = order[np.append(bags.owner[order][1:] != bags.owner[order][:-1], True)]
            best = np.zeros(len(y), bool)
            best[last] = True
            weight = np.where((y == 0) | best, 1.0, 0.0)
        for c in range(classes):  # every class weighs the same
            mass = weight[y == c].sum()
            weight[y == c] *= len(y) / (classes * mass) if mass else 0
        grad = p
        grad[np.arange(len(y)), y] -= 1
        grad *= (weight / weight.sum())[:, None]
        grads = [bags.backward(grad @ out.T), hidden.T @ grad, grad.sum(axis=0)]
        grads[0] += decay * emb
        for i, g in enumerate(grads):
            first[i] += 0.1 * (g - first[i])
            second[i] += 0.01 * (g * g - second[i])
            step_size = rate / (1 - 0.9 ** step)
            params[i] -= (step_size * first[i] / (np.sqrt(second[i] / (1 - 0.99 ** step)) + 1e-8)).astype(params[i].dtype)
    return Model((emb @ out).astype(np.float32), bias.astype(np.float64), window)
