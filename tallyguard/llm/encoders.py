"""Token ids of whole texts with the ``tokenizers`` library, from a bounded cache of the ids of their chunks.

A tokenizer cuts a text into pieces before it merges inside each piece. Where the
cut is known to fall at spaces, a text's ids are the ids of its space-separated
chunks one after another, so a chunk that came before needs no merging again.
"""

from __future__ import annotations

import json
import re
import string
import struct

from tokenizers import Tokenizer

from tallyguard.llm.common import kept

LIMIT = 600_000  # chunks kept by one worker, about 140 MB: the first seen, and so the common ones; others are cut anew
WORDS = 250_000  # pieces whose number of ids one worker keeps, about 40 MB, where ids are counted
_SPACE = re.compile(r" (?=\S)")
_LONGER_SPACE = re.compile(r" \s")


def encoder(path: str) -> "Encoder":
    """The worker's encoder for a vocabulary file; its cache lasts over tasks."""
    return kept(Encoder, path)


class Encoder:
    """``encode(text)`` gives the ids as little-endian unsigned 32-bit integers in bytes.

    ``chunks(text)`` gives what the text is cut into, and ``ids(chunk, before)`` the ids of a chunk, ``before``
    being empty for the first chunk and a space for the others, which have lost theirs: one after another they are
    the ids of the text. ``count(chunk, before)`` is the number of these ids. Strings of special tokens inside a text are ordinary text. Three ways to cut,
    chosen from the tokenizer's own description: before each space that a non-space
    follows (byte-level cut, no normaliser), at ASCII white space (the cut drops
    white space anyway), or not at all.
    """

    def __init__(self, path: str, limit: int | None = None, words: int = WORDS):
        self.limit, self.words = LIMIT if limit is None else limit, words
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.normalizer, self.cutter, self.model = (
            self.tokenizer.normalizer, self.tokenizer.pre_tokenizer, self.tokenizer.model)
        self.first: dict[str | bytes, bytes] = {}  # by chunk, without a space before it
        self.rest: dict[str, bytes] = {}           # by chunk, with one
        self.sizes: dict[str, int] = {}            # numbers of ids, by piece
        self.letters = _Letters(self.cutter)
        self.count = lambda chunk, before: len(self.ids(chunk, before)) // 4
        self.word_count = lambda chunk: 0
        spec = json.loads(self.tokenizer.to_str())
        cut, norm = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
        steps = cut.get("pretokenizers", [])
        if cut.get("type") == "ByteLevel" and cut.get("use_regex") and not cut.get("add_prefix_space") and not norm:
            self.encode, self.chunks, self.count, self.word_count = self._by_space, self._spaced, self._count, self._words()
            self.ids = lambda chunk, before: self._get(self.rest if before else self.first, chunk, before) if chunk else b""
        elif (steps and steps[0]["type"] == "Split" and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
              and "\\s" in steps[0]["pattern"].get("Regex", "")
              and {n["type"] for n in (norm or {}).get("normalizers", [])} <= {"NFC", "Replace", "Lowercase"}):
            self.encode, self.chunks = self._by_white, lambda text: text.split(" ")
            self.ids = lambda chunk, before: self._by_white(chunk)
        else:
            self.encode, self.chunks = self._whole, lambda text: [text]
            self.ids = lambda chunk, before: self._whole(chunk)

    def _whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _piece(self, piece: str) -> bytes:
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(piece)])

    def _cut(self, chunk: str) -> bytes:
        """The ids of a chunk, by the tokenizer's own steps."""
        if self.normalizer is not None:
            chunk = self.normalizer.normalize_str(chunk)
        return b"".join([self._piece(p) for p, _ in self.cutter.pre_tokenize_str(chunk)])

    def _keep(self, kept: dict, chunk, ids: bytes) -> bytes:
        if len(chunk) <= 64 and len(self.first) + len(self.rest) < self.limit:
            kept[chunk] = ids
        return ids

    def _miss(self, kept: dict, chunk: str, before: str) -> bytes:
        """The ids of a chunk that ``kept`` lacks; ``before`` is the space it lost, if any."""
        if "\n" in chunk:
            lines = chunk.split("\n")
            if all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
                newline = self._get(self.first, "\n", "")
                out = [self._get(kept, lines[0], before)]
                for x in lines[1:]:
                    out += (newline, self._get(self.first, x, ""))
                return b"".join(out)
        word = chunk.rstrip(",.")
        if word.isalpha() and max(word) < "\u0100":  # one piece, and perhaps one of commas and dots
            seen = kept.get(word)
            ids = seen or self._keep(kept, word, self._piece(
                self.letters[before] + (word if word.isascii() else word.translate(self.letters))))
            if word != chunk:
                ids += self._get(self.first, chunk[len(word):], "")
                return self._keep(kept, chunk, ids) if seen else ids
            return ids
        return self._keep(kept, chunk, self._cut(before + chunk))

    def _get(self, kept: dict, chunk: str, before: str) -> bytes:
        return kept.get(chunk) or self._miss(kept, chunk, before)

    def _spaced(self, text: str) -> list[str]:
        chunks = text.split(" ")
        if "" in chunks or text[0].isspace() or _LONGER_SPACE.search(text):
            chunks = _SPACE.split(text)
        return chunks

    def _count(self, chunk: str, before: str) -> int:
        """How many ids a chunk has, without making them where it is a word, or words in lines."""
        word = chunk.rstrip(string.punctuation)  # what follows is one piece
        if word.isalpha() and (word.isascii() or max(word) < "\u0100"):
            piece = self.letters[before] + (word if word.isascii() else word.translate(self.letters))
            n = self.sizes.get(piece)
            if n is None:
                n = len(self.model.tokenize(piece))
                if len(piece) <= 64 and len(self.sizes) < self.words:
                    self.sizes[piece] = n
            return n if len(word) == len(chunk) else n + len(self._get(self.first, chunk[len(word):], "")) // 4
        if "\n" in chunk:
            lines = chunk.split("\n")
            if all(x and not x[0].isspace() and not x[-1].isspace() for x in lines):
                newline = len(self._get(self.first, "\n", "")) // 4
                return self._count(lines[0], before) + sum(newline + self._count(x, "") for x in lines[1:])
        return len(self.ids(chunk, before)) // 4

    def _words(self):
        """A function: the ``count`` after a space of a chunk of ASCII letters and what marks follow them, 0 for any other chunk."""
        sizes, tokenize, space, marks, ends = self.sizes, self.model.tokenize, self.letters[" "], {}, string.punctuation

        def count(chunk) -> int:
            if not isinstance(chunk, str) or not chunk.isascii():
                return 0
            word, tail = chunk, 0
            if not chunk.isalpha():
                word = chunk.rstrip(ends)
                if not word.isalpha():
                    return 0
                after = chunk[len(word):]
                tail = marks.get(after) or len(self._get(self.first, after, "")) // 4
                if len(marks) < 1000:
                    marks[after] = tail
            piece = space + word
            n = sizes.get(piece)
            if n is None:
                n = len(tokenize(piece))
                if len(piece) <= 64 and len(sizes) < self.words:
                    sizes[piece] = n
            return n + tail

        return count

    def _by_space(self, text: str) -> bytes:
        chunks = self._spaced(text)
        out = list(map(self.rest.get, chunks))
        out[0] = self._get(self.first, chunks[0], "") if chunks[0] else b""
        for i, ids in enumerate(out):
            if ids is None:
                out[i] = self._miss(self.rest, chunks[i], " ")
        return b"".join(out)

    def _by_white(self, text: str) -> bytes:
        chunks = text.encode("utf-8", "surrogatepass").lower().split()
        out = list(map(self.first.get, chunks))
        for i, ids in enumerate(out):
            if ids is None:
                out[i] = self._miss_white(chunks[i])
        return b"".join(out)

    def _miss_white(self, raw: bytes) -> bytes:
        body = raw.rstrip(b",.")
        word = body.decode("utf-8", "surrogatepass")
        if word.isalpha() and max(word) < "\u0100":
            word = word.lower()
            seen = self.first.get(body)
            ids = seen or self._keep(self.first, body, self._piece(word if word.isascii() else word.translate(self.letters)))
            if body != raw:
                tail = raw[len(body):]
                ids += self.first.get(tail) or self._keep(self.first, tail, self._cut(tail.decode()))
                return self._keep(self.first, raw, ids) if seen else ids
            return ids
        return self._keep(self.first, raw, self._cut(raw.decode("utf-8", "surrogatepass")))


class _Letters(dict):
    """How the tokenizer writes a character in a piece: by itself or by code point, found when first asked for."""

    def __init__(self, cutter):
        self.cutter = cutter
        self[""] = ""

    def __missing__(self, key):
        found = self.cutter.pre_tokenize_str(key if isinstance(key, str) else chr(key))
        self[key] = out = "".join(p for p, _ in found)
        return out
