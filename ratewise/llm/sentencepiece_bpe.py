"""SentencePiece encoding and decoding by a table over prefixes.

In a merge-type (BPE) vocabulary the encoding of every prefix of a text ends
in exactly one token, and a token sequence is the encoding of its text exactly
when every two neighbours are: merging the text of the pair gives the pair
back.  So one pass over the text fills a table that holds for each prefix its
last token: an automaton lists the tokens that end at the position, and the
first one that is compatible with the last token of the prefix before it is
the entry.  Walking the table from its end gives the ids, last one first.

The normaliser of the model must be the identity (white space escaped, one
mark put before a non-empty text), which ``Codec`` checks.  Text is cut where
no token can cross: before a run of white space (no piece has white space
after another character) and around characters that no piece holds, which are
written as bytes.  Encodings of short words are kept in a bounded cache.

Results: NULL and empty text encode to begin and end id alone and decode to
the empty string; every other text is used whole.
"""

from __future__ import annotations

import hashlib
import re
import struct
from array import array
from functools import lru_cache
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame

from ratewise.llm.common import by_document, table

MODEL = "piece_bpe_32k.model"
MARK, UNKNOWN = "▁", " ⁇ "
CACHE_WORDS, CACHE_CHARS, CACHE_PAIRS = 200_000, 48, 400_000
NORMAL, BYTE = 1, 6   # piece types of the model format


def _fields(data: bytes):
    """(number, value) of each field of a protocol-buffer message."""
    at, end = 0, len(data)

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < end:
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield tag >> 3, data[at:at + size]
        at += size


class Codec:
    """Encoder and decoder of one model file's vocabulary."""

    def __init__(self, path: str):
        import ahocorasick
        with open(path, "rb") as f:
            message = f.read()
        self.pieces, self.scores, kinds = [], [], []
        norm = {}
        for field, value in _fields(message):
            if field == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece.get(2, b"\0" * 4))[0])
                kinds.append(piece.get(3, NORMAL))
            elif field == 3:
                norm = dict(_fields(value))
        if norm.get(1) != b"identity" or norm.get(2) or norm.get(4, 1) or not norm.get(3, 1):
            raise ValueError("only identity normalisation with a dummy prefix is supported")
        self.ids = {p: i for i, p in enumerate(self.pieces) if kinds[i] == NORMAL}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if kinds[i] == BYTE}
        if len(self.bytes) != 256 or any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("byte pieces for all bytes and no piece with inner white space are needed")
        self.begin, self.end = self.pieces.index("<s>"), self.pieces.index("</s>")
        self.chars = set("".join(self.ids))
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if self.merged(p) == [i]:          # a piece that merging can reach
                self.automaton.add_word(p, (len(p), i))
        self.automaton.make_automaton()
        self.raw = [p.replace(MARK, " ").encode() for p in self.pieces]
        for byte, i in self.bytes.items():
            self.raw[i] = bytes([byte])
        self.raw[0], self.raw[self.begin], self.raw[self.end] = UNKNOWN.encode(), b"", b""
        self.fits, self.words, self.older = {}, {}, {}

    def merged(self, text: str) -> list[int]:
        """The merge rule itself, for single pieces and pairs: join the
        neighbours whose union has the highest score, leftmost first."""
        parts = list(text)
        ids, scores = self.ids, self.scores
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or scores[i] > best):
                    best, at = scores[i], k
            if best is None:
                return [ids.get(p, -1) for p in parts]
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def compatible(self, left: int, right: int) -> bool:
        key = left << 20 | right
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= CACHE_PAIRS:
                self.fits.clear()
            known = self.fits[key] = self.merged(self.pieces[left] + self.pieces[right]) == [left, right]
        return known

    def _known(self, text: str) -> list[int]:
        """Ids of a text of known characters, from the prefix table."""
        last, before = [-1] * (len(text) + 1), [0] * (len(text) + 1)
        fits = self.fits
        for at, (size, i) in self.automaton.iter(text):   # longest first at each end
            end = at + 1
            if last[end] >= 0:
                continue
            start = end - size
            if start:
                left = last[start]
                if left < 0:
                    continue
                ok = fits.get(left << 20 | i)
                if ok is None:
                    ok = self.compatible(left, i)
                if not ok:
                    continue
            last[end], before[end] = i, start
        out, at = [], len(text)
        while at:
            out.append(last[at])
            at = before[at]
        out.reverse()
        return out

    def _unit(self, text: str) -> bytes:
        """Packed ids of a text in which no token crosses the ends."""
        if self.chars.issuperset(text):
            return array("I", self._known(text)).tobytes()
        ids = []
        for known, run in groupby(text, self.chars.__contains__):
            run = "".join(run)
            ids += self._known(run) if known else [self.bytes[b] for b in run.encode()]
        return array("I", ids).tobytes()

    def word(self, word: str) -> bytes:
        """Packed ids of one space-free word with the mark before it."""
        if "\n" in word and "\n" not in self.chars:     # the parts recur, the whole rarely
            first, *rest = word.split("\n")
            known = self.words                            # a space before what follows a line end
            return (known.get(first) or self.word(first)) + b"".join(
                [known.get(" " + x) or self._cached(" " + x, "\n" + x) for x in rest])
        return self._cached(word, MARK + word)

    def _cached(self, key: str, unit: str) -> bytes:
        """From two generations of at most CACHE_WORDS short words each."""
        packed = self.older.get(key)
        if packed is None:
            packed = self._unit(unit)
        if len(key) <= CACHE_CHARS:
            if len(self.words) >= CACHE_WORDS:
                self.older = self.words.copy()
                self.words.clear()             # the same dict: callers hold its get
            self.words[key] = packed
        return packed

    def packed(self, text: str | None) -> bytes:
        """Little-endian unsigned 32-bit ids, begin and end included."""
        begin, end = struct.pack("<I", self.begin), struct.pack("<I", self.end)
        if not text:
            return begin + end
        words = text.replace(MARK, " ").split(" ")
        if "" not in words:
            get = self.words.get
            return begin + b"".join([get(w) or self.word(w) for w in words]) + end
        out, marks = [begin], 0
        for w in words:                       # runs of marks belong to the word after them
            marks += 1
            if w:
                out.append(self.word(w) if marks == 1 else self._unit(MARK * marks + w))
                marks = 0
        if marks:
            out.append(self._unit(MARK * marks))
        return b"".join([*out, end])

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.packed(text), dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        """Text of ids: marks become spaces, a mark at the very start is
        dropped, runs of byte pieces are read as UTF-8 with U+FFFD for every
        byte that fits nowhere."""
        at = 0
        while at < len(ids) and ids[at] in (self.begin, self.end):
            at += 1
        text = self.raw
        raw = b"".join([text[i] for i in ids])
        if at < len(ids) and self.pieces[ids[at]].startswith(MARK):
            raw = raw[1:]
        try:
            return raw.decode()
        except UnicodeDecodeError:
            out, at = [], 0
            while at < len(raw):
                size = next((n for n in (1, 2, 3, 4) if _one_char(raw[at:at + n])), 0)
                out.append(raw[at:at + size].decode() if size else "\ufffd")
                at += size or 1
            return "".join(out)


def _one_char(data: bytes) -> bool:
    try:
        return len(bytes(data).decode()) == 1
    except UnicodeDecodeError:
        return False


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``docs(doc_id, text)`` with ``ids``, the whole text's token ids."""
    def one(text, state):
        return (state.encode(text),)
    return by_document(docs.select("doc_id", "text"), one, "ids array<int>",
                       lambda: codec(path or model_path()))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, ids_sha256 and
    decoded_sha256, the digest of the text decoded from those ids."""
    def one(text, state):
        packed = state.packed(text)
        decoded = state.decode(np.frombuffer(packed, dtype="<u4").tolist())
        return (len(packed) // 4, hashlib.sha256(packed).hexdigest(),
                hashlib.sha256(decoded.encode()).hexdigest())

    return by_document(docs.select("doc_id", "text"), one,
                       "n_tokens bigint, ids_sha256 string, decoded_sha256 string",
                       lambda: codec(path or model_path()))


def op5_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
