"""Exact BPE encoding and decoding by dynamic programming over prefixes.

For every prefix of a word there is exactly one token its encoding ends with.
It is found among the vocabulary tokens that are suffixes of the prefix (an
automaton over the vocabulary reports them in one scan): the token ``t`` whose
predecessor, the last token of the prefix without ``t``, may stand before it.
Whether two tokens may be neighbours depends on these two alone: along the
right edge of the first and the left edge of the second there must be no
merge that would have joined them before their own inner merges were done.
Following the last tokens back from the word's end gives the ids.

Plan: one narrow ``mapInArrow`` over the scan, no shuffle, nothing broadcast.
A worker keeps a bounded table of the words it has encoded.

Decoding is the library's for a vocabulary without a decoder: the tokens'
strings joined by one blank, special tokens included.

Defined cases: NULL text is empty (no ids, empty decoded text); whole texts of
any length; repeated rows give repeated results; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.vocab import SYMBOL_SET, byte_chars, load_json, older, public_path

#: The word pattern of the vocabulary (fixed value); applied to lower-cased NFC text.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"
# Capitals newer than this Python's tables and the distance to
# their small letters (first, last, step between capitals, distance).
CAPITALS = ((0x1C89, 0x1C89, 1, 1), (0xA7CB, 0xA7CB, 1, 0x264 - 0xA7CB), (0xA7CC, 0xA7CE, 2, 1), (0xA7D2, 0xA7D4, 2, 1),
            (0xA7DA, 0xA7DA, 1, 1), (0xA7DC, 0xA7DC, 1, 0x19B - 0xA7DC), (0x10D50, 0x10D65, 1, 0x20),
            (0x16EA0, 0x16EB8, 1, 0x1B))
LOWER = {ord("Σ"): "σ"} | {c: chr(c + d) for a, b, step, d in CAPITALS for c in range(a, b + 1, step)}
NEWER = re.compile(f"[{SYMBOL_SET}{''.join(map(chr, LOWER))}]")
#: Stands for the word end in place of the file's suffix; no byte-level character.
END = "\0"
KEEP, KEEP_CHARS = 1 << 18, 48
SLICE = 256
NEVER = 1 << 60


class Codec:
    """Encoder for one vocabulary file whose words end in a suffix."""

    def __init__(self, path: str):
        vocab = load_json(path)
        suffix = vocab["word_end"]
        own = lambda s: s[:-len(suffix)] + END if suffix and s.endswith(suffix) else s
        self.chars = byte_chars()
        self.ids = {own(s): i for s, i in vocab["ids"].items()}
        self.shown = {own(s): s for s in vocab["ids"]}
        self.rank: dict[tuple[str, str], int] = {}
        self.made: dict[str, tuple[int, str, str]] = {}         # token -> rank and halves
        for r, (a, b) in enumerate(vocab["merges"]):
            a, b = own(a), own(b)
            self.rank[a, b] = r
            self.made.setdefault(a + b, (r, a, b))
        self.right = lru_cache(1 << 16)(lambda t: self._edge(t, 2))
        self.left = lru_cache(1 << 16)(lambda t: self._edge(t, 1))
        self.fits = lru_cache(1 << 18)(self._fits)
        self.tokens = ahocorasick.Automaton()
        for t in self.ids:
            if t not in self.made or self._stands(t):
                self.tokens.add_word(t, t)
        self.tokens.make_automaton()
        self.words, self.words_newer = regex.compile(WORD), regex.compile(older(WORD), regex.V1)
        self.special = vocab["special"]
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.known: dict[str, tuple[bytes, str]] = {}

    def _edge(self, token: str, side: int) -> tuple[tuple[str, int], ...]:
        """The pieces that were at this edge while ``token`` was built, from the
        whole down to one symbol, each with the rank of the merge that used it up."""
        out, used = [], NEVER
        while True:
            out.append((token, used))
            if token not in self.made:
                return tuple(out)
            used, token = self.made[token][0], self.made[token][side]

    def _crossing(self, first: str, second: str, until: int) -> bool:
        """Does a merge join the two tokens' edges before the pieces are used
        up (and before rank ``until``)?  On equal ranks the left one is first."""
        for p, p_used in self.right(first):
            for q, q_used in self.left(second):
                r = self.rank.get((p, q))
                if r is not None and r < until and r < p_used and r <= q_used:
                    return True
        return False

    def _fits(self, first: str, second: str) -> bool:
        return not self._crossing(first, second, NEVER)

    def _stands(self, token: str) -> bool:
        """Is the token the encoding of its own string?"""
        r, a, b = self.made[token]
        return not self._crossing(a, b, r) and all(x not in self.made or self._stands(x) for x in (a, b))

    def word_tokens(self, word: str) -> list[str]:
        """The tokens of one word."""
        s = "".join(self.chars[b] for b in word.encode()) + END
        last: list[str | None] = [None] * (len(s) + 1)
        before_end = len(s) - 2
        for at, t in self.tokens.iter(s):
            if at == before_end or last[at + 1] is not None:
                continue                    # the last character belongs with the word end
            start = at + 1 - len(t)
            if start == 0 or (last[start] is not None and self.fits(last[start], t)):
                last[at + 1] = t
        out, i = [], len(s)
        while i:
            out.append(last[i])
            i -= len(last[i])
        return out[::-1]

    def _word(self, word: str) -> tuple[bytes, str]:
        found = self.known.get(word)
        if found is None:
            t = self.word_tokens(word)
            found = (b"".join(self.ids[x].to_bytes(4, "little") for x in t), " ".join(self.shown[x] for x in t))
            if len(word) <= KEEP_CHARS:
                if len(self.known) >= KEEP:
                    self.known.clear()
                self.known[word] = found
        return found

    def _split(self, text: str) -> list[str]:
        """Lower-cased words; each character is lower-cased without context."""
        try:
            text.encode("latin-1")          # a cheap sign that no special case is there
        except UnicodeEncodeError:
            if NEWER.search(text):
                return self.words_newer.findall(text.translate(LOWER).lower())
        return self.words.findall(text.lower())

    def parts(self, text: str) -> Iterator[tuple[bytes, str]]:
        """Per word: ids as little-endian 32-bit integers, decoded text."""
        for k, piece in enumerate(self.marks.split(text) if self.marks else [text]):
            if k % 2:
                yield self.special[piece].to_bytes(4, "little"), piece
            else:
                yield from map(self._word, self._split(unicodedata.normalize("NFC", piece)))

    def encode(self, text: str) -> list[int]:
        ids = b"".join(p[0] for p in self.parts(text))
        return [int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)]

    def decode(self, ids: list[int]) -> str:
        names = {i: self.shown[t] for t, i in self.ids.items()} | {i: s for s, i in self.special.items()}
        return " ".join(names[i] for i in ids)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                     digests: bool = False) -> DataFrame:
    """``id_col``, ``n_tokens`` and either ``ids`` (array of int) with
    ``decoded``, or with ``digests`` their SHA-256 (``ids_sha256`` of the ids
    as little-endian 32-bit integers, ``decoded_sha256`` of the UTF-8 text)."""
    sha = lambda b: hashlib.sha256(b).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(vocabulary if "/" in vocabulary else public_path(vocabulary))
        for batch in batches:
            for lo in range(0, batch.num_rows, SLICE):
                ids, decoded, count = [], [], []
                for text in batch.column(1).slice(lo, SLICE).to_pylist():
                    parts = list(c.parts(text or ""))
                    ids.append(b"".join([p[0] for p in parts]))
                    decoded.append(" ".join([p[1] for p in parts]))
                    count.append(len(ids[-1]) // 4)
                if digests:
                    two = [pa.array(map(sha, ids), pa.string()), pa.array((sha(x.encode()) for x in decoded), pa.string())]
                else:
                    two = [pa.array([memoryview(x).cast("I").tolist() for x in ids], pa.list_(pa.int32())),
                           pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, SLICE), pa.array(count, pa.int64()), *two],
                                                 names=["id", "n_tokens", *names])

    names = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
    kinds = "string" if digests else "array<int>"
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = source.mapInArrow(run, f"id long, n_tokens long, {names[0]} {kinds}, {names[1]} string")
    return out.withColumnRenamed("id", id_col)
