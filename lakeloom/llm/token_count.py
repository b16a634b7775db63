"""Token counts by heap-and-linked-list byte-pair merging.

A pre-token starts as one symbol per byte, chained in a linked list.  A heap
holds the adjacent pairs that have a merge rank; the lowest rank (leftmost on
ties) is popped, the two symbols become one and the two new neighbours are
pushed.  The count is the number of first symbols less the number of merges:
no identifier is ever looked up.

Plan: one narrow ``mapInArrow`` over the scan (only id and text are read), no
shuffle, nothing broadcast.  Each worker keeps a bounded table of counts of
pre-tokens it has met, since natural text repeats them.

Defined cases: NULL text counts as empty (0 bytes, 0 tokens); texts of any
length are taken whole, one symbol list per pre-token (n log n); repeated
rows give repeated results; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.vocab import SYMBOL_SET, byte_chars, load_json, older, public_path

#: The pre-token pattern of the vocabulary (fixed value).
PRETOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Entries of a worker's table of counted pre-tokens, and the longest kept.
KEEP, KEEP_CHARS = 1 << 19, 48
#: Texts turned into Python strings at a time.
SLICE = 256


def merged_length(symbols: list[bytes], ranks: dict[tuple[bytes, bytes], int]) -> int:
    """Symbols left when no adjacent pair has a rank any more."""
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(symbols, symbols[1:]))
            if (r := ranks.get((a, b))) is not None]
    heapify(heap)
    merges = 0
    while heap:
        _, i, a, b = heappop(heap)
        j = after[i]
        if symbols[i] != a or j >= n or symbols[j] != b:
            continue                        # one of the two was merged meanwhile
        ab = a + b
        symbols[i], symbols[j] = ab, b""
        k = after[i] = after[j]
        merges += 1
        if k < n:
            before[k] = i
            if (r := ranks.get((ab, symbols[k]))) is not None:
                heappush(heap, (r, i, ab, symbols[k]))
        h = before[i]
        if h >= 0 and (r := ranks.get((symbols[h], ab))) is not None:
            heappush(heap, (r, h, symbols[h], ab))
    return n - merges


class Counter(dict):
    """Token counts of pre-tokens, filled on demand and bounded."""

    def __init__(self, path: str):
        vocab = load_json(path)
        raw = {c: b for b, c in enumerate(byte_chars())}
        as_bytes = lambda s: bytes(raw[c] for c in s)
        self.ranks = {(as_bytes(a), as_bytes(b)): r for r, (a, b) in enumerate(vocab["merges"])}
        self.single = [bytes([b]) for b in range(256)]
        self.pretokens, self.pretokens_newer = regex.compile(PRETOKEN), regex.compile(older(PRETOKEN), regex.V1)
        self.newer = re.compile(f"[{SYMBOL_SET}]")
        self.special = regex.compile("|".join(map(regex.escape, vocab["special"]))) if vocab["special"] else None

    def __missing__(self, token: str) -> int:
        n = merged_length([self.single[b] for b in token.encode()], self.ranks)
        if len(token) <= KEEP_CHARS:
            if len(self) >= KEEP:
                self.clear()
            self[token] = n
        return n

    def count(self, text: str) -> int:
        """Tokens of ``text``; a special string counts as one token."""
        pieces = self.special.split(text) if self.special else [text]
        return len(pieces) - 1 + sum(sum(map(self.__getitem__, self._split(p))) for p in pieces)

    def _split(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")          # a cheap sign that no code point of the newer ones is there
        except UnicodeEncodeError:
            if self.newer.search(text):
                return self.pretokens_newer.findall(text)
        return self.pretokens.findall(text)


@lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024) -> DataFrame:
    """``id_col``, ``n_bytes``, ``n_tokens``, ``over_limit`` for every row.

    ``vocabulary`` is the file's path, or the name of a file of the installed
    public tokenizer package (looked up on each executor)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary if "/" in vocabulary else public_path(vocabulary))
        for batch in batches:
            text = batch.column(1)
            n = [c.count(t or "") for lo in range(0, len(text), SLICE) for t in text.slice(lo, SLICE).to_pylist()]
            size = pc.cast(pc.fill_null(pc.binary_length(text), 0), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), size, pa.array(n, pa.int64())],
                                             names=["id", "n_bytes", "n_tokens"])

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return (source.mapInArrow(run, "id long, n_bytes long, n_tokens long")
            .select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")))
