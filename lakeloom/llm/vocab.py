"""Readers for public byte-level BPE vocabulary files.

A vocabulary file is small and fixed (1-2 MB); every Python worker loads it
once from the path given to the operator and keeps it for later batches.
"""

from __future__ import annotations

import json
from functools import lru_cache

# The library's patterns know an older Unicode than this
# Python's; these code points (first, last) are letters or digits here and
# symbols there.
SYMBOLS = (
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20), (0x18D80, 0x18DF2),
    (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE),
    (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF),
    (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F))
SYMBOL_SET = "".join(f"{chr(a)}-{chr(b)}" for a, b in SYMBOLS)


def older(pattern: str) -> str:
    """``pattern`` (for ``regex.V1``) with those code points taken for symbols."""
    return (pattern.replace(r"[^\s\p{L}\p{N}]+", rf"(?:[^\s\pL\pN]|[{SYMBOL_SET}])+")
            .replace(r"\p{L}", rf"[\pL--[{SYMBOL_SET}]]").replace(r"\p{N}", rf"[\pN--[{SYMBOL_SET}]]"))


@lru_cache(maxsize=1)
def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level files:
    printable Latin-1 bytes stand for themselves, the others for U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


@lru_cache(maxsize=4)
def load_json(path: str) -> dict:
    """``merges`` as pairs of symbols in rank order, ``ids`` by symbol and the
    ``special`` strings with their ids."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    special = {t["content"]: t["id"] for t in spec.get("added_tokens") or [] if t["special"]}
    return {"merges": merges, "ids": model["vocab"], "special": special,
            "word_end": model.get("end_of_word_suffix") or ""}


def public_path(name: str) -> str:
    """Where the installed public tokenizer package keeps ``name``."""
    import public_tokenizers
    return public_tokenizers.path(name)
