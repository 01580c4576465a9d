"""The public tokenizer files as fast, exact encoders (one per Python worker, made on first use).

Byte-level BPE runs on tiktoken with the ranks of the given tokenizers file; texts for which the two
libraries' pattern engines could differ (characters beyond the Latin blocks, whose classes depend on
the Unicode version) or that hold very long unbroken runs go to the tokenizers library itself.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np

PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LONG_RUN = 1000


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=None)
def library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, as letter -> byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """ids of texts as the tokenizers library gives them without added special tokens."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(letters[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in self.special}
        self.fast = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.path = path

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, dtype=np.uint32)
        unusual = not text.isascii() and max(text) >= "ɐ"
        if not unusual and len(text) > LONG_RUN:
            unusual = " " * LONG_RUN in text or max(map(len, text.split(" "))) > LONG_RUN
        if unusual:
            return np.array(library(self.path).encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.fast.encode_to_numpy(text, allowed_special="all")


@lru_cache(maxsize=None)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)
