"""Exact token counts at every prefix by dynamic programming (op3).

The vocabulary is byte-pair encoding with word ends. A sequence of tokens is the encoding of a piece
of text exactly if every two neighbours are *compatible*: no merge across their border comes before
the merges that built them. So, for each prefix of a word, one token can end there, and

    last[i] = the token t ending at i that is compatible with last[i - len(t)]
    count[i] = count[i - len(t)] + 1

with a word-end form of ``t`` where the prefix is read as a whole text. Words are independent of each
other, so the count at any prefix of a document is the sum of the words before it and one look-up in
its last word: truncation and budget questions need no further encoding. Word counts are kept in a
cache of bounded size in each Python worker.

Texts are split at ASCII white space; chunks with characters beyond the Latin blocks, control
characters or special strings are counted by the tokenizers library itself (its Unicode tables then
apply). Positions inside a chunk are code points of its normalised form (NFC, lower case), which for
almost all chunks has the length of the original.

Defined results: null and empty texts have no tokens; repeated rows and null ids are counted row by row.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm import textvec
from tagloom.llm.batches import map_texts
from tagloom.llm.tokenizers_io import byte_letters, library, tokenizer_path

LIMIT = 2048
CACHE_WORDS = 500_000  # entries of each cache before it starts anew

_CHUNK = re.compile(r"[^\x20\x09-\x0D]+")
_ASCII_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
_WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_CONTRACTION = {"'s", "'t", "'re", "'ve", "'m", "'ll", "'d"}
_END = "</w>"
_NEVER = 1 << 60


class PrefixCounter:
    """Token counts of texts and of all their prefixes under one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.path = path
        self.specials = [t["content"] for t in spec["added_tokens"]]
        self.rank: dict[tuple[str, str], int] = {}
        self.split: dict[str, tuple[str, str]] = {}
        for i, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.rank.setdefault((a, b), i)
            self.split.setdefault(a + b, (a, b))
        known = [t for t in model["vocab"] if t in self.split or len(t.removesuffix(_END)) == 1]
        self.inner = {t for t in known if not t.endswith(_END)}
        self.final = {t.removesuffix(_END) for t in known if t.endswith(_END)}
        self.letter = {b: c for c, b in byte_letters().items()}
        self.longest = max(len(t.removesuffix(_END)) for t in self.split)
        self.right: dict[str, list[tuple[str, int]]] = {}
        self.left: dict[str, list[tuple[str, int]]] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        self.words: dict[str, int] = {}
        self.chunks: dict[bytes, int] = {}

    def _spine(self, token: str, side: int) -> list[tuple[str, int]]:
        """The parts of a token at one of its ends, each with the rank of the merge that swallows it."""
        out, rank = [(token, _NEVER)], _NEVER
        while token in self.split:
            pair = self.split[token]
            rank = self.rank[pair]
            token = pair[side]
            out.append((token, rank))
        return out

    def compatible(self, a: str, b: str) -> bool:
        """Whether the encoding of a followed by b is just these two tokens."""
        key = (a, b)
        known = self.fits.get(key)
        if known is None:
            if a not in self.right:
                self.right[a] = self._spine(a, 1)
            if b not in self.left:
                self.left[b] = self._spine(b, 0)
            rank = self.rank
            known = True
            for x, until_x in self.right[a]:
                for y, until_y in self.left[b]:
                    r = rank.get((x, y))
                    if r is not None and r < until_x and r <= until_y:
                        known = False
                        break
                if not known:
                    break
            if len(self.fits) > 4 * CACHE_WORDS:
                self.fits.clear()
            self.fits[key] = known
        return known

    def _last(self, s: str, i: int, last: list[str], tokens: set[str], suffix: str) -> int:
        """Where the one token that ends at i begins, given the last tokens of all shorter prefixes."""
        fits = self.fits
        for start in range(max(0, i - self.longest), i):
            t = s[start:i]
            if t in tokens:
                if not start:
                    return 0
                known = fits.get((last[start], t + suffix))
                if known or (known is None and self.compatible(last[start], t + suffix)):
                    return start
        raise ValueError(f"no token ends at {i} of {s!r}")

    def learn(self, words: dict[str, str]) -> None:
        """Count words (byte letters -> word) that are not in the cache yet.

        They are taken in order, so the table of a word goes on from what it shares with the one before.
        """
        last, count, done = [""], [0], ""
        inner, final, longest, fits, compatible = self.inner, self.final, self.longest, self.fits, self.compatible
        for s in sorted(words):
            if s in final:
                self.words[words[s]] = 1
                continue
            n, shared = len(s), 0
            most = min(len(last), n) - 1
            while shared < most and s[shared] == done[shared]:
                shared += 1
            del last[shared + 1 :], count[shared + 1 :]
            done = s
            for i in range(shared + 1, n):
                # as _last does, written out because nearly all time goes here
                for start in range(i - longest if i > longest else 0, i):
                    t = s[start:i]
                    if t in inner:
                        if not start:
                            break
                        known = fits.get((last[start], t))
                        if known or (known is None and compatible(last[start], t)):
                            break
                else:
                    raise ValueError(f"no token ends at {i} of {s!r}")
                last.append(t)
                count.append(count[start] + 1)
            self.words[words[s]] = count[self._last(s, n, last, final, _END)] + 1

    def word_table(self, s: str, wanted: list[int]) -> list[int]:
        """Token counts of the prefixes of a word (byte letters) at the wanted lengths, each read as a whole word."""
        last, count, out = [""], [0], []
        at = 0
        for i in range(1, wanted[-1] + 1):
            if i == wanted[at]:
                out.append(count[self._last(s, i, last, self.final, _END)] + 1)
                at += 1
            if i < wanted[-1]:
                start = self._last(s, i, last, self.inner, "")
                last.append(s[start:i])
                count.append(count[start] + 1)
        return out

    def _letters(self, word: str) -> str:
        return word if word.isascii() and word.isprintable() else "".join(map(self.letter.__getitem__, word.encode()))

    def word(self, word: str) -> int:
        """Tokens of one word (a match of the word pattern)."""
        if word not in self.words:
            self.learn({self._letters(word): word})
        return self.words[word]

    @staticmethod
    def _plain(chunk: str) -> bool:
        """Whether the word pattern can be applied here rather than by the library."""
        return "<|" not in chunk and (chunk.isascii() or max(chunk) < "ɐ") and (chunk.isprintable() or min(chunk) > "\x1f")

    @staticmethod
    def _words(chunk: str) -> tuple[str, list[str]]:
        if chunk.isascii():
            chunk = chunk.lower()
            return chunk, _ASCII_WORD.findall(chunk)
        chunk = unicodedata.normalize("NFC", chunk).lower()
        return chunk, _WORD.findall(chunk)

    def totals(self, texts: list[bytes]) -> list[int]:
        """Tokens of whole texts; what is new in them is counted together first."""
        split = [t.split() for t in texts]
        every = set().union(*split)
        new = every.difference(self.chunks)
        if len(self.chunks) + len(new) > CACHE_WORDS:
            self.chunks.clear()
            new = every
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        parts, unknown = {}, {}
        for raw in new:
            text = raw.decode()
            if self._plain(text):
                parts[raw] = found = self._words(text)[1]
                for w in found:
                    if w not in self.words:
                        unknown[self._letters(w)] = w
            else:
                self.chunks[raw] = len(library(self.path).encode(text, add_special_tokens=False))
        self.learn(unknown)
        count = self.words.__getitem__
        for raw, found in parts.items():
            self.chunks[raw] = sum(map(count, found))
        count = self.chunks.__getitem__
        return [sum(map(count, chunks)) for chunks in split]

    def total(self, text: str) -> int:
        """Tokens of a whole text."""
        return self.totals([text.encode()])[0]

    def prefixes(self, chunk: str) -> list[int]:
        """Tokens of every prefix of a chunk's normalised form, by code points (1 to its length)."""
        if not self._plain(chunk):
            return self._library_prefixes(chunk)
        chunk, words = self._words(chunk)
        out, before, at = [], 0, 0
        for w in words:
            gap = chunk.index(w, at) - at  # white space other than ASCII's
            out += [before] * gap
            if w in _CONTRACTION:  # a shorter prefix is not a contraction
                table = [self.word("'")] + [self.word("'") + self.word(w[1:k]) for k in range(2, len(w))] + [self.word(w)]
            else:
                s, ends, n = self._letters(w), [], 0
                for c in w:
                    n += len(c.encode())
                    ends.append(n)
                table = self.word_table(s, ends)
            out += [before + x for x in table]
            before += table[-1]
            at += gap + len(w)
        return out + [before] * (len(chunk) - at)

    def _library_prefixes(self, chunk: str) -> list[int]:
        """The same by the library, one special string or stretch of usual text at a time."""
        special = re.compile("|".join(map(re.escape, self.specials)) or r"(?!)")
        normal = library(self.path).normalizer.normalize_str
        encode = library(self.path).encode
        out, before, at = [], 0, 0
        for m in [*special.finditer(chunk), None]:
            stop = m.end() if m else len(chunk)
            part = normal(chunk[at:stop]) if not m else normal(chunk[at : m.start()]) + m[0]
            # a prefix only has to be encoded from the last white space or start of the part on
            counts = [before + len(encode(part[:k], add_special_tokens=False)) for k in range(1, len(part) + 1)]
            out += counts
            before = counts[-1] if counts else before
            at = stop
        return out

    def longest_prefix(self, text: str, limit: int) -> int:
        """Code points of the longest prefix of a text with at most ``limit`` tokens.

        Inside a chunk whose normalised form has another length the prefix ends before the chunk.
        """
        raw = text.encode()
        self.totals([raw])  # all its chunks are known now
        ends = np.cumsum([self.chunks[c] for c in raw.split()])
        at = int(np.searchsorted(ends, limit, side="right"))
        if at == len(ends):
            return len(text)
        m = next(islice(_CHUNK.finditer(text), at, None))
        before = int(ends[at - 1]) if at else 0
        table = self.prefixes(m[0])
        inside = 0
        if len(table) == len(m[0]):
            inside = max((k for k, n in enumerate(table, 1) if before + n <= limit), default=0)
        return m.start() + inside if inside else m.start()

    def counts(self, text: str) -> np.ndarray:
        """Tokens of every prefix of a text: one number for each code point, chunks normalised, white space as it is."""
        out, before, at = [], 0, 0
        for m in _CHUNK.finditer(text):
            out += [before] * (m.start() - at)
            table = self.prefixes(m[0])
            out += [before + n for n in table]
            before += table[-1] if table else 0
            at = m.end()
        return np.array(out + [before] * (len(text) - at), dtype=np.int32)


@lru_cache(maxsize=None)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def prefix_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and the token count at every prefix of its text (see ``PrefixCounter.counts``)."""
    path = tokenizer or tokenizer_path("word_bpe_49k.json")

    def fn(piece: pa.RecordBatch) -> pa.RecordBatch:
        tables = [counter(path).counts(t or "") for t in piece.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(tables, pa.list_(pa.int32()))], names=["doc_id", "counts"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_texts(rows, fn, "doc_id long, counts array<int>")


def token_counts(docs: DataFrame, tokenizer: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, and the code points that fit into the limit."""
    path = tokenizer or tokenizer_path("word_bpe_49k.json")

    def fn(piece: pa.RecordBatch) -> pa.RecordBatch:
        own = counter(path)
        raws = [r or b"" for r in piece.column("text").cast(pa.binary()).to_pylist()]
        n = own.totals(raws)
        fit = [len(t) if k <= limit else own.longest_prefix(t, limit) for t, k in zip((r.decode() for r in raws), n)]
        return pa.RecordBatch.from_arrays(
            [piece.column("doc_id"), pa.array(map(len, raws), pa.int64()), pa.array(n, pa.int64()),
             pa.array([k > limit for k in n]), pa.array(fit, pa.int64())],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fitting_chars"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_texts(rows, fn, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fitting_chars long",
                     limit=16 * textvec.SLICE_BYTES)
