"""Encoding with a public byte-level BPE (problem 8), by dynamic programming over prefixes.

For every prefix of a piece of text exactly one token can end its encoding. The candidates are the vocabulary's tokens that are
suffixes of the prefix, found by one pass of an Aho-Corasick automaton; a candidate is right if the token before it (that of
the shorter prefix) and it stay two tokens when encoded together, which is decided by undoing their merges. Following the stored
tokens back from the end gives the ids that merging by rank would give.

Texts are first cut by the tokenizer's pattern; pieces that came up before are looked up.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

TOKENIZER = os.environ.get("TIDEGLASS_TOKENIZER", "/opt/tokenizers/byte_bpe_50k.json")
#: The pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces that a worker keeps, and the longest that it keeps.
KEPT_PIECES, KEPT_LENGTH = 400_000, 64
NONE = 1 << 40


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary: itself, or the next free one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return {chr(b if b in shown else next(free)): b for b in range(256)}


class PrefixEncoder(dict):
    """Ids of pieces (text of the pattern's matches), computed on demand."""

    def __init__(self, path: str):
        super().__init__()
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        letters, vocab = byte_letters(), model["vocab"]
        self.merged: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        for rule in model["merges"]:
            a, b = rule.split(" ") if isinstance(rule, str) else rule
            pair, whole = (vocab[a], vocab[b]), vocab[a + b]
            self.merged[pair] = whole
            self.parts[whole] = pair
        self.automaton = ahocorasick.Automaton()
        for text, token in vocab.items():
            # One latin-1 character for each byte.
            self.automaton.add_word("".join(chr(letters[x]) for x in text), (token, len(text)))
        self.automaton.make_automaton()
        self.fits: dict[tuple[int, int], bool] = {}
        self.find = regex.compile(PATTERN).findall

    def stay_apart(self, left: int, right: int) -> bool:
        """Whether the encoding of both tokens' bytes is just these two tokens.

        The one formed later is undone, step by step, at the side of the border; a merge across the border spoils it if its rank
        comes before that of the merges that are still done on both sides, in which it would have been made first."""
        merged, parts = self.merged, self.parts
        bound = NONE
        while True:
            across = merged.get((left, right))
            if across is not None and across < bound:
                return False
            if left > right and left in parts:
                bound, left = left, parts[left][1]
            elif right in parts:
                bound, right = right + 1, parts[right][0]
            elif left in parts:
                bound, left = left, parts[left][1]
            else:
                return True

    def encode_bytes(self, data: bytes) -> list[int]:
        text = data.decode("latin-1")
        n = len(text)
        last = array("q", [-1]) * (n + 1)
        size = array("q", [0]) * (n + 1)
        fits = self.fits
        for end, (token, length) in self.automaton.iter(text):
            at = end + 1
            if last[at] >= 0:
                continue
            before = last[at - length]
            if at > length:
                pair = (before, token)
                ok = fits.get(pair)
                if ok is None:
                    if len(fits) > 4 * KEPT_PIECES:
                        fits.clear()
                    ok = fits[pair] = self.stay_apart(before, token)
                if not ok:
                    continue
            last[at], size[at] = token, length
        out, at = [], n
        while at:
            out.append(last[at])
            at -= size[at]
        out.reverse()
        return out

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = tuple(self.encode_bytes(piece.encode("utf-8", "surrogatepass")))
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> Iterator[int]:
        return chain.from_iterable(map(self.__getitem__, self.find(text)))

    def count(self, text: str) -> int:
        return sum(map(len, map(self.__getitem__, self.find(text))))


@lru_cache(maxsize=2)
def encoder(path: str) -> PrefixEncoder:
    """One encoder for each worker process and tokenizer file."""
    return PrefixEncoder(path)


def encode_documents(documents: DataFrame, text: str = "text", key: str = "doc_id", path: str = TOKENIZER) -> DataFrame:
    """key, ids: the ids of each text, without special tokens. Empty and null texts have no ids: an empty list.

    A map over the scan, without shuffle; other columns aren't read. The tokenizer's file must be at `path` on every worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for batch in batches:
            ids, ends = array("i"), [0]
            for t in batch.column(1).to_pylist():
                if t:
                    ids.extend(code.encode(t))
                ends.append(len(ids))
            values = pa.array(np.frombuffer(ids, dtype=np.int32) if ids else np.empty(0, np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)], names=[key, "ids"])

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def token_counts(documents: DataFrame, text: str = "text", key: str = "doc_id", path: str = TOKENIZER) -> DataFrame:
    """key, n_tokens; 0 for empty and null texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for batch in batches:
            sizes = [code.count(t) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=[key, "n_tokens"])

    kind = documents.schema[key].dataType.simpleString()
    return documents.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_tokens bigint")
