"""Byte-level BPE encoding by a segment tree of pair ranks, and decoding.

A text is cut by a pattern and every match encoded for itself. Leaf ``i`` of a match's
tree holds the rank of the token that starts at byte ``i`` joined with its right
neighbour, and each inner node the smaller of its children; ranks carry their position,
so the root names the leftmost of the best pairs. A merge changes three leaves (the
merged token, the one it swallowed, its left neighbour) and the path above each, so a
match of n bytes costs O(n log n) time and O(n) memory, however long it is.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from cuelake.llm.common import row_chunks

# Matches of a text handled at once; distinct ones, of up to so many characters, whose
# tokens a worker process remembers over its tasks (all of them are forgotten beyond that).
SLAB, CACHED, CACHED_CHARS = 100_000, 1_000_000, 64


class Ranks:
    """Token of every byte string of a vocabulary file, and the bytes of every token."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.rank = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.raw = sorted(self.rank, key=self.rank.get)
        if [self.rank[token] for token in self.raw] != list(range(len(pairs))):
            raise ValueError(f"{path}: ranks are not 0 to {len(pairs) - 1}, each once")


@lru_cache(maxsize=2)
def load(path: str) -> Ranks:
    return Ranks(path)


@lru_cache(maxsize=2)
def remembered(path: str) -> dict[str, bytes]:
    """Tokens of the matches this process has seen under a vocabulary, whatever the pattern."""
    return {}


def merge_tokens(word: bytes, rank: dict[bytes, int]) -> list[int]:
    """Tokens of one match: the best-ranked pair, leftmost on ties, until none is left."""
    whole = rank.get(word)
    if whole is not None:
        return [whole]
    n, find = len(word), rank.get
    half = 1 << (n - 1).bit_length()
    none = len(rank) * half  # above every rank * half + position
    # Pairs of single bytes, then every inner node from its children.
    tree = [none] * half
    tree += [none if (r := find(word[i:i + 2])) is None else r * half + i for i in range(n - 1)]
    tree += [none] * (2 * half - len(tree))
    for k in range(half - 1, 0, -1):
        a, b = tree[2 * k], tree[2 * k + 1]
        tree[k] = a if a < b else b
    stop, left = [*range(1, n + 1), n], [*range(-1, n)]
    while (root := tree[1]) != none:
        i = root & (half - 1)
        j = stop[i]
        end = stop[i] = stop[j]
        left[end] = i
        h = left[i]
        own = find(word[i:stop[end]]) if end < n else None
        changed = [(j, none), (i, none if own is None else own * half + i)]
        if h >= 0:
            before = find(word[h:end])
            changed.append((h, none if before is None else before * half + h))
        for at, low in changed:
            k = half + at
            while k and tree[k] != low:
                tree[k] = low
                b = tree[k ^ 1]
                if b < low:
                    low = b
                k >>= 1
    out, i = [], 0
    while i < n:
        out.append(rank[word[i:stop[i]]])
        i = stop[i]
    return out


def _slabs(text: str, cut: regex.Pattern) -> Iterator[list[str]]:
    """The matches of a text in lists of at most SLAB; a short text's are found by one call."""
    if len(text) <= SLAB and not cut.groups:
        yield cut.findall(text)
        return
    matches = cut.finditer(text)
    while words := [m[0] for m in islice(matches, SLAB)]:
        yield words


def encode_text(text: str, cut: regex.Pattern, ranks: Ranks, known: dict[str, bytes]) -> array:
    """Token ids of a whole text; ``known`` holds the tokens of short matches seen before."""
    ids = array("I")
    for words in _slabs(text, cut):
        fresh = set(words).difference(known)
        for word in fresh:
            known[word] = array("I", merge_tokens(word.encode(), ranks.rank)).tobytes()
        ids.frombytes(b"".join(map(known.__getitem__, words)))
        for word in fresh:
            if len(word) > CACHED_CHARS:
                del known[word]
        if len(known) > CACHED:
            known.clear()
    return ids


def decode_ids(ids, ranks: Ranks) -> bytes:
    return b"".join([ranks.raw[i] for i in ids])


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           keep_ids: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids, ids_sha256, decoded_sha256, lossless.

    ``path`` is a file of base64 tokens and ranks that every executor can read;
    ``pattern`` cuts a text into matches. Ties of rank are merged left to right. A null
    or empty text has no tokens; repeated rows and ids are encoded one by one; texts and
    matches of any length are encoded whole; an empty table gives an empty result; a
    null id stays null; further columns are ignored.
    """
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    out = "doc_id bigint, n_tokens bigint, ids array<int>, ids_sha256 string, decoded_sha256 string, lossless boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, cut, known = load(path), regex.compile(pattern), remembered(path)
        for part in row_chunks(batches, "text"):
            n_tokens, ids_of, ids_sha, back_sha, same = [], [], [], [], []
            for text in part.column("text").to_pylist():
                ids = encode_text(text or "", cut, ranks, known)
                back = decode_ids(ids, ranks)
                n_tokens.append(len(ids))
                ids_of.append(np.frombuffer(ids, np.uint32).astype(np.int32) if keep_ids else None)
                ids_sha.append(hashlib.sha256(np.frombuffer(ids, np.uint32).astype("<u4").tobytes()).hexdigest())
                back_sha.append(hashlib.sha256(back).hexdigest())
                same.append(back == (text or "").encode())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array(ids_of, pa.list_(pa.int32())),
                 pa.array(ids_sha, pa.string()), pa.array(back_sha, pa.string()), pa.array(same, pa.bool_())],
                ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256", "lossless"])

    return rows.mapInArrow(run, out)


def decode(encoded: DataFrame, path: str, ids_col: str = "ids") -> DataFrame:
    """doc_id and text of encoded rows; null ids give a null text."""
    rows = encoded.select(encoded["doc_id"].cast("bigint").alias("doc_id"), encoded[ids_col].alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = load(path)
        for batch in batches:
            texts = [None if ids is None else decode_ids(ids, ranks).decode("utf-8", "replace") for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.mapInArrow(run, "doc_id bigint, text string")
