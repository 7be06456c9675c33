"""Merge-type (BPE) SentencePiece encoding with seeded merge-dropout, and decoding.

Merges come from the pieces and scores of a published model file; the agenda is our
own: in every word the candidate merge with the best score, leftmost on ties, is taken
until none is left. With dropout a candidate (start, middle, end) is skipped when a
keyed hash of it falls below the rate, so the same seed always gives the same pieces,
another seed other pieces, and any of them decode to the same text.

No piece holds a space after another character, so runs of spaces plus a word are cut
independently. A batch's distinct words are processed side by side in numpy; words too
long for that use a heap. Characters without a piece, and a literal U+2581, become
byte pieces, which keeps decoding lossless.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# The space mark of the model, and what stands for a literal one (a lone
# surrogate, which no text holds).
MARK, LITERAL = "▁", "\udc81"
# Longer words leave the side-by-side agenda.
WIDE = 48
# Characters of text handled at once in a task; a longer text is handled alone.
CHUNK_CHARS = 4_000_000
GROUPS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
NONE = np.float32(-np.inf)
_M64 = (1 << 64) - 1


class Pieces:
    """Vocabulary, merge table and piece bytes of a model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(n)]
        plain = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)]
        self.ids = {names[i]: i for i in range(n) if plain[i]}
        self.byte_ids = {int(names[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.raw = [names[i].replace(MARK, " ").encode() if plain[i] else b"" for i in range(n)]
        for byte, i in self.byte_ids.items():
            self.raw[i] = bytes([byte])
        self.of_char = np.full(0x110000, -1, np.int64)
        for name, i in self.ids.items():
            if len(name) == 1:
                self.of_char[ord(name)] = i
        self.size = n
        pairs = {}
        for name, i in self.ids.items():
            for k in range(1, len(name)):
                a, b = self.ids.get(name[:k]), self.ids.get(name[k:])
                if a is not None and b is not None:
                    pairs[a * n + b] = i
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.merged = np.array([pairs[k] for k in sorted(pairs)], np.int64)
        self.scores = np.array([model.get_score(i) for i in range(n)], np.float32)

    def merge(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merged piece and score of each pair; score -inf where there is no merge."""
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        ok = (self.keys[at] == key) & (a >= 0) & (b >= 0)
        return self.merged[at], np.where(ok, self.scores[self.merged[at]], NONE)

    def spelled(self, char: int) -> list[int]:
        """Byte pieces of a character without a piece."""
        return [self.byte_ids[x] for x in (MARK if chr(char) == LITERAL else chr(char)).encode()]


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


def _mix(x):
    """A 64-bit finaliser, on Python integers or numpy arrays alike."""
    if isinstance(x, np.ndarray):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & _M64
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & _M64
    return x ^ (x >> 31)


def _candidate(word, start, mid, end):
    """Keyed hash of a candidate merge."""
    if isinstance(start, np.ndarray):
        at = (start.astype(np.uint64) << np.uint64(42)) ^ (mid.astype(np.uint64) << np.uint64(21)) ^ end.astype(np.uint64)
        return _mix(_mix(word ^ at))
    return _mix(_mix(word ^ (((start << 42) ^ (mid << 21) ^ end) & _M64)))


def _word_keys(words: list[str], seed: int, variants: np.ndarray) -> np.ndarray:
    """One 64-bit key per (seed, variant, word)."""
    from pandas.util import hash_array  # in tasks only; the driver does without

    own = hash_array(np.array(words, dtype=object), hash_key="merge-dropout-01", categorize=False)
    return _mix(own ^ _mix((variants.astype(np.uint64) << np.uint64(32)) ^ np.uint64(seed & 0xFFFFFFFF)))


def _agenda(p: Pieces, word: str, key: int, limit: int) -> list[int]:
    """One word by a heap of candidate merges; linear memory, n log n time."""
    chars = [ord(c) for c in word]
    sym = [int(p.of_char[c]) for c in chars]
    n = len(sym)
    right, left, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    heap = []

    def offer(i: int) -> None:
        j = right[i]
        if j < n and sym[i] >= 0 and sym[j] >= 0:
            to = p.pairs.get(sym[i] * p.size + sym[j])
            if to is not None and not (limit and _candidate(key, i, end[i], end[j]) < limit):
                heapq.heappush(heap, (-float(p.scores[to]), i, end[i], end[j], to))

    for i in range(n - 1):
        offer(i)
    dead = [False] * n
    while heap:
        _, i, mid, stop, to = heapq.heappop(heap)
        if dead[i] or end[i] != mid or right[i] >= n or end[right[i]] != stop:
            continue
        j = right[i]
        sym[i], end[i], dead[j], right[i] = to, stop, True, right[j]
        if right[i] < n:
            left[right[i]] = i
        if left[i] >= 0:
            offer(left[i])
        offer(i)
    out, i = [], 0
    while i < n:
        out += [sym[i]] if sym[i] >= 0 else p.spelled(chars[i])
        i = right[i]
    return out


def _side_by_side(p: Pieces, words: list[str], keys: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of similar length as a matrix; each round does every word's best merge.

    Yields (word positions, their symbols padded with -1) as words run out of merges.
    """
    lens = np.array([len(w) for w in words])
    width = int(lens.max())
    chars = np.frombuffer("".join(w.ljust(width, "\0") for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(-1, width).astype(np.int64)
    inside = np.arange(width) < lens[:, None]
    # Characters without a piece keep their code point below -1; -1 is padding.
    sym = np.where(inside, np.where(p.of_char[chars] >= 0, p.of_char[chars], -2 - chars), -1)
    end = np.broadcast_to(np.arange(1, width + 1), sym.shape).copy()
    rows, key = np.arange(len(words)), keys

    def priced(a, b, k, start, mid, stop):
        to, score = p.merge(a, b)
        if limit:
            score = np.where(_candidate(k, start, mid, stop) < np.uint64(limit), NONE, score)
        return to, score

    if width > 1:
        start = np.broadcast_to(np.arange(width - 1), (len(rows), width - 1))
        to, score = priced(sym[:, :-1], sym[:, 1:], key[:, None], start, end[:, :-1], end[:, 1:])
    while width > 1:
        best = score.argmax(1)
        over = np.take_along_axis(score, best[:, None], 1)[:, 0] == NONE
        if over.any():
            yield rows[over], sym[over]
            go = ~over
            rows, key, sym, end, to, score, best = rows[go], key[go], sym[go], end[go], to[go], score[go], best[go]
            if not len(rows):
                return
        each, at, width = np.arange(len(rows)), best[:, None], width - 1
        col = np.arange(width)
        merged = to[each, best]
        sym = np.take_along_axis(sym, col + (col > at), 1)
        sym[each, best] = merged
        end = np.take_along_axis(end, col + (col >= at), 1)
        if width == 1:
            break
        shift = np.minimum(col[:-1] + (col[:-1] > at), width - 1)
        to, score = np.take_along_axis(to, shift, 1), np.take_along_axis(score, shift, 1)
        # Only the pairs on either side of the new symbol are priced again.
        for c in (best - 1, best):
            ok = np.nonzero((c >= 0) & (c < width - 1))[0]
            j = c[ok]
            start = np.where(j > 0, end[ok, np.maximum(j - 1, 0)], 0)
            to[ok, j], score[ok, j] = priced(sym[ok, j], sym[ok, j + 1], key[ok], start, end[ok, j], end[ok, j + 1])
    yield rows, sym


def encode_words(p: Pieces, words: list[str], keys: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Piece ids of all words in one array, and where each word starts and how long it is."""
    lens = np.array([len(w) for w in words], np.int64)
    starts, sizes, flat, total = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), [], 0

    def put(at: np.ndarray, n: np.ndarray, ids: np.ndarray) -> None:
        nonlocal total
        sizes[at], starts[at] = n, total + np.cumsum(n) - n
        flat.append(ids)
        total += len(ids)

    edges = [0, *range(3, 16), 18, 22, 28, 36, WIDE]
    for lo, hi in zip(edges, edges[1:]):
        at = np.nonzero((lens > lo) & (lens <= hi))[0]
        if len(at):
            for k, block in _side_by_side(p, [words[k] for k in at], keys[at], limit):
                used = block != -1
                put(at[k], used.sum(1), block[used])
    for k in np.nonzero(lens > WIDE)[0]:
        ids = np.array(_agenda(p, words[k], int(keys[k]), limit), np.int64)
        put(np.array([k]), np.array([len(ids)]), ids)
    ids = np.concatenate(flat) if flat else np.zeros(0, np.int64)
    odd = np.nonzero(ids < 0)[0]
    if len(odd):  # characters to spell as bytes
        spelled = [p.spelled(-2 - int(x)) for x in ids[odd]]
        grow = np.ones(len(ids), np.int64)
        grow[odd] = [len(b) for b in spelled]
        upto = np.concatenate([[0], np.cumsum(grow)])
        ids = np.repeat(ids, grow)
        ids[np.repeat(upto[odd], grow[odd]) + np.concatenate([np.arange(len(b)) for b in spelled])] = [i for b in spelled for i in b]
        sizes, starts = upto[starts + sizes] - upto[starts], upto[starts]
    return ids, starts, sizes


def encode_texts(p: Pieces, texts: list[str], variants: np.ndarray, seed: int, dropout: float) -> list[np.ndarray]:
    """Piece ids of each text; an empty text has none."""
    limit = min(_M64, int(dropout * 2.0 ** 64))
    groups = [GROUPS.findall((MARK + t.replace(MARK, LITERAL).replace(" ", MARK))) if t else [] for t in texts]
    counts = np.array([len(g) for g in groups], np.int64)
    flat = [w for g in groups for w in g]
    if not flat:
        return [np.zeros(0, np.int32) for _ in texts]
    from pandas import factorize

    # The closing number keeps pandas from its table of C strings, which end at a NUL.
    codes, names = factorize(np.array([*flat, 0], dtype=object))
    codes = codes[:-1]
    variant = np.repeat(variants, counts)
    wide = int(variants.max()) + 1
    pair, inverse = np.unique(codes * wide + variant, return_inverse=True)
    words, of = [names[k] for k in pair // wide], pair % wide
    plain = [w.encode("utf-8", "backslashreplace").decode() for w in words]
    ids, starts, own = encode_words(p, words, _word_keys(plain, seed, of), limit)
    sizes = own[inverse]
    ends = np.cumsum(sizes)
    take = np.arange(int(ends[-1])) + np.repeat(starts[inverse] - (ends - sizes), sizes)
    tokens = ids[take].astype(np.int32)
    return np.split(tokens, np.concatenate([[0], ends])[np.cumsum(counts)[:-1]])


def decode_ids(p: Pieces, ids) -> str:
    """The text of piece ids; the space put in front of every text is taken off."""
    return b"".join(map(p.raw.__getitem__, ids))[1:].decode("utf-8", "replace")


def _pieces_of(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most CHUNK_CHARS bytes together."""
    sizes = np.array([len(t.as_buffer()) if t.is_valid else 0 for t in texts.cast(pa.large_binary())], np.int64)
    start, total = 0, 0
    for k, size in enumerate(sizes):
        if k > start and total + size > CHUNK_CHARS:
            yield start, k
            start, total = k, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", dropout: float = 0.1, seed: int = 17,
           variants: int = 4, model: str = MODEL, keep_ids: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids, ids_sha256, lossless.

    Null and empty texts have no pieces (null ids for null); repeated rows are encoded
    alike; an empty table gives an empty result; further columns are ignored. Documents
    fall into ``variants`` hash classes with segmentations of their own.
    """
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"),
                       F.pmod(F.xxhash64(docs[id_col], F.lit(seed)), F.lit(variants)).alias("variant"))
    out = "doc_id bigint, n_tokens bigint, ids array<int>, ids_sha256 string, lossless boolean"

    def run(batches):
        p = load(model)
        for batch in batches:
            for start, stop in _pieces_of(batch.column("text")):
                part = batch.slice(start, stop - start)
                raw = part.column("text").to_pylist()
                coded = encode_texts(p, [t or "" for t in raw], part.column("variant").to_numpy(), seed, dropout)
                ok = [t is None or decode_ids(p, c.tolist()) == t for t, c in zip(raw, coded)]
                sizes = np.array([len(c) for c in coded], np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)),
                                                 pa.array(np.concatenate(coded).astype(np.int32)),
                                                 mask=pa.array([t is None for t in raw]))
                sha = [hashlib.sha256(c.astype("<i4").tobytes()).hexdigest() for c in coded]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(sizes), lists if keep_ids else pa.nulls(len(raw), pa.list_(pa.int32())),
                     pa.array(sha), pa.array(ok)], ["doc_id", "n_tokens", "ids", "ids_sha256", "lossless"])

    return rows.mapInArrow(run, out)
