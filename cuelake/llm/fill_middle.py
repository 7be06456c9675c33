"""Fill-in-middle transformation over a seekable store of compressed frames.

A text is stored as independent zstandard frames of FRAME_CHARS code points each, with
the units (lines), code points and bytes that come before every frame. A cut after the
k-th unit is found from the cumulative counts and one decompressed frame; outputs and
digests stream the frames in order, so beside the compressed frames a task holds one
frame of a document at a time. Outputs are stores of the same kind, and a text is
restored from its output and form alone.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from cuelake.llm.common import row_chunks, stored, text_of

# The marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
FRAME_CHARS = 65_536
LEVEL = 1
# Frames of finished outputs a task holds at once; a longer output is held alone.
HELD = 256
FRAME = "struct<data:binary,units:bigint,chars:bigint,bytes:bigint>"
FRAMES = pa.list_(pa.struct([("data", pa.binary()), ("units", pa.int64()), ("chars", pa.int64()), ("bytes", pa.int64())]))


class Frames:
    """Compressed frames of a text; ``units``, ``chars`` and ``bytes`` count up to each frame's end."""

    def __init__(self):
        self.data, self.units, self.chars, self.bytes, self.open = [], [0], [0], [0], (-1, b"")

    @classmethod
    def of_text(cls, text: str) -> Frames:
        return cls.of_chunks(text[k:k + FRAME_CHARS].encode() for k in range(0, len(text), FRAME_CHARS))

    @classmethod
    def of_chunks(cls, chunks: Iterable[bytes]) -> Frames:
        """Chunks of UTF-8, each of whole code points; small ones share a frame."""
        self, packer, buffer = cls(), zstandard.ZstdCompressor(level=LEVEL), bytearray()
        for chunk in chunks:
            buffer += chunk
            if len(buffer) >= FRAME_CHARS:
                self._add(packer, bytes(buffer))
                buffer.clear()
        if buffer:
            self._add(packer, bytes(buffer))
        return self

    def _add(self, packer: zstandard.ZstdCompressor, raw: bytes) -> None:
        self.data.append(packer.compress(raw))
        self.units.append(self.units[-1] + raw.count(b"\n"))
        self.chars.append(self.chars[-1] + n_chars(raw))
        self.bytes.append(self.bytes[-1] + len(raw))

    @classmethod
    def of_rows(cls, rows: list[dict]) -> Frames:
        self = cls()
        for row in rows:
            self.data.append(row["data"])
            self.units.append(row["units"])
            self.chars.append(row["chars"])
            self.bytes.append(row["bytes"])
        return self

    def rows(self) -> list[dict]:
        return [{"data": d, "units": u, "chars": c, "bytes": b}
                for d, u, c, b in zip(self.data, self.units[1:], self.chars[1:], self.bytes[1:])]

    def frame(self, k: int) -> bytes:
        if self.open[0] != k:
            self.open = (k, zstandard.ZstdDecompressor().decompress(self.data[k]))
        return self.open[1]

    def read(self, start: int, stop: int) -> Iterator[bytes]:
        """The bytes from start to stop, frame by frame."""
        k = bisect_right(self.bytes, start) - 1
        while start < stop:
            raw, first = self.frame(k), self.bytes[k]
            yield raw[start - first:stop - first]
            start, k = self.bytes[k + 1], k + 1

    def n_units(self) -> int:
        """Lines; an unfinished last one counts."""
        if not self.data:
            return 0
        return self.units[-1] + (not self.frame(len(self.data) - 1).endswith(b"\n"))

    def after(self, unit: int) -> tuple[int, int]:
        """Bytes and code points up to the end of the unit-th line."""
        if unit <= 0:
            return 0, 0
        if unit > self.units[-1]:
            return self.bytes[-1], self.chars[-1]
        k = bisect_left(self.units, unit) - 1
        raw, at = self.frame(k), -1
        for _ in range(unit - self.units[k]):
            at = raw.index(b"\n", at + 1)
        return self.bytes[k] + at + 1, self.chars[k] + n_chars(raw[:at + 1])

    def find(self, marks: Iterable[bytes]) -> dict[bytes, int]:
        """First place of each mark that occurs, across frames as well."""
        marks = list(marks)
        overlap, found, tail = max(map(len, marks)) - 1, {}, b""
        for k in range(len(self.data)):
            raw = tail + self.frame(k)
            for mark in marks:
                if mark not in found and (at := raw.find(mark)) >= 0:
                    found[mark] = self.bytes[k] - len(tail) + at
            tail = raw[-overlap:]
        return found


def n_chars(raw: bytes) -> int:
    """Code points of UTF-8 bytes."""
    return len(raw.decode("utf-8", "surrogatepass"))


def digest(chunks: Iterable[bytes]) -> str:
    sha = hashlib.sha256()
    for chunk in chunks:
        sha.update(chunk)
    return sha.hexdigest()


def arrange(text: Frames, form: str, first: int, second: int) -> Iterator[bytes]:
    """The output of a form whose middle lies between two byte positions."""
    end = text.bytes[-1]
    if form == "plain":
        yield from text.read(0, end)
        return
    parts = [(PREFIX, 0, first), (SUFFIX, second, end)]
    for mark, start, stop in [*(parts if form == "psm" else parts[::-1]), (MIDDLE, first, second)]:
        yield mark
        yield from text.read(start, stop)


def restore(output: Frames, form: str) -> Iterator[bytes]:
    """The text, from the output alone: its parts between the marks, in their old order."""
    end = output.bytes[-1]
    if form == "plain":
        yield from output.read(0, end)
        return
    at = output.find([PREFIX, SUFFIX, MIDDLE])
    stop = dict(zip(sorted(at, key=at.get), [*sorted(at.values())[1:], end]))
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from output.read(at[mark] + len(mark), stop[mark])


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the frames of every text; a null or empty text has none."""
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), text_of(docs[text_col]).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in row_chunks(batches, "text"):
            frames = [Frames.of_text(text).rows() for text in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(frames, FRAMES)], ["doc_id", "frames"])

    return rows.mapInArrow(run, f"doc_id bigint, frames array<{FRAME}>")


def text_of_frames(frames: list[dict] | None) -> str:
    """The whole text of stored frames."""
    kept = Frames.of_rows(frames or [])
    return b"".join(kept.read(0, kept.bytes[-1])).decode()


def _draws(seed: int) -> list[Column]:
    """Four 32-bit numbers of a document, from the digest of seed and id."""
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(hexed, 8 * k + 1, 8), 16, 10).cast("bigint").alias(f"h{k + 1}") for k in range(4)]


def transform(frames: DataFrame, seed: int = 7, rate_pct: int = 100, spm_pct: int = 50, keep_output: bool = True) -> DataFrame:
    """One row per stored document: doc_id, n, form, prefix_chars, middle_chars, output,
    output_sha256, restored_sha256, lossless.

    ``output`` holds the frames of the transformed text (``text_of_frames`` reads it).
    Cuts and forms depend on seed and id only: repeated rows come out alike, null ids
    share the draws of an empty id, equal cuts leave the middle empty. Empty texts and
    texts that hold a mark stay plain. A text of any length is transformed whole; an
    empty table gives an empty result.
    """
    rows = frames.select("doc_id", "frames", *_draws(seed))
    out = (f"doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output array<{FRAME}>, "
           "output_sha256 string, restored_sha256 string, lossless boolean")

    def one(kept: list[dict], h1: int, h2: int, h3: int, h4: int) -> tuple:
        text = Frames.of_rows(kept)
        n = text.n_units()
        plain = not text.data or h3 % 100 >= rate_pct or bool(text.find([PREFIX, SUFFIX, MIDDLE]))
        form = "plain" if plain else "spm" if h4 % 100 < spm_pct else "psm"
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        (first, a), (second, b) = text.after(low), text.after(high)
        output = Frames.of_chunks(arrange(text, form, first, second))
        before = digest(text.read(0, text.bytes[-1]))
        after = digest(restore(output, form))
        return (n, form, None if plain else a, None if plain else b - a, output.rows() if keep_output else None,
                digest(output.read(0, output.bytes[-1])), after, before == after)

    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), FRAMES, pa.string(), pa.string(), pa.bool_())
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "output_sha256", "restored_sha256", "lossless"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            draws = [batch.column(f"h{k}").to_pylist() for k in range(1, 5)]
            start, held, done = 0, 0, []
            for k, kept in enumerate(batch.column("frames")):
                done.append(one(kept.as_py(), *(d[k] for d in draws)))
                held += len(kept) + 1
                if held >= HELD or k + 1 == batch.num_rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*done), kinds)]
                    yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(start, len(done)), *columns], names)
                    start, held, done = k + 1, 0, []

    return rows.mapInArrow(run, out)


def fill_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``transform`` of the texts, by way of a written store in the shared folder."""
    return transform(stored(store(docs, id_col, text_col), "frames"), **how)
