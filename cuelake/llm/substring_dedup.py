"""Removal of repeated 100-byte strings by column-wise sorting of many short texts.

Building one suffix order of a whole corpus column by column takes a round per byte of
its longest document, so the construction runs on what can repeat at all:

1. Equal documents are collapsed first; all but the first of a kind repeat wholly.
2. Every window of WIDTH bytes is named after its smallest hash of GRAM bytes (its
   anchor). Equal windows have equal anchors at equal offsets, so windows whose anchor
   occurs once repeat nowhere. About one anchor per 35 bytes is counted, no text moves.
3. Around the anchors left, snippets hold the windows named after them, aligned at the
   anchor. A block of snippets is the collection: each round inserts one symbol per
   snippet, in front of what is there, and updates the order (the collection's
   Burrows-Wheeler order of that column) and the common prefixes of neighbours.
   Neighbours with a common prefix of WIDTH bytes are the same window; all but the first
   in the corpus is a repeat. Rounds are bounded by the snippet length.
4. Anchors with more than BLOCK occurrences are split by document and place, and cut
   anywhere where a part still exceeds a block; what each block keeps is then compared
   across blocks by two 64-bit hashes of the window.

Blocks stream through a task one after the other; a task holds one of at most 2 * BLOCK
snippets at a time.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cuelake.llm.common import stored, text_of
from cuelake.llm.exact_dedup import exact_duplicates
from cuelake.llm.row_ids import ranked_rows

WIDTH = 100
GRAM = 32
REACH = WIDTH - GRAM  # a window starts at most this far before its anchor
SNIPPET = REACH + WIDTH
BLOCK = 8192
POS_BITS = 22
SLICE = 1 << 18  # bytes whose windows are named at once (at most 1 << POS_BITS); arrays of 64-bit hashes are held of them
PAD = 256
# Places of one document that a frequent anchor's part takes together; bytes of a text that snippets are cut from at once.
RANGE, PART = 1 << 10, 1 << 16
SMALL_IDS = 1_000_000


def _gram_hashes(b: np.ndarray) -> np.ndarray:
    """64-bit hash of the GRAM bytes from each position, by doubling."""
    h = (b.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    n = 1
    while n < GRAM:
        h = h[:-n] * np.uint64(0xD6E8FEB86659FD93 + 2 * n) + h[n:]
        h ^= h >> np.uint64(29)
        n *= 2
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(30))


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, first window, last window) of each anchor of texts end to end."""
    if len(data) < WIDTH:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
    h = _gram_hashes(data)
    mask = np.uint64((1 << POS_BITS) - 1)
    low = (h & ~mask) | np.arange(len(h), dtype=np.uint64)
    span, n = REACH + 1, 1
    while 2 * n <= span:
        low = np.minimum(low[:-n], low[n:])
        n *= 2
    low = np.minimum(low[:len(low) - (span - n)], low[span - n:])
    # A window must end inside its text.
    room = ends[np.searchsorted(ends, np.arange(len(low)), side="right")] - np.arange(len(low))
    starts = np.nonzero(room >= WIDTH)[0]
    at = (low[starts] & mask).astype(np.int64)
    new = np.ones(len(starts), bool)
    new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.nonzero(new)[0]
    last = np.append(first[1:], len(starts))[:len(first)] - 1
    return h[at[first]], at[first], starts[first], starts[last]


def _batches(texts: pa.Array):
    """(bytes, row of each piece, offset of each piece in its text, end of each piece in bytes)."""
    pieces, rows, offs, size = [], [], [], 0
    for k, t in enumerate(texts):
        raw = np.frombuffer(t.as_buffer(), np.uint8) if t.is_valid else np.zeros(0, np.uint8)
        for at in range(0, max(len(raw) - WIDTH + 1, 0), SLICE):
            part = raw[at:at + SLICE + WIDTH - 1]
            if size + len(part) > SLICE + WIDTH and pieces:
                yield np.concatenate(pieces), np.array(rows), np.array(offs), np.cumsum([len(p) for p in pieces])
                pieces, rows, offs, size = [], [], [], 0
            pieces.append(part)
            rows.append(k)
            offs.append(at)
            size += len(part)
    if pieces:
        yield np.concatenate(pieces), np.array(rows), np.array(offs), np.cumsum([len(p) for p in pieces])


def _name_windows(batches):
    for batch in batches:
        ids = batch.column("id").to_numpy(zero_copy_only=False)
        for data, rows, offs, ends in _batches(batch.column("text")):
            key, at, lo, hi = anchors(data, ends)
            piece = np.searchsorted(ends, at, side="right")
            base = (ends - np.diff(np.concatenate([[0], ends])))[piece]
            yield pa.RecordBatch.from_arrays([
                pa.array(key.view(np.int64)), pa.array(ids[rows[piece]].astype(np.int64)), pa.array((at - base + offs[piece]).astype(np.int64)),
                pa.array((at - lo).astype(np.int16)), pa.array((at - hi).astype(np.int16))], ["anchor", "id", "at", "before", "after"])


def _cut(batches):
    """Snippets of the listed anchors, cut from their part of the document."""
    kinds = {"anchor": pa.int64(), "salt": pa.int64(), "id": pa.int64(), "at": pa.int64(), "before": pa.int16(), "after": pa.int16()}

    def out(held, snippets):
        return pa.RecordBatch.from_arrays([*(pa.array(np.concatenate([h[c] for h in held]), t) for c, t in kinds.items()),
                                           pa.array(snippets, pa.binary())], [*kinds, "snippet"])

    for batch in batches:
        ids, bases = (batch.column(c).to_pylist() for c in ("id", "base"))
        held, snippets = [], []
        for row in range(batch.num_rows):
            raw, marks = batch.column("text")[row].as_py(), batch.column("marks")[row].values
            fields = dict(zip((f.name for f in marks.type), (f.to_numpy() for f in marks.flatten())))
            fields["id"] = np.full(len(marks), ids[row], np.int64)
            lo = fields["at"] - fields["before"] - bases[row]
            hi = fields["at"] - fields["after"] + WIDTH - bases[row]
            for k in range(0, len(marks), BLOCK):
                held.append({c: fields[c][k:k + BLOCK] for c in kinds})
                snippets.extend(raw[x:y] for x, y in zip(lo[k:k + BLOCK].tolist(), hi[k:k + BLOCK].tolist()))
                if len(snippets) >= BLOCK:
                    yield out(held, snippets)
                    held, snippets = [], []
        if held:
            yield out(held, snippets)


def repeats(group: np.ndarray, rank: np.ndarray, before: np.ndarray, after: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Which windows (snippet, start column) equal one of a lower rank in their group.

    ``cells`` holds a snippet per row, aligned at column REACH and padded with PAD.
    """
    m = len(group)
    order = np.argsort(group, kind="stable")
    common = np.where(np.diff(group[order], prepend=-1) != 0, -1, 0)
    out = np.zeros((m, REACH + 1), bool)
    for col in range(cells.shape[1] - 1, -1, -1):
        # Insert the column's symbol in front of every snippet: a stable sort of the order.
        key = group[order] * (PAD + 1) + cells[order, col]
        moved = np.argsort(key, kind="stable")
        placed = key[moved]
        same = np.zeros(m, bool)
        same[1:] = placed[1:] == placed[:-1]
        # Common prefix with the neighbour: one more than the least between their old places.
        new = np.where(np.diff(group[order][moved], prepend=-1) != 0, -1, 0)
        hit = np.nonzero(same)[0]
        if len(hit):
            lo, hi = moved[hit - 1] + 1, moved[hit]
            level = np.floor(np.log2(hi - lo + 1)).astype(np.int64)
            table, step = common, 1
            least = np.empty(len(hit), np.int64)
            for k in range(int(level.max()) + 1):
                on = level == k
                least[on] = np.minimum(table[lo[on]], table[hi[on] - step + 1])
                table = np.minimum(table[:-step], table[step:]) if len(table) > step else table
                step *= 2
            new[hit] = np.minimum(least + 1, WIDTH)
        order, common = order[moved], new
        if col <= REACH:
            valid = (col >= REACH - before) & (col <= REACH - after)
            run = np.nonzero(common < WIDTH)[0]
            lowest = np.repeat(np.minimum.reduceat(np.where(valid[order], rank[order], m), run), np.diff(np.append(run, m)))
            out[order, col] = valid[order] & (rank[order] > lowest)
    return out


def _merged(ids: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of each document, overlapping and touching ones made one."""
    if not len(ids):
        return ids, lo, hi
    order = np.lexsort((lo, ids))
    ids, lo, hi = ids[order], lo[order], hi[order]
    other = np.diff(ids, prepend=ids[0]) != 0
    shift = np.cumsum(other) * (int(hi.max()) + 1)
    end = np.maximum.accumulate(hi + shift)
    new = np.ones(len(ids), bool)
    new[1:] = other[1:] | ((lo + shift)[1:] > end[:-1])
    first = np.nonzero(new)[0]
    return ids[first], lo[first], np.maximum.reduceat(hi, first)


def _sort_blocks(batches):
    """Blocks of (anchor, salt) groups, whole ones unless the anchor is split; yields
    repeated and, for split anchors, kept windows."""
    def block(rows: pa.Table):
        a, s, ids, at, before, after = (rows.column(c).to_numpy() for c in ("anchor", "salt", "id", "at", "before", "after"))
        before, after = before.astype(np.int64), after.astype(np.int64)
        raw = rows.column("snippet").combine_chunks()
        cells = np.full((len(a), SNIPPET), PAD, np.int16)
        place = np.arange(SNIPPET)
        filled = (place >= (REACH - before)[:, None]) & (place < (REACH - after + WIDTH)[:, None])
        cells[filled] = np.frombuffer(b"".join(x.as_buffer() for x in raw), np.uint8)
        group = np.cumsum((np.diff(a, prepend=a[0] - 1) != 0) | (np.diff(s, prepend=s[0] - 1) != 0)) - 1
        rank = np.empty(len(a), np.int64)
        rank[np.lexsort((at, ids))] = np.arange(len(a))
        again = repeats(group, rank, before, after, cells)
        edge = np.diff(np.pad(again.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        who, lo = np.nonzero(edge == 1)
        hi = np.nonzero(edge == -1)[1]
        start = at[who] - REACH + lo
        yield *_merged(ids[who], start, at[who] - REACH + hi - 1 + WIDTH), None, None
        split = s >= 0
        if split.any():  # windows kept here may be repeats of another block's
            cols = np.arange(REACH + 1)
            mine = split[:, None] & (cols >= (REACH - before)[:, None]) & (cols <= (REACH - after)[:, None]) & ~again
            who, col = np.nonzero(mine)
            for k in range(0, len(who), 50_000):
                w, c = who[k:k + 50_000], col[k:k + 50_000]
                window = cells[w[:, None], c[:, None] + np.arange(WIDTH)].astype(np.uint64)
                h1, h2 = (_poly(window, p).view(np.int64) for p in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
                start = at[w] - REACH + c
                yield ids[w], start, start + WIDTH, h1, h2

    def out(parts):
        for ids, lo, hi, h1, h2 in parts:
            n = len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(lo), pa.array(hi), pa.nulls(n, pa.int64()) if h1 is None else pa.array(h1),
                                              pa.nulls(n, pa.int64()) if h2 is None else pa.array(h2)], ["id", "lo", "hi", "h1", "h2"])

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        while held.num_rows > 2 * BLOCK:
            a, s = held.column("anchor").to_numpy(), held.column("salt").to_numpy()
            edges = np.nonzero((a[1:] != a[:-1]) | (s[1:] != s[:-1]))[0] + 1
            edges = edges[edges <= 2 * BLOCK]
            # Only a split anchor's part can be longer, and its blocks are compared afterwards.
            cut = int(edges[-1]) if len(edges) else BLOCK
            yield from out(block(held.slice(0, cut).combine_chunks()))
            held = held.slice(cut)
    if held is not None and held.num_rows:
        yield from out(block(held.combine_chunks()))


def _poly(window: np.ndarray, factor: int) -> np.ndarray:
    h = np.full(len(window), 7, np.uint64)
    for j in range(window.shape[1]):
        h = (h ^ (h >> np.uint64(31))) * np.uint64(factor) + window[:, j]
    return h ^ (h >> np.uint64(29))


def _remove(batches):
    """Bytes outside the repeated spans, as digests and counts."""
    for batch in batches:
        ids, n_removed, n_spans, sha = [], [], [], []
        for row in batch.to_pylist():
            raw, at, kept, removed, spans = row["text"], 0, [], 0, 0
            end = -1
            for lo, hi in sorted((s["lo"], s["hi"]) for s in row["spans"]):
                if lo > end:
                    kept.append(raw[at:lo])
                    spans += 1
                    removed += hi - lo
                    end = hi
                elif hi > end:
                    removed += hi - end
                    end = hi
                at = end
            kept.append(raw[at:])
            ids.append(row["id"])
            n_removed.append(removed)
            n_spans.append(spans)
            sha.append(hashlib.sha256(b"".join(kept)).hexdigest())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(sha, pa.string())],
                                         ["id", "n_removed", "n_spans", "kept_sha256"])


def _only(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Join on listed ids; a short list (counted, at most SMALL_IDS longs) is broadcast."""
    return rows.join(F.broadcast(ids) if ids.count() <= SMALL_IDS else ids, "id", how)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = "substrings") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Null texts count as empty; rows with a null id are returned whole (no order says
    what comes before them); rows repeating an id and text are treated alike; different
    texts of one id follow each other by digest; texts of any length are read whole; an
    empty table gives an empty result; further columns are ignored.
    """
    known = docs.filter(docs[id_col].isNotNull())
    own = stored(exact_duplicates(known, id_col, text_col, keep="smallest", name=name).select(
        F.col("doc_id").alias("id"), "text_sha256", (F.col("doc_id") == F.col("keep_id")).alias("first")), f"{name}-equal")
    if not own.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty():
        rows, names = ranked_rows(docs, id_col, text_col, name)
        given, lone = rows.filter("rank IS NOT NULL"), rows.filter("rank IS NULL")
        done = stored(remove_repeats(given.dropDuplicates(["rank"]).unionByName(lone), "rank", "text", f"{name}-ranked"), f"{name}-unique")
        back = given.select(F.col("rank").alias("doc_id")).join(done, "doc_id").join(names, F.col("doc_id") == F.col("rank"))
        return back.select(F.col("id").alias("doc_id"), *done.columns[1:]).unionByName(done.filter("doc_id IS NULL"))
    equal = own.select("id", "first")
    texts = docs.select(docs[id_col].cast("bigint").alias("id"), text_of(docs[text_col]).cast("binary").alias("text"))
    later = equal.filter("NOT first").select("id")
    owners = _only(texts.filter("id IS NOT NULL"), later, "left_anti")
    named = stored(owners.mapInArrow(_name_windows, "anchor bigint, id bigint, at bigint, before smallint, after smallint"), f"{name}-anchors")
    often = named.groupBy("anchor").agg(F.count("*").alias("df")).filter("df > 1")
    # Anchors with many occurrences are split by document and place, so no task holds them all.
    place = F.floor(F.col("at") / RANGE)
    parts = F.when(F.col("df") > BLOCK, F.pmod(F.xxhash64("id", place), F.ceil(F.col("df") / BLOCK) * 2)).otherwise(F.lit(-1))
    marks = stored(named.join(often, "anchor").withColumn("salt", parts.cast("bigint")).groupBy("id", F.floor(F.col("at") / PART).alias("part")).agg(
        F.collect_list(F.struct("anchor", "salt", "at", "before", "after")).alias("marks")), f"{name}-marks")
    base = F.greatest(F.lit(0), F.col("part") * PART - REACH)
    cut = _only(texts, marks.select("id").distinct(), "left_semi").dropDuplicates(["id"]).join(marks, "id").select(
        "id", base.alias("base"), F.substring("text", (base + 1).cast("int"), F.lit(PART + REACH + WIDTH)).alias("text"), "marks").mapInArrow(
        _cut, "anchor bigint, salt bigint, id bigint, at bigint, before smallint, after smallint, snippet binary")
    found = stored(cut.repartition("anchor", "salt").sortWithinPartitions("anchor", "salt").mapInArrow(
        _sort_blocks, "id bigint, lo bigint, hi bigint, h1 bigint, h2 bigint"), f"{name}-found")
    again = found.filter("h1 IS NULL").select("id", "lo", "hi")
    kept = found.filter("h1 IS NOT NULL")
    first = kept.groupBy("h1", "h2").agg(F.min("id").alias("id0"), F.count("*").alias("n")).filter("n > 1")
    # The earliest window of the smallest document is the first; others are repeats.
    across = kept.join(first, ["h1", "h2"])
    start = across.filter("id = id0").groupBy("h1", "h2").agg(F.min("lo").alias("lo0"))
    across = across.join(start, ["h1", "h2"]).filter("id > id0 OR lo > lo0").select("id", "lo", "hi")
    spans = stored(again.unionByName(across).groupBy("id").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), f"{name}-spans")
    cleaned = stored(_only(texts, spans.select("id"), "left_semi").dropDuplicates(["id"]).join(spans, "id").mapInArrow(
        _remove, "id bigint, n_removed bigint, n_spans bigint, kept_sha256 string"), f"{name}-cleaned")
    rows = texts.select("id", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2("text", 256).alias("own"))
    whole = later.select("id", F.lit(True).alias("copy"))
    out = _only(_only(rows, whole, "left"), cleaned, "left")
    gone = F.coalesce("copy", F.lit(False)) & (F.col("n_bytes") >= WIDTH)
    return out.select(
        F.col("id").alias("doc_id"), "n_bytes", F.when(gone, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(gone, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(gone, F.lit(hashlib.sha256(b"").hexdigest())).otherwise(F.coalesce("kept_sha256", "own")).alias("kept_sha256"))
