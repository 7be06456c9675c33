"""Spelling variants of a corpus's words by a bit-sliced position index.

1. Runs of letters are counted over all texts, after a keyed few lose one letter.
2. Two words one edit apart agree on the first or the second half of the longer one, so
   words meet in blocks of (longer length, half, its letters): four blocks a word, and
   every near pair in exactly one (a pair that agrees on both halves counts in the
   first).
3. A block's words, most frequent first, are the bits of its index: one bitset per
   (position, letter) and per length. A word runs through it letter by letter and keeps
   four sets, each updated for all words at once: no error so far, and one error by
   replacement, insertion or deletion, the last two reading the index one position on or
   back. What is left at the end is counted, and its lowest bit is the most frequent
   near word, so no pair is ever a row.
4. Blocks of more than BLOCK words are indexed in slices, and every word of the block
   runs through all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cuelake.llm.common import stored, text_of

# What counts as a run, and the letters that change case.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK = 4096
MIN_LENGTH, MIN_COUNT, RATIO, NOISE = 6, 5, 5, 199


class PositionIndex:
    """Bitsets over words by (position, letter) and by length; bit k is the k-th word."""

    def __init__(self, words: list[str]):
        self.words = words
        longest = max(map(len, words))
        self.at = [{} for _ in range(longest + 1)]
        self.of_length = {}
        for k, word in enumerate(words):
            bit = 1 << k
            self.of_length[len(word)] = self.of_length.get(len(word), 0) | bit
            for row, letter in zip(self.at, word):
                row[letter] = row.get(letter, 0) | bit

    def letter(self, position: int, letter: str) -> int:
        return self.at[position].get(letter, 0) if 0 <= position < len(self.at) else 0

    def near(self, word: str, longer: int, agreeing: int = 0) -> int:
        """Words one edit from ``word`` where the longer of the two has ``longer`` letters.

        With ``agreeing``, words that share so many first letters are left out.
        """
        exact = (1 << len(self.words)) - 1
        replaced = deleted = left_out = 0
        inserted = exact
        for i, letter in enumerate(word):
            here = self.letter(i, letter)
            replaced = (replaced & here) | (exact & ~here)
            deleted = (deleted & self.letter(i - 1, letter)) | exact
            exact &= here
            inserted = (inserted & self.letter(i + 1, letter)) | exact
            if i + 1 == agreeing:
                left_out = exact
        n, size = len(word), self.of_length.get
        found = replaced & size(n, 0) if n == longer else 0
        found |= inserted & size(n + 1, 0) if n + 1 == longer else deleted & size(n - 1, 0)
        return found & ~left_out


def counted_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
                  min_count: int = MIN_COUNT, noise: int | None = NOISE) -> DataFrame:
    """word and n: every run of letters of the corpus that is long and frequent enough.

    ``noise`` makes the runs whose keyed checksum it divides lose one letter.
    """
    runs = docs.select(F.coalesce(docs[id_col].cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.translate(text_of(docs[text_col]), UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    word = F.col("run")
    if noise:
        h = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
        at = F.pmod(h, F.length("run")).cast("int")
        shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        word = F.when(h % noise == 0, shorter).otherwise(word)
    long = runs.select(word.alias("word")).filter(F.length("word") >= min_length)
    return long.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count)


def _blocks(words: DataFrame) -> DataFrame:
    """Each word once per block it meets others in: the longer word's length, which half, its letters.

    A pair differs in the second half of the longer word, and then agrees on the first
    ``longer / 2`` letters, or in the first half, and then on the last
    ``longer - longer / 2``.
    """
    longer = words.select("*", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("longer"))
    first = F.floor(F.col("longer") / 2).cast("int")
    halves = F.array(F.struct(F.lit(False).alias("second"), F.substring("word", F.lit(1), first).alias("half")),
                     F.struct(F.lit(True).alias("second"), F.right("word", F.col("longer") - first).alias("half")))
    return longer.select("word", "n", "longer", F.inline(halves))


def _dealt(blocks: DataFrame, block: int) -> DataFrame:
    """Blocks of one word dropped, larger ones cut in slices; ``indexed`` rows are a slice's words.

    Every word of a block meets all of its slices.
    """
    key = ["longer", "second", "half"]
    sizes = blocks.groupBy(*key).agg(F.count("*").alias("size")).filter("size > 1")
    known = blocks.join(sizes, key)
    slices = F.ceil(F.col("size") / block).cast("int")
    own = F.pmod(F.xxhash64("word"), slices).cast("int")
    return known.select("*", own.alias("own"), F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice")).select(
        "word", "n", *key, "slice", (F.col("own") == F.col("slice")).alias("indexed"))


def _run_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per row that has any: its number of near words in the slice and the most frequent one.

    Rows come sorted by slice, its own words before the visitors.
    """
    key, mine, index = None, [], None

    def found(row: tuple) -> tuple | None:
        longer, second = row[0], row[1]
        near = index.near(row[4], longer, longer // 2 if second else 0)
        if not near:
            return None
        best = (near & -near).bit_length() - 1
        return row[4], near.bit_count(), mine[best][4], mine[best][5]

    def built(done: list) -> None:
        nonlocal index
        index = PositionIndex([row[4] for row in mine])
        done += map(found, mine)

    def out(done: list) -> pa.RecordBatch:
        columns = list(zip(*(row for row in done if row))) or [()] * 4
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["word", "n_near", "best", "best_n"])

    for batch in batches:
        done = []
        rows = zip(*(batch.column(c).to_pylist() for c in ("longer", "second", "half", "slice", "word", "n", "indexed")))
        for row in rows:
            if row[:4] != key:
                if mine and index is None:
                    built(done)
                key, mine, index = row[:4], [], None
            if row[6]:
                mine.append(row)
                continue
            if index is None and mine:
                built(done)
            if index is not None:
                done.append(found(row))
        yield out(done)
    done = []
    if mine and index is None:
        built(done)
    yield out(done)


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, n_near, best and best_n of every word with a near word."""
    dealt = _dealt(_blocks(words), block).repartition("longer", "second", "half", "slice").sortWithinPartitions(
        "longer", "second", "half", "slice", F.desc("indexed"), F.desc("n"), "word")
    parts = dealt.mapInArrow(_run_blocks, "word string, n_near bigint, best string, best_n bigint")
    first = F.min(F.struct((-F.col("best_n")).alias("minus"), "best"))
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), first.alias("top")).select(
        "word", "n_near", F.col("top.best").alias("best"), (-F.col("top.minus")).alias("best_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """word and root of every word with a form, by pointer doubling over forms that have forms."""
    steps = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(steps.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if moved.filter("moved").isEmpty():
            return moved.drop("moved")
        steps = moved.drop("moved")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH,
             min_count: int = MIN_COUNT, ratio: int = RATIO, noise: int | None = NOISE, block: int = BLOCK) -> DataFrame:
    """One row per word: word, n, n_near, form, form_n, root.

    ``form`` is the near word of largest n (ties: smallest in code-point order) if it is
    ``ratio`` times as frequent, and ``root`` the end of the chain of forms, or the word.
    Null and empty texts have no words, repeated rows count again, null ids key the
    noise by an empty id, texts of any length are read whole, an empty table gives an
    empty result, further columns are ignored. ``min_length`` is 3 at least, so that
    neither half of a word is empty.
    """
    if min_length < 3:
        raise ValueError("min_length below 3")
    if ratio < 2:
        raise ValueError("ratio below 2: forms could go round in a circle")
    words = stored(counted_words(docs, id_col, text_col, min_length, min_count, noise), "words")
    near = near_words(words, block)
    formed = F.col("best_n") >= ratio * F.col("n")
    known = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best")).alias("form"),
        F.when(formed, F.col("best_n")).alias("form_n")), "forms")
    return known.join(_roots(known.filter("form IS NOT NULL")), "word", "left").withColumn("root", F.coalesce("root", "word"))
