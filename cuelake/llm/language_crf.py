"""Language identification by a linear-chain conditional random field over words.

Each word has affix, character n-gram and lexicon features (hashed); a matrix of
learned transitions ties neighbours together; forward-backward gives every word's
label distribution, also where a text switches languages. A document's language is the
label with the most expected words, its score that share.

Training takes a bounded, documented sample of labelled documents (``per_label``, by
hash order). Shards train in parallel on sequences spliced from pieces of documents in
different languages, and their weights are averaged between rounds. Prediction reads
every whole text, in Arrow batches; long texts are cut into blocks whose transfer
matrices are multiplied first, so the result is exact without a loop over every word.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from cuelake.llm.common import stored

# Letters only; what has none is undetermined.
LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
BUCKETS = 1 << 17
PER_LABEL = 150
MAX_LABELS = 200
LEXICON = 3000
SHARDS = 6
ROUNDS = 4
SEQUENCE = 120
BATCH = 32
RATE = 0.3
BLOCK = 64
# Words handled at once in a task; a longer text is handled alone.
CHUNK_BYTES = 4_000_000


@dataclass
class Model:
    labels: list[str]
    emit: np.ndarray  # BUCKETS x labels
    move: np.ndarray  # labels x labels, log scale
    lexicon: np.ndarray  # sorted word hashes


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xFF51AFD7ED558CCD)
    return ((x ^ (x >> np.uint64(33))) % np.uint64(BUCKETS)).astype(np.int64)


def features(words: list[str], lexicon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(feature, word position) pairs: affixes, n-grams with word ends, and the lexicon."""
    cp = np.frombuffer("".join(f"\x02{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    lens = np.array([len(w) for w in words], np.int64) + 2
    starts = np.cumsum(lens) - lens
    owner = np.repeat(np.arange(len(words)), lens)
    found, owners = [], []

    def add(keys, own, salt):
        found.append(_mixed(keys, salt))
        owners.append(own)

    for n in (2, 3, 4):
        keys = np.zeros(max(0, len(cp) - n + 1), np.uint64)
        for j in range(n):
            keys = keys * np.uint64(1000003) + cp[j:len(cp) - n + 1 + j]
        inside = owner[:len(keys)] == owner[n - 1:]
        add(keys[inside], owner[:len(keys)][inside], n)
    for n in (1, 2, 3):
        long = np.nonzero(lens - 2 > n)[0]
        for salt, first in ((10 + n, starts[long] + 1), (20 + n, starts[long] + lens[long] - 1 - n)):
            keys = np.zeros(len(long), np.uint64)
            for j in range(n):
                keys = keys * np.uint64(1000003) + cp[first + j]
            add(keys, long, salt)
    whole = word_hashes(words)
    if len(lexicon):
        at = np.minimum(np.searchsorted(lexicon, whole), len(lexicon) - 1)
        known = np.nonzero(lexicon[at] == whole)[0]
        add(whole[known], known, 31)
    return np.concatenate(found), np.concatenate(owners)


def word_hashes(words: list[str]) -> np.ndarray:
    from pandas.util import hash_array  # in tasks only; the driver does without

    return hash_array(np.array(words, dtype=object), categorize=False)


def emissions(model: Model, words: list[str]) -> np.ndarray:
    """Scores of each word under each label; words have about the same weight each."""
    feature, owner = features(words, model.lexicon)
    out = np.stack([np.bincount(owner, weights=model.emit[feature, k], minlength=len(words))
                    for k in range(len(model.labels))], 1)
    return out / np.sqrt(np.maximum(1, np.bincount(owner, minlength=len(words))))[:, None]


# -- forward-backward ----------------------------------------------------------

def marginals(scores: np.ndarray, lens: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Label distribution of every word of several texts laid end to end.

    Texts are cut into blocks. The blocks' transfer matrices are multiplied side by
    side, carried along each text, and then resolved within all blocks at once.
    """
    n_labels = scores.shape[1]
    e = np.exp(scores - scores.max(1, keepdims=True))
    step = np.exp(move - move.max())
    blocks = -(-lens // BLOCK)
    first = np.cumsum(blocks) - blocks
    n = int(blocks.sum())
    text = np.repeat(np.arange(len(lens)), blocks)
    index = np.arange(n) - first[text]
    start = (np.cumsum(lens) - lens)[text] + index * BLOCK
    size = np.minimum(BLOCK, lens[text] - index * BLOCK)
    pos = start[:, None] + np.arange(BLOCK)
    real = np.arange(BLOCK) < size[:, None]
    grid = np.where(real[..., None], e[np.minimum(pos, len(e) - 1)], 1.0)

    def normal(x, axes):
        return x / np.maximum(x.sum(axis=axes, keepdims=True), 1e-300)

    whole = np.broadcast_to(np.eye(n_labels), (n, n_labels, n_labels)).copy()
    for t in range(BLOCK):
        on = real[:, t]
        whole[on] = normal((whole[on] @ step) * grid[on, t][:, None, :], (1, 2))
    enter, leave = np.full((n, n_labels), 1.0 / n_labels), np.full((n, n_labels), 1.0)
    for k in range(1, int(blocks.max()) if n else 0):
        at = first[blocks > k] + k
        enter[at] = normal(np.einsum("bi,bij->bj", enter[at - 1], whole[at - 1]), (1,))
        back = first[blocks > k] + blocks[blocks > k] - 1 - k
        leave[back] = normal(np.einsum("bij,bj->bi", whole[back + 1], leave[back + 1]), (1,))
    ahead = np.empty((n, BLOCK, n_labels))
    a = enter
    for t in range(BLOCK):
        a = normal((a @ step) * grid[:, t], (1,))
        ahead[:, t] = a
    b = leave
    for t in range(BLOCK - 1, -1, -1):
        ahead[:, t] *= b
        b = np.where(real[:, t][:, None], normal((b * grid[:, t]) @ step.T, (1,)), b)
    return normal(ahead[real], (1,))


def _pairs(scores: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word and neighbour expectations of a batch of equally long sequences."""
    n_seq, length, n_labels = scores.shape
    e, step = np.exp(scores - scores.max(2, keepdims=True)), np.exp(move - move.max())
    alpha, beta = np.empty_like(e), np.ones_like(e)
    a = np.full((n_seq, n_labels), 1.0 / n_labels)
    for t in range(length):
        a = (a @ step) * e[:, t]
        a /= a.sum(1, keepdims=True)
        alpha[:, t] = a
    for t in range(length - 1, 0, -1):
        b = (beta[:, t] * e[:, t]) @ step.T
        beta[:, t - 1] = b / b.sum(1, keepdims=True)
    gamma = alpha * beta
    gamma /= gamma.sum(2, keepdims=True)
    xi = alpha[:, :-1, :, None] * step * (e * beta)[:, 1:, None, :]
    xi /= xi.sum((2, 3), keepdims=True)
    return gamma, xi.sum((0, 1))


# -- training --------------------------------------------------------------------

def _spliced(docs: list[tuple[int, list[str]]], rng) -> tuple[list[list[str]], list[np.ndarray]]:
    """Sequences of SEQUENCE words, cut from documents and mixed between languages."""
    parts = []
    for label, found in docs:
        at = 0
        while at < len(found):
            take = int(rng.integers(4, 60))
            parts.append((label, found[at:at + take]))
            at += take
    rng.shuffle(parts)
    words = [w for _, part in parts for w in part]
    labels = np.array([k for k, part in parts for _ in part])
    n = len(words) // SEQUENCE
    return [words[i * SEQUENCE:(i + 1) * SEQUENCE] for i in range(n)], list(labels[:n * SEQUENCE].reshape(n, SEQUENCE))


def _train_shard(model: Model, docs: list[tuple[int, list[str]]], seed: int) -> tuple[np.ndarray, np.ndarray, int]:
    from pandas import factorize

    rng = np.random.default_rng(seed)
    texts, labels = _spliced(docs, rng)
    n_labels = len(model.labels)
    emit, move = model.emit.copy(), model.move.copy()
    g_emit, g_move = np.full(emit.shape, 1e-2), np.full(move.shape, 1.0)
    for at in range(0, len(texts), BATCH):
        batch, gold = texts[at:at + BATCH], np.stack(labels[at:at + BATCH])
        codes, names = factorize(np.array([w for t in batch for w in t], dtype=object))
        feature, owner = features(list(names), model.lexicon)
        scale = 1 / np.sqrt(np.maximum(1, np.bincount(owner, minlength=len(names))))
        score = np.stack([np.bincount(owner, weights=emit[feature, k], minlength=len(names)) for k in range(n_labels)], 1) * scale[:, None]
        gamma, xi = _pairs(score[codes].reshape(*gold.shape, n_labels), move)
        off = (np.eye(n_labels)[gold] - gamma).reshape(-1, n_labels)
        per_word = np.stack([np.bincount(codes, weights=off[:, k], minlength=len(names)) for k in range(n_labels)], 1) * scale[:, None]
        used, inverse = np.unique(feature, return_inverse=True)
        grad = np.stack([np.bincount(inverse, weights=per_word[owner, k]) for k in range(n_labels)], 1) / len(batch)
        g_emit[used] += grad ** 2
        emit[used] += RATE * grad / np.sqrt(g_emit[used])
        want = np.zeros_like(move)
        np.add.at(want, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1.0)
        grad = (want - xi) / len(batch)
        g_move += grad ** 2
        move += RATE * grad / np.sqrt(g_move)
    return emit.astype(np.float32), move, len(texts)


def _shard_fit(held, turn: int):
    def fit(pdf):
        import pandas as pd

        pdf = pdf.sort_values(["label", "text"])
        docs = [(int(k), LETTERS.findall(t.lower())) for k, t in zip(pdf["label"], pdf["text"])]
        shard = int(pdf["shard"].iloc[0])
        emit, move, n = _train_shard(held.value, docs, 1000 * turn + shard)
        return pd.DataFrame({"shard": [shard], "n": [n], "emit": [emit.tobytes()], "move": [move.tobytes()]})
    return fit


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "lang", per_label: int = PER_LABEL,
          shards: int = SHARDS, rounds: int = ROUNDS) -> Model | None:
    """Fit on at most ``per_label`` documents of each label, chosen by hash of the id.

    Whole documents are used. None when nothing is labelled; more than MAX_LABELS labels
    are refused, none is left out.
    """
    spark = labelled.sparkSession
    rows = labelled.select(labelled[id_col].alias("id"), labelled[label_col].cast("string").alias("label"),
                           labelled[text_col].cast("string").alias("text")).filter("id IS NOT NULL AND label IS NOT NULL AND text IS NOT NULL")
    # All labels are learned: their weights are one table on the driver, so not too many.
    labels = sorted(r["label"] for r in rows.select("label").distinct().limit(MAX_LABELS + 1).collect())
    if len(labels) > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels: the weights would not fit one driver")
    if not labels:
        return None
    # Ids are picked first, so that only the sample's texts move.
    picked = None
    for k, label in enumerate(labels):
        part = (rows.filter(F.col("label") == label).select("id").orderBy(F.xxhash64("id"), "id").limit(per_label)
                .select("id", F.lit(k).alias("k")))
        picked = part if picked is None else picked.unionByName(part)
    picked = stored(picked, "lid-ids").dropDuplicates(["id"])
    sample = rows.join(F.broadcast(picked), "id").dropDuplicates(["id"])  # at most per_label ids a label
    sample = stored(sample.select(F.col("k").alias("label"), "text", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int").alias("shard")), "lid-sample")
    words = sample.select("label", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}]+"), F.lit(0))).alias("w"))
    known = words.groupBy("w").agg(F.count("*").alias("n")).filter("n > 2").orderBy(F.desc("n"), "w").limit(LEXICON).collect()
    lexicon = np.sort(word_hashes([r["w"] for r in known])) if known else np.zeros(0, np.uint64)
    model = Model(labels, np.zeros((BUCKETS, len(labels)), np.float32), np.zeros((len(labels), len(labels))), lexicon)
    for turn in range(rounds):
        held = spark.sparkContext.broadcast(model)  # BUCKETS x labels floats: a bounded size
        got = sample.groupBy("shard").applyInPandas(_shard_fit(held, turn), "shard int, n long, emit binary, move binary").collect()
        got = sorted((r for r in got if r["n"]), key=lambda r: r["shard"])
        total = sum(r["n"] for r in got)
        if not total:
            break
        emit = sum(np.frombuffer(r["emit"], np.float32).reshape(model.emit.shape) * (r["n"] / total) for r in got)
        move = sum(np.frombuffer(r["move"], np.float64).reshape(model.move.shape) * (r["n"] / total) for r in got)
        model = Model(labels, emit.astype(np.float32), move, lexicon)
        held.unpersist()
    return model


# -- prediction --------------------------------------------------------------------

def label_texts(model: Model, texts: list[str | None]) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
    """Words of each text, all label distributions end to end, and words per text."""
    from pandas import factorize

    found = [LETTERS.findall(t.lower()) if t else [] for t in texts]
    lens = np.array([len(f) for f in found], np.int64)
    flat = [w for f in found for w in f]
    if not flat:
        return found, np.zeros((0, len(model.labels))), lens
    codes, names = factorize(np.array(flat, dtype=object))
    scores = emissions(model, list(names))[codes]
    some = lens > 0
    return found, marginals(scores, lens[some], model.move), lens


def _ranges(column: pa.Array):
    start, total = 0, 0
    for k, t in enumerate(column.cast(pa.large_binary())):
        size = len(t.as_buffer()) if t.is_valid else 0
        if k > start and total + size > CHUNK_BYTES:
            yield start, k
            start, total = k, 0
        total += size
    if start < len(column):
        yield start, len(column)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score, n_words, n_switches.

    Null texts, texts without a letter, and everything when nothing could be learned,
    are ``und`` with score 0. Repeated rows are predicted alike; further columns are
    ignored. ``n_switches`` counts neighbours with different labels.
    """
    rows = docs.select(docs[id_col].cast("bigint").alias("doc_id"), docs[text_col].cast("string").alias("text"))
    if model is None:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"),
                           F.lit(0).cast("bigint").alias("n_words"), F.lit(0).cast("bigint").alias("n_switches"))
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = held.value
        names = np.array([*m.labels, UNKNOWN], dtype=object)
        for batch in batches:
            for start, stop in _ranges(batch.column("text")):
                part = batch.slice(start, stop - start)
                _, gamma, lens = label_texts(m, part.column("text").to_pylist())
                owner = np.repeat(np.arange(len(lens)), lens)
                share = np.stack([np.bincount(owner, weights=gamma[:, k], minlength=len(lens)) for k in range(len(m.labels))], 1)
                share = share / np.maximum(1, lens)[:, None]
                best, hard = share.argmax(1), gamma.argmax(1)
                turns = np.bincount(owner[1:][(hard[1:] != hard[:-1]) & (owner[1:] == owner[:-1])], minlength=len(lens))
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(names[np.where(lens > 0, best, len(m.labels))], pa.string()),
                    pa.array(np.where(lens > 0, np.clip(share.max(1), 0, 1), 0.0)), pa.array(lens), pa.array(turns.astype(np.int64))],
                    ["doc_id", "lang_pred", "score", "n_words", "n_switches"])

    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double, n_words bigint, n_switches bigint")


def held_out(spark_docs: DataFrame, id_col: str = "doc_id"):
    """The fold that is never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.pmod(F.crc32(spark_docs[id_col].cast("string")), F.lit(3)) == 1, F.lit(False))
