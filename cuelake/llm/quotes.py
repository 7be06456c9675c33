"""Chat formatting by quotation linking.

Messages are parsed into lines with a quote level (leading ``>`` marks, nested). Runs of
one level are passages; passages and their lines are normalised (case, white space) and
hashed. A message replies to the message that holds most of what it quotes at level one;
of several messages holding a passage the earliest is the original. Messages that quote
nothing known reply to the turn before. The result has the quotes taken out, and orders
each conversation by replies: (root_turn, depth, turn) puts every parent before its
answers, without gathering a conversation in one task.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from cuelake.llm.common import sha256_hex, stored

MARKS = re.compile(r"^(?:[ \t]*>)+ ?")
# Fixed value: the line mail programs put above a quotation.
WROTE = re.compile(r"^\s*On .{1,200} wrote:\s*$")
# Turns whose order one task decides at a time.
TURNS = 1000


def parse(text: str) -> tuple[str, list[tuple[int, str, int]]]:
    """(text without quotes, [(level, passage hash, length)]); level 0 is the message's own."""
    own, runs = [], []
    lines = text.split("\n")
    for k, line in enumerate(lines):
        m = MARKS.match(line)
        level = m.group().count(">") if m else 0
        body = line[m.end():] if m else line
        if level == 0:
            if WROTE.match(line) and k + 1 < len(lines) and MARKS.match(lines[k + 1]):
                continue
            own.append(line)
        if runs and runs[-1][0] == level:
            runs[-1][1].append(body)
        else:
            runs.append((level, [body]))
    found = {}
    for level, bodies in runs:
        for passage in {" ".join(bodies), *bodies}:
            norm = " ".join(passage.lower().split())
            if norm:
                key = int.from_bytes(hashlib.sha256(norm.encode()).digest()[:8], "big", signed=True)
                found[(level, key)] = len(norm)
    return "\n".join(own).strip("\n"), [(lv, key, n) for (lv, key), n in found.items()]


def _parsed(batches):
    kind = pa.list_(pa.struct([("level", pa.int32()), ("key", pa.int64()), ("chars", pa.int64())]))
    for batch in batches:
        texts, passages = [], []
        for t in batch.column("text").to_pylist():
            own, found = parse(t) if t else (t, [])
            texts.append(own)
            passages.append([{"level": lv, "key": k, "chars": n} for lv, k, n in found])
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("turn"), batch.column("role"), pa.array(texts, pa.string()),
                                          pa.array(passages, kind)], ["conv", "turn", "role", "text", "passages"])


def _turn_before(turns: DataFrame) -> DataFrame:
    """(conv, turn, before): the next smaller turn of the conversation, in bounded windows."""
    keyed = turns.withColumn("b", F.floor(F.col("turn") / TURNS))
    ends = keyed.groupBy("conv", "b").agg(F.max("turn").alias("last"))
    ends = ends.select("conv", "b", F.lag("last").over(W.partitionBy("conv").orderBy("b")).alias("carry"))
    inside = F.lag("turn").over(W.partitionBy("conv", "b").orderBy("turn"))
    return keyed.withColumn("inside", inside).join(ends, ["conv", "b"]).select("conv", "turn", F.coalesce("inside", "carry").alias("before"))


def link(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per input row: conv_id, turn, role, text, parent_turn, root_turn, depth, n_quoted, n_linked, message.

    ``text`` is without quotes, ``message`` has the role in front. ``n_quoted`` counts
    quoted passages and lines of any level, ``n_linked`` those found in an earlier turn.
    Null texts stay null and quote nothing; rows with a null conversation or turn stand
    alone; rows repeating a turn count as one message for links, each is returned; an
    empty table gives an empty result; further columns are ignored.
    """
    rows = messages.select(messages[conv_col].cast("bigint").alias("conv"), messages[turn_col].cast("bigint").alias("turn"),
                           messages[role_col].cast("string").alias("role"), messages[text_col].cast("string").alias("text"))
    rows = stored(rows.mapInArrow(_parsed, "conv bigint, turn bigint, role string, text string, passages array<struct<level:int,key:bigint,chars:bigint>>"), "messages")
    passages = rows.select("conv", "turn", F.explode("passages").alias("p")).select("conv", "turn", "p.*").filter("conv IS NOT NULL AND turn IS NOT NULL").distinct()
    origin = passages.filter("level = 0").groupBy("conv", "key").agg(F.min("turn").alias("origin"))
    quoted = passages.filter("level > 0").join(origin, ["conv", "key"], "left").withColumn("hit", F.col("origin") < F.col("turn"))
    per_turn = quoted.groupBy("conv", "turn").agg(F.count("*").alias("n_quoted"), F.sum(F.coalesce("hit", F.lit(False)).cast("bigint")).alias("n_linked"))
    votes = quoted.filter("hit AND level = 1").groupBy("conv", "turn", "origin").agg(F.sum("chars").alias("chars"))
    replies = votes.groupBy("conv", "turn").agg(F.max_by("origin", F.struct("chars", "origin")).alias("reply"))
    turns = rows.select("conv", "turn").filter("conv IS NOT NULL AND turn IS NOT NULL").distinct()
    tree = stored(_turn_before(turns).join(replies, ["conv", "turn"], "left").join(per_turn, ["conv", "turn"], "left").select(
        "conv", "turn", F.coalesce("reply", "before").alias("parent"), F.coalesce("n_quoted", F.lit(0)).alias("n_quoted"), F.coalesce("n_linked", F.lit(0)).alias("n_linked")), "replies")
    # Pointer jumping to the root: the number of rounds is the logarithm of the depth.
    at = stored(tree.select("conv", "turn", F.coalesce("parent", "turn").alias("up"), F.col("parent").isNotNull().cast("bigint").alias("depth")), "depth")
    done, turn = None, 0
    while True:  # only messages whose pointer isn't at a root yet take part
        upto = at if done is None else done.unionByName(at)
        above = upto.select("conv", F.col("turn").alias("up"), F.col("up").alias("top"), F.col("depth").alias("more"))
        new = stored(at.join(above, ["conv", "up"]).select("conv", "turn", F.col("top").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("more") > 0).alias("moved")), f"depth{turn}")
        arrived, at, turn = new.filter("NOT moved").drop("moved"), new.filter("moved").drop("moved"), turn + 1
        done = arrived if done is None else done.unionByName(arrived)
        if at.isEmpty():
            break
    known = tree.join(done, ["conv", "turn"])
    out = rows.join(known, ["conv", "turn"], "left")
    return out.select(
        F.col("conv").alias("conv_id"), "turn", "role", "text", F.col("parent").alias("parent_turn"), F.coalesce("up", "turn").alias("root_turn"),
        F.coalesce("depth", F.lit(0)).cast("bigint").alias("depth"), F.coalesce("n_quoted", F.lit(0)).cast("bigint").alias("n_quoted"),
        F.coalesce("n_linked", F.lit(0)).cast("bigint").alias("n_linked"),
        F.concat(F.lit("<|"), F.coalesce("role", F.lit("unknown")), F.lit("|>\n"), F.coalesce("text", F.lit("")), F.lit("\n")).alias("message"))


def digest(linked: DataFrame) -> DataFrame:
    return linked.select("conv_id", "turn", "role", "parent_turn", "root_turn", "depth", "n_quoted", "n_linked", sha256_hex(F.col("message")).alias("message_sha256"))
