"""Augmentation: up to two new spoken-style variants per training row.

Every attempt that chains draws a partner of its own from a directory of its class, in
which rows are addressed by their place. Candidates move through the shuffle as digests
only; rows then claim their first usable variants in turn (``claims``), and only the
texts they keep are built.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window as W, functions as F

from cuelake.functions import disfluency as D, keys as K, labels as L
from cuelake.functions.draws import draw_hash, pick_index, uniform
from cuelake.operators.claims import Claims, claim_in_turn
from cuelake.operators.ranks import positions
from cuelake.operators.skew import attach_per_key
from cuelake.session import written

ATTEMPTS = 12
PER_ROW = 2
BUCKET_ROWS = 4096


def with_partner(rows: DataFrame, id_col: str, seed: int, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Add ``partner``: another row's text of the same intent, NULL when it is the same text.

    Rows of an intent are dealt into hash buckets of about ``bucket_rows`` rows; within
    a bucket the partner is the next row in hash order, the last row taking the first.
    """
    # Any label space: every class found is dealt out, one without a label as well.
    keyed = rows.withColumn("_class", F.coalesce("intent", F.lit("\u0001")))
    sizes = keyed.groupBy("_class").agg(F.count(F.lit(1)).alias("n"), F.ceil(F.count(F.lit(1)) / bucket_rows).alias("_buckets"))
    h = draw_hash(seed, F.col(id_col), "partner")
    dealt = (attach_per_key(keyed, sizes, "_class", F.col(id_col)).withColumn("_h", h)
             .withColumn("_bucket", pick_index(uniform(F.col("_h"), 0), F.coalesce("_buckets", F.lit(1)))))
    ring = W.partitionBy("intent", "_bucket").orderBy("_h", id_col)
    whole = ring.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    nxt = F.coalesce(F.lead("text").over(ring), F.first("text").over(whole))
    return dealt.withColumn("partner", F.when(nxt != F.col("text"), nxt)).select(*rows.columns, "partner")


@dataclass
class Directory:
    """Rows of every class by place: (intent, place, text), and the classes' sizes (intent, n)."""

    rows: DataFrame
    sizes: DataFrame


def directory(rows: DataFrame, id_col: str, seed: int) -> Directory:
    """Places are ranks of a hash of the id, so they do not depend on how rows are dealt."""
    hashed = rows.select("intent", "text", F.col(id_col).alias("_id"), draw_hash(seed, F.col(id_col), "place").alias("_h"))
    placed = positions(hashed, "intent", ["_h", "_id"], "place").select("intent", "place", "text")
    return Directory(written(placed, "directory"), rows.groupBy("intent").agg(F.count(F.lit(1)).alias("n")))


def attempt_partners(tries: DataFrame, known: Directory, id_col: str, seed: int) -> DataFrame:
    """Add ``partner`` for column ``attempt``: the text at a drawn place of the row's class.

    Every attempt draws anew, over the whole class, the row itself included; NULL when
    the text drawn is the row's own. Looked up by (class, place), which no two rows of
    the directory share, so a class of any size is spread over all tasks.
    """
    sizes = known.sizes.withColumn("_size", F.col("n"))
    u = uniform(draw_hash(seed, F.col(id_col), F.col("attempt"), "partner"))
    drawn = attach_per_key(tries, sizes, "intent", F.col(id_col)).withColumn("_place", pick_index(u, F.col("_size")).cast("long"))
    there = known.rows.select(F.col("intent").alias("_class"), "place", F.col("text").alias("_text"))
    found = drawn.join(there, (F.col("intent") == F.col("_class")) & (F.col("_place") == F.col("place")), "left")
    return found.select(*tries.columns, F.when(F.col("_text") != F.col("text"), F.col("_text")).alias("partner"))


def _with_variants(tries: DataFrame, known: Directory, id_col: str, seed: int, chainable: list[str]) -> DataFrame:
    """Add ``variant`` to (id, attempt, text, intent, chains); NULL when a chain drew its own text."""
    h0, h1, h2, h3 = (draw_hash(seed, F.col(id_col), F.col("attempt"), i) for i in range(4))
    chained = F.coalesce(F.col("chains") & (uniform(h0, 0) < D.P_CHAIN), F.lit(False))
    marked = tries.withColumn("_chained", chained)
    hashes = {"_h1": h1, "_h2": h2, "_h3": h3}
    pairs = attempt_partners(marked.filter("_chained"), known, id_col, seed).withColumns(hashes).withColumn(
        "variant", D.chain(F.col("text"), F.col("partner"), F.col("intent"), F.col("_h1"), F.col("_h2"), chainable))
    singles = marked.filter("NOT _chained").withColumns(hashes).withColumn("variant", D.variant(F.col("text"), F.col("_h1"), F.col("_h2"), F.col("_h3")))
    columns = [*tries.columns, "variant"]
    return singles.select(*columns).unionByName(pairs.select(*columns))


@dataclass
class Augmented:
    rows: DataFrame  # id, attempt, text, intent
    rounds: int


def augment_in_turn(examples: DataFrame, holdout: DataFrame, id_col: str = "seq", seed: int = 0, per_row: int = PER_ROW,
                    attempts: int = ATTEMPTS, labels: list[str] | None = None, chainable: list[str] | None = None) -> Augmented:
    """Variants of examples (id, text, intent), as a loop over the rows by id would keep them.

    Each row takes its first ``per_row`` of ``attempts`` variants whose loose key is not
    empty, not its source's, not in the holdout and not taken by an earlier row or
    attempt. Only ``labels`` are augmented and only ``chainable`` ones chained; a class of
    one row is not chained. Ids are unique.
    """
    labels = L.REAL_INTENTS if labels is None else labels
    chainable = L.CHAINABLE if chainable is None else chainable
    base = examples.select(F.col(id_col).cast("long").alias(id_col), "text", "intent").filter(F.col("intent").isin(labels))
    # The source's own key is made once a row, not once an attempt.
    keyed = base.withColumn("_own", K.digest(K.key_loose(F.col("text"))))
    known = directory(base.filter(F.col("intent").isin(chainable)), id_col, seed)
    chains = known.sizes.withColumn("chains", F.col("n") > 1)
    rows = written(attach_per_key(keyed, chains, "intent", F.col(id_col)), "sources")
    tries = rows.withColumn("attempt", F.explode(F.sequence(F.lit(0), F.lit(attempts - 1))))
    loose = _with_variants(tries, known, id_col, seed, chainable).select(id_col, "attempt", "_own", K.key_loose(F.col("variant")).alias("_loose"))
    # Unusable attempts get a NULL key here and leave there: a filter on the key in this
    # place would be pushed down and build every variant a second time.
    key = F.when(F.col("_loose") != "", K.digest(F.col("_loose")))
    candidates = written(loose.select(id_col, "attempt", "_own", key.alias("key")), "candidates").filter("key <> _own").drop("_own")
    claims: Claims = claim_in_turn(candidates, holdout.select(K.digest(K.key_loose(F.col("text"))).alias("key")), id_col, per_row)
    chosen = rows.join(claims.kept.select(id_col, "attempt"), id_col)
    made = _with_variants(chosen, known, id_col, seed, chainable)
    return Augmented(made.select(id_col, "attempt", F.col("variant").alias("text"), "intent"), claims.rounds)


def augment(examples: DataFrame, holdout: DataFrame, id_col: str = "seq", seed: int = 0, per_row: int = PER_ROW,
            attempts: int = ATTEMPTS, labels: list[str] | None = None, chainable: list[str] | None = None) -> DataFrame:
    """The rows of ``augment_in_turn``."""
    return augment_in_turn(examples, holdout, id_col, seed, per_row, attempts, labels, chainable).rows


def counts_by_intent(augmented: DataFrame) -> DataFrame:
    dim = L.DEFAULT_LABELS.dim(augmented.sparkSession).filter("is_real").select("intent")
    n = augmented.groupBy("intent").agg(F.count(F.lit(1)).alias("n"))
    return dim.join(n, "intent", "left").select("intent", F.coalesce("n", F.lit(0)).cast("long").alias("n"))
