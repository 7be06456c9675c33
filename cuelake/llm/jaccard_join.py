"""N-gram Jaccard join by filters under several global token orders.

A document is its set of distinct word n-grams, as 64-bit keys. Two sets as similar as
asked share a key among the first ``n - overlap + 1`` keys of each under *any* global
order of the keys, and ``l`` keys among the first ``n - overlap + l``. Four orders are
used: ascending key (as good as random), ascending document frequency within that
prefix (rare keys first), ascending frequency within whole sets, and descending key.

1. Prefixes under the first order are counted by key. The second order drops each
   prefix's ``l - 1`` most frequent keys, so words that everybody uses join nothing.
2. Candidates meet in the remaining keys. Instead of all pairs of a key, documents first
   meet the key's most central one; what that links is one component, and only pairs of
   different components are compared afterwards. A large group of near copies therefore
   costs about one comparison per member.
3. Documents still sharing a key across components are paired if the key has at most
   ``FEW`` of them. Those of all other keys are ordered once more, by the frequency of
   the keys of their whole sets among them (see ``_rare_first``); documents that meet in
   those prefixes are paired again where few meet, and else decided group by group, in
   chunks that give back connecting links only.
4. A pair must pass the filter of the ascending order (its prefixes share at least ``l``
   keys) and of the descending order before its whole sets are intersected. Every pair not yet connected is decided exactly.

Equal sets are collapsed before anything is joined. Whole texts are tokenised twice (for
prefixes, and for the sets of documents in some candidate); sets of other documents
never move.

Links are counted afterwards, on demand (``count_links``): every link lies within one
component, so each component is dealt out in chunks, a task holds two chunks and decides
all their pairs exactly, and only a number per document leaves it. That is a comparison
per pair of different sets of a component, but rows only by the number of its chunks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, Window as W

from cuelake.llm.common import let, stored, text_of, words
from cuelake.llm.components import components
from cuelake.llm.row_ids import ranked_rows

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Keys more than one prefix needs; the most frequent of them may then be dropped.
SPARE = 32
CENTER_ROUNDS = 2
# Documents of one key that are paired directly; those of more frequent keys are ordered once more.
FEW = 32
# Ids that may be broadcast (8 bytes each).
SMALL_IDS = 1_000_000
# Documents and keys of a component that a chunk holds, about; and columns of a product.
CHUNK_DOCS, CHUNK_KEYS = 256, 1_000_000
COLUMNS = 2048


def shingle_keys(text: Column, n: int) -> Column:
    """Sorted distinct keys of a text's word n-grams, A-Z lower-cased.

    A text of fewer than ``n`` words has its whole sequence as one; no words, none.
    """
    def of(h: Column) -> Column:
        keys = h
        for j in range(1, n):
            m = F.size(h) - j
            keys = F.zip_with(F.slice(keys, 1, m), F.slice(h, 1 + j, m), lambda a, b: F.xxhash64(a, b))
        whole = F.aggregate(h, F.lit(0).cast("bigint"), lambda a, x: F.xxhash64(a, x, F.lit("short")))
        return (F.when(F.size(h) >= n, F.sort_array(F.array_distinct(keys)))
                .when(F.size(h) > 0, F.array(whole)).otherwise(F.array().cast("array<bigint>")))

    lowered = F.translate(text_of(text), UPPER, LOWER)
    return let(F.transform(words(lowered), lambda w: F.xxhash64(w)), of)


def _overlap(n: Column, pct: int) -> Column:
    """Keys that a set of ``n`` shares at least with any partner."""
    return F.ceil(n * F.lit(pct) / F.lit(100)).cast("int")


def _only(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose id is listed. A short list (counted, at most SMALL_IDS longs) is sent to
    the rows; otherwise both sides are shuffled."""
    ids = ids.select("id").distinct()
    return rows.join(F.broadcast(ids) if ids.count() <= SMALL_IDS else ids, "id", "left_semi")


def _both_ends(pairs: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """Pairs (a, b) with the column of either end as x and y."""
    return (pairs.join(rows.select(F.col("id").alias("a"), F.col(column).alias("x")), "a")
            .join(rows.select(F.col("id").alias("b"), F.col(column).alias("y")), "b"))


def _verified(pairs: DataFrame, heads: DataFrame, sets: DataFrame, pct: int, name: str) -> DataFrame:
    """Links (a, b) among candidate pairs.

    The ascending order's filter needs only the prefixes: they share at least SPARE keys
    (all a short set must share). What passes has its whole sets fetched for the
    descending order's filter and the intersection.
    """
    spare = F.least(F.lit(SPARE), F.least(F.col("x.o"), F.col("y.o")))
    passed = stored(_both_ends(pairs, heads, "head").filter(
        F.size(F.array_intersect("x.prefix", "y.prefix")) >= spare).select("a", "b"), f"{name}-passed")
    some = _only(sets, passed.select(F.explode(F.array("a", "b")).alias("id")))

    def tail(k: str) -> Column:
        n = F.size(k)
        return F.slice(k, _overlap(n, pct), n - _overlap(n, pct) + 1)

    both = _both_ends(passed, some, "keys").filter(F.arrays_overlap(tail("x"), tail("y")))
    union = F.size("x") + F.size("y") - F.col("shared")
    return (both.withColumn("shared", F.size(F.array_intersect("x", "y")))
            .filter(F.col("shared") * 100 >= union * pct).select("a", "b"))


def _size_fits(a: Column, b: Column, pct: int) -> Column:
    return (F.least(a, b) * 100 >= F.greatest(a, b) * pct)


def _rare_first(left: DataFrame, sets: DataFrame, pct: int, name: str) -> tuple[DataFrame, DataFrame]:
    """What the documents ``left`` leave to be told apart, where they share a prefix key
    under the order of ascending frequency of their whole sets: pairs (a, b) to verify,
    and links (a, b) already decided.

    Keys of one document take the first places of its order and join nothing, so only
    their number matters. A pair needs ``o`` common keys by its two sizes, so its first
    common one is within the first ``n - o + 1`` places of both. Places are counted from
    the last. Documents of a key with at most FEW of them are paired; the others fall
    into groups connected by such keys, and groups are decided without listing pairs
    (``_group_links``).
    """
    rows = _only(sets, left).select("id", F.explode("keys").alias("key"))
    often = rows.groupBy("key").agg(F.count("*").alias("df")).filter("df > 1")
    shared = rows.join(often, "key").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "key"))).alias("keys"))
    first = shared.join(left, "id").withColumn("alone", F.col("n") - F.size("keys"))
    room = F.greatest(F.lit(0), F.col("n") - _overlap(F.col("n"), pct) + 1 - F.col("alone"))
    placed = first.select("id", "n", "comp", "alone", F.posexplode(F.slice("keys", 1, room)).alias("i", "k")).select(
        "id", "n", "comp", F.col("k.key").alias("key"), (F.col("alone") + F.col("i") + 1).alias("place"))
    placed = stored(placed, f"{name}-placed")
    mixed = stored(placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("docs"),
                                             F.min("id").alias("first")).filter("lo <> hi").drop("lo", "hi"), f"{name}-mixed")
    hubs = placed.join(mixed.filter(F.col("docs") > FEW), "key").select("id", "first", "comp")
    links = _group_links(hubs, left, sets, pct, name)
    few = placed.join(mixed.filter(F.col("docs") <= FEW).select("key"), "key")
    # The smaller set's place is bounded by its own size alone, so fewer rows are met than look.
    half = F.ceil(F.col("n") * F.lit(2 * pct) / F.lit(100 + pct))
    other = few.filter(F.col("place") <= F.col("n") - half + 1).select(
        "key", F.col("id").alias("id2"), F.col("n").alias("n2"), F.col("comp").alias("comp2"), F.col("place").alias("place2"))
    need = F.ceil((F.col("n") + F.col("n2")) * F.lit(pct) / F.lit(100 + pct))
    smaller = (F.col("n2") < F.col("n")) | ((F.col("n2") == F.col("n")) & (F.col("id2") < F.col("id")))
    met = few.join(other, "key").filter(smaller & (F.col("comp") != F.col("comp2")) & _size_fits(F.col("n"), F.col("n2"), pct)
                                        & (F.col("place") <= F.col("n") - need + 1) & (F.col("place2") <= F.col("n2") - need + 1))
    return met.select(F.least("id", "id2").alias("a"), F.greatest("id", "id2").alias("b")), links


def _group_links(hubs: DataFrame, left: DataFrame, sets: DataFrame, pct: int, name: str) -> DataFrame:
    """Links (a, b) that join all documents of a group that links join.

    ``hubs`` has a document with the first one of a key. A group is dealt out in chunks; a
    task holds two of them, decides all their pairs exactly, and gives back no more
    links than connect them: rows grow with the chunks of a group, not with its pairs.
    """
    edges = hubs.select(F.col("id").alias("a"), F.col("first").alias("b")).distinct()
    groups = components(edges, f"{name}-groups").withColumnRenamed("comp", "grp")
    members = stored(left.join(groups, "id"), f"{name}-members")
    width = members.groupBy("grp").agg(F.greatest(F.ceil(F.count("*") / CHUNK_DOCS), F.ceil(F.sum("n") / CHUNK_KEYS)).cast("int").alias("parts"))
    dealt = stored(members.join(width, "grp").withColumn("side", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")), f"{name}-dealt")
    rows = (_only(sets, dealt).join(dealt, "id").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("grp", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", "id", "comp", "keys"))
    key = ["grp", "i", "j"]
    return rows.repartition(*key).sortWithinPartitions(*key).mapInArrow(_per_chunk_pair("grp", _connect(pct)), "a bigint, b bigint")


def _connect(pct: int):
    """Links between different components of two chunks, no more than connect what links."""
    def of(t: pa.Table) -> pa.RecordBatch:
        side, i, j, ids, comp = (t.column(c).to_numpy() for c in ("side", "i", "j", "id", "comp"))
        keys = t.column("keys").combine_chunks()
        lens, flat = keys.value_lengths().to_numpy().astype(np.int64), keys.flatten().to_numpy()
        a, b, link = _links_of(flat, lens, side == i, bool(i[0] == j[0]), pct)
        x, y = np.nonzero(link & (comp[a][:, None] != comp[b][None, :]))
        up = {}

        def root(c: int) -> int:
            while c in up:
                c = up[c]
            return c

        found = []
        for p, q in zip(a[x].tolist(), b[y].tolist()):
            c, d = root(int(comp[p])), root(int(comp[q]))
            if c != d:
                up[max(c, d)] = min(c, d)
                found.append((int(ids[p]), int(ids[q])))
        lo, hi = ([f(e) for e in found] for f in (min, max))
        return pa.RecordBatch.from_arrays([pa.array(lo, pa.int64()), pa.array(hi, pa.int64())], ["a", "b"])
    return of


def _links_of(keys: np.ndarray, lens: np.ndarray, left: np.ndarray, within: bool, pct: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which of the left sets (a) link with which of the others (b), or (``within``) which
    of all with which of all: a, b, link. ``keys`` holds the sets end to end."""
    m = len(lens)
    a = np.arange(m) if within else np.nonzero(left)[0]
    b = a if within else np.nonzero(~left)[0]
    if len(a) * len(b) <= 16:
        ends = np.cumsum(lens)
        sets = [keys[e - n:e] for e, n in zip(ends, lens)]
        shared = np.array([[len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for y in b] for x in a]).reshape(len(a), len(b))
    else:
        order = np.argsort(keys, kind="stable")
        new = np.diff(keys[order], prepend=keys[order[0]] - 1) != 0
        code, df = np.cumsum(new) - 1, np.diff(np.append(np.nonzero(new)[0], len(keys)))
        # Keys of one set are shared with none.
        often = df > 1
        on = often[code]
        owner, code = np.repeat(np.arange(m), lens)[order][on], (np.cumsum(often) - 1)[code[on]]
        shared = np.zeros((len(a), len(b)))
        for at in range(0, int(often.sum()), COLUMNS):
            lo, hi = np.searchsorted(code, [at, at + COLUMNS])
            has = np.zeros((m, COLUMNS), np.float32)
            has[owner[lo:hi], code[lo:hi] - at] = 1
            shared += has[a] @ has[b].T
    shared = shared.astype(np.int64)
    link = shared * 100 >= (lens[a][:, None] + lens[b][None, :] - shared) * pct
    if within:
        np.fill_diagonal(link, False)
    return a, b, link


def _linked_rows(keys: np.ndarray, lens: np.ndarray, left: np.ndarray, rows: np.ndarray, within: bool, pct: int) -> np.ndarray:
    """Rows that each set links with, among the same pairs."""
    a, b, link = _links_of(keys, lens, left, within, pct)
    out = np.zeros(len(lens), np.int64)
    out[a] = link @ rows[b]
    if not within:
        out[b] = rows[a] @ link
    return out


def _count_links(pct: int):
    """Links of each set with those of the same two chunks."""
    def of(t: pa.Table) -> pa.RecordBatch:
        side, i, j, rows = (t.column(c).to_numpy() for c in ("side", "i", "j", "rows"))
        keys = t.column("keys").combine_chunks()
        lens, flat = keys.value_lengths().to_numpy().astype(np.int64), keys.flatten().to_numpy()
        n = _linked_rows(flat, lens, side == i, rows, bool(i[0] == j[0]), pct)
        return pa.RecordBatch.from_arrays([*(t.column(c).combine_chunks() for c in ("n", "h1", "h2")), pa.array(n)], ["n", "h1", "h2", "links"])
    return of


def _per_chunk_pair(group: str, of):
    """``of`` each run of rows of one (group, i, j); rows come sorted by these."""
    def run(batches):
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            edge = np.any([np.diff(held.column(c).to_numpy()) != 0 for c in (group, "i", "j")], axis=0)
            at = 0
            for cut in (np.nonzero(edge)[0] + 1).tolist():
                yield of(held.slice(at, cut - at))
                at = cut
            held = held.slice(at)
        if held is not None:
            yield of(held)
    return run


def link_counts(reps: DataFrame, sets: DataFrame, comps: DataFrame, n: int, pct: int, name: str) -> DataFrame:
    """(n, h1, h2, links): rows with another set that the rows of a set link with.

    ``reps`` has a row per different set, ``sets`` the keys by id, ``comps`` the
    component of an id. Every pair of a component is decided, whatever its size.
    """
    same = ["n", "h1", "h2"]
    members = stored(reps.join(comps, reps["rep"] == comps["id"]).select("id", *same, "rows", "comp"), f"{name}-members")
    width = members.groupBy("comp").agg(F.greatest(
        F.ceil(F.count("*") / CHUNK_DOCS), F.ceil(F.sum("n") / CHUNK_KEYS)).cast("int").alias("parts"))
    placed = stored(members.join(width, "comp").withColumn("side", F.pmod(F.xxhash64("h2", "h1"), F.col("parts")).cast("int")), f"{name}-chunks")
    keyed = _only(sets, placed).withColumns({"h1": F.xxhash64("keys"), "h2": F.xxhash64(F.lit(n), "keys"), "n": F.size("keys")})
    rows = (keyed.join(placed, ["id", *same]).dropDuplicates(["id", *same])
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
            .select("comp", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "side", *same, "rows", "keys"))
    counted = rows.repartition("comp", "i", "j").sortWithinPartitions("comp", "i", "j").mapInArrow(
        _per_chunk_pair("comp", _count_links(pct)), "n int, h1 bigint, h2 bigint, links bigint")
    return stored(counted.groupBy(*same).agg(F.sum("links").alias("links")), f"{name}-counts")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = 5, pct: int = 80,
                    name: str = "jaccard", count_links: bool = False, carry: Column | None = None) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id and, if asked, n_links; kept.

    ``component_id`` is the smallest id reachable over links (100 * intersection >=
    pct * union), the row's own included. Null or empty texts have empty sets and link
    with nothing; so do rows with a null id (null component); rows repeating an id with
    another text are judged by their own text; texts of any length are read whole; an
    empty table gives an empty result; further columns are ignored. ``n_links`` is the
    number of other rows (with an id) that the row links with, rows of an equal set
    included. ``kept`` marks the rows of a component's smallest id; where that id has
    several texts, those of one of them. ``carry`` is a column of the input returned as
    ``carried``.
    """
    more = [] if carry is None else [carry.alias("carried")]
    base = stored(docs.select(docs[id_col].cast("bigint").alias("doc_id"), let(shingle_keys(docs[text_col], n), lambda k: F.struct(
        F.size(k).alias("n"), F.xxhash64(k).alias("h1"), F.xxhash64(F.lit(n), k).alias("h2"),
        F.slice(k, 1, F.least(F.size(k), F.size(k) - _overlap(F.size(k), pct) + SPARE)).alias("prefix"))).alias("s"), *more)
        .select("doc_id", "s.*", *(["carried"] if more else [])), f"{name}-base")
    same = ["n", "h1", "h2"]
    of_id = base.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(F.struct(*same)).alias("lo"), F.max(F.struct(*same)).alias("hi"))
    if not of_id.filter("lo <> hi").isEmpty():
        rows, names = ranked_rows(docs, id_col, text_col, name, *more)
        done = near_duplicates(rows, "rank", "text", n, pct, f"{name}-ranked", count_links, rows["carried"] if more else None)
        own, top = names.select(F.col("rank").alias("doc_id"), "id"), names.select(F.col("rank").alias("component_id"), F.col("id").alias("top"))
        return done.join(own, "doc_id", "left").join(top, "component_id", "left").select(
            F.col("id").alias("doc_id"), "n_shingles", F.col("top").alias("component_id"), *done.columns[3:])
    reps = stored(base.filter("doc_id IS NOT NULL AND n > 0").groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count("*").alias("rows")), f"{name}-reps")
    unique = (base.join(reps, same).filter("doc_id = rep").dropDuplicates(["doc_id", *same])
              .select(F.col("doc_id").alias("id"), "n", "prefix"))

    # Second order: frequency within the prefixes; the most frequent keys are spare.
    rows = unique.select("id", "n", F.explode("prefix").alias("key"))
    often = rows.groupBy("key").agg(F.count("*").alias("df")).filter("df > 1")
    shared = rows.join(often, "key")
    spare = F.least(F.lit(SPARE), _overlap(F.col("n"), pct)) - 1
    late = F.row_number().over(W.partitionBy("id", "n").orderBy(F.desc("df"), F.desc("key")))
    central = F.sum(F.log2("df")).over(W.partitionBy("id", "n")) / F.col("n")
    kept = shared.withColumn("late", late).withColumn("central", central).filter(F.col("late") > spare).drop("late", "df")
    kept = stored(kept, f"{name}-kept")
    # A key left with one document joins nothing.
    alone = kept.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo <> hi").select("key")
    kept = stored(kept.join(alone, "key"), f"{name}-meeting")

    wanted = stored(kept.select("id").distinct(), f"{name}-ids")
    texts = docs.select(docs[id_col].cast("bigint").alias("id"), docs[text_col].alias("text"))
    sets = stored(_only(texts, wanted).select("id", shingle_keys(F.col("text"), n).alias("keys")), f"{name}-sets")
    heads = stored(_only(base.withColumnRenamed("doc_id", "id"), wanted).select(
        "id", F.struct("prefix", _overlap(F.col("n"), pct).alias("o")).alias("head")), f"{name}-heads")

    links, comps, tried = None, None, None
    for turn in range(CENTER_ROUNDS + 1):
        now = kept.withColumn("comp", F.col("id")) if comps is None else kept.join(comps, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        mixed = now.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("docs"),
                                       F.max_by(F.struct("id", "n", "comp"), F.struct("central", "id")).alias("c")).filter("lo <> hi")
        if turn < CENTER_ROUNDS:
            # Each document against the most central one of its key; later rounds look
            # for the most central one outside the component already made.
            if turn:
                outside = now.join(mixed.select("key", F.col("c.comp").alias("top")), "key").filter("comp <> top")
                mixed = outside.groupBy("key").agg(F.max_by(F.struct("id", "n", "comp"), F.struct("central", "id")).alias("c"))
            met = now.join(mixed.select("key", "c"), "key").filter(
                (F.col("comp") != F.col("c.comp")) & _size_fits(F.col("n"), F.col("c.n"), pct))
            pairs = met.select(F.least("id", "c.id").alias("a"), F.greatest("id", "c.id").alias("b")).distinct()
        else:
            # Third order: frequency over the whole sets, among the documents still to be told apart.
            rest = stored(now.join(mixed.select("key", "docs"), "key").select("key", "docs", "id", "n", "comp"), f"{name}-rest")
            few = rest.filter(F.col("docs") <= FEW)
            other = few.select("key", F.col("id").alias("id2"), F.col("n").alias("n2"), F.col("comp").alias("comp2"))
            direct = (few.join(other, "key").filter((F.col("id") < F.col("id2")) & (F.col("comp") != F.col("comp2")) & _size_fits(F.col("n"), F.col("n2"), pct))
                      .select(F.col("id").alias("a"), F.col("id2").alias("b")))
            left = stored(rest.filter(F.col("docs") > FEW).select("id", "n", "comp").distinct(), f"{name}-left")
            paired, decided = _rare_first(left, sets, pct, name)
            pairs = direct.unionByName(paired).distinct()
            grouped = stored(decided, f"{name}-grouped")
            if not grouped.isEmpty():
                links = grouped if links is None else links.unionByName(grouped)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, f"{name}-pairs{turn}")
        if not pairs.isEmpty():
            found = stored(_verified(pairs, heads, sets, pct, f"{name}{turn}"), f"{name}-links{turn}")
            links = found if links is None else links.unionByName(found)
        if links is not None:
            comps = stored(components(links, f"{name}-cc{turn}"), f"{name}-comps{turn}")
        tried = pairs if tried is None else tried.unionByName(pairs)
    of = base.join(reps.filter("rows > 1"), same, "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    if comps is not None:
        of = of.join(comps, of["rep"] == comps["id"], "left").withColumn("rep", F.coalesce("comp", "rep"))
    out = ["doc_id", F.col("n").cast("bigint").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.col("rep")).alias("component_id")]
    if count_links:
        others = F.coalesce(F.col("rows") - 1, F.lit(0))
        if comps is not None:
            of = of.join(link_counts(reps, sets, comps, n, pct, f"{name}-count"), same, "left")
            others = others + F.coalesce("links", F.lit(0))
        out.append(F.when(F.col("doc_id").isNull(), 0).otherwise(others).cast("bigint").alias("n_links"))
    out.append((F.col("doc_id").isNull() | (F.col("doc_id") == F.col("rep"))).alias("kept"))
    return of.select(*out, *(["carried"] if more else []))
