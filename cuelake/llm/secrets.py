"""Secret scans through a trigram inverted index.

Each rule's regular expression is turned into a Boolean query over trigrams that any
match must contain (lower-cased, so one index serves either case). The index holds, per
block of documents, the posting list of every trigram some rule asks for; intersecting
and uniting lists inside a block gives the candidates of a rule, and only candidates
are verified with the rule itself. Rules without a mandatory trigram scan every text.

Blocks are hashes of the id, of about BLOCK_ROWS documents each, so a posting list is
bounded however common its trigram is.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from re import _parser as regex_parser

from pyspark.sql import Column, DataFrame, functions as F

from cuelake.llm.common import let, sha256_hex, stored, text_of

BLOCK_ROWS = 4096
# Classes and alternatives with at most so many spellings are spelled out.
MAX_SPELLINGS = 64
# Trigram flags per long of a document's mask.
MASK_BITS = 62
# Matches positioned per inner step; keeps the work per text linear in practice.
STEP = 512


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    group: int = 0
    least: int = 0  # code points of that group; shorter matches are dropped
    base: bool = False


# The three base rules, in the order that breaks ties.
KEYWORDS = ["password", "passwd", "secret", "token"]
ASSIGN = ("(" + "|".join(map(_any_case, KEYWORDS)) + "|" + _any_case("api") + "_?" + _any_case("key")
          + r")[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
BASE_RULES = [
    Rule("assign", ASSIGN, 2, 6, True),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", "[0-9a-f]+", 0, 24, True),
]
# Published formats of keys.
EXTRA_RULES = [
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{6,}"),
]
RULES = BASE_RULES + EXTRA_RULES


# -- from a regular expression to trigrams -------------------------------------

def _spellings(op, arg) -> set[str] | None:
    """All lower-case strings one parsed item can match, or None if many."""
    name = str(op)
    if name == "LITERAL":
        return {chr(arg).lower()}
    if name == "IN":
        chars = set()
        for kind, value in arg:
            if str(kind) == "LITERAL":
                chars.add(chr(value).lower())
            elif str(kind) == "RANGE" and value[1] - value[0] < 8:
                chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None
        return chars if len(chars) <= 8 else None
    if name == "SUBPATTERN":
        return _joined(arg[3])
    if name == "BRANCH":
        parts = [_joined(b) for b in arg[1]]
        return None if None in parts else set().union(*parts)
    if name == "MAX_REPEAT" and arg[1] == 1:
        inner = _joined(arg[2])
        return None if inner is None else inner | ({""} if arg[0] == 0 else set())
    return None


def _joined(items) -> set[str] | None:
    out = {""}
    for op, arg in items:
        more = _spellings(op, arg)
        if more is None or len(out) * len(more) > MAX_SPELLINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def _alternatives(strings: set[str]) -> list[frozenset[str]]:
    """One of these trigram sets must be present; empty when nothing is mandatory."""
    sets = {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}
    if frozenset() in sets:
        return []
    return sorted((s for s in sets if not any(o < s for o in sets)), key=sorted)


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """All clauses must hold; a clause is a list of alternatives, each a set of trigrams."""
    def of(items) -> list[list[frozenset[str]]]:
        clauses, run = [], {""}
        for op, arg in items:
            more = _spellings(op, arg)
            if more is not None and len(run) * len(more) <= MAX_SPELLINGS:
                run = {a + b for a in run for b in more}
                continue
            clauses.append(_alternatives(run))
            run = {""}
            if str(op) == "SUBPATTERN":
                clauses += of(arg[3])
            elif str(op) == "MAX_REPEAT" and arg[0] >= 1:
                clauses += of(arg[2])
        return [c for c in [*clauses, _alternatives(run)] if c]
    return of(regex_parser.parse(pattern))


# -- index and candidates --------------------------------------------------------

def build_index(docs: DataFrame, trigrams: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(block, p0, p1, ...): per block the posting list of each trigram, in the given order."""
    def masks(low: Column) -> Column:
        out = []
        for at in range(0, len(trigrams), MASK_BITS):
            bits = F.lit(0).cast("bigint")
            for k, t in enumerate(trigrams[at:at + MASK_BITS]):
                bits = bits.bitwiseOR(F.when(F.contains(low, F.lit(t)), F.lit(1 << k)).otherwise(F.lit(0)).cast("bigint"))
            out.append(bits.alias(f"m{at // MASK_BITS}"))
        return F.struct(*out)

    blocks = max(1, math.ceil(docs.count() / BLOCK_ROWS))
    flags = docs.select(docs[id_col].alias("id"), let(F.lower(text_of(docs[text_col])), masks).alias("m")).filter("id IS NOT NULL")
    has = [F.expr(f"(m.m{k // MASK_BITS} & {1 << (k % MASK_BITS)}L) != 0") for k in range(len(trigrams))]
    return (flags.groupBy(F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))
            .agg(*[F.collect_list(F.when(h, F.col("id"))).alias(f"p{k}") for k, h in enumerate(has)]))


def candidates(index: DataFrame, trigrams: list[str], rules: list[Rule]) -> DataFrame:
    """(id, rules): positions of the rules whose trigram query the document satisfies."""
    at = {t: F.col(f"p{k}") for k, t in enumerate(trigrams)}

    def fold(lists: list[Column], step) -> Column:
        out = lists[0]
        for more in lists[1:]:
            out = step(out, more)
        return out

    found = []
    for k, rule in enumerate(rules):
        clauses = trigram_query(rule.pattern)
        if clauses:
            hits = fold([fold([fold([at[t] for t in sorted(s)], F.array_intersect) for s in alternatives],
                              F.array_union) for alternatives in clauses], F.array_intersect)
            found.append(_tagged(F.array_distinct(hits), k))
    return (index.select(F.explode(F.concat(*found)).alias("h")).groupBy("h.id")
            .agg(F.collect_set("h.rule").alias("rules")))


def _tagged(ids: Column, rule: int) -> Column:
    return F.transform(ids, lambda i: F.struct(i.alias("id"), F.lit(rule).alias("rule")))


# -- verification ----------------------------------------------------------------

def _positions(lens: Column) -> Column:
    """Array of (start, end, ok) from an array of (gap, len, ok), in code points."""
    def one(acc: Column, x: Column) -> Column:
        start = acc["pos"] + x["gap"]
        return F.struct((start + x["len"]).alias("pos"), F.concat(acc["out"], F.array(F.struct(
            start.alias("start"), (start + x["len"]).alias("end"), x["ok"].alias("ok")))).alias("out"))

    empty = F.from_json(F.lit("[]"), "array<struct<start:int,end:int,ok:boolean>>")

    def step(all_lens: Column):
        def run(acc: Column, at: Column) -> Column:
            part = F.aggregate(F.slice(all_lens, at + 1, STEP),
                               F.struct(acc["pos"].alias("pos"), empty.alias("out")), one)
            return let(part, lambda p: F.struct(p["pos"].alias("pos"), F.concat(acc["out"], p["out"]).alias("out")))
        return run

    return let(lens, lambda n: F.aggregate(
        F.sequence(F.lit(0), F.size(n) - 1, F.lit(STEP)), F.struct(F.lit(0).alias("pos"), empty.alias("out")),
        step(n), lambda acc: acc["out"]))


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, end, kind) of a rule's matches, leftmost first."""
    p = F.lit(rule.pattern)
    matches, gaps = F.regexp_extract_all(text, p, F.lit(0)), F.split(text, rule.pattern, -1)
    long = (F.transform(F.regexp_extract_all(text, p, F.lit(rule.group)), lambda g: F.length(g) >= rule.least)
            if rule.group else F.transform(matches, lambda m: F.length(m) >= rule.least))
    lens = let(F.arrays_zip(F.slice(gaps, 1, F.size(matches)).alias("g"), matches.alias("m"), long.alias("ok")),
               lambda z: F.transform(z, lambda x: F.struct(F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("len"), x["ok"].alias("ok"))))
    kept = F.filter(_positions(lens), lambda s: s["ok"])
    return F.transform(kept, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"),
                                                s["end"].alias("end"), F.lit(rule.kind).alias("kind")))


def _probe(rule: Rule) -> str:
    """A pattern that every text with a kept match of the rule contains."""
    if rule.group == 0 and rule.least and rule.pattern.endswith("+"):
        fixed = len(regex_parser.parse(rule.pattern)) - 1
        return f"{rule.pattern[:-1]}{{{rule.least - fixed},}}"
    return rule.pattern


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: list[Rule] | None = None) -> DataFrame:
    """One row per input row: doc_id, spans array<struct<start, order, end, kind>>.

    Null text counts as empty; a row with a null id is in no posting list and is scanned
    by every rule; rows repeating an id are each verified; an empty table gives an empty
    result; further columns are ignored. Positions are code points, end exclusive.
    """
    rules = rules or RULES
    queries = [trigram_query(r.pattern) for r in rules]
    trigrams = sorted({t for q in queries for clause in q for s in clause for t in s})
    listed = stored(candidates(stored(build_index(docs, trigrams, id_col, text_col), "trigrams"), trigrams, rules)
                    .withColumnRenamed("id", "_id"), "candidates")
    rows = docs.select(docs[id_col].alias("doc_id"), text_of(docs[text_col]).alias("text"))
    rows = rows.join(listed, rows["doc_id"] == listed["_id"], "left")
    none = F.from_json(F.lit("[]"), "array<struct<start:int,order:int,end:int,kind:string>>")
    found = []
    for k, (rule, query) in enumerate(zip(rules, queries)):
        wanted = F.rlike("text", F.lit(_probe(rule)))
        if query:
            wanted = (F.col("doc_id").isNull() | F.coalesce(F.array_contains("rules", k), F.lit(False))) & wanted
        found.append(F.when(wanted, spans_of(F.col("text"), rule, k)).otherwise(none))
    return rows.select("doc_id", F.sort_array(F.concat(*found)).alias("spans"))


def digest_spans(found: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_<base kind>, base_sha256 and spans as text."""
    rules = rules or RULES
    base = [k for k, r in enumerate(rules) if r.base]

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    only_base = F.filter("spans", lambda s: s["order"].isin(base))

    def count(k: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["order"] == k)).cast("bigint").alias(f"n_{rules[k].kind}")

    counts = [count(k) for k in base]
    return found.select("doc_id", *counts, sha256_hex(text(only_base)).alias("base_sha256"), text(F.col("spans")).alias("spans"))
