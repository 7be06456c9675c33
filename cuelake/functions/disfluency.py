"""Spoken-style variants of a text, as expressions over hashed draws.

``variant`` and ``chain`` take draw hashes (see functions.draws) instead of a random
generator: one attempt of one row always yields the same text.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cuelake.functions import text as T
from cuelake.functions.draws import pick, pick_index, uniform
from cuelake.functions.labels import CHAINABLE
from cuelake.functions.vectors import let

# Inserted words and the probability of each step.
FILLERS = ["uh", "uhh", "um", "like", "you know", "i mean"]
HEDGES = ["can you", "i was wondering if you could", "hey can u", "could you"]
TAILS = ["plz", "thanks", "please", "thx"]
P_FILLER = 0.85
P_STUTTER = 0.10
P_APOSTROPHES = 0.70
P_HEDGE = 0.45
P_TAIL = 0.35
P_PUNCT = 0.40
P_CHAIN = 0.25
P_CHAIN_APOSTROPHES = 0.6
P_CHAIN_FILLER = 0.5
CHAIN_LINK = " and then "


def _insert(ws: Column, at: Column, word: Column) -> Column:
    """``word`` before position ``at`` (0-based)."""
    tail = F.slice(ws, at + 1, F.greatest(F.size(ws) - at, F.lit(0)))
    return F.array_join(F.concat(F.slice(ws, F.lit(1), at), F.array(word), tail), " ")


def insert_filler(c: Column, ws: Column, u_pos: Column, u_word: Column) -> Column:
    """A filler between two of the words ``ws`` of ``c``; a single word stays as it is."""
    return F.when(F.size(ws) < 2, c).otherwise(
        _insert(ws, pick_index(u_pos, F.size(ws) - 1) + 1, pick(u_word, FILLERS)))


def stutter(c: Column, ws: Column, u_fire: Column, u_pos: Column) -> Column:
    """Now and then repeat one of the words ``ws`` of ``c``."""
    at = pick_index(u_pos, F.size(ws))
    return F.when((u_fire >= P_STUTTER) | (F.size(ws) < 2), c).otherwise(_insert(ws, at, F.get(ws, at)))


def prepend_hedge(c: Column, u: Column) -> Column:
    return F.concat_ws(" ", pick(u, HEDGES), c)


def append_tail(c: Column, u: Column) -> Column:
    return F.concat_ws(" ", c, pick(u, TAILS))


# In the two builders below every step mentions the text so far exactly once (``let`` binds
# it where a step needs it twice). The optimizer may then inline the expression, for a
# filter pushed down to the scan say, without the steps multiplying.

def _maybe_drop_apostrophes(s: Column, fire: Column) -> Column:
    return F.replace(s, F.when(fire, "'").otherwise(""), F.lit(""))


def _maybe_drop_closing_punct(s: Column, fire: Column) -> Column:
    """Whitespace goes as well; the builders collapse it at the end anyway."""
    return F.rtrim(F.rtrim(s, F.when(fire, T.CLOSING).otherwise("")),
                   F.when(fire, T.WHITESPACE).otherwise(""))


def _with_words(s: Column, fire: Column, change) -> Column:
    return let(s, lambda s0: F.when(fire, let(T.words(s0), lambda ws: change(s0, ws))).otherwise(s0))


def variant(text: Column, h1: Column, h2: Column, h3: Column) -> Column:
    """One rephrasing: changed words first, then what is put before and after them."""
    s = _with_words(text, uniform(h1, 0) < P_FILLER,
                    lambda s0, ws: insert_filler(s0, ws, uniform(h1, 1), uniform(h1, 2)))
    s = _with_words(s, uniform(h1, 3) < P_STUTTER,
                    lambda s0, ws: stutter(s0, ws, uniform(h1, 3), uniform(h2, 0)))
    s = _maybe_drop_apostrophes(s, uniform(h2, 1) < P_APOSTROPHES)
    hedge = F.when(uniform(h2, 2) < P_HEDGE, F.concat(pick(uniform(h2, 3), HEDGES), F.lit(" "))).otherwise("")
    tail = F.when(uniform(h3, 0) < P_TAIL, F.concat(F.lit(" "), pick(uniform(h3, 1), TAILS))).otherwise("")
    return T.collapse_whitespace(_maybe_drop_closing_punct(F.concat(hedge, s, tail), uniform(h3, 2) < P_PUNCT))


def chain(text: Column, partner: Column, intent: Column, h1: Column, h2: Column, chainable: list[str] | None = None) -> Column:
    """Two same-class texts joined into one; NULL without a partner or where joining
    would change the class (any but the ``chainable`` ones)."""
    def side(x, u):
        return T.drop_closing_punct(_maybe_drop_apostrophes(x, u < P_CHAIN_APOSTROPHES))
    joined = F.concat(side(text, uniform(h1, 0)), F.lit(CHAIN_LINK), side(partner, uniform(h1, 1)))
    out = _with_words(joined, uniform(h1, 2) < P_CHAIN_FILLER,
                      lambda s0, ws: insert_filler(s0, ws, uniform(h1, 3), uniform(h2, 0)))
    return F.when(intent.isin(CHAINABLE if chainable is None else chainable), T.collapse_whitespace(out))
