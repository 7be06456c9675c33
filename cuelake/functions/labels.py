"""The intent label set and the label-level expressions built on it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Labels in declaration order, tie-break order, chainable labels.
INTENTS = ["find_action", "integration", "chat", "memory", "agent", "none"]
REAL_INTENTS = ["find_action", "integration", "chat", "memory", "agent"]
TIE_ORDER = ["agent", "memory", "integration", "find_action", "chat"]
DEFAULT_INTENT = "chat"
CHAINABLE = ["chat", "memory", "agent"]
REJECT_INTENT = "none"
GATE = 0.55


@dataclass(frozen=True)
class LabelSet:
    """A label space. Operators take one, so other tasks can bring their own."""

    labels: tuple[str, ...] = tuple(INTENTS)
    tie_order: tuple[str, ...] = tuple(TIE_ORDER)
    default: str = DEFAULT_INTENT
    reject: str | None = REJECT_INTENT

    def dim(self, spark: SparkSession) -> DataFrame:
        rows = [(lbl, i, lbl != self.reject,
                 self.tie_order.index(lbl) if lbl in self.tie_order else None,
                 lbl in CHAINABLE)
                for i, lbl in enumerate(self.labels)]
        return spark.createDataFrame(
            rows, "intent string, ord int, is_real boolean, tie_rank int, chainable boolean")


DEFAULT_LABELS = LabelSet()


def is_valid(label: Column, labels: LabelSet = DEFAULT_LABELS) -> Column:
    return F.coalesce(label.isin(list(labels.labels)), F.lit(False))


def has_label(label: Column) -> Column:
    """A label counts as given when it is neither NULL nor the empty string."""
    return F.coalesce(label != "", F.lit(False))


def has_exact_keys(json_line: Column, keys: list[str]) -> Column:
    wanted = F.array(*[F.lit(k) for k in sorted(keys)])
    return F.coalesce(F.array_sort(F.json_object_keys(json_line)) == wanted, F.lit(False))


def break_tie(candidates: Column, labels: LabelSet = DEFAULT_LABELS) -> Column:
    """First candidate by precedence; the default label when there is none."""
    order = F.array(*[F.lit(x) for x in labels.tie_order])
    hits = F.array_intersect(order, F.coalesce(candidates, F.array().cast("array<string>")))
    return F.coalesce(F.get(hits, F.lit(0)), F.lit(labels.default))


def resolve_label(client_label: Column, teacher_label: Column,
                  labels: LabelSet = DEFAULT_LABELS) -> Column:
    """Struct(source, intent): the in-log label wins, then the teacher's.

    source is ``client``, ``teacher``, ``bad`` (in-log label outside the set) or
    ``needs_teacher``. A teacher may answer with real labels only.
    """
    real = list(x for x in labels.labels if x != labels.reject)
    teacher_ok = F.coalesce(teacher_label.isin(real), F.lit(False))
    source = (F.when(has_label(client_label),
                     F.when(is_valid(client_label, labels), "client").otherwise("bad"))
              .when(teacher_ok, "teacher")
              .when(teacher_label.isNotNull(), "bad")
              .otherwise("needs_teacher"))
    intent = (F.when(source == "client", client_label)
              .when(source == "teacher", teacher_label))
    return F.struct(source.alias("source"), intent.alias("intent"))


# Boundary rules as patterns over lowercased text, one candidate label each.
WEAK_RULES = [
    ("agent", r" and then |, then "),
    ("memory", r"(^| )(remember|note|save) "),
    ("memory", r"(^| )(what's|what is|who is|where is) my "),
    ("chat", r"^(what does|what's the|what is the|tell me about|explain|talk me through)( |$)"),
    ("find_action", r"^(click|tap|scroll|select|find|where is the)( |$)"),
    ("integration", r"^(skip|pause|next|volume|play|open|check|send)( |$)"),
]


def weak_candidates(c: Column) -> Column:
    low = F.lower(c)
    found = [F.when(low.rlike(p), F.lit(lbl)) for lbl, p in WEAK_RULES]
    return F.array_distinct(F.array_compact(F.array(*found)))


def weak_label(c: Column, labels: LabelSet = DEFAULT_LABELS) -> Column:
    """Rule-based label. A question about an element beats a UI verb, so a match
    of the question rule removes ``find_action`` before the tie is broken."""
    cands = weak_candidates(c)
    cands = F.when(F.array_contains(cands, "chat"), F.array_remove(cands, "find_action")).otherwise(cands)
    return break_tie(cands, labels)


def gate_action(confidence: Column, intent: Column, gate: float = GATE,
                reject: str = REJECT_INTENT) -> Column:
    """``defer`` below the gate or for the reject label, else ``keep``."""
    return F.when((confidence < gate) | (intent == reject), "defer").otherwise("keep")
