"""Out-of-distribution rows for the reject class, one per seed row.

Any table with an id can seed the generator, so volume follows the seed table; the
family mix is a parameter. Every character is a hashed draw of (seed, id, position).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cuelake.functions import keys as K, labels as L, text as T
from cuelake.functions.draws import draw_hash, pick_index, uniform
from cuelake.operators.ranks import random_split
from cuelake.operators.skew import exclude_keys

# Alphabets, family weights, and the hand-written families.
CONSONANTS = "bcdfghjklmnpqrstvwz"
VOWELS = "aeiou"
SALAD = CONSONANTS + VOWELS + "    "
FAMILY_WEIGHTS = {"gibberish": 150, "salad": 80, "numbers": 60}
P_CODA = 0.4
FOREIGN = [
    "quelle heure est il maintenant", "ich moechte ein kaltes bier",
    "donde esta la biblioteca por favor", "wo ist der naechste bahnhof",
    "je voudrais un cafe au lait", "como se llama este lugar",
    "il fait tres froid aujourd hui", "dov e la stazione dei treni",
    "watashi wa nihongo ga hanasemasen", "guten morgen wie geht es ihnen",
    "merci beaucoup pour votre aide", "no entiendo lo que dices",
]
OFF_DOMAIN = [
    "the mitochondria is the powerhouse of the cell",
    "photosynthesis converts sunlight into glucose and oxygen",
    "the treaty of westphalia was signed in sixteen forty eight",
    "ribosomes translate messenger rna into proteins",
    "the french revolution began in seventeen eighty nine",
    "water boils at one hundred degrees celsius at sea level",
    "the mariana trench is the deepest part of the ocean",
    "shakespeare wrote romeo and juliet in the fifteen nineties",
    "the speed of light is roughly three hundred thousand kilometers per second",
    "tectonic plates drift a few centimeters every year",
    "the human heart beats about a hundred thousand times a day",
    "jupiter is the largest planet in the solar system",
    "the great wall of china stretches thousands of miles",
    "honeybees communicate the location of flowers by dancing",
    "the renaissance began in florence in the fourteenth century",
    "a group of crows is called a murder",
    "mount everest grows a little taller each year",
    "the amazon rainforest produces a fifth of the world oxygen",
]
DISFLUENCY = [
    "uh um like you know i mean", "er hmm well so anyway", "uhhh ahh ok ok ok",
    "yeah yeah no no wait", "hmm let me think uhh", "so like basically um",
    "wait what no hold on", "errr i dunno maybe sorta",
]
SYMBOLS = ["!@#$ %^&* ()_+", "<<<>>> {}{}{} []", "??? ... ;;; :::", "~~~ === +++ ---"]
FIXED_TEXTS = FOREIGN + OFF_DOMAIN + DISFLUENCY + SYMBOLS


def _char(u: Column, alphabet: str) -> Column:
    return F.substr(F.lit(alphabet), pick_index(u, len(alphabet)) + 1, F.lit(1))


def _span(u: Column, low: int, high: int) -> Column:
    """Integer in [low, high]."""
    return pick_index(u, high - low + 1) + low


SALAD_BLOCKS, WORDS_MAX = 6, 6


def _hash_plan() -> dict[str, list[tuple]]:
    """Per family, the salts of the draw hashes its text is built from, in order."""
    words = [("word", w) for w in range(1, WORDS_MAX + 1)]
    syllables = [("syllable", w, half) for w in range(1, WORDS_MAX + 1) for half in (1, 2)]
    return {"gibberish": [("gibberish",), *words, *syllables],
            "salad": [("salad",), *[("char", i) for i in range(SALAD_BLOCKS)]],
            "numbers": [("numbers",), ("more",)]}


def gibberish(h: list[Column]) -> Column:
    """Two to six made-up words of one to three consonant-vowel syllables."""
    def word(w):
        head, first, second = h[w], h[WORDS_MAX + 2 * w - 1], h[WORDS_MAX + 2 * w]
        pairs = [(first, 0), (first, 2), (second, 0)]
        syllables = [F.concat(_char(uniform(x, i), CONSONANTS), _char(uniform(x, i + 1), VOWELS)) for x, i in pairs]
        n = _span(uniform(head, 0), 1, 3)
        coda = F.when(uniform(head, 1) < P_CODA, _char(uniform(head, 2), CONSONANTS)).otherwise("")
        return F.concat(syllables[0], F.when(n >= 2, syllables[1]).otherwise(""),
                        F.when(n >= 3, syllables[2]).otherwise(""), coda)
    n = _span(uniform(h[0], 0), 2, WORDS_MAX)
    return F.concat_ws(" ", *[F.when(n >= w, word(w)) for w in range(1, WORDS_MAX + 1)])


def salad(h: list[Column]) -> Column:
    """Eight to twenty-four characters, blanks included, then stripped."""
    chars = [_char(uniform(x, i), SALAD) for x in h[1:] for i in range(4)]
    return F.trim(F.substr(F.concat(*chars), F.lit(1), _span(uniform(h[0], 0), 8, 4 * SALAD_BLOCKS)))


def numbers(h: list[Column]) -> Column:
    """Two to five integers below 10,000."""
    draws = [(h[0], 1), (h[0], 2), (h[0], 3), (h[1], 0), (h[1], 1)]
    n = _span(uniform(h[0], 0), 2, 5)
    parts = [_span(uniform(x, i), 0, 9999).cast("string") for x, i in draws]
    return F.concat_ws(" ", *[F.when(n > at, part) for at, part in enumerate(parts)])


def generate(seeds: DataFrame, id_col: str, seed: int = 11,
             weights: dict[str, int] = FAMILY_WEIGHTS) -> DataFrame:
    """(id, family, text): one generated row per seed row.

    A row's hashes are columns of their own, so each is computed once and only for the
    family that uses it, and the text is a flat expression over them.
    """
    makers = {"gibberish": gibberish, "salad": salad, "numbers": numbers}
    row = F.col(id_col)
    at = uniform(draw_hash(seed, row, "family"), 0) * F.lit(float(sum(weights.values())))
    family, text, bound, hashes = F.when(F.lit(False), ""), F.when(F.lit(False), ""), 0, {}
    for name, weight in weights.items():
        bound += weight
        family = family.when(at < bound, name)
        names = [f"_{name}{i}" for i in range(len(_hash_plan()[name]))]
        hashes |= {n: F.when(F.col("family") == name, draw_hash(seed, row, *salt))
                   for n, salt in zip(names, _hash_plan()[name])}
        text = text.when(F.col("family") == name, makers[name]([F.col(n) for n in names]))
    rows = seeds.select(row, family.alias("family")).withColumns(hashes)
    return rows.select(id_col, "family", text.alias("text"))


def fixed_rows(spark: SparkSession) -> DataFrame:
    """The hand-written texts, with ids below zero."""
    rows = [(-i - 1, "fixed", t) for i, t in enumerate(FIXED_TEXTS)]
    return spark.createDataFrame(rows, "id long, family string, text string")


def make_ood(seeds: DataFrame, id_col: str, probe: DataFrame, seed: int = 11,
             eval_fraction: float = 0.2, weights: dict[str, int] = FAMILY_WEIGHTS) -> DataFrame:
    """(id, family, text, intent, part) with part ``train`` or ``eval``.

    Unique by text, never a probe text (compared stripped and lowercased), never blank.
    """
    made = generate(seeds, id_col, seed, weights).withColumnRenamed(id_col, "id")
    every = made.unionByName(fixed_rows(seeds.sparkSession))
    # Blank texts leave after the aggregate, where the filter cannot be pushed into the
    # generator and make it build every text twice.
    first = (every.groupBy("text")
             .agg(F.min(F.struct("id", "family")).alias("o"), F.bool_or(~T.is_blank(F.col("text"))).alias("said"))
             .filter("said").select("o.*", "text"))
    keyed = first.withColumn("_key", K.digest(K.key_leak(F.col("text"))))
    block = probe.select(K.digest(K.key_leak(F.col("text"))).alias("_key"))
    clean = exclude_keys(keyed, block, "_key", spread=F.col("id")).drop("_key")
    split = random_split(clean, "id", eval_fraction, seed)
    return split.select("id", "family", "text", F.lit(L.REJECT_INTENT).alias("intent"),
                        F.when(F.col("chosen"), "eval").otherwise("train").alias("part"))
