import re

import pytest
from pyspark.sql import functions as F

from cuelake.functions import keys as K, labels as L, text as T

# Pairs that must match.
VECTORS = [
    ("play despacito on spotify", "play despacito on spotify"),
    ("what's the capital of france", "what's the capital of france"),
    ("where is the search bar", "where is the search bar"),
    ("set volume to 50", "set volume to 50"),
    ("remember my name is morgan", "remember my name is morgan"),
    ("my wifi password is hunter2", "my wifi password <SECRET>"),
    ("email me at john@example.com", "email me at <EMAIL>"),
    ("call 5551234", "call <NUM>"),
    ("my pin is 9041", "my pin <SECRET>"),
    ("my github token is ghp_abc123", "my github token <SECRET>"),
    ("send a@b.com my pin 4321", "send <EMAIL> my pin <SECRET>"),
    ("Hey. Can you hear me?", "hey. can you hear me"),
    ("Pause the music.", "pause the music"),
    ("Are you there?", "are you there"),
    ("WHY ARE YOU SHOUTING?!", "why are you shouting"),
    ("Email me at John@Example.com.", "email me at <EMAIL>"),
]
UNICODE = [
    ("my password\rfoo bar", "my password <SECRET>"),
    ("pin\u0085leak", "pin <SECRET>"), ("pin leak", "pin <SECRET>"),
    ("ſecret x", "ſecret <SECRET>"),
    ("call ١٢٣٤٥", "call <NUM>"),
    ("password́ x", "password <SECRET>"), ("12345́", "<NUM>́"),
    ("joſe@example.com", "<EMAIL>"), ("joı@example.com", "<EMAIL>"),
    ("hello ?!", "hello"), ("hello !", "hello"), ("hello\x1c", "hello"),
    ("spinning ab12345 passwords", "spinning ab12345 passwords"),
    ("a secret b\nnext line", "a secret <SECRET>\nnext line"),
    ("API  key abc", "api  key <SECRET>"), ("my password", "my password <SECRET>"),
]


def apply(spark, fn, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.withColumn("o", fn(F.col("t"))).orderBy("i").select("o").collect()]


@pytest.mark.parametrize("cases", [VECTORS, UNICODE], ids=["vectors", "unicode"])
def test_normalize(spark, cases):
    assert apply(spark, T.normalize_text, [a for a, _ in cases]) == [b for _, b in cases]


def test_filter_on_normalized_text_stays_small(spark):
    df = spark.createDataFrame([("a.",)], "t string").withColumn("t", K.key_redacted(F.col("t")))
    plan = df.filter("t <> ''")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<NUM>") <= 4


def test_strip_is_unicode_aware(spark):
    assert apply(spark, T.strip, ["  a b  \x1f", None, " "]) == ["a b", None, ""]


def test_keys(spark):
    assert apply(spark, K.key_loose, ["Don't  STOP, now!", "..."]) == ["dont stop now", ""]
    assert apply(spark, K.key_leak, [" Mail a@b.com "]) == ["mail a@b.com"]
    once = apply(spark, K.key_redacted, [a for a, _ in VECTORS + UNICODE])
    assert apply(spark, K.key_redacted, once) == once


def test_drop_closing_punct(spark):
    assert apply(spark, T.drop_closing_punct, ["hi?! ", "hi ?!", "hi.\n"]) == ["hi?!", "hi", "hi."]


def test_tokens(spark):
    got = apply(spark, T.unigrams_and_bigrams, ["I like big-cats", "a", None])
    assert got == [["like", "big", "cats", "like big", "big cats"], [], None]


def test_labels(spark):
    cases = [(["chat", "agent"], "agent"), (["integration", "find_action"], "integration"), ([], "chat"), (None, "chat")]
    df = spark.createDataFrame(cases, "c array<string>, want string")
    assert all(r[0] == r[1] for r in df.select(L.break_tie(F.col("c")), "want").collect())
    texts = ["open maps and then call bob", "remember my keys", "what does this button do", "click the skip button", "skip", "hi"]
    assert apply(spark, L.weak_label, texts) == ["agent", "memory", "chat", "find_action", "integration", "chat"]


def test_loose_key_of_any_character_in_one_pass(spark):
    """Equal to its rule character by character, in one pass of patterns."""
    chars = [*range(1, 0x250), 0x1680, 0x2000, 0x2009, 0x2028, 0x202F, 0x212A, 0x3000, 0x4E2D, 0xFEFF, 0x1F600]
    texts = [f"{before}{chr(k)}{after}" for k in chars for before, after in (("", ""), (" A'", "b "), ("9 ", "' \t"), ("'", "  z"))]

    def rule(text):
        spaced = re.sub("[^a-z0-9 ]", " ", text.lower().replace("'", ""))
        return re.sub(" +", " ", spaced).strip(" ")
    assert apply(spark, K.key_loose, texts) == [rule(t) for t in texts]
    assert apply(spark, K.key_loose, [None, "", "'"]) == [None, "", ""]

    assert str(K.key_loose(F.col("x"))).count("regexp_replace") == 1
