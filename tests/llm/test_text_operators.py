"""Byte-level BPE, fill-in-middle and spelling variants against brute force, and on odd inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pandas as pd
import public_tokenizers
import pytest
import regex
import tiktoken

from cuelake.llm import byte_bpe, fill_middle, queries, spelling

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(sf):
    return pd.read_parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=byte_bpe.load(RANKS).rank, special_tokens={})


def test_bpe_is_the_library_s(spark, sf, docs, library):
    got = queries.QUERIES["op11_segment_tree_bpe"](spark, sf).toPandas().set_index("doc_id")
    for i, t in zip(docs.doc_id, docs.text):
        ids = library.encode_ordinary(t or "")
        raw = b"".join(k.to_bytes(4, "little") for k in ids)
        r = got.loc[i]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(raw), sha(t or ""))


def test_bpe_of_long_matches_and_odd_letters(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "SLAB", 7)
    monkeypatch.setattr(byte_bpe, "CACHED", 5)
    rng = random.Random(3)
    ranks, cut, known = byte_bpe.load(RANKS), regex.compile(PATTERN), {}
    texts = ["", "\0", "a" * 5000, "".join(rng.choice("abcdeé") for _ in range(20_000)), " " * 3000 + "x", "\x85   x", "<|endoftext|>'s",
             *("".join(rng.choice("aeinst 1.\n'é中😀") for _ in range(rng.randrange(60))) for _ in range(400))]
    for t in texts:
        ids = byte_bpe.encode_text(t, cut, ranks, known)
        assert ids.tolist() == library.encode_ordinary(t) and byte_bpe.decode_ids(ids, ranks) == t.encode()


def test_merges_without_a_whole_token():
    """Ties go to the left, and a vocabulary is taken as its ranks say."""
    rank = {bytes([k]): k for k in range(256)} | {b"aa": 256, b"ab": 257, b"aab": 258}
    assert byte_bpe.merge_tokens(b"aaab", rank) == [256, 257]
    assert byte_bpe.merge_tokens(b"aaa", rank) == [256, 97]
    assert byte_bpe.merge_tokens(b"baab", rank) == [98, 258]


def test_bpe_decodes(spark, odd):
    encoded = byte_bpe.encode(odd, RANKS, PATTERN)
    back = Counter((r["doc_id"], r["text"]) for r in byte_bpe.decode(encoded, RANKS).collect())
    assert back == Counter((r["doc_id"], r["text"] or "") for r in odd.collect())


def test_bpe_refuses_ranks_with_gaps(tmp_path):
    (tmp_path / "ranks").write_text("YQ== 0\nYg== 2\n")
    with pytest.raises(ValueError, match="ranks are not"):
        byte_bpe.Ranks(str(tmp_path / "ranks"))


def expected_fim(doc_id, t):
    lines = re.findall(r"[^\n]*\n|[^\n]+", t)
    x = hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()
    h = [int(x[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(lines) + 1), h[1] % (len(lines) + 1)))
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not t or any(mark in t for mark in ("<P>", "<S>", "<M>")):
        return len(lines), "plain", None, None, t
    if h[3] % 100 < 50:
        return len(lines), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(lines), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("frame", [5, 65_536])
def test_fill_middle_brute_force(spark, monkeypatch, frame):
    """Whatever the frames: cuts inside frames and lines over many of them, marks across frames, odd ends."""
    rng = random.Random(5)
    texts = ["", "\n", "\n\n", "one line", "one\n", "é中😀\nü\r\nx" * 9, "tell <P> apart", "<" * 9 + "\nP>", "ab<\nS>" * 4, "x" * 40 + "\n" + "y" * 40,
             "abcd<M>e", *("".join(rng.choice("ab\n<>PSMé😀") for _ in range(rng.randrange(80))) for _ in range(200))]
    monkeypatch.setattr(fill_middle, "FRAME_CHARS", frame)
    stores = [fill_middle.Frames.of_text(t) for t in texts]
    for i, (t, kept) in enumerate(zip(texts, stores)):
        kept = fill_middle.Frames.of_rows(kept.rows())
        n, form, p, m, out = expected_fim(i, t)
        assert kept.n_units() == n and kept.chars[-1] == len(t)
        assert bool(kept.find([b"<P>", b"<S>", b"<M>"])) == any(x in t for x in ("<P>", "<S>", "<M>"))
        lines = re.findall(r"[^\n]*\n|[^\n]+", t)
        for k in range(n + 1):
            assert kept.after(k) == (len("".join(lines[:k]).encode()), len("".join(lines[:k])))
        x = hashlib.sha256(f"7:{i}".encode()).hexdigest()
        first, second = (kept.after(k)[0] for k in sorted((int(x[:8], 16) % (n + 1), int(x[8:16], 16) % (n + 1))))
        output = fill_middle.Frames.of_chunks(fill_middle.arrange(kept, form, first, second))
        assert b"".join(output.read(0, output.bytes[-1])).decode() == out
        assert b"".join(fill_middle.restore(output, form)).decode() == t
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in fill_middle.fill_middle(df).collect()}
    for i, t in enumerate(texts):
        n, form, p, m, out = expected_fim(i, t)
        r = got[i]
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output_sha256"], r["restored_sha256"]) == (n, form, p, m, sha(out), sha(t))
        assert fill_middle.text_of_frames([f.asDict() for f in r["output"]]) == out and r["lossless"]


def test_fill_middle_rate(spark):
    df = spark.createDataFrame([(k, "a\nb\nc") for k in range(300)], "doc_id bigint, text string")
    plain = fill_middle.fill_middle(df, rate_pct=40, seed=3).filter("form = 'plain'").count()
    assert 150 < plain < 210


def spelled(rows, min_length=6, min_count=5, ratio=5, noise=199):
    """word -> (n, near words, form, root), comparing every word with its deletions and replacements."""
    fold, counts = str.maketrans(spelling.UPPER, spelling.LOWER), Counter()
    for i, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(fold)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if noise and h % noise == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= min_length and k >= min_count}
    holes, near = defaultdict(set), defaultdict(set)
    for w in n:
        for k in range(len(w)):
            holes[k, w[:k] + w[k + 1:]].add(w)
    for (_, rest), words in holes.items():
        for w in words:
            near[w] |= words - {w} | ({rest} & n.keys())
            if rest in n:
                near[rest].add(w)
    form = {w: min(near[w], key=lambda v: (-n[v], v)) if near[w] else None for w in n}
    form = {w: f if f and n[f] >= ratio * n[w] else None for w, f in form.items()}

    def root(w):
        return root(form[w]) if form[w] else w

    return {w: (n[w], len(near[w]), form[w], n.get(form[w]), root(w)) for w in n}


def found(rows):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}


def test_spelling_brute_force(spark, sf, docs):
    got = found(queries.QUERIES["op13_spelling_variants"](spark, sf).collect())
    want = spelled(zip(docs.doc_id, docs.text))
    assert got == want and any(w[2] for w in want.values())


def test_spelling_edits_everywhere(spark):
    """One edit at any place, blocks cut in slices, chains of forms, ties, upper case and accents."""
    rng = random.Random(7)
    rows = []
    for g in range(3):
        base = "".join(rng.choice("abcé") for _ in range(6 + g))
        words = [(base, 130)] + [(w, rng.choice((1, 2, 2, 30))) for w in
                                 sorted({base[:k] + x + base[k + d:] for k in range(len(base) + 1) for d in (0, 1) for x in ("", "a", "b", "é", "zz")})]
        rows += [(f"{w.upper() if w.isascii() else w} ") * n for w, n in words]
    rows += ["Chainwords " * 300, "chainword " * 50, "chainwor " * 7]
    rows = [(k if k % 9 else None, t) for k, t in enumerate(rows)] + [(5000, None), (5001, ""), (5002, "Ünlike " * 3 + "ſtop")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = spelled(rows, min_count=2, noise=11)
    assert max(w[1] for w in want.values()) > 20 and any(want[w[2]][2] for w in want.values() if w[2])
    for block in (3, 4096):
        assert found(spelling.variants(df, min_count=2, noise=11, block=block).collect()) == want


def test_spelling_refuses_what_it_cannot_do(spark, empty):
    with pytest.raises(ValueError):
        spelling.variants(empty, min_length=2)
    with pytest.raises(ValueError):
        spelling.variants(empty, ratio=1)


def test_odd_rows(odd, empty):
    """One row per input row; repeated rows, nulls and clashing names are no trouble."""
    for make in (lambda d: byte_bpe.encode(d, RANKS, PATTERN), fill_middle.fill_middle):
        assert len(make(odd).collect()) == odd.count()
        assert make(empty).collect() == []
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for min_count in (1, 2):
        assert found(spelling.variants(odd.withColumnRenamed("row", "word").withColumnRenamed("run", "n"), min_count=min_count).collect()) == spelled(
            rows, min_count=min_count)
    assert spelling.variants(empty).collect() == []


def test_matches_are_remembered_over_tasks(spark, monkeypatch):
    known = byte_bpe.remembered(RANKS)
    assert known is byte_bpe.remembered(RANKS)
    ranks, cut = byte_bpe.load(RANKS), regex.compile(PATTERN)
    text = "qzxvw onlyseenhere, once\n\n and qzxvw"
    first = byte_bpe.encode_text(text, cut, ranks, known)
    with monkeypatch.context() as m:
        m.setattr(byte_bpe, "merge_tokens", None)  # nothing is left to merge
        assert byte_bpe.encode_text(text, cut, ranks, known) == first
        assert byte_bpe.encode_text("", cut, ranks, known) == byte_bpe.array("I")
    for pattern in (PATTERN, f"({PATTERN})"):  # groups leave findall, long texts are cut in slabs
        cut = regex.compile(pattern)
        whole = [w for words in byte_bpe._slabs(text, cut) for w in words]
        monkeypatch.setattr(byte_bpe, "SLAB", 3)
        assert [w for words in byte_bpe._slabs(text, cut) for w in words] == whole == [x[0] for x in cut.finditer(text)]
        monkeypatch.undo()
