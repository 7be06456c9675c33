import hashlib
import json

import pytest
from pyspark.sql import functions as F

from cuelake.sources import lines as LN, manifest as MF, objects as O, sinks as SK
from cuelake.streaming import jobs as J

LINES = ['{"text": "a", "intent": "chat"}', "", "   ", "{bad", '["text"]', '{"text": "b"}',
         '{"text": "c", "intent": "tyop"}', '{"text": 5, "intent": "memory"}', '{"text": "d", "intent": "agent", "x": 1}']


def test_scan_labeled(spark, tmp_path):
    (tmp_path / "b.jsonl").write_text("\n".join(LINES) + "\n")
    (tmp_path / "a.jsonl").write_text('{"text": "first", "intent": "none"}\n')
    (tmp_path / "raw").mkdir()
    (tmp_path / "raw" / "c.jsonl").write_text('{"text": "hidden"}\n')
    scan = LN.scan_labeled(spark, str(tmp_path), glob="*.jsonl", exact_keys=True)
    good = [(r["text"], r["_line"], r["seq"]) for r in scan.examples.orderBy("seq").collect()]
    assert good == [("first", 1, 0), ("a", 1, 1), ("5", 8, 8)]
    bad = {r["_line"]: r["reason"] for r in scan.violations.collect()}
    assert bad == {4: "bad_json", 5: "bad_json", 6: "missing_key", 7: "unknown_intent", 9: "extra_key"}
    with pytest.raises(Exception, match=r"b.jsonl:[4567]: not a labeled example"):
        LN.load_labeled_dir(spark, str(tmp_path)).collect()


def test_line_numbers_over_splits(spark, tmp_path):
    (tmp_path / "big.txt").write_text("\n".join(f"row {i}" for i in range(5000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = LN.number_lines(LN.read_lines(spark, str(tmp_path))).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(rows) == 5000 and all(r["line"] == f"row {r['_line'] - 1}" and r["seq"] == r["_line"] - 1 for r in rows)


def test_samples_and_limit(spark, tmp_path):
    body = ['{"text": "a", "tag": "chat"}', "oops", '{"tag": "x"}', '{"text": "b"}']
    (tmp_path / "s.jsonl").write_text("\n".join(body))
    samples, rejects = LN.scan_samples(spark, str(tmp_path), label_field="tag")
    assert samples.count() == 3 and [r["line"] for r in rejects.collect()] == ["oops"]
    assert LN.scan_samples(spark, str(tmp_path), limit=2)[0].count() == 2


def test_objects(spark, tmp_path):
    for day, dev, name, body in [("2026-05-29", "d1", "17-ab", '{"text": "x",\n "client_label": "chat"}'),
                                 ("2026-05-30", "d2", "18-cd", "not json"), ("2026-05-30", "d2", "19-ef", "[1]")]:
        folder = tmp_path / "samples" / day / dev
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{name}.json").write_text(body)
    counts = {r["status"]: r["n"] for r in O.pull(spark, str(tmp_path), str(tmp_path / "out"), "samples/").collect()}
    assert counts == {"written": 1, "skipped": 2}
    row = spark.read.parquet(str(tmp_path / "out")).first()
    assert (row["device"], row["ts"], row["uuid"], row["text"]) == ("d1", "17", "ab", "x")
    one_day = O.compact(O.read_objects(spark, str(tmp_path), "samples/2026-05-29/"))
    assert one_day.count() == 1
    for prefix, n in [("samples/2026-05", 3), ("samples/2026-05-3", 2), ("samples/2026-05-30/d2/18", 1), ("samples/2027", 0)]:
        assert O.read_objects(spark, str(tmp_path), prefix).count() == n
    assert O.pull(spark, str(tmp_path), str(tmp_path / "none"), "samples/2027").count() == 0


def test_pull_packs_by_size(spark, tmp_path):
    for i in range(300):
        folder = tmp_path / "in" / f"2026-05-{10 + i % 3}" / f"d{i % 7}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{i}-x.json").write_text(json.dumps({"text": "t" * 80, "client_label": str(i)}))
    out = tmp_path / "out"
    assert [tuple(r) for r in O.pull(spark, str(tmp_path / "in"), str(out), target_bytes=4000).collect()] == [("written", 300)]
    assert sorted(int(r[0]) for r in spark.read.parquet(str(out)).select("client_label").collect()) == list(range(300))
    for date in out.glob("date=*"):
        assert 1 <= len(list(date.glob("*.parquet"))) <= 4  # 100 objects of about 110 bytes


def test_manifest(spark, tmp_path):
    for n in "abc":
        (tmp_path / n).write_text(n)
    want = MF.build_manifest(spark, str(tmp_path)).filter("path <> 'a'").withColumn(
        "md5", F.when(F.col("path") == "b", "0").otherwise(F.col("md5"))).collect()
    want = spark.createDataFrame(want + [("z", "0", 1)], "path string, md5 string, size long")
    got = {r["path"]: r["status"] for r in MF.verify_manifest(MF.build_manifest(spark, str(tmp_path)), want).collect()}
    assert got == {"a": "extra", "b": "changed", "c": "ok", "z": "missing"}


def test_manifest_of_large_files(spark, tmp_path):
    """A file beyond what one value can hold (sparse here), names with blanks, a root named twice in its path."""
    root = tmp_path / "a b" / "data" / "a b" / "data"
    (root / "sub").mkdir(parents=True)
    size = (1 << 31) + 5
    with open(root / "sub" / "big file%20", "wb") as f:
        f.truncate(size)
    (root / "empty").write_text("")
    (root / "few").write_text("x" * 1000)
    want = hashlib.md5()
    for _ in range(1 << 7):
        want.update(bytes(1 << 24))
    want.update(bytes(5))
    got = {r["path"]: (r["md5"], r["size"]) for r in MF.build_manifest(spark, f"{root}/", whole=500, chunk=300 << 10).collect()}
    assert got == {"sub/big file%20": (want.hexdigest(), size), "few": (hashlib.md5(b"x" * 1000).hexdigest(), 1000)}


def test_append_is_idempotent(spark, tmp_path):
    out = str(tmp_path / "collected")
    rows = spark.createDataFrame([("call <NUM>", "chat"), ("hi", "chat")], "text string, intent string")
    for _ in range(2):
        SK.append_new(rows, out)
    assert spark.read.json(out).count() == 2


def test_stream_dedup_one_file_or_many(spark, tmp_path):
    def run(files):
        src, out = tmp_path / f"in{files}", str(tmp_path / f"out{files}")
        src.mkdir()
        rows = [{"ts": f"2026-01-01T00:00:{i % 60:02d}Z", "text": f"Say {i % 10}."} for i in range(200)]
        for f in range(files):
            (src / f"{f}.json").write_text("\n".join(json.dumps(r) for r in rows[f::files]))
        stream = spark.readStream.schema("ts timestamp, text string").option("maxFilesPerTrigger", 2).json(str(src))
        J.run_available(J.dedup_stream(stream, "ts").select("text"), out, str(tmp_path / f"ck{files}"))
        return sorted(r["text"] for r in spark.read.parquet(out).collect())
    assert run(1) == run(10) == [f"Say {i}." for i in range(10)]


def test_strict_scan_fails_whatever_is_selected(spark, tmp_path):
    from cuelake.sources import lines as LN

    path = tmp_path / "bad.jsonl"
    path.write_text('{"text": "a", "intent": "chat"}\nnot json\n')
    for use in (lambda d: d.count(), lambda d: d.select("text").collect(), lambda d: d.collect()):
        with pytest.raises(Exception, match="bad.jsonl:2"):
            use(LN.load_labeled(spark, str(path)))
