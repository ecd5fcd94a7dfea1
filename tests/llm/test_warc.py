import random

import zstandard

from utterflow.llm import warc
from utterflow.llm.queries import LLM_QUERIES


def roundtrip(spark, df, **kw):
    folder = warc.shared_path(spark, "warc-test")
    index = warc.write_archives(df, folder, **kw)
    return folder, index, warc.read_records(index, folder)


def test_query_equals_brute_force(spark):
    SF_SMALL = "/root/testdata/sf0.001"
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    last = {}
    for r in pages:
        last[r.html or ""] = max(last.get(r.html or "", -1), r.page_id)
    want = []
    for r in pages:
        data, end = (r.html or "").encode(), last[r.html or ""]
        again = r.page_id < end
        want.append((r.page_id, len(data), warc.payload_digest(data), "revisit" if again else "response", end if again else None))
    got = sorted(map(tuple, LLM_QUERIES["op8_warc"](spark, SF_SMALL).collect()))
    assert got == sorted(want)


def test_bundles_are_plain_zstandard_with_independent_frames(spark, monkeypatch):
    rows = [(i, f"http://h/{i}\r\n x", "é" * (i * 37 % 5000)) for i in range(900)]
    folder, index, back = roundtrip(spark, spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert back.count() == 900
    entries = index.collect()
    fs, base = warc.open_root(folder)
    for name in {r.bundle for r in entries}:
        with fs.open_input_file(f"{base}/{name}") as f:
            frames = warc.seek_table(f)
            data = f.read_at(f.size(), 0)
        whole = b"".join(zstandard.ZstdDecompressor().decompress(data[a:a + n]) for a, n, _ in frames)
        assert zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read() == whole
        mine = [r for r in entries if r.bundle == name]
        assert whole.count(b"WARC/1.1\r\n") == len(mine) and len(whole) == sum(r.length for r in mine)


def test_nulls_repeats_empty_table_and_clashing_columns(spark):
    schema = "page_id long, url string, html string, payload int, refers_to string, sha1 string, id int"
    rows = [(1, None, None, 1, "", "", 1), (2, "u", "", 1, "", "", 1), (3, "u", "x", None, None, None, None), (5, "u", "x", 1, "", "", 1),
            (5, "u", "x", 1, "", "", 1), (None, "u", "x", 1, "", "", 1), (9, "u", "WARC/1.1\r\n\r\n" * 20_000, 1, "", "", 1)]
    df = spark.createDataFrame(rows, schema)
    got = sorted(((r.page_id or 0), r.payload_bytes, r.record_type, r.refers_to) for r in roundtrip(spark, df)[2].collect())
    assert got == [(0, 1, "response", None), (1, 0, "revisit", 2), (2, 0, "response", None), (3, 1, "revisit", 5),
                   (5, 1, "response", None), (5, 1, "response", None), (9, 12 * 20_000, "response", None)]
    some = {r.page_id: r.record_type for r in roundtrip(spark, df, min_payload=1)[2].collect()}
    assert some[1] == some[2] == "response" and some[3] == "revisit"
    assert roundtrip(spark, spark.createDataFrame([], schema))[2].count() == 0


def test_long_records_full_bundles_and_runs_of_frames(spark, monkeypatch):
    """Records longer than a frame, several bundles a task, and tasks that read few frames each."""
    for name, size in (("FRAME_BYTES", 20_000), ("BUNDLE_BYTES", 30_000), ("READ_FRAMES", 2)):
        monkeypatch.setattr(warc, name, size)
    rows = [(i, f"http://h/{i}", random.Random(i % 100).randbytes(80_000 if i % 20 == 0 else 1500).hex()) for i in range(1, 121)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    folder, index, back = roundtrip(spark, df)
    held = index.collect()
    assert len({r.bundle for r in held}) > 4 and max(r.length for r in held) > 150_000
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type) for r in back.collect()}
    last = {h: i for i, _, h in rows}
    assert got == {i: (len(h), warc.payload_digest(h.encode()), "response" if last[h] == i else "revisit") for i, _, h in rows}
    runs = {(r.bundle, r.frame // 2) for r in held}
    assert warc.read_records(index, folder).rdd.getNumPartitions() == len(runs)


def test_folders_without_a_scheme_are_on_sparks_file_system(spark, tmp_path):
    import pytest
    df = spark.createDataFrame([(1, "u", "x")], "page_id long, url string, html string")
    index = warc.write_archives(df, str(tmp_path))
    assert warc.read_records(index, f"file://{tmp_path}").count() == 1 and any(p.suffix == ".zst" for p in tmp_path.iterdir())
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://store/")
    try:
        with pytest.raises(Exception):
            warc.read_records(index, str(tmp_path)).count()        # not the executor's own disk
    finally:
        conf.set("fs.defaultFS", before) if before else conf.unset("fs.defaultFS")
