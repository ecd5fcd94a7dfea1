import io
import os
import random
import struct
import tarfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from utterflow.operators import reconcile
from utterflow.sources import generated, readers, sinks, storage, tarshards

WAV = (b"RIFF" + struct.pack("<I", 36) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, 16000, 32000, 2, 16)
       + b"data" + struct.pack("<I", 0))


def test_tsv_last_wins(spark):
    lines = spark.createDataFrame([(1, "a\tX"), (2, "a\tY\textra"), (3, "b\tZ\n")], "line_no long, line string")
    got = {r.id: r.text for r in readers.parse_tsv_transcripts(lines).collect()}
    assert got == {"a": "y", "b": "z"}


def test_malformed_input_fails_instead_of_vanishing(spark, tmpdir_fresh):
    schema = T.StructType([T.StructField("wav", T.StringType()), T.StructField("text", T.StringType())])
    one = lambda v: spark.createDataFrame([(v,)], "value string")
    with pytest.raises(Exception):
        readers.parse_json_records(one('[{"wav": "a", "text": "b"}, {"wav": "c", "te'), schema).collect()
    with pytest.raises(Exception):
        readers.parse_literal_records(one("[{'wav': 'a', 'text': 'b'}, {'wav': 'c', 'te"), schema).collect()
    with pytest.raises(Exception):
        readers.explode_keyed_json(one('{"1": {"wav": "a.wav"}, "2": {"w')).collect()
    with pytest.raises(Exception):
        readers.parse_jsonl_manifest(one('{"key": "a", "text": ')).collect()
    assert readers.parse_jsonl_manifest(one("  ")).count() == 0
    with pytest.raises(Exception, match="without a tab"):
        readers.parse_tsv_transcripts(spark.createDataFrame([(1, "no tab")], "line_no long, line string")).collect()
    out = os.path.join(tmpdir_fresh, "corpus")
    spark.range(3).write.parquet(out)
    with pytest.raises(ValueError, match="no split column"):
        readers.load_split(spark, out, "test")
    with pytest.raises(Exception, match="already exists"):
        sinks.publish(spark.range(3), out, split=None)


def test_literals_inside_strings_stay(spark):
    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("ok", T.BooleanType())])
    doc = "[{'text': 'say [None, ok', 'ok': True}, {'text': 'x, None, y', 'ok': None}, {'text': \"it's: False, \\\"True\", 'ok': False}, {'text': None}]"
    got = [tuple(r) for r in readers.parse_literal_records(spark.createDataFrame([(doc,)], "value string"), schema).collect()]
    assert got == [("say [None, ok", True), ("x, None, y", None), ('it\'s: False, "True', False), (None, None)]


def test_pipe_manifest_keeps_quoted_line_breaks(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "pipe.txt")
    open(p, "w").write('a.wav|"two\nlines"|z\nb.wav|plain|z\n')
    assert sorted(tuple(r) for r in readers.read_pipe_manifest(spark, p, n_fields=3).collect()) == [("a.wav", "two\nlines"), ("b.wav", "plain")]


def test_tsv_files_in_line_order(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "tsv")
    os.makedirs(d)
    open(os.path.join(d, "a.tsv"), "w").write("".join(f"id{i % 5}\tText {i}\textra\n" for i in range(50)))
    open(os.path.join(d, "b.tsv"), "w").write("id3\tLAST")
    got = {r.id: r.text for r in readers.read_tsv_transcripts(spark, d).collect()}
    assert got == {"id0": "text 45", "id1": "text 46", "id2": "text 47", "id3": "last", "id4": "text 49"}


def test_split_filter_prunes_partitions(spark, tmpdir_fresh):
    out = os.path.join(tmpdir_fresh, "corpus")
    spark.range(30).withColumn("split", F.when(F.col("id") < 20, "train").otherwise("test")).write.partitionBy("split").parquet(out)
    df = readers.load_split(spark, out, "test", ["id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == 10 and "PartitionFilters: [isnotnull(split" in plan and "train" not in plan


def test_literal_records_none_kept(spark):
    df = spark.createDataFrame([("[{'file':'a','text':None}, {'file':'b','text':'it\\'s'}]",)], "value string")
    schema = T.StructType([T.StructField("file", T.StringType()), T.StructField("text", T.StringType())])
    rows = sorted(tuple(r) for r in readers.parse_literal_records(df, schema).collect())
    assert rows == [("a", None), ("b", "it's")]


def test_keyed_json_and_records(spark):
    df = spark.createDataFrame([('{"1": {"wav": "a.wav", "x": 3}, "2": {"wav": "b.wav"}}',)], "value string")
    assert sorted(r.wav for r in readers.explode_keyed_json(df).collect()) == ["a.wav", "b.wav"]
    rec = spark.createDataFrame([('[{"wav": "a.wav", "text": "x"}]',)], "value string")
    schema = T.StructType([T.StructField("wav", T.StringType()), T.StructField("text", T.StringType())])
    assert [tuple(r) for r in readers.parse_json_records(rec, schema).collect()] == [("a.wav", "x")]


def test_metadata_csv_round_trip(spark, tmpdir_fresh):
    rows = [("train", "a.wav", " "), ("train", "b.wav", ""), ("test", "c.wav", 'he said "x", \\ ok'),
            ("test", "d.wav", "line\nbreak")]
    df = spark.createDataFrame(rows, "split string, file_name string, transcription string")
    out = os.path.join(tmpdir_fresh, "meta")
    sinks.write_metadata_csv(df, out)
    assert sorted(f for f in os.listdir(out) if not f.startswith(".")) == ["_SUCCESS", "split=test", "split=train"]
    back = sinks.read_metadata_csv(spark, out, T.StructType([
        T.StructField("file_name", T.StringType()), T.StructField("transcription", T.StringType()),
        T.StructField("split", T.StringType())]))
    assert sorted((r.split, r.file_name, r.transcription) for r in back.collect()) == sorted(rows)
    first = open([os.path.join(out, "split=train", f) for f in os.listdir(os.path.join(out, "split=train"))
                  if f.endswith(".csv")][0], encoding="utf-8").read().splitlines()[0]
    assert first == '"file_name","transcription"'


def test_publish_and_list(spark, tmpdir_fresh):
    df = spark.range(250).select(F.col("id").alias("utt_id"),
                                 F.when(F.col("id") % 2 == 0, "train").otherwise("test").alias("split"))
    out = os.path.join(tmpdir_fresh, "pub")
    sinks.publish(df.repartition(1), out, rows_per_file=50)
    files = readers.list_files(spark, out, "*.parquet").collect()
    assert len(files) == 6 and all(r.length > 0 for r in files)
    assert spark.read.parquet(out).where("split = 'train'").count() == 125
    m = sinks.materialize(df, os.path.join(tmpdir_fresh, "mat"))
    assert m.count() == 250 and [f.dataType for f in m.schema] == [f.dataType for f in df.schema]


def _write_audio_tree(root):
    for split, names in {"train": ["a", "b"], "test": ["c"]}.items():
        os.makedirs(os.path.join(root, split), exist_ok=True)
        for n in names:
            open(os.path.join(root, split, n + ".wav"), "wb").write(WAV)
        with open(os.path.join(root, split, "metadata.csv"), "w", encoding="utf-8") as f:
            f.write('"file_name","transcription"\n')
            for n in names:
                f.write(f'"{n}.wav","text {n}"\n')


def test_audiofolder(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "af")
    _write_audio_tree(root)
    af = readers.read_audiofolder(spark, root)
    got = sorted((r.split, r.file_name, r.transcription) for r in af.collect())
    assert got == [("test", "c.wav", "text c"), ("train", "a.wav", "text a"), ("train", "b.wav", "text b")]


def test_sidecars_keep_trailing_newline(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "side")
    os.makedirs(d)
    for n in ("x", "y", "z"):
        open(os.path.join(d, n + ".txt"), "w").write(f"hello {n}\n")
    for n in ("x", "y"):
        open(os.path.join(d, n + ".wav"), "wb").write(WAV)
    s = readers.read_sidecars(spark, d)
    assert sorted((r.stem, r.text) for r in s.collect()) == [("x", "hello x\n"), ("y", "hello y\n"), ("z", "hello z\n")]
    audio = readers.list_files(spark, d, "*.wav").select(F.regexp_replace("name", r"\.wav$", "").alias("stem"))
    diff = sorted(tuple(r) for r in reconcile.sidecar_diff(audio, s.select("stem")).collect())
    assert diff == [("text_without_audio", "z")]


def test_pipe_and_path_list(spark, tmpdir_fresh):
    p = os.path.join(tmpdir_fresh, "pipe.txt")
    open(p, "w").write('a.wav|xin chào|extra\nb.wav|"x | y"|z\n')
    got = sorted(tuple(r) for r in readers.read_pipe_manifest(spark, p, n_fields=3).collect())
    assert got == [("a.wav", "xin chào"), ("b.wav", "x | y")]
    q = os.path.join(tmpdir_fresh, "list.txt")
    open(q, "w").write("id1\t00001.wav\nid2\t00002.wav\n")
    assert sorted(r.path for r in readers.read_path_list(spark, q).collect()) == ["id1/00001.wav", "id2/00002.wav"]


def test_tar_shards_and_transcript_join(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "shards")
    os.makedirs(d)
    for s in range(3):
        with tarfile.open(os.path.join(d, f"train-{s}.tar.gz"), "w:gz") as tf:
            for m in range(4):
                data = WAV + bytes(range(m))
                info = tarfile.TarInfo(f"audio/s{s}_m{m}.wav")
                info.size = len(data)
                tf.addfile(info, io.BytesIO(data))
    tarshards.register(spark)
    df = spark.read.format("tarshards").option("path", os.path.join(d, "*.tar.gz")).load()
    assert df.rdd.getNumPartitions() == 3
    rows = df.collect()
    assert len(rows) == 12 and sum(r.size for r in rows) == sum(len(WAV) + m for _ in range(3) for m in range(4))
    keys = [f"s{s}_m{m}" for s in range(3) for m in range(4) if (s, m) != (2, 3)]
    tr = spark.createDataFrame([("train", k, "t " + k) for k in keys], "split string, key string, transcription string")
    members = df.select(F.col("shard").alias("archive"), F.col("member").alias("path"))
    tr = tr.union(spark.createDataFrame([("dev", "s0_m0", "in a train shard"), ("dev", "s2_m1", "d")], tr.schema))
    archives = spark.createDataFrame([("train", f"train-{s}.tar.gz") for s in range(2)]
                                     + [("dev", "train-2.tar.gz"), ("test", "train-2.tar.gz")], "split string, archive string")
    matched = reconcile.shard_transcripts(members, tr, archives)
    got = sorted((r.split, r.key) for r in matched.collect())
    assert got == [("dev", "s2_m1")] + [("train", f"s{s}_m{m}") for s in range(2) for m in range(4)]
    counts = {r.split: (r.n_members, r.n_matched, r.n_unmatched) for r in reconcile.shard_counts(members, tr, archives).collect()}
    assert counts == {"train": (8, 8, 0), "dev": (4, 1, 3), "test": (4, 0, 4)}
    twice = reconcile.shard_counts(members.union(members), tr.union(tr), archives)
    assert {r.split: (r.n_members, r.n_matched, r.n_unmatched) for r in twice.collect()} == counts


def test_whole_file_json_readers(spark, tmpdir_fresh):
    d = os.path.join(tmpdir_fresh, "json")
    os.makedirs(d)
    open(os.path.join(d, "train.json"), "w").write('{"1": {"wav": "a.wav"},\n "2": {"wav": "b.wav"}}')
    open(os.path.join(d, "records.json"), "w").write('[{"wav": "a.wav", "text": "x"},\n {"wav": "b.wav", "text": null}]')
    open(os.path.join(d, "lit.txt"), "w").write("[{'file': 'a', 'text': 'it\\'s', 'speaker_name': None}]")
    keyed = readers.read_keyed_json(spark, os.path.join(d, "train.json"))
    assert sorted(r.wav for r in keyed.collect()) == ["a.wav", "b.wav"]
    schema = T.StructType([T.StructField("wav", T.StringType()), T.StructField("text", T.StringType())])
    rec = readers.read_json_records(spark, os.path.join(d, "records.json"), schema)
    assert sorted((r.wav, r.text) for r in rec.collect()) == [("a.wav", "x"), ("b.wav", None)]
    lschema = T.StructType([T.StructField(c, T.StringType()) for c in ("file", "text", "speaker_name")])
    lit = readers.read_literal_records(spark, os.path.join(d, "lit.txt"), lschema)
    assert [(r.file, r.text, r.speaker_name) for r in lit.collect()] == [("a", "it's", None)]


def test_file_and_shard_writers_publish_atomically(spark, tmpdir_fresh):
    df = spark.createDataFrame([(f"s{i % 3}", f"m{i}.wav", f"x{i}".encode()) for i in range(30)],
                               "shard string, member string, content binary")
    out = os.path.join(tmpdir_fresh, "tars")
    counts = {r.shard: r.n_members for r in sinks.write_tar_shards(df, out).collect()}
    assert counts == {"s0": 10, "s1": 10, "s2": 10}
    assert sorted(os.listdir(out)) == ["s0.tar.gz", "s1.tar.gz", "s2.tar.gz"]      # no temp files left
    with tarfile.open(os.path.join(out, "s1.tar.gz")) as tf:
        assert sorted(m.name for m in tf.getmembers()) == sorted(f"m{i}.wav" for i in range(1, 30, 3))
    files = df.select(F.concat("shard", F.lit("/"), "member").alias("relpath"), "content")
    fout = os.path.join(tmpdir_fresh, "files")
    assert sinks.write_files(files, fout).agg(F.count("*"), F.sum("n_bytes")).first() == (30, 80)
    written = sorted(os.path.join(d, f) for d in os.listdir(fout) for f in os.listdir(os.path.join(fout, d)))
    assert len(written) == 30 and open(os.path.join(fout, "s1", "m10.wav")).read() == "x10"


def _visible(root):
    return sorted(os.path.relpath(os.path.join(d, f), root) for d, _, names in os.walk(root) for f in names)


def test_a_failed_job_leaves_nothing_visible(spark, tmpdir_fresh):
    rows = spark.range(100).repartition(4).select(F.concat(F.lit("f"), "id").alias("relpath"), F.encode(F.col("id").cast("string"), "UTF-8").alias("content"))
    bad = rows.withColumn("content", F.when(F.col("relpath") == "f99", F.raise_error(F.lit("on purpose")).cast("binary")).otherwise(F.col("content")))
    for write, df in ((sinks.write_files, bad), (sinks.write_tar_shards, bad.select(F.col("relpath").alias("member"), "content", F.lit("s").alias("shard")))):
        with pytest.raises(Exception, match="on purpose"):
            write(df, tmpdir_fresh)
        assert os.listdir(tmpdir_fresh) == []
    with pytest.raises(Exception, match="more than one row for f7"):
        sinks.write_files(rows.union(rows.where("relpath = 'f7'")), tmpdir_fresh)
    with pytest.raises(Exception, match="needs a path and content"):
        sinks.write_files(rows.withColumn("content", F.lit(None).cast("binary")), tmpdir_fresh)
    assert os.listdir(tmpdir_fresh) == []
    sinks.write_files(rows, f"file://{tmpdir_fresh}")
    sinks.write_files(rows.where("relpath = 'f7'").withColumn("content", F.lit(b"new")), tmpdir_fresh)
    assert len(_visible(tmpdir_fresh)) == 100 == len(os.listdir(tmpdir_fresh)) and open(os.path.join(tmpdir_fresh, "f7")).read() == "new"
    assert sinks.write_files(rows.limit(0), tmpdir_fresh).count() == 0 and len(os.listdir(tmpdir_fresh)) == 100


def test_moves_of_lost_attempts_are_not_made_twice(spark, tmpdir_fresh):
    """A row whose file has been moved already is done; one without any file is an error."""
    root, hidden = sinks._staged(spark, tmpdir_fresh)
    open(os.path.join(tmpdir_fresh, "a"), "w").write("moved before")
    done = spark.createDataFrame([("a", "staged-a")], "relpath string, staged string")
    assert sinks._published(done, root, hidden).collect() == [("a",)]
    root, hidden = sinks._staged(spark, tmpdir_fresh)
    with pytest.raises(Exception):
        sinks._published(spark.createDataFrame([("b", "staged-b")], done.schema), root, hidden)
    assert os.listdir(tmpdir_fresh) == ["a"]


def _members(n, size=5000):
    return [(f"audio/m{i:03}.wav", random.Random(i).randbytes(size + i)) for i in range(n)]


def _plain_tar(path, mode, members):
    with tarfile.open(path, mode, format=tarfile.PAX_FORMAT) as tf:
        for name, data in members:
            info = tarfile.TarInfo(name)
            info.size, info.pax_headers = len(data), {"comment": "x" * 30}
            tf.addfile(info, io.BytesIO(data))
        tf.addfile(tarfile.TarInfo("empty"), io.BytesIO(b""))
        folder = tarfile.TarInfo("folder")
        folder.type = tarfile.DIRTYPE
        tf.addfile(folder)


def test_one_shard_is_read_by_several_partitions(spark, tmpdir_fresh):
    members = _members(60)
    df = spark.createDataFrame([("s", n, d) for n, d in members], "shard string, member string, content binary")
    sinks.write_tar_shards(df, tmpdir_fresh, group_bytes=20_000)
    _plain_tar(os.path.join(tmpdir_fresh, "p.tar"), "w", members)
    _plain_tar(os.path.join(tmpdir_fresh, "q.tar.gz"), "w:gz", members)
    _plain_tar(os.path.join(tmpdir_fresh, "r.tar.xz"), "w:xz", members)
    want = dict(members)
    with tarfile.open(os.path.join(tmpdir_fresh, "s.tar.gz")) as tf:                     # a usual archive to others
        assert {m.name: tf.extractfile(m).read() for m in tf} == want
    for name, spread in (("s.tar.gz", True), ("p.tar", True), ("q.tar.gz", False), ("r.tar.xz", False)):
        got = tarshards.read_tar_shards(spark, os.path.join(tmpdir_fresh, name), rangebytes=30_000)
        assert got.rdd.getNumPartitions() > 5
        rows = got.withColumn("task", F.spark_partition_id()).collect()
        assert sorted((r.member, bytes(r.content)) for r in rows if r.member != "empty") == sorted(want.items()), name
        assert (len({r.task for r in rows}) > 5) == spread and all(r.size == len(r.content) and r.offset == 0 for r in rows)
        assert [r.size for r in rows if r.member == "empty"] == ([] if name == "s.tar.gz" else [0])
    for step in (701, 5000, 1 << 20):                                                    # every member once, whatever the ranges
        reader = tarshards._TarShardsReader({"path": os.path.join(tmpdir_fresh, "*"), "rangebytes": str(step), "content": "false"})
        names = [m for p in reader.partitions() for b in reader.read(p) for m in b.column(1).to_pylist()]
        assert sorted(names) == sorted([*want] * 4 + ["empty"] * 3)


def test_long_members_in_pieces(spark, tmpdir_fresh):
    members = [("a", b"x" * 10), ("b", random.Random(1).randbytes(250_000)), ("c", b"")]
    _plain_tar(os.path.join(tmpdir_fresh, "p.tar"), "w", members)
    df = tarshards.read_tar_shards(spark, tmpdir_fresh + "/*.tar", piecebytes=100_000)
    rows = sorted(df.collect())
    assert [(r.member, r.offset, len(r.content)) for r in rows] == [("a", 0, 10), ("b", 0, 100_000), ("b", 100_000, 100_000), ("b", 200_000, 50_000),
                                                                    ("c", 0, 0), ("empty", 0, 0)]
    assert b"".join(bytes(r.content) for r in rows if r.member == "b") == members[1][1]


def test_named_shards_and_members_are_read_alone(spark, tmpdir_fresh):
    for k in range(3):
        _plain_tar(os.path.join(tmpdir_fresh, f"t{k}.tar"), "w", _members(5))
    pattern = f"file://{tmpdir_fresh}/*.tar"
    some = tarshards.read_tar_shards(spark, pattern, ["t1.tar"], ["audio/m001.wav", "audio/m004.wav", "none"])
    assert sorted((r.shard, r.member) for r in some.collect()) == [("t1.tar", "audio/m001.wav"), ("t1.tar", "audio/m004.wav")]
    assert some.rdd.getNumPartitions() == 1                                               # the other shards are not opened
    assert tarshards.read_tar_shards(spark, pattern, shards=["no"]).count() == 0
    df = tarshards.read_tar_shards(spark, pattern)
    assert df.where("shard = 't1.tar'").count() == 6 and df.where("member = 'empty'").count() == 3 and df.count() == 18
    reader = tarshards._TarShardsReader({"path": f"{tmpdir_fresh}/t0.tar", "members": '["audio/m002.wav"]'})
    tar = tarfile.open(f"{tmpdir_fresh}/t0.tar")
    calls = []
    tar.extractfile = lambda m, f=tar.extractfile: calls.append(m.name) or f(m)
    assert [r[0] for r in reader._rows(tar, 0, 1 << 62)] == ["audio/m002.wav"] == calls


def test_a_large_shard_is_not_held_whole(tmpdir_fresh):
    import tracemalloc
    path = os.path.join(tmpdir_fresh, "big.tar.gz")
    with open(path, "wb") as out:
        tar = tarshards.GroupWriter(out)
        for i in range(60):
            tar.add(f"m{i}", bytes([i]) * 2_000_000)
        tar.close()
    reader = tarshards._TarShardsReader({"path": path, "piecebytes": "500000"})
    tracemalloc.start()
    assert sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 240
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40_000_000                     # of 120 MB


def test_listing_of_matching_names(tmpdir_fresh):
    for name in ("a/x-1.tar.gz", "a/x-2.tar.gz", "a/y.txt", "a/deep/x-3.tar.gz", "a/.x-4.tar.gz"):
        path = os.path.join(tmpdir_fresh, "shards", name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        open(path, "wb").close()
    for root in (f"file://{tmpdir_fresh}/shards", f"{tmpdir_fresh}/shards"):
        assert storage.list_matching(f"{root}/a/*.tar.gz") == [f"{root}/a/x-1.tar.gz", f"{root}/a/x-2.tar.gz"]
        assert storage.list_matching(f"{root}/*/x-1.tar.gz") == [f"{root}/a/x-1.tar.gz"]
        assert storage.list_matching(f"{root}/a/y.txt") == [f"{root}/a/y.txt"]
        assert storage.list_matching(f"{root}/none/*.gz") == []


def test_no_scratch_folder_of_one_machine_on_a_cluster(monkeypatch):
    from utterflow import session

    class Conf:
        def get(self, *a):
            return None

    class Cluster:
        conf = Conf()

        class sparkContext:
            master = "spark://host:7077"

            @staticmethod
            def getConf():
                return Conf()
    with pytest.raises(RuntimeError, match="all nodes share"):
        session.ensure_checkpoint_dir(Cluster())


def test_rows_from_a_generator(spark):
    import pyarrow as pa

    def generate(unit):
        first, n = unit
        yield {"id": first, "text": f"row {first}"}
        yield (first + 1, None)
        yield pa.RecordBatch.from_pydict({"more": [0] * (n - 2), "text": ["b"] * (n - 2), "id": list(range(first + 2, first + n))})

    df = generated.from_generator(spark, {"train": [(0, 3), (10, 5)], "test": [(20, 2)], "none": []}, generate, "id long, text string")
    assert df.rdd.getNumPartitions() == 3 and df.columns == ["split", "id", "text"]
    assert sorted((r.split, r.id, r.text) for r in df.collect() if r.id < 12) == [
        ("train", 0, "row 0"), ("train", 1, None), ("train", 2, "b"), ("train", 10, "row 10"), ("train", 11, None)]
    assert df.groupBy("split").count().orderBy("split").collect() == [("test", 2), ("train", 8)]
    plain = generated.from_generator(spark, [(5, 2)], generate, T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())]))
    assert plain.columns == ["id", "text"] and plain.count() == 2
    assert generated.from_generator(spark, [], generate, "id long").count() == 0
    with pytest.raises(Exception):
        generated.from_generator(spark, [(0, 3)], generate, "id long, other string").collect()


def test_row_groups_are_units(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "t.parquet")
    spark.range(1000).repartition(3).write.option("parquet.block.size", 1024).parquet(path)
    units = generated.parquet_row_groups(spark, path)
    assert len(units) >= 3 and units == generated.parquet_row_groups(spark, f"file://{path}")
    df = generated.from_generator(spark, units, lambda u: generated.read_row_group(u, ["id"]), "id long")
    assert df.rdd.getNumPartitions() == len(units) and sorted(r.id for r in df.collect()) == list(range(1000))
