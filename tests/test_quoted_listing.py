import os
import random

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from utterflow.sources import listing, quoted, readers, sinks, storage

OPTIONS = {"sep": "|", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
           "emptyValue": "", "nullValue": "\u0000\u0001"}


def whole_file(spark, path, fields=2, **more):
    """Spark's own reader, one task a file."""
    schema = ", ".join(f"_c{i} string" for i in range(fields))
    return spark.read.schema(schema).options(**{**OPTIONS, "multiLine": "true", **more}).csv(path)


def automaton(data: bytes, state: int, sep: int = ord(",")) -> int:
    for c in data:
        opens = 3 if c == 34 else 1 if c == sep else 0 if c == 10 else 2
        state = {0: opens, 1: opens, 2: opens if opens != 3 else 2, 3: 4 if c == 34 else 3, 4: opens}[state]
    return state


def test_scanner_equals_a_bytewise_automaton():
    rnd, scanner = random.Random(0), quoted.Scanner(",")
    for _ in range(4000):
        data = bytes(rnd.choice(b'ab",\n"\n,"\r') for _ in range(rnd.randrange(40)))
        assert scanner.ends(data) == [automaton(data, s) for s in range(5)]
        assert list(scanner.records(data, 0)) == [i for i in range(1, len(data) + 1) if automaton(data[:i], 0) == 0]


@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_a_quoted_line_break_across_every_range_border(spark, tmpdir_fresh, newline):
    rows = [("a.wav", "plain"), ("b.wav", 'two\nlines "quoted"\n\nand | a bar'), ("c.wav", ""), ("d é.wav", "\n" * 9), ("e.wav", 'x"y'), ("", "z")]
    text = newline.join(f'{a}|"' + b.replace('"', '""') + '"|more' for a, b in rows) + newline + f'f.wav|say "hi"|x{newline}{newline}g|"end'
    path = os.path.join(tmpdir_fresh, "m.csv")
    open(path, "wb").write(text.encode())
    want = sorted(tuple(map(str, r)) for r in whole_file(spark, path, 3).select("_c0", "_c1").collect())
    assert len(want) == 8
    schema = "_c0 string, _c1 string, _c2 string"
    scanner, size = quoted.Scanner("|"), os.path.getsize(path)
    fs, name = storage.open_root(path)
    with fs.open_input_file(name) as f:
        every = [(r["start"], r["value"]) for b in quoted._cut(scanner, f, path, 0, size, quoted.RECORD, False) for r in b.to_pylist()]
        for step in range(1, size + 1):                      # every border there can be
            state, got = quoted.RECORD, []
            for start in range(0, size, step):
                end = min(start + step, size)
                got += [(r["start"], r["value"]) for b in quoted._cut(scanner, f, path, start, end, state, False) for r in b.to_pylist()]
                state = scanner.ends(f.read_at(end - start, start))[state]
            assert got == every, step
    for step in (3, 13, 1000):
        rec = quoted.read_records(spark, path, "|", range_bytes=step)
        got = rec.select(F.from_csv("value", schema, OPTIONS).alias("r")).select("r._c0", "r._c1").collect()
        assert sorted(tuple(map(str, r)) for r in got) == want, step
        assert len({r.start for r in rec.collect()}) == len(want)
    assert sorted(tuple(map(str, r)) for r in readers.read_pipe_manifest(spark, path, n_fields=3).collect()) == want


def test_random_files_equal_the_whole_file_reader(spark, tmpdir_fresh, monkeypatch):
    rnd = random.Random(5)
    for k in range(6):
        os.makedirs(os.path.join(tmpdir_fresh, "many"), exist_ok=True)
        with open(os.path.join(tmpdir_fresh, "many", f"part {k}%20.csv"), "w", newline="") as f:
            for _ in range(rnd.randrange(60)):
                cells = ["".join(rnd.choice('ab" \né,\t') for _ in range(rnd.randrange(9))) for _ in range(3)]
                f.write(",".join('"' + c.replace('"', '""') + '"' if rnd.random() < 0.8 or set(c) & set('",\n') else c for c in cells) + "\n")
    folder = os.path.join(tmpdir_fresh, "many")
    open(os.path.join(folder, "_ignored.csv"), "w").write("no,no,no\n")
    want = sorted(tuple(map(str, r)) for r in whole_file(spark, folder, 3, sep=",", header="true").select("_c1", "_c2").collect())
    for step in (30, 1 << 20):
        monkeypatch.setattr(quoted, "RANGE_BYTES", step)
        got = readers.read_indexed_csv(spark, folder, ["_c1", "_c2"]).collect()
        assert sorted(tuple(map(str, r)) for r in got) == want


def test_a_file_of_several_ranges_is_several_tasks(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "big.csv")
    with open(path, "w") as f:
        for i in range(2000):
            f.write(f'{i}|"line {i}\nand more"|x\n')
    rec = quoted.read_records(spark, path, "|", range_bytes=10_000)
    per_task = rec.groupBy(F.spark_partition_id()).count().collect()
    assert len(per_task) >= 4 and sum(r["count"] for r in per_task) == 2000
    assert rec.rdd.getNumPartitions() == -(-os.path.getsize(path) // 10_000)
    empty = os.path.join(tmpdir_fresh, "empty.csv")
    open(empty, "w").close()
    assert readers.read_pipe_manifest(spark, empty).count() == 0


def test_tsv_lines_keep_their_order_over_splits(spark, tmpdir_fresh):
    folder = os.path.join(tmpdir_fresh, "tsv")
    os.makedirs(folder)
    with open(os.path.join(folder, "a b%20.tsv"), "w", newline="") as f:
        for i in range(5000):
            f.write(f"id{i % 7}\tText {i}\textra\r\n")
    with open(os.path.join(folder, "b.tsv"), "w", newline="") as f:
        f.write("id3\tLAST\rid4\tmac")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        assert spark.read.text(folder).rdd.getNumPartitions() > 10
        got = {r.id: r.text for r in readers.read_tsv_transcripts(spark, folder).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want = {f"id{i % 7}": f"text {i}" for i in range(5000)} | {"id3": "last", "id4": "mac"}
    assert got == want


def _tree(root):
    for rel in ("a.wav", "x/b c.wav", "x/y%20z/d+é.wav", "x/y%20z/d.txt", "x/.hidden/e.wav", "x/.f.wav", "_u/g.wav", "x/_temporary/h.wav"):
        os.makedirs(os.path.dirname(os.path.join(root, rel)), exist_ok=True)
        open(os.path.join(root, rel), "w").write(rel)
    os.makedirs(os.path.join(root, "nothing/here"))


def test_trees_are_listed_by_executors(spark, tmpdir_fresh, monkeypatch):
    _tree(tmpdir_fresh)
    for name in ("collect", "toPandas", "toLocalIterator", "take", "first", "head", "toArrow"):      # the driver gets numbers of folders only
        monkeypatch.setattr(DataFrame, name, lambda *a, **b: pytest.fail("rows came to the driver"))
    found = {root: listing.list_tree(spark, root, "*.{wav,WAV}") for root in (tmpdir_fresh, f"file:{tmpdir_fresh}", f"file://{tmpdir_fresh}/")}
    monkeypatch.undo()
    for tree in found.values():
        rows = {r.rel: (r.name, r.path, r.length) for r in tree.collect()}
        assert set(rows) == {"a.wav", "x/b c.wav", "x/y%20z/d+é.wav", "_u/g.wav"}
        for rel, (name, path, length) in rows.items():
            fs, local = storage.open_root(path)
            assert name == rel.split("/")[-1] and length == len(rel.encode()) and open(local).read() == rel
    assert listing.list_tree(spark, os.path.join(tmpdir_fresh, "a.wav")).select("rel", "length").collect() == [("a.wav", 5)]
    with pytest.raises(FileNotFoundError):
        listing.list_tree(spark, os.path.join(tmpdir_fresh, "none"))
    assert readers.list_files(spark, os.path.join(tmpdir_fresh, "nothing")).count() == 0


def test_sidecars_with_odd_names(spark, tmpdir_fresh):
    names = {"a b%20c.txt": "one\n", "d+e.txt": "zwei é\r\n", "ü.txt": ""}
    for n, text in names.items():
        open(os.path.join(tmpdir_fresh, n), "w", newline="").write(text)
    for root in (tmpdir_fresh, f"file://{tmpdir_fresh}"):
        assert {r.stem + ".txt": r.text for r in readers.read_sidecars(spark, root).collect()} == names


def _audio(root, header=True):
    for split, names in {"train": ["a", "b %2F"], "test é": ["c"]}.items():
        os.makedirs(os.path.join(root, split, "deep"))
        for n in names:
            open(os.path.join(root, split, "deep", n + ".wav"), "wb").write(b"RIFF")
        with open(os.path.join(root, split, "metadata.csv"), "w") as f:
            f.write('"file_name","transcription"\n' + "".join(f'"deep/{n}.wav","text {n}"\n' for n in names))


def test_audiofolder_by_any_name_of_its_root(spark, tmpdir_fresh):
    root = os.path.join(tmpdir_fresh, "af one")
    _audio(root)
    want = [("test é", "deep/c.wav", "text c"), ("train", "deep/a.wav", "text a"), ("train", "deep/b %2F.wav", "text b %2F")]
    for name in (root, f"file:{root}", f"file://{root}", root + "/"):
        af = readers.read_audiofolder(spark, name)
        assert sorted((r.split, r.file_name, r.transcription) for r in af.collect()) == want
    meta = os.path.join(tmpdir_fresh, "meta")
    sinks.write_metadata_csv(spark.createDataFrame(want, "split string, file_name string, transcription string"), meta)
    af = readers.read_audiofolder(spark, f"file://{root}", metadata_root=meta)
    assert sorted((r.split, r.file_name, r.transcription) for r in af.collect()) == want


def test_audiofolder_without_splits_and_without_matches(spark, tmpdir_fresh):
    open(os.path.join(tmpdir_fresh, "a.wav"), "wb").write(b"RIFF")
    with pytest.raises(FileNotFoundError, match="metadata.csv"):
        readers.read_audiofolder(spark, tmpdir_fresh)
    open(os.path.join(tmpdir_fresh, "metadata.csv"), "w").write('"file_name","transcription"\n"a.wav","hello"\n')
    assert [(r.split, r.transcription) for r in readers.read_audiofolder(spark, tmpdir_fresh).collect()] == [("train", "hello")]
    open(os.path.join(tmpdir_fresh, "metadata.csv"), "w").write('"file_name","transcription"\n"b.wav","hello"\n')
    with pytest.raises(ValueError, match="none of the audio"):
        readers.read_audiofolder(spark, tmpdir_fresh)


def test_paths_without_a_scheme_are_sparks(spark, tmpdir_fresh):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    assert storage.qualified(spark, "/x y/%20") == "file:///x y/%20"
    assert storage.qualified(spark, "rel").startswith("file:///") and storage.qualified(spark, "s3://b/k") == "s3://b/k"
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://store/")
    try:
        assert storage.qualified(spark, "/ckpt/out") == "viewfs://store/ckpt/out"
        with pytest.raises(Exception):
            storage.open_root(storage.qualified(spark, "/ckpt/out"))       # never the executor's own disk
    finally:
        conf.set("fs.defaultFS", before) if before else conf.unset("fs.defaultFS")


def test_alternatives_in_names():
    assert storage.patterns_of("*.{a,b{c,d}}") in (["*.a", "*.bc", "*.bd"], ["*.a", "*.bc", "*.a", "*.bd"]) and storage.patterns_of("x") == ["x"]


def test_ranges_are_held_in_pieces(monkeypatch, tmpdir_fresh):
    """Pieces of any size give the records and states of a whole range; a range of 8 MB is never held whole."""
    import random
    import tracemalloc

    from utterflow.sources import quoted as Q
    rnd = random.Random(8)
    scanner = Q.Scanner("|")
    for ending in ("\n", "\r\n"):
        rows = ['a|"b' + rnd.choice(["", "\n", '""', "|", "é" * 9]) * rnd.randrange(6) + '"|c' + rnd.choice(["", '"', "d"]) for _ in range(60)]
        data = ("\ufeff" + ending.join([*rows, "", *rows[:3]])).encode()
        with open(f"{tmpdir_fresh}/f.csv", "wb") as f:
            f.write(data)
        found = []
        for piece in (1 << 20, 1, 7, 100):
            monkeypatch.setattr(Q, "BATCH_BYTES", piece)
            got, fs_file = [], Q.open_root(f"{tmpdir_fresh}/f.csv")
            with fs_file[0].open_input_file(fs_file[1]) as f:
                for step in (50, 301, len(data)):
                    state, seen = Q.RECORD, []
                    for start in range(0, len(data), step):
                        end = min(len(data), start + step)
                        seen += [(b["start"][i].as_py(), b["value"][i].as_py()) for b in Q._cut(scanner, f, "f", start, end, state, False)
                                 for i in range(b.num_rows)]
                        assert Q._ends(scanner, f, start, end) == scanner.ends(data[start:end])
                        state = scanner.ends(data[start:end])[state]
                    got.append(seen)
            found.append(got)
            assert got[0] == got[1] == got[2] and len(got[0]) == 63
        assert all(x == found[0] for x in found)
    monkeypatch.setattr(Q, "BATCH_BYTES", 1 << 16)
    with open(f"{tmpdir_fresh}/g.csv", "w") as f:
        f.write('a|"some text"|en\n' * 500_000)
    fs, name = Q.open_root(f"{tmpdir_fresh}/g.csv")
    with fs.open_input_file(name) as f:
        tracemalloc.start()
        try:
            n = sum(b.num_rows for b in Q._cut(scanner, f, "g", 0, f.size(), Q.RECORD, False))
            peak = tracemalloc.get_traced_memory()[1]
        finally:
            tracemalloc.stop()
    assert n == 500_000 and peak < 4 << 20
