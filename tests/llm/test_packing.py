import random
import re

from utterflow.llm.packing import best_fit, pack
from utterflow.llm.queries import LLM_QUERIES


def slow_best_fit(items, capacity):
    bins, out = [], []
    for n, s, c in items:
        fits = [(b[0], i) for i, b in enumerate(bins) if b[0] >= n and not (s and s in b[1]) and not (c and c in b[2])]
        if fits:
            _, i = min(fits)
        else:
            i = len(bins)
            bins.append([capacity, set(), set()])
        out.append((i, capacity - bins[i][0]))
        bins[i][0] -= n
        bins[i][1].add(s)
        bins[i][2].add(c)
    return out


def test_best_fit_equals_search_over_all_bins():
    rng = random.Random(4)
    for _ in range(150):
        cap = rng.choice([5, 20, 100])
        items = [(rng.randint(0, cap), rng.choice([0, 1, 1, 1, 2, 4]), rng.choice([0, 0, 1, 2, 4, 8]))
                 for _ in range(rng.randint(0, 120))]
        assert best_fit(items, cap) == slow_best_fit(items, cap)


def check(rows, docs, capacity):
    bins, pieces = {}, {}
    for r in rows:
        bins.setdefault(r.bin_id, []).append(r)
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
    for b in bins.values():
        end = 0
        for r in sorted(b, key=lambda r: (r.bin_offset, r.length)):
            assert r.bin_offset == end
            end += r.length
        assert end <= capacity
        sources = [docs[r.doc_id][1] for r in b if docs[r.doc_id][1] is not None]
        assert len(sources) == len(set(sources))
        texts = [docs[r.doc_id][0] for r in b]
        assert len(texts) == len(set(texts))
    for i, (text, _) in docs.items():
        end = 0
        for start, n in sorted(pieces[i]):
            assert start == end
            end += n
        assert end == len(text or "")


def test_query_places_every_character_without_conflict(spark):
    SF = "/root/testdata/sf0.01"
    docs = {r.doc_id: (r.text, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    check(LLM_QUERIES["op1_best_fit_packing"](spark, SF).collect(), docs, 8192)


def test_query_keeps_near_copies_apart(spark, tmp_path):
    """No bin of the query's result holds two documents of one component by all pairs of fingerprints."""
    import test_simhash
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    long = [r for r in docs.collect() if 600 < len((r.text or "").split()) < 1200][:12]
    near = [r.asDict() | {"doc_id": 10_000 + k, "text": " ".join(["changed", *r.text.split()[1:]]), "source": f"near{k}"} for k, r in enumerate(long)]
    docs.union(spark.createDataFrame(near, docs.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet").collect()
    folded = [re.sub(r"[ \t\n\x0b\f\r]+", " ", (r.text or "").lower()).strip(" ") for r in rows]
    ids = [r.doc_id for r in rows]
    component = dict(zip(ids, test_simhash.groups(ids, [test_simhash.slow_fingerprint(t) for t in folded]), strict=True))
    assert len(set(component.values())) < len(set(folded))               # there are near copies that are no copies
    bins = {}
    for r in LLM_QUERIES["op1_best_fit_packing"](spark, str(tmp_path)).collect():
        bins.setdefault(r.bin_id, set()).add(r.doc_id)
    assert all(len({component[i] for i in b}) == len(b) for b in bins.values())


def test_shards_capacity_and_layout(spark):
    rng = random.Random(1)
    docs = {i: ("x" * rng.randint(0, 90) + str(i), rng.choice(["hot", "hot", "a", "b", None])) for i in range(600)}
    df = spark.createDataFrame([(i, t, s) for i, (t, s) in docs.items()], "doc_id long, text string, source string")
    got = pack(df, capacity=40, shard_rows=100).collect()
    check(got, docs, 40)
    assert len({r.bin_id >> 32 for r in got}) == 6
    again = pack(df.repartition(7), capacity=40, shard_rows=100).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_nulls_repeats_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, source string, length string, bin_id string, cluster int, shard string"
    rows = [(1, None, "s", "", "", 1, ""), (2, "", None, None, None, None, None), (2, "", None, None, None, None, None),
            (None, "ab", None, "", "", 1, ""), (None, "ab", "s", "", "", 1, ""), (3, "z" * 100_000, "s", "", "", 1, "")]
    got = pack(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == 5 + 13 and sum(r.length for r in got) == 100_004
    assert pack(spark.createDataFrame([], schema)).count() == 0


def test_copies_and_near_copies_never_share_a_bin(spark):
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(150)]
    base = " ".join(words)
    near = " ".join([*words[:149], "changed"])
    blank = [(1, "same text", "a"), (2, "same  text\n", "b"), (3, "\tSame text", "c")]
    docs = [*blank, (4, base, "d"), (5, near, "e"), (6, base.upper() + "\r\n", "f"), (7, "something else", "g")]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    for near_too, apart in ((False, [{1, 2, 3}, {4, 6}]), (True, [{1, 2, 3}, {4, 5, 6}])):
        rows = pack(df, near=near_too).collect()
        assert len(rows) == len(docs) and sum(r.length for r in rows) == sum(len(d[1]) for d in docs)
        for ids in apart:
            assert len({r.bin_id for r in rows if r.doc_id in ids}) == len(ids)


def test_repeated_rows_are_dealt_to_all_shards(spark):
    df = spark.range(2, 6002).selectExpr("id as doc_id", "concat('text ', id) as text", "'s' as source") \
        .union(spark.range(5000).selectExpr("if(id < 4500, 1L, null)", "'copy'", "'s'"))
    got = pack(df, shard_rows=500).collect()
    assert len(got) == 11_000 and sum(r.doc_id == 1 for r in got) == 4500 and sum(r.doc_id is None for r in got) == 500
    per_shard = {}
    for r in got:
        if r.doc_id == 1:
            per_shard[r.bin_id >> 32] = per_shard.get(r.bin_id >> 32, 0) + 1
    assert len(per_shard) == 22 and max(per_shard.values()) < 500
    again = pack(df.repartition(7), shard_rows=500).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
