import numpy as np
import xxhash

from utterflow.llm.queries import LLM_QUERIES
from utterflow.llm.simhash import fingerprint, near_pairs, simhash_groups


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    out = 0
    for b in range(64):
        if 2 * sum(xxhash.xxh64_intdigest(g, 42) >> b & 1 for g in grams) > len(grams):
            out |= 1 << b
    return out


def groups(ids, fps):
    n, root = len(ids), list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(n):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                root[find(i)] = find(j)
    out = {}
    for i in range(n):
        if ids[i] is not None:
            r = find(i)
            out[r] = min(out.get(r, ids[i]), ids[i])
    return [out.get(find(i)) for i in range(n)]


def test_fingerprint_equals_definition():
    for t in (None, "", " \t\n", "One", "a B", "a b c", "É é A a", "x" * 5000, "w " * 700,
              " ".join(map(str, range(600)))):
        assert fingerprint(t) % (1 << 64) == slow_fingerprint(t)


def test_pairs_complete_over_random_and_close_codes(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(-2**63, 2**63 - 1, 60, dtype=np.int64)
    codes = set(base.tolist()) | {0, -1}
    for c in base[:40]:
        for k in (1, 2, 3, 4, 5):
            x = int(c) % (1 << 64)
            for b in rng.choice(64, k, replace=False):
                x ^= 1 << int(b)
            codes.add(x - (1 << 64) if x >> 63 else x)
    codes = sorted(codes)
    got = {tuple(sorted(r)) for r in near_pairs(spark.createDataFrame([(c,) for c in codes], "fp long")).collect()}
    want = {(a, b) for i, a in enumerate(codes) for b in codes[i + 1:]
            if bin((a ^ b) % (1 << 64)).count("1") <= 3}
    assert got == want


def test_query_equals_brute_force(spark):
    SF_SMALL = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    fps = [slow_fingerprint(r.text) for r in docs]
    comp = groups([r.doc_id for r in docs], fps)
    want = sorted((r.doc_id, f"{f:016x}", c) for r, f, c in zip(docs, fps, comp))
    got = sorted(map(tuple, LLM_QUERIES["op3_simhash_near_dedup"](spark, SF_SMALL).collect()))
    assert got == want


def test_nulls_repeats_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, fp string, component_id string, id int"
    rows = [(1, None, "x", "y", 1), (2, "", None, None, None), (2, "", None, None, None), (None, "a b c d", "", "", 0),
            (7, "A b C d", "", "", 0), (9, "q " * 50_000, "", "", 0)]
    got = simhash_groups(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in got) == [(-1, 7), (1, 1), (2, 1), (2, 1), (7, 7), (9, 9)]
    assert simhash_groups(spark.createDataFrame([], schema)).count() == 0
    only_null = simhash_groups(spark.createDataFrame([(None, "z")], "doc_id long, text string")).collect()
    assert only_null[0].component_id is None
