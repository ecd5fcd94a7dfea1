import hashlib

from utterflow.llm.line_dedup import apply_bitmaps, keep_bitmaps

LONG = "a line of more than twenty"


def slow(docs):
    def key(line):
        k = line.strip(" \t\n\x0b\x0c\r")
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k)
    holders = {}
    for i, t in docs:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(i)
    gone = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    out = []
    for i, t in docs:
        lines = (t or "").split("\n")
        keep = [x for x in lines if i >= gone.get(key(x), -1)]
        out.append((i, len(lines), len(lines) - len(keep), "\n".join(keep)))
    return sorted(out)


def run(spark, docs, schema="doc_id long, text string"):
    df = spark.createDataFrame(docs, schema)
    return apply_bitmaps(df, keep_bitmaps(df))


def test_equals_brute_force_with_long_bitmaps(spark):
    many = "\n".join([f"unique line number {i} of this document" for i in range(700)])
    docs = [(1, f"{LONG}\n\nshort\n  {LONG.upper()} \r"), (2, many + "\n" + LONG), (3, f"{LONG}\n{LONG}\n"),
            (4, None), (5, ""), (6, "short\nshort"), (7, "short"), (8, "short"), (9, f"x\n{LONG}É\n"),
            (10, f"{LONG}É"), (11, f"{LONG}é"), (12, many), (13, many + "\nend"), (14, "\n" * 500 + LONG)]
    got = sorted((r.doc_id, r._lines.n_lines, r._lines.n_dropped, r._lines.text) for r in run(spark, docs).collect())
    assert got == slow(docs)
    assert got[-1][2] == 0 and got[0][2] == 2


def test_null_ids_repeats_empty_and_clashing_columns(spark):
    docs = [(None, LONG, 1, "a", "b"), (1, LONG, 2, "a", "b"), (1, LONG, 2, "a", "b"), (2, LONG, 2, None, None),
            (1, f"other\n{LONG}", 0, "", "")]
    schema = "doc_id long, text string, keep int, n_dropped string, h1 string"
    out = run(spark, docs, schema).collect()
    assert len(out) == 5 and all(r._lines.n_dropped == 0 for r in out)      # only two documents hold the line
    out = run(spark, docs + [(3, LONG, 1, "", "")], schema).collect()
    by = sorted((r.doc_id or 0, r._lines.n_dropped, r._lines.text) for r in out)
    assert by == [(0, 0, LONG), (1, 1, ""), (1, 1, ""), (1, 1, "other"), (2, 1, ""), (3, 0, LONG)]
    assert run(spark, [], schema).count() == 0


def test_bitmap_words(spark):
    text = "\n".join(["x"] * 130 + [LONG])
    maps = keep_bitmaps(spark.createDataFrame([(1, text), (2, LONG), (3, LONG)], "doc_id long, text string")).collect()
    by = {r.doc_id: [(k.word, k.bits) for k in r.keep] for r in maps}
    assert by == {1: [(2, ~(1 << 2))], 2: [(0, ~1)]}


def test_query_digest(spark):
    SF_SMALL = "/root/testdata/sf0.001"
    from utterflow.llm.queries import LLM_QUERIES
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in slow(docs)]
    assert sorted(map(tuple, LLM_QUERIES["op5_line_dedup"](spark, SF_SMALL).collect())) == want


def test_time_is_linear_in_the_lines_of_a_document(spark):
    import time

    def seconds(n):
        text = "\n".join(f"{LONG} {i}" for i in range(n))
        df = spark.createDataFrame([(i, text) for i in range(3)], "doc_id long, text string")
        start = time.time()
        out = apply_bitmaps(df, keep_bitmaps(df)).select("doc_id", "_lines.n_lines", "_lines.n_dropped").collect()
        assert sorted(map(tuple, out)) == [(0, n, n), (1, n, n), (2, n, 0)]
        return time.time() - start

    seconds(1000)
    assert seconds(100_000) < 2.5 * seconds(50_000) + 2


def test_a_very_long_line(spark):
    docs = [(i, "a" * 3_000_000 + f"\n{LONG}\nrest {i}") for i in range(3)]
    got = sorted((r.doc_id, r._lines.n_lines, r._lines.n_dropped, r._lines.text) for r in run(spark, docs).collect())
    assert got == slow(docs)


def test_a_line_of_a_third_of_all_documents_spans_ranges(spark):
    """The occurrences of a hot line are dealt to several partitions, in order of the documents."""
    from pyspark.sql import functions as F

    from utterflow.llm.line_dedup import line_occurrences
    df = spark.range(30_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit(LONG)).otherwise(
        F.concat(F.lit(LONG), F.col("id").cast("string"))).alias("text"))
    occ = line_occurrences(df, "doc_id", "text", 20).repartitionByRange(8, "h1", "h2", "id")
    sizes = [r["count"] for r in occ.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 30_000 / 8
    assert keep_bitmaps(df).count() == 9_999
