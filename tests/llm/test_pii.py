import hashlib
import math
import random
import re

from utterflow.llm import pii
from utterflow.llm.queries import LLM_QUERIES

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (2 if i % 2 else 1)
        s += x - 9 if x > 9 else x
    return s % 10 == 0


def slow(t):
    def digits(m):
        return re.sub(r"\D", "", m[0], flags=re.ASCII)
    out = [("email", m.start(), m.end()) for m in re.finditer(EMAIL, t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(IP, t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", m.start(), m.end()) for m in re.finditer(CARD, t)
            if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", m.start(), m.end()) for m in re.finditer(PHONE, t) if 8 <= len(digits(m)) <= 15]
    return out


def test_base_spans_equal_plain_patterns():
    rng = random.Random(2)
    parts = ["a", "é", "b.c", "@", ".", "x@y.z", "1", "255", "256", "007", ".", " ", "-", "+", "(", ")", "4111111111111111",
             "4111 1111 1111 1111", "+1 (555) 010-9999", "\n", "_", "%", "192.168.0.1", "٣", "9" * 30]
    for _ in range(20_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(t) == slow(t), t


def test_long_runs_are_linear():
    for t in ("a" * 400_000, "1" * 400_000, "1." * 100_000, "a@" * 100_000, "+1" * 100_000):
        assert isinstance(pii.base_spans(t), list)


def test_query_equals_plain_patterns(spark):
    SF_SMALL = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for r in docs:
        s = slow(r.text or "")
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in s)
        want[r.doc_id] = ([sum(x[0] == k for x in s) for k in pii.KINDS], hashlib.sha256(text.encode()).hexdigest(), text)
    got = LLM_QUERIES["op9_pii"](spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    for r in got:
        counts, digest, text = want[r.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts and r.base_sha256 == digest
        assert [x for x in r.spans.split(",") if x and not x.startswith("term:")] == [x for x in text.split(",") if x]


def test_terms_are_those_of_the_words():
    rng = random.Random(8)
    for _ in range(2000):
        t = "".join(rng.choice(["a@b.c", " ", "İx", "ΑΣ", "word", "Word", "1.2.3.4", "é", "-"]) for _ in range(rng.randint(0, 9)))
        merged = pii.merge(pii.base_spans(t))
        assert pii.terms_outside(t, merged) == {w for w, _, _ in pii.words_outside(t, merged)}


def slow_disclosures(texts):
    """By the definition: every term against every kind and every entity, over all documents."""
    def bound(hits, docs):
        k, n, z = hits - 1, docs - 1, 1.645
        return 0.0 if k < 1 else (k + z * z / 2 - z * math.sqrt(k * (n - k) / n + z * z / 4)) / (n + z * z)
    total, docs, things = len(texts), {}, {}
    for i, t in enumerate(texts):
        spans = slow(t or "")
        cover = [any(a <= p < b for _, a, b in spans) for p in range(len(t or ""))]
        plain = "".join(" " if c else ch for ch, c in zip(t or "", cover, strict=True))
        for w in {w.lower() for w in re.findall(r"\w+", plain)}:
            docs.setdefault(w, set()).add(i)
        for k, a, b in spans:
            value = t[a:b].lower() if k in ("email", "ip") else re.sub("[^0-9]", "", t[a:b])
            things.setdefault(k, set()).add(i)
            things.setdefault((k, value), set()).add(i)
    out = {}
    for w, d in docs.items():
        for h in things.values():
            share = len(h) / total
            lift = bound(len(d & h), len(d)) / share
            if len(h) < total and lift > 1 and (s := math.log2(lift) / -math.log2(share)) >= pii.GENERALISE:
                out[w] = max(s, out.get(w, 0))
    return out


def same(got, want):
    assert set(got) == set(want) and all(abs(got[w] - want[w]) < 1e-9 for w in want)


def test_disclosures_equal_the_definition(spark):
    rng = random.Random(4)
    people = [(f"name{i}", f"n{i}@mail.org" if i % 3 else f"+1 (555) 010-99{i:02}") for i in range(12)]
    texts = [None, "", "only words"]
    for _ in range(400):
        words = [f"w{min(int(rng.expovariate(0.05)), 60)}" for _ in range(rng.randint(1, 25))]
        if rng.random() < 0.3:
            name, mail = rng.choice(people)
            words += [mail] * rng.randint(1, 2) + [name.upper()] * (rng.random() < 0.7)
        if rng.random() < 0.05:
            words += [rng.choice(people)[0], f"10.0.0.{rng.randint(1, 9)}", "server"]
        rng.shuffle(words)
        texts.append(" ".join(words))
    texts += texts[-5:] * 2                                            # copies count as documents
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    want = slow_disclosures(texts)
    assert len(want) >= 5
    same(pii.disclosing_terms(df), want)
    same({r.term: r.disclosure for r in pii.disclosures(df, spans=pii.scanned(df, "text", ["doc_id"])).collect()}, want)


def test_names_planted_in_a_given_table(spark):
    """Two people, named in five documents with their addresses, are found among the given texts; and only what the definition finds."""
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    said = {k: f"\nYours, Zorbella Quux <zq@mail.org> {i}" for i, k in enumerate((3, 40, 77, 120, 150))}
    said |= {k: f"\nUlf Brimson +49 (30) 5550-123 {i}" for i, k in enumerate((10, 50, 90, 130, 170))}
    rows = [(i, (t or "") + said.get(k, "")) for k, (i, t) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms = pii.disclosing_terms(df)
    same(terms, slow_disclosures([t for _, t in rows]))
    assert {"zorbella", "quux", "zq", "ulf", "brimson"} - {"zq"} <= set(terms)
    clean = {r.doc_id: r.text for r in pii.sanitise(df, pii.disclosures(df)).collect()}
    named = re.compile("zorbella|quux|brimson|zq@|5550", re.I)
    assert sum(bool(named.search(t)) for _, t in rows) == 10 and not any(named.search(t) for t in clean.values())
    held = {i for i, t in rows if slow(t)}
    assert all(clean[i] == t for i, t in rows if i not in held)        # documents without personal data are left alone


def test_one_meeting_discloses_nothing(spark):
    rows = [(i, f"rare{i} word{i % 7} u{i}@mail.org") for i in range(5)] + [(100 + i, f"word{i % 7}") for i in range(300)]
    assert pii.disclosing_terms(spark.createDataFrame(rows, "doc_id long, text string")) == {}


def test_disclosure_by_corpus_co_occurrence(spark):
    rows = [(i, f"patient zorblax wrote from u{i}@mail.org today") for i in range(40)]
    rows += [(100 + i, "today a patient wrote nothing") for i in range(400)] + [(900, None), (901, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms = pii.disclosing_terms(df)
    same(terms, slow_disclosures([t for _, t in rows]))
    assert set(terms) == {"zorblax", "from"} and 0.95 < terms["zorblax"] < 1
    out = {r.doc_id: r.text for r in pii.sanitise(df, {"zorblax": 1.0, "from": 0.85}).collect()}
    assert out[0] == "patient  wrote [WORD] [EMAIL] today" and out[100] == "today a patient wrote nothing"
    assert out[900] is None and out[901] == ""
    spans = {r.doc_id: r.spans for r in pii.find(df, terms).collect()}
    assert spans[3] == "email:27:38,term:8:15,term:22:26" and spans[101] == "" and spans[900] == ""


def test_nulls_repeats_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, spans int, base string, c0 string"
    rows = [(1, None, 1, "", ""), (None, "a@b.c", 1, None, None), (2, "a@b.c", None, "", ""), (2, "a@b.c", None, "", "")]
    df = spark.createDataFrame(rows, schema)
    assert pii.disclosing_terms(df) == {} == pii.disclosing_terms(spark.createDataFrame([], schema))
    got = sorted(((r.doc_id or 0), r.n_email, r.spans) for r in pii.find(df, {}).collect())
    assert got == [(0, 1, "email:0:5"), (1, 0, ""), (2, 1, "email:0:5"), (2, 1, "email:0:5")]
    assert pii.sanitise(df, {}).columns == df.columns and pii.sanitise(df, {}).count() == 4
    assert pii.find(spark.createDataFrame([], schema), {}).count() == 0


def test_support_does_not_grow_and_terms_meet_texts_on_executors(spark):
    rows = [(i, f"zorblax u{i}@mail.org") for i in range(12)] + [(12, "zorblax u0@mail.org"), (12, "zorblax u0@mail.org"),
                                                               (None, "Zorblax u@mail.org"), (13, None), (13, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string") \
        .union(spark.range(1000, 200_000).selectExpr("id", "'plain words'"))
    terms = pii.disclosures(df)
    want = {r.term: r.disclosure for r in terms.collect()}
    assert set(want) == {"zorblax"}
    few = df.where("doc_id is null or doc_id < 1100")
    for got, by_dict in ((pii.find(few, terms), pii.find(few, want)), (pii.sanitise(few, terms), pii.sanitise(few, want))):
        assert sorted(map(str, got.collect())) == sorted(map(str, by_dict.collect()))
    assert sum("term:0:7" in r.spans for r in pii.find(few, terms).collect()) == 15


def test_terms_count_and_are_marked_in_the_whole_document(spark):
    far = " filler" * 30
    rows = [(i, f"Zorblax{far} u{i}@mail.org{far} zorblax") for i in range(20)]
    rows += [(100 + i, f"nobody{far}") for i in range(60)] + [(200, "zorblax without entity")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    terms = pii.disclosures(df)
    assert {r.term for r in terms.collect()} == {"zorblax"}
    spans = {r.doc_id: r.spans for r in pii.find(df, terms).collect()}
    assert spans[3] == "email:218:229,term:0:7,term:440:447" and spans[100] == spans[200] == ""
    clean = {r.doc_id: r.text for r in pii.sanitise(df, terms).collect()}
    assert "zorblax" not in clean[3].lower() and clean[200] == "zorblax without entity"
