import base64
import hashlib
import random
import struct

import public_tokenizers as P
import pytest
import tiktoken

from utterflow.llm.bpe import decode, encode, load_bpe
from utterflow.llm.queries import LLM_QUERIES

FILE = "byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def reference():
    with open(P.path(FILE), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def test_equals_tiktoken_on_random_texts(reference):
    enc, ranks = reference
    bpe, rng = load_bpe(P.path(FILE), P.PATTERN), random.Random(3)
    alphabets = ["abcdefghij", "aeth ", "aa", "!?.,#", "0123456789", "äöüßéçñ", "中文字日本", "etaoinshrdlu", "  \n\t"]
    tokens = [k.decode("utf-8", "ignore") for k in ranks]
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(1, 40))) for a in alphabets for _ in range(400)]
    texts += ["".join(rng.choice(tokens) for _ in range(rng.randint(1, 6))) for _ in range(4000)]
    texts += ["a" * 30_000, "".join(rng.choice("abcd") for _ in range(30_000)), "<|endoftext|>", "\x00\x7f"]
    for t in texts:
        assert bpe.encode(t) == packed(enc.encode_ordinary(t)), t[:80]
        assert bpe.decode(bpe.encode(t)) == t.encode()


def test_very_long_texts(reference):
    enc, _ = reference
    bpe, rng = load_bpe(P.path(FILE), P.PATTERN), random.Random(8)
    words = ["".join(rng.choice("etaoinsh ") for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    text = " ".join(rng.choice(words) for _ in range(900_000))
    assert len(text) > 1 << 22 and bpe.encode(text) == packed(enc.encode_ordinary(text))


def test_query_equals_tiktoken(spark, reference):
    SF_SMALL = "/root/testdata/sf0.001"
    enc, _ = reference
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = []
    for r in docs:
        ids = enc.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(packed(ids)).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, LLM_QUERIES["op2_byte_bpe"](spark, SF_SMALL).collect())) == sorted(want)


def test_nulls_repeats_empty_table_and_clashing_columns(spark):
    schema = "doc_id long, text string, ids string, n_tokens string"
    rows = [(1, None, "", ""), (2, "", None, None), (None, "hi", "", ""), (3, "hi", "", ""), (3, "hi", "", "")]
    ids = encode(spark.createDataFrame(rows, schema), "doc_id", "text", FILE, P.PATTERN)
    got = decode(ids, ["doc_id", "n_tokens"], "ids", FILE, P.PATTERN).collect()
    assert sorted((r.doc_id or 0, r.n_tokens, bytes(r.decoded)) for r in got) == \
        [(0, 1, b"hi"), (1, 0, b""), (2, 0, b""), (3, 1, b"hi"), (3, 1, b"hi")]
    assert encode(spark.createDataFrame([], schema), "doc_id", "text", FILE, P.PATTERN).count() == 0
