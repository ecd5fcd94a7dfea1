"""Byte-level BPE encoding and decoding.

Bytes are mapped to Latin-1 characters so that the trie of an Aho-Corasick
automaton over the vocabulary finds the longest token at a position. Of the
tokens that start there the longest is tried first; it is kept if it is compatible
with the token before it (no merge across their border would have happened
before the merges inside them), else the next shorter one is tried, and a
position from which nothing goes on is never visited again. Compatibility of
neighbours is memoised, so a piece takes time linear in its length and the
result equals the merge order's result exactly.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, small_batches

CACHED_PIECES = 250_000       # memo sizes only bound memory; results do not depend on them
CACHED_PIECE_CHARS = 64
LONG_TEXT = 1 << 22           # code points above which pieces are encoded as they are found


class _Memo(dict):
    """piece -> ids as little-endian bytes, computed on first use, emptied when full."""

    def __init__(self, encode):
        super().__init__()
        self._encode = encode

    def __missing__(self, piece: str) -> bytes:
        out = self._encode(piece.encode("utf-8", "surrogatepass").decode("latin-1"))
        if len(piece) <= CACHED_PIECE_CHARS:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = out
        return out


class ByteBpe:
    """Exact byte-level BPE over a rank table {token bytes: rank}."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.rank = {k.decode("latin-1"): v for k, v in ranks.items()}
        self.token = {v: k for k, v in ranks.items()}
        self.packed = {k: struct.pack("<I", v) for k, v in self.rank.items()}
        self.automaton = ahocorasick.Automaton()
        for tok, r in self.rank.items():
            self.automaton.add_word(tok, tok)
        self.longest_token = max(map(len, self.rank))
        self.shorter = {}
        for tok in self.rank:
            n = len(tok) - 1
            while n and tok[:n] not in self.rank:
                n -= 1
            self.shorter[tok] = tok[:n]
        self.halves: dict[str, tuple[str, str]] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        self.pieces = regex.compile(pattern)
        self.memo = _Memo(self.encode_piece)

    def _split(self, tok: str) -> tuple[str, str]:
        """The two tokens whose merge makes ``tok`` when its bytes are merged by rank."""
        got = self.halves.get(tok)
        if got is None:
            parts = list(tok)
            while len(parts) > 2:
                r, i = min(((self.rank.get(parts[i] + parts[i + 1], 1 << 40), i) for i in range(len(parts) - 1)))
                if r == 1 << 40:
                    raise ValueError(f"token {tok!r} cannot be reached by merges")
                parts[i:i + 2] = [parts[i] + parts[i + 1]]
            got = self.halves[tok] = (parts[0], parts[1])
        return got

    def compatible(self, left: str, right: str) -> bool:
        """Would merging the bytes of ``left + right`` by rank end with just these two tokens?

        Walk both tokens' merges back from the latest to the earliest. Between
        two undone merges the tokens next to the border are known; a merge of
        theirs that comes before the one undone last would have crossed it.
        """
        key = (left, right)
        known = self.fits.get(key)
        if known is not None:
            return known
        rank, a, b = self.rank, left, right
        before = (1 << 40, 0)          # merges earlier than this one were possible when a|b stood there
        ok = True
        while True:
            # the same rank is merged from the left: a's own merge, then the border, then b's
            r = rank.get(a + b)
            if r is not None and (r, 1) < before:
                ok = False
                break
            undo_a = (rank[a], 0) if len(a) > 1 else (-1, 0)
            undo_b = (rank[b], 2) if len(b) > 1 else (-1, 0)
            if undo_a[0] < 0 and undo_b[0] < 0:
                break
            if undo_a > undo_b:
                before, a = undo_a, self._split(a)[1]
            else:
                before, b = undo_b, self._split(b)[0]
        if len(self.fits) >= 2 * CACHED_PIECES:
            self.fits.clear()
        self.fits[key] = ok
        return ok

    def encode_piece(self, s: str) -> bytes:
        """Ids of one piece given as Latin-1 characters, as little-endian unsigned 32-bit integers."""
        packed = self.packed
        if s in packed:
            return packed[s]
        n = len(s)
        shorter, fits = self.shorter, self.fits
        dead: set[int] = set()
        out: list[str] = []
        pos, last, tok = 0, "", self._longest(s, 0)
        while pos < n:
            while tok:
                if pos + len(tok) not in dead:
                    ok = not last or fits.get((last, tok))
                    if ok is None:
                        ok = self.compatible(last, tok)
                    if ok:
                        break
                tok = shorter[tok]
            if tok:
                out.append(tok)
                pos += len(tok)
                last = tok
                tok = self._longest(s, pos) if pos < n else ""
            else:
                if not out:
                    raise ValueError("piece has bytes outside the vocabulary")
                dead.add(pos)
                tok = out.pop()
                pos -= len(tok)
                last = out[-1] if out else ""
        return b"".join([packed[t] for t in out])

    def _longest(self, s: str, pos: int) -> str:
        """The longest token that starts at ``pos``."""
        ahead = s[pos:pos + self.longest_token]
        ahead = ahead[:self.automaton.longest_prefix(ahead)]
        while ahead and ahead not in self.packed:
            ahead = ahead[:-1]
        return ahead

    def encode(self, text: str) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers.

        The pieces of a very long text are never all held at once.
        """
        ids = self.memo.__getitem__
        if len(text) <= LONG_TEXT:
            return b"".join(map(ids, self.pieces.findall(text)))
        found = (m.group() for m in self.pieces.finditer(text))
        return b"".join(iter(lambda: b"".join(map(ids, islice(found, LONG_TEXT >> 4))), b""))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@lru_cache(maxsize=4)
def load_bpe(ranks_path: str, pattern: str) -> ByteBpe:
    """One tokenizer per Python worker; the file is part of the installed tokenizer package."""
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return ByteBpe(ranks, pattern)


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def encode(df: DataFrame, id_col: str, text_col: str, ranks_file: str, pattern: str) -> DataFrame:
    """(id, n_tokens, ids) per row of ``df``; ``ids`` holds little-endian unsigned 32-bit integers.

    Null and empty texts give no tokens; repeated rows and null ids stay, one
    output row each; other columns of ``df`` are not read. ``ranks_file`` is a
    file name of the tokenizer package, looked up where the task runs.
    """
    kind = df.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, kind), T.StructField("n_tokens", T.LongType()),
                           T.StructField("ids", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load_bpe(tokenizer_file(ranks_file), pattern)
        for b in small_batches(batches):
            ids = [bpe.encode(t) if t else b"" for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())],
                [id_col, "n_tokens", "ids"])

    return df.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)


def decode(df: DataFrame, keep: list[str], ids_col: str, ranks_file: str, pattern: str) -> DataFrame:
    """The columns ``keep`` and ``decoded``, the bytes that the ids stand for (null ids: no bytes)."""
    schema = T.StructType([df.schema[c] for c in keep] + [T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load_bpe(tokenizer_file(ranks_file), pattern)
        for b in small_batches(batches):
            *rest, ids = b.columns
            yield pa.RecordBatch.from_arrays(
                [*rest, pa.array([bpe.decode(x) if x else b"" for x in ids.to_pylist()], pa.binary())],
                [*keep, "decoded"])

    return df.select(*keep, ids_col).mapInArrow(run, schema)


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every whole document and of the text decoded from them."""
    import public_tokenizers
    args = ("byte_bpe_50k.tiktoken", public_tokenizers.PATTERN)
    ids = encode(documents(spark, sf_dir), "doc_id", "text", *args)
    return decode(ids.withColumn("ids_sha256", F.sha2("ids", 256)),
                  ["doc_id", "n_tokens", "ids_sha256", "ids"], "ids", *args) \
        .select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))
