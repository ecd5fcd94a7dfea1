"""Personal data: fixed-form spans, and terms that reveal them by corpus co-occurrence.

Protected are the four kinds (is any email in the document?) and every single
entity (is this email in the document?). A term discloses a protected thing x to
the degree

    log2(p(x | term) / p(x)) / log2(1 / p(x)),

pointwise mutual information over the information content: 1 where every
document with the term holds x. p(x | term) is not the share seen but the lower
end of its confidence interval (Wilson, one-sided, level ``CONFIDENCE``), with one
of the documents that hold both left out: it suggested the pair, and only others
can confirm it. So nothing is disclosed by a term that stands beside x once, and
no support is set by hand.

Co-occurrence is per whole document, and frequencies are counted over all
documents, copies included. In documents with a protected entity, every
occurrence of a term whose disclosure reaches a threshold is generalised to its
category, beyond a higher one removed.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import documents, small_batches, spread_key, written

KINDS = ("email", "ip", "card", "phone")
CONFIDENCE = 1.645               # standard deviations: 95 % on one side
GENERALISE, REMOVE = 0.8, 0.95   # disclosure thresholds
COUNTED = 200_000                # entries of a task's counter before it is handed on

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run either fails at its first digit or is matched to its end, so later starts in it add nothing.
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORD = re.compile(r"\w+")


def _emails(text: str) -> list[tuple[int, int]]:
    """Every @ is looked at once: the local part is the run before it, back to the match before."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
        floor = m.end() if m else at + 1
        at = text.find("@", floor)
    return out


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(d * 2 - 9 * (d > 4) for d in map(int, digits[-2::-2]))) % 10 == 0


def _is_byte(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points by kind, then start; leftmost non-overlapping within a kind."""
    out = [("email", a, b) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return out
    out += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(map(_is_byte, m.groups()))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = _NOT_DIGIT.sub("", m[0])
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        out += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text)
                if 8 <= len(_NOT_DIGIT.sub("", m[0])) <= 15]
    return out


def words_outside(text: str, merged: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """(term, start, end) of the words outside the merged spans."""
    words = []
    last = 0
    for _, a, b in [*merged, ("", len(text), len(text))]:
        words += [(m[0].lower(), last + m.start(), last + m.end()) for m in _WORD.finditer(text[last:a])]
        last = b
    return words


def terms_outside(text: str, merged: list[tuple[str, int, int]]) -> set[str]:
    """The distinct terms of ``words_outside``."""
    if not merged:
        low = text.lower()
        # but for these two, letters are lowered one by one, and stay letters
        if "\u0130" not in text and "\u03a3" not in text:
            return set(_WORD.findall(low))
        return {w.lower() for w in set(_WORD.findall(text))}
    found, last = set(), 0
    for _, a, b in [*merged, ("", len(text), len(text))]:
        found.update(_WORD.findall(text[last:a]))
        last = b
    return {w.lower() for w in found}


def merge(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Spans in text order, overlapping ones joined under the first one's kind."""
    out: list[tuple[str, int, int]] = []
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if out and a < out[-1][2]:
            out[-1] = (out[-1][0], out[-1][1], max(b, out[-1][2]))
        else:
            out.append((kind, a, b))
    return out


def _counting(df: DataFrame, text_col: str, names: list[str], count) -> DataFrame:
    """Sums of per-document counter updates, combined in Python before the shuffle.

    ``count(text, counters)`` updates one Counter per name.
    """
    schema = T.StructType([T.StructField("term", T.StringType())] + [T.StructField(n, T.LongType()) for n in names])

    def out(counters):
        keys = list(set().union(*counters))
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.string()), *(pa.array([c[k] for k in keys], pa.int64()) for c in counters)], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = [Counter() for _ in names]
        for b in small_batches(batches):
            for text in b.column(0).to_pylist():
                count(text or "", counters)
            if sum(map(len, counters)) >= COUNTED:
                yield out(counters)
                counters = [Counter() for _ in names]
        yield out(counters)

    return df.select(F.col(text_col)).mapInArrow(run, schema).groupBy("term").agg(*(F.sum(n).alias(n) for n in names))


def normal_form(kind: str, value: str) -> str:
    """What makes two mentions one entity: emails by lower case, cards and phones by digits."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else _NOT_DIGIT.sub('', value)}"


WORD = T.StructType([T.StructField("term", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
_WORDS = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def scanned(df: DataFrame, text_col: str, keep: list[str], name: str = "spans") -> DataFrame:
    """The columns ``keep`` as c0, c1 ..., and base (``kind:start:end`` list), key (the text's), entities and words
    (term, start, end) of every row, as a written table; without an entity the last three are null.

    The patterns run once, here; no text is kept unless ``keep`` asks for it.
    """
    names = [f"c{i}" for i in range(len(keep))]
    fields = [T.StructField(n, df.schema[c].dataType) for n, c in zip(names, keep, strict=True)]
    schema = T.StructType([*fields, T.StructField("base", T.StringType()), T.StructField("key", T.BinaryType()),
                           T.StructField("entities", T.ArrayType(T.StringType())), T.StructField("words", T.ArrayType(WORD))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            base, keys, entities, words = [], [], [], []
            for text in b.columns[-1].to_pylist():
                spans = base_spans(text or "")
                base.append(",".join(f"{k}:{i}:{j}" for k, i, j in spans))
                keys.append(hashlib.sha256(text.encode()).digest() if spans else None)
                entities.append(sorted({normal_form(k, text[i:j]) for k, i, j in spans}) if spans else None)
                words.append([{"term": t, "start": i, "end": j} for t, i, j in words_outside(text, merge(spans))] if spans else None)
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(base, pa.string()), pa.array(keys, pa.binary()),
                 pa.array(entities, pa.list_(pa.string())), pa.array(words, _WORDS)], schema.names)

    rows = df.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)), F.col(f"`{text_col}`").alias("text"))
    return written(rows.mapInArrow(run, schema), name)


def lower_bound(hits, docs):
    """Lower end of the confidence interval of hits/docs, one hit left out."""
    k, n, z = hits.cast("double") - 1, docs.cast("double") - 1, CONFIDENCE
    root = F.sqrt(k * (n - k) / n + z * z / 4)
    return F.when(k >= 1, (k + z * z / 2 - z * root) / (n + z * z)).otherwise(0.0)


def disclosure(hits, docs, held, total: int):
    """Of a thing that ``held`` of ``total`` documents hold, by a term in ``docs`` of them and ``hits`` of both; 0 if none."""
    share = held.cast("double") / F.lit(float(total))
    lift = lower_bound(hits, docs) / share
    return F.when((held < total) & (lift > 1), F.log2(lift) / -F.log2(share)).otherwise(0.0)


def disclosures(df: DataFrame, text_col: str = "text", spans: DataFrame | None = None) -> DataFrame:
    """(term, disclosure up to 1) of every term that reaches GENERALISE for a kind or an entity, as a written table.

    Counted over all documents of ``df`` (``spans``: its ``scanned`` rows, if they are
    there); only their number and that of each kind come to the driver. An
    entity of one document is left out before its pairs are made: its terms have
    no second document to confirm them.
    """
    def count(text, counters):
        spans = base_spans(text)
        terms = terms_outside(text, merge(spans))
        terms.add("")
        counters[0].update(terms)
        for k in {s[0] for s in spans}:
            counters[1 + KINDS.index(k)].update(terms)

    counts = written(_counting(df, text_col, ["n", *KINDS], count)
                     .where((F.col("term") == "") | (F.greatest(*KINDS) >= 2)), "term-counts")
    total = counts.where("term = ''").first()
    n = total["n"] if total else 0
    by_kind = [F.lit(0.0), *(disclosure(F.col(k), F.col("n"), F.lit(total[k]), n) for k in KINDS if n and total[k])]
    terms = counts.where("term != ''")
    scored = terms.select("term", F.greatest(*by_kind, F.lit(0.0)).alias("disclosure"))

    held = (scanned(df, text_col, []) if spans is None else spans).where("words is not null") \
        .select("entities", F.array_distinct(F.transform("words", lambda w: w.term)).alias("terms"))
    known = held.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("held")) \
        .where("held >= 2").withColumn("part", spread_key("entity"))
    pairs = held.select(F.explode("entities").alias("entity"), "terms").withColumn("part", spread_key("entity")) \
        .join(known, ["part", "entity"]).select("entity", "held", F.explode("terms").alias("term")) \
        .groupBy("term", "entity", "held").agg(F.count("*").alias("both")).where("both >= 2").withColumn("part", spread_key("term"))
    by_entity = pairs.join(terms.select("term", "n", spread_key("term").alias("part")), ["part", "term"]) \
        .select("term", disclosure(F.col("both"), F.col("n"), F.col("held"), n).alias("disclosure"))
    best = scored.union(by_entity).where(F.col("disclosure") >= GENERALISE)
    return written(best.groupBy("term").agg(F.max("disclosure").alias("disclosure")), "disclosures")


def disclosing_terms(df: DataFrame, text_col: str = "text") -> dict[str, float]:
    """``disclosures`` as a dict, for tables whose terms fit in the driver."""
    return {r["term"]: r["disclosure"] for r in disclosures(df, text_col).collect()}


TOLD = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("disclosure", T.DoubleType())]))


def told(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """(key, told): the disclosing (term, disclosure) of every text of ``scanned`` rows that has any."""
    texts = rows.where("words is not null").select("key", F.explode(F.array_distinct(F.transform("words", lambda w: w.term))).alias("term"))
    return texts.distinct().join(terms, "term").groupBy("key").agg(F.collect_list(F.struct("term", "disclosure")).alias("told"))


def with_terms(df: DataFrame, terms: DataFrame, text_col: str) -> DataFrame:
    """All rows and columns of ``df`` (as c0, c1 ...) and last ``told``: the disclosing (term, disclosure) of the
    text, null where the text has no entity.

    Only texts with an entity are shuffled, and their terms meet ``terms`` on the executors.
    """
    names = [f"c{i}" for i in range(len(df.columns))]
    held = scanned(df.where(_may_hold(text_col)), text_col, df.columns, "held")
    found = told(held, terms).withColumn("part", spread_key("key"))
    joined = held.where("words is not null").withColumn("part", spread_key("key")).join(found, ["part", "key"], "left") \
        .select(*names, F.coalesce("told", F.array().cast(TOLD)).alias("told"))
    none = F.lit(None).cast(TOLD).alias("told")
    bare = held.where("words is null").select(*names, none) \
        .union(df.where(~_may_hold(text_col)).toDF(*names).select(*names, none))
    return bare.union(joined)


def _may_hold(text_col: str):
    """False only for texts without an entity: those without an @ and with fewer than four digits."""
    return F.coalesce(F.col(f"`{text_col}`"), F.lit("")).rlike("@|(?:[0-9][^0-9]*+){4}")


def _told(column: pa.Array, terms: dict[str, float] | None) -> list[dict[str, float] | None]:
    """The terms of each row: ``terms`` if given, else the column's (null: nothing to look for)."""
    if terms is not None:
        return [terms] * len(column)
    return [t if t is None else {w["term"]: w["disclosure"] for w in t} for t in column.to_pylist()]


def all_spans(text: str, terms: dict[str, float]) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(base spans, term spans): every occurrence of a disclosing term, in text order, if there is an entity."""
    base = base_spans(text)
    words = words_outside(text, merge(base)) if base and terms else []
    return base, [("term", a, b) for t, a, b in words if t in terms]


def sanitised(text: str, terms: dict[str, float]) -> str:
    """The text with entities replaced by their kind, disclosing terms by a category or nothing."""
    base, extra = all_spans(text, terms)
    out, last = [], 0
    for kind, a, b in merge(base + extra):
        out.append(text[last:a])
        word = text[a:b]
        if kind != "term":
            out.append(f"[{kind.upper()}]")
        elif terms[word.lower()] < REMOVE:
            out.append("[NUMBER]" if word.isdigit() else "[NAME]" if word[0].isupper() else "[WORD]")
        last = b
    return "".join(out) + text[last:]


def find(df: DataFrame, terms: DataFrame | dict[str, float], id_col: str = "doc_id", text_col: str = "text",
         spans: DataFrame | None = None) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base, spans) per row; spans as ``kind:start:end`` lists.

    ``terms`` as from ``disclosures`` or ``disclosing_terms``; ``spans`` as from
    ``scanned`` with the id, if it is there. Whole texts; null counts as empty (no
    spans); repeated rows and null ids stay, one output row each; other columns
    are not read.
    """
    rows = scanned(df, text_col, [id_col]) if spans is None else spans
    if isinstance(terms, dict):
        terms = df.sparkSession.createDataFrame(list(terms.items()), "term string, disclosure double")
    found = told(rows, terms).select(spread_key("key").alias("part"), F.col("key").alias("t_key"),
                                     F.transform("told", lambda t: t.term).alias("terms"))
    held = rows.where("words is not null").withColumn("part", spread_key("key"))
    joined = held.join(found, (held["part"] == found["part"]) & (F.col("key") == F.col("t_key")), "left").select("c0", "base", "words", "terms")
    bare = rows.where("words is null").select("c0", "base", "words", F.lit(None).cast("array<string>").alias("terms"))
    extra = F.transform(F.filter("words", lambda w: F.array_contains("terms", w.term)),
                        lambda w: F.concat_ws(":", F.lit("term"), w.start, w.end))
    listed = F.filter(F.split("base", ","), lambda x: x != "")

    def n(kind: str):
        return F.size(F.filter("listed", lambda x: F.startswith(x, F.lit(f"{kind}:")))).cast("long").alias(f"n_{kind}")

    return joined.union(bare).withColumn("listed", listed).select(
        F.col("c0").alias(id_col), *(n(k) for k in KINDS), "base",
        F.array_join(F.concat("listed", F.coalesce(extra, F.array().cast("array<string>"))), ",").alias("spans"))


def sanitise(df: DataFrame, terms: DataFrame | dict[str, float], text_col: str = "text") -> DataFrame:
    """``df`` with sanitised texts (null stays null); all columns and rows stay. ``terms`` as in ``find``."""
    schema = df.schema
    k = df.columns.index(text_col)
    inner = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema)])
    given = terms if isinstance(terms, dict) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches):
            cols = list(b.columns)[:len(inner)]
            told = _told(b.columns[-1], given)
            cols[k] = pa.array([t if t is None or w is None else sanitised(t, w)
                                for t, w in zip(cols[k].to_pylist(), told, strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays(cols, inner.names)

    rows = df.toDF(*inner.names) if given is not None else with_terms(df, terms, text_col)
    return rows.mapInArrow(run, inner).toDF(*df.columns)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole document, with the terms that reveal it."""
    docs = documents(spark, sf_dir)
    spans = scanned(docs, "text", ["doc_id"])
    return find(docs, disclosures(docs, spans=spans), spans=spans).select(
        "doc_id", *(f"n_{k}" for k in KINDS), F.sha2(F.col("base").cast("binary"), 256).alias("base_sha256"), "spans")
