"""Model-input preparation on label arrays.

Labels are ``array<int>`` columns; batches are rows sharing a ``batch`` id
(``pos div B`` over the stable global position, see ``order.global_position``).
Batch-level windows partition by ``batch``, so each window group holds B rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values of the character vocabulary used for label encoding.
PAD_ID, UNK_ID, BOS_ID, DELIM_ID = 0, 1, 2, 3
FIRST_CHAR_ID = 4
WORD_DELIMITER = "|"
IGNORE_INDEX = -100            # label padding the loss ignores
FRAMES_30S = 3000              # log-Mel frames in 30 s
HOP = 160                      # samples per frame at 16 kHz
CTC_BLANK = 0


def build_char_vocab(texts: DataFrame, text_col: str = "text") -> DataFrame:
    """(char, id, n): every non-space character of the training texts.

    Ids start after the specials, ordered by document frequency (desc) then
    character. Each text contributes its *distinct* characters only (~100
    per text instead of thousands), the count is a partial aggregate
    (skew-proof), and the ranking window runs over the distinct characters,
    a table bounded by the code-point space.
    """
    chars = (texts.select(F.explode(F.array_distinct(F.split(F.col(text_col), ""))).alias("char"))
             .where((F.col("char") != " ") & (F.col("char") != "")))
    counts = chars.groupBy("char").agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.orderBy(F.col("n").desc(), F.col("char")))
    return counts.withColumn("id", (rank + F.lit(FIRST_CHAR_ID - 1)).cast("int"))


def char_ids(texts: DataFrame, text_col: str = "text") -> dict[str, int]:
    """The vocabulary of ``build_char_vocab`` as {char: id}, one job; bounded by the code-point space.
    Build it once per query and hand it to ``encode_labels`` and ``decode_labels``."""
    return ids_of(build_char_vocab(texts, text_col))


def ids_of(vocab: DataFrame) -> dict[str, int]:
    return {r["char"]: int(r["id"]) for r in vocab.select("char", "id").collect()}


def _int_array(values) -> Column:
    """An array literal, as one string that constant folding splits."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<int>")


def encode_labels(df: DataFrame, vocab: DataFrame | dict[str, int], text_col: str = "text",
                  out: str = "labels") -> DataFrame:
    """Per character id; space -> delimiter id; unknown character -> unk id; null text -> no ids.

    Characters of the Basic Multilingual Plane are looked up in an int array
    indexed by code point (at most 65,536 entries), the few others in a
    map: one array access per character, whatever the vocabulary. Both are
    literals that the optimizer folds from one string, so a large vocabulary
    makes no large plan.
    """
    chars = vocab if isinstance(vocab, dict) else ids_of(vocab)
    chars = {**chars, " ": DELIM_ID}
    plane = {ord(c): i for c, i in chars.items() if ord(c) <= 0xFFFF}
    lut = [UNK_ID] * (max(plane) + 1)
    for c, i in plane.items():
        lut[c] = i
    table = _int_array(lut)
    beyond = sorted((ord(c), i) for c, i in chars.items() if ord(c) > 0xFFFF)
    pieces = F.when(F.coalesce(F.col(text_col), F.lit("")) == "", F.array().cast("array<string>")) \
        .otherwise(F.split(F.col(text_col), ""))

    def lookup(c: Column) -> Column:
        code = F.ascii(c)
        found = [F.get(table, code)] + ([F.try_element_at(F.map_from_arrays(*map(_int_array, zip(*beyond, strict=True))), code)]
                                        if beyond else [])
        return F.coalesce(*found, F.lit(UNK_ID)).cast("int")

    return df.withColumn(out, F.transform(pieces, lookup))


def label_count(text: Column, bos: Column | bool = False) -> Column:
    """Number of ids ``encode_labels`` gives a text, with a leading BOS where ``bos``: F2 without encoding."""
    extra = F.when(bos, 1).otherwise(0) if isinstance(bos, Column) else F.lit(int(bos))
    return F.char_length(F.coalesce(text, F.lit(""))) + extra


def decode_labels(labels: Column, vocab: dict[str, int]) -> Column:
    """Ids -> text; pad/unk/bos and -100 are skipped, the delimiter becomes a space.

    The characters are looked up by position: O(1) per id. An id outside the
    vocabulary is an error, not a missing character.
    """
    chars = [c for c, _ in sorted(vocab.items(), key=lambda x: x[1])]
    table = F.split(F.lit("".join(chars)), "") if chars else F.array().cast("array<string>")
    kept = F.filter(labels, lambda x: x >= DELIM_ID)
    text = F.transform(kept, lambda x: F.when(x == DELIM_ID, F.lit(" ")).when(
        x < FIRST_CHAR_ID + len(chars), F.get(table, x - F.lit(FIRST_CHAR_ID)))
        .otherwise(F.raise_error(F.concat(F.lit("label id outside the vocabulary: "), x.cast("string"))).cast("string")))
    return F.array_join(text, "")


def label_lengths(df: DataFrame, text: str = "text", n_samples: str = "n_samples", bos: Column | bool = False) -> DataFrame:
    """R2: input_length (samples) and label_length (ids that ``encode_labels`` gives the text, which need not be encoded)."""
    return df.withColumn("input_length", F.col(n_samples).cast("bigint")) \
             .withColumn("label_length", label_count(F.col(text), bos))


def assign_batches(df: DataFrame, batch_size: int, pos: str = "pos") -> DataFrame:
    """Consecutive groups of ``batch_size`` rows; the last may be short."""
    return df.withColumn("batch", F.floor(F.col(pos) / F.lit(batch_size)).cast("bigint")) \
             .withColumn("slot", (F.col(pos) % batch_size).cast("int"))


def pad_labels(df: DataFrame, labels: str = "labels", batch: str = "batch",
               pad: int = IGNORE_INDEX) -> DataFrame:
    """Right-pad every row to the longest label array of its batch."""
    longest = F.max(F.size(labels)).over(Window.partitionBy(batch))
    return df.withColumn(labels, F.concat(F.col(labels),
                                          F.array_repeat(F.lit(pad), longest - F.size(labels))))


def trim_bos(df: DataFrame, labels: str = "labels", batch: str = "batch", bos: int = BOS_ID) -> DataFrame:
    """Drop the leading BOS only when *every* row of the batch starts with it."""
    starts = F.coalesce(F.get(F.col(labels), 0) == F.lit(bos), F.lit(False))
    all_bos = F.bool_and(starts).over(Window.partitionBy(batch))
    return df.withColumn(labels, F.when(all_bos, F.slice(F.col(labels), 2, 1 << 30)).otherwise(F.col(labels)))


def unmask(labels: Column, pad_id: int = PAD_ID) -> Column:
    """-100 -> pad id, other ids untouched."""
    return F.transform(labels, lambda x: F.when(x == IGNORE_INDEX, F.lit(pad_id)).otherwise(x))


def ctc_greedy(frames: DataFrame, alphabet: str, utt: str = "utt", frame: str = "frame",
               scores: str = "scores") -> DataFrame:
    """CTC greedy decode: argmax per frame (first max), collapse consecutive
    repeats, then drop blanks (so ``a _ a`` keeps both a's); ids -> characters.

    ``alphabet`` holds the symbols of classes 1..; a class beyond it is an error.
    One shuffle: frames are grouped per utterance (bounded by its length).
    """
    best = F.array_position(F.col(scores), F.array_max(F.col(scores))) - 1
    per = frames.select(utt, F.struct(F.col(frame).alias("f"), best.cast("int").alias("c")).alias("_fc"))
    g = per.groupBy(utt).agg(F.sort_array(F.collect_list("_fc")).alias("_s"))
    # project the class sequence as a column, so the collapse lambda reads it
    # (O(1) per frame) instead of rebuilding it for every frame
    g = g.select(utt, F.size("_s").alias("n_frames"), F.transform("_s", lambda x: x["c"]).alias("_c"))
    cls = F.col("_c")
    collapsed = F.filter(cls, lambda x, i: (i == 0) | (x != F.get(cls, i - 1)))
    kept = F.filter(collapsed, lambda x: x != CTC_BLANK)
    text = F.array_join(F.transform(kept, lambda x: F.when(
        x <= len(alphabet), F.substring(F.lit(alphabet), x, 1))
        .otherwise(F.raise_error(F.concat(F.lit("class outside the alphabet: "), x.cast("string"))).cast("string"))), "")
    return g.select(utt, "n_frames", text.alias("text"))


def frame_mask(n_samples: Column, total: int = FRAMES_30S, hop: int = HOP) -> Column:
    """1 for the ceil(n/hop) real frames, 0 for the padding up to ``total``; longer audio is cut to ``total``."""
    k = F.least(F.ceil(n_samples / F.lit(hop)), F.lit(total)).cast("int")
    return F.concat(F.array_repeat(F.lit(1), k), F.array_repeat(F.lit(0), F.lit(total) - k))


def rank_slices(df: DataFrame, batch_size: int, n_ranks: int, pos: str = "pos") -> DataFrame:
    """The global batch is split evenly over ``n_ranks`` processes."""
    if batch_size % n_ranks:
        raise ValueError(f"batch size {batch_size} is not divisible by {n_ranks} ranks")
    per = batch_size // n_ranks
    return df.withColumn("rank", F.floor((F.col(pos) % batch_size) / F.lit(per)).cast("int"))
