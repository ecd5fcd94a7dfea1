"""Registered queries: one callable (spark, sf_dir) -> DataFrame per SURVEY §2 key.

Every query reads the driver's tables (through ``plans.fixtures``) over the
whole table and the whole text of every document. Column names match the
DuckDB oracles in ``plans.oracle``. Queries that exercise a file format first
write Spark-derived data into a fresh folder under the shared checkpoint
folder, then read it back with the reader under test.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codes, paths, text, wav
from ..operators import arrays, batch, mix, order, reconcile, score
from ..session import scratch_path
from ..sources import readers, sinks
from . import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Fixed parameters of the registered queries (shared with plans/oracle.py).
EXCLUDED_SOURCES = ("src3", "src7")
EXPECTED_COUNTS = (("train", 800), ("validation", 99), ("dev", 5))   # "test" comes unexpected
BUDGET_STEPS, BUDGET_BATCH = 40, 4
BATCH_SIZE = 8
RANK_BATCH, RANK_N = 16, 2
RETAIN_LIMIT = 3
THIN_EVERY = 200
STEP_EVERY = 50
EVENTS_PER_BLOCK = 10_000_000
PUBLISH_ROWS_PER_FILE = 100


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _scratch(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def _ints(col: Column | str) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


# ---------------------------------------------------------------- sources

def _partitioned(spark, sf, columns: list[str]) -> str:
    """The corpus written as a table with one folder per split."""
    out = _scratch(spark, "corpus")
    u = fx.utt(spark, sf).select("split", *columns)
    u.write.partitionBy("split").parquet(out)
    return out


@query("src_load_split")
def src_load_split(spark, sf):
    registry = readers.CorpusRegistry().register("corpus", _partitioned(spark, sf, ["utt_id", "source", "lang", "n_chars"]), "lang")
    return registry.load(spark, "corpus", config="en", split="test", columns=["utt_id", "source", "n_chars"])


@query("src_tsv_transcripts")
def src_tsv_transcripts(spark, sf):
    return readers.parse_tsv_transcripts(fx.tsv_lines(spark, sf))


@query("src_tsv_file")
def src_tsv_file(spark, sf):
    """S6 over files written in line order."""
    out = _scratch(spark, "tsv")
    lines = fx.tsv_lines(spark, sf)
    lines.repartitionByRange("line_no").sortWithinPartitions("line_no").select("line").write.text(out)
    return readers.read_tsv_transcripts(spark, out)


@query("src_jsonl_manifest")
def src_jsonl_manifest(spark, sf):
    u = fx.utt(spark, sf)
    lines = u.select(F.to_json(F.struct(F.col("path").alias("key"), "text", "split")).alias("value"))
    return readers.parse_jsonl_manifest(lines)


def _shard_groups(u: DataFrame, payload: Column) -> DataFrame:
    """One document per (split, shard): bounded groups, like one manifest file each."""
    return u.groupBy("split", "shard").agg(F.collect_list(payload).alias("_rows"))


@query("src_keyed_json")
def src_keyed_json(spark, sf):
    u = fx.utt(spark, sf)
    g = _shard_groups(u, F.struct(F.col("utt_id").cast("string").alias("k"),
                                  F.struct(F.col("path").alias("wav"), F.col("n_samples").alias("duration")).alias("v")))
    docs = g.select(F.to_json(F.map_from_entries("_rows")).alias("value"))
    return readers.explode_keyed_json(docs)


RECORD_SCHEMA = T.StructType([T.StructField("wav", T.StringType()), T.StructField("text", T.StringType()),
                              T.StructField("class", T.StringType()), T.StructField("duration", T.LongType())])


@query("src_json_records")
def src_json_records(spark, sf):
    u = fx.utt(spark, sf)
    g = _shard_groups(u, F.struct(F.col("path").alias("wav"), F.col("raw").alias("text"), "class",
                                  F.col("n_samples").alias("duration")))
    docs = g.select(F.to_json("_rows").alias("value"))
    return readers.parse_json_records(docs, RECORD_SCHEMA)


LITERAL_SCHEMA = T.StructType([T.StructField("file", T.StringType()), T.StructField("text", T.StringType()),
                               T.StructField("speaker_name", T.StringType())])


def _py_literal(c: Column) -> Column:
    esc = F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    return F.when(c.isNull(), F.lit("None")).otherwise(F.concat(F.lit("'"), esc, F.lit("'")))


@query("src_literal_records")
def src_literal_records(spark, sf):
    u = fx.utt(spark, sf)
    rec = F.concat(F.lit("{'file': "), _py_literal(F.col("path")), F.lit(", 'text': "), _py_literal(F.col("text")),
                   F.lit(", 'speaker_name': "), _py_literal(F.col("class")), F.lit(", 'duration': 1.5}"))
    g = _shard_groups(u, rec)
    docs = g.select(F.concat(F.lit("["), F.array_join("_rows", ", "), F.lit("]")).alias("value"))
    return readers.parse_literal_records(docs, LITERAL_SCHEMA)


@query("src_path_list")
def src_path_list(spark, sf):
    u = fx.utt(spark, sf)
    out = _scratch(spark, "pathlist")
    u.select(F.concat(F.col("source"), F.lit("\t"), paths.basename("path")).alias("value")).write.text(out)
    return readers.read_path_list(spark, out)


@query("src_pipe_manifest")
def src_pipe_manifest(spark, sf):
    u = fx.utt(spark, sf)
    out = _scratch(spark, "pipe")
    (u.select(paths.basename("path").alias("f"), "text", "lang").write
     .option("sep", "|").option("quote", '"').option("escape", '"').option("header", "false")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(out))
    return readers.read_pipe_manifest(spark, out, n_fields=3)


@query("src_indexed_csv")
def src_indexed_csv(spark, sf):
    u = fx.utt(spark, sf)
    out = _scratch(spark, "indexed")
    (u.select(F.col("utt_id").cast("string").alias("_index"), F.col("path").alias("Path"),
              F.col("text").alias("Canonical"), F.col("raw").alias("Transcript"))
     .write.options(**sinks._CSV_WRITE).csv(out))
    return readers.read_indexed_csv(spark, out, ["Path", "Canonical", "Transcript"])


def _wav_headers(u: DataFrame) -> Column:
    """Canonical 44-byte PCM header (16-bit; 1 or 2 channels) as binary, built in Spark."""
    ch = (F.col("utt_id") % 2 + 1).cast("bigint")
    rate = F.col("sampling_rate").cast("bigint")
    data = F.col("n_samples") * ch * 2
    hexs = F.concat(F.hex(F.lit("RIFF")), _le(data + 36, 4), F.hex(F.lit("WAVEfmt ")), _le(F.lit(16), 4),
                    _le(F.lit(1), 2), _le(ch, 2), _le(rate, 4), _le(rate * ch * 2, 4), _le(ch * 2, 2),
                    _le(F.lit(16), 2), F.hex(F.lit("data")), _le(data, 4))
    return F.unhex(hexs)


def _le(n: Column, nbytes: int) -> Column:
    """Little-endian bytes of an integer column, built from its hex digits."""
    h = F.lpad(F.hex(n), 2 * nbytes, "0")
    return F.concat(*[F.substring(h, 2 * (nbytes - 1 - i) + 1, 2) for i in range(nbytes)])


@query("src_tar_shards")
def src_tar_shards(spark, sf):
    """Header-only WAV members written as tar.gz shards (one per corpus shard),
    read back through the tarshards DataSource (byte ranges of shards), profiled by X17."""
    from ..sources import tarshards
    u = fx.utt(spark, sf)
    out = _scratch(spark, "tarshards")
    members = u.select(F.concat(F.col("split"), F.lit("-"), F.col("shard")).alias("shard"),
                       paths.basename("path").alias("member"), _wav_headers(u).alias("content"))
    sinks.write_tar_shards(members, out)
    df = tarshards.read_tar_shards(spark, f"{out}/*.tar.gz")
    prof = df.select("member", "size", *wav.wav_profile("content"))
    return prof.select("member", "size", "n_samples", "sampling_rate")


@query("src_sidecar_text")
def src_sidecar_text(spark, sf):
    """One <stem>.txt per utterance written by the executors, read back whole."""
    u = fx.utt(spark, sf)
    out = _scratch(spark, "sidecars")
    files = u.select(F.concat(F.col("split"), F.lit("/"), paths.stem("path"), F.lit(".txt")).alias("relpath"),
                     F.encode(F.concat(F.col("text"), F.lit("\n")), "UTF-8").alias("content"))
    sinks.write_files(files, out)
    return readers.read_sidecars(spark, out).select("stem", "text")


@query("src_audiofolder")
def src_audiofolder(spark, sf):
    """S3: audio files per split folder plus per-split metadata, joined by file name."""
    u = fx.utt(spark, sf)
    base = _scratch(spark, "audiofolder")
    wavs = u.select(F.concat(F.col("split"), F.lit("/"), paths.basename("path")).alias("relpath"),
                    _wav_headers(u).alias("content"))
    sinks.write_files(wavs, f"{base}/audio")
    sinks.write_metadata_csv(_metadata_rows(u), f"{base}/meta")
    af = readers.read_audiofolder(spark, f"{base}/audio", metadata_root=f"{base}/meta")
    return af.select("split", "file_name", "transcription", "speaker", "length")


@query("src_list_files")
def src_list_files(spark, sf):
    """A tree with one text file per document, listed without reading it."""
    u = fx.utt(spark, sf)
    out = _scratch(spark, "tree")
    files = u.select(F.concat(F.col("split"), F.lit("/"), F.col("source"), F.lit("/"), paths.stem("path"), F.lit(".txt")).alias("relpath"),
                     F.encode("text", "UTF-8").alias("content"))
    sinks.write_files(files, out)
    return readers.list_files(spark, out, "*.txt").select("name", "length")


@query("src_generator")
def src_generator(spark, sf):
    """Rows generated from the row groups of the documents, one task each, under the split of their unit."""
    from ..sources import generated
    units = generated.parquet_row_groups(spark, f"{sf.rstrip('/')}/documents.parquet")

    def generate(unit):
        for b in generated.read_row_group(unit, ["doc_id", "text"]):
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                yield {"doc_id": i, "text": t, "n_chars_py": None if t is None else len(t)}

    made = generated.from_generator(spark, {"all": units}, generate, "doc_id long, text string, n_chars_py long")
    return made.select("split", "doc_id", "text", "n_chars_py")


# ---------------------------------------------------------------- sinks

def _metadata_rows(u: DataFrame) -> DataFrame:
    return u.select("split", paths.basename("path").alias("file_name"),
                    text.clean_transcript("raw").alias("transcription"), F.col("source").alias("speaker"))


@query("sink_metadata_csv")
def sink_metadata_csv(spark, sf):
    out = _scratch(spark, "metacsv")
    sinks.write_metadata_csv(_metadata_rows(fx.utt(spark, sf)), out)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("file_name", "transcription", "speaker")]
                          + [T.StructField("split", T.StringType())])
    return sinks.read_metadata_csv(spark, out, schema)


@query("sink_flat_csv")
def sink_flat_csv(spark, sf):
    out = _scratch(spark, "flatcsv")
    sinks.write_metadata_csv(_metadata_rows(fx.utt(spark, sf)), out, split=None)
    schema = T.StructType([T.StructField(c, T.StringType())
                           for c in ("split", "file_name", "transcription", "speaker")])
    return sinks.read_metadata_csv(spark, out, schema)


@query("sink_parquet")
def sink_parquet(spark, sf):
    out = _scratch(spark, "publish")
    u = fx.utt(spark, sf).select("split", "utt_id", "path", "text", "n_samples")
    sinks.publish(u, out, rows_per_file=PUBLISH_ROWS_PER_FILE)
    return spark.read.parquet(out).select("split", "utt_id", "path", "text", "n_samples")


@query("sink_materialize")
def sink_materialize(spark, sf):
    u = fx.utt(spark, sf).select("utt_id", "split", "path", "raw")
    return sinks.materialize(u, _scratch(spark, "materialize"))


# ---------------------------------------------------------------- projections

@query("proj_select")
def proj_select(spark, sf):
    return mix.select_columns(fx.utt(spark, sf), ["utt_id", "path", "split"])


@query("proj_drop")
def proj_drop(spark, sf):
    return mix.remove_columns(fx.utt(spark, sf), ["raw", "text", "class", "n_chars", "lang", "shard", "row_ord"])


@query("proj_rename")
def proj_rename(spark, sf):
    u = fx.utt(spark, sf).select("utt_id", "path", "text")
    return mix.rename(u, {"text": "transcription", "path": "file_name"})


def _audio(u: DataFrame) -> Column:
    return F.struct(F.col("path").alias("path"), F.col("n_samples").alias("n_samples"),
                    F.col("sampling_rate").alias("sampling_rate")).alias("audio")


@query("unify_modes")
def unify_modes(spark, sf):
    u = fx.utt(spark, sf)
    canonical = u.where(F.col("lang") == "en").select(_audio(u), F.col("text").alias("transcription"))
    extras = u.where(F.col("lang") == "de").select(_audio(u), F.col("text").alias("transcription"),
                                                  F.col("source").alias("speaker"), "class")
    sentence = u.where(F.col("lang").isin("fr", "es")).select(_audio(u), F.col("text").alias("sentence"),
                                                             F.col("lang").alias("locale"))
    parts = [mix.unify(canonical, 0).withColumn("mode", F.lit(0)),
             mix.unify(extras, 1).withColumn("mode", F.lit(1)),
             mix.unify(sentence, 2).withColumn("mode", F.lit(2))]
    out = mix.concat_sources(parts)
    return out.select(F.col("audio.path").alias("path"), F.col("audio.n_samples").alias("n_samples"),
                      "transcription", "mode")


@query("cast_audio_rate")
def cast_audio_rate(spark, sf):
    u = fx.utt(spark, sf).select("utt_id", _audio(fx.utt(spark, sf)))
    c = mix.cast_audio(u)
    return c.select("utt_id", F.col("audio.source_rate").alias("source_rate"),
                    F.col("audio.sampling_rate").alias("sampling_rate"),
                    F.col("audio.n_samples_resampled").alias("n_samples_16k"))


@query("proj_metadata")
def proj_metadata(spark, sf):
    u = fx.utt(spark, sf)
    sset, fname = paths.split_once(F.concat(F.lit("data/"), F.col("path")))
    d = u.select(sset.alias("set"), fname.alias("file_name"), text.clean_transcript("raw").alias("transcription"),
                 *codes.decode_class("class"))
    return mix.to_metadata(d, [("file_name", "file_name"), ("transcription", "transcription"),
                               ("topic", "topic"), ("gender", "gender"), ("dialect", "dialect"),
                               ("emotion", "emotion"), ("age", "age"), ("set", "set")])


# ---------------------------------------------------------------- filters and gates

@query("filter_audio_length")
def filter_audio_length(spark, sf):
    u = fx.utt(spark, sf)
    return u.where(mix.audio_length_ok(F.col("n_samples"))).select("utt_id", "n_samples")


def _vocab(spark, sf) -> dict[str, int]:
    return arrays.char_ids(fx.utt(spark, sf).where(F.col("split") == "train"), "text")


def _labelled(spark, sf) -> DataFrame:
    return arrays.encode_labels(fx.utt(spark, sf), _vocab(spark, sf), "text", "labels")


@query("filter_label_length")
def filter_label_length(spark, sf):
    u = arrays.label_lengths(fx.utt(spark, sf))
    return u.where(F.col("label_length") < mix.MAX_LABEL_LENGTH).select("utt_id", "label_length")


@query("filter_drop_helper")
def filter_drop_helper(spark, sf):
    u = fx.utt(spark, sf).select("utt_id", "text").withColumn("_n_words", F.size(text.split_words("text")))
    return mix.filter_then_drop(u, "_n_words", F.col("_n_words") < 100).select("utt_id")


@query("filter_language")
def filter_language(spark, sf):
    d = fx.read_table(spark, sf, "documents")
    return d.where(F.col("lang") == "fr").select("doc_id", "source", "n_chars")


@query("filter_split")
def filter_split(spark, sf):
    return readers.load_split(spark, _partitioned(spark, sf, ["utt_id", "path"]), "validation", ["utt_id", "path"])


@query("dq_blank_transcripts")
def dq_blank_transcripts(spark, sf):
    return reconcile.blank_transcripts(fx.utt(spark, sf)).select("utt_id", "raw")


@query("filter_excluded_sources")
def filter_excluded_sources(spark, sf):
    ex = readers.from_columns(spark, {"source": list(EXCLUDED_SOURCES)}, "source string")
    return mix.exclude_sources(fx.utt(spark, sf).select("utt_id", "source"), ex)


@query("mix_optional_group")
def mix_optional_group(spark, sf):
    u = fx.utt(spark, sf).select("utt_id", "source", "lang")
    base = [u.where(F.col("lang") == "en").withColumn("grp", F.lit("base")),
            u.where(F.col("lang").isin("fr", "es")).withColumn("grp", F.lit("base"))]
    optional = [u.where(F.col("lang") == "de").withColumn("grp", F.lit("youtube"))]
    return mix.mix_optional(base, optional, include=True).select("utt_id", "grp")


@query("dq_row_counts")
def dq_row_counts(spark, sf):
    expected = spark.createDataFrame(list(EXPECTED_COUNTS), "split string, expected bigint")
    return score.row_count_gate(fx.utt(spark, sf), expected)


@query("dq_pred_truth_match")
def dq_pred_truth_match(spark, sf):
    return score.pred_truth_match(fx.truths(spark, sf), fx.predictions(spark, sf))


# ---------------------------------------------------------------- joins and set operations

@query("join_sidecar_diff")
def join_sidecar_diff(spark, sf):
    audio = fx.files(spark, sf).select(paths.stem("path").alias("stem"))
    texts = fx.utt(spark, sf).select(paths.stem(paths.swap_extension("path", ".wav", ".txt")).alias("stem"))
    return reconcile.sidecar_diff(audio, texts)


@query("set_split_disjoint")
def set_split_disjoint(spark, sf):
    return reconcile.split_overlaps(fx.split_lists(spark, sf))


@query("set_listed_existing")
def set_listed_existing(spark, sf):
    return reconcile.listed_existing(fx.listed(spark, sf), fx.files(spark, sf))


@query("set_complement")
def set_complement(spark, sf):
    existing = reconcile.listed_existing(fx.listed(spark, sf), fx.files(spark, sf))
    return reconcile.complement(fx.files(spark, sf), existing)


@query("join_split_assign")
def join_split_assign(spark, sf):
    ids = fx.utt(spark, sf).select("path")
    return reconcile.assign_split(ids, fx.split_lists(spark, sf))


def _manifest_store(spark, sf, buckets: int = 16):
    from ..sources.manifests import ManifestStore
    store = ManifestStore(spark, _scratch(spark, "manifests"), buckets)
    store.put("files", fx.files(spark, sf))
    store.put("listed", fx.listed(spark, sf))
    store.put("lists", fx.split_lists(spark, sf))
    return store


@query("manifest_reconcile")
def manifest_reconcile(spark, sf):
    """J2-J5 and J8 over manifests stored by path: what they say of every path, and no shuffle of paths."""
    store = _manifest_store(spark, sf)
    files, listed, lists = store.get("files"), store.get("listed"), store.get("lists")
    existing = reconcile.listed_existing(listed, files)
    parts = [existing.select(F.lit("existing").alias("kind"), "path", F.lit("").alias("split")),
             reconcile.complement(files, existing).select(F.lit("remaining").alias("kind"), "path", F.lit("").alias("split")),
             reconcile.assign_split(files, lists, bucketed=True).select(F.lit("assigned").alias("kind"), "path", F.col("assigned").alias("split")),
             reconcile.orphans(files, listed).select(F.lit("orphan").alias("kind"), "path", "split")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("join_strict_lookup")
def join_strict_lookup(spark, sf):
    rec = fx.utt(spark, sf).select("utt_id", paths.basename("path").alias("wav"))
    return reconcile.strict_lookup(rec, fx.lookup_lists(spark, sf), "wav", "file_name", order="list")


def _shard_inputs(spark, sf):
    return fx.archive_members(spark, sf), fx.split_transcripts(spark, sf), fx.archives(spark)


@query("join_shard_transcripts")
def join_shard_transcripts(spark, sf):
    return reconcile.shard_transcripts(*_shard_inputs(spark, sf)).select("split", "key", "path")


@query("join_shard_unmatched")
def join_shard_unmatched(spark, sf):
    return reconcile.shard_counts(*_shard_inputs(spark, sf))


@query("join_orphans")
def join_orphans(spark, sf):
    u = fx.utt(spark, sf)
    files = fx.files(spark, sf)
    transcribed = u.where(F.col("lang") != "fr").select("split", "path", F.col("text").alias("transcription"))
    present = transcribed.join(files, "path", "left_semi")
    return present.unionByName(reconcile.orphans(files, transcribed))


@query("union_splits")
def union_splits(spark, sf):
    u = fx.utt(spark, sf)
    train = u.where((F.col("split") == "train") & (F.col("lang") != "es")).select(
        "utt_id", "path", "text", F.col("source").alias("speaker"))
    cv = u.where((F.col("split") == "train") & (F.col("lang") == "es")).select("utt_id", "path", "text")
    dev = u.where(F.col("split") == "validation").select("utt_id", "path", "text")
    test = u.where(F.col("split") == "test").select("utt_id", "path", "text", F.col("class").alias("age"))
    return reconcile.union_splits([("train", train), ("train", cv), ("validation", dev), ("test", test)])


@query("concat_sources")
def concat_sources(spark, sf):
    u = fx.utt(spark, sf).select("source_ord", "row_ord", "utt_id")
    groups = [u.where(F.col("source_ord") < 7), u.where((F.col("source_ord") >= 7) & (F.col("source_ord") < 14)),
              u.where(F.col("source_ord") >= 14)]
    return mix.concat_sources(groups)


@query("join_pred_truth")
def join_pred_truth(spark, sf):
    return score.join_pred_truth(fx.truths(spark, sf), fx.predictions(spark, sf), order="attempt")


# ---------------------------------------------------------------- scalar functions

def _u(spark, sf):
    return fx.utt(spark, sf)


@query("path_basename")
def path_basename(spark, sf):
    return _u(spark, sf).select("utt_id", paths.basename("path").alias("name"))


@query("path_stem")
def path_stem(spark, sf):
    return _u(spark, sf).select("utt_id", paths.stem("path").alias("stem"),
                                paths.stem(F.concat(F.lit("."), F.col("source"))).alias("dot_stem"))


@query("path_swap_ext")
def path_swap_ext(spark, sf):
    return _u(spark, sf).select("utt_id", paths.swap_extension(F.concat("path", F.lit(".wav")), ".wav", ".txt")
                                .alias("txt"))


@query("path_compose")
def path_compose(spark, sf):
    u = _u(spark, sf)
    prefix = (F.when(F.col("split") == "train", F.lit("train_audio/"))
              .when(F.col("split") == "validation", F.lit("dev_audio/")).otherwise(F.lit("test_audio/")))
    return u.select("utt_id", paths.compose_path(prefix, paths.stem("path"), ".ogg").alias("file"))


@query("path_strip_prefix")
def path_strip_prefix(spark, sf):
    u = _u(spark, sf)
    return u.select("utt_id", paths.strip_prefix(F.concat(F.lit("corpus/"), F.col("path")), "corpus/")
                    .alias("file_name"))


@query("path_split_once")
def path_split_once(spark, sf):
    u = _u(spark, sf)
    a, b = paths.split_once(F.concat(F.lit("data/"), F.col("path")))
    c, d = paths.split_once(paths.basename("path"))
    return u.select("utt_id", a.alias("set"), b.alias("file_name"), c.alias("set2"), d.alias("file_name2"))


@query("meta_id_prefix")
def meta_id_prefix(spark, sf):
    u = _u(spark, sf)
    return u.select("utt_id", paths.id_prefix(F.concat(F.col("source"), F.lit("_"), F.col("text"))).alias("id"))


@query("path_unflatten")
def path_unflatten(spark, sf):
    u = _u(spark, sf)
    flat = F.concat(F.lit("data/id"), F.lpad(F.col("utt_id").cast("string"), 5, "0"), F.lit("_"),
                    F.lpad(F.col("n_chars").cast("string"), 5, "0"), F.lit(".wav"))
    return u.select("utt_id", paths.unflatten(flat).alias("path"))


@query("path_flatten")
def path_flatten(spark, sf):
    return _u(spark, sf).select("utt_id", paths.flatten(F.concat(F.col("source"), F.lit("/"), F.col("path")))
                                .alias("flat"))


@query("derive_age_class")
def derive_age_class(spark, sf):
    a = fx.age_ids(spark, sf)
    cls, p = paths.age_class("id")
    return a.select("utt_id", cls.alias("age_class"), p.alias("current_path"))


@query("clean_unk")
def clean_unk(spark, sf):
    return _u(spark, sf).select("utt_id", text.clean_unk("raw").alias("transcription"))


@query("clean_transcript")
def clean_transcript(spark, sf):
    return _u(spark, sf).select("utt_id", text.clean_transcript("raw").alias("transcription"))


@query("decode_class")
def decode_class(spark, sf):
    return _u(spark, sf).select("utt_id", *codes.decode_class("class"))


@query("clean_tsv_text")
def clean_tsv_text(spark, sf):
    return _u(spark, sf).select("utt_id", text.clean_tsv_text(F.concat(F.lit("\n"), F.col("raw"))).alias("text"))


@query("json_transcript")
def json_transcript(spark, sf):
    return fx.result_json(spark, sf).select("utt_id", text.json_transcript("doc").alias("transcript"))


@query("norm_words")
def norm_words(spark, sf):
    u = _u(spark, sf)
    w = text.normalize_words("raw")
    return u.select("utt_id", F.array_join(w, " ").alias("words"), F.size(w).alias("n_words"))


@query("wav_header_profile")
def wav_header_profile(spark, sf):
    """A canonical 44-byte PCM header per utterance (16-bit; channels 1 or 2)
    is built as binary in Spark, then parsed back by ``wav.wav_profile``."""
    u = _u(spark, sf)
    content = u.select("utt_id", _wav_headers(u).alias("content"))
    return content.select("utt_id", *wav.wav_profile("content"))


# ---------------------------------------------------------------- aggregations (WER)

@query("wer_pairs")
def wer_pairs(spark, sf):
    return score.word_edits(fx.pairs(spark, sf))


@query("wer_corpus")
def wer_corpus(spark, sf):
    return score.corpus_wer(score.word_edits(fx.pairs(spark, sf)))


@query("wer_by_split")
def wer_by_split(spark, sf):
    return score.corpus_wer(score.word_edits(fx.pairs(spark, sf)), ["split"])


@query("wer_gate")
def wer_gate(spark, sf):
    return score.wer_gate(score.corpus_wer(score.word_edits(fx.gate_pairs(spark, sf)), ["split"]))


@query("wer_gate_samples")
def wer_gate_samples(spark, sf):
    """the first and last five pairs of suspicious splits."""
    return score.gate_samples(fx.gate_pairs(spark, sf), wer_gate(spark, sf))


@query("corpus_mix")
def corpus_mix(spark, sf):
    known = F.when(F.col("source") != "src3", F.col("source"))          # some rows have no source
    return mix.corpus_mix(fx.read_table(spark, sf, "documents").select(known.alias("source")))


# ---------------------------------------------------------------- ordering

def _ordered(spark, sf) -> DataFrame:
    # narrow columns only: the scan is not spread, and the text is not read
    return fx.derive_utt(fx.read_table(spark, sf, "documents")).select("utt_id", "split", "source_ord", "row_ord")


def _positions(spark, sf, partition=()) -> DataFrame:
    return order.global_position(_ordered(spark, sf), ["source_ord", "row_ord"], "block", partition, rows_per_shard=order.ROWS_PER_SHARD)


@query("global_position")
def global_position(spark, sf):
    return _positions(spark, sf).select("utt_id", "pos")


@query("split_position")
def split_position(spark, sf):
    return _positions(spark, sf, ["split"]).select("utt_id", "split", "pos")


@query("sample_budget")
def sample_budget(spark, sf):
    return order.sample_budget(_ordered(spark, sf), BUDGET_STEPS, BUDGET_BATCH, ["source_ord", "row_ord"], "block",
                               rows_per_shard=order.ROWS_PER_SHARD).select("utt_id", "pos")


@query("head_tail_sample")
def head_tail_sample(spark, sf):
    u = fx.utt(spark, sf).select("split", "utt_id", "row_ord")
    return order.head_tail(u, ["split"], "row_ord", 5).select("split", "end", "rank_in_end", "utt_id")


def _metrics(spark, sf) -> DataFrame:
    # blocks of a run by wide ranges of its order: a usual run is one block, a huge one many
    p = order.global_position(fx.metric_log(spark, sf), ["event_id"], "block", ["run"], rows_per_shard=EVENTS_PER_BLOCK)
    return p.select("run", ((F.col("pos") + 1) * STEP_EVERY).alias("step"), F.col("wer_milli").alias("wer"))


@query("best_checkpoint")
def best_checkpoint(spark, sf):
    return order.best_checkpoint(_metrics(spark, sf))


@query("retain_checkpoints")
def retain_checkpoints(spark, sf):
    return order.retain_checkpoints(_metrics(spark, sf), RETAIN_LIMIT)


@query("thin_steps")
def thin_steps(spark, sf):
    return order.thin_steps(_metrics(spark, sf), THIN_EVERY)


# ---------------------------------------------------------------- arrays / model inputs

@query("encode_labels")
def encode_labels(spark, sf):
    return _labelled(spark, sf).select("utt_id", _ints("labels").alias("labels"))


@query("encode_raw_labels")
def encode_raw_labels(spark, sf):
    """R1, R7 over noisy transcripts: byte-order marks, line breaks and backslashes are characters like others."""
    u = fx.utt(spark, sf)
    vocab = arrays.char_ids(u.where(F.col("split") == "train"), "raw")
    lab = arrays.encode_labels(u, vocab, "raw", "labels")
    return lab.select("utt_id", _ints("labels").alias("labels"), arrays.decode_labels(F.col("labels"), vocab).alias("text"))


@query("derive_lengths")
def derive_lengths(spark, sf):
    return arrays.label_lengths(fx.utt(spark, sf)).select("utt_id", "input_length", "label_length")


def _train_stream(spark, sf, bos: bool = False) -> DataFrame:
    """Training-stream order: F1, F2 by character count, R1 once, then O1 and R3 on the written rows."""
    has_bos = F.lit(bos) & (F.col("source_ord") % 2 == 0)
    u = fx.utt(spark, sf).where(mix.audio_length_ok(F.col("n_samples")))
    u = u.where(arrays.label_count(F.col("text"), has_bos) < mix.MAX_LABEL_LENGTH)
    lab = arrays.encode_labels(u, _vocab(spark, sf), "text", "labels")
    lab = lab.withColumn("labels", F.when(has_bos, F.concat(F.array(F.lit(arrays.BOS_ID)), F.col("labels")))
                         .otherwise(F.col("labels")))
    rows = sinks.materialize(lab.select("utt_id", "source_ord", "row_ord", "labels", "n_samples"), _scratch(spark, "train-stream"))
    pos = order.global_position(rows, ["source_ord", "row_ord"], "block", rows_per_shard=order.ROWS_PER_SHARD)
    return arrays.assign_batches(pos, BATCH_SIZE)


@query("assign_batches")
def assign_batches(spark, sf):
    return _train_stream(spark, sf).select("utt_id", "pos", "batch", "slot")


@query("pad_labels")
def pad_labels(spark, sf):
    p = arrays.pad_labels(_train_stream(spark, sf))
    return p.select("utt_id", "batch", F.size("labels").alias("padded_length"), _ints("labels").alias("labels"))


@query("trim_bos")
def trim_bos(spark, sf):
    t = arrays.trim_bos(_train_stream(spark, sf, bos=True))
    return t.select("utt_id", "batch", _ints("labels").alias("labels"))


@query("unmask_labels")
def unmask_labels(spark, sf):
    p = arrays.pad_labels(_train_stream(spark, sf))
    return p.select("utt_id", _ints(arrays.unmask(F.col("labels"))).alias("labels"))


@query("decode_labels")
def decode_labels(spark, sf):
    vocab = _vocab(spark, sf)
    lab = arrays.encode_labels(fx.utt(spark, sf), vocab, "text", "labels")
    return lab.select("utt_id", arrays.decode_labels(F.col("labels"), vocab).alias("text"))


@query("ctc_greedy")
def ctc_greedy(spark, sf):
    return arrays.ctc_greedy(fx.frames(spark, sf), fx.CTC_ALPHABET)


@query("frame_mask")
def frame_mask(spark, sf):
    m = arrays.frame_mask(F.col("n_samples"))               # audio over 30 s included
    return fx.utt(spark, sf).select("utt_id", F.size(m).alias("n_frames"),
                    F.aggregate(m, F.lit(0), lambda a, x: a + x).alias("n_real"))


@query("rank_slices")
def rank_slices(spark, sf):
    return arrays.rank_slices(_positions(spark, sf), RANK_BATCH, RANK_N).select("utt_id", "pos", "rank")


@query("wer_from_ids")
def wer_from_ids(spark, sf):
    """A4: label ids (padded with -100) and predicted ids -> unmask, decode, corpus WER."""
    vocab = _vocab(spark, sf)
    both = fx.utt(spark, sf).select("split", "utt_id", "text", fx.hypothesis(F.col("utt_id"), F.col("text")).alias("hyp"))
    lab = arrays.encode_labels(both, vocab, "text", "labels")
    lab = arrays.encode_labels(lab, vocab, "hyp", "pred_ids")
    dec = lab.select("split", "utt_id",
                     arrays.decode_labels(arrays.unmask(F.col("labels")), vocab).alias("ref"),
                     arrays.decode_labels(F.col("pred_ids"), vocab).alias("hyp"))
    return score.corpus_wer(score.word_edits(dec), ["split"])


# ---------------------------------------------------------------- batch / UDF surface

def _char_stats(pdf):
    import pandas as pd
    return pd.DataFrame({"utt_id": pdf["utt_id"],
                         "n_chars_py": pdf["text"].map(len).astype("int64"),
                         "n_upper": pdf["text"].map(lambda s: sum(ch.isupper() for ch in s)).astype("int64")})


@query("map_batches")
def map_batches(spark, sf):
    u = fx.utt(spark, sf).select("utt_id", "text")
    return batch.map_batches(u, _char_stats, "utt_id long, n_chars_py long, n_upper long", batch_size=88)


@query("score_batches")
def score_batches(spark, sf):
    u = fx.utt(spark, sf).select("utt_id", "text")
    pred = batch.score_batches(fx.make_rule_predictor, ["utt_id", "text"], T.StringType(), batch_size=32)
    return u.select("utt_id", pred.alias("pred"))


@query("score_rows")
def score_rows(spark, sf):
    """The same predictor, one row a call."""
    u = fx.utt(spark, sf).select("utt_id", "text")
    pred = batch.score_batches(fx.make_rule_predictor, ["utt_id", "text"], T.StringType(), batch_size=1)
    return u.select("utt_id", pred.alias("pred"))


# ---------------------------------------------------------------- streaming

@query("stream_prepare")
def stream_prepare(spark, sf):
    """Corpus rows stream in; unify (P4), audio length (F1), labels from a
    static vocabulary (R1), label length (F2); appended to a parquet sink."""
    from ..streaming.stream import prepare_stream
    vocab = _vocab(spark, sf)
    u = fx.derive_utt(fx.stream_documents(spark, sf)).select(
        "utt_id", "split", F.struct(F.col("path"), F.col("n_samples"), F.col("sampling_rate")).alias("audio"),
        F.col("text").alias("transcription"))
    canonical = mix.unify(u, 0).where(mix.audio_length_ok(F.col("audio.n_samples")))
    lab = arrays.encode_labels(canonical, vocab, "transcription", "labels")
    rows = lab.where(mix.label_length_ok(F.col("labels"))).select(
        "utt_id", "split", F.col("audio.n_samples").alias("n_samples"), F.size("labels").alias("label_length"))
    base = _scratch(spark, "stream-prepare")
    return prepare_stream(rows, f"{base}/out", f"{base}/checkpoint")


@query("stream_position")
def stream_position(spark, sf):
    """T1 with O2 and R3: positions and batches given as rows stream in."""
    from ..streaming.stream import numbered_stream
    u = fx.derive_utt(fx.stream_documents(spark, sf)).select("utt_id", "split", "source_ord", "row_ord")
    base = _scratch(spark, "stream-position")
    rows = numbered_stream(u, f"{base}/out", f"{base}/checkpoint", ["source_ord", "row_ord"], batch_size=BATCH_SIZE)
    return rows.select("utt_id", "split", "pos", "batch", "slot")


@query("stream_wer")
def stream_wer(spark, sf):
    from ..streaming.stream import running_wer, stream_session
    docs = fx.stream_documents(stream_session(spark), sf)
    pairs = fx.derive_utt(docs).select("split", "utt_id", F.col("raw").alias("ref"),
                                       fx.hypothesis(F.col("utt_id"), F.col("text")).alias("hyp"))
    base = _scratch(spark, "stream-wer")
    return running_wer(pairs, f"{base}/out", f"{base}/checkpoint")
