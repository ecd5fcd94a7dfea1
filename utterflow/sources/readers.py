"""Readers for the manifest and listing formats speech corpora ship with.

Every reader takes an explicit schema (no inference) and returns a lazy
DataFrame. Whole-file formats (keyed JSON, record arrays, literal records)
are parsed from a string column so the caller decides the unit of work: one
row per file/shard, never one row for the whole corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.paths import basename, stem
from ..functions.text import clean_tsv_text
from .listing import list_tree, read_contents
from .quoted import read_records


def load_split(spark: SparkSession, path: str, split: str | None = None,
               columns: list[str] | None = None, where: Column | None = None) -> DataFrame:
    """A named corpus folder (parquet, ``split=`` partitions) and one split.

    The split filter prunes partitions; ``where`` is pushed into the scan. A
    corpus without splits can't be asked for one.
    """
    df = spark.read.parquet(path)
    if split is not None:
        if "split" not in df.columns:
            raise ValueError(f"{path} has no split column, asked for split {split!r}")
        df = df.where(F.col("split") == split)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def from_columns(spark: SparkSession, columns: dict[str, list], schema: T.StructType | str) -> DataFrame:
    """A dataset from in-memory columns (small, driver-held inputs only,
    e.g. a list of excluded corpora). Large generated inputs belong in a
    partitioned source such as ``sources.tarshards`` so no driver holds them."""
    names = list(columns)
    rows = list(zip(*[columns[n] for n in names])) if names else []
    return spark.createDataFrame(rows, schema)


class CorpusRegistry:
    """Named corpora: name -> (parquet path, optional config column).

    ``load(spark, name, config, split)`` reads one corpus, keeps one config
    (e.g. a language) with a filter pushed into the scan and one split.
    """

    def __init__(self, entries: dict[str, tuple[str, str | None]] | None = None):
        self.entries = dict(entries or {})

    def register(self, name: str, path: str, config_column: str | None = None) -> "CorpusRegistry":
        self.entries[name] = (path, config_column)
        return self

    def load(self, spark: SparkSession, name: str, config: str | None = None, split: str | None = None,
             columns: list[str] | None = None) -> DataFrame:
        path, config_column = self.entries[name]
        where = None
        if config is not None:
            if config_column is None:
                raise ValueError(f"corpus {name!r} has no config column")
            where = F.col(config_column) == config
        return load_split(spark, path, split, columns, where)


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Recursive listing (path, name, length) by the executors; file contents are never read.

    Paths are URIs of Spark's file system, names as they are (see ``sources.listing``).
    """
    return list_tree(spark, root, glob).select("path", "name", "length")


# CSV fields as they are: " and "" stay apart, nothing is trimmed
_FIELDS = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
           "emptyValue": "", "nullValue": "\u0000\u0001"}


def read_pipe_manifest(spark: SparkSession, path: str, names: tuple[str, str] = ("file_name", "transcription"),
                       n_fields: int = 2) -> DataFrame:
    """Headerless '|' manifest, first two fields used (quoted with '"').

    A quoted field may hold line breaks; a file is read by as many tasks as it has ranges (see ``sources.quoted``).
    """
    schema = ", ".join(f"_c{i} string" for i in range(max(n_fields, 2)))
    rows = read_records(spark, path, "|").select(F.from_csv("value", schema, {"sep": "|", **_FIELDS}).alias("r"))
    return rows.select(F.col("r._c0").alias(names[0]), F.col("r._c1").alias(names[1]))


def read_indexed_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """CSV with a header whose first (index) column is dropped; files are split as in S4."""
    schema = ", ".join(f"`{c}` string" for c in ["_index", *columns])
    rows = read_records(spark, path, ",", header=True).select(F.from_csv("value", schema, {"sep": ",", **_FIELDS}).alias("r"))
    return rows.select(*(F.col(f"r.`{c}`").alias(c) for c in columns))


def parse_tsv_transcripts(lines: DataFrame, line: str = "line", line_no: str = "line_no") -> DataFrame:
    """S6/A6: 'id<TAB>text...' lines -> (id, text); text lowercased with only
    newlines trimmed; extra fields ignored; for a repeated id the last line wins
    (largest ``line_no``). A line without a tab is an error.

    ``max_by`` is a partial aggregate, so a hot id never gathers its rows.
    """
    parts = F.split(F.col(line), "\t", 3)
    second = F.when(F.size(parts) > 1, F.get(parts, 1)).otherwise(
        F.raise_error(F.concat(F.lit("line without a tab: "), F.substring(line, 1, 80))).cast("string"))
    rows = lines.select(F.get(parts, 0).alias("id"), clean_tsv_text(second).alias("text"), F.col(line_no))
    return rows.groupBy("id").agg(F.max_by("text", line_no).alias("text"))


def read_tsv_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """S6 over files: lines in file order, files in name order; a line ends at LF, CR LF or CR.

    Large files are split. A line's place is its file, where its split begins,
    and its number within the task, which reads a split in order: the order is
    that of the file whatever the cluster does.
    """
    place = F.struct(_file_path().alias("file"), F.col("_metadata.file_block_start").alias("start"),
                     F.monotonically_increasing_id().alias("n"))
    return parse_tsv_transcripts(spark.read.text(path).select(place.alias("line_no"), F.col("value").alias("line")))


def _decoded(name: Column) -> Column:
    """A file name or path as it is: Spark's metadata columns give it percent-encoded."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def _file_path() -> Column:
    return _decoded(F.col("_metadata.file_path"))


JSONL_SCHEMA = T.StructType([T.StructField("key", T.StringType()), T.StructField("text", T.StringType())])


_STRICT = {"mode": "FAILFAST"}      # a malformed document fails the job instead of vanishing


def parse_jsonl_manifest(df: DataFrame, col: str = "value") -> DataFrame:
    """JSON lines {key, text, ...} -> (file_name = basename(key), transcription).

    Blank lines are skipped; a malformed line is an error.
    """
    j = df.where(F.trim(F.col(col)) != "").select(F.from_json(F.col(col), JSONL_SCHEMA, _STRICT).alias("_j"))
    return j.select(basename(F.col("_j.key")).alias("file_name"), F.col("_j.text").alias("transcription"))


def read_jsonl_manifest(spark: SparkSession, path: str) -> DataFrame:
    return parse_jsonl_manifest(spark.read.text(path))


KEYED_SCHEMA = T.MapType(T.StringType(), T.StructType([T.StructField("wav", T.StringType())]))


def explode_keyed_json(df: DataFrame, col: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """{"id": {"wav": ...}, ...} -> one row (id, wav) per entry; a malformed document is an error."""
    m = df.select(*keep, F.from_json(F.col(col), KEYED_SCHEMA, _STRICT).alias("_m"))
    return m.select(*keep, F.explode("_m").alias("id", "_v")).select(*keep, "id", F.col("_v.wav").alias("wav"))


def parse_json_records(df: DataFrame, schema: T.StructType, col: str = "value",
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """A JSON array of records -> one row per record (``inline``); a malformed document is an error."""
    a = df.select(*keep, F.from_json(F.col(col), T.ArrayType(schema), _STRICT).alias("_a"))
    return a.select(*keep, F.inline("_a"))


# a whole quoted string, or a bare literal outside of strings
_PY_TOKENS = r"""('[^'\\]*+(?:\\.[^'\\]*+)*+'|"[^"\\]*+(?:\\.[^"\\]*+)*+")|\b(None|True|False)\b"""


def parse_literal_records(df: DataFrame, schema: T.StructType, col: str = "value",
                          keep: tuple[str, ...] = ()) -> DataFrame:
    """Single-quoted Python-literal records -> rows.

    Bare None/True/False become JSON; quoted strings are matched first and
    left alone, whatever they hold. The JSON reader accepts single quotes and
    backslash-escaped quotes; a malformed document is an error.
    """
    fixed = F.regexp_replace(F.col(col), _PY_TOKENS, "$1\u0000$2")
    for name, json in (("None", "null"), ("True", "true"), ("False", "false")):
        fixed = F.replace(fixed, F.lit(f"\u0000{name}"), F.lit(json))
    fixed = F.replace(fixed, F.lit("\u0000"), F.lit(""))
    opts = {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true", **_STRICT}
    a = df.select(*keep, F.from_json(fixed, T.ArrayType(schema), opts).alias("_a"))
    return a.select(*keep, F.inline("_a"))


def _whole_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file (value = whole content, plus the file name): a
    whole-file JSON document is parsed inside the task that reads it."""
    df = spark.read.text(path, wholetext=True)
    return df.select(_decoded(F.col("_metadata.file_name")).alias("source_file"), "value")


def read_keyed_json(spark: SparkSession, path: str) -> DataFrame:
    """S8 over files: each file is one {"id": {"wav": ...}} object."""
    return explode_keyed_json(_whole_files(spark, path), keep=("source_file",))


def read_json_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S9 over files: each file is one JSON array of records."""
    return parse_json_records(_whole_files(spark, path), schema, keep=("source_file",))


def read_literal_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S10 over files: each file is one Python-literal list of records."""
    return parse_literal_records(_whole_files(spark, path), schema, keep=("source_file",))


def read_path_list(spark: SparkSession, path: str) -> DataFrame:
    """S11: 'speaker<TAB>file' lines -> 'speaker/file'."""
    return spark.read.text(path).select(F.translate(F.col("value"), "\t", "/").alias("path"))


def read_sidecars(spark: SparkSession, root: str, glob: str = "*.txt") -> DataFrame:
    """One text file per audio file, whole content (trailing newline kept)."""
    files = read_contents(list_tree(spark, root, glob).select("name", "path", "length"), spark)
    return files.select(stem(F.col("name")).alias("stem"), "path", F.decode("content", "UTF-8").alias("text"))


def read_audiofolder(spark: SparkSession, root: str, audio_glob: str = "*.wav",
                     metadata_root: str | None = None) -> DataFrame:
    """S3: audio files joined to their split's metadata by (split, file_name).

    The split is the first folder under ``root``; audio right under the root is
    the split "train". Metadata is either a ``<split>/metadata.csv`` (or
    ``metadata.csv``) beside the audio, or (``metadata_root``) the
    ``split=<name>/`` folders written by ``sinks.write_metadata_csv``. Audio
    contents are never read. Audio of which none has metadata is an error.
    """
    from .sinks import read_metadata_csv
    tree = list_tree(spark, root, f"{{{audio_glob},metadata.csv}}")
    parts = F.split(F.col("rel"), "/", 2)
    place = F.when(F.col("rel").contains("/"), F.struct(parts[0].alias("split"), parts[1].alias("file_name"))) \
        .otherwise(F.struct(F.lit("train").alias("split"), F.col("rel").alias("file_name")))
    placed = tree.select("path", "length", place.alias("at")).select("path", "length", "at.*")
    files = placed.where(F.col("file_name") != "metadata.csv")
    if metadata_root is None:
        meta = None                                  # one file a split
        for m in placed.where(F.col("file_name") == "metadata.csv").select("split", "path").collect():
            one = read_metadata_csv(spark, m["path"]).withColumn("split", F.lit(m["split"]))
            meta = one if meta is None else meta.unionByName(one, allowMissingColumns=True)
        if meta is None:
            raise FileNotFoundError(f"no metadata.csv below {root}")
    else:
        meta = read_metadata_csv(spark, metadata_root)
    joined = files.join(meta, ["split", "file_name"], "inner")
    if files.limit(1).count() and not joined.limit(1).count():
        raise ValueError(f"none of the audio below {root} is in its metadata")
    return joined
