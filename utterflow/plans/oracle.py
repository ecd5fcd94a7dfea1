"""DuckDB SQL for every registered query that has an exact SQL equivalent.

The fixture tables of ``plans.fixtures`` are spelled here as CTEs over the
pre-registered views. DuckDB lambdas index from 1, Spark's from 0.
The word edit distance is the plain dynamic program over anti-diagonals (no
cell depends on another one of its diagonal), a list reduction per pair over
whole texts. Code tables, the CTC alphabet and the character classes are spelled
out here, so a wrong entry in the library shows.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from . import catalog as C

SPLIT = "CASE WHEN doc_id % 10 < 8 THEN 'train' WHEN doc_id % 10 = 8 THEN 'validation' ELSE 'test' END"


@lru_cache(maxsize=None)
def _class(kind: str) -> str:
    """A bracket class of the code points that Python counts as white space or as punctuation (category P)."""
    test = str.isspace if kind == "space" else lambda c: unicodedata.category(c)[0] == "P"
    return "[" + "".join(f"\\x{{{c:x}}}" for c in range(sys.maxunicode + 1) if test(chr(c))) + "]"


def _base() -> str:
    ws = _class("space")
    return f"""_docs AS (
  SELECT doc_id, source, lang, n_chars,
         regexp_replace(regexp_replace(text, '{ws}+', ' ', 'g'), '^ | $', '', 'g') AS t
  FROM documents),
utt AS (
  SELECT doc_id AS utt_id, doc_id AS row_ord, source,
         CAST(substr(source, 4) AS INTEGER) AS source_ord,
         CAST(doc_id // 250 AS BIGINT) AS shard,
         {SPLIT} AS split,
         {SPLIT} || '/' || source || '_' || lpad(CAST(doc_id AS VARCHAR), 6, '0') || '.wav' AS path,
         t AS text,
         CASE doc_id % 7 WHEN 0 THEN chr(65279) || t
                         WHEN 1 THEN replace(t, ' ', ' - ')
                         WHEN 2 THEN replace(t, ' ', chr(10) || chr(10))
                         WHEN 3 THEN t || chr(13) || chr(10)
                         WHEN 4 THEN replace(t, ' ', ' ' || chr(92) || ' ')
                         WHEN 5 THEN '<unk> ' || t || '   [noise]  '
                         ELSE CASE WHEN doc_id % 49 = 6 THEN chr(9) || ' ' ELSE t END END AS raw,
         CAST(CASE WHEN doc_id % 50 = 0 THEN 0 WHEN doc_id % 50 = 1 THEN 480000
                   WHEN doc_id % 50 = 2 THEN 479999 ELSE (n_chars * 137) % 600000 END AS BIGINT) AS n_samples,
         CAST(CASE doc_id % 4 WHEN 0 THEN 16000 WHEN 1 THEN 22050 WHEN 2 THEN 44100 ELSE 48000 END AS INTEGER)
           AS sampling_rate,
         CASE WHEN doc_id % 97 = 0 THEN NULL WHEN doc_id % 97 = 1 THEN 'X0'
              ELSE 'X' || substr('0123456789Z', CAST(doc_id % 11 AS INTEGER) + 1, 1)
                       || substr('MFU', CAST(doc_id % 3 AS INTEGER) + 1, 1)
                       || substr('01234Q', CAST(doc_id % 6 AS INTEGER) + 1, 1)
                       || substr('NJASTDFHW', CAST(doc_id % 9 AS INTEGER) + 1, 1)
                       || substr('CYMOSV', CAST(doc_id % 6 AS INTEGER) + 1, 1) END AS class,
         lang, n_chars,
         array_to_string(list_filter(list_transform(list_filter(string_split(t, ' '), lambda w: w <> ''),
             lambda w, i: CASE WHEN (i - 1 + doc_id) % 11 = 0 THEN 'zzz' ELSE w END),
             lambda w, i: (i - 1 + doc_id) % 7 <> 0), ' ') AS hyp
  FROM _docs),
files AS (SELECT path FROM utt WHERE lang <> 'de'),
listed AS (SELECT path FROM utt WHERE lang <> 'fr'),
lookup_lists AS (
  SELECT regexp_extract(path, '[^/]*$', 0) AS wav, 'data/' || path AS file_name, 0 AS list FROM utt WHERE lang <> 'fr'
  UNION ALL SELECT regexp_extract(path, '[^/]*$', 0), 'held/' || path, 1 FROM utt WHERE lang = 'es'),
split_lists AS (
  SELECT 'train' AS split, path FROM utt WHERE lang IN ('en', 'de')
  UNION ALL SELECT 'validation', path FROM utt WHERE lang IN ('fr', 'de')
  UNION ALL SELECT 'test', path FROM utt WHERE lang = 'es' OR n_chars < 500)"""


def _with(sql: str, extra: str = "") -> str:
    return "WITH " + _base() + (",\n" + extra if extra else "") + "\n" + sql


def _basename(x: str) -> str:
    return f"regexp_extract({x}, '[^/]*$', 0)"


def _stem(x: str) -> str:
    return f"regexp_replace({_basename(x)}, '^(\\.*[^.].*)\\.[^.]*$', '\\1')"


def _clean_transcript(x: str) -> str:
    ws = _class("space")
    s = f"regexp_replace({x}, ' ?- ?', ' ', 'g')"
    s = f"regexp_replace({s}, '\\n+', ' ', 'g')"
    s = f"regexp_replace({s}, '\\r+', ' ', 'g')"
    s = f"regexp_replace({s}, ' +', ' ', 'g')"
    s = f"replace({s}, chr(92), '')"
    s = f"replace({s}, chr(65279), '')"
    return f"regexp_replace({s}, '^{ws}+|{ws}+$', '', 'g')"


def _norm_words(x: str) -> str:
    ws = _class("space")
    s = f"regexp_replace(lower({x}), '[<\\[][^>\\]]*[>\\]]', '', 'g')"
    s = f"regexp_replace({s}, '{ws}{{2,}}', ' ', 'g')"
    s = f"regexp_replace({s}, '^{ws}+|{ws}+$', '', 'g')"
    s = f"regexp_replace({s}, '{_class('punctuation')}', '', 'g')"
    return f"list_filter(string_split({s}, ' '), lambda w: w <> '')"


def _positions(partition: str = "") -> str:
    p = f"PARTITION BY {partition} " if partition else ""
    return f"CAST(row_number() OVER ({p}ORDER BY source_ord, row_ord) - 1 AS BIGINT)"


_VOCAB = """vocab AS (
  SELECT c AS char, CAST(row_number() OVER (ORDER BY count(*) DESC, c) + 3 AS INTEGER) AS id
  FROM (SELECT unnest(list_distinct(string_split(text, ''))) AS c FROM utt WHERE split = 'train')
  WHERE c <> ' ' AND c <> '' GROUP BY c),
labelled AS (
  SELECT u.*, coalesce(e.labels, []) AS labels
  FROM utt u LEFT JOIN (
    SELECT utt_id, list(CAST(CASE WHEN ch = ' ' THEN 3 ELSE coalesce(v.id, 1) END AS INTEGER) ORDER BY pos) AS labels
    FROM (SELECT utt_id, unnest(string_split(text, '')) AS ch, generate_subscripts(string_split(text, ''), 1) AS pos
          FROM utt WHERE text <> '') x
    LEFT JOIN vocab v ON v.char = x.ch GROUP BY utt_id) e USING (utt_id))"""

_STREAM = """stream AS (
  SELECT *, CAST((row_number() OVER (ORDER BY source_ord, row_ord) - 1) AS BIGINT) AS pos
  FROM labelled WHERE n_samples > 0 AND n_samples < 480000 AND len(labels) < 448),
batched AS (SELECT *, pos // 8 AS batch, CAST(pos % 8 AS INTEGER) AS slot FROM stream)"""


def _ints(x: str) -> str:
    return f"array_to_string(list_transform({x}, lambda v: CAST(v AS VARCHAR)), ',')"


# Fixed values of the class code's positions (see functions/codes.py for the decoder under test).
_DECODED = """
  CASE substr(class, 2, 1) WHEN '0' THEN 'news' WHEN '1' THEN 'movies, drama (dialogue)' WHEN '2' THEN 'stories, audio book'
    WHEN '3' THEN 'cultural issue' WHEN '4' THEN 'tourism, exploring' WHEN '5' THEN 'living viewpoints, living expats'
    WHEN '6' THEN 'sports' WHEN '7' THEN 'security related' WHEN '8' THEN 'traffic' WHEN '9' THEN 'healthcare' END AS topic,
  CASE substr(class, 3, 1) WHEN 'M' THEN 'male' WHEN 'F' THEN 'female' END AS gender,
  CASE substr(class, 4, 1) WHEN '0' THEN 'northern dialect' WHEN '1' THEN 'central dialect'
    WHEN '2' THEN 'highland central dialect' WHEN '3' THEN 'southern dialect'
    WHEN '4' THEN 'minority ethnic group dialect' END AS dialect,
  CASE substr(class, 5, 1) WHEN 'N' THEN 'neutral' WHEN 'J' THEN 'joyful' WHEN 'A' THEN 'angry' WHEN 'S' THEN 'sad'
    WHEN 'T' THEN 'tired' WHEN 'D' THEN 'disgust' WHEN 'F' THEN 'fear' WHEN 'H' THEN 'happy' END AS emotion,
  CASE substr(class, 6, 1) WHEN 'C' THEN 'children' WHEN 'Y' THEN 'young' WHEN 'M' THEN 'middle age' WHEN 'O' THEN 'old'
    WHEN 'S' THEN 'very old' END AS age"""
_ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ!"


def _edits(ref: str, hyp: str, rows: str = "utt", extra: str = "") -> str:
    """CTE ``edits`` (split, utt_id, ref_words, hyp_words, edits) over rows with word lists ``ref`` and ``hyp``.

    Diagonal k holds the cells (i, k - i) from i = max(0, k - m) to min(n, k);
    ``a`` is the last diagonal and ``b`` the one before it; lists give null
    outside their range, which ``least`` skips. Eight slices, together all
    rows, let DuckDB work side by side.
    """
    cell = """least(s.a[i - greatest(0, x.k - 1 - m)] + 1, s.a[i - greatest(0, x.k - 1 - m) + 1] + 1,
                    s.b[i - greatest(0, x.k - 2 - m)] + CASE WHEN r[i] = h[x.k - i] THEN 0 ELSE 1 END)"""
    one = f"""SELECT split, utt_id, n, m,
        list_reduce(list_transform(range(1, n + m + 1), lambda k: {{'k': k, 'a': []::INT[], 'b': []::INT[]}}),
          lambda s, x: {{'k': x.k, 'b': s.a,
            'a': list_transform(range(greatest(0, x.k - m), least(n, x.k) + 1), lambda i: {cell})::INT[]}},
          {{'k': 0::BIGINT, 'a': [0]::INT[], 'b': []::INT[]}}).a[1] AS d
      FROM words WHERE slice = """
    slices = " UNION ALL ".join(one + str(i) for i in range(8))
    return f"""{extra}words AS MATERIALIZED (
      SELECT split, utt_id, utt_id % 8 AS slice, list_transform({ref}, lambda w: hash(w)) AS r,
             list_transform({hyp}, lambda w: hash(w)) AS h, len({ref}) AS n, len({hyp}) AS m FROM {rows}),
    edits AS (SELECT split, utt_id, CAST(n AS BIGINT) AS ref_words, CAST(m AS BIGINT) AS hyp_words,
                     CAST(d AS BIGINT) AS edits FROM ({slices}))"""


def _corpus(group: str = "") -> str:
    g = f"{group}, " if group else ""
    return f"""SELECT {g}count(*) AS n_pairs, CAST(sum(edits) AS BIGINT) AS edits, CAST(sum(ref_words) AS BIGINT) AS ref_words,
        CAST(count(*) FILTER (ref_words = 0) AS BIGINT) AS n_empty_ref,
        CASE WHEN sum(ref_words) <> 0 THEN CAST(sum(edits) * 100 AS DOUBLE) / CAST(sum(ref_words) AS DOUBLE) END AS wer
        FROM edits""" + (f" GROUP BY {group}" if group else "")


_METRICS = """metrics AS (
  SELECT user_id AS run, CAST(50 * row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS step,
         CASE WHEN event_id % 13 <> 0 AND user_id % 50 <> 7 THEN CAST(floor(value * 100) AS BIGINT) % 1000 END AS wer
  FROM events)"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["src_load_split"] = """SELECT doc_id AS utt_id, source, n_chars FROM documents
        WHERE lang = 'en' AND doc_id % 10 = 9"""
    q["src_generator"] = "SELECT 'all' AS split, doc_id, text, CAST(length(text) AS BIGINT) AS n_chars_py FROM documents"
    q["src_list_files"] = _with(f"SELECT {_stem('path')} || '.txt' AS name, octet_length(encode(text)) AS length FROM utt")
    q["src_tsv_transcripts"] = _with("SELECT source AS id, arg_max(lower(trim(text, chr(10))), utt_id) AS text "
                                     "FROM utt GROUP BY source")
    q["src_tsv_file"] = q["src_tsv_transcripts"]
    q["src_jsonl_manifest"] = _with(f"SELECT {_basename('path')} AS file_name, text AS transcription FROM utt")
    q["src_keyed_json"] = _with("SELECT CAST(utt_id AS VARCHAR) AS id, path AS wav FROM utt")
    q["src_json_records"] = _with("SELECT path AS wav, raw AS text, class, n_samples AS duration FROM utt")
    q["src_literal_records"] = _with("SELECT path AS file, text, class AS speaker_name FROM utt")
    q["src_path_list"] = _with(f"SELECT source || '/' || {_basename('path')} AS path FROM utt")
    q["src_pipe_manifest"] = _with(f"SELECT {_basename('path')} AS file_name, text AS transcription FROM utt")
    q["src_indexed_csv"] = _with("SELECT path AS Path, text AS Canonical, raw AS Transcript FROM utt")
    meta = f"SELECT split, {_basename('path')} AS file_name, {_clean_transcript('raw')} AS transcription, " \
           "source AS speaker FROM utt"
    q["sink_metadata_csv"] = _with(meta)
    q["sink_flat_csv"] = _with(meta)
    q["sink_parquet"] = _with("SELECT split, utt_id, path, text, n_samples FROM utt")
    q["sink_materialize"] = _with("SELECT utt_id, split, path, raw FROM utt")
    q["proj_select"] = _with("SELECT utt_id, path, split FROM utt")
    q["proj_drop"] = _with("SELECT utt_id, source, source_ord, split, path, n_samples, sampling_rate FROM utt")
    q["proj_rename"] = _with("SELECT utt_id, path AS file_name, text AS transcription FROM utt")
    q["unify_modes"] = _with("""SELECT path, n_samples, text AS transcription,
        CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 ELSE 2 END AS mode FROM utt""")
    q["cast_audio_rate"] = _with("""SELECT utt_id, sampling_rate AS source_rate, 16000 AS sampling_rate,
        CAST((n_samples * 32000 + sampling_rate) // (2 * sampling_rate) AS BIGINT) AS n_samples_16k FROM utt""")
    q["proj_metadata"] = _with(f"""SELECT regexp_extract('data/' || path, '^[^/]*/(.*)$', 1) AS file_name,
        {_clean_transcript('raw')} AS transcription, {_DECODED}, 'data' AS set FROM utt""")
    q["filter_audio_length"] = _with("SELECT utt_id, n_samples FROM utt WHERE n_samples > 0 AND n_samples < 480000")
    q["filter_label_length"] = _with("SELECT utt_id, CAST(length(text) AS INTEGER) AS label_length FROM utt "
                                     "WHERE length(text) < 448")
    q["filter_drop_helper"] = _with("SELECT utt_id FROM utt "
                                    "WHERE len(list_filter(string_split(text, ' '), lambda w: w <> '')) < 100")
    q["filter_language"] = "SELECT doc_id, source, n_chars FROM documents WHERE lang = 'fr'"
    q["filter_split"] = _with("SELECT utt_id, path FROM utt WHERE split = 'validation'")
    q["dq_blank_transcripts"] = _with(f"SELECT utt_id, raw FROM utt WHERE {_clean_transcript('raw')} = ''")
    ex = ", ".join(f"'{s}'" for s in C.EXCLUDED_SOURCES)
    q["filter_excluded_sources"] = _with(f"SELECT source, utt_id FROM utt WHERE source NOT IN ({ex})")
    q["mix_optional_group"] = _with("""SELECT utt_id, CASE WHEN lang = 'de' THEN 'youtube' ELSE 'base' END AS grp
        FROM utt""")
    exp = " UNION ALL ".join(f"SELECT '{s}' AS split, {n} AS expected" for s, n in C.EXPECTED_COUNTS)
    q["dq_row_counts"] = _with(f"""SELECT coalesce(a.split, e.split) AS split, CAST(coalesce(a.actual, 0) AS BIGINT) AS actual,
        CAST(e.expected AS BIGINT) AS expected, coalesce(a.actual, 0) IS NOT DISTINCT FROM e.expected AS ok
        FROM (SELECT split, count(*) AS actual FROM utt GROUP BY split) a FULL OUTER JOIN ({exp}) e ON a.split = e.split""")
    q["dq_pred_truth_match"] = _with("""SELECT split,
        CAST(sum(CASE WHEN lang = 'de' THEN 1 ELSE 0 END) AS BIGINT) AS truth_only,
        CAST(0 AS BIGINT) AS pred_only,
        CAST(sum(CASE WHEN lang <> 'de' THEN 1 ELSE 0 END) AS BIGINT) AS matched,
        CAST(count(*) FILTER (lang <> 'de' AND split = 'train' AND utt_id % 5 = 0) AS BIGINT) AS repeated,
        count(*) FILTER (lang = 'de' OR split = 'train' AND utt_id % 5 = 0) = 0 AS ok
        FROM utt GROUP BY split""")
    q["join_sidecar_diff"] = _with(f"""SELECT 'text_without_audio' AS kind, {_stem('path')} AS stem
        FROM utt WHERE lang = 'de'""")
    q["set_split_disjoint"] = _with("""SELECT a.split AS split_a, b.split AS split_b, count(*) AS n_shared
        FROM (SELECT DISTINCT split, path FROM split_lists) a JOIN (SELECT DISTINCT split, path FROM split_lists) b
        ON a.path = b.path AND a.split < b.split GROUP BY 1, 2""")
    q["set_listed_existing"] = _with("SELECT DISTINCT path FROM listed WHERE path IN (SELECT path FROM files)")
    q["set_complement"] = _with("SELECT path FROM files WHERE path NOT IN "
                                "(SELECT path FROM listed WHERE path IN (SELECT path FROM files))")
    q["join_split_assign"] = _with("""SELECT u.path, coalesce(
          CASE min(CASE s.split WHEN 'train' THEN 0 WHEN 'validation' THEN 1 WHEN 'test' THEN 2 END)
            WHEN 0 THEN 'train' WHEN 1 THEN 'validation' WHEN 2 THEN 'test' END, '') AS assigned
        FROM utt u LEFT JOIN split_lists s ON s.path = u.path GROUP BY u.path""")
    q["manifest_reconcile"] = _with("""SELECT 'existing' AS kind, path, '' AS split FROM files WHERE path IN (SELECT path FROM listed)
        UNION ALL SELECT 'remaining', path, '' FROM files WHERE path NOT IN (SELECT path FROM listed)
        UNION ALL SELECT 'orphan', path, 'orphan' FROM files WHERE path NOT IN (SELECT path FROM listed)
        UNION ALL SELECT 'assigned', f.path, coalesce(
          CASE min(CASE s.split WHEN 'train' THEN 0 WHEN 'validation' THEN 1 WHEN 'test' THEN 2 END)
            WHEN 0 THEN 'train' WHEN 1 THEN 'validation' WHEN 2 THEN 'test' END, '')
        FROM files f LEFT JOIN split_lists s ON s.path = f.path GROUP BY f.path""")
    q["join_strict_lookup"] = _with(f"""SELECT u.utt_id, {_basename('u.path')} AS wav, l.file_name FROM utt u
        LEFT JOIN (SELECT wav, arg_max(file_name, list) AS file_name FROM lookup_lists GROUP BY wav) l
        ON l.wav = {_basename('u.path')}""")
    listed = ", ".join(f"('{x}', '{y}')" for x, y in C.fx.ARCHIVES)
    shard_t = f"""archives(split, archive) AS (VALUES {listed}),
        members AS (SELECT split, path, {_stem('path')} AS key FROM archives JOIN
                    (SELECT source AS archive, path FROM utt WHERE lang <> 'de') USING (archive)),
        transcripts AS (
        SELECT 'train_raw' AS split, {_stem('path')} AS key FROM utt WHERE lang IN ('en', 'fr')
        UNION ALL SELECT 'train_refined', {_stem('path')} FROM utt WHERE lang IN ('en', 'es')
        UNION ALL SELECT 'dev', {_stem('path')} FROM utt WHERE lang IN ('en', 'de')
        UNION ALL SELECT 'test', {_stem('path')} FROM utt WHERE lang IN ('fr', 'es'))"""
    q["join_shard_transcripts"] = _with("SELECT split, key, path FROM members JOIN transcripts USING (split, key)", shard_t)
    q["join_shard_unmatched"] = _with("""SELECT a.split, count(m.path) AS n_members, count(t.key) AS n_matched,
        count(m.path) - count(t.key) AS n_unmatched
        FROM (SELECT DISTINCT split FROM archives) a LEFT JOIN members m ON m.split = a.split
        LEFT JOIN transcripts t ON t.split = m.split AND t.key = m.key GROUP BY a.split""", shard_t)
    q["join_orphans"] = _with("""SELECT split, path, text AS transcription FROM utt WHERE lang NOT IN ('fr', 'de')
        UNION ALL SELECT 'orphan', path, ' ' FROM utt WHERE lang = 'fr'""")
    q["union_splits"] = _with("""SELECT utt_id, path, text, CASE WHEN split = 'train' AND lang <> 'es' THEN source END AS speaker,
        split, CASE WHEN split = 'test' THEN class END AS age FROM utt""")
    q["concat_sources"] = _with("SELECT source_ord, row_ord, utt_id FROM utt")
    q["join_pred_truth"] = _with("SELECT split, utt_id, raw AS sentence, hyp AS pred FROM utt WHERE lang <> 'de'")
    q["path_basename"] = _with(f"SELECT utt_id, {_basename('path')} AS name FROM utt")
    q["path_stem"] = _with(f"SELECT utt_id, {_stem('path')} AS stem, {_stem(chr(39) + '.' + chr(39) + ' || source')} AS dot_stem FROM utt")
    q["path_swap_ext"] = _with("SELECT utt_id, replace(path || '.wav', '.wav', '.txt') AS txt FROM utt")
    q["path_compose"] = _with(f"""SELECT utt_id, CASE split WHEN 'train' THEN 'train_audio/' WHEN 'validation' THEN 'dev_audio/'
        ELSE 'test_audio/' END || {_stem('path')} || '.ogg' AS file FROM utt""")
    q["path_strip_prefix"] = _with("SELECT utt_id, path AS file_name FROM utt")
    q["path_split_once"] = _with(f"""SELECT utt_id, 'data' AS set, path AS file_name, {_basename('path')} AS set2,
        CAST(NULL AS VARCHAR) AS file_name2 FROM utt""")
    q["meta_id_prefix"] = _with("SELECT utt_id, left(source || '_' || text, 14) AS id FROM utt")
    q["path_unflatten"] = _with("""SELECT utt_id, translate(right('data/id' || lpad(CAST(utt_id AS VARCHAR), 5, '0') || '_'
        || lpad(CAST(n_chars AS VARCHAR), 5, '0') || '.wav', 17), '_', '/') AS path FROM utt""")
    q["path_flatten"] = _with("SELECT utt_id, translate(source || '/' || path, '/', '_') AS flat FROM utt")
    q["derive_age_class"] = _with("""SELECT utt_id,
        CASE WHEN m < 4 THEN 'kindergarten' ELSE 'primaryschool' END AS age_class,
        'audio_MDD/' || CASE WHEN m < 4 THEN 'kindergarten/' || regexp_replace(id, '^([^_]*)_', '\\1/')
                        ELSE 'primaryschool/' || id END || '.wav' AS current_path
        FROM (SELECT utt_id, utt_id % 6 AS m, CASE utt_id % 6 WHEN 0 THEN 'đông_' WHEN 1 THEN 'thành_' WHEN 2 THEN 'tú_'
              WHEN 3 THEN 'tuyến_' WHEN 4 THEN 'dong_' ELSE 'x' END || CAST(utt_id AS VARCHAR) || '_a' AS id FROM utt)""")
    q["clean_unk"] = _with("SELECT utt_id, replace(replace(raw, '<unk>', ''), '  ', ' ') AS transcription FROM utt")
    q["clean_transcript"] = _with(f"SELECT utt_id, {_clean_transcript('raw')} AS transcription FROM utt")
    q["decode_class"] = _with(f"SELECT utt_id, {_DECODED} FROM utt")
    q["clean_tsv_text"] = _with("SELECT utt_id, lower(trim(chr(10) || raw, chr(10))) AS text FROM utt")
    q["json_transcript"] = _with("SELECT utt_id, text AS transcript FROM utt")
    q["norm_words"] = _with(f"""SELECT utt_id, array_to_string(w, ' ') AS words, CAST(len(w) AS INTEGER) AS n_words
        FROM (SELECT utt_id, {_norm_words('raw')} AS w FROM utt)""")
    q["wav_header_profile"] = _with("""SELECT utt_id, utt_id % 2 + 1 AS channels, CAST(sampling_rate AS BIGINT) AS sampling_rate,
        CAST(16 AS BIGINT) AS bits_per_sample, n_samples * (utt_id % 2 + 1) * 2 AS data_bytes, n_samples,
        n_samples / sampling_rate AS duration_s FROM utt""")
    q["corpus_mix"] = """SELECT source, count(*) AS n_rows, GROUPING(source) = 1 AS is_total
        FROM (SELECT nullif(source, 'src3') AS source FROM documents) GROUP BY ROLLUP (source)"""
    q["global_position"] = _with(f"SELECT utt_id, {_positions()} AS pos FROM utt")
    q["split_position"] = _with(f"SELECT utt_id, split, {_positions('split')} AS pos FROM utt")
    q["stream_position"] = _with(f"""SELECT utt_id, split, pos, pos // {C.BATCH_SIZE} AS batch, CAST(pos % {C.BATCH_SIZE} AS INTEGER) AS slot
        FROM (SELECT utt_id, split, {_positions('split')} AS pos FROM utt)""")
    q["sample_budget"] = _with(f"""SELECT utt_id, pos FROM (SELECT utt_id, {_positions()} AS pos FROM utt)
        WHERE pos < {C.BUDGET_STEPS * C.BUDGET_BATCH * (1 if C.BUDGET_BATCH >= 8 else 8 // C.BUDGET_BATCH)}""")
    q["head_tail_sample"] = _with("""SELECT split, 'head' AS "end", r AS rank_in_end, utt_id
        FROM (SELECT split, utt_id, CAST(row_number() OVER (PARTITION BY split ORDER BY row_ord) AS INTEGER) AS r FROM utt)
        WHERE r <= 5
        UNION ALL SELECT split, 'tail', r, utt_id
        FROM (SELECT split, utt_id, CAST(row_number() OVER (PARTITION BY split ORDER BY row_ord DESC) AS INTEGER) AS r FROM utt)
        WHERE r <= 5""")
    q["best_checkpoint"] = "WITH " + _METRICS + """
        SELECT run, arg_min(step, (wer, step)) FILTER (wer IS NOT NULL) AS best_step, min(wer) AS best_wer FROM metrics GROUP BY run"""
    q["retain_checkpoints"] = "WITH " + _METRICS + f""",
        best AS (SELECT run, arg_min(step, (wer, step)) FILTER (wer IS NOT NULL) AS step FROM metrics GROUP BY run),
        newest AS (SELECT run, step FROM (SELECT run, step,
                   row_number() OVER (PARTITION BY run ORDER BY step DESC) AS r FROM metrics) WHERE r <= {C.RETAIN_LIMIT}),
        cand AS (SELECT m.run, m.step, m.wer, (b.step IS NOT NULL) AS is_best FROM metrics m
                 LEFT JOIN best b ON b.run = m.run AND b.step = m.step
                 WHERE (m.run, m.step) IN (SELECT run, step FROM newest UNION SELECT run, step FROM best))
        SELECT run, step, wer, is_best, CAST(keep_rank AS INTEGER) AS keep_rank FROM (
          SELECT *, row_number() OVER (PARTITION BY run ORDER BY is_best DESC, step DESC) AS keep_rank FROM cand)
        WHERE keep_rank <= {C.RETAIN_LIMIT}"""
    q["thin_steps"] = "WITH " + _METRICS + f" SELECT run, step, wer FROM metrics WHERE step % {C.THIN_EVERY} = 0"
    q["encode_labels"] = _with(f"SELECT utt_id, {_ints('labels')} AS labels FROM labelled", _VOCAB)
    raw = _VOCAB.replace("text", "raw")
    q["encode_raw_labels"] = _with(f"""SELECT utt_id, {_ints('labels')} AS labels,
        array_to_string(list_transform(list_filter(labels, lambda x: x >= 3),
          lambda x: CASE WHEN x = 3 THEN ' ' ELSE vl[x - 3] END), '') AS text
        FROM labelled, (SELECT list(char ORDER BY id) AS vl FROM vocab) v""", raw)
    q["derive_lengths"] = _with("SELECT utt_id, n_samples AS input_length, CAST(len(labels) AS INTEGER) AS label_length "
                                "FROM labelled", _VOCAB)
    q["assign_batches"] = _with("SELECT utt_id, pos, batch, slot FROM batched", _VOCAB + ",\n" + _STREAM)
    pad = "list_concat(labels, list_transform(range(mx - len(labels)), lambda x: -100))"
    q["pad_labels"] = _with(f"""SELECT utt_id, batch, CAST(mx AS INTEGER) AS padded_length, {_ints(pad)} AS labels
        FROM (SELECT *, max(len(labels)) OVER (PARTITION BY batch) AS mx FROM batched)""", _VOCAB + ",\n" + _STREAM)
    q["unmask_labels"] = _with(f"""SELECT utt_id, {_ints('list_concat(labels, list_transform(range(mx - len(labels)), lambda x: 0))')} AS labels
        FROM (SELECT *, max(len(labels)) OVER (PARTITION BY batch) AS mx FROM batched)""", _VOCAB + ",\n" + _STREAM)
    bos_stream = _VOCAB + """,
        bosl AS (SELECT * REPLACE (CASE WHEN source_ord % 2 = 0 THEN list_concat([2], labels) ELSE labels END AS labels)
                 FROM labelled),
        stream AS (SELECT *, CAST((row_number() OVER (ORDER BY source_ord, row_ord) - 1) AS BIGINT) AS pos
                   FROM bosl WHERE n_samples > 0 AND n_samples < 480000 AND len(labels) < 448),
        batched AS (SELECT *, pos // 8 AS batch FROM stream)"""
    q["trim_bos"] = _with(f"""SELECT utt_id, batch, {_ints('CASE WHEN allb THEN labels[2:] ELSE labels END')} AS labels
        FROM (SELECT *, bool_and(coalesce(labels[1] = 2, false)) OVER (PARTITION BY batch) AS allb FROM batched)""",
                          bos_stream)
    q["decode_labels"] = _with("""SELECT utt_id, array_to_string(list_transform(list_filter(labels, lambda x: x >= 3),
        lambda x: CASE WHEN x = 3 THEN ' ' ELSE vl[x - 3] END), '') AS text
        FROM labelled, (SELECT list(char ORDER BY id) AS vl FROM vocab) v""", _VOCAB)
    q["ctc_greedy"] = f"""WITH f AS (
          SELECT CAST(floor(vec_id / 50) AS BIGINT) AS utt, vec_id AS frame,
                 CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS c FROM embeddings),
        g AS (SELECT utt, count(*) AS n_frames, list(c ORDER BY frame) AS cls FROM f GROUP BY utt)
        SELECT utt, CAST(n_frames AS INTEGER) AS n_frames, array_to_string(list_transform(list_filter(
            list_filter(cls, lambda x, i: i = 1 OR x <> cls[i - 1]), lambda x: x <> 0),
            lambda x: substr('{_ALPHABET}', x, 1)), '') AS text FROM g"""
    q["frame_mask"] = _with("""SELECT utt_id, 3000 AS n_frames, CAST(least(ceil(n_samples / 160), 3000) AS INTEGER) AS n_real FROM utt""")
    q["rank_slices"] = _with(f"""SELECT utt_id, pos, CAST((pos % {C.RANK_BATCH}) // {C.RANK_BATCH // C.RANK_N} AS INTEGER) AS rank
        FROM (SELECT utt_id, {_positions()} AS pos FROM utt)""")
    q["map_batches"] = _with("""SELECT utt_id, CAST(length(text) AS BIGINT) AS n_chars_py,
        CAST(len(list_filter(string_split(text, ''), lambda c: c <> lower(c))) AS BIGINT) AS n_upper FROM utt""")
    q["score_rows"] = _with("SELECT utt_id, hyp AS pred FROM utt")
    q["score_batches"] = _with("SELECT utt_id, hyp AS pred FROM utt")
    q["src_tar_shards"] = _with(f"SELECT {_basename('path')} AS member, CAST(44 AS BIGINT) AS size, n_samples, "
                                "CAST(sampling_rate AS BIGINT) AS sampling_rate FROM utt")
    q["src_sidecar_text"] = _with(f"SELECT {_stem('path')} AS stem, text || chr(10) AS text FROM utt")
    q["src_audiofolder"] = _with(f"""SELECT split, {_basename('path')} AS file_name, {_clean_transcript('raw')} AS transcription,
        source AS speaker, CAST(44 AS BIGINT) AS length FROM utt""")
    q["stream_prepare"] = _with("""SELECT utt_id, split, n_samples, CAST(length(text) AS INTEGER) AS label_length FROM utt
        WHERE n_samples > 0 AND n_samples < 480000 AND length(text) < 448""")
    noisy = _edits(_norm_words("raw"), _norm_words("hyp"))
    q["wer_pairs"] = _with("SELECT * FROM edits", noisy)
    q["wer_corpus"] = _with(_corpus(), noisy)
    q["wer_by_split"] = q["stream_wer"] = _with(_corpus("split"), noisy)
    gated = "gp AS (SELECT split, utt_id, raw, CASE WHEN split = 'validation' THEN raw ELSE hyp END AS hyp FROM utt),\n"
    gate = f"""gate AS (SELECT *, CASE WHEN wer > 0 AND wer < 100 THEN 'ok' ELSE 'suspicious' END AS status
        FROM ({_corpus("split")}))"""
    gate = _edits(_norm_words("raw"), _norm_words("hyp"), "gp", gated) + ",\n" + gate
    q["wer_gate"] = _with("SELECT * FROM gate", gate)
    ends = " UNION ALL ".join(f"""SELECT split, '{end}' AS "end", CAST(r AS INTEGER) AS rank_in_end, utt_id, raw AS reference, hyp AS prediction
        FROM (SELECT *, row_number() OVER (PARTITION BY split ORDER BY utt_id {way}) AS r FROM gp JOIN gate USING (split)
              WHERE status <> 'ok') WHERE r <= 5""" for end, way in (("head", "ASC"), ("tail", "DESC")))
    q["wer_gate_samples"] = _with(ends, gate)
    seen = "(SELECT list(char) FROM vocab)"
    known = lambda x: f"array_to_string(list_filter(string_split({x}, ''), lambda c: c = ' ' OR list_contains(known, c)), '')"
    from_ids = f"""{_VOCAB},
    dec AS (SELECT split, utt_id, {known('text')} AS ref, {known('hyp')} AS pred FROM utt, (SELECT {seen} AS known)),
    """
    q["wer_from_ids"] = _with(_corpus("split"), _edits(_norm_words("ref"), _norm_words("pred"), "dec", from_ids))
    return q
