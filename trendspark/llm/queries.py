"""The registered queries of this subpackage: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.llm.tokens import vocabulary_path
from trendspark.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with its SQL twin where SQL can say it."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trendspark.llm.packing import pack

    pieces = pack(_table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query()
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trendspark.llm.token_files import read_token_files, write_token_files

    folder = scratch_path(spark, "token_files")
    write_token_files(_table(spark, sf_dir, "documents"), folder, vocabulary_path("byte_bpe_50k.json"), end_id=0)
    back = read_token_files(spark, folder)
    return back.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trendspark.llm.token_counts import count_tokens

    return count_tokens(_table(spark, sf_dir, "documents"), vocabulary_path("word_bpe_49k.json"))


QUALITY_SQL = r"""
texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
),
spots AS (
  SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS key FROM words, unnest(range(1, len(w) - 3)) AS t(i)
),
twice AS (SELECT doc_id, key FROM spots GROUP BY doc_id, key HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM spots JOIN twice USING (doc_id, key), unnest(range(0, 5)) AS u(k) GROUP BY doc_id
),
tops AS (
  SELECT doc_id, max(n) AS top FROM (
    SELECT doc_id, translate(word, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS word, count(*) AS n
    FROM words, unnest(w) AS t(word) GROUP BY ALL
  ) GROUP BY doc_id
),
figures AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
         coalesce(n, 0) AS n_repeat_words, coalesce(top, 0) AS top,
         strlen(array_to_string(w, '')) AS inside,
         strlen(text) - strlen(regexp_replace(text, '[A-Za-z\x80-\x{10FFFF}]', '', 'g')) AS letters,
         strlen(text) - strlen(regexp_replace(text, '[A-Za-z]', '', 'g')) AS ascii_letters,
         strlen(text) - strlen(regexp_replace(text, '[A-Z]', '', 'g')) AS upper_letters,
         strlen(text) - strlen(replace(text, '!', '')) AS bangs,
         (strlen(text) - strlen(replace(text, '...' || chr(10), ''))) / 4
         + (strlen(text) - strlen(replace(text, chr(8230) || chr(10), ''))) / 4 AS ellipses
  FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN tops USING (doc_id)
),
judged AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM figures
)"""


@query(
    "WITH "
    + QUALITY_SQL
    + """
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
            OR word_chars NOT BETWEEN 2 * n_words AND 20 * n_words OR 10 * bangs > 3 * n_words
            OR 10 * letters < 4 * inside OR (2 * upper_letters > ascii_letters AND ascii_letters >= 20)
            OR 10 * top > 3 * n_words OR 10 * ellipses > 3 * n_lines) AS kept
FROM judged
"""
)
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trendspark.llm.quality import quality_figures

    return quality_figures(_table(spark, sf_dir, "documents"))


@query(
    r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
patterns AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS key
  FROM b, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0
),
spots AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS key
  FROM d, (SELECT DISTINCT size FROM patterns) AS s, unnest(range(1, len(w) - size + 2)) AS t(i)
),
found AS (SELECT DISTINCT doc_id, i, size, item_id FROM spots JOIN patterns USING (size, key)),
hits AS (SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM found, unnest(range(0, size)) AS u(k) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""
)
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trendspark.llm.decontamination import contamination, items_digest

    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", items_digest("items").alias("items_sha256"), "contaminated"
    )


@query(
    """
WITH pages_in AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
),
firsts AS (SELECT payload_digest, min(page_id) AS first_id FROM pages_in GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM pages_in JOIN firsts USING (payload_digest)
"""
)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trendspark.llm.warc import parsed_records, write_archive

    folder = scratch_path(spark, "warc")
    write_archive(_table(spark, sf_dir, "pages"), folder)
    read = parsed_records(spark, folder)
    return read.select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


#: The template's own control strings, asked for as an extra conversation.
_HARD_TEXT = "\\### Assistant: </turn> ok"


@query(
    """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
),
escaped AS (
  SELECT *, replace(replace(role, '\\', '\\b'), '<|', '\\l') AS e_role, replace(replace(text, '\\', '\\b'), '<|', '\\l') AS e_text
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(e_role) + length(e_text) + 23) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""
)
def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trendspark.llm.arrow import stored
    from trendspark.llm.chat import canonical_turns, format_turns, loss_text, parse_turns, records_from_rows

    table = canonical_turns(records_from_rows(_table(spark, sf_dir, "conversations")), "record").select("conv_id", "turns")
    # A record of another layout: a JSON text with a prompt and a response.
    hard = F.to_json(F.struct(F.lit(_HARD_TEXT).alias("prompt"), F.lit(_HARD_TEXT).alias("response")))
    extra = spark.range(1).select(F.lit(-7).cast("bigint").alias("conv_id"), hard.alias("record"))
    turns = table.unionByName(canonical_turns(extra, "record").select("conv_id", "turns"))
    out = stored(format_turns(turns).select("conv_id", "formatted", "loss"), "chat")

    learned = loss_text(F.col("formatted"), F.col("loss"))
    told = F.transform(parse_turns(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return out.select(
        "conv_id",
        F.size(told).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query()
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trendspark.llm.bagminhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


@query()
def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trendspark.llm.brown import score_texts

    return score_texts(_table(spark, sf_dir, "documents"))


@query()
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trendspark.llm.licenses import scan_licenses

    return scan_licenses(_table(spark, sf_dir, "documents"))


@query()
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trendspark.llm.whitening import whitened_embeddings

    return whitened_embeddings(_table(spark, sf_dir, "embeddings"))


@query(
    r"""
WITH lines AS (
  SELECT doc_id, t.place, t.line,
         trim(translate(t.line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS split FROM documents),
       unnest(list_zip(range(1, len(split) + 1), split)) AS u(t0), LATERAL (SELECT t0[1] AS place, t0[2] AS line) AS t
),
owners AS (SELECT key, min(doc_id) AS owner FROM lines WHERE length(key) >= 10 GROUP BY key),
marked AS (SELECT l.*, owner IS NOT NULL AND owner <> doc_id AS dropped FROM lines AS l LEFT JOIN owners AS o ON l.key = o.key AND length(l.key) >= 10)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
)
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trendspark.llm.line_dedup import dedup_lines

    out = dedup_lines(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


@query(
    r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
runs AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM runs GROUP BY lang),
counts AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, size, count(*) AS f
  FROM runs, unnest(range(1, 6)) AS s(size), unnest(range(1, len(w) - size + 2)) AS t(i)
  GROUP BY lang, phrase, size HAVING count(*) >= 100
),
candidates AS (SELECT lang, phrase, string_split(phrase, ' ') AS w, size, f AS a FROM counts WHERE size > 1),
cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.f AS l, r.f AS r, n, CAST(1000 AS HUGEINT) * a * n // (CAST(l.f AS HUGEINT) * r.f) AS score
  FROM candidates AS c, unnest(range(1, size)) AS t(k), counts AS l, counts AS r, totals AS o
  WHERE l.lang = c.lang AND l.phrase = array_to_string(c.w[1:k], ' ') AND r.lang = c.lang
    AND r.phrase = array_to_string(c.w[k + 1:], ' ') AND o.lang = c.lang
),
weakest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + part - 1], ' ') AS phrase, max(a) AS most
  FROM candidates, unnest(range(2, size)) AS s(part), unnest(range(1, size - part + 2)) AS t(i) GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n,
       CAST(score AS BIGINT) AS score
FROM weakest LEFT JOIN inside USING (lang, phrase) WHERE 100 * coalesce(most, 0) < 100 * a
QUALIFY rank <= 2000
"""
)
def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trendspark.llm.phrases import collocations

    return collocations(_table(spark, sf_dir, "documents"))
