"""Text, time and value-transform queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.catalog.base import VIDEOS_SQL, query, rounded, table, videos
from trendspark.functions import text, times
from trendspark.operators import transforms
from trendspark.operators.checks import blank_counts as count_blanks
from trendspark.operators.encoding import clean_language as clean_language_op
from trendspark.plans.features import text_features
from trendspark.session import c

# --- tags and text ----------------------------------------------------------------

# Tag text in every form the parser accepts, built from a table's own words.
_TAG_TEXT_SQL = """
tagged AS (
  SELECT p_partkey, p_name, CASE p_partkey % 5
    WHEN 0 THEN '[''' || replace(p_name, ' ', ''', ''') || ''']'
    WHEN 1 THEN replace(p_name, ' ', ', ') || ', '
    WHEN 2 THEN NULL
    WHEN 3 THEN '  [[' || replace(p_name, ' ', ',,') || ']] '
    ELSE '[]' END AS tags
  FROM part)"""


def _tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    form = F.col("p_partkey") % 5
    name = F.col("p_name")
    tags = (
        F.when(form == 0, F.concat(F.lit("['"), F.replace(name, F.lit(" "), F.lit("', '")), F.lit("']")))
        .when(form == 1, F.concat(F.replace(name, F.lit(" "), F.lit(", ")), F.lit(", ")))
        .when(form == 2, F.lit(None).cast("string"))
        .when(form == 3, F.concat(F.lit("  [["), F.replace(name, F.lit(" "), F.lit(",,")), F.lit("]] ")))
        .otherwise("[]")
    )
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", tags.alias("tags"))


@query(
    f"""WITH {_TAG_TEXT_SQL},
s AS (SELECT p_partkey, list_filter(list_transform(string_split(
    regexp_replace(trim(tags), '^[\\[\\]]+|[\\[\\]]+$', '', 'g'), ','), lambda x: trim(x)), lambda x: x <> '') AS t FROM tagged)
SELECT p_partkey, cast(coalesce(len(t), 0) AS int) AS n_tags, coalesce(array_to_string(t, '|'), '') AS tags FROM s"""
)
def normalize_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tag text to a list: brackets go, quotes stay, blanks drop."""
    out = _tagged(spark, sf_dir).select("p_partkey", text.split_tags(c("tags")).alias("t"))
    return out.select("p_partkey", F.size("t").alias("n_tags"), F.array_join("t", "|").alias("tags"))


@query(
    f"""WITH {_TAG_TEXT_SQL}
SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN replace(p_name, ' ', '|') ELSE '' END AS parsed FROM tagged"""
)
def parse_tag_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """List literals parse; any other text is an empty list."""
    rows = _tagged(spark, sf_dir).filter("p_partkey % 5 <> 3").unionByName(
        _tagged(spark, sf_dir).filter("p_partkey % 5 = 3").withColumn("tags", F.trim("p_name"))
    )
    return rows.select("p_partkey", F.array_join(text.parse_list_text(c("tags")), "|").alias("parsed"))


@query(
    f"""WITH {_TAG_TEXT_SQL}
SELECT p_partkey, cast(coalesce(len(string_split(tags, ',')), 0) AS int) AS tag_count FROM tagged"""
)
def tag_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma pieces of tag text; '[]' counts one, null counts none."""
    return _tagged(spark, sf_dir).select("p_partkey", text.comma_pieces(c("tags")).alias("tag_count"))


@query("SELECT p_partkey, replace(p_name, ' ', '; ') AS tags_joined FROM part")
def join_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of a name as a list with a null entry, joined again by another sign."""
    tags = F.concat(F.split("p_name", " "), F.array(F.lit(None).cast("string")))
    return table(spark, sf_dir, "part").select("p_partkey", text.join_tags(tags, "; ").alias("tags_joined"))


@query("SELECT doc_id, cast(coalesce(length(text), 0) AS int) AS text_length, cast(coalesce(length(CASE WHEN lang = 'en' THEN source END), 0) AS int) AS source_length FROM documents")
def text_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.when(c("lang") == "en", c("source"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.text_length(c("text")).alias("text_length"), text.text_length(source).alias("source_length")
    )


@query(
    r"""SELECT doc_id, CASE WHEN length(text) = 0 THEN 0.0 ELSE round(len(regexp_extract_all(text, '\p{Lu}')) / length(text)::double, 6) END AS caps_ratio
FROM documents"""
)
def caps_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(table(spark, sf_dir, "documents").select("doc_id", text.caps_ratio(c("text")).alias("caps_ratio")), "caps_ratio", digits=6)


_EMOJI = ["🌍", "👨‍👩‍👧", "🇫🇷", "✨🔥", "1️⃣", "no"]
_EMOJI_COUNTS = [1, 1, 1, 2, 1, 0]


@query(
    "WITH n AS (SELECT doc_id, cast(doc_id % 6 AS int) AS k, cast(doc_id % 4 AS int) AS times FROM documents) "
    f"SELECT doc_id, cast(list_value({', '.join(map(str, _EMOJI_COUNTS))})[k + 1] * times AS int) AS emoji_count FROM n"
)
def emoji_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Emoji sequences in document text, after planting a known number of them in each."""
    docs = table(spark, sf_dir, "documents")
    mark = F.get(F.array(*[F.lit(e) for e in _EMOJI]), (c("doc_id") % 6).cast("int"))
    # Symbols that are no emoji stand beside the planted ones; the texts themselves are counted as they are.
    planted = F.concat(c("text"), F.lit(" ♪ ★ ✓ ☰ ❶ ➜ 🄐"), F.repeat(F.concat(F.lit(" "), mark), (c("doc_id") % 4).cast("int")))
    return docs.select("doc_id", text.emoji_count(planted).alias("emoji_count"))


@query(
    r"""SELECT doc_id, regexp_matches(text, '[^\x00-\x7F]') AS has_emoji, contains(text, '?') AS has_question, contains(text, '#') AS has_hashtag,
  len(regexp_extract_all(text, '\p{Lu}')) / (length(text) + 1)::double > 0.05 AS has_caps FROM documents"""
)
def title_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = text.title_flags(c("text"), caps_share=0.05)
    return table(spark, sf_dir, "documents").select("doc_id", *[e.alias(n) for n, e in flags.items()])


_CODES_SQL = """
coded AS (SELECT c_custkey, CASE c_nationkey % 5 WHEN 0 THEN 'en-US' WHEN 1 THEN 'pt-BR' WHEN 2 THEN 'FR' WHEN 3 THEN NULL ELSE 'xx-YY' END AS code FROM customer)"""


def _coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = F.col("c_nationkey") % 5
    code = F.when(pick == 0, "en-US").when(pick == 1, "pt-BR").when(pick == 2, "FR").when(pick == 4, "xx-YY")
    return table(spark, sf_dir, "customer").select("c_custkey", code.alias("code"))


@query(
    f"""WITH {_CODES_SQL}
SELECT c_custkey, CASE WHEN code IS NOT NULL THEN string_split(code, '-')[1] END AS lang_base, coalesce(string_split(code, '-')[2], 'NO') AS lang_region FROM coded"""
)
def language_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coded(spark, sf_dir).select(
        "c_custkey", text.language_base(c("code")).alias("lang_base"), text.language_region(c("code")).alias("lang_region")
    )


@query(f"WITH {_CODES_SQL} SELECT c_custkey, lower(string_split(code, '-')[1]) AS lang FROM coded")
def normalize_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coded(spark, sf_dir).select("c_custkey", text.normalize_language(c("code")).alias("lang"))


@query(
    f"""WITH {_CODES_SQL}
SELECT c_custkey, CASE WHEN code IS NOT NULL AND lower(string_split(code, '-')[1]) NOT IN (SELECT DISTINCT lang FROM documents) THEN 'unknown' ELSE code END AS code
FROM coded"""
)
def clean_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes whose base language has no documents become 'unknown'."""
    known = table(spark, sf_dir, "documents").select(c("lang").alias("code")).distinct()
    return clean_language_op(_coded(spark, sf_dir), "code", known)


@query(
    """SELECT doc_id, coalesce(CASE WHEN source = 'web' THEN source END, '') AS filled, CASE WHEN lang = 'en' OR source = '' THEN 'no text' ELSE source END AS embedded FROM documents"""
)
def fill_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(c("source") == "web", c("source")).alias("filled"),
        F.when(c("lang") != "en", c("source")).otherwise("").alias("embedded"),
    )
    return transforms.fill_text(transforms.fill_text(docs, ["filled"]), ["embedded"], "no text", True)


@query(
    r"""SELECT d.doc_id, cast(len(string_split(d.source, ',')) AS int) AS tag_count, cast(length(d.source) AS int) AS title_length,
  cast(length(d.text) AS int) AS description_length, round(len(regexp_extract_all(d.source, '\p{Lu}')) / greatest(length(d.source), 1)::double, 4) AS title_has_caps_ratio
FROM documents d"""
)
def text_feature_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text features of a record in one projection."""
    docs = table(spark, sf_dir, "documents").select("doc_id", c("source").alias("title"), c("text").alias("description"), c("source").alias("tags"))
    out = text_features(docs).select("doc_id", "tag_count", "title_length", "description_length", "title_has_caps_ratio")
    return rounded(out, "title_has_caps_ratio")


# --- time ---------------------------------------------------------------------------


@query(
    """SELECT event_id, cast(hour(ts) AS int) AS hour, cast(isodow(ts) - 1 AS int) AS weekday, cast(month(ts) AS int) AS month, cast(year(ts) AS int) AS year,
  cast(quarter(ts) AS int) AS quarter, isodow(ts) >= 6 AS is_weekend FROM events"""
)
def time_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = times.time_parts(c("ts"))
    return table(spark, sf_dir, "events").select("event_id", *[e.alias(n) for n, e in parts.items()])


@query(
    """SELECT l_orderkey, l_linenumber, cast(sum(CASE WHEN l_suppkey % 4 = 0 THEN 0 WHEN l_suppkey % 4 = 1 THEN l_quantity * 60 + l_linenumber
  WHEN l_suppkey % 4 = 2 THEN l_linenumber * 86400 + l_quantity * 3600 ELSE l_quantity END) AS bigint) AS seconds FROM lineitem GROUP BY 1, 2"""
)
def duration_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations written from line figures in several forms, parsed back and summed."""
    form, q, n = F.col("l_suppkey") % 4, F.col("l_quantity").cast("int").cast("string"), F.col("l_linenumber").cast("string")
    written = (
        F.when(form == 0, F.concat(F.lit("P"), q, F.lit("X")))
        .when(form == 1, F.concat(F.lit("PT"), q, F.lit("M"), n, F.lit("S")))
        .when(form == 2, F.concat(F.lit("P"), n, F.lit("DT"), q, F.lit("H")))
        .otherwise(F.concat(F.lit("PT"), q, F.lit("S")))
    )
    texts = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", written.alias("duration"))
    lines = texts.select("l_orderkey", "l_linenumber", times.duration_seconds(c("duration")).alias("s"))
    return lines.groupBy("l_orderkey", "l_linenumber").agg(F.sum("s").alias("seconds"))


@query("SELECT event_id, cast(hour(ts) * 60 + minute(ts) AS int) AS seconds FROM events")
def clock_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", times.clock_seconds(F.date_format("ts", "H:mm")).alias("seconds"))


@query("SELECT event_id, strftime(ts, '%a') AS day FROM events")
def day_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", times.day_label(times.weekday(c("ts"))).alias("day"))


# --- values -------------------------------------------------------------------------


@query(
    """SELECT c_custkey, round(ln(greatest(c_acctbal, 0) + 1), 4) AS natural_log, round(log2(greatest(c_acctbal, 0) + 1), 4) AS log2, round(log10(greatest(c_acctbal, 0) + 1), 4) AS log10 FROM customer"""
)
def log_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of balances, negatives as 0."""
    df = table(spark, sf_dir, "customer").select("c_custkey", *[c("c_acctbal").alias(n) for n in ("natural_log", "log2", "log10")])
    for name, base in (("natural_log", "natural"), ("log2", "log2"), ("log10", "log10")):
        df = transforms.log_transform(df, [name, "not_there"], base)
    return rounded(df, "natural_log", "log2", "log10")


@query("SELECT c_custkey, round(c_acctbal, 4) AS c_acctbal, round(sqrt(c_nationkey), 4) AS c_nationkey FROM customer")
def sqrt_transform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Square roots; the balance column holds negatives and stays."""
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey")
    return rounded(transforms.sqrt_transform(df, ["c_acctbal", "c_nationkey"]), "c_acctbal", "c_nationkey")


@query("SELECT l_orderkey, l_linenumber, round(exp(l_discount) - 1, 6) AS back FROM lineitem")
def inverse_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", c("l_discount").alias("back"))
    return rounded(transforms.inverse_log(lines, "back"), "back", digits=6)


@query(
    """WITH b AS (SELECT quantile_cont(c_acctbal, 0.25) AS q1, quantile_cont(c_acctbal, 0.75) AS q3 FROM customer)
SELECT c_custkey, round(least(greatest(c_acctbal, q1 - 0.2 * (q3 - q1)), q3 + 0.2 * (q3 - q1)), 4) AS c_acctbal FROM customer, b"""
)
def cap_outliers_iqr(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return rounded(transforms.cap_outliers(df, ["c_acctbal"], "iqr", k=0.2), "c_acctbal")


@query(
    """WITH b AS (SELECT avg(l_extendedprice) AS m, stddev_samp(l_extendedprice) AS s FROM lineitem)
SELECT l_orderkey, l_linenumber, round(least(greatest(l_extendedprice, m - s), m + s), 4) AS l_extendedprice, least(greatest(cast(l_quantity AS bigint), 0), 20) AS chapter_count FROM lineitem, b"""
)
def cap_outliers_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    """z-score fences for prices, the fixed range for a chapter count."""
    df = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", c("l_quantity").cast("bigint").alias("chapter_count"))
    return rounded(transforms.cap_outliers(df, ["l_extendedprice", "chapter_count"], "zscore", z=1.0), "l_extendedprice")


@query("SELECT l_orderkey, l_linenumber, least(l_quantity, 20) AS l_quantity FROM lineitem")
def clip_upper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transforms.clip_upper(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), "l_quantity", 20.0)


@query(
    f"""WITH {VIDEOS_SQL}
SELECT video_id, CASE WHEN "categoryId" = 1 THEN NULL ELSE view_count END AS view_count, "categoryId" IN (2, 3) AS embeddable FROM videos"""
)
def cast_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text counts and flags to types; text that is no number becomes null."""
    kind = c("categoryId")
    raw = videos(spark, sf_dir).select(
        "video_id",
        F.when(kind == 1, "invalid").otherwise(c("view_count").cast("string")).alias("view_count"),
        F.when(kind == 2, "True").when(kind == 3, "TRUE").when(kind == 4, "no").when(kind == 5, "False").alias("embeddable"),
    )
    return transforms.cast_types(raw, ["view_count", "likes"], ["embeddable"])


@query(
    """SELECT doc_id, CASE WHEN length(text) <= 0 THEN NULL WHEN length(text) <= 200 THEN '<=200' WHEN length(text) <= 400 THEN '201-400' WHEN length(text) <= 2000 THEN '401-2000' END AS bin FROM documents"""
)
def bin_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.length("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.right_closed_bin(size, [0, 200, 400, 2000], ["<=200", "201-400", "401-2000"]).alias("bin")
    )


@query(
    f"""WITH {VIDEOS_SQL}
SELECT video_id, CASE WHEN comment_count IS NULL AND comments_disabled THEN 0 ELSE comment_count END AS comment_count FROM videos"""
)
def fill_when(spark: SparkSession, sf_dir: str) -> DataFrame:
    vids = videos(spark, sf_dir).select("video_id", "comment_count", "comments_disabled")
    return transforms.fill_when(vids, "comment_count", c("comments_disabled"), 0).drop("comments_disabled")


@query(
    """WITH s AS (SELECT avg(c_acctbal) AS m, stddev_samp(c_acctbal) AS d, stddev_pop(c_acctbal) AS p FROM customer)
SELECT c_custkey, round((c_acctbal - m) / d, 4) AS c_acctbal_z, round((c_acctbal - m) / p, 4) AS c_acctbal_p FROM customer, s"""
)
def zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = transforms.zscore(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])
    df = transforms.zscore(df, ["c_acctbal"], ddof=0, suffix="_p")
    return rounded(df.drop("c_acctbal"), "c_acctbal_z", "c_acctbal_p")


@query(
    """WITH t AS (SELECT quantile_cont(s_acctbal, 0.5) AS m, quantile_cont(s_acctbal, 0.75) - quantile_cont(s_acctbal, 0.25) AS iqr,
  quantile_cont(s_nationkey, 0.5) AS mn, quantile_cont(s_nationkey, 0.75) - quantile_cont(s_nationkey, 0.25) AS iqrn FROM supplier WHERE s_suppkey % 5 <> 0)
SELECT s_suppkey, round((s_acctbal - m) / iqr, 4) AS s_acctbal, round((s_nationkey - mn) / iqrn, 4) AS s_nationkey, 0.0::double AS constant
FROM supplier, t WHERE s_suppkey % 5 = 0"""
)
def robust_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on four fifths of the suppliers, applied to the rest; a constant column divides by 1."""
    rows = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal", "s_nationkey", F.lit(7).alias("constant"))
    scale = transforms.RobustScale.fit(rows.filter("s_suppkey % 5 <> 0"), ["s_acctbal", "s_nationkey", "constant"])
    return rounded(scale.apply(rows.filter("s_suppkey % 5 = 0")), "s_acctbal", "s_nationkey", "constant")


@query(
    """SELECT 'text' AS "column", count(*) FILTER (regexp_matches(CASE WHEN d.doc_id % 3 = 0 THEN '  ' || chr(9) ELSE d.text END, '^\\s*$')) AS blanks FROM documents d
UNION ALL SELECT 'source', count(*) FILTER (regexp_matches(CASE WHEN lang = 'en' THEN '' WHEN lang = 'fr' THEN NULL ELSE source END, '^\\s*$')) FROM documents"""
)
def blank_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.when(c("doc_id") % 3 == 0, "  \t").otherwise(c("text")).alias("text"),
        F.when(c("lang") == "en", "").when(c("lang") != "fr", c("source")).alias("source"),
    )
    return count_blanks(docs, ["text", "source", "not_there"])
