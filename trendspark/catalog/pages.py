"""Page-feature queries. Watch pages are written from table rows and parsed back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.catalog.base import query, table
from trendspark.functions import pages as P
from trendspark.plans.pages import page_features as page_features_plan
from trendspark.session import c

# Which page carries what, by part key; the SQL twins use the same rules.
KEY = "p_partkey"


def _under(path: str, leaf: Column) -> Column:
    """'a.b' and a column to struct(a: struct(b: column))."""
    out = leaf
    for name in reversed(path.split(".")):
        out = F.struct(out.alias(name))
    return out


def _markers(words: Column) -> Column:
    chapters = F.transform(
        words,
        lambda w, i: F.struct(
            F.struct(F.struct(w.alias("simpleText")).alias("title"), ((i + 1) * 61500).alias("timeRangeStartMillis")).alias("chapterRenderer")
        ),
    )
    empty = F.filter(chapters, lambda _: F.lit(False))
    entries = F.array(
        F.struct(F.lit("OTHER").alias("key"), F.struct(empty.alias("chapters")).alias("value")),
        F.struct(F.lit("AUTO_CHAPTERS").alias("key"), F.struct(chapters.alias("chapters")).alias("value")),
    )
    path = "playerOverlayRenderer.decoratedPlayerBarRenderer.decoratedPlayerBarRenderer.playerBar.multiMarkersPlayerBarRenderer.markersMap"
    return _under(path, entries)


def watch_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, html, player, initial): one page per part; every eleventh failed to load."""
    key, name, size = c(KEY), c("p_name"), c("p_size")
    words = F.split(name, " ")
    description = F.concat(F.lit("Welcome\n0:00 Intro\n1:30  "), name, F.lit(" \n10:05\tOutro\nend"))
    card = lambda i: F.struct(
        F.struct(
            F.concat(i.cast("string"), F.lit("000")).alias("startCardActiveMs"),
            F.when(i % 2 == 0, _under("simpleCardTeaserRenderer.message.simpleText", name)).alias("teaser"),
        ).alias("cardRenderer")
    )
    cards = F.transform(F.sequence(F.lit(1), size % 3 + 1), card)
    player = F.struct(
        F.when(key % 3 == 0, _markers(words)).alias("playerOverlays"),
        F.when(key % 3 != 2, F.struct(description.alias("shortDescription"))).alias("videoDetails"),
        F.when(
            key % 5 != 0,
            F.struct(
                F.when(key % 5 == 1, "LOGIN_REQUIRED").when(key % 5 != 2, "OK").alias("status"),
                F.when(key % 5 == 3, F.lit(False)).alias("playableInEmbed"),
            ),
        ).alias("playabilityStatus"),
        F.struct(F.struct((size % 2 == 0).alias("isFamilySafe")).alias("playerMicroformatRenderer")).alias("microformat"),
        F.when(size % 4 != 0, _under("cardCollectionRenderer.cards", cards)).alias("cards"),
        F.when(key % 4 == 0, F.struct(F.lit("Includes paid promotion").alias("text"))).alias("paidContentOverlay"),
    )
    badge = F.struct(
        F.struct(
            F.when(key % 6 == 1, F.struct(F.lit("Verified").alias("label"))).when(key % 6 != 1, F.struct(c("p_brand").alias("label"))).alias("accessibilityData"),
            F.when(key % 6 == 2, "BADGE_STYLE_TYPE_VERIFIED_ARTIST").alias("style"),
            F.when(key % 6 == 3, F.struct(F.lit("CHECK_CIRCLE_THICK").alias("iconType"))).alias("icon"),
        ).alias("metadataBadgeRenderer")
    )
    owner = F.when(key % 6 != 5, _under("owner.videoOwnerRenderer.badges", F.array(badge)))
    section = _under("contents", F.array(F.struct(F.when(size % 5 == 0, F.struct(F.lit("off").alias("text"))).alias("messageRenderer"), F.lit(1).alias("n"))))
    none_owner, none_section = F.when(F.lit(False), _under("owner.videoOwnerRenderer.badges", F.array(badge))), F.when(F.lit(False), section)
    contents = F.array(
        F.struct(none_owner.alias("videoSecondaryInfoRenderer"), none_section.alias("itemSectionRenderer")),
        F.struct(owner.alias("videoSecondaryInfoRenderer"), none_section.alias("itemSectionRenderer")),
        F.struct(none_owner.alias("videoSecondaryInfoRenderer"), section.alias("itemSectionRenderer")),
    )
    initial = _under("contents.twoColumnWatchNextResults.results.results.contents", contents)
    marker_initial = F.struct(_markers(words).alias("playerOverlays"))
    initial_json = F.when(key % 3 == 2, F.to_json(marker_initial)).otherwise(F.to_json(initial))
    rows = table(spark, sf_dir, "part").select(KEY, "p_name", "p_size", "p_brand", F.to_json(player).alias("player"), initial_json.alias("initial"))
    html = F.concat(
        F.lit("<html><head><script>var other = {};</script>\n<script nonce='x'>var ytInitialPlayerResponse = {oops};</script>\n<script>var ytInitialPlayerResponse = "),
        c("player"),
        F.lit(";</script></head><body><p>ytInitialData</p><script>\nvar ytInitialData   =\n"),
        c("initial"),
        F.lit(";</script></body></html>"),
    )
    return rows.select(KEY, F.when(key % 11 != 0, html).alias("html"), "player", "initial")


def parsed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, player, initial) as parsed structs."""
    pages = watch_pages(spark, sf_dir)
    return pages.select(KEY, P.parse_player(c("player")).alias("player"), P.parse_initial(c("initial")).alias("initial"))


# Chapters: titles and starts by where they come from.
_CHAPTERS_SQL = """
ch AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 1 THEN 3 ELSE len(string_split(p_name, ' ')) END AS n,
  CASE WHEN p_partkey % 3 = 1 THEN 'Intro|' || p_name || '|Outro' ELSE replace(p_name, ' ', '|') END AS titles,
  CASE WHEN p_partkey % 3 = 1 THEN 0 + 90 + 605 ELSE list_sum(list_transform(range(1, len(string_split(p_name, ' ')) + 1), lambda i: (i * 61500) // 1000)) END AS seconds
  FROM part)"""


def _chapter_columns(chapters: Column) -> list[Column]:
    return [
        F.size(chapters).alias("chapter_count"),
        F.array_join(F.transform(chapters, lambda x: x["title"]), "|").alias("titles"),
        F.aggregate(chapters, F.lit(0).cast("bigint"), lambda a, x: a + x["start_seconds"]).alias("seconds"),
    ]


@query(f"WITH {_CHAPTERS_SQL} SELECT p_partkey, cast(n AS int) AS chapter_count, titles, cast(seconds AS bigint) AS seconds FROM ch")
def page_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Player markers, else initial-data markers, else description lines."""
    pages = parsed_pages(spark, sf_dir).select(KEY, P.chapters(c("player"), c("initial")).alias("ch"))
    return pages.select(KEY, *_chapter_columns(c("ch")))


@query("SELECT event_id, 2 AS chapter_count, 'Start|' || event_type AS titles, cast(hour(ts) * 60 + minute(ts) AS bigint) AS seconds FROM events")
def chapters_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """'mm:ss title' lines of a description."""
    text = F.concat(F.lit("See below\n0:00 Start\n"), F.date_format("ts", "H:mm"), F.lit("   "), c("event_type"), F.lit("\nno 1:2 stamp"))
    rows = table(spark, sf_dir, "events").select("event_id", P.chapters_from_text(text).alias("ch"))
    return rows.select("event_id", *_chapter_columns(c("ch")))


@query(
    """SELECT p_partkey, p_partkey % 11 <> 0 AS player_found, p_partkey % 11 <> 0 AS initial_found FROM part"""
)
def script_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The extracted JSON equals the one written; an earlier invalid assignment is passed over."""
    pages = watch_pages(spark, sf_dir)
    same_player = P.script_json(c("html"), P.PLAYER_KEY).eqNullSafe(c("player"))
    same_initial = P.script_json(c("html"), P.INITIAL_KEY).eqNullSafe(c("initial"))
    return pages.select(KEY, same_player.alias("player_found"), same_initial.alias("initial_found"))


@query("SELECT page_id, false AS has_player, regexp_matches(html, '(?s)<script') AS has_script FROM pages")
def script_json_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordinary pages hold scripts but no player data."""
    return table(spark, sf_dir, "pages").select(
        "page_id", P.script_json(c("html"), P.PLAYER_KEY).isNotNull().alias("has_player"), c("html").rlike(r"(?s)<script").alias("has_script")
    )


@query(
    """SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'LOGIN_REQUIRED' WHEN 2 THEN 'UNKNOWN' ELSE 'OK' END AS status,
  p_partkey % 5 <> 0 AND p_size % 2 = 0 AS supports_miniplayer, p_partkey % 5 = 1 AS is_age_restricted, p_partkey % 5 <> 3 AS is_embeddable FROM part"""
)
def page_playability(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_pages(spark, sf_dir).select(KEY, P.playability(c("player")).alias("p")).select(KEY, "p.*")


@query(
    """SELECT p_partkey, cast(CASE WHEN p_size % 4 = 0 THEN 0 ELSE p_size % 3 + 1 END AS int) AS card_count,
  CASE WHEN p_size % 4 = 0 THEN '' ELSE array_to_string(list_transform(range(1, p_size % 3 + 2), lambda i: CASE WHEN i % 2 = 0 THEN p_name ELSE '' END || '@' || i || '000'), '|') END AS cards FROM part"""
)
def page_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    cards = parsed_pages(spark, sf_dir).select(KEY, P.cards(c("player")).alias("k"))
    shown = F.transform("k", lambda x: F.concat_ws("@", x["teaser_text"], x["start_ms"]))
    return cards.select(KEY, F.size("k").alias("card_count"), F.array_join(shown, "|").alias("cards"))


@query(
    """SELECT p_partkey, p_partkey % 3 <> 2 AND p_partkey % 6 IN (1, 2, 3) AS is_verified,
  CASE WHEN p_partkey % 3 = 2 OR p_partkey % 6 = 5 THEN '' WHEN p_partkey % 6 = 1 THEN 'Verified' ELSE p_brand END AS badge_labels FROM part"""
)
def page_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    owner = parsed_pages(spark, sf_dir).select(KEY, P.verified(c("initial")).alias("v"))
    return owner.select(KEY, F.col("v.is_verified").alias("is_verified"), F.array_join("v.badge_labels", "|").alias("badge_labels"))


@query("SELECT p_partkey, p_partkey % 3 <> 2 AND p_size % 5 = 0 AS comments_disabled FROM part")
def page_comments_disabled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_pages(spark, sf_dir).select(KEY, P.comments_disabled(c("initial")).alias("comments_disabled"))


@query("SELECT p_partkey, p_partkey % 4 = 0 AS has_paid_promotion FROM part")
def page_paid_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsed_pages(spark, sf_dir).select(KEY, P.paid_promotion(c("player")).alias("has_paid_promotion"))


@query(
    f"""WITH {_CHAPTERS_SQL}
SELECT p_partkey, cast(n AS int) AS chapter_count, CASE p_partkey % 5 WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'LOGIN_REQUIRED' WHEN 2 THEN 'UNKNOWN' ELSE 'OK' END AS playability_status,
  p_partkey % 5 <> 0 AND p_size % 2 = 0 AS supports_miniplayer, cast(CASE WHEN p_size % 4 = 0 THEN 0 ELSE p_size % 3 + 1 END AS int) AS card_count,
  p_partkey % 3 <> 2 AND p_partkey % 6 IN (1, 2, 3) AS is_verified, p_partkey % 3 <> 2 AND p_size % 5 = 0 AS comments_disabled, p_partkey % 4 = 0 AS has_paid_promotion
FROM part JOIN ch USING (p_partkey) WHERE p_partkey % 11 <> 0"""
)
def page_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From HTML to one feature row per page; failed pages are removed."""
    out = page_features_plan(watch_pages(spark, sf_dir).select(KEY, "html"), KEY)
    return out.drop("chapters", "cards", "badge_labels")
