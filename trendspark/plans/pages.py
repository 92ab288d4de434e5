"""One feature row per saved page."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.functions import pages as P
from trendspark.session import c


def page_features(df: DataFrame, key: str = "video_id", html: str = "html") -> DataFrame:
    """The eleven page columns. Pages without content (failed downloads) are removed.

    Each page is searched for scripts once and each JSON text is parsed once; nothing is shuffled.
    """
    scripts = df.filter(c(html).isNotNull()).select(c(key), P.script_bodies(c(html)).alias("_scripts"))
    texts = scripts.select(
        c(key),
        P.assigned_json(c("_scripts"), P.PLAYER_KEY).alias("_player"),
        P.assigned_json(c("_scripts"), P.INITIAL_KEY).alias("_initial"),
    )
    structs = texts.select(c(key), P.parse_player(c("_player")).alias("_player"), P.parse_initial(c("_initial")).alias("_initial"))
    parsed = structs.select(
        c(key),
        P.chapters(c("_player"), c("_initial")).alias("chapters"),
        P.playability(c("_player")).alias("_play"),
        P.cards(c("_player")).alias("cards"),
        P.verified(c("_initial")).alias("_owner"),
        P.comments_disabled(c("_initial")).alias("comments_disabled"),
        P.paid_promotion(c("_player")).alias("has_paid_promotion"),
    )
    return parsed.select(
        c(key),
        F.size("chapters").alias("chapter_count"),
        "chapters",
        F.col("_play.status").alias("playability_status"),
        F.col("_play.supports_miniplayer").alias("supports_miniplayer"),
        F.size("cards").alias("card_count"),
        "cards",
        F.col("_owner.is_verified").alias("is_verified"),
        F.col("_owner.badge_labels").alias("badge_labels"),
        "comments_disabled",
        "has_paid_promotion",
    )
