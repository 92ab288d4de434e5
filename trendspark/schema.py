"""Record schemas and column groups."""

from __future__ import annotations

from pyspark.sql import types as T

# Column order of the raw video table.
RAW_COLUMNS = [
    "video_id",
    "title",
    "publishedAt",
    "channelId",
    "channelTitle",
    "categoryId",
    "trending_date",
    "tags",
    "view_count",
    "likes",
    "comment_count",
    "thumbnail_link",
    "description",
    "is_trending",
    "defaultLanguage",
    "duration",
    "dimension",
    "definition",
    "caption",
    "licensedContent",
    "projection",
    "embeddable",
    "madeForKids",
    "favoriteCount",
    "contentDetails.regionRestriction.blocked",
    "contentDetails.regionRestriction.allowed",
    "contentDetails.contentRating.ytRating",
    "chapter_count",
    "chapters",
    "playability_status",
    "supports_miniplayer",
    "card_count",
    "cards",
    "is_verified",
    "badge_labels",
    "comments_disabled",
    "has_paid_promotion",
]

# Columns removed by cleaning.
CLEANING_DROPS = [
    "thumbnail_link",
    "chapters",
    "cards",
    "badge_labels",
    "contentDetails.contentRating.ytRating",
    "contentDetails.regionRestriction.allowed",
    "contentDetails.regionRestriction.blocked",
    "trending_date",
    "favoriteCount",
]

# Columns removed before modelling.
MODEL_DROPS = [
    "video_id",
    "title",
    "publishedAt",
    "channelId",
    "tags",
    "likes",
    "comment_count",
    "description",
    "duration",
    "tags_joined",
    "defaultLanguage",
    "supports_miniplayer",
    "playability_status",
    "definition",
    "dimension",
    "projection",
    "channelTitle",
    "has_paid_promotion",
    "card_count",
]

# Typed column groups.
INT_COLUMNS = ["view_count", "likes", "categoryId", "comment_count", "card_count", "is_trending", "chapter_count"]
BOOL_COLUMNS = [
    "embeddable",
    "madeForKids",
    "supports_miniplayer",
    "is_verified",
    "has_paid_promotion",
    "comments_disabled",
]
LOG_COLUMNS = ["view_count", "likes", "comment_count"]
CAP_COLUMNS = ["view_count", "likes", "comment_count", "chapter_count"]
REQUIRED_COLUMNS = ["video_id", "title", "view_count", "likes", "publishedAt", "channelId", "is_trending"]
TEXT_COLUMNS = ["title", "video_id", "channelId", "channelTitle"]
NUMERIC_COLUMNS = ["view_count", "likes", "comment_count", "categoryId", "favoriteCount", "card_count", "chapter_count"]
DATE_COLUMNS = ["publishedAt", "trending_date"]
NOT_SCALED = ["lang_base", "lang_region", "like_to_view_ratio", "comment_to_view_ratio", "has_cards"]

# Language codes accepted besides the published list.
EXTRA_LANGUAGES = [
    "yue",
    "yue-hk",
    "bh",
    "bho",
    "mai",
    "sat",
    "bgc",
    "chr",
    "mni",
    "vro",
    "ase",
    "mo",
    "bi",
    "und",
    "zxx",
    "sdp",
]

# Names given to API fields.
API_RENAMES = {"id": "video_id", "likeCount": "likes", "viewCount": "view_count", "commentCount": "comment_count"}

CLEANED_COLUMNS = [name for name in RAW_COLUMNS if name not in CLEANING_DROPS]

_NUMERIC_TEXT = {"view_count", "likes", "comment_count", "favoriteCount", "card_count", "chapter_count"}


def raw_schema() -> T.StructType:
    """Explicit CSV schema: counts as double (they may hold blanks or decimals), the rest as text."""
    fields = []
    for name in RAW_COLUMNS:
        if name in _NUMERIC_TEXT:
            kind: T.DataType = T.DoubleType()
        elif name in ("categoryId", "is_trending"):
            kind = T.LongType()
        else:
            kind = T.StringType()
        fields.append(T.StructField(name, kind))
    return T.StructType(fields)
