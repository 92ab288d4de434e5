"""Feature extraction from saved watch pages: HTML to JSON text to typed columns.

``script_json`` finds the two JSON texts of a page, ``parse_player`` and
``parse_initial`` read each once into a narrow struct, and the extractors work
on those structs. Keep the three in separate projections, so that neither the
search nor the parsing is repeated per feature.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendspark.functions.times import clock_seconds

# Page keys, marker names and badge marks of the page format.
PLAYER_KEY = "ytInitialPlayerResponse"
INITIAL_KEY = "ytInitialData"
CHAPTER_MARKER = "AUTO_CHAPTERS"
VERIFIED_LABELS = ["Verified"]
VERIFIED_STYLES = ["BADGE_STYLE_TYPE_VERIFIED"]
VERIFIED_ICONS = ["CHECK_CIRCLE_THICK"]
CHAPTER_LINE = r"(?d)(\d{1,2}:\d{2})\s+(.+)"

CHAPTER_TYPE = "array<struct<title:string,start_seconds:bigint>>"
CARD_TYPE = "array<struct<teaser_text:string,start_ms:string>>"


def _struct_path(path: str, leaf: str) -> str:
    """DDL of nested single-field structs: 'a.b' and leaf type to struct<a:struct<b:leaf>>."""
    ddl = leaf
    for name in reversed(path.split(".")):
        ddl = f"struct<{name}:{ddl}>"
    return ddl


_MARKERS_PATH = (
    "playerOverlayRenderer.decoratedPlayerBarRenderer.decoratedPlayerBarRenderer"
    ".playerBar.multiMarkersPlayerBarRenderer.markersMap"
)
_OVERLAYS = "playerOverlays:" + _struct_path(
    _MARKERS_PATH,
    "array<struct<key:string,value:struct<chapters:array<struct<chapterRenderer:"
    "struct<title:struct<simpleText:string>,timeRangeStartMillis:bigint>>>>>>",
)
_CARDS_PATH = "cardCollectionRenderer.cards"
_CARDS = "cards:" + _struct_path(
    _CARDS_PATH,
    "array<struct<cardRenderer:struct<startCardActiveMs:string,teaser:struct<simpleCardTeaserRenderer:"
    "struct<message:struct<simpleText:string>>>>>>",
)
_CONTENTS_PATH = "twoColumnWatchNextResults.results.results.contents"
_CONTENTS = "contents:" + _struct_path(
    _CONTENTS_PATH,
    "array<struct<videoSecondaryInfoRenderer:struct<owner:struct<videoOwnerRenderer:struct<badges:"
    "array<struct<metadataBadgeRenderer:struct<accessibilityData:struct<label:string>,style:string,"
    "icon:struct<iconType:string>>>>>>>,"
    "itemSectionRenderer:struct<contents:array<struct<messageRenderer:string>>>>>",
)
_PLAYER_DDL = (
    f"struct<{_OVERLAYS},{_CARDS},videoDetails:struct<shortDescription:string>,"
    "playabilityStatus:struct<status:string,playableInEmbed:string>,"
    "microformat:struct<playerMicroformatRenderer:struct<isFamilySafe:string>>,paidContentOverlay:variant>"
)
_INITIAL_DDL = f"struct<{_OVERLAYS},{_CONTENTS}>"


def parse_player(json: Column) -> Column:
    """The fields of the player JSON that features are made of."""
    return F.from_json(json, _PLAYER_DDL)


def parse_initial(json: Column) -> Column:
    """The fields of the initial-data JSON that features are made of."""
    return F.from_json(json, _INITIAL_DDL)


def _walk(col: Column, path: str) -> Column:
    for name in path.split("."):
        col = col.getField(name)
    return col


def _empty(ddl: str) -> Column:
    return F.array().cast(ddl)


def script_bodies(html: Column) -> Column:
    """Texts of all script elements."""
    return F.regexp_extract_all(html, F.lit(r"(?is)<script\b[^>]*>(.*?)</script>"), F.lit(1))


def assigned_json(bodies: Column, key: str) -> Column:
    """First valid JSON object assigned to ``key`` in any of the scripts; null if none."""
    naming = F.filter(bodies, lambda b: b.contains(key))
    found = F.transform(naming, lambda b: F.regexp_extract(b, rf"(?d){key}\s*=\s*(\{{.*\}});", 1))
    # Inside brackets the text must be one whole value: anything after the object makes it invalid.
    valid = F.filter(found, lambda j: F.json_array_length(F.concat(F.lit("["), j, F.lit("]"))) == 1)
    return F.get(valid, F.lit(0))


def script_json(html: Column, key: str) -> Column:
    return assigned_json(script_bodies(html), key)


def _marker_chapters(parsed: Column) -> Column:
    markers = _walk(parsed["playerOverlays"], _MARKERS_PATH)
    first = F.get(F.filter(markers, lambda m: m["key"] == CHAPTER_MARKER), F.lit(0))
    chapters = F.transform(
        first["value"]["chapters"],
        lambda ch: F.struct(
            ch["chapterRenderer"]["title"]["simpleText"].alias("title"),
            F.floor(ch["chapterRenderer"]["timeRangeStartMillis"] / 1000).alias("start_seconds"),
        ),
    )
    broken = F.exists(chapters, lambda ch: ch["title"].isNull() | ch["start_seconds"].isNull())
    return F.when(chapters.isNotNull() & ~broken, chapters.cast(CHAPTER_TYPE)).otherwise(_empty(CHAPTER_TYPE))


def chapters_from_text(text: Column) -> Column:
    """'mm:ss title' lines as an array of chapters."""
    stamps = F.regexp_extract_all(text, F.lit(CHAPTER_LINE), F.lit(1))
    titles = F.regexp_extract_all(text, F.lit(CHAPTER_LINE), F.lit(2))
    chapters = F.zip_with(
        stamps,
        titles,
        lambda s, t: F.struct(
            F.regexp_replace(t, r"(?U)^\s+|\s+$", "").alias("title"),
            clock_seconds(s).cast("bigint").alias("start_seconds"),
        ),
    )
    return F.coalesce(chapters.cast(CHAPTER_TYPE), _empty(CHAPTER_TYPE))


def chapters(player: Column, initial: Column) -> Column:
    """Player markers, else initial-data markers, else description lines."""
    by_player = _marker_chapters(player)
    by_initial = _marker_chapters(initial)
    by_text = chapters_from_text(player["videoDetails"]["shortDescription"])
    return (
        F.when(F.size(by_player) > 0, by_player).when(F.size(by_initial) > 0, by_initial).otherwise(by_text)
    )


def playability(player: Column) -> Column:
    """Status, family-safe flag, age restriction and embeddability as one struct."""
    state = player["playabilityStatus"]
    safe = player["microformat"]["playerMicroformatRenderer"]["isFamilySafe"] == "true"
    return F.struct(
        F.coalesce(state["status"], F.lit("UNKNOWN")).alias("status"),
        F.coalesce(state.isNotNull() & safe, F.lit(False)).alias("supports_miniplayer"),
        F.coalesce(state["status"] == "LOGIN_REQUIRED", F.lit(False)).alias("is_age_restricted"),
        F.coalesce(state["playableInEmbed"] == "true", F.lit(True)).alias("is_embeddable"),
    )


def cards(player: Column) -> Column:
    """Info cards as an array of teaser text and start time; malformed cards give none."""
    raw = _walk(player["cards"], _CARDS_PATH)
    items = F.transform(
        raw,
        lambda k: F.struct(
            F.coalesce(
                k["cardRenderer"]["teaser"]["simpleCardTeaserRenderer"]["message"]["simpleText"], F.lit("")
            ).alias("teaser_text"),
            k["cardRenderer"]["startCardActiveMs"].alias("start_ms"),
        ),
    )
    broken = F.exists(raw, lambda k: k["cardRenderer"].isNull())
    return F.when(raw.isNotNull() & ~broken, items.cast(CARD_TYPE)).otherwise(_empty(CARD_TYPE))


def verified(initial: Column) -> Column:
    """Badge labels of the channel owner and whether any badge marks it as verified."""
    second = F.get(_walk(initial["contents"], _CONTENTS_PATH), F.lit(1))
    badges = F.transform(
        second["videoSecondaryInfoRenderer"]["owner"]["videoOwnerRenderer"]["badges"],
        lambda b: F.struct(
            F.coalesce(b["metadataBadgeRenderer"]["accessibilityData"]["label"], F.lit("")).alias("label"),
            F.coalesce(b["metadataBadgeRenderer"]["style"], F.lit("")).alias("style"),
            F.coalesce(b["metadataBadgeRenderer"]["icon"]["iconType"], F.lit("")).alias("icon"),
        ),
    )

    def marked(b: Column) -> Column:
        hit = b["label"].isin(VERIFIED_LABELS) | b["icon"].isin(VERIFIED_ICONS)
        for style in VERIFIED_STYLES:
            hit = hit | b["style"].startswith(style)
        return hit

    return F.struct(
        F.coalesce(F.exists(badges, marked), F.lit(False)).alias("is_verified"),
        F.coalesce(F.transform(badges, lambda b: b["label"]), _empty("array<string>")).alias("badge_labels"),
    )


def comments_disabled(initial: Column) -> Column:
    """True when any item section holds a message renderer."""
    hit = F.exists(
        _walk(initial["contents"], _CONTENTS_PATH),
        lambda s: F.coalesce(
            F.exists(s["itemSectionRenderer"]["contents"], lambda x: x["messageRenderer"].isNotNull()), F.lit(False)
        ),
    )
    return F.coalesce(hit, F.lit(False))


def paid_promotion(player: Column) -> Column:
    """The overlay is present and not an empty value: text, number, list and object each by their own type."""
    value = player["paidContentOverlay"]
    kind = F.schema_of_variant(value)
    told = (
        F.when(kind == "VOID", F.lit(False))
        .when(kind == "STRING", F.try_variant_get(value, "$", "string") != "")
        .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(kind.startswith("OBJECT"), kind != "OBJECT<>")
        .when(kind.startswith("ARRAY"), F.to_json(value) != "[]")
        .otherwise(F.try_variant_get(value, "$", "double") != 0)
    )
    return F.coalesce(told, F.lit(False))
