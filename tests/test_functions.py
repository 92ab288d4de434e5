"""Scalar expressions on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from trendspark.functions import pages, text, times


def values(spark, col, items, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(col(F.col("v"))).collect()]


def test_duration_seconds(spark):
    got = values(spark, times.duration_seconds, ["PT1M", "PT1H1M1S", "P1DT2H", "invalid", None, "P", "PT", "PT30S x"])
    assert got == [60, 3661, 93600, 0, 0, 0, 0, 0]


def test_clock_seconds(spark):
    assert values(spark, times.clock_seconds, ["1:30", "10:05", "0:00", "x", None]) == [90, 605, 0, None, None]


def test_split_tags(spark):
    got = values(spark, text.split_tags, ["['apple', 'banana']", "apple, orange", None, "", " [a,,b ] ", "[]", "\t[x]\n"])
    assert got == [["'apple'", "'banana'"], ["apple", "orange"], [], [], ["a", "b"], [], ["x"]]


def test_parse_list_text(spark):
    got = values(spark, text.parse_list_text, ["['tag1', 'tag2']", "tag3,tag4", None, "[]", "[\"it's\", 'b']"])
    assert got == [["tag1", "tag2"], [], [], [], ["it's", "b"]]


def test_comma_pieces(spark):
    assert values(spark, text.comma_pieces, ["a,b", "[]", "", None]) == [2, 1, 1, 0]


def test_caps_ratio(spark):
    assert values(spark, text.caps_ratio, ["AbC", "À", "", None, "xyz"]) == [2 / 3, 1.0, 0.0, None, 0.0]


def test_emoji_count(spark):
    got = values(spark, text.emoji_count, ["Hello 🌍!", "No emojis here", "Wow 🔥✨", "👨‍👩‍👧", "🇫🇷🇩🇪", "1️⃣ 12 #", "👍🏽", "❤️", None])
    assert got == [1, 0, 2, 1, 2, 1, 1, 1, 0]


def test_title_flags(spark):
    df = spark.createDataFrame([("Why? #NEWS é",), ("plain",)], "t string")
    got = df.select(*[e.alias(n) for n, e in text.title_flags(F.col("t")).items()]).collect()
    assert tuple(got[0]) == (True, True, True, True) or tuple(got[0])[:3] == (True, True, True)
    assert tuple(got[1]) == (False, False, False, False)


def test_language(spark):
    codes = ["en-US", "PT", None, ""]
    assert values(spark, text.language_base, codes) == ["en", "PT", None, ""]
    assert values(spark, text.language_region, codes) == ["US", "NO", "NO", "NO"]
    assert values(spark, text.normalize_language, codes) == ["en", "pt", None, ""]


def test_blank_and_bool(spark):
    assert values(spark, text.is_blank, ["", "  ", "\t\n", "a", None]) == [True, True, True, False, None]
    assert values(spark, text.as_bool, ["True", "TRUE", "no", "", None]) == [True, True, False, False, False]


@pytest.mark.parametrize(
    ("value", "size"),
    [
        ("[{'t': 1}, {'t': 2}]", 2),
        ("[]", 0),
        ("", 0),
        ("nan", 0),
        (None, 0),
        ("[{'t': True, 'u': None}]", 1),
        ("[{\"t\": \"it's\"}, {'t': 'a\\'b'}]", 2),
        ("[broken", -1),
        ("no list", -1),
    ],
)
def test_literal_list_length(spark, value, size):
    assert values(spark, text.literal_list_length, [value]) == [size]


def test_right_closed_bin(spark):
    got = values(spark, lambda v: text.right_closed_bin(v, [0, 20, 40], ["a", "b"]), [0, 1, 20, 21, 40, 41, None], "int")
    assert got == [None, "a", "a", "b", "b", None, None]


def test_weekday_starts_on_monday(spark):
    df = spark.createDataFrame([("2024-01-01T12:00:00Z",), ("2024-01-07T23:00:00Z",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    parts = times.time_parts(F.col("t"))
    got = [tuple(r) for r in df.select(parts["weekday"], parts["hour"], parts["is_weekend"], times.day_label(parts["weekday"])).collect()]
    assert got == [(0, 12, False, "Mon"), (6, 23, True, "Sun")]


# --- pages ---------------------------------------------------------------------------


def one(spark, expr, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{n} string" for n in cols))
    return df.select(expr.alias("x")).first()["x"]


def test_script_json(spark):
    html = '<html><body>\n<script>var ytInitialPlayerResponse = {"status": "OK", "is_awesome": true};</script></body></html>'
    got = one(spark, pages.script_json(F.col("h"), pages.PLAYER_KEY), h=html)
    assert json.loads(got) == {"status": "OK", "is_awesome": True}
    assert one(spark, pages.script_json(F.col("h"), pages.INITIAL_KEY), h=html) is None
    trailing = '<script>ytInitialData = {"a": 1}; var x = {"b": 2};</script>'
    assert one(spark, pages.script_json(F.col("h"), pages.INITIAL_KEY), h=trailing) is None
    broken = '<script>ytInitialData = {bad};</script><SCRIPT a="b">ytInitialData = {"n": 2};</SCRIPT>'
    assert one(spark, pages.script_json(F.col("h"), pages.INITIAL_KEY), h=broken) == '{"n": 2}'


def test_cards(spark):
    card = {"cardRenderer": {"startCardActiveMs": "1000", "teaser": {"simpleCardTeaserRenderer": {"message": {"simpleText": "Check"}}}}}
    good = {"cards": {"cardCollectionRenderer": {"cards": [card, {"cardRenderer": {}}]}}}
    got = one(spark, pages.cards(pages.parse_player(F.col("p"))), p=json.dumps(good))
    assert [tuple(x) for x in got] == [("Check", "1000"), ("", None)]
    bad = {"cards": {"cardCollectionRenderer": {"cards": [card, {"other": 1}]}}}
    assert one(spark, pages.cards(pages.parse_player(F.col("p"))), p=json.dumps(bad)) == []
    assert one(spark, pages.cards(pages.parse_player(F.col("p"))), p="{}") == []
    assert one(spark, pages.cards(pages.parse_player(F.col("p"))), p=None) == []


def watch_next(*contents):
    return json.dumps({"contents": {"twoColumnWatchNextResults": {"results": {"results": {"contents": list(contents)}}}}})


@pytest.mark.parametrize(
    ("badge", "expected"),
    [
        ({"accessibilityData": {"label": "Verified"}}, True),
        ({"style": "BADGE_STYLE_TYPE_VERIFIED_ARTIST"}, True),
        ({"icon": {"iconType": "CHECK_CIRCLE_THICK"}}, True),
        ({"accessibilityData": {"label": "Music"}}, False),
        ({}, False),
    ],
)
def test_verified(spark, badge, expected):
    owner = {"videoSecondaryInfoRenderer": {"owner": {"videoOwnerRenderer": {"badges": [{"metadataBadgeRenderer": badge}]}}}}
    got = one(spark, pages.verified(pages.parse_initial(F.col("p"))), p=watch_next({}, owner))
    assert got["is_verified"] is expected
    assert got["badge_labels"] == [badge.get("accessibilityData", {}).get("label", "")]
    assert tuple(one(spark, pages.verified(pages.parse_initial(F.col("p"))), p="{}")) == (False, [])


def test_comments_disabled(spark):
    section = {"itemSectionRenderer": {"contents": [{"messageRenderer": {}}]}}
    assert one(spark, pages.comments_disabled(pages.parse_initial(F.col("p"))), p=watch_next(section)) is True
    assert one(spark, pages.comments_disabled(pages.parse_initial(F.col("p"))), p=watch_next({}, {"itemSectionRenderer": {"contents": [{"x": 1}]}})) is False
    assert one(spark, pages.comments_disabled(pages.parse_initial(F.col("p"))), p="{}") is False


def test_paid_promotion(spark):
    assert one(spark, pages.paid_promotion(pages.parse_player(F.col("p"))), p='{"paidContentOverlay": {"a": 1}}') is True
    for empty in ('{"paidContentOverlay": {}}', '{"paidContentOverlay": null}', "{}", None):
        assert one(spark, pages.paid_promotion(pages.parse_player(F.col("p"))), p=empty) is False


def test_playability(spark):
    got = one(
        spark,
        pages.playability(pages.parse_player(F.col("p"))),
        p=json.dumps({"playabilityStatus": {"status": "LOGIN_REQUIRED", "playableInEmbed": False}, "microformat": {"playerMicroformatRenderer": {"isFamilySafe": True}}}),
    )
    assert tuple(got) == ("LOGIN_REQUIRED", True, True, False)
    assert tuple(one(spark, pages.playability(pages.parse_player(F.col("p"))), p=None)) == ("UNKNOWN", False, False, True)


def test_chapters_from_text(spark):
    body = "Welcome to the video!\n0:00 Intro\n1:30 Middle Part\n10:05 Outro\nThanks for watching."
    got = one(spark, pages.chapters_from_text(F.col("t")), t=body)
    assert [tuple(x) for x in got] == [("Intro", 0), ("Middle Part", 90), ("Outro", 605)]
    assert one(spark, pages.chapters_from_text(F.col("t")), t=None) == []


def markers(chapters, key="AUTO_CHAPTERS"):
    bar = {"multiMarkersPlayerBarRenderer": {"markersMap": [{"key": "HEAT"}, {"key": key, "value": {"chapters": chapters}}]}}
    return {"playerOverlays": {"playerOverlayRenderer": {"decoratedPlayerBarRenderer": {"decoratedPlayerBarRenderer": {"playerBar": bar}}}}}


def test_chapters_prefer_markers(spark):
    chapter = {"chapterRenderer": {"title": {"simpleText": "A"}, "timeRangeStartMillis": 61999}}
    described = {"videoDetails": {"shortDescription": "1:00 Text"}}
    player = {**markers([chapter]), **described}
    expr = pages.chapters(pages.parse_player(F.col("p")), pages.parse_initial(F.col("i")))
    assert [tuple(x) for x in one(spark, expr, p=json.dumps(player), i=None)] == [("A", 61)]
    assert [tuple(x) for x in one(spark, expr, p=json.dumps(described), i=json.dumps(markers([chapter])))] == [("A", 61)]
    assert [tuple(x) for x in one(spark, expr, p=json.dumps(described), i="{}")] == [("Text", 60)]
    assert [tuple(x) for x in one(spark, expr, p=json.dumps({**markers([{"chapterRenderer": {}}]), **described}), i="{}")] == [("Text", 60)]


def test_emoji_ranges_are_unicodes(spark):
    import regex
    from pyspark.sql import functions as F

    from trendspark.functions import text

    ranges = [[int(x, 16) for x in part.split("-")] for part in text._EMOJI_RANGES.split()]
    ours = {x for r in ranges for x in range(r[0], r[-1] + 1)}
    theirs = {x for x in range(0x80, 0x110000) if not 0xD800 <= x < 0xE000 and regex.match(r"\p{Emoji}", chr(x))} - set(range(0x1F1E6, 0x1F200))
    assert ours == theirs
    some = [("♪ ♫ ★ ☆ ✓ ✗ 🄐🅑 ☰ ❶ ➜", 0), ("☀ ❤️ ⭐ 1️⃣ 7 # *", 4), ("👨‍👩‍👧🇫🇷👍🏽", 3), (None, 0)]
    df = spark.createDataFrame(some, "t string, n int")
    assert df.filter(text.emoji_count(F.col("t")) != F.col("n")).count() == 0


def test_paid_promotion_by_type(spark):
    from trendspark.functions import pages
    from pyspark.sql import functions as F

    values = {'"0"': True, '""': False, "0": False, "0.0": False, "2.5": True, "{}": False, '{"a":1}': True, "[]": False, "[0]": True, "true": True, "false": False, "null": False}
    df = spark.createDataFrame([(f'{{"paidContentOverlay": {v}}}', want) for v, want in values.items()] + [("{}", False)], "j string, want boolean")
    got = df.select("j", "want", pages.paid_promotion(pages.parse_player(F.col("j"))).alias("got")).collect()
    assert [r["j"] for r in got if r["got"] != r["want"]] == []


def test_join_tags(spark):
    from pyspark.sql import functions as F

    from trendspark.functions import text

    df = spark.createDataFrame([(["a", None, "b c"],), ([],), (None,)], "t array<string>")
    assert [r[0] for r in df.select(text.join_tags(F.col("t"))).collect()] == ["a b c", "", ""]
