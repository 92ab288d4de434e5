"""Text and tag expressions; all stay in JVM built-ins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code points with Unicode's Emoji property, without digits, signs of keycaps and regional indicators.
_EMOJI_RANGES = """
A9 AE 203C 2049 2122 2139 2194-2199 21A9-21AA 231A-231B 2328 23CF 23E9-23F3 23F8-23FA 24C2 25AA-25AB 25B6 25C0
25FB-25FE 2600-2604 260E 2611 2614-2615 2618 261D 2620 2622-2623 2626 262A 262E-262F 2638-263A 2640 2642 2648-2653
265F-2660 2663 2665-2666 2668 267B 267E-267F 2692-2697 2699 269B-269C 26A0-26A1 26A7 26AA-26AB 26B0-26B1 26BD-26BE
26C4-26C5 26C8 26CE-26CF 26D1 26D3-26D4 26E9-26EA 26F0-26F5 26F7-26FA 26FD 2702 2705 2708-270D 270F 2712 2714 2716
271D 2721 2728 2733-2734 2744 2747 274C 274E 2753-2755 2757 2763-2764 2795-2797 27A1 27B0 27BF 2934-2935 2B05-2B07
2B1B-2B1C 2B50 2B55 3030 303D 3297 3299 1F004 1F0CF 1F170-1F171 1F17E-1F17F 1F18E 1F191-1F19A 1F201-1F202 1F21A
1F22F 1F232-1F23A 1F250-1F251 1F300-1F321 1F324-1F393 1F396-1F397 1F399-1F39B 1F39E-1F3F0 1F3F3-1F3F5 1F3F7-1F4FD
1F4FF-1F53D 1F549-1F54E 1F550-1F567 1F56F-1F570 1F573-1F57A 1F587 1F58A-1F58D 1F590 1F595-1F596 1F5A4-1F5A5 1F5A8
1F5B1-1F5B2 1F5BC 1F5C2-1F5C4 1F5D1-1F5D3 1F5DC-1F5DE 1F5E1 1F5E3 1F5E8 1F5EF 1F5F3 1F5FA-1F64F 1F680-1F6C5
1F6CB-1F6D2 1F6D5-1F6D9 1F6DC-1F6E5 1F6E9 1F6EB-1F6EC 1F6F0 1F6F3-1F6FC 1F7E0-1F7EB 1F7F0 1F90C-1F93A 1F93C-1F945
1F947-1F9FF 1FA70-1FA7C 1FA80-1FAC6 1FAC8 1FACC-1FADD 1FADF-1FAEB 1FAEF-1FAFA
"""
_PICTOGRAPH = "".join("-".join(rf"\x{{{x}}}" for x in part.split("-")) for part in _EMOJI_RANGES.split())
_ONE = rf"[{_PICTOGRAPH}]\x{{FE0F}}?[\x{{1F3FB}}-\x{{1F3FF}}]?(?:[\x{{E0020}}-\x{{E007F}}]+)?"
# The first group turns letters away after a few comparisons; a keycap is found by its closing mark.
EMOJI_PATTERN = (
    r"(?=[\x{203C}-\x{3299}\x{1F000}-\x{1FAFF}\x{A9}\x{AE}])(?:"
    r"[\x{1F1E6}-\x{1F1FF}]{2}"
    r"|(?<=[0-9#*]\x{FE0F}?)\x{20E3}"
    rf"|{_ONE}(?:\x{{200D}}{_ONE})*"
    r"|[\x{1F3FB}-\x{1F3FF}])"
)


def strip(col: Column) -> Column:
    """Remove all leading and trailing white space, not only blanks."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def split_tags(col: Column) -> Column:
    """Tag text to a list: outer brackets go, pieces are trimmed, blanks drop, quotes stay."""
    body = F.regexp_replace(strip(col), r"^[\[\]]+|[\[\]]+$", "")
    pieces = F.transform(F.split(body, ","), strip)
    return F.coalesce(F.filter(pieces, lambda t: t != ""), F.array().cast("array<string>"))


def parse_list_text(col: Column) -> Column:
    """A list literal as an array of text; anything else is an empty array."""
    parsed = F.from_json(col, "array<string>", {"allowBackslashEscapingAnyCharacter": "true"})
    return F.coalesce(parsed, F.array().cast("array<string>"))


def join_tags(tags: Column, by: str = " ") -> Column:
    """A tag list as one text; null entries are left out, a null list is empty text."""
    return F.coalesce(F.array_join(tags, by), F.lit(""))


def comma_pieces(col: Column) -> Column:
    """Number of comma-separated pieces of text; an empty list literal counts one."""
    return F.coalesce(F.size(F.split(col, ",")), F.lit(0))


def text_length(col: Column) -> Column:
    return F.coalesce(F.length(col), F.lit(0))


def caps_ratio(col: Column, extra: int = 0) -> Column:
    """Upper-case characters over length (plus ``extra``); 0 for empty text."""
    size = F.length(col) + F.lit(extra)
    return F.when(size == 0, F.lit(0.0)).otherwise(F.regexp_count(col, F.lit(r"\p{IsUppercase}")) / size)


def emoji_count(col: Column) -> Column:
    """Emoji sequences: a joined family or a flag pair counts once."""
    return F.coalesce(F.regexp_count(col, F.lit(EMOJI_PATTERN)), F.lit(0))


def has_symbol(col: Column) -> Column:
    """Loose emoji test, by code point only: 128..0x1F9FE or above 0x1F300, that is any non-ASCII text."""
    return col.rlike(r"[^\x{00}-\x{7F}]")


def title_flags(col: Column, caps_share: float = 0.3) -> dict[str, Column]:
    return {
        "has_emoji": has_symbol(col),
        "has_question": col.contains("?"),
        "has_hashtag": col.contains("#"),
        "has_caps": caps_ratio(col, 1) > F.lit(caps_share),
    }


def language_base(col: Column) -> Column:
    return F.split_part(col, F.lit("-"), F.lit(1))


def language_region(col: Column, missing: str = "NO") -> Column:
    return F.coalesce(F.get(F.split(col, "-"), F.lit(1)), F.lit(missing))


def normalize_language(col: Column) -> Column:
    """Lower-case base code; null and empty text pass through."""
    return F.lower(language_base(col))


def is_blank(col: Column) -> Column:
    return col.rlike(r"(?U)^\s*$")


def as_bool(col: Column) -> Column:
    """'true' in any case is true, everything else including null is false."""
    return F.coalesce(F.lower(col.cast("string")) == "true", F.lit(False))


def literal_list_length(col: Column) -> Column:
    """Length of a serialised list: blank is 0, unparseable is -1.

    Python's True/False/None are rewritten to JSON words first; that can touch
    text inside the list but never its length.
    """
    text = strip(col.cast("string"))
    as_json = F.regexp_replace(text, r"\bNone\b", "null")
    as_json = F.regexp_replace(as_json, r"\bTrue\b", "true")
    as_json = F.regexp_replace(as_json, r"\bFalse\b", "false")
    parsed = F.from_json(as_json, "array<string>", {"allowBackslashEscapingAnyCharacter": "true"})
    return (
        F.when(col.isNull() | text.isin("", "[]", "nan"), F.lit(0))
        .when(parsed.isNull(), F.lit(-1))
        .otherwise(F.size(parsed))
    )


def right_closed_bin(col: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the bin (lo, hi] holding the value; null outside."""
    out: Column | None = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels, strict=True):
        hit = (col > lo) & (col <= hi)
        out = F.when(hit, F.lit(label)) if out is None else out.when(hit, F.lit(label))
    assert out is not None, "at least one bin"
    return out
