"""Feature engineering: text, time, language and embedding features, then splits ready for models."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.functions import text, times
from trendspark.ml.embed import embed_text
from trendspark.ml.reduce import CentredPCA
from trendspark.ml.search import with_folds
from trendspark.ml.select import rfecv
from trendspark.ml.vectors import assemble
from trendspark.operators.encoding import FrequencyEncoding, group_rare_count, group_rare_share
from trendspark.operators.projection import drop_columns, engagement_ratios, presence_flags
from trendspark.operators.sampling import balanced_sample, split3
from trendspark.operators.transforms import RobustScale, scalable_columns
from trendspark.schema import MODEL_DROPS, NOT_SCALED
from trendspark.session import c, durable

# Derived columns and rarity thresholds.
RATIOS = {"likes": "like_to_view_ratio", "comment_count": "comment_to_view_ratio"}
FLAGS = {"card_count": "has_cards", "chapter_count": "has_chapter"}
EMBEDDED = ["tags_joined", "description", "title"]
EMOJI_COLUMNS = ["description", "title"]
BASE_SHARE = 0.002
REGION_SHARE = 0.005
RARE_CATEGORY_ROWS = 500
OTHER_CATEGORY = 29
COMPONENTS = 100


def text_features(df: DataFrame) -> DataFrame:
    """Lengths, capitals, emoji, tags; one projection."""
    is_list = isinstance(df.schema["tags"].dataType, T.ArrayType)
    tags = c("tags") if is_list else text.parse_list_text(c("tags"))
    count = F.coalesce(F.size("tags"), F.lit(0)) if is_list else text.comma_pieces(c("tags"))
    return df.withColumns(
        {
            "tag_count": count,
            "title_length": text.text_length(c("title")),
            "description_length": text.text_length(c("description")),
            "title_has_caps_ratio": text.caps_ratio(c("title")),
            "tags": tags,
            "tags_joined": text.join_tags(tags),
            **{f"{n}_emoji_count": text.emoji_count(c(n)) for n in EMOJI_COLUMNS},
        }
    )


def time_features(df: DataFrame) -> DataFrame:
    ts = c("publishedAt").cast("timestamp")
    return df.withColumns(
        {
            "publish_hour": F.hour(ts),
            "publish_dayofweek": times.weekday(ts),
            "duration_seconds": times.duration_seconds(c("duration")),
        }
    )


def language_features(df: DataFrame, base_share: float = BASE_SHARE, region_share: float = REGION_SHARE) -> DataFrame:
    """Base and region of the language code, rare ones as 'other'."""
    parts = df.withColumns(
        {"lang_base": text.language_base(c("defaultLanguage")), "lang_region": text.language_region(c("defaultLanguage"))}
    )
    grouped = group_rare_share(parts, "lang_base", base_share)
    return group_rare_share(grouped, "lang_region", region_share)


def build_features(df: DataFrame, encode: Callable | None = None, embed: Sequence[str] = tuple(EMBEDDED)) -> DataFrame:
    """All derived columns of a cleaned table."""
    out = engagement_ratios(df, RATIOS)
    out = presence_flags(text_features(out), FLAGS)
    out = language_features(time_features(out))
    return embed_text(out, embed, encode) if embed else out


@dataclass(frozen=True)
class Engineered:
    train: DataFrame
    val: DataFrame
    test: DataFrame
    selected: list[str]
    scores: dict[int, float]


def engineer(
    df: DataFrame,
    key: str = "video_id",
    target: str = "is_trending",
    encode: Callable | None = None,
    embed: Sequence[str] = tuple(EMBEDDED),
    components: int = COMPONENTS,
    rare_rows: int = RARE_CATEGORY_ROWS,
    step: int = 1,
    folds: int = 5,
    seed: int = 42,
) -> Engineered:
    """Cleaned table to encoded, reduced, selected and scaled splits.

    Frequencies, components, selection and scaling are fitted on the training
    part only. Each part is written once, after the shared features.
    """
    features = build_features(df, encode, embed)
    if embed:
        vectors = F.concat(*[c(f"{n}_emb") for n in embed])
        features = features.withColumn("_vec", vectors).drop(*[f"{n}_emb" for n in embed])
    features = features.withColumn("_key", c(key).cast("string"))
    features = drop_columns(features, MODEL_DROPS)
    features = durable(group_rare_count(features, "categoryId", rare_rows, OTHER_CATEGORY), "features")

    train, val, test = split3(features, "_key", seed)
    frequency = FrequencyEncoding.fit(train, ["lang_base", "lang_region"])
    parts = [frequency.apply(p) for p in (train, val, test)]
    if embed:
        pca = CentredPCA.fit(parts[0], "_vec", components)
        parts = [pca.apply(p, "_vec") for p in parts]
    # Flags become 0/1; unseen categories and undefined ratios become 0 so that no row is lost.
    names = [f.name for f in parts[0].schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType)) and f.name != target]
    parts = [
        durable(p.select("_key", c(target), *[F.coalesce(c(n).cast("double"), F.lit(0.0)).alias(n) for n in names]), "part")
        for p in parts
    ]
    sample = with_folds(balanced_sample(parts[0], target, "_key", seed), "_key", folds, seed)
    vectors = assemble(sample, names).withColumnRenamed(target, "label")
    kept, scores = rfecv(vectors, len(names), step, folds, seed=seed)
    selected = [names[i] for i in kept]
    parts = [p.select("_key", c(target), *[c(n) for n in selected]) for p in parts]

    scale = RobustScale.fit(parts[0], scalable_columns(parts[0], target, [*NOT_SCALED, "_key"]))
    return Engineered(*[scale.apply(p) for p in parts], selected, scores)
