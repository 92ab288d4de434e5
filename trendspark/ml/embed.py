"""Text to dense vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF, HashingTF, Normalizer, Tokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendspark.operators.transforms import fill_text
from trendspark.session import c

# Vector width and the stand-in for missing text.
EMBEDDING_SIZE = 384
EMPTY_TEXT = "no text"


def embed_text(
    df: DataFrame,
    cols: Sequence[str],
    encode: Callable[[Sequence[str]], Sequence[Sequence[float]]] | None = None,
    size: int = EMBEDDING_SIZE,
    batch: int = 512,
) -> DataFrame:
    """Append ``<col>_emb`` (array of float) per text column.

    Without ``encode``: hashed term frequencies weighted by rarity, unit length.
    With ``encode`` (a list of texts to a list of vectors): run in Arrow batches.
    """
    filled = fill_text(df.select("*", *[c(n).alias(f"_{n}") for n in cols]), [f"_{n}" for n in cols], EMPTY_TEXT, True)
    if encode is not None:
        return _encode(filled, cols, encode, batch).drop(*[f"_{n}" for n in cols])
    out = filled
    for name in cols:
        stages = [
            Tokenizer(inputCol=f"_{name}", outputCol="_words"),
            HashingTF(inputCol="_words", outputCol="_tf", numFeatures=size),
            IDF(inputCol="_tf", outputCol="_tfidf"),
            Normalizer(inputCol="_tfidf", outputCol="_unit"),
        ]
        out = Pipeline(stages=stages).fit(out).transform(out)
        out = out.withColumn(f"{name}_emb", vector_to_array("_unit", "float32")).drop("_words", "_tf", "_tfidf", "_unit")
    return out.drop(*[f"_{n}" for n in cols])


def _encode(df: DataFrame, cols: Sequence[str], encode: Callable, batch: int) -> DataFrame:
    @F.pandas_udf("array<float>")
    def vectors(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            out: list = []
            for start in range(0, len(texts), batch):
                out += [list(map(float, v)) for v in encode(texts.iloc[start : start + batch].tolist())]
            yield pd.Series(out, index=texts.index, dtype="object")

    return df.withColumns({f"{n}_emb": vectors(c(f"_{n}")) for n in cols})


def concat_embeddings(df: DataFrame, cols: Sequence[str], out: str = "embedding") -> DataFrame:
    """Several vector columns joined end to end into one."""
    return df.withColumn(out, F.concat(*[c(f"{n}_emb") for n in cols]).cast(T.ArrayType(T.DoubleType())))
