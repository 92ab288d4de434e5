"""Token counts of texts by a two-tier lookup, without shuffling pre-tokens.

First tier: the lengths of the most frequent pre-tokens, a table of bounded size sent to all tasks. Second tier: a
cache in each worker, which asks the library about the rest. Both only save time: every count is the library's.

The frequent pre-tokens are found over all texts. Each task folds its pre-tokens into one summary of bounded size (it keeps
the largest counts and drops what falls behind). Summaries are merged whole, by a few tasks and then by the driver: no
pre-token is shuffled.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.arrow import batch, columns, map_batches
from trendspark.llm.tokens import cuts, distinct_parts, token_counter

# Rows of the table sent to all tasks, pre-tokens of one task's summary, and summaries that the driver merges.
FREQUENT_PARTS = 50_000
SUMMARY_PARTS = 8_192
MERGED_SUMMARIES = 16
_SUMMARY = pa.schema([("slot", pa.int32()), ("parts", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
_SUMMARY_KINDS = "slot int, parts array<string>, counts array<bigint>"
_COUNTS = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64())])


def _summaries(keep: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for rows in batches:
            for column in cuts(rows.column(0)):
                followers, _, _, codes, _ = distinct_parts(column)
                counts = np.bincount(codes, minlength=len(followers))[: len(followers)]
                # Within a slice, parts seen once are not worth a row of the summary.
                often = np.flatnonzero(counts > 1)
                seen.update({followers[i]: n for i, n in zip(often.tolist(), counts[often].tolist(), strict=True)})
                if len(seen) > 16 * keep:
                    seen = Counter(dict(seen.most_common(4 * keep)))
        yield _summary(seen, keep)

    return task


def _summary(seen: Counter[str], keep: int) -> pa.RecordBatch:
    """One row: the largest counts. Its slot, from its content, deals summaries out evenly."""
    top = seen.most_common(keep)
    parts, counts = [p for p, _ in top], [n for _, n in top]
    slot = zlib.crc32("\n".join(parts).encode()) % MERGED_SUMMARIES
    return batch(_SUMMARY, [slot], [parts], [counts])


def _merge(keep: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()
        for rows in batches:
            for parts, counts in zip(rows.column("parts"), rows.column("counts"), strict=True):
                seen.update(dict(zip(parts.as_py(), counts.as_py(), strict=True)))
                if len(seen) > 16 * keep:
                    seen = Counter(dict(seen.most_common(4 * keep)))
        if seen:
            yield _summary(seen, keep)

    return task


def frequent_parts(df: DataFrame, text: str, limit: int = FREQUENT_PARTS) -> list[str]:
    """At most ``limit`` frequent pre-tokens of a text column, by the summaries of all tasks."""
    found = map_batches(columns(df, text=text), _summaries(SUMMARY_PARTS), _SUMMARY_KINDS)
    merged = map_batches(found.repartitionById(MERGED_SUMMARIES, F.col("slot")), _merge(max(limit, SUMMARY_PARTS)), _SUMMARY_KINDS)
    totals: Counter[str] = Counter()
    for row in merged.toLocalIterator():  # at most MERGED_SUMMARIES summaries
        totals.update(dict(zip(row["parts"], row["counts"], strict=True)))
    return sorted(totals, key=lambda part: (-totals[part], part))[:limit]


def _lengths(path: str, parts: list[str]) -> dict[str, int]:
    counter = token_counter(path)
    counts = counter.column(pa.array(parts, pa.string()), {})
    return dict(zip(parts, counts.tolist(), strict=True))


def count_tokens(
    df: DataFrame, vocabulary: str, id_col: str = "doc_id", text: str = "text", max_tokens: int = 2048
) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of each row: the tokens of the whole text without added special tokens.

    ``vocabulary`` is a file of ``tokenizers`` (.json) or ``sentencepiece`` (.model). A null text counts as empty; ids
    may be null or repeated, each row gives a row; other columns are ignored.
    """
    from trendspark.llm.tokens import PartCounter

    counts_parts = isinstance(token_counter(vocabulary), PartCounter)
    table = _lengths(vocabulary, frequent_parts(df, text)) if counts_parts else {}
    shared = df.sparkSession.sparkContext.broadcast(table)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = shared.value
        counter = token_counter(vocabulary)
        for rows in batches:
            ids, at = rows.column(0), 0
            for column in cuts(rows.column(1)):
                sizes = np.fromiter((len(t) for t in column.cast(pa.binary()).to_pylist()), np.int64, len(column))
                yield batch(_COUNTS, ids.slice(at, len(column)), sizes, counter.column(column, frequent))
                at += len(column)

    counted = map_batches(
        columns(df, id=id_col, text=text).withColumn("id", F.col("id").cast("bigint")),
        task,
        "id bigint, n_bytes bigint, n_tokens bigint",
    )
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > max_tokens).alias("over_limit")
    )
