"""Benchmark passages in documents, by Wu-Manber search over words.

The symbols of the search are words. For the patterns of one length, a table says how far the search may move on after
reading a block of words (the last words of the window that lies over the text): by the whole window if no pattern
holds the block, else by the block's distance from the nearest pattern's end. Only where that distance is zero does the
block, which then ends some pattern, lead to a bucket of patterns, and these are compared with the text word by word.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from trendspark.llm.arrow import batch, columns, map_batches, stored
from trendspark.session import c

WINDOW = 10
BLOCK = 3
# Words of benchmark texts whose tables are sent to all tasks at once; more of them are searched in further passes.
PASS_WORDS = 2_000_000
# Bytes of text cut into words at a time.
SLICE_BYTES = 1 << 22
# Words are runs of ASCII letters and digits and of non-ASCII characters; everything else becomes a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def fold_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def word_slices(text: bytes, limit: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """Words of a text in slices that end between words."""
    folded = text.translate(_FOLD)
    at = 0
    while len(folded) - at > limit:
        end = folded.rfind(b" ", at, at + limit)
        end = end if end > at else folded.find(b" ", at + limit)
        if end < 0:
            break
        yield folded[at:end].split()
        at = end
    yield folded[at:].split()


class WuManber:
    """Search for word patterns of one length; each pattern carries the items it comes from."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list], length: int):
        self.length, self.block = length, min(BLOCK, length)
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.ending: dict[tuple[bytes, ...], list[tuple[tuple[bytes, ...], list]]] = {}
        for pattern, items in patterns.items():
            for at in range(length - self.block + 1):
                block, left = pattern[at : at + self.block], length - self.block - at
                self.shift[block] = min(left, self.shift.get(block, left))
            self.ending.setdefault(pattern[length - self.block :], []).append((pattern, items))
        # Most blocks of a text hold a last word that no pattern has: looked up first, alone.
        self.known = {word for pattern in patterns for word in pattern}
        self.full = length - self.block + 1

    def find(self, words: list[bytes]) -> Iterator[tuple[int, list]]:
        """(first word, items) of every occurrence."""
        length, size, full = self.length, self.block, self.full
        known, shift, ending = self.known, self.shift, self.ending
        at, n = length, len(words)
        while at <= n:
            if words[at - 1] not in known:
                # No pattern holds the word: none can lie over it.
                at += length
                continue
            block = tuple(words[at - size : at])
            step = shift.get(block, full)
            if step:
                at += step
                continue
            window = words[at - length : at]
            for pattern, items in ending[block]:
                if list(pattern) == window:
                    yield at - length, items
            at += 1


def build_searches(rows: Sequence[tuple[int, str]], window: int = WINDOW) -> list[WuManber]:
    """Searches over the windows of (item, text) rows, one per pattern length."""
    by_length: dict[int, dict[tuple[bytes, ...], list]] = {}
    for item, text in rows:
        words = fold_words((text or "").encode())
        size = min(window, len(words))
        patterns = by_length.setdefault(size, {})
        for at in range(len(words) - size + 1 if size else 0):
            items = patterns.setdefault(tuple(words[at : at + size]), [])
            if item not in items:
                items.append(item)
    return [WuManber(patterns, size) for size, patterns in by_length.items() if size]


def _search(text: bytes, searches: list[WuManber]) -> tuple[int, list[tuple[int, int]], set]:
    """Number of words, sorted disjoint hit runs (first word, past the last) and items found."""
    n_words, hits, items = 0, [], set()
    longest = max((s.length for s in searches), default=1)
    carried: list[bytes] = []
    for some in word_slices(text):
        words = carried + some
        first = n_words - len(carried)
        for search in searches:
            # Occurrences inside the carried words alone are found again; runs and items take that.
            for at, found in search.find(words):
                hits.append((first + at, first + at + search.length))
                items.update(found)
        n_words += len(some)
        carried = words[max(0, len(words) - longest + 1) :]
    return n_words, merge_runs(hits), items


def merge_runs(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


_FOUND = StructType(
    [
        StructField("n_words", LongType()),
        StructField("runs", ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))),
        StructField("items", ArrayType(LongType())),
    ]
)
_FOUND_ARROW = [
    ("n_words", pa.int64()),
    ("runs", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
    ("items", pa.list_(pa.int64())),
]


def _passes(benchmark: DataFrame, item_col: str, text: str, pass_words: int) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's rows in parts of bounded size; one part for any benchmark of usual size."""
    items = columns(benchmark, item=item_col, text=text).withColumn("item", F.col("item").cast("bigint"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # A word with its separator takes two bytes at least.
    n = max(1, -(-size // (2 * pass_words)))
    for k in range(n):
        # By text, so that an item of many rows is spread too.
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("text"), F.lit(n)) == k)
        yield [(r["item"], r["text"]) for r in part.collect()]


def search_documents(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_col: str = "item_id",
    benchmark_text: str = "text",
    window: int = WINDOW,
    pass_words: int = PASS_WORDS,
    out: str = "found",
) -> DataFrame:
    """``df`` with a column ``out`` (n_words, runs, items): its words, the disjoint runs of hit words, the items found.

    A word run is hit if ``window`` consecutive words of a benchmark text, or all words of a shorter one, stand there.
    A-Z is lower-cased on both sides. Null texts have no words, benchmark rows without words are left out, an empty
    benchmark hits nothing. Benchmark rows with a null id are one item, which stands as a null at the end of ``items``.
    The name ``out`` must not be a column of ``df``.

    A benchmark of several passes is searched pass by pass: each pass is written to the shared folder and its tables are
    released before the next one's are built.
    """
    if out in df.columns:
        raise ValueError(f"the table has a column {out} already")
    place = df.columns.index(text)
    shared = None
    for rows in _passes(benchmark, item_col, benchmark_text, pass_words):
        if shared is not None:
            df = stored(df, "searched")
            shared.destroy()
        shared = df.sparkSession.sparkContext.broadcast(build_searches(rows, window))
        before = df.columns.index(out) if out in df.columns else None
        df = map_batches(df, _search_task(shared, place, before, out), _with_found(df, out, before))
    return df


def _with_found(df: DataFrame, out: str, before: int | None) -> StructType:
    return df.schema if before is not None else StructType([*df.schema.fields, StructField(out, _FOUND)])


def _search_task(shared, place: int, before: int | None, out: str):
    kind = pa.struct(_FOUND_ARROW)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches = shared.value
        for rows in batches:
            found = []
            for text in rows.column(place).cast(pa.large_binary()):
                n, runs, items = _search(text.as_py() or b"", searches)
                found.append({"n_words": n, "runs": [{"start": a, "end": b} for a, b in runs], "items": _in_order(items)})
            arrays, names = list(rows.columns), list(rows.schema.names)
            if before is not None:
                found = [_joined(a, b) for a, b in zip(arrays[before].to_pylist(), found, strict=True)]
                arrays[before] = pa.array(found, kind)
            else:
                arrays.append(pa.array(found, kind))
                names.append(out)
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return task


def _joined(a: dict, b: dict) -> dict:
    runs = merge_runs([(r["start"], r["end"]) for r in a["runs"] + b["runs"]])
    return {"n_words": a["n_words"], "runs": [{"start": s, "end": e} for s, e in runs], "items": _in_order({*a["items"], *b["items"]})}


def _in_order(items: set) -> list:
    return sorted(items, key=lambda i: (i is None, i))


def contamination(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """(id, n_words, n_hit, n_items, items, runs, contaminated) of each row of ``df``."""
    found = search_documents(columns(df, id=id_col, text=text), benchmark, **options)
    n_hit = F.aggregate("found.runs", F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["start"])
    return found.select(
        F.col("id").alias(id_col),
        F.col("found.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size("found.items").cast("bigint").alias("n_items"),
        F.col("found.items").alias("items"),
        F.col("found.runs").alias("runs"),
        (n_hit > 0).alias("contaminated"),
    )


def items_digest(items: str) -> Column:
    """Hex SHA-256 of the ids as text, in the order of text, joined by commas."""
    return F.sha2(F.array_join(F.array_sort(F.transform(items, lambda i: i.cast("string"))), ","), 256)


def keep_clean(df: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``df`` that hold no benchmark window, with all their columns."""
    out = "found"
    while out in df.columns:
        out = f"_{out}"
    found = search_documents(df, benchmark, text, out=out, **options)
    return found.filter(F.size(c(out)["runs"]) == 0).drop(out)
