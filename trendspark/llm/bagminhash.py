"""Near duplicates by BagMinHash signatures over multisets of word shingles.

A text is the multiset of its runs of five words. Each shingle owns Poisson processes of points (time, slot, level) over
the levels its count may reach, one per dyadic range of levels: [0, 1), [1, 2), [2, 4), [4, 8) and so on. A point of a
range counts for a text if its level is below the shingle's count there. A slot of the signature is the earliest point
that counts, so two texts agree in a slot with a probability equal to their weighted Jaccard similarity. Points are
drawn in order of time up to a limit by which all slots are filled almost always; texts with an empty slot draw on.

Texts that agree in a band of slots are candidates. Groups of candidates are compared exactly, so bands only choose what
is compared: with 32 bands of 5 slots, a pair of similarity 0.8 shares none with a probability of 3 in a million.
Near duplicates are the connected components of the links, whose similarity is at least 0.8.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from trendspark.llm.arrow import batch, columns, map_batches, stored
from trendspark.llm.components import components
from trendspark.llm.words import LOWERED, WORD_BYTES, Texts, mix, row_hash, span_prints, texts, window_prints
from trendspark.session import c

SHINGLE = 5
BANDS, BAND_SLOTS = 32, 5
# Similarity of links, as a fraction.
LINK = (4, 5)
# Texts compared with one another in one task; larger groups of candidates are split.
BLOCK_TEXTS = 256
# Rows of a table of candidate ids that may be sent to all tasks (16 bytes each); beyond it they are joined by a shuffle.
SENT_ROWS = 200_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _step(k: int) -> np.uint64:
    return np.uint64(k * int(_ODD) % (1 << 64))


def shingles(some: Texts, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """(row, fingerprint) of every shingle, rows ascending. Of fewer words, all together are the only shingle."""
    data = LOWERED[some.data]
    starts, ends = some.spans(WORD_BYTES[data])
    rows = some.rows_of(starts)
    prints = span_prints(data, starts, ends)
    windows, at = window_prints(prints, rows, size)
    counts = np.bincount(rows, minlength=len(some))
    short = np.flatnonzero((counts > 0) & (counts < size))
    firsts = np.searchsorted(rows, short)
    whole = np.zeros(len(short), np.uint64)
    for k in range(size - 1):
        there = counts[short] > k
        whole[there] = mix(whole[there] * _ODD + prints[firsts[there] + k])
    all_rows = np.concatenate((rows[at], short))
    order = np.argsort(all_rows, kind="stable")
    return all_rows[order], np.concatenate((windows, whole))[order]


def multisets(rows: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, fingerprint, count) of the distinct shingles of each row."""
    keys = row_hash(rows, prints)
    order = np.argsort(keys)
    ordered = keys[order]
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(first, len(keys)))
    at = order[first]
    return rows[at], prints[at], counts


def signatures(rows: np.ndarray, prints: np.ndarray, counts: np.ndarray, n: int, slots: int) -> np.ndarray:
    """The n x slots signatures of weighted sets; a row of zeros where a set is empty."""
    best = np.full(n * slots, np.inf)
    found = np.zeros(n * slots, np.uint64)
    weight = np.bincount(rows, weights=counts, minlength=n)
    limit = (np.log(slots) + 4) / np.maximum(weight, 1)
    while len(rows):
        where, when, who = _points(rows, prints, counts, limit, slots)
        np.minimum.at(best, where, when)
        first = when == best[where]
        found[where[first]] = who[first]
        empty = np.flatnonzero(np.isinf(best.reshape(n, slots)).any(axis=1) & (weight > 0))
        again = np.isin(rows, empty)
        rows, prints, counts = rows[again], prints[again], counts[again]
        limit[empty] *= 2
    return found.reshape(n, slots)


def _points(rows, prints, counts, limit, slots) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(signature place, time, identity) of the points that count, up to the rows' time limits."""
    where, when, who = [], [], []
    low, width, level = 0, 1, 0
    while True:
        some = np.flatnonzero(counts > low)
        if not len(some):
            break
        own = mix(prints[some] + _step(level + 1))
        row, count, time = rows[some], counts[some], np.zeros(len(some))
        draw = 0
        while len(own):
            draw += 1
            bits = mix(own + _step(draw))
            time = time - np.log(((bits >> np.uint64(11)).astype(np.float64) + 1) * 2.0**-53) / (slots * width)
            alive = time <= limit[row]
            own, row, count, time, bits = own[alive], row[alive], count[alive], time[alive], bits[alive]
            point = mix(bits ^ _ODD)
            slot = ((point >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)
            at_level = low + (((point & np.uint64(0xFFFFFFFF)) * np.uint64(width)) >> np.uint64(32)).astype(np.int64)
            counted = at_level < count
            where.append(row[counted] * slots + slot[counted].astype(np.int64))
            when.append(time[counted])
            who.append(point[counted])
        low, width, level = (1, 1, 1) if level == 0 else (low * 2, low * 2, level + 1)
    return np.concatenate(where), np.concatenate(when), np.concatenate(who)


def band_keys(signature: np.ndarray, bands: int, size: int) -> np.ndarray:
    """One 64-bit key per row and band."""
    cut = signature.reshape(len(signature), bands, size)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _ODD, (len(signature), bands)).copy()
    for k in range(size):
        out = mix(out * _ODD + cut[:, :, k])
    return out.view(np.int64)


def content_key(text: bytes) -> bytes:
    """Strong hash of the text's lower-cased words: equal for texts with equal shingles in equal order."""
    return hashlib.blake2b(b" ".join(text.lower().split()), digest_size=16).digest()


_SIGNED = "id bigint, key binary, bands array<bigint>"
_SIGNED_ARROW = pa.schema([("id", pa.int64()), ("key", pa.binary()), ("bands", pa.list_(pa.int64()))])


def signed(df: DataFrame, id_col: str, text: str, bands: int, size: int) -> DataFrame:
    """(id, key, bands) of every row; a null text has neither key nor bands, a text without words no bands."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            column = rows.column(1)
            known = column.is_valid().to_pylist()
            for some in texts(column):
                raw, at, n = some.data.tobytes(), some.offsets.tolist(), len(some)
                here = known[some.first : some.first + n]
                keys = [content_key(raw[at[i] : at[i + 1]]) if here[i] else None for i in range(n)]
                rows_, prints, counts = multisets(*shingles(some))
                keyed = band_keys(signatures(rows_, prints, counts, n, bands * size), bands, size).tolist()
                filled = np.bincount(rows_, minlength=n).tolist()
                lists = [keyed[i] if filled[i] else [] for i in range(n)]
                yield batch(_SIGNED_ARROW, rows.column(0).slice(some.first, n), keys, lists)

    source = columns(df, id=id_col, text=text).withColumn("id", F.col("id").cast("bigint"))
    return map_batches(source, task, _SIGNED)


def linked_texts(bodies: list[str]) -> np.ndarray:
    """Which of the texts are linked: exactly, by the weighted Jaccard similarity of their multisets of shingles."""
    n = len(bodies)
    rows_out, marks_out = [], []
    for some in texts(pa.array(bodies, pa.large_string())):
        rows, prints = shingles(some)
        keys = row_hash(rows, prints)
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        new = np.concatenate(([True], ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, bool)
        start = np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0)) if len(ordered) else np.zeros(0, np.int64)
        # The k-th copy of a shingle is a mark of its own, so shared marks count the smaller of two counts.
        copy = np.arange(len(ordered)) - start
        rows_out.append(rows[order] + some.first)
        marks_out.append(mix(prints[order] + copy.astype(np.uint64) * _ODD))
    rows = np.concatenate(rows_out) if rows_out else np.zeros(0, np.int64)
    marks = np.concatenate(marks_out) if marks_out else np.zeros(0, np.uint64)
    totals = np.bincount(rows, minlength=n)
    _, place, times = np.unique(marks, return_inverse=True, return_counts=True)
    shared = times[place] > 1
    rows, place = rows[shared], np.unique(place[shared], return_inverse=True)[1]
    overlap = np.zeros((n, n), np.float32)
    order = np.argsort(place, kind="stable")
    rows, place = rows[order], place[order]
    width = 8192
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        a, b = np.searchsorted(place, (low, low + width))
        present = np.zeros((n, width), np.float32)
        present[rows[a:b], place[a:b] - low] = 1
        overlap += present @ present.T
    union = totals[:, None] + totals[None, :] - overlap
    return (LINK[1] * overlap >= LINK[0] * union) & (totals[:, None] > 0) & (totals[None, :] > 0)


def smallest_labels(linked: np.ndarray) -> np.ndarray:
    """The smallest number in the component of each node."""
    n = len(linked)
    labels = np.arange(n)
    while True:
        near = np.where(linked, labels[None, :], n).min(axis=1, initial=n)
        new = np.minimum(labels, near)
        new = np.minimum(new, new[new])
        if (new == labels).all():
            return labels
        labels = new


_LINKS = "a binary, b binary"
_LINKS_ARROW = pa.schema([("a", pa.binary()), ("b", pa.binary())])


def _compare_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, key, text) sorted by group: links of a spanning forest of each group."""
    held: dict[bytes, str] = {}
    group = None

    def forest() -> pa.RecordBatch:
        keys = sorted(held)
        labels = smallest_labels(linked_texts([held[k] for k in keys])).tolist()
        ends = [(keys[i], keys[label]) for i, label in enumerate(labels) if label != i]
        return batch(_LINKS_ARROW, [a for a, _ in ends], [b for _, b in ends])

    for rows in batches:
        for g, key, text in zip(*(c.to_pylist() for c in rows.columns), strict=True):
            if g != group:
                if len(held) > 1:
                    yield forest()
                held, group = {}, g
            held[key] = text
    if len(held) > 1:
        yield forest()


def _compare_with_hub(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("label", pa.binary()), ("key", pa.binary()), ("text", pa.string()), ("attached", pa.bool_())])
    for rows in batches:
        label, key, text, hub = rows.columns
        wanted = text.to_pylist()
        attached: list[bool] = []
        hubs = hub.to_pylist()
        first = 0
        while first < len(wanted):
            last = first + 1
            while last < len(wanted) and hubs[last] == hubs[first] and last - first < BLOCK_TEXTS:
                last += 1
            attached += linked_texts([hubs[first], *wanted[first:last]])[0, 1:].tolist()
            first = last
        yield batch(schema, label, key, text, attached)


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", bands: int = BANDS, band_slots: int = BAND_SLOTS
) -> DataFrame:
    """(id, key, class_key, class_id, class_size): a class per connected component of near duplicates, for every row of ``df``.

    ``key`` is the content key, ``class_key`` the smallest key of the class, ``class_id`` the smallest id of the class and ``class_size`` its rows. Words are
    lower-cased (A-Z) runs of characters other than the space and the control characters 9 to 13. Texts with the same
    words in the same order are one class; texts without words are one class; a null text is a class of its own with
    its own id. Null ids never name a class unless it has no other. Other columns are ignored.
    """
    rows = stored(signed(df, id_col, text, bands, band_slots), "signed")
    # Copies fold into one row per content before anything is compared, on the map side first.
    contents = rows.filter(F.col("key").isNotNull()).groupBy("key").agg(F.first("bands").alias("bands"), F.min("id").alias("id"))
    members = contents.select("key", F.explode("bands").alias("bucket"))
    # Totals that meet their own rows again are written first: joined by exchanges of their own, hot ones can be split.
    buckets = stored(members.groupBy("bucket").agg(F.min("key").alias("hub"), F.count("*").alias("n")).filter("n > 1"), "hubs")
    shared = stored(members.join(buckets, "bucket").select("key", "hub", "n"), "buckets")

    # Contents that share a bucket, directly or through others, are compared: groups of candidates.
    grouped = components(shared.select("key", "hub"), "key", "hub")
    degree = shared.groupBy("key").agg(F.sum("n").alias("degree"))
    labelled = stored(grouped.select(F.col("node").alias("key"), F.col("root").alias("label")).join(degree, "key"), "labels")
    sizes = labelled.groupBy("label").agg(F.count("*").alias("size"), F.max(F.struct("degree", "key"))["key"].alias("center"))
    sizes = stored(sizes, "sizes")
    candidates = stored(labelled.join(sizes, "label").join(contents.select("key", "id"), "key"), "candidates")

    wanted = candidates.select("id", "key", "label", "size", "center")
    if candidates.count() <= SENT_ROWS:
        wanted = F.broadcast(wanted)
    source = columns(df, own=id_col, text=text)
    own = F.col("own").cast("bigint")
    placed = source.filter(F.col("text").isNotNull()).join(wanted, own.eqNullSafe(F.col("id")))
    placed = _own_content(placed.select("key", "label", "size", "center", "text"))

    small = placed.filter(F.col("size") <= BLOCK_TEXTS).select("label", "key", "text")
    links = map_batches(small.repartition("label").sortWithinPartitions("label"), _compare_groups, _LINKS)
    links = links.unionByName(_links_of_large(placed.filter(F.col("size") > BLOCK_TEXTS)))

    joined = components(stored(links, "near_links"), "a", "b")
    own_class = rows.join(joined, rows["key"] == joined["node"], "left").select(
        "id", "key", F.coalesce("root", "key").alias("class")
    )
    classes = own_class.filter(F.col("class").isNotNull()).groupBy("class").agg(F.min("id").alias("class_id"), F.count("*").alias("class_size"))
    told = own_class.join(stored(classes, "class_ids"), "class", "left")
    alone = F.col("class").isNull()
    return told.select(
        F.col("id").alias(id_col),
        "key",
        F.col("class").alias("class_key"),
        F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(1).cast("bigint")).otherwise(F.col("class_size")).alias("class_size"),
    )


def _own_content(placed: DataFrame) -> DataFrame:
    """Rows whose text has the content key it was joined by: ids may be repeated with other texts."""
    at = placed.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            bodies = rows.column(at).cast(pa.binary()).to_pylist()
            right = [content_key(b) == k for b, k in zip(bodies, rows.column(0).to_pylist(), strict=True)]
            yield rows.filter(pa.array(right, pa.bool_()))

    return map_batches(placed, task, placed.schema)


def _links_of_large(placed: DataFrame) -> DataFrame:
    """Links of groups too large for one task.

    All contents are compared with the group's best connected one first; then blocks of those that are not attached to
    it meet every block. Attached contents are in one component already and need no comparison with each other.
    """
    large = stored(placed.select("label", "key", "text", "center"), "large_groups")
    centers = large.filter(F.col("key") == F.col("center")).select("label", F.col("text").alias("hub")).dropDuplicates(["label"])
    centers = stored(centers, "centers")
    beside = large.select("label", "key", "text").join(centers, "label")
    tried = stored(map_batches(beside, _compare_with_hub, "label binary, key binary, text string, attached boolean"), "attached")
    named = stored(large.select("label", "center").distinct(), "centers")
    stars = tried.filter("attached").join(named, "label")
    stars = stars.filter(F.col("key") != F.col("center")).select(F.col("key").alias("a"), F.col("center").alias("b"))

    blocks = F.ceil(F.col("n") / BLOCK_TEXTS * 2).cast("int")
    per = tried.groupBy("label", "attached").agg(F.countDistinct("key").alias("n"))
    counts = per.groupBy("label").agg(
        F.coalesce(F.max(F.when(F.col("attached"), blocks)), F.lit(0)).alias("n_in"),
        F.coalesce(F.max(F.when(~F.col("attached"), blocks)), F.lit(0)).alias("n_out"),
    )
    rows = tried.join(stored(counts, "blocks"), "label").filter("n_out > 0")
    own = F.pmod(F.xxhash64("key"), F.when(F.col("attached"), F.col("n_in")).otherwise(F.col("n_out"))).cast("int")
    rows = rows.withColumn("own", own)
    # A block meets block k of the others: outer blocks are numbered first, then inner ones.
    outer = F.sequence(F.lit(0), F.col("n_out") - 1)
    everyone = F.sequence(F.lit(0), F.col("n_out") + F.col("n_in") - 1)
    pairs_in = F.transform(outer, lambda k: F.struct(k.alias("i"), (F.col("n_out") + F.col("own")).alias("j")))
    pairs_out = F.transform(
        everyone, lambda k: F.struct(F.least(F.col("own"), k).alias("i"), F.greatest(F.col("own"), k).alias("j"))
    )
    met = rows.select("label", "key", "text", F.explode(F.when(F.col("attached"), pairs_in).otherwise(pairs_out)).alias("pair"))
    grouped = met.select(F.concat("label", F.encode(F.to_json("pair"), "utf-8")).alias("group"), "key", "text")
    links = map_batches(grouped.repartition("group").sortWithinPartitions("group"), _compare_groups, _LINKS)
    return links.unionByName(stars)


def keep_one_of_each(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` without near duplicates: of each class the row with the smallest id, with all its columns.

    Rows with a null text stay. Null ids come after all others. Of rows with the same id and words, one stays.
    """
    classes = stored(near_duplicates(df, id_col, text).select(F.col(id_col).alias("id"), "key", "class_key"), "classes")
    known = classes.filter(F.col("key").isNotNull())
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "key"))
    best = known.groupBy("class_key").agg(first.alias("best"))
    # One row per content and class that does not stay: fewer than the rows, and none for most texts.
    rest = known.select("class_key", "id", "key").distinct().join(best, "class_key")
    stays = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("key") == F.col("best.key"))
    dropped = stored(rest.filter(~stays).select(F.col("id").alias("drop_id"), F.col("key").alias("drop_key")), "dropped")

    name = "content_key"
    while name in df.columns:
        name = f"_{name}"
    place = df.columns.index(text)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            bodies = rows.column(place).cast(pa.binary()).to_pylist()
            keys = pa.array([None if b is None else content_key(b) for b in bodies], pa.binary())
            yield pa.RecordBatch.from_arrays([*rows.columns, keys], names=[*rows.schema.names, name])

    keyed = map_batches(df, task, StructType([*df.schema.fields, StructField(name, BinaryType())]))
    if dropped.count() <= SENT_ROWS:
        dropped = F.broadcast(dropped)
    same = (c(name) == F.col("drop_key")) & c(id_col).cast("bigint").eqNullSafe(F.col("drop_id"))
    left = keyed.join(dropped, same, "left_anti")
    repeated = known.groupBy("id", "key").count().filter("count > 1")
    if not repeated.isEmpty():
        left = left.filter(c(name).isNotNull()).dropDuplicates([name]).unionByName(left.filter(c(name).isNull()))
    return left.drop(name)
