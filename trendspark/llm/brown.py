"""Scores of texts by a class-based bigram model whose classes come from exchange clustering.

The model gives a token the probability of its class after the class before, times its probability within the class.
Counts are over all training texts. A start is found on units: each of the most frequent words, and for the other words
one of a fixed number of groups by their last letters. The bigrams of units, a square table of fixed size, are clustered
from several starts in parallel; the best is kept.

Texts are split into words once. Each chunk of texts keeps its word numbers and sends its distinct words, with their
counts, to buckets by the words' hashes; a bucket counts and numbers its words and sends the numbers back to the chunks.
Bigrams and scores are taken from the chunks, whose arrays travel as one compressed binary value each. The words of the
chunks are a table of their own, which goes as soon as they are numbered.

From the start on every word that came twice or more is moved by its own bigrams with all other words. The words beside
the words of a bucket, with their counts, are one row of a stored table; in a turn, tasks find the best class of each
word of a quarter of the buckets against the counts of class bigrams, and the counts are changed by the words that
moved. The most frequent words, and the groups, which now hold only words that came once or never, move one after
another in between: their neighbours are in the rows of the others. Sweeps end when the likelihood no longer grows. The
driver and each task hold one byte a word for its class.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.llm.arrow import batch, columns, drop_stored, map_batches, raw_text, steps, stored, stored_at
from trendspark.llm.tokens import cuts
from trendspark.session import c, scratch_path

# Words that a model holds by themselves outside of a query; the others have the class of their group there.
FREQUENT_WORDS = 1 << 17
# Units of the start: words of their own, and groups of the other words.
CLUSTER_WORDS, SUFFIX_GROUPS, SUFFIX_BYTES = 1024, 256, 3
CLASSES, SWEEPS, STARTS = 64, 20, 3
# Sweeps over all words end when the likelihood of a token grows by less (natural logarithm).
LEAST_GAIN = 1e-3
# All words move in so many turns, each against counts taken after the turn before.
TURNS = 4
# Rows scored at a time; counts below which logarithms are looked up, and below which one product adds them.
_SCORE_ROWS, _SMALL, _LEAST = 512, 64, 3
# Texts of a chunk, and the fewest buckets of words.
CHUNK_BYTES, BUCKETS = 8 << 20, 256
# Neighbours a task holds before it sends them.
HELD_BIGRAMS = 1_500_000
# Words a task holds while counting.
HELD_WORDS = 400_000
# Cells of a table that are summed in one task.
_CELLS = 1 << 13
# No word holds white space, so this is the end token only.
END = b"\n"
_EMISSION, _TRANSITION = 0.5, 1.0
_EMIT_ROWS = 50_000


def word_codes(column: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct words of a text column without nulls, the word number and the row of every word in order.

    A-Z is lower-cased; words are runs of characters other than the space and the control characters 9 to 13.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(column))
    offsets = lists.offsets.to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(column)), np.diff(offsets))
    words = coded.dictionary.cast(pa.binary()).to_pylist()
    if b"" in words:
        real = codes != words.index(b"")
        codes, rows = codes[real], rows[real]
    return words, codes, rows


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])
    seen: Counter[bytes] = Counter()

    def emit() -> Iterator[pa.RecordBatch]:
        words = list(seen)
        for at in range(0, len(words), _EMIT_ROWS):
            some = words[at : at + _EMIT_ROWS]
            yield batch(schema, some, [seen[w] for w in some])
        seen.clear()

    for rows in batches:
        for column in cuts(rows.column(0)):
            words, codes, _ = word_codes(column)
            counts = np.bincount(codes, minlength=len(words)).tolist()
            seen.update({w: n for w, n in zip(words, counts, strict=True) if n})
            seen[END] += len(column)
            if len(seen) > HELD_WORDS:
                yield from emit()
    yield from emit()


def word_counts(df: DataFrame, text: str) -> DataFrame:
    """(word, n) over all texts, with one end token per text; null texts are empty."""
    partial = map_batches(columns(df, text=text), _count_words, "word binary, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, limit: int) -> list[tuple[bytes, int]]:
    """At most ``limit`` words, all above a common count, by that count; the end token is always there."""
    level = F.floor(F.log2(F.col("n").cast("double")) * 16)
    # At most 64 x 16 levels.
    levels = sorted(counts.groupBy(level.alias("level")).count().collect(), key=lambda r: -r["level"])
    total, least = 0, None
    for r in levels:
        total += r["count"]
        if total > limit:
            break
        least = r["level"]
    kept = (F.col("word") == F.lit(END)) | (level >= F.lit(least) if least is not None else F.lit(False))
    found = [(bytes(r["word"]), r["n"]) for r in counts.filter(kept).collect()]
    return sorted(found, key=lambda r: (-r[1], r[0]))


@dataclass(frozen=True)
class Units:
    """Numbers of the frequent words, their counts, and the unit of any word in the start of the clustering."""

    number: dict[bytes, int]
    counts: np.ndarray
    own: dict[bytes, int]
    n_words: int
    n_groups: int

    @classmethod
    def build(cls, frequent: list[tuple[bytes, int]], n_words: int, n_groups: int) -> Units:
        words = [w for w, _ in frequent if w != END][:n_words]
        return cls(
            {w: i for i, (w, _) in enumerate(frequent)},
            np.array([n for _, n in frequent], np.int64),
            {w: i for i, w in enumerate(words)},
            n_words,
            n_groups,
        )

    def start(self, word: bytes) -> int:
        at = self.own.get(word)
        return self.n_words + self.group(word) if at is None else at

    def unit(self, word: bytes) -> int:
        """Place of a word in the classes of a model: frequent words by number, then the groups."""
        at = self.number.get(word)
        return len(self.number) + self.group(word) if at is None else at

    def group(self, word: bytes) -> int:
        return zlib.crc32(word[-SUFFIX_BYTES:]) % self.n_groups

    @property
    def end(self) -> int:
        return self.n_words + self.n_groups

    @property
    def size(self) -> int:
        return self.n_words + self.n_groups + 1


def _stream(units: np.ndarray, codes: np.ndarray, rows: np.ndarray, n: int, end: int) -> np.ndarray:
    """Units of all rows, one after another, an end unit behind each row."""
    out = np.full(len(codes) + n, end, np.int64)
    out[np.arange(len(codes)) + rows] = units[codes]
    return out


def _h(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def log_likelihood(pairs: np.ndarray) -> float:
    """Of class bigram counts, without constant terms."""
    return float(_h(pairs).sum() - _h(pairs.sum(1)).sum() - _h(pairs.sum(0)).sum())


def class_pairs(bigrams: np.ndarray, assigned: np.ndarray, classes: int) -> np.ndarray:
    member = np.zeros((len(assigned), classes))
    member[np.arange(len(assigned)), assigned] = 1
    return member.T @ (bigrams @ member)


def _sweep(bigrams: np.ndarray, assigned: np.ndarray, pairs: np.ndarray, right: np.ndarray, left: np.ndarray) -> int:
    """Move every unit but the last in turn; ``right`` and ``left`` hold its counts with the classes after and before."""
    moved = 0
    for unit in range(len(bigrams) - 1):
        now, twin = assigned[unit], bigrams[unit, unit]
        after, before = right[unit].copy(), left[unit].copy()
        pairs[now, :] -= after
        pairs[:, now] -= before
        pairs[now, now] += twin
        after[now] -= twin
        before[now] -= twin
        rows, columns_ = _h(pairs + after) - _h(pairs), _h(pairs + before[:, None]) - _h(pairs)
        both = np.diagonal(pairs)
        gain = rows.sum(1) - np.diagonal(rows) + columns_.sum(0) - np.diagonal(columns_)
        gain += _h(both + after + before + twin) - _h(both)
        for side, more in ((pairs.sum(1), after.sum() + twin), (pairs.sum(0), before.sum() + twin)):
            gain -= _h(side + more) - _h(side)
        best = int(np.argmax(gain[:-1]))
        if gain[best] <= gain[now] + 1e-9:
            best = int(now)
        pairs[best, :] += after
        pairs[:, best] += before
        pairs[best, best] += twin
        if best != now:
            moved += 1
            assigned[unit] = best
            right[:, now] -= bigrams[:, unit]
            right[:, best] += bigrams[:, unit]
            left[:, now] -= bigrams[unit]
            left[:, best] += bigrams[unit]
    return moved


def exchange(bigrams: np.ndarray, classes: int, seed: int, sweeps: int) -> tuple[float, np.ndarray]:
    """(log likelihood, class of each unit): every unit in turn moves where the likelihood is highest.

    The last unit, the end token, keeps the last class to itself. Sweeps end early when no unit moves. Units are
    numbered from the most frequent; they start in turn over the classes, from a place and in steps that the seed sets.
    """
    n = len(bigrams)
    random = np.random.Generator(np.random.PCG64(seed))
    assigned = np.arange(n) % (classes - 1) if seed == 0 else random.integers(0, classes - 1, n)
    assigned[-1] = classes - 1
    pairs = class_pairs(bigrams, assigned, classes)
    # Counts of each unit with the classes after and before it.
    member = np.zeros((n, classes))
    member[np.arange(n), assigned] = 1
    right, left = bigrams @ member, bigrams.T @ member
    for _ in range(sweeps):
        if not _sweep(bigrams, assigned, pairs, right, left):
            break
    return log_likelihood(pairs), assigned


def summed(df: DataFrame, total_of: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """The sum of the integer tables, of ``size`` cells each, that ``total_of`` makes of each partition."""

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        yield total_of(batches)

    return summed_and_listed(df, alone, size)[2]


def summed_and_listed(df: DataFrame, parts_of: Callable, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids, all their classes, and the sum of all tables of ``size`` integers that ``parts_of`` yields.

    It yields tables, and pairs of ids and classes. Tables travel in slices, without their zeros, and a slice is summed
    in one task.
    """
    schema = pa.schema([("part", pa.int32()), ("cells", pa.binary()), ("n", pa.binary())])
    cells = _CELLS

    def told(part: int, table: np.ndarray) -> pa.RecordBatch:
        found = np.flatnonzero(table)
        return batch(schema, [part], [found.astype(np.int16).tobytes()], [table[found].tobytes()])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Lists of ids have parts of their own.
        lists = -1 - TaskContext.get().partitionId()
        for x in parts_of(batches):
            if isinstance(x, tuple):
                yield batch(schema, [lists], [x[0].tobytes()], [x[1].tobytes()])
                continue
            for part in range(0, size, cells):
                if x[part : part + cells].any():
                    yield told(part // cells, x[part : part + cells])

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for rows in batches:
            for part, at, n in zip(*(x.to_pylist() for x in rows.columns), strict=True):
                if part < 0:
                    yield batch(schema, [part], [at], [n])
                else:
                    sums.setdefault(part, np.zeros(cells, np.int64))[np.frombuffer(at, np.int16)] += np.frombuffer(n, np.int64)
        for part, table in sums.items():
            yield told(part, table)

    kind = "part int, cells binary, n binary"
    out, ids, classes = np.zeros(-(-size // cells) * cells), [b""], [b""]
    for r in map_batches(map_batches(df, first, kind).repartition("part"), second, kind).collect():
        if r["part"] < 0:
            ids.append(bytes(r["cells"]))
            classes.append(bytes(r["n"]))
        else:
            out[r["part"] * cells :][np.frombuffer(r["cells"], np.int16)] = np.frombuffer(r["n"], np.int64)
    return np.frombuffer(b"".join(ids), np.int64), np.frombuffer(b"".join(classes), np.int8), out[:size]


# --- texts as numbers of words ------------------------------------------------------

# A chunk's texts: ids, sizes in words, whether they are learned from, and the chunk's own number of each word.
_CHUNK = "ids array<bigint>, sizes binary, learned binary, codes binary"
_CHUNK_ARROW = [("ids", pa.list_(pa.int64())), ("sizes", pa.binary()), ("learned", pa.binary()), ("codes", pa.binary())]
# After the words of a chunk in the order of the buckets.
_TEXTS = (1 << 31) - 1
_KINDS = ("texts", "words")


def _narrow(x: np.ndarray) -> bytes:
    """Unsigned numbers in one, two, four or eight bytes each, by the largest."""
    return x.astype(np.min_scalar_type(int(x.max())) if len(x) else np.uint8).tobytes()


def _wide(raw: bytes, n: int) -> np.ndarray:
    """``n`` numbers by ``_narrow``."""
    return np.frombuffer(raw, f"u{max(1, len(raw) // max(n, 1))}").astype(np.int64)


def _packed(x: np.ndarray) -> bytes:
    """Unsigned numbers in as few bytes each as the largest needs, lowest bytes first, compressed; the width before them."""
    width = max(1, -(-int(x.max()).bit_length() // 8)) if len(x) else 1
    planes = np.ascontiguousarray(x, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpacked(raw: bytes, n: int) -> np.ndarray:
    """``n`` numbers by ``_packed``."""
    width = raw[0]
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(pa.decompress(raw[1:], n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, n).T
    return out.reshape(-1).view("<i8")


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple]]]:
    """Rows of sorted batches as tuples, by their first column."""
    rows = (r for b in batches for r in zip(*(x.to_pylist() for x in b.columns), strict=True))
    return groupby(rows, key=lambda r: r[0])


def split_texts(df: DataFrame, id_col: str, text: str, learned: Column, buckets: int) -> tuple[DataFrame, str]:
    """Chunks of texts and, bucket by bucket, their distinct words with the counts in learned texts; and the folder.

    Texts and words are in subfolders of their own, by ``kind``.
    """
    schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), *_CHUNK_ARROW, ("places", pa.binary()), ("words", pa.binary()), ("ns", pa.binary())])
    limit = CHUNK_BYTES

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for rows in batches:
            texts = rows.column(1).fill_null("") if rows.column(1).null_count else rows.column(1)
            for first, last in steps(raw_text(texts)[1], limit):
                n = last - first
                words, codes, of_row = word_codes(texts.slice(first, n))
                learn = rows.column(2).slice(first, n).to_numpy(zero_copy_only=False).astype(bool)
                sizes, none = np.bincount(of_row, minlength=n).astype(np.uint32), [None]
                ids = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), rows.column(0).slice(first, n))
                yield batch(schema, [chunk], [_TEXTS], ids, [sizes.tobytes()], [learn.tobytes()], [_packed(codes)], none, none, none)
                uses, ns = np.bincount(codes, minlength=len(words)), np.bincount(codes[learn[of_row]], minlength=len(words))
                of = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
                order = np.argsort(of, kind="stable")
                # The empty word is never used.
                order = order[uses[order] > 0]
                starts = np.flatnonzero(np.r_[True, of[order][1:] != of[order][:-1]]) if len(order) else order
                parts = np.split(order, starts[1:]) if len(order) else []
                yield batch(
                    schema,
                    [chunk] * len(parts),
                    of[order[starts]],
                    *[pa.nulls(len(parts), t) for _, t in _CHUNK_ARROW],
                    # Ascending in a bucket, so their steps are small.
                    [_narrow(np.diff(x, prepend=0)) for x in parts],
                    [END.join([words[i] for i in x.tolist()]) for x in parts],
                    [_narrow(ns[x]) for x in parts],
                )
                chunk += 1

    source = columns(df.withColumn("learned", learned), id=id_col, text=text, learned="learned").withColumn("id", F.col("id").cast("bigint"))
    kind, path = f"chunk bigint, bucket int, {_CHUNK}, places binary, words binary, ns binary", scratch_path(df.sparkSession, "split_texts")
    told = map_batches(source, task, kind).withColumn("kind", F.when(F.col("bucket") == _TEXTS, _KINDS[0]).otherwise(_KINDS[1]))
    told.write.partitionBy("kind").parquet(path)
    return df.sparkSession.read.schema(f"{kind}, kind string").parquet(path), path


def number_words(split: DataFrame, groups: int) -> tuple[DataFrame, str]:
    """Per bucket its words (chunk -1), per bucket and chunk the numbers of the chunk's words in the bucket; the folder.

    The words that came twice or more, of which there are ``kept``, have the first numbers.
    """
    fields = [(x, pa.binary()) for x in ("places", "numbers", "ns", "groups", "words")]
    schema = pa.schema([("chunk", pa.int64()), ("bucket", pa.int32()), *fields, ("kept", pa.int64()), ("types", pa.int64()), ("seen", pa.int64()), ("tokens", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _by_key(batches):
            _, chunks, places, words, ns = zip(*rows, strict=True)
            sizes = [x.count(END) + 1 for x in words]
            coded = pa.array(END.join(words).split(END), pa.binary()).dictionary_encode()
            distinct, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy()
            n = np.bincount(codes, weights=np.concatenate([_wide(x, size) for x, size in zip(ns, sizes, strict=True)]), minlength=len(distinct)).astype(np.int64)
            order = np.argsort(n < 2, kind="stable")
            number = np.empty(len(order), np.int64)
            number[order] = np.arange(len(order))
            group = np.fromiter((zlib.crc32(w[-SUFFIX_BYTES:]) for w in distinct), np.int64, len(distinct)) % groups
            kept = int((n > 1).sum())
            yield batch(
                schema, [-1], [bucket], [None], [None], [_narrow(n[order])], [group[order].astype(np.uint16).tobytes()], [END.join([distinct[i] for i in order.tolist()])],
                [kept], [len(n)], [int((n > 0).sum())], [int(n.sum())],
            )
            own = np.split(codes, np.cumsum(sizes)[:-1])
            none = pa.nulls(len(chunks), pa.int64())
            yield batch(
                schema, chunks, [bucket] * len(chunks), places, [_narrow(number[x]) for x in own], [_narrow(n[x]) for x in own],
                [group[x].astype(np.uint16).tobytes() for x in own], pa.nulls(len(chunks), pa.binary()), none, none, none, none,
            )

    listed = split.filter(F.col("kind") == _KINDS[1]).select("bucket", "chunk", "places", "words", "ns").repartition("bucket").sortWithinPartitions("bucket", "chunk")
    kind = "chunk bigint, bucket int, places binary, numbers binary, ns binary, groups binary, words binary, kept bigint, types bigint, seen bigint, tokens bigint"
    return stored_at(map_batches(listed, task, kind), "numbered_words")


@dataclass(frozen=True)
class Numbers:
    """From numbers of words in their buckets to ids.

    Ids below ``units`` are units: words of their own, groups of words that came once or never, and the end. ``first``
    has the first id of each bucket's words that came twice or more, ``before`` the words of all buckets before, and
    ``own`` the place of each word that is a unit among all words, ascending, with its unit in ``own_unit``.
    """

    units: int
    n_words: int
    first: np.ndarray
    before: np.ndarray
    own: np.ndarray
    own_unit: np.ndarray

    @property
    def end(self) -> int:
        return self.units - 1

    @property
    def ids(self) -> int:
        return int(self.first[-1])

    def turns(self) -> np.ndarray:
        """The turn in which each id moves; -1 for units."""
        kept = self.first[1:] - self.first[:-1]
        return np.concatenate((np.full(self.units, -1, np.int8), np.repeat(np.arange(len(kept)) % TURNS, kept).astype(np.int8)))

    def __call__(self, bucket: int | np.ndarray, numbers: np.ndarray, groups: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, and their units in the start of the clustering."""
        numbers, groups = numbers.astype(np.int64), groups.astype(np.int64)
        start = self.n_words + groups
        ids = np.where(numbers < (self.first[1:] - self.first[:-1])[bucket], self.first[bucket] + numbers, start)
        if len(self.own):
            place = self.before[bucket] + numbers
            at = np.minimum(np.searchsorted(self.own, place), len(self.own) - 1)
            is_own = self.own[at] == place
            ids, start = np.where(is_own, self.own_unit[at], ids), np.where(is_own, self.own_unit[at], start)
        return ids, start


def listed_words(vocabulary: DataFrame, most: int | None = None) -> DataFrame:
    """(word, n, bucket, number, group) of all words, or of those that may be among the ``most`` frequent."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64()), ("bucket", pa.int32()), ("number", pa.int64()), ("group", pa.int32())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for bucket, words, ns, groups in zip(*(x.to_pylist() for x in rows.columns), strict=True):
                listed, group = words.split(END), np.frombuffer(groups, np.uint16)
                n = _wide(ns, len(listed))
                least = 0 if most is None or len(n) <= most else np.partition(n, -most)[-most]
                found = np.flatnonzero(n >= least)
                for k in range(0, len(found), _EMIT_ROWS):
                    some = found[k : k + _EMIT_ROWS]
                    yield batch(schema, [listed[i] for i in some.tolist()], n[some], np.full(len(some), bucket, np.int32), some, group[some].astype(np.int32))

    return map_batches(vocabulary.select("bucket", "words", "ns", "groups"), task, "word binary, n bigint, bucket int, number bigint, group int")


def encode_texts(split: DataFrame, numbered: DataFrame, numbers: Numbers) -> tuple[DataFrame, str]:
    """Chunks of texts with the id, the unit of the start and the count of each distinct word; and the folder."""
    schema = pa.schema([*_CHUNK_ARROW, ("words", pa.binary()), ("starts", pa.binary()), ("ns", pa.binary()), ("size", pa.int64())])
    shared = split.sparkSession.sparkContext.broadcast(numbers)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids: Numbers = shared.value
        for _, rows in _by_key(batches):
            met = list(rows)
            texts = met.pop()
            # A group takes two bytes.
            sizes = [len(r[5]) // 2 for r in met]
            bucket = np.repeat(np.array([r[1] for r in met], np.int64), np.array(sizes, np.int64))
            none = np.zeros(0, np.int64)
            places = np.concatenate([none, *[np.cumsum(_wide(r[2], n)) for r, n in zip(met, sizes, strict=True)]])
            of_bucket, ns = (np.concatenate([none, *[_wide(r[k], n) for r, n in zip(met, sizes, strict=True)]]) for k in (3, 4))
            size = int(places.max()) + 1 if len(places) else 0
            told = []
            for x in (*to_ids(bucket, of_bucket, np.frombuffer(b"".join(r[5] for r in met), np.uint16)), ns):
                told.append(np.zeros(size, np.int64))
                told[-1][places] = x
            yield batch(schema, *[[x] for x in texts[6:]], *[[_packed(x)] for x in told], [size])

    none = [F.lit(None).cast("binary").alias(x) for x in ("places", "numbers", "ns", "groups")]
    texts = split.filter(F.col("kind") == _KINDS[0]).select("chunk", "bucket", *none, "ids", "sizes", "learned", "codes")
    no_text = [F.lit(None).cast(kind).alias(x) for x, kind in (("ids", "array<bigint>"), ("sizes", "binary"), ("learned", "binary"), ("codes", "binary"))]
    maps = numbered.filter("chunk >= 0").select("chunk", "bucket", "places", "numbers", "ns", "groups", *no_text)
    dealt = texts.unionAll(maps).repartition("chunk").sortWithinPartitions("chunk", "bucket")
    return stored_at(map_batches(dealt, task, f"{_CHUNK}, words binary, starts binary, ns binary, size bigint"), "encoded_texts")


def _learned_pairs(sizes: bytes, learned: bytes, codes: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of each learned word and of the one before it; the end of a text is ``n`` and stands before the first."""
    sizes_, learned_ = np.frombuffer(sizes, np.uint32).astype(np.int64), np.frombuffer(learned, bool)
    some = _unpacked(codes, int(sizes_.sum()))[np.repeat(learned_, sizes_)]
    rows = int(learned_.sum())
    stream = _stream(np.arange(n), some, np.repeat(np.arange(rows), sizes_[learned_]), rows, n)
    return stream, np.concatenate(([n], stream[:-1]))


def unit_tables(encoded: DataFrame, numbers: Numbers) -> tuple[np.ndarray, np.ndarray]:
    """How often a unit follows another: with the units of the start for all words, and among words that are units."""
    size, end = numbers.units, numbers.end

    def total_of(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(2 * size * size, np.int64)
        for rows in batches:
            for sizes, learned, codes, words, starts, n in zip(*(x.to_pylist() for x in rows.columns), strict=True):
                ids = np.append(_unpacked(words, n), end)
                after, before = _learned_pairs(sizes, learned, codes, len(ids) - 1)
                start = np.append(_unpacked(starts, n), end)
                total[: size * size] += np.bincount(start[before] * size + start[after], minlength=size * size)
                a, b = ids[before], ids[after]
                both = (a < size) & (b < size)
                total[size * size :] += np.bincount(a[both] * size + b[both], minlength=size * size)
        return total

    told = summed(encoded.select("sizes", "learned", "codes", "words", "starts", "size"), total_of, 2 * size * size)
    return told[: size * size].reshape(size, size), told[size * size :].reshape(size, size)


def exchange_classes(table: np.ndarray, spark, classes: int = CLASSES) -> np.ndarray:
    """Class of each unit, by the best of some exchange clusterings of unit bigrams from different starts.

    The unit bigrams are a square table of a size that does not depend on the corpus; each task clusters it once.
    """
    shared = spark.sparkContext.broadcast(table)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("seed", pa.int64()), ("likelihood", pa.float64()), ("classes", pa.list_(pa.int32()))])
        for rows in batches:
            for seed in rows.column(0).to_pylist():
                likelihood, assigned = exchange(shared.value, classes, seed, SWEEPS)
                yield batch(schema, [seed], [likelihood], [assigned.tolist()])

    starts = spark.range(0, STARTS, 1, STARTS)
    told = map_batches(starts, task, "seed bigint, likelihood double, classes array<int>").collect()
    return np.array(max(told, key=lambda r: (r["likelihood"], -r["seed"]))["classes"])


# --- all words ------------------------------------------------------------------


# Columns of the neighbours of a bucket's words: of all, and of those that move in the same turn.
_BESIDE = ["ids", "sizes", "codes", "ns"]
_BESIDE_SAME = [f"same_{x}" for x in _BESIDE]


def word_contexts(encoded: DataFrame, numbers: Numbers) -> tuple[DataFrame, str]:
    """Per bucket its turn and its words that are no units with their neighbours, and its folder.

    A word's neighbours are codes with counts: twice the neighbour's id, and one more if the neighbour stands before
    the word; counts of 256 and more are several. The most frequent words, the units, have none, so no bucket is large
    beside the corpus.
    """
    schema = pa.schema([("bucket", pa.int32()), ("size", pa.int64()), ("numbers", pa.binary()), ("codes", pa.binary()), ("ns", pa.binary())])
    shared = encoded.sparkSession.sparkContext.broadcast(numbers)
    # Two bytes hold a bucket if they can: these are sorted faster.
    small, held_most = np.uint16 if len(numbers.first) <= 1 << 16 else np.int64, HELD_BIGRAMS

    def packed(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        bucket, *rest = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(bucket, kind="stable")
        bucket, rest = bucket[order], [x[order] for x in rest]
        at = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]).tolist()
        ranges = list(zip(at, [*at[1:], len(bucket)], strict=True))
        return batch(schema, bucket[at].astype(np.int32), [k - i for i, k in ranges], *[[_narrow(x[i:k]) for i, k in ranges] for x in rest])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids: Numbers = shared.value
        held, size = [], 0
        for rows in batches:
            for sizes, learned, codes, words, n_words in zip(*(x.to_pylist() for x in rows.columns), strict=True):
                ids = np.append(_unpacked(words, n_words), to_ids.end)
                bucket = np.searchsorted(to_ids.first, ids, side="right") - 1
                number = (ids - to_ids.first[bucket]).astype(np.uint32)
                bucket = bucket.astype(small)
                after, before = _learned_pairs(sizes, learned, codes, n_words)
                found, n = np.unique(before * len(ids) + after, return_counts=True)
                a, b = found // len(ids), found % len(ids)
                for word, other, side in ((a, b, 0), (b, a, 1)):
                    some = np.flatnonzero(ids[word] >= to_ids.units)
                    if len(some):
                        word = word[some]
                        held.append((bucket[word], number[word], ids[other[some]] * 2 + side, n[some].astype(np.uint32)))
                        size += len(some)
                if size > held_most:
                    yield packed(held)
                    held, size = [], 0
        if held:
            yield packed(held)

    span = 2 * numbers.ids
    told = pa.schema([("turn", pa.int32()), *[(x, pa.binary()) for x in _BESIDE + _BESIDE_SAME], ("code_bytes", pa.int32())])

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, turn_of = shared.value.first, shared.value.turns()
        width = np.uint32 if span < 1 << 32 else np.uint64

        def listed(word: np.ndarray, code: np.ndarray, n: np.ndarray) -> list[list[bytes]]:
            ids, sizes = np.unique(word, return_counts=True)
            return [[x.tobytes()] for x in (ids, sizes, code.astype(width), n)]

        for bucket, rows in _by_key(batches):
            number, code, n = (np.concatenate([_wide(r[k], r[1]) for r in rows_]) for rows_ in [list(rows)] for k in (2, 3, 4))
            # A bucket's words times all codes stay far below 2**63.
            key = number * span + code
            order = np.argsort(key)
            key = key[order]
            new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            ns, key = np.add.reduceat(n[order], new), key[new]
            # Counts in one byte each, as many as it takes.
            times = -(-ns // 255)
            last = np.cumsum(times) - 1
            n = np.full(int(times.sum()), 255, np.uint8)
            n[last] = ns - 255 * (times - 1)
            word, code = np.repeat(key // span + first[bucket], times), np.repeat(key % span, times)
            same = turn_of[code >> 1] == bucket % TURNS
            yield batch(told, [bucket % TURNS], *listed(word, code, n), *listed(word[same], code[same], n[same]), [width().itemsize])

    sent = map_batches(encoded.select("sizes", "learned", "codes", "words", "size"), task, "bucket int, size bigint, numbers binary, codes binary, ns binary")
    dealt = sent.select("bucket", "size", "numbers", "codes", "ns").repartition("bucket").sortWithinPartitions("bucket")
    kind, path = f"turn int, {', '.join(f'{x} binary' for x in _BESIDE + _BESIDE_SAME)}, code_bytes int", scratch_path(encoded.sparkSession, "word_contexts")
    map_batches(dealt, met, kind).write.partitionBy("turn").parquet(path)
    return encoded.sparkSession.read.schema(kind).parquet(path), path


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Of each bucket: ids and numbers of neighbours of its words, then the neighbours' codes and counts."""
    for rows in batches:
        for width, *arrays in zip(*rows.columns, strict=True):
            kinds = (np.int64, np.int64, f"u{width.as_py()}", np.uint8)
            yield tuple(np.frombuffer(x.as_buffer(), kind) for x, kind in zip(arrays, kinds, strict=True))


def _add_pairs(total: np.ndarray, units: int, own: np.ndarray, codes: np.ndarray, ns: np.ndarray, signed: list[tuple[np.ndarray, int]]) -> None:
    """Add pairs of words with neighbours to the counts of class bigrams and of units beside classes.

    ``signed`` has tables of classes by id, each with the sign that its counts take.
    """
    square, wide = CLASSES * CLASSES, units * CLASSES
    other, before = (codes >> 1).astype(np.int64), (codes & 1).astype(bool)
    unit = other < units
    edge = square + np.where(before, 0, wide) + other * CLASSES
    for classes, sign in signed:
        mine, its = classes[own].astype(np.int64), classes[other].astype(np.int64)
        key = np.where(unit, edge + mine, np.where(before, its * CLASSES + mine, mine * CLASSES + its))
        total += sign * np.bincount(key, weights=ns, minlength=len(total)).astype(np.int64)


def _tables(total: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class bigrams among words that are no units; counts of each unit with classes of such words after and before it."""
    square, wide = CLASSES * CLASSES, units * CLASSES
    return total[:square].reshape(CLASSES, -1), total[square : square + wide].reshape(units, -1), total[square + wide :].reshape(units, -1)


def _table_size(units: int) -> int:
    return CLASSES * (CLASSES + 2 * units)


def count_classes(contexts: DataFrame, shared, units: int) -> np.ndarray:
    """The counts of ``_tables``, all in one row, for the classes of ``shared``."""

    def total_of(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        classes = shared.value[1]
        total = np.zeros(_table_size(units), np.int64)
        for ids, sizes, codes, ns in _contexts(batches):
            # Of two words that are no units, the first one's row counts.
            some = np.flatnonzero((codes < 2 * units) | (codes & 1 == 0))
            _add_pairs(total, units, np.repeat(ids, sizes)[some], codes[some], ns[some], [(classes, 1)])
        return total

    return summed(contexts.select("code_bytes", *_BESIDE), total_of, _table_size(units))


def _changes(contexts: DataFrame, shared, units: int) -> np.ndarray:
    """What pairs of two words of the same turn change in the counts; ``shared`` has the classes before and now."""

    def total_of(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        old, now = shared.value
        moved = old != now
        total = np.zeros(_table_size(units), np.int64)
        for ids, sizes, codes, ns in _contexts(batches):
            # Where both words have moved, the first one's row counts.
            some = np.flatnonzero(np.repeat(moved[ids], sizes))
            some = some[(codes[some] & 1 == 0) | ~moved[codes[some] >> 1]]
            if len(some):
                _add_pairs(total, units, np.repeat(ids, sizes)[some], codes[some], ns[some], [(now, 1), (old, -1)])
        return total

    return summed(contexts.select("code_bytes", *_BESIDE_SAME), total_of, _table_size(units))


def _grown(table: np.ndarray) -> np.ndarray:
    """Of each small count x and class k, one row of what x more counts with k add in each class."""
    more = np.arange(_SMALL)[:, None, None]
    return (_h(table.T + more) - _h(table.T)).reshape(-1, len(table))


def best_classes(pairs: np.ndarray, now: np.ndarray, after: np.ndarray, before: np.ndarray, twin: np.ndarray, grown: tuple | None = None) -> np.ndarray:
    """For each word, alone, the class that gives the highest likelihood; its own class if no other is better.

    ``after`` and ``before`` count the classes beside a word (one row each) without its ``twin`` bigrams with itself.
    """
    rows, classes = np.arange(len(now)), len(pairs)
    gain = np.zeros((len(now), classes))
    grown = grown or (_grown(pairs), _grown(pairs.T))
    for table, mine, across, known in ((pairs, after, before, grown[0]), (pairs.T, before, after, grown[1])):
        cells = np.flatnonzero(mine)
        x = mine.ravel()[cells]
        few = x < _SMALL
        # What small counts with the neighbour's class add is known for all classes.
        many, cells, x = cells[~few], cells[few], x[few]
        r = cells // classes
        k = cells - r * classes
        at = x.astype(np.int64) * classes + k
        one = x < _LEAST
        least = np.zeros((len(now), (_LEAST - 1) * classes))
        least.ravel()[r[one] * ((_LEAST - 1) * classes) + at[one] - classes] = 1
        gain += least @ known[classes : _LEAST * classes]
        more_ = ~one
        _add_rows(gain, r[more_], known.take(at[more_], axis=0))
        # The class with itself is taken below, and the word's own class holds the word already.
        of, at_row = known.ravel(), at * classes
        gain.ravel()[cells] -= of.take(at_row + k)
        own = now[r]
        here, same = table[own, k], k == own
        gain[rows, now] += np.bincount(r, weights=np.where(same, 0, _h(here) - _h(here - x) - of.take(at_row + own)), minlength=len(now))
        # Beside its own class, a word's counts on the other side are in the counts too.
        lone, mid, place = r[same], k[same], at[same]
        i, to = np.nonzero(across[lone])
        i, to = i[to != mid[i]], to[to != mid[i]]
        counts = table[to, mid[i]] - across[lone[i], to]
        gain[lone[i], to] += _h(counts + x[same][i]) - _h(counts) - known[place[i], to]

        r = many // classes
        k = many - r * classes
        x, lone, at = mine[r, k][:, None], np.arange(len(r)), now[r]
        # Counts of all classes with the neighbour's class, without this word.
        counts = table.T[k].copy()
        counts[lone, at] -= x[:, 0]
        same = np.flatnonzero(k == at)
        counts[same] -= across[r[same]]
        counts[same, at[same]] -= twin[r[same]]
        told = _h(counts + x) - _h(counts)
        told[lone, k] = 0
        _add_rows(gain, r, told)

        more, side = mine.sum(1) + twin, table.sum(1)
        which, where = np.unique(more, return_inverse=True)
        gain -= (_h(side + which[:, None]) - _h(side))[where]
        own = side[now]
        gain[rows, now] += _h(own + more) - 2 * _h(own) + _h(own - more)
    own = after + before + twin[:, None]
    cells = np.flatnonzero(own)
    r = cells // classes
    k = cells - r * classes
    x, both = own.ravel()[cells], np.diagonal(pairs)[k]
    both = np.where(k == now[r], both - x, both)
    gain.ravel()[cells] += _h(both + x) - _h(both)
    gain = gain.round(6)
    # Words that move together would all take the same empty class: units, which move in turn, open these.
    gain[:, pairs.sum(0) == 0] = -np.inf
    # The last class is the end token's.
    best = gain[:, :-1].argmax(1)
    return np.where(gain[rows, best] > gain[rows, now], best, now)


def _add_rows(gain: np.ndarray, r: np.ndarray, told: np.ndarray) -> None:
    """Add rows of ``told`` to the rows ``r``, ascending, of ``gain``."""
    if len(r):
        first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
        gain[r[first]] += np.add.reduceat(told, first, axis=0)


def _moves(contexts: DataFrame, shared, pairs: np.ndarray, units: int, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of the words for which another class is best, that class, and what they change in the counts.

    Pairs of two words of the turn are not counted: both may have moved.
    """

    def total_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray | tuple[np.ndarray, np.ndarray]]:
        turn_of, classes = shared.value
        now, grown = classes.copy(), (_grown(pairs), _grown(pairs.T))
        total = np.zeros(_table_size(units), np.int64)
        for ids, sizes, codes, ns in _contexts(batches):
            ends = np.concatenate(([0], np.cumsum(sizes)))
            for low in range(0, len(ids), _SCORE_ROWS):
                words = ids[low : low + _SCORE_ROWS]
                some = slice(ends[low], ends[low + len(words)])
                other, left = (codes[some] >> 1).astype(np.int64), (codes[some] & 1).astype(np.int64)
                row = np.repeat(np.arange(len(words)), sizes[low : low + len(words)])
                n, self_ = ns[some], other == words[row]
                size = len(words) * CLASSES
                key = left * size + row * CLASSES + classes[other]
                beside = np.bincount(key, weights=np.where(self_, 0, n), minlength=2 * size).reshape(2, -1, CLASSES)
                same = np.flatnonzero(self_ & (left == 0))
                twin = np.bincount(row[same], weights=n[same], minlength=len(words))
                now[words] = best_classes(pairs, classes[words].astype(np.int64), *beside, twin, grown)
            moved = now[ids] != classes[ids]
            some = np.flatnonzero(np.repeat(moved, sizes))
            some = some[turn_of[codes[some] >> 1] != turn]
            if len(some):
                _add_pairs(total, units, np.repeat(ids, sizes)[some], codes[some], ns[some], [(now, 1), (classes, -1)])
            yield ids[moved], now[ids[moved]]
        yield total

    return summed_and_listed(contexts.select("code_bytes", *_BESIDE), total_of, _table_size(units))


def all_word_classes(contexts: DataFrame, bigrams: np.ndarray, classes: np.ndarray, numbers: Numbers) -> tuple[np.ndarray, np.ndarray]:
    """(class of each id, class bigram counts) after sweeps over all words from the given classes.

    ``bigrams`` are those among units, which have the first ids and whose last is the end token.
    """
    units, turn_of = len(bigrams), numbers.turns()
    context = contexts.sparkSession.sparkContext
    shared = context.broadcast((None, classes))
    total = count_classes(contexts, shared, units)
    best: tuple[float, np.ndarray, np.ndarray] | None = None
    for step in range(SWEEPS * TURNS + 1):
        turn = step % TURNS
        mine = classes[:units].astype(np.int64)
        member = np.zeros((units, CLASSES))
        member[np.arange(units), mine] = 1
        body, right, left = _tables(total, units)
        pairs = body + member.T @ (bigrams @ member) + member.T @ right + (member.T @ left).T
        if turn == 0:
            likelihood = log_likelihood(pairs)
            if best is not None and likelihood - best[0] < LEAST_GAIN * max(pairs.sum(), 1):
                # Words that move together do not see each other's moves, so a sweep may lose; the better state is kept.
                return (classes, pairs) if likelihood > best[0] else best[1:]
            best = (likelihood, classes.copy(), pairs.copy())
        if step == SWEEPS * TURNS:
            break
        _sweep(bigrams, mine, pairs, right + bigrams @ member, left + bigrams.T @ member)
        before = classes.copy()
        before[:units] = mine
        shared.unpersist()
        shared = context.broadcast((turn_of, before))
        some_words = contexts.filter(F.col("turn") == turn)
        ids, best_of, change = _moves(some_words, shared, pairs, units, turn)
        classes = before.copy()
        classes[ids] = best_of
        shared.unpersist()
        shared = context.broadcast((before, classes))
        total += change
        if len(ids):
            total += _changes(some_words, shared, units)
    return best[1:]


@dataclass(frozen=True)
class Model:
    """``classes`` has those of the frequent words, by number, and of the groups."""

    units: Units
    classes: np.ndarray
    transition: np.ndarray
    emission_total: np.ndarray
    train_tokens: int
    train_words: int

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.5) / (self.train_tokens + 0.5 * (self.train_words + 1)))

    def emission(self, counts: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.log10((counts + _EMISSION) / self.emission_total[of])


@dataclass(frozen=True)
class Learned:
    """A model of all words: their classes, and the tables of classes."""

    numbers: Numbers
    classes: np.ndarray
    transition: np.ndarray
    emission_total: np.ndarray
    train_tokens: int
    train_words: int
    train_texts: int


def train(df: DataFrame, text: str, counts: DataFrame) -> Model:
    """The model of the texts of ``df``, whose word counts are ``counts``."""
    source = df.select(F.lit(None).cast("bigint").alias("id"), c(text).alias("text"))
    learned, _, vocabulary = learn(source, "id", "text", F.lit(True))
    frequent = frequent_words(counts, FREQUENT_WORDS)
    units = Units.build(frequent, CLUSTER_WORDS, SUFFIX_GROUPS)
    least = min((n for w, n in frequent if w != END), default=1 << 62)
    of = {END: CLASSES - 1}
    for r in listed_words(vocabulary).filter(F.col("n") >= least).collect():
        if bytes(r["word"]) in units.number:
            at = learned.numbers(np.array([r["bucket"]]), np.array([r["number"]]), np.array([r["group"]]))[0]
            of[bytes(r["word"])] = int(learned.classes[at[0]])
    groups = learned.classes[learned.numbers.n_words : learned.numbers.end]
    classes = np.concatenate(([of[w] for w in units.number], groups)).astype(np.int64)
    return Model(units, classes, learned.transition, learned.emission_total, learned.train_tokens, learned.train_words)


def learn(df: DataFrame, id_col: str, text: str, learned: Column) -> tuple[Learned, DataFrame, DataFrame]:
    """The model of the texts that are ``learned``; all texts as ids of words; and the words of the buckets."""
    spark = df.sparkSession
    buckets = max(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    split, split_path = split_texts(df, id_col, text, learned, buckets)
    numbered, numbered_path = number_words(split, SUFFIX_GROUPS)
    drop_stored(spark, f"{split_path}/kind={_KINDS[1]}")
    vocabulary = stored(numbered.filter("chunk = -1"), "vocabulary")
    kept, types = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
    groups = [b""] * buckets
    n = v = 0
    # One row a bucket.
    for r in vocabulary.select("bucket", "kept", "types", "seen", "tokens", "groups").collect():
        at = r["bucket"]
        kept[at], types[at], groups[at] = r["kept"], r["types"], bytes(r["groups"])[: 2 * r["kept"]]
        n, v = n + r["tokens"], v + r["seen"]
    units = CLUSTER_WORDS + SUFFIX_GROUPS + 1
    before = np.concatenate(([0], np.cumsum(types)))
    most = listed_words(vocabulary, CLUSTER_WORDS).filter("n > 0").orderBy(F.desc("n"), "word").select("bucket", "number").limit(CLUSTER_WORDS).collect()
    place = np.array([before[r["bucket"]] + r["number"] for r in most], np.int64)
    order = np.argsort(place)
    numbers = Numbers(units, CLUSTER_WORDS, units + np.concatenate(([0], np.cumsum(kept))), before, place[order], order)

    encoded, _ = encode_texts(split, numbered, numbers)
    drop_stored(spark, split_path, numbered_path)
    start_table, table = unit_tables(encoded, numbers)
    # Every text has one end token, whatever stands before it.
    texts = int(start_table[:, numbers.end].sum())
    started = exchange_classes(start_table, spark).astype(np.int8)
    contexts, contexts_path = word_contexts(encoded, numbers)
    first = np.frombuffer(b"".join(groups), np.uint16).astype(np.int64)
    classes, pairs = all_word_classes(contexts, table, np.concatenate((started, started[CLUSTER_WORDS + first])), numbers)
    drop_stored(spark, contexts_path)

    shared = spark.sparkContext.broadcast((numbers, classes))

    def total_of(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        to_ids, of = shared.value
        total = np.zeros(2 * CLASSES, np.int64)
        for rows in batches:
            for bucket, ns, group in zip(*(x.to_pylist() for x in rows.columns), strict=True):
                group = np.frombuffer(group, np.uint16)
                n = _wide(ns, len(group))
                cls = of[to_ids(np.full(len(n), bucket), np.arange(len(n)), group)[0]]
                total[:CLASSES] += np.bincount(cls, weights=n, minlength=CLASSES).astype(np.int64)
                total[CLASSES:] += np.bincount(cls[n > 0], minlength=CLASSES)
        return total

    told = summed(vocabulary.select("bucket", "ns", "groups"), total_of, 2 * CLASSES)
    tokens, kinds = told[:CLASSES], told[CLASSES:]
    tokens[-1], kinds[-1] = texts, texts > 0
    # A place for one unseen word per class; the end class has none.
    emission = tokens + _EMISSION * (kinds + 1)
    emission[-1] = tokens[-1] + _EMISSION
    prior = (pairs.sum(0) + 0.5) / (pairs.sum() + 0.5 * CLASSES)
    transition = np.log10((pairs + _TRANSITION * prior) / (pairs.sum(1, keepdims=True) + _TRANSITION))
    return Learned(numbers, classes, transition, emission, int(n + texts), int(v + (texts > 0)), texts), encoded, vocabulary


def held_out(id_col: Column, folds: int = 5, fold: int = 1) -> Column:
    """Whether a row is left out of training, by the crc32 of its id as text; rows without an id are not."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def _scores(encoded: DataFrame, learned: Learned) -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) of every text."""
    schema = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
    shared = encoded.sparkSession.sparkContext.broadcast(learned)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Learned = shared.value
        for rows in batches:
            ids = rows.column(0).flatten()
            at = 0
            for sizes, codes, words, ns, n_words in zip(*(x.to_pylist() for x in rows.columns[1:]), strict=True):
                size = np.frombuffer(sizes, np.uint32).astype(np.int64)
                n, code = len(size), _unpacked(codes, int(size.sum()))
                # The last number stands for the end token.
                of = np.append(_unpacked(words, n_words), model.numbers.end)
                count = np.append(_unpacked(ns, n_words), model.train_texts).astype(np.float64)
                cls = model.classes[of].astype(np.int64)
                base_of = np.log10((count + 0.5) / (model.train_tokens + 0.5 * (model.train_words + 1)))
                emit_of = np.log10((count + _EMISSION) / model.emission_total[cls])
                of_row = np.repeat(np.arange(n), size)
                stream = _stream(np.arange(len(of)), code, of_row, n, len(of) - 1)
                # A text's end token is its last one.
                owner = np.repeat(np.arange(n), size + 1)
                after = cls[stream]
                steps_ = model.transition[np.concatenate(([CLASSES - 1], after[:-1])), after]
                base = np.bincount(owner, weights=base_of[stream], minlength=n)
                score = np.bincount(owner, weights=emit_of[stream] + steps_, minlength=n)
                known = np.bincount(owner, weights=count[stream] > 0, minlength=n).astype(np.int64)
                yield batch(schema, ids.slice(at, n), size + 1, known, base, score)
                at += n

    return map_batches(encoded.select("ids", "sizes", "codes", "words", "ns", "size"), task, "id bigint, n_tokens bigint, n_known bigint, base_score double, score double")


def score_texts(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    The model learns from the rows that are not held out. Scores are log10 probabilities of the whole text with its end
    token. A null text is empty and has the end token alone; rows with equal or null ids are texts of their own; other
    columns are ignored. Without training rows all counts are zero.
    """
    source = columns(df, id=id_col, text=text)
    learned, encoded, _ = learn(source, "id", "text", ~held_out(F.col("id")))
    told = _scores(encoded, learned)
    return told.select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(learned.train_tokens).cast("bigint").alias("train_tokens"),
        "base_score",
        "score",
    )
