"""Phrases whose words occur together more often than by chance, by weighted acyclic automata.

Every run of up to five words that starts at a word is a window; the paths of the windows form an acyclic automaton whose
arcs carry counts, so that the weight of a path is the number of occurrences of its phrase. Tasks build such count
transducers from their sorted windows, cut at fixed windows into prefix ranges. The transducers of a range meet in one
task, which unions them and sums the weights level by level; arcs below the least count go with all that hangs on them,
since no phrase is more frequent than its parts. The parts of a candidate are looked up by composing them with the
transducers of their ranges.

A window ends at a word that is too rare for any candidate. Such words are told by a bit table of fixed size; a word that
shares a bit with a frequent one only costs work.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendspark.llm.arrow import columns, map_batches, stored
from trendspark.llm.words import LOWERED, byte_set, texts

SIZE = 5
LEAST = 100
TOP = 2000
SLICE_WORDS = 1_000_000
RANGE_WORDS = 8_000_000
SAMPLE = 20_000
SLICE_SAMPLE = 512
BIT_BITS = 26
_BITMAP = 1 << 15  # bits of one of Spark's bitmaps
_SPACES = byte_set(b" \t")
_BREAKS = byte_set(b".,;:!?\n\x0b\x0c\r")
_INSIDE = ~(_SPACES | _BREAKS)
_OTHER_LANG = "und"

# A label is a language and a word of it; words hold no line feed.
_SEPARATOR = b"\n"


# --- words of a shard --------------------------------------------------------------------------


@dataclass
class Words:
    """Consecutive words: their text, their language's number, and whether each starts a new piece."""

    word: pa.Array
    lang: np.ndarray
    opens: np.ndarray

    def __len__(self) -> int:
        return len(self.lang)


def _read(batches: Iterator[pa.RecordBatch], langs: dict[str, int]) -> Iterator[Words]:
    """Words of (text, lang) batches, some at a time; languages are numbered in ``langs``."""
    for rows in batches:
        names = pc.fill_null(rows.column(1), _OTHER_LANG).to_pylist()
        numbers = np.array([langs.setdefault(name, len(langs)) for name in names], np.int64)
        for some in texts(rows.column(0)):
            data = LOWERED[some.data]
            inside = _INSIDE[data]
            starts, ends = some.spans(inside)
            if not len(starts):
                continue
            row = some.rows_of(starts)
            piece = np.searchsorted(np.flatnonzero(_BREAKS[data]), starts)
            opens = np.ones(len(starts), bool)
            opens[1:] = (row[1:] != row[:-1]) | (piece[1:] != piece[:-1])
            offsets = np.concatenate(([0], np.cumsum(ends - starts)))
            word = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
            yield Words(word, numbers[row + some.first], opens)


def _slices(parts: Iterator[Words], size: int) -> Iterator[tuple[Words, int]]:
    """Words in slices of about ``size``, with the number of those whose windows are the slice's own.

    The last words of a slice come again before the next one's, as their windows reach into it.
    """
    held: list[Words] = []
    n = 0

    def joined() -> Words:
        return Words(pa.concat_arrays([w.word for w in held]), np.concatenate([w.lang for w in held]), np.concatenate([w.opens for w in held]))

    for part in parts:
        for first in range(0, len(part), size):
            cut = slice(first, first + size)
            held.append(Words(part.word[cut], part.lang[cut], part.opens[cut]))
            n += len(held[-1])
            if n >= size + SIZE:
                whole = joined()
                yield whole, n - (SIZE - 1)
                held = [Words(whole.word[1 - SIZE :], whole.lang[1 - SIZE :], whole.opens[1 - SIZE :])]
                n = SIZE - 1
    if n:
        yield joined(), n


def _pairs(words: Words, langs: dict[str, int]) -> tuple[list[bytes], np.ndarray]:
    """Distinct labels of the words, and each word's place among them."""
    coded = words.word.dictionary_encode()
    spelled = coded.dictionary.to_pylist()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    prefix = [name.encode() + _SEPARATOR for name in langs]
    together = words.lang * len(spelled) + code
    if len(prefix) * len(spelled) <= 8 * len(code):
        there = np.zeros(len(prefix) * len(spelled), bool)
        there[together] = True
        distinct = np.flatnonzero(there)
        place = (np.cumsum(there) - 1)[together]
    else:
        distinct, place = np.unique(together, return_inverse=True)
    lang, word = np.divmod(distinct, len(spelled))
    return [prefix[a] + spelled[b] for a, b in zip(lang.tolist(), word.tolist(), strict=True)], place


def _split_label(label: bytes) -> tuple[str, str]:
    lang, _, word = label.rpartition(_SEPARATOR)
    return lang.decode(), word.decode()


def _word_counts(docs: DataFrame, slice_words: int) -> DataFrame:
    """(label, f) of every word by language, with f = 0 for a spread of windows from all tasks."""
    schema = pa.schema([("label", pa.binary()), ("f", pa.int64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs: dict[str, int] = {}
        for words, own in _slices(_read(batches, langs), slice_words):
            labels, place = _pairs(words, langs)
            counts = np.bincount(place[:own], minlength=len(labels))
            step = max(1, own // SLICE_SAMPLE)
            windows = []
            for i in range(step // 2, own, step):
                stop = i + 1
                while stop < min(i + SIZE, len(words)) and not words.opens[stop]:
                    stop += 1
                lang = labels[place[i]].rpartition(_SEPARATOR)[0]
                # Two separators in front tell a window from a word.
                windows.append(b"\n\n" + b"\n".join([lang.hex().encode(), *words.word[i:stop].to_pylist()]))
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.binary()), pa.array(counts)], schema=schema).filter(pa.array(counts > 0))
            yield pa.RecordBatch.from_arrays([pa.array(windows, pa.binary()), pa.array(np.zeros(len(windows), np.int64))], schema=schema)

    return map_batches(docs, task, "label binary, f bigint").groupBy("label").agg(F.sum("f").alias("f"))


# --- count transducers ---------------------------------------------------------------------------


@dataclass
class Transducer:
    """A weighted acyclic automaton of label paths, by level.

    States of a level stand in the order of their paths; ``parents`` are states of the level before (ascending),
    ``labels`` places in the sorted ``vocabulary``, ``weights`` the counts of the paths.
    """

    vocabulary: list[bytes]
    parents: list[np.ndarray]
    labels: list[np.ndarray]
    weights: list[np.ndarray]

    @classmethod
    def from_sorted(cls, vocabulary: list[bytes], paths: Sequence[np.ndarray], counts: np.ndarray) -> Transducer:
        """From distinct paths in order (a column a level, 0 after a path's end, else label + 1) and their counts."""
        parents, labels, weights = [], [], []
        running = np.concatenate(([0], np.cumsum(counts)))
        changed = np.zeros(len(counts), bool)
        if len(counts):
            changed[0] = True
        above = np.zeros(len(counts), np.int64)
        for column in paths:
            changed[1:] |= column[1:] != column[:-1]
            state = np.cumsum(changed) - 1
            at = np.flatnonzero(changed)
            ends = np.append(at[1:], len(counts))
            # A path that ended makes a group of its own here, but no state.
            there = column[at] > 0
            parents.append(above[at[there]])
            labels.append(column[at[there]] - 1)
            weights.append((running[ends] - running[at])[there])
            numbers = np.cumsum(there) - 1
            above = numbers[state]
        return cls(vocabulary, parents, labels, weights)

    def to_bytes(self) -> bytes:
        """Packed form: only the labels in use, level by level, planes of bytes compressed."""
        used = np.unique(np.concatenate(self.labels)) if self.labels else np.zeros(0, np.int64)
        spelled = [self.vocabulary[i] for i in used.tolist()]
        blocks = [np.array(list(map(len, spelled)), np.int64)]
        for parent, label, weight in zip(self.parents, self.labels, self.weights, strict=True):
            blocks += [np.diff(parent, prepend=0), np.searchsorted(used, label), weight]
        body = b"".join(_planes(b) for b in blocks) + b"".join(spelled)
        head = np.array([len(self.parents), len(spelled), *map(len, self.parents), len(body)], np.int64).tobytes()
        return head + pa.compress(body, codec="zstd", asbytes=True)

    @classmethod
    def from_bytes(cls, data: bytes) -> Transducer:
        depth, n = np.frombuffer(data, np.int64, 2).tolist()
        *sizes, length = np.frombuffer(data, np.int64, depth + 1, 16).tolist()
        body = pa.decompress(memoryview(data)[24 + 8 * depth :], length, codec="zstd", asbytes=True)
        at = 0

        def take(count: int) -> np.ndarray:
            nonlocal at
            out, at = _unplaned(body, at, count)
            return out

        lengths = take(n)
        levels = [(np.cumsum(take(s)), take(s), take(s)) for s in sizes]
        ends = (at + np.cumsum(lengths)).tolist()
        vocabulary = [body[a:b] for a, b in zip([at, *ends], ends)]
        return cls(vocabulary, *map(list, zip(*levels, strict=True)))

    def weights_of(self, paths: Sequence[Sequence[bytes]]) -> np.ndarray:
        """Composition with many label paths at once: the weight of each, 0 where the transducer has no such path."""
        place = {label: i for i, label in enumerate(self.vocabulary)}
        n = len(self.vocabulary) + 1
        state = np.zeros(len(paths), np.int64)
        weight = np.zeros(len(paths), np.int64)
        for level in range(len(self.parents)):
            arcs = self.parents[level] * n + self.labels[level]
            wanted = np.array([place.get(p[level], n - 1) if level < len(p) else n - 1 for p in paths], np.int64)
            goes = (wanted < n - 1) & (state >= 0) if len(arcs) else np.zeros(len(paths), bool)
            key = state * n + wanted
            at = np.searchsorted(arcs, key) if len(arcs) else np.zeros(len(paths), np.int64)
            at = np.minimum(at, max(len(arcs) - 1, 0))
            found = goes & (arcs[at] == key) if len(arcs) else goes
            done = np.array([len(p) == level + 1 for p in paths], bool)
            weight[found & done] = self.weights[level][at[found & done]]
            state = np.where(found, at, -1)
        return weight


def _planes(values: np.ndarray) -> bytes:
    """Width in bytes, then the values' bytes plane by plane."""
    most = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w or w == 8)
    return bytes([width]) + values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()


def _unplaned(body: bytes, at: int, count: int) -> tuple[np.ndarray, int]:
    width = body[at]
    end = at + 1 + width * count
    planes = np.frombuffer(body, np.uint8, width * count, at + 1).reshape(width, count)
    return np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(np.int64), end


def _ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rank of each key among the distinct ones, the places of all keys in order, and where each distinct key begins there."""
    order = np.argsort(key)
    ordered = key[order]
    new = np.ones(len(key), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    rank = np.empty(len(key), np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank, order, np.flatnonzero(new)


def sorted_windows(label: np.ndarray, opens: np.ndarray, own: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct windows in order and their counts; labels from 1 on, 0 for words that no window holds.

    A window of two is ranked first, one of four as two of two, and one of five by its last word.
    """
    n = len(label)
    size = int(label.max(initial=0)) + 1
    after = np.zeros(n + SIZE, np.int64)
    after[: n - 1] = np.where(opens[1:], 0, label[1:])
    after[:n][label == 0] = 0
    column = [label, after[:n]]
    for k in range(2, SIZE):
        column.append(np.where(column[-1] > 0, after[k - 1 : n + k - 1], 0))
    at = np.flatnonzero(label)
    if not len(at):
        return [np.zeros(0, np.int64)] * SIZE, np.zeros(0, np.int64)
    two = np.zeros(n + 2, np.int64)
    rank, _, first = _ranked(label[at] * size + column[1][at])
    two[at] = rank + 1
    at = at[at < own]
    four, _, _ = _ranked(two[at] * (len(first) + 1) + np.where(column[2][at] > 0, two[at + 2], 0))
    _, order, first = _ranked(four * size + column[4][at])
    return [c[at[order[first]]] for c in column], np.diff(np.append(first, len(order)))


def _cuts(vocabulary: list[bytes], paths: Sequence[np.ndarray], bounds: Sequence[tuple[bytes, ...]]) -> np.ndarray:
    """Number of sorted paths below each bound."""
    out = []
    for bound in bounds:
        low, high = 0, len(paths[0])
        for level, label in enumerate(bound):
            place = bisect_left(vocabulary, label)
            column = paths[level][low:high]
            if place < len(vocabulary) and vocabulary[place] == label:
                low, high = low + int(np.searchsorted(column, place + 1)), low + int(np.searchsorted(column, place + 1, side="right"))
            else:  # no path goes on with this label
                low += int(np.searchsorted(column, place + 1))
                break
        out.append(low)
    return np.array(out, np.int64)


def union(parts: Sequence[Transducer], least: int, edges: Sequence[tuple[bytes, ...]] = ()) -> Transducer:
    """Sum of transducers: paths below ``least`` are left out, but for those that begin an edge of the range."""
    vocabulary = sorted(set().union(*(p.vocabulary for p in parts)))
    place = {label: i for i, label in enumerate(vocabulary)}
    n = len(vocabulary) + 1
    depth = max((len(p.parents) for p in parts), default=0)
    maps = [np.array([place[v] for v in p.vocabulary], np.int64) for p in parts]
    above = [np.zeros(1, np.int64) for _ in parts]
    on_edge = [0] * len(edges)
    parents, labels, weights = [], [], []
    for level in range(depth):
        keys, sums = [], []
        for part, spelled, states in zip(parts, maps, above, strict=True):
            parent = states[part.parents[level]]
            keys.append(np.where(parent < 0, -1, parent * n + spelled[part.labels[level]]))
            sums.append(part.weights[level])
        sizes = np.cumsum([0, *map(len, keys)])
        key, weight = np.concatenate(keys), np.concatenate(sums)
        live = np.flatnonzero(key >= 0)
        rank, order, first = _ranked(key[live])
        total = np.add.reduceat(weight[live][order], first) if len(first) else np.zeros(0, np.int64)
        distinct = key[live][order[first]]
        kept = total >= least
        for e, edge in enumerate(edges):
            state, on_edge[e] = on_edge[e], -1
            if state >= 0 and level < len(edge) and edge[level] in place:
                at = int(np.searchsorted(distinct, state * n + place[edge[level]]))
                if at < len(distinct) and distinct[at] == state * n + place[edge[level]]:
                    kept[at] = True
                    on_edge[e] = at
        number = np.where(kept, np.cumsum(kept) - 1, -1)
        on_edge = [int(number[s]) if s >= 0 else -1 for s in on_edge]
        merged = np.full(len(key), -1, np.int64)
        merged[live] = number[rank]
        above = [merged[a:b] for a, b in zip(sizes[:-1], sizes[1:], strict=True)]
        parents.append(distinct[kept] // n)
        labels.append(distinct[kept] % n)
        weights.append(total[kept])
    return Transducer(vocabulary, parents, labels, weights)


# --- Spark stages ----------------------------------------------------------------------------------


def _frequent_bits(words: DataFrame, least: int) -> np.ndarray:
    """A bit for each label that is frequent enough, in a table of 2 ** BIT_BITS bits (8 MB)."""
    bit = F.pmod(F.crc32("label"), F.lit(1 << BIT_BITS))
    spots = words.filter(F.col("f") >= least).select(bit.alias("bit"))
    maps = spots.groupBy((F.col("bit") / _BITMAP).cast("bigint").alias("part")).agg(
        F.bitmap_construct_agg((F.col("bit") % _BITMAP)).alias("bits")
    )
    out = np.zeros(1 << (BIT_BITS - 3), np.uint8)
    for part, bits in maps.toLocalIterator():
        out[part * (_BITMAP >> 3) : (part + 1) * (_BITMAP >> 3)] = np.frombuffer(bytes(bits), np.uint8)
    return out


def _is_set(bits: np.ndarray, labels: Sequence[bytes]) -> np.ndarray:
    spot = np.fromiter((zlib.crc32(x) for x in labels), np.int64, len(labels)) & ((1 << BIT_BITS) - 1)
    return (bits[spot >> 3] >> (spot & 7)) & 1 > 0


def _range_bounds(words: DataFrame, bits: np.ndarray, ranges: int) -> list[tuple[bytes, ...]]:
    """Windows that cut all windows into ranges of about equal size, from a sample of fixed size."""
    sample = words.filter(F.col("f") == 0).orderBy(F.xxhash64("label")).limit(SAMPLE).select("label").collect()
    paths = set()
    for (packed,) in sample:
        lang, *spelled = bytes(packed)[2:].split(_SEPARATOR)
        prefix = bytes.fromhex(lang.decode()) + _SEPARATOR
        path = []
        for word in spelled:
            if not _is_set(bits, [prefix + word])[0]:
                break
            path.append(prefix + word)
        if path:
            paths.add(tuple(path))
    ordered = sorted(paths)
    ranges = min(ranges, max(len(ordered) // 4, 1))
    return sorted({ordered[len(ordered) * k // ranges] for k in range(1, ranges)}) if ordered else []


def _shard_transducers(docs: DataFrame, bits: np.ndarray, bounds: list[tuple[bytes, ...]], slice_words: int) -> DataFrame:
    """(range, automaton): the windows of every slice of every task, by range."""
    schema = pa.schema([("range", pa.int32()), ("automaton", pa.binary())])
    session = docs.sparkSession
    sent = session.sparkContext.broadcast((bits, bounds))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, bounds = sent.value
        langs: dict[str, int] = {}
        for words, own in _slices(_read(batches, langs), slice_words):
            labels, place = _pairs(words, langs)
            frequent = np.flatnonzero(_is_set(bits, labels))
            order = sorted(frequent.tolist(), key=labels.__getitem__)
            number = np.zeros(len(labels), np.int64)
            number[order] = np.arange(1, len(order) + 1)
            vocabulary = [labels[i] for i in order]
            paths, counts = sorted_windows(number[place], words.opens, own)
            cuts = np.concatenate(([0], _cuts(vocabulary, paths, bounds), [len(counts)]))
            for k in np.flatnonzero(np.diff(cuts)).tolist():
                part = slice(cuts[k], cuts[k + 1])
                built = Transducer.from_sorted(vocabulary, [p[part] for p in paths], counts[part])
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([built.to_bytes()], pa.binary())], schema=schema)

    return map_batches(docs, task, "range int, automaton binary")


_COUNTED = pa.schema([("range", pa.int32()), ("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("f", pa.int64())])


def _phrase_rows(found: Transducer, bounds: list[tuple[bytes, ...]]) -> Iterator[pa.RecordBatch]:
    """A row for each path; its range is that of the path itself."""
    spelled = [_split_label(v) for v in found.vocabulary]
    above: list[tuple[bytes, ...]] = [()]
    for level in range(len(found.parents)):
        here = [(*above[p], found.vocabulary[x]) for p, x in zip(found.parents[level].tolist(), found.labels[level].tolist(), strict=True)]
        place = dict(zip(found.vocabulary, spelled, strict=True))
        langs = [place[path[0]][0] for path in here]
        phrases = [" ".join(place[x][1] for x in path) for path in here]
        ranges = [bisect_right(bounds, path) for path in here]
        if here:
            yield pa.RecordBatch.from_arrays(
                [pa.array(ranges, pa.int32()), pa.array(langs), pa.array(phrases), pa.array([level + 1] * len(here), pa.int32()), pa.array(found.weights[level])],
                schema=_COUNTED,
            )
        above = here


def _by_range(rows: DataFrame, ranges: int) -> DataFrame:
    return rows.repartitionById(ranges, F.col("range"))


def phrase_counts(
    docs: DataFrame, least: int = LEAST, slice_words: int = SLICE_WORDS
) -> tuple[DataFrame, DataFrame, list[tuple[bytes, ...]]]:
    """Counts of all phrases of up to five words of (text, lang) found ``least`` times or more.

    Returns (range, lang, phrase, size, f), the number of words by language (lang, n), and the bounds of the ranges.
    """
    words = stored(_word_counts(docs, slice_words), "words")
    named = F.regexp_extract(F.col("label").cast("string"), r"(?s)^(.*)\n[^\n]*$", 1)
    totals = stored(words.filter(F.col("f") > 0).groupBy(named.alias("lang")).agg(F.sum("f").alias("n")), "language_words")
    bits = _frequent_bits(words, least)
    in_all = words.filter(F.col("f") >= least).agg(F.coalesce(F.sum("f"), F.lit(0))).first()[0]
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-in_all // RANGE_WORDS))
    bounds = _range_bounds(words, bits, ranges)
    parts = _shard_transducers(docs, bits, bounds, slice_words)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: dict[int, list[bytes]] = defaultdict(list)
        for rows in batches:
            for k, data in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
                gathered[k].append(data)
        for k in sorted(gathered):
            edges = [bounds[i] for i in (k - 1, k) if 0 <= i < len(bounds)]
            yield from _phrase_rows(union([Transducer.from_bytes(d) for d in gathered.pop(k)], least, edges), bounds)

    partial = map_batches(_by_range(parts, len(bounds) + 1), task, "range int, lang string, phrase string, size int, f bigint")
    # A phrase that begins an edge of ranges is counted by part on both sides.
    whole = partial.groupBy("range", "lang", "phrase", "size").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    return stored(whole, "phrase_counts"), totals, bounds


def _labels(lang: str, phrase: str) -> tuple[bytes, ...]:
    prefix = lang.encode() + _SEPARATOR
    return tuple(prefix + word for word in phrase.encode().split(b" "))


def part_counts(counts: DataFrame, bounds: list[tuple[bytes, ...]]) -> DataFrame:
    """(range, lang, part, f): the counts of all parts that the candidates of each range need, found in the parts' ranges."""
    schema = pa.schema([("range", pa.int32()), ("asker", pa.int32()), ("lang", pa.string()), ("phrase", pa.string()), ("f", pa.int64())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted: set[tuple[int, str, str]] = set()
        for rows in batches:
            for k, lang, phrase in zip(*(rows.column(c).to_pylist() for c in ("range", "lang", "phrase")), strict=True):
                spelled = phrase.split(" ")
                for cut in range(1, len(spelled)):
                    wanted |= {(k, lang, " ".join(spelled[:cut])), (k, lang, " ".join(spelled[cut:]))}
        if wanted:
            asker, lang, part = zip(*sorted(wanted), strict=True)
            ranges = [bisect_right(bounds, _labels(a, p)) for a, p in zip(lang, part, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(ranges, pa.int32()), pa.array(asker, pa.int32()), pa.array(lang), pa.array(part), pa.nulls(len(part), pa.int64())], schema=schema)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[bytes, ...], int] = {}
        asked: list[tuple[int, str, str]] = []
        for rows in batches:
            for asker, lang, phrase, f in zip(*(rows.column(c).to_pylist() for c in ("asker", "lang", "phrase", "f")), strict=True):
                if f is None:
                    asked.append((asker, lang, phrase))
                else:
                    known[_labels(lang, phrase)] = f
        if asked:
            weight = _transducer_of(known).weights_of([_labels(a, p) for _, a, p in asked])
            asker, lang, part = zip(*asked, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(asker, pa.int32()), pa.array(asker, pa.int32()), pa.array(lang), pa.array(part), pa.array(weight)], schema=schema)

    kinds = "range int, asker int, lang string, phrase string, f bigint"
    n = len(bounds) + 1
    asked = map_batches(_by_range(counts.filter(F.col("size") > 1).select("range", "lang", "phrase"), n), ask, kinds)
    told = counts.select("range", F.lit(None).cast("int").alias("asker"), "lang", "phrase", "f")
    found = map_batches(_by_range(asked.unionByName(told), n), answer, kinds)
    return found.select("range", "lang", F.col("phrase").alias("part"), "f")


def _transducer_of(known: dict[tuple[bytes, ...], int]) -> Transducer:
    """Paths of one range with their weights. Beginnings that lie in another range become states of weight 0."""
    every = sorted({path[:k] for path in known for k in range(1, len(path) + 1)})
    vocabulary = sorted({label for path in every for label in path[-1:]})
    place = {label: i for i, label in enumerate(vocabulary)}
    levels: list[list[tuple[bytes, ...]]] = [[p for p in every if len(p) == k] for k in range(1, max(map(len, every), default=0) + 1)]
    parents, above = [], {(): 0}
    for level in levels:
        parents.append(np.array([above[p[:-1]] for p in level], np.int64))
        above = {p: i for i, p in enumerate(level)}
    labels = [np.array([place[p[-1]] for p in level], np.int64) for level in levels]
    weights = [np.array([known.get(p, 0) for p in level], np.int64) for level in levels]
    return Transducer(vocabulary, parents, labels, weights)


def score_phrases(counts: DataFrame, totals: DataFrame, bounds: list[tuple[bytes, ...]]) -> DataFrame:
    """(lang, phrase, a, l, r, n, score, inner): candidates by their weakest cut, with the parts of equal count."""
    schema = "lang string, phrase string, a bigint, l bigint, r bigint, n bigint, score bigint, inner array<string>"
    out = pa.schema([("lang", pa.string()), ("phrase", pa.string()), *[(x, pa.int64()) for x in ("a", "l", "r", "n", "score")], ("inner", pa.list_(pa.string()))])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple[str, str], int] = {}
        candidates = []
        for rows in batches:
            for lang, phrase, f, n in zip(*(rows.column(c).to_pylist() for c in ("lang", "phrase", "f", "n")), strict=True):
                if n is None:
                    known[lang, phrase] = f
                else:
                    candidates.append((lang, phrase, f, n))
        rows = []
        for lang, phrase, a, n in candidates:
            spelled = phrase.split(" ")
            cuts = []
            for k in range(1, len(spelled)):
                left, right = known[lang, " ".join(spelled[:k])], known[lang, " ".join(spelled[k:])]
                cuts.append((1000 * a * n // (left * right), k, left, right))
            worth, _, left, right = min(cuts)
            inner = [part for part in (" ".join(spelled[:-1]), " ".join(spelled[1:])) if len(spelled) > 2 and known[lang, part] == a]
            rows.append((lang, phrase, a, left, right, n, worth, inner))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    wanted = counts.filter(F.col("size") > 1).join(totals, "lang").select("range", "lang", "phrase", "f", "n")
    parts = part_counts(counts, bounds).select("range", "lang", F.col("part").alias("phrase"), "f", F.lit(None).cast("bigint").alias("n"))
    return map_batches(_by_range(wanted.unionByName(parts), len(bounds) + 1), score, schema)


def collocations(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = LEAST,
    top: int = TOP,
    slice_words: int = SLICE_WORDS,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases of 2 to 5 words by score.

    Texts are lower-cased in A-Z, cut into pieces at ``.,;:!?`` and line ends, and those into words at spaces and tabs.
    A null text is empty; a null language is ``und``. Phrases found ``least`` times or more are candidates; a candidate
    that lies inside a longer one of equal count is dropped. Ties in score and count go to the smaller phrase in byte
    order, so ranks are unique. Repeated rows count each. A table without such phrases, or an empty one, has no rows.
    Other columns are not read.
    """
    docs = columns(df, text=text_col, lang=lang_col)
    docs = docs.select("text", F.col("lang").cast("string").alias("lang"))
    scored = stored(score_phrases(*phrase_counts(docs, least, slice_words)), "scored_phrases")
    inside = scored.select("lang", F.explode("inner").alias("phrase"))
    left = scored.join(inside, ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
