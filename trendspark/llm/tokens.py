"""Token ids of a public vocabulary, through per-worker caches of pre-tokens.

Texts are cut before white space. No pre-token of the vocabularies used here crosses such a cut and no special string
holds white space, so the ids of a text are the ids of its parts, one after another. Parts repeat: the parts of a
batch are made distinct by Arrow, and a worker asks the library once for most of them. The cache is bounded and only
saves time.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable, Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from trendspark.llm.arrow import raw_text, steps

# Unicode's White_Space, as the vocabularies' own patterns take it; Python's \s has four control characters more.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_PARTS = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
# White space before a space or a line feed: such texts are cut by _PARTS, all others at each of the two.
_SPACED = "[\\t-\\r \\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}][ \\n]"
# Letters (all of these code points are in Unicode's L), then punctuation of ASCII only.
_PLAIN = re.compile("([A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ʯ]+)([!-/:-@\\[-`{-~]*)")
_LOWERED = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-/:-@\\[-`{-~]*)")
CACHE_PARTS = 120_000
SEEN_SLOTS = 1 << 21
CUT_BYTES = 4 << 20

_LOADED: dict[tuple, object] = {}
_ID = attrgetter("id")


def vocabulary_path(name: str) -> str:
    """Place of a public vocabulary file on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The printable stand-ins of the 256 bytes in byte-level vocabularies: own sign where printable, else from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


_LETTERS = _byte_letters()


def _mapped(pretoken: str) -> str:
    return pretoken.encode().decode("latin-1").translate(_LETTERS)


class Bounded(dict):
    """A cache of two generations for keys that come back.

    A key enters when it is missed for the second time, as a table of bits by its hash remembers; most parts of a
    corpus come only once. When the young generation is full the old one is forgotten; used entries move back.
    """

    def __init__(self, compute: Callable, limit: int | None = None):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit or CACHE_PARTS, {}
        self.seen = bytearray(SEEN_SLOTS)

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
            slot = hash(key) % SEEN_SLOTS
            if not self.seen[slot]:
                self.seen[slot] = 1
                return value
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
            self.seen = bytearray(SEEN_SLOTS)
        self[key] = value
        return value


def parts(text: str) -> list[str]:
    """``text`` cut before each run of white space."""
    return _PARTS.findall(text)


def distinct_parts(column: pa.Array) -> tuple[list[str], list[str], list[str], np.ndarray, np.ndarray]:
    """Parts of a text column without nulls: distinct followers, first parts and uncut texts, then codes and offsets.

    Row i is the concatenation of the parts numbered ``codes[offsets[i]:offsets[i + 1]]`` over the three lists in
    turn. A follower stood after a space, or after nothing if it begins with a line feed.
    """
    odd = pc.match_substring_regex(column, _SPACED)
    has_odd = pc.any(odd).as_py()
    plain = pc.if_else(odd, "", column) if has_odd else column
    lists = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.flatten()
    offsets = offsets - offsets[0]
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    firsts = flat.take(pa.array(offsets[:-1])).dictionary_encode()
    n, m = len(coded.dictionary), len(firsts.dictionary)
    codes[offsets[:-1]] = n + firsts.indices.to_numpy(zero_copy_only=False)
    uncut: list[str] = []
    if has_odd:
        rows = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        uncut = column.take(pa.array(rows)).to_pylist()
        codes[offsets[rows]] = n + m + np.arange(len(rows))
    return coded.dictionary.to_pylist(), firsts.dictionary.to_pylist(), uncut, codes, offsets


def cuts(column: pa.Array) -> Iterator[pa.Array]:
    """A text column in slices of bounded size, nulls as empty texts."""
    column = column.fill_null("") if column.null_count else column
    for first, last in steps(raw_text(column)[1], CUT_BYTES):
        yield column.slice(first, last - first)


class IdEncoder:
    """Unsigned 32-bit ids of texts, by the ``tokenizers`` library and a byte-level vocabulary."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        if hasattr(self.model, "_resize_cache"):  # the caches here replace the library's own
            self.model._resize_cache(0)
        self.heads = Bounded(lambda part: self._part("", part))
        self.tails = Bounded(lambda part: self._part("", part) if part[:1] == "\n" else self._part(" ", part))
        self.marks = Bounded(self._piece)
        self.line_feed = self._whole("\n")

    def _piece(self, pretoken: str) -> bytes:
        return array("I", map(_ID, self.model.tokenize(_mapped(pretoken)))).tobytes()

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _part(self, before: str, part: str) -> bytes:
        if part.isascii() and part.isalpha():
            return array("I", map(_ID, self.model.tokenize("Ġ" + part if before else part))).tobytes()
        feed = part[:1] == "\n" and not before
        plain = _PLAIN.fullmatch(part, 1 if feed else 0)
        if plain is None:
            return self._whole(before + part)
        word, marks = plain.groups()
        if feed:
            ids = self.line_feed + self.heads[word]
        elif marks:
            ids = self.tails[word] if before else self.heads[word]
        else:
            return self._piece(before + word)
        return ids + self.marks[marks] if marks else ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self._spaced, parts(text)))

    def _spaced(self, part: str) -> bytes:
        return self.tails[part[1:]] if part[:1] == " " and part[1:2] != "\n" else self.heads[part]

    def column(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows of a text column, one after another, and the offsets of the rows."""
        followers, firsts, uncut, codes, offsets = distinct_parts(column)
        ids = [*map(self.tails.__getitem__, followers), *map(self.heads.__getitem__, firsts), *map(self.encode, uncut)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        table = np.frombuffer(b"".join(ids), "<u4")
        at = np.cumsum(sizes) - sizes
        taken = sizes[codes]
        ends = np.cumsum(taken)
        where = np.repeat(at[codes] - (ends - taken), taken) + np.arange(ends[-1] if len(ends) else 0)
        bounds = np.concatenate(([0], ends))[offsets]
        return table[where], bounds


def id_encoder(path: str) -> IdEncoder:
    """One encoder per worker process and vocabulary."""
    key = ("ids", path)
    if key not in _LOADED:
        _LOADED[key] = IdEncoder(path)
    return _LOADED[key]


class PartCounter:
    """Token counts of parts, by a ``tokenizers`` vocabulary for which white space only separates words."""

    def __init__(self, tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        if hasattr(self.model, "_resize_cache"):
            self.model._resize_cache(0)
        self.cache = Bounded(self._count)

    def _count(self, part: str) -> int:
        if part[:1] == "\n":
            return self.cache[part[1:]]
        plain = _LOWERED.fullmatch(part)
        if plain is None:
            return len(self.tokenizer.encode(part, add_special_tokens=False).ids)
        word, marks = plain.groups()
        if marks:
            return self.cache[word] + self.cache[marks]
        return len(self.model.tokenize(_mapped(word.lower())))

    def column(self, column: pa.Array, frequent: dict[str, int]) -> np.ndarray:
        """Tokens of each row: the frequent parts by their table, the others through the cache."""
        followers, firsts, uncut, codes, offsets = distinct_parts(column)
        cache = self.cache
        counts = [frequent.get(part) for part in followers]
        counts = [cache[part] if n is None else n for part, n in zip(followers, counts, strict=True)]
        counts += [cache[part] for part in firsts]
        counts += [sum(map(cache.__getitem__, parts(text))) for text in uncut]
        total = np.concatenate(([0], np.cumsum(np.array(counts, np.int64)[codes])))
        return total[offsets[1:]] - total[offsets[:-1]]


class IdCounter:
    """Token counts by a byte-level vocabulary that keeps white space."""

    def __init__(self, path: str):
        self.encoder = IdEncoder(path)

    def column(self, column: pa.Array, frequent: dict[str, int]) -> np.ndarray:
        return np.diff(self.encoder.column(column)[1])


class PieceCounter:
    """Token counts by a ``sentencepiece`` model, text by text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)

    def column(self, column: pa.Array, frequent: dict[str, int]) -> np.ndarray:
        return np.array([len(self.model.encode(t, num_threads=1)) for t in column.to_pylist()], np.int64)


def token_counter(path: str) -> PartCounter | IdCounter | PieceCounter:
    """One counter per worker process and vocabulary."""
    key = ("counts", path)
    if key not in _LOADED:
        if path.endswith(".model"):
            _LOADED[key] = PieceCounter(path)
        else:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            ids = [tokenizer.encode(t, add_special_tokens=False).ids for t in ("a b", "a \n  b ")]
            _LOADED[key] = PartCounter(tokenizer) if ids[0] == ids[1] else IdCounter(path)
    return _LOADED[key]
