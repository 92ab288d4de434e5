"""Quality rules as a short-circuit cascade.

Base figures of all texts are computed together, vectorised over the bytes of a batch. The rules behind them are
conditions a text must meet; they are independent, so their order changes the cost and not the verdict. Each rule is
timed and its rejections counted on a sample (the first rows of every partition), and the rules then run in order of
rejections per second: a text leaves the cascade at its first failed rule.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendspark.llm.arrow import batch, columns, map_batches
from trendspark.llm.words import LEADING_BYTES, WORD_BYTES, Texts, byte_set, row_hash, span_prints, texts, window_prints

SYMBOLS = b"#*$%&|<>"
_SYMBOL_BYTES = byte_set(SYMBOLS)
_ASCII_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
_LETTER_BYTES = _ASCII_LETTERS + bytes(range(0x80, 0x100))
_UPPER = bytes(range(65, 91))
WINDOW = 5
# Rows of each partition on which the rules' cost and selectivity are estimated.
SAMPLE_ROWS = 64


@dataclass(frozen=True)
class Base:
    """Base figures of one text."""

    n_words: int
    word_chars: int
    n_symbols: int
    n_dup_lines: int
    n_repeat_words: int
    n_lines: int

    @property
    def failed(self) -> bool:
        return self.n_words < 10 or 100 * self.n_repeat_words > 20 * self.n_words


@dataclass(frozen=True)
class Rule:
    """``rejects(text, base)`` is true for texts to leave out."""

    name: str
    rejects: Callable[[bytes, Base], bool]


def _letters_short(text: bytes, base: Base) -> bool:
    # In bytes: letters of any script count, digits, marks and symbols do not.
    letters = len(text) - len(text.translate(None, _LETTER_BYTES))
    inside = len(text) - sum(map(text.count, (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")))
    return 10 * letters < 4 * inside


def _shouting(text: bytes, base: Base) -> bool:
    upper = len(text) - len(text.translate(None, _UPPER))
    letters = len(text) - len(text.translate(None, _ASCII_LETTERS))
    return 2 * upper > letters and letters >= 20


def _one_word(text: bytes, base: Base) -> bool:
    words = text.lower().split()
    seen: dict[bytes, int] = {}
    for word in words:
        seen[word] = seen.get(word, 0) + 1
    return 10 * max(seen.values()) > 3 * len(words)


def _ellipsis_lines(text: bytes, base: Base) -> bool:
    return 10 * (text.count(b"...\n") + text.count("\u2026\n".encode())) > 3 * base.n_lines


RULES: tuple[Rule, ...] = (
    Rule("symbols", lambda text, base: 10 * base.n_symbols > base.n_words),
    Rule("repeated lines", lambda text, base: 2 * base.n_dup_lines > base.n_lines),
    Rule("word length", lambda text, base: not 2 * base.n_words <= base.word_chars <= 20 * base.n_words),
    Rule("exclamations", lambda text, base: 10 * text.count(b"!") > 3 * base.n_words),
    Rule("letters", _letters_short),
    Rule("shouting", _shouting),
    Rule("one word", _one_word),
    Rule("ellipses", _ellipsis_lines),
)


def base_figures(some: Texts) -> list[Base]:
    """Base figures of each row. Words are runs of bytes other than the space and the control characters 9 to 13."""
    n = len(some)
    inside = WORD_BYTES[some.data]
    starts, ends = some.spans(inside)
    rows = some.rows_of(starts)
    n_words = np.bincount(rows, minlength=n)
    word_chars = some.per_row(inside & LEADING_BYTES[some.data])
    n_symbols = some.per_row(_SYMBOL_BYTES[some.data])

    # Lines that hold a word: all runs of bytes other than the line feed, then those that a word starts in.
    line_starts, line_ends = some.spans(some.data != 10)
    with_word = np.zeros(len(line_starts), bool)
    with_word[np.searchsorted(line_starts, starts, side="right") - 1] = True
    line_starts, line_ends = line_starts[with_word], line_ends[with_word]
    line_rows = some.rows_of(line_starts)
    lines = row_hash(line_rows, span_prints(some.data, line_starts, line_ends))
    order = np.argsort(lines, kind="stable")
    again = order[1:][lines[order][1:] == lines[order][:-1]]
    n_dup = np.bincount(line_rows[again], minlength=n)
    n_lines = np.bincount(line_rows, minlength=n)

    windows, at = window_prints(span_prints(some.data, starts, ends), rows, WINDOW)
    keys = row_hash(rows[at], windows)
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    equal = ordered[1:] == ordered[:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    change = np.zeros(len(starts) + 1, np.int64)
    np.add.at(change, at[twice], 1)
    np.add.at(change, at[twice] + WINDOW, -1)
    covered = np.cumsum(change[:-1]) > 0
    n_repeat = np.bincount(rows[covered], minlength=n)
    figures = (n_words, word_chars, n_symbols, n_dup, n_repeat, n_lines)
    return [Base(*row) for row in zip(*(f.tolist() for f in figures), strict=True)]


def _measure(rules: Sequence[Rule]):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, rejected, seconds = SAMPLE_ROWS, [0] * len(rules), [0.0] * len(rules)
        for rows in batches:
            column = rows.column(0).slice(0, left)
            for some in texts(column):
                for i, base in enumerate(base_figures(some)):
                    text = bytes(some.data[some.offsets[i] : some.offsets[i + 1]])
                    if base.failed:
                        continue
                    for k, rule in enumerate(rules):
                        began = time.perf_counter()
                        rejected[k] += rule.rejects(text, base)
                        seconds[k] += time.perf_counter() - began
            left -= len(column)
            if left <= 0:
                break
        schema = pa.schema([("rule", pa.int32()), ("rejected", pa.int64()), ("seconds", pa.float64())])
        yield batch(schema, list(range(len(rules))), rejected, seconds)

    return task


def rule_order(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> list[int]:
    """Numbers of the rules by rejections per second on the sample, most first; one row per rule reaches the driver."""
    measured = map_batches(columns(df, text=text), _measure(rules), "rule int, rejected bigint, seconds double")
    found = measured.groupBy("rule").agg(F.sum("rejected").alias("rejected"), F.sum("seconds").alias("seconds")).collect()
    rate = {r["rule"]: (r["rejected"] + 0.5) / (r["seconds"] + 1e-6) for r in found}
    return sorted(range(len(rules)), key=lambda k: -rate.get(k, 0.0))


def _verdicts(column: pa.Array, rules: Sequence[Rule]) -> Iterator[tuple[Base, bool]]:
    for some in texts(column):
        raw = some.data.tobytes()
        at = some.offsets.tolist()
        for i, base in enumerate(base_figures(some)):
            kept = not base.failed
            if kept:
                body = raw[at[i] : at[i + 1]]
                kept = not any(rule.rejects(body, base) for rule in rules)
            yield base, kept


_FIGURES = "id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean"


def quality_figures(df: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Base figures and the cascade's verdict of each row.

    Words are runs of characters other than the space and the control characters 9 to 13, taken from the whole text; a
    null or empty text has none and fails the base rule. Lines compare as they are, ended by line feeds. Null and
    repeated ids give a row each; other columns are ignored.
    """
    ordered = [rules[k] for k in rule_order(df, rules, text)]
    schema = pa.schema([("id", pa.int64()), *[(c, pa.int64()) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], ("base_failed", pa.bool_()), ("kept", pa.bool_())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            out = [
                (b.n_words, b.word_chars, b.n_symbols, b.n_dup_lines, b.n_repeat_words, b.failed, kept)
                for b, kept in _verdicts(rows.column(1), ordered)
            ]
            yield batch(schema, rows.column(0), *(zip(*out, strict=True) if out else [[]] * 7))

    source = columns(df, id=id_col, text=text).withColumn("id", F.col("id").cast("bigint"))
    return map_batches(source, task, _FIGURES).withColumnRenamed("id", id_col)


def keep_quality(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``df`` that meet the base rule and all others, with all their columns."""
    ordered = [rules[k] for k in rule_order(df, rules, text)]
    place = df.columns.index(text)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            kept = [kept for _, kept in _verdicts(rows.column(place), ordered)]
            yield rows.filter(pa.array(kept, pa.bool_()))

    return map_batches(df, task, df.schema)
