"""Whitening, line dedup and phrase collocations against plain computation, and their defined odd cases."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from trendspark.llm import line_dedup, phrases, whitening

SF = "/root/testdata/sf0.001"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- whitening ------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "values",
    [
        [2.0],
        [3.0, 3.0, 3.0],
        [0.0, 0.0],
        list(np.exp(-np.arange(40) / 3.0)),
        [1.0] * 10 + [0.0] * 10,
        [1e6, *np.linspace(1, 1 + 1e-9, 15)],
        list(np.random.default_rng(1).uniform(0, 1, 64)),
        [1e-12, 1.0, 1e12],
    ],
)
def test_spectral_split_diagonalises(values):
    rng = np.random.default_rng(3)
    q, _ = np.linalg.qr(rng.normal(size=(len(values), len(values))))
    a = (q * values) @ q.T
    found, axes = whitening.spectral_split(a)
    scale = max(np.abs(values)) or 1
    assert np.abs(found - np.sort(values)[::-1]).max() <= 1e-12 * scale
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() <= 1e-13
    assert np.abs(a @ axes - axes * found).max() <= 1e-12 * scale


def test_polar_factor_is_orthogonal_and_keeps_signs():
    rng = np.random.default_rng(4)
    q, _ = np.linalg.qr(rng.normal(size=(20, 20)))
    values = np.r_[np.geomspace(1e-6, 1, 10), -np.geomspace(1e-5, 2, 10)]
    u = whitening.polar_factor((q * values) @ q.T)
    assert np.abs(u @ u - np.eye(20)).max() < 1e-12
    assert np.abs(u - (q * np.sign(values)) @ q.T).max() < 1e-8


def check_whitened(rows, vectors):
    """Rows of the query against a plain eigenvalue routine; ``vectors`` by id."""
    x = np.array([[math.floor(1024 * float(c)) + 100_000 for c in v] for v in vectors.values()], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    y = (x - np.array([s / n for s in sums])).astype(float)
    v = y.T @ y / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    place = {k: i for i, k in enumerate(vectors)}
    k = min(8, int((values > 1e-12 * values[0]).sum()))
    assert sorted((r["vec_id"], r["component"]) for r in rows) == sorted((i, c) for i in vectors for c in range(1, k + 1))
    got = np.zeros((n, k))
    for r in rows:
        i, c = place[r["vec_id"]], r["component"] - 1
        got[i, c] = r["whitened"]
        assert r["n"] == n and r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x[i], sums, strict=True))
        assert abs(r["explained"] - values[c] / np.trace(v)) <= 1e-10
        assert 0 <= r["identity_error"] <= 1e-10
    want = (y @ axes[:, :k]) / np.sqrt(values[:k])
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * signs).max() <= 1e-8


def test_whitening_query_against_a_plain_routine(spark):
    rows = contract.queries()["op11_whitening"](spark, SF).collect()
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check_whitened(rows, {r["vec_id"]: r["embedding"] for r in table})


def test_whitening_of_odd_rows(spark):
    rng = np.random.default_rng(7)
    good = {i: [float(c) for c in rng.normal(size=3)] for i in range(9)}
    good[9] = good[0]
    bad = [(20, None), (21, [1.0, None, 2.0]), (22, [1.0, float("nan"), 2.0]), (23, [float("inf"), 0.0, 0.0]), (24, []), (25, [1.0, 2.0])]
    df = spark.createDataFrame([*good.items(), *bad], "vec_id bigint, embedding array<float>")
    df = df.withColumns({name: F.lit("clash") for name in ("id", "v", "x", "w", "place", "value", "whitened", "n")}).repartition(4)
    good32 = {i: np.array(v, np.float32).astype(float).tolist() for i, v in good.items()}
    check_whitened(whitening.whitened_embeddings(df).collect(), good32)


def test_whitening_without_variance_or_rows(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id bigint, embedding array<double>")
    assert whitening.whitened_embeddings(one).collect() == []
    assert whitening.whitened_embeddings(one.limit(0)).collect() == []
    # Of three dimensions two move together: two components.
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, float(i * i % 7)]) for i in range(12)] + [(None, [0.0, 0.0, 0.0])] * 2, "vec_id bigint, embedding array<double>")
    rows = whitening.whitened_embeddings(flat).collect()
    assert {r["component"] for r in rows} == {1, 2} and sum(r["vec_id"] is None for r in rows) == 4


def test_deviations_past_64_bits():
    x = np.array([[1 << 40], [0]], np.int64)
    sums = (int(x.sum()),)
    assert whitening._deviations(x, 2, sums) == [None, None]
    assert whitening._deviations(np.array([[1 << 20], [0]], np.int64), 2, (1 << 20,)) == [1 << 40, 1 << 40]


# --- lines ----------------------------------------------------------------------------------


def plain_lines(rows):
    """(doc_id, n_lines, n_dropped, kept) of each row; a null id comes last."""
    late = (1, 0)
    order = lambda i: late if i is None else (0, i)
    first = {}
    keyed = []
    for i, text in rows:
        lines = (text or "").split("\n")
        keys = [line.strip(" \t\n\x0b\x0c\r").translate(UPPER) for line in lines]
        keyed.append((i, lines, keys))
        for key in keys:
            if len(key) >= 10:
                first[key] = min(first.get(key, order(i)), order(i))
    out = []
    for i, lines, keys in keyed:
        kept = [line for line, key in zip(lines, keys, strict=True) if len(key) < 10 or first[key] == order(i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def line_rows():
    random.seed(11)
    common = [f"line number {k} of the common ones" for k in range(30)]
    rows = []
    for i in range(120):
        lines = [random.choice(common) if random.random() < 0.5 else f"own line {i} {random.random()}" for _ in range(random.randint(1, 12))]
        lines += random.choice([[], ["short"], ["  Line NUMBER 3 of the common ones\t"], ["", ""], ["éÉ line with accents"], ["ÉÉ line with accents"]])
        random.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    rows += [(200, None), (201, ""), (202, "\n"), (203, "exactly 10\r\nexactly 1\n EXACTLY 10 "), (204, "exactly 10\nexactly 1")]
    rows += [(205, "twice in one row\ntwice in one row"), (7, "another text of seven\nline number 5 of the common ones"), (9, None)]
    rows += [rows[3], rows[3], (None, "line number 5 of the common ones\nonly without an id"), (None, "only without an id\nonly without an id")]
    rows += [(300 + k, "a line that a third of all rows hold\nx") for k in range(60)]
    rows += [(400, "\n".join(f"long text line {k % 4000}" for k in range(30_000))), (401, "\n".join(f"long text line {k}" for k in range(0, 8000, 2)))]
    return rows


@pytest.mark.parametrize(("batches", "fanout"), [(1, 2), (4, 3), (5, 2)])
def test_lines_against_a_plain_pass(spark, batches, fanout):
    rows = line_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    df = df.withColumns({name: F.lit("clash") for name in ("id", "t", "h1", "h2", "key", "place", "places", "owner", "batch", "line", "of", "u")})
    got = line_dedup.dedup_lines(df, batches=batches, fanout=fanout).collect()
    assert Counter(tuple(r) for r in got) == Counter(plain_lines(rows))


def test_lines_of_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert line_dedup.dedup_lines(df).collect() == []
    some = spark.createDataFrame([("b", "the same long line"), ("a", "the same long line")], "doc_id string, text string")
    assert {tuple(r) for r in line_dedup.dedup_lines(some).collect()} == {("a", 1, 0, "the same long line"), ("b", 1, 1, "")}


def test_runs_are_compacted_by_level_and_joined_in_place(spark):
    runs = line_dedup.LineRuns(spark, fanout=2, buckets=4)
    keys = lambda *ks: spark.createDataFrame([(k, k, i) for k, i in ks], "h1 bigint, h2 bigint, id bigint")
    runs.add(keys((1, 10), (2, 10), (1, 11)))
    assert [len(level) for level in runs.levels] == [1]
    runs.add(keys((2, 20), (3, 21), (3, 20)))
    assert [len(level) for level in runs.levels] == [0, 1]
    runs.add(keys((4, 30), (1, 30)))
    assert [len(level) for level in runs.levels] == [1, 1]
    assert {(r["h1"], r["owner"]) for r in runs.owners().collect()} == {(1, 10), (2, 10), (3, 20), (4, 30)}
    # A run's side of the anti-join is read in its buckets' order: neither moved nor sorted.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fresh = keys((4, 1), (9, 1)).groupBy("h1", "h2").agg(F.min("id"))
        joined = fresh.join(spark.table(runs.names[0]).select("h1", "h2"), ["h1", "h2"], "left_anti")
        plan = joined._jdf.queryExecution().sparkPlan().toString()
        assert "Bucketed: true" in plan
        assert joined.count() == 1
        executed = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in executed or "ShuffledHashJoin" in executed
    runs.close()
    assert not runs.levels


def test_line_plans_run_no_python(spark):
    df = spark.createDataFrame(line_rows()[:20], "doc_id bigint, text string")
    plan = line_dedup.dedup_lines(df)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- phrases --------------------------------------------------------------------------------


def plain_phrases(rows, least, top):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(UPPER)):
            words = [w for w in re.split("[ \t]", piece) if w]
            totals[lang] += len(words)
            for size in range(1, 6):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    found = {}
    for (lang, phrase), a in counts.items():
        if len(phrase) > 1 and a >= least:
            cuts = []
            for k in range(1, len(phrase)):
                left, right = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
                cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
            found[lang, phrase] = (a, *min(cuts))
    inside = Counter()
    for (lang, phrase), (a, *_) in found.items():
        for size in range(2, len(phrase)):
            for i in range(len(phrase) - size + 1):
                part = (lang, phrase[i : i + size])
                inside[part] = max(inside[part], a)
    out = []
    for lang in totals:
        mine = [(-score, -a, " ".join(p).encode(), left, right) for (at, p), (a, score, _, left, right) in found.items() if at == lang and 100 * inside[at, p] < 100 * a]
        for rank, (score, a, phrase, left, right) in enumerate(sorted(mine)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return out


def phrase_rows():
    random.seed(13)
    words = [f"w{k}" for k in range(60)]
    fixed = ["new york city hall", "of the", "Of The", "x x x x x x x", "naïve été ÉTÉ 中文"]
    rows = []
    for _ in range(400):
        text = []
        for _ in range(random.randint(0, 30)):
            text.append(random.choice(fixed) if random.random() < 0.3 else words[min(int(random.expovariate(0.15)), 59)])
            text.append(random.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r\n", ";", "\x00 "]))
        rows.append(("".join(text), random.choice(["en", "en", "en", "de", None, "und", "", "a\nb"])))
    rows += [(None, "en"), ("", None), (" \t .. ", "en"), (" ".join(words[i % 7] for i in range(40_000)), "de")]
    rows += [("of the " * 50, "en")] * 20
    return rows


@pytest.mark.parametrize(("least", "slice_words"), [(3, 997), (30, 5), (100, 2_000_000)])
def test_phrases_against_plain_counts(spark, least, slice_words):
    rows = phrase_rows()
    if slice_words == 5:
        rows = rows[:120]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    df = df.withColumns({name: F.lit("clash") for name in ("label", "f", "range", "n", "phrase", "size", "rank", "score", "inner")})
    got = phrases.collocations(df, least=least, top=50, slice_words=slice_words).collect()
    assert sorted(tuple(r) for r in got) == sorted(plain_phrases(rows, least, 50))


def test_no_phrases(spark):
    df = spark.createDataFrame([("some words only", "en"), (None, None)], "text string, lang string")
    assert phrases.collocations(df).collect() == []
    assert phrases.collocations(df.limit(0)).collect() == []


def path_counts(transducer):
    """All paths of a transducer with their weights."""
    out, above = {}, [()]
    for parents, labels, weights in zip(transducer.parents, transducer.labels, transducer.weights, strict=True):
        here = [(*above[p], transducer.vocabulary[x]) for p, x in zip(parents.tolist(), labels.tolist(), strict=True)]
        assert here == sorted(here)
        out |= dict(zip(here, weights.tolist(), strict=True))
        above = here
    return out


def windows_of(words):
    return [tuple(words[i : i + 5]) for i in range(len(words))]


def built(words, vocabulary):
    label = np.array([vocabulary.index(w) + 1 for w in words], np.int64)
    opens = np.zeros(len(words), bool)
    opens[:1] = True
    paths, counts = phrases.sorted_windows(label, opens, len(words))
    return phrases.Transducer.from_sorted(vocabulary, paths, counts)


def test_transducers_keep_union_and_compose_counts():
    random.seed(17)
    vocabulary = [b"a", b"b", b"c", b"dd"]
    some, more = ([random.choice(vocabulary) for _ in range(n)] for n in (500, 300))
    wanted = Counter()
    for words in (some, more):
        for window in windows_of(words):
            wanted.update(window[:k] for k in range(1, len(window) + 1))
    first, second = built(some, vocabulary), phrases.Transducer.from_bytes(built(more, vocabulary).to_bytes())
    both = phrases.union([first, second], 1)
    assert path_counts(both) == wanted
    assert path_counts(phrases.Transducer.from_bytes(both.to_bytes())) == wanted
    # Rare paths go, unless they begin an edge of the range.
    edge = min(wanted, key=lambda p: (wanted[p], -len(p), p))
    pruned = path_counts(phrases.union([first, second], 20, [edge]))
    assert pruned == {p: f for p, f in wanted.items() if f >= 20 or p == edge[: len(p)]}
    asked = [(b"a",), (b"a", b"b"), (b"a", b"zz"), (b"dd", b"dd", b"a"), (b"c",) * 5, (b"c",) * 6]
    assert both.weights_of(asked).tolist() == [wanted[p] for p in asked]


def test_cuts_agree_with_comparison():
    random.seed(19)
    vocabulary = [b"a", b"b", b"d"]
    words = [random.choice(vocabulary) for _ in range(200)]
    label = np.array([vocabulary.index(w) + 1 for w in words], np.int64)
    paths, _ = phrases.sorted_windows(label, np.arange(200) % 9 == 0, 200)
    plain = [tuple(vocabulary[c[i] - 1] for c in paths if c[i]) for i in range(len(paths[0]))]
    bounds = [(b"a",), (b"a", b"b", b"c"), (b"b", b"0"), (b"c", b"a"), (b"d", b"d", b"d", b"d", b"d"), (b"z",)]
    assert phrases._cuts(vocabulary, paths, bounds).tolist() == [sum(p < b for p in plain) for b in bounds]


def test_digests_of_line_query(spark):
    rows = contract.queries()["op12_line_dedup"](spark, SF).collect()
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {(i, n, d, hashlib.sha256(kept.encode()).hexdigest()) for i, n, d, kept in plain_lines(docs)}
    assert {tuple(r) for r in rows} == want
