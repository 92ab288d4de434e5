"""The training-data operators: exact results against plain computation, and the defined odd cases."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from tools.check import compare, connect
from trendspark.llm import brown, bagminhash, chat, decontamination, licenses, packing, quality, queries, simple8b, token_counts, token_files, tokens, warc, words
from trendspark.llm.components import components
from trendspark.session import scratch_path

SF = "/root/testdata/sf0.001"
IDS = tokens.vocabulary_path("byte_bpe_50k.json")
WORDS = tokens.vocabulary_path("word_bpe_49k.json")
PLAIN = "the quick brown fox jumps over the lazy dog while seven other animals look on from a hill nearby today"
LONG = " ".join(f"w{i % 997}x{i % 31}" for i in range(60_000))
ODD_ROWS = [
    (1, PLAIN),
    (2, None),
    (3, ""),
    (None, "a row without an id but with words enough to be kept by the base rule of the cascade"),
    (5, LONG),
    (6, PLAIN.upper()),
    (7, PLAIN),
    (7, PLAIN),
    (8, " \n\t "),
    (9, "é \x1c\x85　 <|endoftext|>\n\n  Ünïcode's ½ 中文 \U0001f600 end "),
    (None, None),
]
# Names that operators use inside.
CLASH = ["id", "key", "row", "found", "content_key", "n", "words", "part", "path", "label", "group", "bands", "size", "class"]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD_ROWS, "doc_id bigint, text string")
    return df.withColumns({name: F.lit("clash") for name in CLASH}).repartition(3)


@pytest.fixture(scope="module")
def none(odd):
    return odd.limit(0)


def texts_of(rows=ODD_ROWS):
    return [(i, t or "") for i, t in rows]


def tokenizer(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


# --- the registered queries beside SQL ---------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    assert compare(connect(SF), contract.queries()[name](spark, SF), queries.ORACLE_SQL[name]) == "ok"


def test_each_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


# --- tokens, packing, token files, counts --------------------------------------------------


def test_parts_give_the_ids_of_whole_texts():
    random.seed(5)
    alphabet = [*"ab'stllre.,!  \n\n\t\r\x0b\x1c\x1d\x85\xa0 　​9\xb2\xbd\xe9\xc9\xdf́̀ıİΣς中", "<|endoftext|>", "'s", "\n ", "  "]
    some = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 14))) for _ in range(20_000)]
    plain, lower = tokenizer(IDS), tokenizer(WORDS)
    ids, at = tokens.id_encoder(IDS).column(pa.array(some))
    counts = tokens.token_counter(WORDS).column(pa.array(some), {})
    for i, text in enumerate(some):
        assert ids[at[i] : at[i + 1]].tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)
        assert counts[i] == len(lower.encode(text, add_special_tokens=False).ids), repr(text)


def test_cache_keeps_keys_that_come_back():
    asked = []
    cache = tokens.Bounded(lambda k: asked.append(k) or k * 2, limit=2)
    assert [cache[k] for k in (1, 1, 1, 2, 3, 1)] == [2, 2, 2, 4, 6, 2]
    assert asked == [1, 1, 2, 3] and list(cache) == [1]
    assert [cache[k] for k in (2, 3, 1, 4, 4, 3)] == [4, 6, 2, 8, 8, 6]
    assert len(cache) <= 2


def test_packing(spark, odd, none):
    length = 64
    pieces = packing.pack(odd, IDS, length=length).collect()
    plain = tokenizer(IDS)
    want = Counter()
    for doc, text in texts_of():
        want[doc, tuple(plain.encode(text, add_special_tokens=False).ids + [1])] += 1
    by_place = sorted(pieces, key=lambda r: (r["sequence_id"], r["offset"]))
    # The stream is gapless, and all sequences but the last are full.
    at = 0
    docs, open_ids = Counter(), []
    for r in by_place:
        assert r["sequence_id"] * length + r["offset"] == at
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] and r["start"] == len(open_ids)
        at += r["length"]
        open_ids += ids.tolist()
        if len(open_ids) == r["doc_tokens"]:
            docs[r["doc_id"], tuple(open_ids)] += 1
            open_ids = []
    assert docs == want and not open_ids
    built = packing.sequences(packing.pack(odd, IDS, length=length)).orderBy("sequence_id").collect()
    assert [r["n_ids"] for r in built[:-1]] == [length] * (len(built) - 1)
    assert all(sum(b["length"] for b in r["boundaries"]) == r["n_ids"] == len(r["ids"]) // 4 for r in built)
    assert packing.pack(none, IDS).count() == 0


def test_simple8b_round_trip():
    random.seed(1)
    for n in (0, 1, 2, 3, 59, 60, 61, 5000):
        for top in (1, 2, 200, 50_257, 1 << 31, (1 << 60) - 1):
            ids = np.array([random.choice((0, 1, random.randrange(top))) for _ in range(n)], np.uint64)
            packed = simple8b.encode(ids)
            assert simple8b.decode(packed).tolist() == ids.tolist()
    assert len(simple8b.encode(np.ones(600, np.uint64))) == 10
    assert (simple8b.encode(np.array([1 << 40], np.uint64)) >> np.uint64(60)).tolist() == [simple8b.ESCAPE]


def test_token_file_blocks(tmp_path):
    sizes = [3, 0, 500, 1, 1, 2000, 7]
    ids = np.arange(sum(sizes)) % 50_257
    path = tmp_path / "x.s8b"
    with open(path, "wb") as sink:
        writer = simple8b.Writer(sink, block_ids=600)
        writer.add([1, None, 3, 4, 5, 6, 7], np.array(sizes), ids)
        writer.close()
    with open(path, "rb") as source:
        blocks = list(simple8b.read_blocks(source, path.stat().st_size))
    assert len(blocks) == 2
    assert [k for keys, _, _ in blocks for k in keys] == [1, None, 3, 4, 5, 6, 7]
    assert np.concatenate([s for _, s, _ in blocks]).tolist() == sizes
    assert np.concatenate([i for _, _, i in blocks]).tolist() == ids.tolist()


def test_token_files(spark, odd, none):
    folder = scratch_path(spark, "files")
    listed = token_files.write_token_files(odd, folder, IDS, end_id=0)
    assert listed.agg(F.sum("n_docs")).first()[0] == len(ODD_ROWS)
    rows = token_files.read_token_files(spark, folder).collect()
    plain = tokenizer(IDS)
    want = sorted((i is not None, i or 0, plain.encode(t, add_special_tokens=False).ids + [0]) for i, t in texts_of())
    got = sorted(rows, key=lambda r: r["start"])
    assert [r["id"] for r in got] == sorted([i for i, _ in ODD_ROWS], key=lambda i: (i is not None, i or 0))
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got[:-1]]).tolist()
    assert sorted((r["id"] is not None, r["id"] or 0, np.frombuffer(r["ids"], "<u4").tolist()) for r in got) == want
    empty = scratch_path(spark, "files")
    token_files.write_token_files(none, empty, IDS, end_id=0)
    assert token_files.read_token_files(spark, empty).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_token_counts(spark, odd, none, name):
    path = tokens.vocabulary_path(name)
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    else:
        model = tokenizer(path)
        count = lambda t: len(model.encode(t, add_special_tokens=False).ids)
    got = [tuple(r) for r in token_counts.count_tokens(odd, path, max_tokens=100).collect()]
    want = [(i, len(t.encode()), count(t), count(t) > 100) for i, t in texts_of()]
    assert Counter(got) == Counter(want)
    assert token_counts.count_tokens(none, path).count() == 0


def test_frequent_parts_come_from_all_tasks(spark):
    df = spark.createDataFrame([(f"x{i} common common b{i % 3} b{i % 3}",) for i in range(90)], "text string").repartition(4)
    assert token_counts.frequent_parts(df, "text", limit=4)[0] == "common"
    assert token_counts.frequent_parts(df.limit(0), "text") == []


# --- quality ---------------------------------------------------------------------------------


def plain_base(text):
    found = [w.decode() for w in text.encode().split()]
    spots = defaultdict(list)
    for i in range(len(found) - 4):
        spots[tuple(found[i : i + 5])].append(i)
    covered = {i + k for at in spots.values() if len(at) > 1 for i in at for k in range(5)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (
        len(found),
        sum(map(len, found)),
        sum(text.count(s) for s in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_figures(spark, odd, none):
    random.seed(2)
    made = [(100 + i, "".join(random.choice(["a ", "b ", "c\n", "é\t", "#", "\n", "\x0b", "\x1c", "word "]) for _ in range(random.randint(0, 80)))) for i in range(300)]
    more = spark.createDataFrame(made, "doc_id bigint, text string")
    rows = quality.quality_figures(odd.unionByName(more, allowMissingColumns=True)).collect()
    got = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in rows)
    assert got == Counter((i, *plain_base(t)) for i, t in texts_of() + made)
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert quality.quality_figures(none).count() == 0


def test_order_of_rules_does_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {tuple(sorted(r["doc_id"] for r in quality.keep_quality(docs, rules).select("doc_id").collect())) for rules in (quality.RULES, quality.RULES[::-1])}
    assert len(kept) == 1


def test_cascade_keeps_good_documents(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet").filter("toxic = 0")
    told = quality.quality_figures(spark.read.parquet(f"{sf}/documents.parquet")).join(labels, "doc_id")
    by = {r["quality"]: (r["kept"], r["n"]) for r in told.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"), F.count("*").alias("n")).collect()}
    assert by[1][0] > 0.97 and by[0][0] < 0.2


def test_rules_run_by_rejections_per_second(spark):
    import time

    def slow(text, base):
        time.sleep(0.001)
        return False

    rules = (quality.Rule("slow", slow), quality.Rule("cheap", lambda text, base: True))
    df = spark.createDataFrame([(PLAIN,)] * 20, "text string")
    assert quality.rule_order(df, rules) == [1, 0]


# --- licenses --------------------------------------------------------------------------------


def test_licenses(spark, odd, none):
    apache = dict(licenses.TEMPLATES)["Apache-2.0-header"]
    changed = apache.replace("obtain a copy", "get copies").replace("governing", "that governs")
    bodies = [
        (1, f"{PLAIN}\nReleased under the MIT License.\n{PLAIN}", [("MIT", 1.0, "Released under the MIT License")]),
        (2, f"é é Licensed under CC BY-NC 4.0. {PLAIN}", [("CC-BY-NC-4.0", 1.0, "Licensed under CC BY-NC 4.0")]),
        (3, f"{PLAIN} {changed} {PLAIN}", [("Apache-2.0-header", None, None)]),
        (4, PLAIN, []),
        (5, "licensed under the terms of a license, version 2.0 of it", []),
        (6, "Released under the MIT License.\n" * 40, [("MIT", 1.0, "Released under the MIT License")] * 40),
    ]
    df = spark.createDataFrame([b[:2] for b in bodies], "doc_id bigint, text string")
    found = defaultdict(list)
    for r in licenses.scan_licenses(df).collect():
        found[r["doc_id"]].append(r)
    for doc, body, want in bodies:
        got = sorted(found[doc], key=lambda r: r["start"])
        assert [r["license"] for r in got] == [w[0] for w in want]
        for r, (_, coverage, span) in zip(got, want, strict=True):
            assert coverage is None or (r["coverage"], body[r["start"] : r["end"]]) == (coverage, span)
    assert 0.8 <= found[3][0]["coverage"] < 1
    assert licenses.scan_licenses(odd).count() == 0 and licenses.scan_licenses(none).count() == 0


def names_in(text):
    index = licenses.Index.build(licenses.TEMPLATES)
    prints = licenses.notice_prints(text.encode())
    grams, at = words.window_prints(prints, np.zeros(len(prints), np.int64), licenses.GRAM)
    there, known = index.hits(grams)
    places = [(t, w - place, w) for w, gram in zip(at[there].tolist(), known.tolist(), strict=True) for t, place in index.places[gram]]
    return [index.names[t] if named else None for t, named, *_ in licenses.found_in(index, prints, places, licenses.MIN_COVERAGE)]


@pytest.mark.parametrize(
    ("text", "names"),
    [
        ("This work is licensed under the GNU General Public License, version 2.", ["GPL-2.0"]),
        ("This work is licensed under the GNU General Public License, version 4.", [None]),
        ("This work is licensed under the GNU Lesser General Public License, version 3.", ["LGPL-3.0"]),
        (dict(licenses.TEMPLATES)["GPL-2.0-header"], ["GPL-2.0-header"]),
        (dict(licenses.TEMPLATES)["LGPL-2.1-header"], ["LGPL-2.1-header"]),
        (dict(licenses.TEMPLATES)["GPL-3.0-header"].replace("General", "Library General"), [None]),
        ("Licensed under CC BY 3.0.", ["CC-BY-3.0"]),
        ("Licensed under CC BY-NC-ND 4.0.", ["CC-BY-NC-ND-4.0"]),
        ("Licensed under CC BY-NC-SA 4.0, or not.", ["CC-BY-NC-SA-4.0"]),
        ("Licensed under CC BY-NC-XX 4.0.", ["CC-BY-NC-4.0"]),
        ("Not licensed under the MIT License", [None]),
        (dict(licenses.TEMPLATES)["BSD-3-Clause-text"], ["BSD-3-Clause-text"]),
        (dict(licenses.TEMPLATES)["BSD-2-Clause-text"], ["BSD-2-Clause-text"]),
        ("Licensed under the Apache License, Version 1.0.", [None]),
    ],
)
def test_siblings_are_told_apart(text, names):
    assert names_in(text) == names
    assert names_in(f"{PLAIN} {text} {PLAIN}") == names


def test_every_template_names_itself():
    for name, text in licenses.TEMPLATES:
        assert names_in(f"{PLAIN}. {text} {PLAIN}") == [name]


def plain_alignment(template, text):
    """(score, matches) of the best local alignment over the full matrix."""
    best, zero = (0, 0), (0, 0)
    before = [zero] * (len(text) + 1)
    for a in template:
        row = [zero]
        for j, b in enumerate(text, 1):
            score, matches = before[j - 1]
            cells = [(score + licenses.MATCH, matches + 1) if a == b else (score + licenses.MISMATCH, matches)]
            cells += [(s + licenses.GAP, m) for s, m in (before[j], row[-1])]
            cell = max(cells)
            row.append(cell if cell[0] > 0 else zero)
        best = max(best, *row)
        before = row
    return best


def test_alignment_against_the_full_matrix():
    random.seed(23)
    for _ in range(150):
        template = [random.randrange(40) for _ in range(random.randint(4, 30))]
        body = [w for w in template if random.random() > 0.1]
        for _ in range(random.randint(0, 3)):
            body.insert(random.randint(0, len(body)), random.randrange(40))
        text = [random.randrange(100, 140) for _ in range(20)] + body + [random.randrange(100, 140) for _ in range(20)]
        matches, first, end = licenses.aligned(template, text, -len(template), len(text))
        score, most = plain_alignment(template, text)
        inside = plain_alignment(template, text[first:end])
        assert inside[0] == score and matches <= end - first and abs(matches - most) <= 1


def test_long_repeats_do_not_hide_notices():
    """Short notices back to back chain over every diagonal of a long template; both long notices are still found."""
    header = dict(licenses.TEMPLATES)["Apache-2.0-header"]
    line = "Licensed under the Apache License, Version 2.0. "
    got = names_in(f"{header} {line * 60} {header}")
    assert got.count("Apache-2.0-header") == 2 and got.count("Apache-2.0") >= 58


def test_winnowing_finds_every_shared_run():
    random.seed(4)
    index = licenses.Index.build(licenses.TEMPLATES)
    need = licenses.WINNOW + licenses.GRAM - 1
    for _ in range(200):
        t = random.randrange(len(index.words))
        template = index.words[t]
        at = random.randrange(max(1, len(template) - need + 1))
        text = [random.getrandbits(60) for _ in range(5)] + template[at : at + need] + [random.getrandbits(60) for _ in range(5)]
        grams, _ = words.window_prints(np.array(text, np.uint64), np.zeros(len(text), np.int64), licenses.GRAM)
        assert any(p[0] == t for k in index.hits(grams)[1] for p in index.places[k])


# --- archive ---------------------------------------------------------------------------------


def test_archive(spark):
    big = "x" * 150
    rows = [(4, "u4", big), (2, "u2", big), (2, "u2", big), (9, None, big), (None, "n", big), (3, "u\r\n3", "small"), (1, "u1", "small"), (5, "u5", None), (6, "u6", "é" * 60), (None, "m", "only" * 40)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumns({n: F.lit(0) for n in CLASH})
    folder = scratch_path(spark, "warc")
    warc.write_archive(df, folder)
    payloads = {r["digest"]: bytes(r["payload"]) for r in warc.read_payloads(spark, folder).collect()}
    assert len(payloads) == len({r[2] or "" for r in rows})
    assert all(hashlib.sha256(p).hexdigest() == d for d, p in payloads.items())
    got = Counter((r["key"], r["record_type"], r["refers_to"], r["payload_digest"], r["payload_bytes"]) for r in warc.parsed_records(spark, folder).collect())

    def want(key, html):
        body = (html or "").encode()
        first = min((k for k, _, h in rows if h == html and k is not None), default=None)
        revisit = len(body) >= 100 and first is not None and key != first
        return key, "revisit" if revisit else "response", first if revisit else None, hashlib.sha256(body).hexdigest(), len(body)

    assert got == Counter(want(k, h) for k, _, h in rows)
    # The bytes of a record: headers, the payload unless it is a revisit, and lengths that hold.
    for r in warc.read_records(spark, folder).select("carries", "payload", warc.record_bytes().alias("raw")).collect():
        raw = bytes(r["raw"])
        head, _, rest = raw.partition(b"\r\n\r\n")
        length = int(next(x for x in head.split(b"\r\n") if x.startswith(b"Content-Length")).split(b": ")[1])
        assert len(rest) == length + 4 and rest.endswith(b"\r\n\r\n")
        assert rest[:-4].endswith(bytes(r["payload"])) if r["carries"] else rest[:-4].endswith(b"\r\n\r\n")
    empty = scratch_path(spark, "warc")
    warc.write_archive(df.limit(0), empty)
    assert warc.parsed_records(spark, empty).count() == 0


def test_damaged_payload_stops_the_read(spark):
    folder = scratch_path(spark, "warc")
    warc.write_archive(spark.createDataFrame([(1, "u", "body")], "page_id bigint, url string, html string"), folder)
    spark.createDataFrame([(hashlib.sha256(b"body").hexdigest(), b"other")], "digest string, payload binary").write.mode("overwrite").parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        warc.parsed_records(spark, folder).collect()


# --- chat ------------------------------------------------------------------------------------


def turns_of(row):
    return None if row is None else [(t["role"], t["text"]) for t in row]


def test_layouts_by_fingerprint(spark):
    records = [
        ('{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":"a"}]}', [("user", "q"), ("assistant", "a")]),
        ('{"conversations":[{"from":"human","value":"q"},{"value":"a","from":"gpt"}]}', [("user", "q"), ("assistant", "a")]),
        ('{"turns":[{"speaker":"bot","utterance":"a"}]}', [("assistant", "a")]),
        ('{"response":"a","prompt":"q"}', [("user", "q"), ("assistant", "a")]),
        ('{"prompt":"q","response":null}', [("user", "q"), ("assistant", "")]),
        ('{"instruction":"i","input":"","output":"o"}', [("system", "i"), ("assistant", "o")]),
        ('{"instruction":"i","output":"o"}', [("user", "i"), ("assistant", "o")]),
        ('{"question":1,"answer":2.5}', [("user", "1"), ("assistant", "2.5")]),
        ('{"unknown":"x"}', None),
        ("not json", None),
        (None, None),
    ]
    df = spark.createDataFrame([(i, r[0]) for i, r in enumerate(records)], "i int, record string")
    got = {r["i"]: turns_of(r["turns"]) for r in chat.canonical_turns(df, "record").collect()}
    assert got == {i: want for i, (_, want) in enumerate(records)}


def test_struct_records_by_their_type(spark):
    df = spark.createDataFrame([(("q", "a"),), (None,)], "record struct<prompt:string,completion:string>")
    got = [turns_of(r["turns"]) for r in chat.canonical_turns(df, "record").collect()]
    assert sorted(got, key=str) == [None, [("user", "q"), ("assistant", "a")]] or got == [[("user", "q"), ("assistant", "a")], None]
    other = spark.createDataFrame([(("q",),)], "record struct<body:string>")
    assert chat.canonical_turns(other, "record").first()["turns"] is None


def test_template_round_trip(spark):
    random.seed(6)
    bits = ["\\", "<|", "<", "|", ">", "<|end|>", "<|turn|>", "\\l", "\\b", "é", "\n", "x", "</turn>", "\U0001f600", ""]
    made = [[(random.choice(["user", "assistant", "sys<|tem"]), "".join(random.choice(bits) for _ in range(random.randint(0, 9)))) for _ in range(random.randint(0, 5))] for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(made)], f"i int, turns {chat.TURNS}")
    out = chat.format_turns(df)
    out = out.withColumns({"back": chat.parse_turns(F.col("formatted")), "learned": chat.loss_text(F.col("formatted"), F.col("loss"))})
    for r in out.collect():
        assert turns_of(r["back"]) == made[r["i"]]
        assert r["learned"] == "".join(t for role, t in made[r["i"]] if role == "assistant")


def test_rows_to_records(spark):
    rows = [(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 2, "assistant", "b"), (None, 1, None, None), (None, None, "user", "z"), (3, 0, "user", None)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumns({n: F.lit(1) for n in CLASH})
    got = {r["conv_id"]: turns_of(r["turns"]) for r in chat.canonical_turns(chat.records_from_rows(df), "record").collect()}
    assert got == {1: [("user", "a"), ("assistant", "b"), ("assistant", "b")], None: [("user", "z"), ("", "")], 3: [("user", "")]}
    assert chat.records_from_rows(df.limit(0)).count() == 0


def test_chat_plan_has_no_python(spark):
    plan = contract.queries()["op7_chat"](spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# --- near duplicates ---------------------------------------------------------------------------


def shingle_set(text):
    found = text.encode().lower().split()
    if len(found) < 5:
        return Counter([tuple(found)] if found else [])
    return Counter(zip(*[found[i:] for i in range(5)], strict=False))


def plain_classes(rows):
    """Class of each row number: components of rows that have the same words or a similarity of 0.8."""
    sets = [None if t is None else shingle_set(t) for _, t in rows]
    total = [0 if s is None else sum(s.values()) for s in sets]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] is None or sets[j] is None:
                continue
            shared = sum((sets[i] & sets[j]).values())
            same = rows[i][1].encode().lower().split() == rows[j][1].encode().lower().split()
            if same or (shared and 5 * shared >= 4 * (total[i] + total[j] - shared)):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(rows))]


def copies(n, edits, seed, base=90):
    random.seed(seed)
    original = [f"word{random.randrange(10**6)}" for _ in range(base)]
    out = [" ".join(original)]
    for _ in range(n):
        changed = list(original)
        for _ in range(random.randint(0, edits)):
            changed[random.randrange(base)] = f"new{random.randrange(10**6)}"
        out.append(" ".join(changed))
    return out


def same_partition(got, rows):
    """Classes equal the plain ones, and are named by their smallest ids."""
    want = plain_classes(rows)
    members = defaultdict(list)
    for (i, _), w in zip(rows, want, strict=True):
        members[w].append(i)
    expected = Counter()
    for (i, t), w in zip(rows, want, strict=True):
        known = [m for m in members[w] if m is not None]
        expected[i, (min(known) if known else None) if t is not None else i, len(members[w]) if t is not None else 1] += 1
    assert Counter(got) == expected


def test_near_duplicates(spark, odd, none):
    rows = list(ODD_ROWS)
    for k, (n, edits) in enumerate([(6, 3), (12, 5), (1, 1), (3, 0)]):
        rows += [(1000 * (k + 1) + i, t) for i, t in enumerate(copies(n, edits, k))]
    rows += [(9000, "four words are few"), (9001, "Four words  are few"), (9002, "four words are here"), (9003, "the the the the the the the the the"), (9004, "the the the the the the the the the the")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({n: F.lit("clash") for n in CLASH}).repartition(4)
    got = [(r["doc_id"], r["class_id"], r["class_size"]) for r in bagminhash.near_duplicates(df).collect()]
    same_partition(got, rows)
    assert bagminhash.near_duplicates(none).count() == 0


def test_large_groups_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(bagminhash, "BLOCK_TEXTS", 8)
    rows = [(i, t) for i, t in enumerate(copies(60, 9, 11) + copies(5, 2, 12))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = [(r["doc_id"], r["class_id"], r["class_size"]) for r in bagminhash.near_duplicates(df).collect()]
    same_partition(got, rows)


def test_candidates_beyond_the_bound_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(bagminhash, "SENT_ROWS", 0)
    rows = [(i, t) for i, t in enumerate(copies(6, 4, 13))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    same_partition([(r["doc_id"], r["class_id"], r["class_size"]) for r in bagminhash.near_duplicates(df).collect()], rows)
    assert bagminhash.keep_one_of_each(df).count() == len(set(plain_classes(rows)))


def test_signatures_estimate_weighted_jaccard():
    random.seed(3)
    slots = 20_000
    for _ in range(3):
        a = {k: random.choice([1, 1, 1, 2, 3, 7, 20]) for k in random.sample(range(10**9), 60)}
        b = {k: max(0, w + random.choice([0, 0, 0, 1, -1, 5])) for k, w in a.items()}
        b = {k: w for k, w in b.items() if w} | {random.randrange(10**9): 2}
        rows = np.array([0] * len(a) + [1] * len(b))
        prints = words.mix(np.array([*a, *b], np.uint64))
        found = bagminhash.signatures(rows, prints, np.array([*a.values(), *b.values()]), 2, slots)
        keys = a.keys() | b.keys()
        exact = sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
        assert abs((found[0] == found[1]).mean() - exact) < 0.02


def test_components(spark):
    random.seed(8)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 430)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a int, b int"), "a", "b").collect()}
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    assert got == {x: find(x) for x in parent if any(x in e and e[0] != e[1] for e in edges)}


# --- decontamination ---------------------------------------------------------------------------


def plain_hits(text, items, window):
    found = decontamination.fold_words((text or "").encode())
    hit, names = set(), set()
    for item, body in items:
        words_ = decontamination.fold_words((body or "").encode())
        size = min(window, len(words_))
        for at in range(len(words_) - size + 1 if size else 0):
            for k in range(len(found) - size + 1):
                if found[k : k + size] == words_[at : at + size]:
                    hit |= set(range(k, k + size))
                    names.add(item)
    return len(found), len(hit), sorted(names, key=lambda i: (i is None, i))


@pytest.mark.parametrize("pass_words", [decontamination.PASS_WORDS, 4])
def test_contamination(spark, odd, none, pass_words):
    random.seed(7)
    some = lambda n: " ".join(random.choice(["a", "b", "Éa", "c-d", "x9", "the"]) for _ in range(n))
    items = [(1, some(6)), (2, some(9)), (3, some(2)), (4, ""), (5, None), (None, some(6)), (6, "b"), (6, some(5)), (7, PLAIN)]
    docs = [(i, some(random.randint(0, 60))) for i in range(80)] + ODD_ROWS
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("item", F.lit(0))
    df = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({n: F.lit("clash") for n in CLASH if n != "found"}).repartition(3)
    rows = decontamination.contamination(df, bench, window=5, pass_words=pass_words).collect()
    want = [(i, *plain_hits(t, items, 5)) for i, t in docs]
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in rows) == Counter((i, n, h, tuple(x)) for i, n, h, x in want)
    assert all(r["contaminated"] == (r["n_hit"] > 0) for r in rows)
    kept = decontamination.keep_clean(odd, bench, window=5, pass_words=pass_words)
    assert kept.columns == odd.columns
    clean = Counter(i for i, t in ODD_ROWS if not plain_hits(t, items, 5)[1])
    assert Counter(r["doc_id"] for r in kept.collect()) == clean
    assert decontamination.keep_clean(none, bench).count() == 0
    assert decontamination.keep_clean(odd, bench.limit(0)).count() == len(ODD_ROWS)


def test_long_texts_are_searched_in_slices(monkeypatch):
    searches = decontamination.build_searches([(1, PLAIN)], 10)
    text = f"{LONG[:3000]} {PLAIN} {LONG[:3000]}".encode()
    whole = decontamination._search(text, searches)
    monkeypatch.setattr(decontamination.word_slices, "__defaults__", (200,))
    assert decontamination._search(text, searches) == whole and whole[1]


# --- language model ----------------------------------------------------------------------------


def plain_scores(rows):
    counts = Counter()
    for i, t in rows:
        if i is None or zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update((t or "").encode().lower().split())
            counts[b"\n"] += 1
    n, v = sum(counts.values()), len(counts)
    out = Counter()
    for i, t in rows:
        found = (t or "").encode().lower().split() + [b"\n"]
        base = math.fsum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in found)
        out[i, i is not None and zlib.crc32(str(i).encode()) % 5 == 1, len(found), sum(counts[w] > 0 for w in found), n, round(base, 6)] += 1
    return out


@pytest.mark.parametrize("frequent", [brown.FREQUENT_WORDS, 30])
def test_scores(spark, odd, none, monkeypatch, frequent):
    monkeypatch.setattr(brown, "FREQUENT_WORDS", frequent)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] + ODD_ROWS
    df = odd.unionByName(docs, allowMissingColumns=True)
    got = brown.score_texts(df).collect()
    assert Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in got) == plain_scores(rows)
    assert all(r["score"] < 0 for r in got)
    assert brown.score_texts(none).count() == 0


def test_joined_words_score_like_sent_ones(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(brown, "CLUSTER_WORDS", 20)
    whole = {r["doc_id"]: r["score"] for r in brown.score_texts(docs).collect()}
    monkeypatch.setattr(brown, "FREQUENT_WORDS", 40)
    joined = {r["doc_id"]: r["score"] for r in brown.score_texts(docs).collect()}
    assert whole.keys() == joined.keys()
    assert all(math.isclose(whole[d], joined[d], rel_tol=1e-9) for d in whole)


def test_model_beats_base_on_held_out_texts(spark):
    rows = brown.score_texts(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").collect()
    n = sum(r["n_tokens"] for r in rows)
    assert sum(r["score"] for r in rows) / n > sum(r["base_score"] for r in rows) / n + 0.1


def test_exchange_finds_planted_classes():
    random = np.random.default_rng(1)
    kinds = random.integers(0, 4, 60)
    follow = np.array([[0, 9, 1, 0], [0, 0, 9, 1], [1, 0, 0, 9], [9, 1, 0, 0]])
    table = random.poisson(follow[kinds][:, kinds] * 5.0).astype(float)
    table = np.pad(table, (0, 1), constant_values=1)
    best = max((brown.exchange(table, 5, seed, 30) for seed in range(4)), key=lambda r: r[0])[1]
    assert best[-1] == 4 and all(len(set(best[:-1][kinds == k])) == 1 for k in range(4))


def test_best_classes_have_the_highest_likelihood():
    random = np.random.default_rng(5)
    n, classes = 30, 6
    table = random.poisson(1.5, (n, n)).astype(float)
    assigned = np.r_[random.integers(0, classes - 1, n - 1), classes - 1]
    member = np.eye(classes)[assigned]
    right, left, twin = table @ member, table.T @ member, np.diagonal(table)
    rows = np.arange(n)
    right[rows, assigned] -= twin
    left[rows, assigned] -= twin
    got = brown.best_classes(brown.class_pairs(table, assigned, classes), assigned, right, left, twin)
    for word in range(n - 1):
        told = [brown.log_likelihood(brown.class_pairs(table, np.where(rows == word, k, assigned), classes)) for k in range(classes - 1)]
        assert told[got[word]] == pytest.approx(max(told))


def test_words_beyond_the_units_have_classes_by_their_own_bigrams(spark, monkeypatch):
    monkeypatch.setattr(brown, "CLUSTER_WORDS", 20)
    monkeypatch.setattr(brown, "SUFFIX_GROUPS", 4)
    random = np.random.default_rng(8)
    # Words of four kinds that follow each other in turn, five of each kind common; their letters tell nothing.
    kind = {f"w{zlib.crc32(b'%d' % i):x}".encode(): i % 4 for i in range(160)}
    of = [[w.decode() for w, k in kind.items() if k == q] for q in range(4)]
    texts = [" ".join(of[(at + j) % 4][random.integers(5 if random.random() < 0.6 else 40)] for j in range(60)) for at in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    model = brown.train(df, "text", brown.word_counts(df, "text").cache())
    kinds = defaultdict(Counter)
    for word, k in kind.items():
        kinds[int(model.classes[model.units.unit(word)])][k] += 1
    assert sum(max(c.values()) for c in kinds.values()) >= 0.95 * len(kind)


def test_probabilities_add_up(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = brown.word_counts(docs, "text").cache()
    model = brown.train(docs, "text", counts)
    assert np.allclose((10.0**model.transition).sum(1), 1)
    listed = [(bytes(r["word"]), r["n"]) for r in counts.collect()]
    within = np.zeros(brown.CLASSES)
    for word, n in listed:
        of = brown.CLASSES - 1 if word == brown.END else model.classes[model.units.unit(word)]
        within[of] += 10.0 ** model.emission(np.float64(n), of)
    # One unseen word of each class but the end's.
    within[:-1] += brown._EMISSION / model.emission_total[:-1]
    assert np.allclose(within, 1)


def test_scores_by_plain_counts_of_the_models_classes(spark, monkeypatch):
    monkeypatch.setattr(brown, "CLUSTER_WORDS", 50)
    seen = []
    sweeps = brown.all_word_classes
    monkeypatch.setattr(brown, "all_word_classes", lambda contexts, *rest: seen.extend([contexts.count(), sweeps(contexts, *rest)]) or seen[1])
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(300)
    learned, encoded, vocabulary = brown.learn(docs, "doc_id", "text", ~brown.held_out(F.col("doc_id")))
    # A row for each bucket of words, not one for each bigram.
    assert seen[0] <= brown.BUCKETS
    listed = brown.listed_words(vocabulary).collect()
    ids, _ = learned.numbers(*(np.array([r[x] for r in listed]) for x in ("bucket", "number", "group")))
    cls = {bytes(r["word"]): int(k) for r, k in zip(listed, learned.classes[ids], strict=True)} | {brown.END: brown.CLASSES - 1}
    counts, pairs = Counter(), np.zeros((brown.CLASSES, brown.CLASSES))
    texts = {r["doc_id"]: (r["text"] or "").encode().lower().split() + [brown.END] for r in docs.collect()}
    for i, words in texts.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(words)
            for a, b in zip([brown.END, *words], words):
                pairs[cls[a], cls[b]] += 1
    # Counts that are changed by the words that moved are those of the classes in the end.
    assert np.array_equal(seen[1][1], pairs)
    prior = (pairs.sum(0) + 0.5) / (pairs.sum() + 0.5 * brown.CLASSES)
    follows = np.log10((pairs + prior) / (pairs.sum(1, keepdims=True) + 1))
    tokens, kinds = np.zeros(brown.CLASSES), np.zeros(brown.CLASSES)
    for word, n in counts.items():
        tokens[cls[word]] += n
        kinds[cls[word]] += 1
    total = tokens + 0.5 * (kinds + (np.arange(brown.CLASSES) < brown.CLASSES - 1))
    for r in brown._scores(encoded, learned).collect():
        words = texts[r["id"]]
        want = sum(follows[cls[a], cls[b]] + math.log10((counts[b] + 0.5) / total[cls[b]]) for a, b in zip([brown.END, *words], words))
        assert r["score"] == pytest.approx(want)


def test_packed_numbers_come_back():
    random = np.random.default_rng(2)
    many = random.zipf(1.3, 50_000) % 200_000
    for x in ([], [0], [255, 0, 3], [256, 1], [65_535], [65_536, 2], [(1 << 24) - 1], [1 << 24, 5], [1 << 32, 7], [1 << 62, 0], many):
        x = np.array(x, np.int64)
        assert np.array_equal(brown._unpacked(brown._packed(x), len(x)), x)
    assert len(brown._packed(many)) < len(brown._narrow(many)) / 2


def test_disk_of_tables_when_texts_are_encoded(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    folder, seen = Path(scratch_path(spark, "x")).parent, []
    encode, old = brown.encode_texts, set(folder.glob("**/*"))

    class Encoded(Exception):
        pass

    def watched(split, numbered, numbers):
        seen.extend(p for p in split.inputFiles() if Path(p.removeprefix("file://")).exists())
        encode(split, numbered, numbers)
        raise Encoded

    monkeypatch.setattr(brown, "encode_texts", watched)
    with pytest.raises(Encoded):
        brown.learn(docs, "doc_id", "text", ~brown.held_out(F.col("doc_id")))
    # The words of the chunks have numbers by now and are gone.
    assert {r["bucket"] for r in spark.read.parquet(*seen).select("bucket").collect()} == {brown._TEXTS}
    stored = sum(p.stat().st_size for p in set(folder.glob("**/*")) - old if p.is_file())
    assert stored < 2 * docs.select(F.sum(F.octet_length("text"))).first()[0]


# --- pipeline ----------------------------------------------------------------------------------


def test_pipeline(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {r["doc_id"] for r in quality.quality_figures(docs).filter("kept").collect()}
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    patterns = {tuple(w[i : i + 10]) for _, t in bench for w in [decontamination.fold_words(t.encode())] for i in range(len(w) - 9)}
    left = sorted(good)
    shingled = {d: shingle_set(rows[d]) for d in left}
    total = {d: sum(s.values()) for d, s in shingled.items()}
    where = defaultdict(list)
    parent = {d: d for d in left}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d in left:
        shared = Counter()
        for s, n in shingled[d].items():
            for e in where[s]:
                shared[e] += min(n, shingled[e][s])
            where[s].append(d)
        for e, n in shared.items():
            if 5 * n >= 4 * (total[d] + total[e] - n):
                low, high = sorted((find(d), find(e)))
                parent[high] = low
    once = [d for d in left if find(d) == d]
    clean = [d for d in once for w in [decontamination.fold_words(rows[d].encode())] if not any(tuple(w[i : i + 10]) in patterns for i in range(len(w) - 9))]
    out = corpus_pipeline.run(spark, sf).collect()
    assert {r["doc_id"] for r in out} == set(clean)
    plain = tokenizer(IDS)
    ids = {d: np.array(plain.encode(rows[d], add_special_tokens=False).ids + [1], "<u4") for d in clean}
    for r in out:
        piece = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert zlib.crc32(piece.tobytes()) == r["ids_crc32"] and r["doc_tokens"] == len(ids[r["doc_id"]])
    assert sum(r["length"] for r in out) == sum(map(len, ids.values()))


@pytest.mark.parametrize("k", range(4))
def test_stages_take_odd_tables(spark, odd, none, k):
    name, stage = corpus_pipeline.STAGES[k]
    for df in (odd, none):
        out = stage(spark, df, SF)
        rows = out.collect()
        if k < 3:
            assert out.schema == df.schema
        assert rows or df is none
    if name == "near_duplicates":
        left = [(r["doc_id"], r["text"]) for r in stage(spark, odd, SF).collect()]
        classes = len({w for w, (_, t) in zip(plain_classes(ODD_ROWS), ODD_ROWS, strict=True) if t is not None})
        assert sum(t is not None for _, t in left) == classes
        assert sum(t is None for _, t in left) == sum(t is None for _, t in ODD_ROWS)
