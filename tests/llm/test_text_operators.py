import random

import base64
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from metrolake.llm import bpe, decontaminate, line_dedup, simhash
from metrolake.llm.registry import queries
from tests.llm import brute

DATA = "/root/testdata/sf0.001"


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


def rows(spark, name):
    return [tuple(r) for r in spark.read.parquet(f"{DATA}/{name}.parquet").collect()]


@pytest.fixture()
def many_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", old)


def some_docs(seed=3, n=160):
    """Hot lines and shared ones, lines met in two documents only, odd white space, null and empty texts, equal ids."""
    rng = random.Random(seed)
    pool = [f"This line number {k} is shared by some Documents" for k in range(40)]
    docs = []
    for i in range(n):
        lines = ["  the very COMMON line of them all\t"] if i % 3 else ["short"]
        lines += rng.choices(pool, k=rng.randrange(6)) + [f"only document {i} has this line of text", "ééééééééééé ß"]
        rng.shuffle(lines)
        docs.append((i // 2 if i < 10 else i, "\n".join(lines)))
    return [*docs, (n, None), (n + 1, ""), (None, docs[5][1]), (n + 2, "\n\n"), docs[7], docs[7]]


# ---- line dedup -------------------------------------------------------------

def test_line_dedup_equals_brute_force(spark, many_partitions):
    docs = some_docs()
    df = frame(spark, docs).repartition(5)
    out = line_dedup.apply_bitmaps(df, line_dedup.keep_bitmaps(df))
    got = sorted(((r.doc_id, r["_n_lines"], r["_n_lines"] - r["_n_dropped"], r["_kept"]) for r in out.collect()), key=str)
    # Rows with one id are one document that holds all their lines.
    want = [(i, n, len(k.split("\n")) if k or n == 1 else 0, k) for i, n, k in brute.line_dedup(docs)]
    assert [(a, b, d) for a, b, _, d in got] == sorted(((a, b, d) for a, b, _, d in want), key=str)


def test_line_dedup_keeps_one_line_of_keys_at_partition_edges(spark, many_partitions):
    # Few keys on many partitions: most keys begin or end a partition and are settled late.
    docs = [(i, f"a line that every document holds, number {i % k}") for k in (1, 2, 3) for i in range(k * 20, k * 20 + 20)]
    df = frame(spark, docs).repartition(5)
    out = line_dedup.apply_bitmaps(df, line_dedup.keep_bitmaps(df)).collect()
    want = {i: k for i, _, k in brute.line_dedup(docs)}
    assert {r.doc_id: r["_kept"] for r in out} == want
    assert {t for _, t in docs} == {k for k in want.values() if k}


def test_line_dedup_stage_keeps_columns_and_empty_table(spark):
    df = frame(spark, some_docs()).selectExpr("doc_id", "text", "1 AS _kept", "'x' AS kind", "2 AS pos")
    out = line_dedup.drop_lines(df.drop("_kept"))
    assert out.columns == ["doc_id", "text", "kind", "pos"] and out.count() == df.count()
    assert out.filter("text is null").count() == 1
    none = frame(spark, [])
    assert line_dedup.drop_lines(none).count() == 0


def test_line_dedup_stage_keeps_columns_named_like_its_own(spark):
    names = ["_id", "_h", "_doc", "_rk", "_bits", "_bitmap", "_cut", "_kept", "_n_lines", "_n_dropped", "row", "cut",
             "id", "h", "doc", "rk", "n_bits", "bitmap"]
    df = frame(spark, some_docs()).selectExpr("doc_id", "text", *[f"{k} AS {c}" for k, c in enumerate(names)])
    out = line_dedup.drop_lines(df)
    assert out.columns == df.columns
    got, want = out.collect(), brute.line_dedup(some_docs())
    assert all([r[c] for c in names] == list(range(len(names))) for r in got)
    assert len(got) == len(want) and {r.text for r in got if r.text is not None} == {
        k for (_, t), (*_, k) in zip(some_docs(), want, strict=True) if t is not None}


def test_bitmap_round_trip():
    keep = line_dedup.unpack_bitmap(line_dedup.pack_bitmap(19, np.array([0, 3, 18])), 19)
    assert np.flatnonzero(~keep).tolist() == [0, 3, 18]


# ---- SimHash ----------------------------------------------------------------

def near_docs():
    rng = random.Random(5)
    vocab = ["".join(rng.choices("abcdefghij", k=5)) for _ in range(300)]
    docs = []
    for g in range(12):
        base = rng.choices(vocab, k=220)
        for _ in range(rng.choice([1, 2, 9, 30])):
            w = list(base)
            for _ in range(rng.randrange(3)):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            docs.append(" ".join(w).title() if rng.random() < 0.3 else "\t".join(w))
    docs += [None, "", " \n", "one", "One", "one two three", "a b c d e", docs[0], docs[0]]
    rng.shuffle(docs)
    return [(None if k % 17 == 3 else 1000 - k, t) for k, t in enumerate(docs)]


@pytest.mark.parametrize("segments,block_rows", [(5, 4096), (5, 7), (6, 11)])
def test_simhash_equals_brute_force(spark, segments, block_rows):
    docs = near_docs()
    out = simhash.simhash_components(frame(spark, docs).repartition(3), segments=segments, block_rows=block_rows)
    got = [(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in out.collect()]
    assert sorted(got, key=str) == sorted(brute.simhash(docs), key=str)


def test_links_forest_finds_every_link():
    rng = np.random.default_rng(2)
    for spread in (2, 6, 40):
        base = rng.integers(0, 1 << 63, 20, dtype=np.uint64)
        fp = np.unique(base[rng.integers(0, 20, 900)] ^ np.bitwise_or.reduce(
            np.uint64(1) << rng.integers(0, spread, (900, 3)).astype(np.uint64), axis=1))
        rank = fp.copy()
        for s in (1, 2, 4, 8, 16, 32):
            rank ^= rank >> np.uint64(s)
        fp = fp[np.argsort(rank)]
        lab = simhash.links_forest(np.zeros(len(fp), np.int64), fp, 4)
        far = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4
        want = brute.components(range(len(fp)), zip(*np.nonzero(far), strict=True))
        assert lab.tolist() == [want[k] for k in range(len(fp))]


def test_fingerprint_of_long_text_in_pieces(monkeypatch):
    text = " ".join(str(k * 7919 % 1000) for k in range(3000))
    want = simhash.fingerprint(text.encode(), 4)
    monkeypatch.setattr(simhash, "PIECE", 257)
    assert simhash.fingerprint(text.encode(), 4) == want
    assert want & (1 << 64) - 1 == brute.fingerprint(text)


def test_drop_near_copies_keeps_one_of_each_group(spark):
    docs = near_docs()
    df = frame(spark, docs).selectExpr("doc_id", "text", "7 AS fp", "8 AS component_id", "9 AS h")
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns
    comp = brute.simhash(docs)
    ids = [c for *_, c in comp if c is not None]
    got = [r.doc_id for r in kept.collect()]
    assert sorted(x for x in got if x is not None) == sorted(set(ids))
    assert simhash.drop_near_copies(frame(spark, [])).count() == 0


# ---- decontamination ----------------------------------------------------------

def leaks():
    rng = random.Random(9)
    vocab = ["the", "of", "and", "x", "y", "ñu", "42", *["w" + str(k) for k in range(25)]]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([0, 2, 5, 9, 10, 11, 30])))) for i in range(25)]
    items += [(25, None), (None, "never seen by anyone"), (3, "a second text of item three with more than ten words in it"), (30, items[9][1])]
    docs = []
    for d in range(120):
        w = rng.choices(vocab, k=rng.randrange(40))
        if d % 3 == 0:
            t = (rng.choice(items)[1] or "").split()
            a = rng.randrange(max(1, len(t) - 9))
            w[len(w) // 2:len(w) // 2] = t[a:a + rng.randrange(8, 30)]
        docs.append((d, " ".join(x.upper() if rng.random() < 0.2 else x + rng.choice(["", ",", "!\n"]) for x in w)))
    return [*docs, (500, None), (501, ""), (None, docs[3][1]), docs[3]], items


@pytest.mark.parametrize("piece,block", [(4 << 20, 32 << 20), (23, 300)])
def test_decontamination_equals_brute_force(spark, monkeypatch, piece, block):
    monkeypatch.setattr(decontaminate, "PIECE", piece)
    docs, items = leaks()
    it = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.annotate(frame(spark, docs), it, block_bytes=block)
    got = [(r.doc_id, r.n_words, {p for s in r.spans for p in range(s.start, s.end)}, set(r["items"]))
           for r in out.collect()]
    assert sorted(got, key=str) == sorted(brute.contamination(docs, items), key=str)


def test_decontaminate_cuts_spans_and_keeps_the_rest(spark):
    passage = "one Two three four five six seven eight nine ten eleven"
    it = spark.createDataFrame([(1, passage)], "item_id long, text string")
    clean = " ".join(f"clean{k}" for k in range(80))
    docs = [(1, clean), (2, f"{clean}. {passage.upper()}! {clean} é"), (3, passage), (4, None), (None, "")]
    df = frame(spark, docs).selectExpr("doc_id", "text", "5 AS n_words", "'k' AS items")
    out = {r.doc_id: tuple(r)[1:] for r in decontaminate.decontaminate(df, it).collect()}
    assert out == {1: (clean, 5, "k"), 2: (f"{clean}. ! {clean} é", 5, "k"), 4: (None, 5, "k"), None: ("", 5, "k")}
    empty = it.limit(0)
    assert decontaminate.decontaminate(df, empty).count() == 5
    assert decontaminate.decontaminate(df.limit(0), it).count() == 0


# ---- BPE ------------------------------------------------------------------------

@pytest.fixture(scope="module")
def reference_encoding():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_tiktoken_and_round_trips(spark, reference_encoding):
    rng = random.Random(1)
    pick = lambda: chr(rng.choice([rng.randrange(1, 0x250), rng.randrange(1, 128), rng.randrange(0x300, 0xD7FF),
                                   rng.randrange(0x10000, 0x1F9FF), 32, 10, 97]))
    texts = ["", None, "a" * 3000, " " * 700 + "x", "日本語テスト" * 300, "\x1c\x1d​﻿ x\x85y", "<|endoftext|> hi",
             "½²³ 12٣٤ ª º µ ×÷", "é x'll 'RE\t\t\n x", "ab" * 5000,
             *["".join(pick() for _ in range(rng.randrange(1, 80))) for _ in range(200)],
             *[t for _, t, *_ in rows(spark, "documents")]]
    df = frame(spark, list(enumerate(texts))).selectExpr("doc_id", "text", "1 AS decoded", "2 AS extra")
    out = bpe.decode(bpe.encode(df.drop("decoded")))
    seen = 0
    for r in out.collect():
        assert list(r.token_ids) == reference_encoding.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()
        seen += 1
    assert seen == len(texts) and bpe.encode(df.limit(0)).count() == 0
    null = spark.createDataFrame([(1, None)], "doc_id long, token_ids array<int>")
    assert bytes(bpe.decode(null).first().decoded) == b""


def test_bpe_query_digests(spark, reference_encoding):
    text = dict((d, t or "") for d, t, *_ in rows(spark, "documents"))
    for r in queries()["op6_bpe"](spark, DATA).collect():
        ids = reference_encoding.encode_ordinary(text[r.doc_id])
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), brute.sha(",".join(map(str, ids)).encode()), brute.sha(text[r.doc_id].encode()))


# ---- decontamination over many blocks ------------------------------------------

def test_decontamination_by_segments_groups_and_id_types(spark, monkeypatch):
    # Items of many segments, many blocks, several groups of them, string ids with ties of the text.
    monkeypatch.setattr(decontaminate, "SEGMENT", 7)
    monkeypatch.setattr(decontaminate, "GROUP", 2)
    docs, items = leaks()
    named = [(None if i is None else f"item-{i}", t) for i, t in items]
    it = spark.createDataFrame(named, "item_id string, text string")
    out = decontaminate.annotate(frame(spark, docs), it, block_bytes=400)
    got = [(r.doc_id, r.n_words, {p for s in r.spans for p in range(s.start, s.end)}, set(r["items"]))
           for r in out.collect()]
    assert sorted(got, key=str) == sorted(brute.contamination(docs, named), key=str)
    assert any(x[3] for x in got)


def test_automaton_is_small_and_bounded():
    rng = random.Random(4)
    texts = [(k, " ".join(f"w{rng.randrange(3000)}" for _ in range(200)).encode()) for k in range(500)]
    packed = decontaminate.build_automaton(texts, 10)
    size = sum(len(t) + 1 for _, t in texts)
    auto = decontaminate.Automaton(packed, list(range(500)))
    assert len(auto.length) <= size and len(packed) < 14 * size
    n, spans, items = auto.match(texts[7][1] + b" unseen " + texts[3][1][:60])
    assert spans[0] == [0, 200] and 7 in items and n > 200
