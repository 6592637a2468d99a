import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from metrolake.llm import alignment

DATA = "/root/testdata/sf0.001"
A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(A_PATH)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B_PATH)


def letters():
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    out, n = {chr(b): b for b in own}, 0
    for b in range(256):
        if b not in own:
            out[chr(256 + n)] = b
            n += 1
    return out


def ranges(tokens):
    at, out = 0, []
    for t in tokens:
        out.append((at, at + len(t)))
        at += len(t)
    return out


def brute(docs, tokenizers):
    """[(id, text)] -> rows as the query has them; every pair of tokens of a group is compared."""
    a, b = tokenizers
    letter, found, held = letters(), [], Counter()
    for i, text in docs:
        found.append((i, [], [], [], []))
        if not text:
            continue
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ta = [bytes(letter[c] for c in a.id_to_token(x)) for x in ia]
        tb = [bytes([int(b.id_to_piece(x)[3:5], 16)]) if b.is_byte(x) else b.id_to_piece(x).replace("▁", " ").encode()
              for x in ib]
        if not b"".join(ta) == b"".join(tb) == (" " + text).encode():
            continue
        ra, rb = ranges(ta), ranges(tb)
        cuts = sorted({z for _, z in ra} & {z for _, z in rb})
        ga, gb = defaultdict(list), defaultdict(list)
        for k, (_, z) in enumerate(ra):
            ga[next(c for c in cuts if c >= z) if len(cuts) < 60 else cuts[int(np.searchsorted(cuts, z))]].append(k)
        for k, (_, z) in enumerate(rb):
            gb[cuts[int(np.searchsorted(cuts, z))]].append(k)
        links = [(ia[x], ib[y]) for c in cuts for x in ga[c] for y in gb[c]
                 if max(ra[x][0], rb[y][0]) < min(ra[x][1], rb[y][1])]
        found[-1] = (i, ia, ib, [([ia[x] for x in ga[c]], [ib[y] for y in gb[c]]) for c in cuts], links)
        held.update(set(links))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    out = []
    for i, ia, ib, groups, links in found:
        digest = ";".join("|".join(",".join(map(str, s)) for s in g) for g in groups)
        out.append((i, len(ia), len(ib), len(groups), len(links), sum(held[p] == best[p[0]] for p in links),
                    sum(held[p] for p in links), hashlib.sha256(digest.encode()).hexdigest() if ia else ""))
    return sorted(out, key=str)


def odd_docs():
    rng = random.Random(2)
    texts = [None, "", " ", "a", "  two  spaces ", "\n\n", "tab\there", "▁ own sign", "<|endoftext|> <s> </s> <unk> <0x41>",
             "\x00 zero", "é ü ﬁ ﬀ ½ Ⅷ", "日本語のテキストと中文", "русский текст", "\U0001f600 \U0001f9d1‍\U0001f4bb",
             "x" * 3000, "word " * 5000, " " * 3000 + "end", "１２３ full width", "café café", "12345 678.90", "a b c"]
    texts += ["".join(rng.choices("abc dé\n.,'日\U0001f600 the", k=rng.randrange(1, 60))) for _ in range(120)]
    return [(k if k % 20 else None, t) for k, t in enumerate(texts)] + [(3, "a"), (3, "a")]


def got(df):
    return sorted([(r.doc, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)
                   for r in df.collect()], key=str)


def test_score_equals_brute_force(spark, tokenizers, monkeypatch):
    docs = odd_docs()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    want = brute(docs, tokenizers)
    assert got(alignment.score(df)) == want
    monkeypatch.setattr(alignment, "BLOCK_CHARS", 300)  # many blocks
    assert got(alignment.score(df)) == want


def test_score_equals_brute_force_on_given_documents(spark, tokenizers):
    df = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text")
    want = brute([tuple(r) for r in df.filter("length(text) < 8000").collect()], tokenizers)
    assert got(alignment.score(df.filter("length(text) < 8000"))) == want


def test_align_gives_groups_and_keeps_columns(spark, tokenizers):
    docs = spark.createDataFrame(odd_docs(), "doc_id long, text string").withColumns(
        {"t": F.lit(7), "row": F.lit("r"), "b_ids": F.lit(1)})
    out = alignment.align(docs)
    assert out.columns == ["doc_id", "text", "t", "row", "a_ids", "b_ids", "a_sizes", "b_sizes"]
    rows = out.collect()
    assert len(rows) == docs.count() and all(r.t == 7 and r["row"] == "r" for r in rows)
    mine = []
    for r in rows:
        assert sum(r.a_sizes) == len(r.a_ids) and sum(r.b_sizes) == len(r.b_ids) and len(r.a_sizes) == len(r.b_sizes)
        i = j = 0
        parts = []
        for p, q in zip(r.a_sizes, r.b_sizes, strict=True):
            parts.append(",".join(map(str, r.a_ids[i:i + p])) + "|" + ",".join(map(str, r.b_ids[j:j + q])))
            i, j = i + p, j + q
        mine.append((r.doc_id, hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else ""))
    assert sorted(mine, key=str) == sorted([(w[0], w[-1]) for w in brute(odd_docs(), tokenizers)], key=str)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.score(none).count() == 0 and alignment.align(none).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert got(alignment.score(nothing)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_walk_finds_every_common_end():
    rng = np.random.default_rng(1)
    for n in [1, 2, 3, 10, 200, 2000] * 5:
        ends = np.cumsum(rng.integers(1, 4, n))
        ea = np.union1d(ends[rng.random(n) < rng.choice([0.1, 0.5, 0.9, 1.0])], ends[-1:])
        eb = np.union1d(ends[rng.random(n) < rng.choice([0.1, 0.5, 0.9, 1.0])], ends[-1:])
        p, q = alignment.group_sizes(ea, eb)
        both = np.intersect1d(ea, eb)
        assert (ea[np.cumsum(p) - 1] == both).all() and (eb[np.cumsum(q) - 1] == both).all()
        ia, ib = alignment.linked_tokens(ea, eb, p, q)
        sa, sb = np.append(0, ea), np.append(0, eb)
        want = {(x, y) for x in range(len(ea)) for y in np.flatnonzero((sb[:-1] < ea[x]) & (eb > sa[x])).tolist()}
        assert len(ia) == len(want) and set(zip(ia.tolist(), ib.tolist(), strict=True)) == want


def test_rank_form_equals_the_json_tokenizer(tokenizers):
    a = alignment.ByteLevel(open(A_PATH, encoding="utf-8").read())
    assert a.fast is not None
    points = [c for c in range(1, 0x3000) if not 0xD800 <= c < 0xE000] + list(range(0x3000, 0x110000, 97))
    texts = [f"x{chr(c)}{chr(c)} 1{chr(c)} .{chr(c)}  {chr(c)}a" for c in points if not 0xD800 <= c < 0xE000]
    texts += ["it's we'll  \n\n x'S   ", "a" * 5000, " \n" * 900 + "x"]
    want = [e.ids for e in tokenizers[0].encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in a.encode(texts)] == want
    assert a.encode([" " * 1_000_000])[0].tolist() == tokenizers[0].encode(" " * 1_000_000, add_special_tokens=False).ids
