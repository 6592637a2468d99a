import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from metrolake.llm import htmltext, langid, lm, pivots, quality, sharding
from tests.llm import brute

DATA = "/root/testdata/sf0.001"


def table(spark, name):
    return spark.read.parquet(f"{DATA}/{name}.parquet")


# ---- quality ------------------------------------------------------------------

def test_quality_log_probability_equals_brute_force(spark):
    texts = [r.text for r in table(spark, "documents").select("text").limit(60).collect()]
    docs = [(k, t, "en" if k % 2 else "de") for k, t in enumerate(texts)] + [
        (900, None, "en"), (901, "", None), (902, "unseen ☃ snow ☃", None), (None, texts[0], "en"),
        (3, texts[3], "en"), (3, texts[3], "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(k, 1 if k < 40 else 0) for k in range(60)] + [(None, 1), (5, 1), (41, None)],
                                   "doc_id long, quality int")
    out = quality.classify(df, labels, min_trusted=5).collect()
    # All rows of a trusted id are trusted.
    model = brute.kneser_ney([t for k, t, _ in docs if k is not None and k < 40])
    want = {(k, t or "", y) for k, t, y in docs}
    assert len(out) == len(want)
    by_key = {}
    for r in out:
        by_key.setdefault((r.doc, r.lang), []).append(r)
    for k, t, y in want:
        r = by_key[k, y][0]
        # Rows with equal id and text add up alike in both sums.
        times = r.n_chars // len(t) if t else 1
        assert r.n_chars == len(t) * times
        if t:
            assert r.log_prob / times == pytest.approx(model(t), rel=1e-9)
            assert r.perplexity == pytest.approx(math.exp(-model(t) / len(t)), rel=1e-9)
        else:
            assert r.perplexity is None and r.kept


def test_quality_limits_equal_brute_force_by_halves(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in table(spark, "documents").collect()]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(k, int(k % 4 > 0)) for k in range(150)], "doc_id long, quality int")
    ids = [k for k in range(150) if k % 4]
    half = {r.k: r.half for r in spark.createDataFrame([(k,) for k in ids], "k long").selectExpr(
        "k", "pmod(xxhash64(1, k), 2) AS half").collect()}
    models = [brute.kneser_ney([t for k, t, _ in docs if half.get(k) == h]) for h in (0, 1)]
    whole = brute.kneser_ney([t for k, t, _ in docs if k in half])
    e = [(y, -models[1 - half[k]](t) / len(t)) for k, t, y in docs if k in half and t]
    limits = {}
    for y in {y for *_, y in docs}:
        mine = [x for z, x in e if z == y]
        mine = mine if len(mine) >= 20 else [x for _, x in e]
        mid, high = np.quantile(mine, [0.5, 0.99])
        limits[y] = mid, mid + (high - mid) * 2
    out = {r.doc: r for r in quality.classify(df, labels, min_trusted=20).collect()}
    for k, t, y in docs:
        mid, top = limits[y]
        assert out[k].top == pytest.approx(top, rel=1e-9)
        entropy = (20 * mid - whole(t)) / (len(t) + 20)
        assert out[k].entropy == pytest.approx(entropy, rel=1e-9) and out[k].kept == (entropy <= top)
    assert len({t for _, t in limits.values()}) > 1


@pytest.mark.parametrize("grams, packed", [(quality.SHARD_GRAMS, quality.MAX_PACKED), (50, 100)])
def test_quality_learns_from_all_trusted_texts(spark, monkeypatch, grams, packed):
    # More labelled texts than any sample held; also with more shards than the least number, and ids joined by shuffle.
    monkeypatch.setattr(quality, "SHARD_GRAMS", grams)
    monkeypatch.setattr(quality, "MAX_PACKED", packed)
    rng = random.Random(5)
    docs = [(k * 10**14 - 10**18, "".join(rng.choices("abcdefghij", k=3)), "en") for k in range(20_500)]
    labels = spark.createDataFrame([(k, 1) for k, *_ in docs], "doc_id long, quality int")
    out = {r.doc: r for r in quality.classify(spark.createDataFrame(docs, "doc_id long, text string, lang string"),
                                              labels).collect()}
    model = brute.kneser_ney([t for _, t, _ in docs])
    assert len(out) == len(docs)
    for k, t, _ in docs[::100]:
        assert out[k].log_prob == pytest.approx(model(t), rel=1e-9)
    own = [-model(t) / len(t) for _, t, _ in docs]
    half = {r.k: r.half for r in spark.createDataFrame([d[:1] for d in docs], "k long").selectExpr(
        "k", "pmod(xxhash64(1, k), 2) half").collect()}
    models = [brute.kneser_ney([t for k, t, _ in docs if half[k] == h]) for h in (0, 1)]
    mid, high = np.quantile([-models[1 - half[k]](t) / len(t) for k, t, _ in docs], [0.5, 0.99])
    assert out[docs[0][0]].top == pytest.approx(mid + (high - mid) * 2, rel=1e-9)
    assert [out[k].kept for k, *_ in docs] == [
        (e * len(t) + 20 * mid) / (len(t) + 20) <= mid + (high - mid) * 2 for (_, t, _), e in zip(docs, own, strict=True)]


def test_quality_separates_labelled_junk(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    # The classifier learns from even ids only.
    out = quality.classify(docs, labels.filter("doc_id % 2 = 0")).selectExpr("doc AS doc_id", "kept")
    n = {(r.quality, r.kept): r["count"] for r in out.join(labels.filter("doc_id % 2 = 1"), "doc_id")
         .groupBy("quality", "kept").count().collect()}
    assert n[1, True] / (n[1, True] + n.get((1, False), 0)) > 0.97
    assert n[0, False] / (n[0, False] + n.get((0, True), 0)) > 0.7


def test_quality_of_a_script_with_thousands_of_characters(spark):
    rng = random.Random(6)
    chars = [chr(0x4E00 + k) for k in rng.sample(range(20_000), 3000)] + [chr(0x20000 + k) for k in range(100)]
    lexicon = [a + b for a, b in zip(chars[::2], chars[1::2], strict=True)]
    follow = [rng.sample(range(len(lexicon)), 4) for _ in lexicon]  # four words may follow a word, or sometimes any

    def text(odd):
        w = [rng.randrange(len(lexicon))]
        for _ in range(199):
            w.append(rng.randrange(len(lexicon)) if rng.random() < odd else rng.choice(follow[w[-1]]))
        return "".join(lexicon[k] for k in w)
    good = [text(0.3 * rng.random()) for _ in range(160)]
    junk = ["".join(rng.choices(chars, k=400)) for _ in range(40)]
    latin = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=1000)) for _ in range(60)]
    docs = [(k, t, "zh" if t[0] > "z" else "en") for k, t in enumerate([*good[:120], *latin, *good[120:], *junk])]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    labels = spark.createDataFrame([(k, 1) for k in range(180)], "doc_id long, quality int")
    out = {r.doc: r for r in quality.classify(df, labels).collect()}
    model = brute.kneser_ney([t for k, t, _ in docs if k < 180], alphabet=1 << 20, base=4096)
    for k, t, _ in docs[::7]:
        assert out[k].log_prob == pytest.approx(model(t), rel=1e-9)
    assert [out[k].kept for k in range(180, 220)].count(True) >= 38
    assert [out[k].kept for k in range(220, 260)].count(True) == 0


def test_quality_without_trust_or_rows(spark):
    df = spark.createDataFrame([(1, "abc", "en", 5), (2, None, None, 6)], "doc_id long, text string, lang string, h int")
    none = spark.createDataFrame([], "doc_id long, quality int")
    kept = quality.filter_quality(df, none)
    assert kept.columns == df.columns and kept.count() == 2
    assert quality.filter_quality(df.limit(0), none).count() == 0


# ---- sharding -------------------------------------------------------------------

def check_shards(out, docs, shards=8):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in out) == sorted(
        (str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    slots = {}
    for r in out:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(docs)


@pytest.mark.parametrize("hot", [0, 300])
def test_sharding_law_slots_and_groups(spark, hot):
    docs = [(k, f"text {k}") for k in range(400)] + [(1000 + k, f"copy é {k % 40}") for k in range(200)]
    docs += [(5000 + k, "one group of very many") for k in range(hot)] + [(None, None), (7, ""), (None, "x"), (7, "")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    out = sharding.with_slots(sharding.shard_documents(df)).collect()
    check_shards(out, docs)
    where = {}
    text = dict(docs)
    for r in out:
        where.setdefault(text.get(r.doc_id), set()).add(r.shard)
    split = [t for t, s in where.items() if t and t.startswith("copy") and len(s) > 1]
    assert len(split) <= 6
    if hot:  # a group larger than a shard takes whole shards and little else
        assert len(where["one group of very many"]) <= 5


def test_propagation_cuts_fewer_links(spark):
    rng = random.Random(2)
    n = Counter((g, rng.randrange(8)) for g in range(60) for _ in range(rng.randrange(2, 12)))
    state = spark.createDataFrame([(g, s, k) for (g, s), k in n.items()], "g long, shard int, n long")
    total = sum(n.values())
    after = sharding.propagate(state, [total // 8 + 1] * 8, rounds=6)
    assert sharding.cut_edges(after) < 0.25 * sharding.cut_edges(state)
    assert after.groupBy("g").sum("n").count() == 60
    assert after.agg({"n": "sum"}).first()[0] == total
    load = [r["sum(n)"] for r in after.groupBy("shard").sum("n").collect()]
    assert max(load) <= 1.5 * total / 8


def test_sharding_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sharding.with_slots(sharding.shard_documents(df)).count() == 0


# ---- language -----------------------------------------------------------------------

def test_langid_held_out_accuracy_and_rejection(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit(docs.filter(langid.fold("doc_id", 3) != 1), "doc_id", "text", "lang")
    got = langid.predict(docs.withColumnRenamed("lang", "y"), model).filter(langid.fold("doc_id", 3) == 1).collect()
    right = [r for r in got if r.lang_pred == r.y]
    assert len(right) / len(got) > 0.98 and all(0 <= r.score <= 1 for r in got)
    sure = [r for r in got if r.accepted]
    assert sum(r.lang_pred == r.y for r in sure) / len(sure) >= len(right) / len(got)


@pytest.mark.parametrize("k", [1, 7, 50])
def test_langid_sample_is_the_least_hashed_rows(spark, k):
    rows = [(i, "en") for i in range(3000)] + [(i, "de") for i in range(5000, 5040)] + [(9999, "fr")] * 30
    df = spark.createDataFrame(rows, "i long, y string").repartition(5)
    h = {r.i: r.h for r in df.selectExpr("i", "xxhash64(i) AS h").distinct().collect()}
    want = set()
    for lang in ("en", "de", "fr"):
        want.update(sorted((i for i, y in rows if y == lang), key=lambda i: (h[i], i))[:k])
    assert {r.si for r in langid._least_hashed(df, k).collect()} == want


def test_langid_cases(spark, monkeypatch):
    docs = [(k, f"the cat {k} and the dog", "en") for k in range(40)] + [
        (100 + k, f"der Hund {k} und die Katze", "de") for k in range(40)] + [(300, None, "en"), (None, "xx", "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    model = langid.fit(df, "doc_id", "text", "lang", max_train=40)
    ask = spark.createDataFrame([(1, None, 1.0), (2, "", 1.0), (3, "12 34 !?", 1.0), (4, "the dog", 1.0), (5, "É", 1.0),
                                 (None, "der Hund und", 1.0)], "doc_id long, text string, score double")
    got = [(r.lang_pred, r.score) for r in langid.predict(ask, model).collect()]
    assert [y for y, _ in got][:4] == ["und", "und", "und", "en"] and got[5][0] == "de" and got[4][0] in ("en", "de")
    assert got[0][1] == 0
    nothing = langid.fit(df.limit(0), "doc_id", "text", "lang")
    assert {r.lang_pred for r in langid.predict(ask, nothing).collect()} == {"und"}
    text = "Über alles und die ganze Welt " * 30
    whole = langid.subword_counts(text)
    monkeypatch.setattr(langid, "BLOCK", 61)  # a long text in pieces counts alike
    assert all((a == b).all() for a, b in zip(whole, langid.subword_counts(text), strict=True))


# ---- language model -------------------------------------------------------------------

def brute_lm(docs):
    train = [t for i, t in docs if i is not None and zlib.crc32(str(i).encode()) % 10]
    one, two, ctx = Counter(), Counter(), Counter()
    for t in train:
        w = brute.tokens(t)
        one.update(w)
        two.update(zip(["START", *w], w, strict=False))
        ctx.update(["START", *w[:-1]])
    n, v = sum(one.values()), len(one)
    hist = Counter()
    for t in train:
        w = brute.tokens(t)
        for h, x in zip(["START", *w], w, strict=False):
            c = ctx[h] - 1
            p2 = (two[h, x] - 1) / c if c else 0.0
            q = np.array([c]), np.array([p2]), np.array([(one[x] - 1) / (n - 1)])
            hist[int(lm._bucket(q[0])[0]), int(lm._bin(q[1])[0]), int(lm._bin(q[2])[0])] += 1
    z = lm.ZERO + 1
    lam = np.tile([0.0, 0, 1], (lm.BUCKETS, 1))
    if n:
        lam = lm.mixture(np.array([(b * z + a) * z + c for b, a, c in hist]), np.array(list(hist.values()), float),
                         1 / (v + 1))
    out = []
    for i, t in docs:
        w, base, score = brute.tokens(t), 0.0, 0.0
        for h, x in zip(["START", *w], w, strict=False):
            c = ctx[h]
            k = lam[int(lm._bucket(np.array([c]))[0])]
            base += math.log10((one[x] + 0.1) / (n + 0.1 * (v + 1)))
            score += math.log10(k[0] * two[h, x] / max(c, 1) + k[1] * one[x] / max(n, 1) + k[2] / (v + 1))
        out.append((i, i is not None and zlib.crc32(str(i).encode()) % 10 == 0, len(w), sum(one[x] > 0 for x in w), n,
                    base, score))
    return out


def test_lm_equals_brute_force_over_many_blocks(spark, monkeypatch):
    docs = [(r.doc_id, r.text) for r in table(spark, "documents").collect()][:120]
    docs += [(500, None), (501, ""), (None, docs[0][1]), docs[4], docs[4], (502, " ".join(["Same"] * 3000))]
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 2000)
    monkeypatch.setattr(lm, "SHARD_TOKENS", 9000)
    got = lm.lm_scores(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    key = lambda r: (str(r[0]), r[2], r[5])
    for a, b in zip(sorted(map(tuple, got.collect()), key=key), sorted(brute_lm(docs), key=key), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)
    held = [r for r in got.collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_lm_without_training_text(spark):
    df = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert sorted((r.n_tokens, r.train_tokens, r.base_score, r.score) for r in lm.lm_scores(df).collect()) == [
        (1, 0, 0.0, 0.0), (3, 0, 0.0, 0.0)]
    assert lm.lm_scores(df.limit(0)).count() == 0


def test_mixture_learns_the_weights_that_made_the_counts():
    key = np.array([(3 * (lm.ZERO + 1) + 4) * (lm.ZERO + 1) + 40, (3 * (lm.ZERO + 1) + lm.ZERO) * (lm.ZERO + 1) + 40])
    lam = lm.mixture(key, np.array([900.0, 100.0]), 1e-6)
    assert lam[3][0] == pytest.approx(0.9, abs=0.02) and lam[3].sum() == pytest.approx(1)


# ---- embeddings -------------------------------------------------------------------------

def brute_links(vecs, threshold=0.9):
    ok = [k for k, (_, v) in enumerate(vecs) if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    x = np.array([vecs[k][1] for k in ok])
    x /= np.linalg.norm(x, axis=1)[:, None]
    s = x @ x.T >= threshold
    np.fill_diagonal(s, False)
    links = [(ok[a], ok[b]) for a, b in zip(*np.nonzero(s), strict=True)]
    return links


def vectors(seed=4):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(500, 16))
    out = [x[k] for k in range(500)]
    for k in range(0, 200):  # pairs at and above the threshold, as well as copies and multiples
        u = rng.normal(size=16)
        u -= u @ x[k] / (x[k] @ x[k]) * x[k]
        c = rng.choice([0.9005, 0.92, 0.97, 0.8995])
        out.append(c * x[k] / np.linalg.norm(x[k]) + math.sqrt(1 - c * c) * u / np.linalg.norm(u))
    out += [x[3], x[3], 2.5 * x[3], *(x[9] + rng.normal(size=(120, 16)) * 0.01)]
    rows = [(k, v.tolist()) for k, v in enumerate(out)]
    return rows + [(5000, None), (5001, [0.0] * 16), (5002, [float("nan")] * 16), (5003, [None] * 16), (5004, []),
                   (None, x[9].tolist()), (5005, [float("inf")] * 16), (3, x[3].tolist())]


@pytest.mark.parametrize("params", [{}, {"block_rows": 23}, {"key_pivots": 2, "block_rows": 40}])
def test_embedding_components_recall(spark, params):
    vecs = vectors()
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>").repartition(3)
    out = pivots.embedding_components(df, **params).collect()
    want = brute_links(vecs)
    n = Counter(a for a, _ in want)
    assert len(out) == len(vecs)
    found = sum(r.n_links for r in out)
    assert found >= 0.97 * len(want) and found <= len(want)
    # Never a link below the threshold: no vector has more links than brute force gives its id.
    most = Counter()
    for k, (i, _) in enumerate(vecs):
        most[i] = max(most[i], n[k])
    assert all(r.n_links <= most[r.vec_id] for r in out)
    comp = brute.components(range(len(vecs)), want)
    hub = {r.component_id for r in out if r.vec_id is not None and 703 <= r.vec_id < 823}
    assert hub == {min(vecs[k][0] for k in range(len(vecs)) if comp[k] == comp[9] and vecs[k][0] is not None)}
    assert all(r.n_links == 0 and r.kept for r in out if (r.vec_id or 0) >= 5000)


def test_embedding_recall_where_a_third_are_near_copies(spark):
    rng = np.random.default_rng(8)
    unit = lambda x: x / np.linalg.norm(x, axis=1)[:, None]
    n, m, dim = 10_000, 3_333, 64
    centre, noise = unit(rng.normal(size=(1, dim))), rng.normal(size=(m, dim))
    noise = unit(noise - noise @ centre.T * centre)
    x = np.r_[0.97 * centre + math.sqrt(1 - 0.97 ** 2) * noise, unit(rng.normal(size=(n - m, dim)))]  # cosines near 0.94
    want = np.concatenate([(x[a:a + 1000] @ x.T >= 0.9).sum(axis=1) - 1 for a in range(0, n, 1000)])
    df = spark.createDataFrame(enumerate(x.tolist()), "vec_id long, embedding array<double>").repartition(4)
    out = {r.vec_id: r for r in pivots.embedding_components(df).collect()}
    got = np.array([out[k].n_links for k in range(n)])
    assert (got <= want).all() and got.sum() >= 0.99 * want.sum(), got.sum() / want.sum()
    assert {out[k].component_id for k in range(m)} == {0}


def test_embeddings_of_nothing(spark):
    df = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert [tuple(r) for r in pivots.embedding_components(df).collect()] == [(1, 0, 1, True)]
    assert pivots.embedding_components(df.limit(0)).count() == 0


# ---- HTML ---------------------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="no-sidebar">
<header><h1>Site</h1></header><div class="layout has-sidebar"><main><article class=post><header><h1>Title &amp; more</h1>
<p>By me</p></header><div><p>Para&nbsp;one <i>it</i>alic<br>x &lt;b&gt;<p>two
 lines<ul><li>a<li>b</ul><div class="ad-slot">Buy</div><form>f<input></form></div></article>
<section id="comments"><article>c1</article><article>c2</article></section></main><aside>z</aside></div>
<div class="cookie-notice">We use</div><!-- <p>no</p> --><script>if(a<b){"</p>"}</script><footer>&copy; F</footer></body>"""


def test_page_text():
    read = lambda s: htmltext.read(s).text()
    assert read(PAGE) == "Title & more\nPara one italic x <b>\ntwo lines\na\nb"
    assert read("<p>Hello <b>w</b>orld</p>tail a < b") == "Hello world\ntail a < b"
    assert read("") == read(None) == ""
    assert read("<p class='x\"y>broken") == "broken"
    assert read("<article><p>one<p>cut of") == "one\ncut of"
    assert read("<div>" * 5000 + "deep") == "deep"
    assert read("<table><tr><td>a<td>b<tr><td>c</table>") == "a\nb\nc"


def test_site_template_is_removed_by_host(spark):
    rows = []
    for k in range(30):
        own = f"<div class=x><p>Story {k} of its own</p></div><p>And more of {k}.</p>"
        rows.append((k, f"http://A.example/{k}", f"<body><div><p>Welcome to this site</p></div>{own}<div>Bye all</div>"))
    rows += [(100 + k, f"https://u@b.example:8{k}/", f"<article><p>Same line</p><p>Body {k}</p></article>") for k in range(9)]
    rows += [(200, None, "<p>Welcome to this site</p>"), (201, "http://c.example", None), (202, "x", ""), (None, None, None),
             (0, "http://A.example/0", rows[0][2])]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn(
        "template", htmltext.F.lit(1)).repartition(3)
    got = {r.page_id: r.text for r in htmltext.extract(df).collect()}
    assert got[4] == "Story 4 of its own\nAnd more of 4." and got[0] == "Story 0 of its own\nAnd more of 0."
    assert got[103] == "Same line\nBody 3"  # an article's paragraphs may repeat
    assert got[200] == "Welcome to this site" and got[201] == got[202] == got[None] == ""
    assert htmltext.extract(df).count() == len(rows)
    assert htmltext.extract(df.limit(0)).count() == 0


def test_template_of_a_section_of_a_large_host(spark):
    # Menus on 2 % of 3,000 pages and a notice on 10 of them go as on a small host; a block on 2 pages stays.
    rows = []
    for k in range(3000):
        menu = f"<div><p>All of section {k % 50}</p></div>"
        rare = "<p>Closed today</p>" if k % 300 == 7 else f"<p>Said twice {k // 2}</p>" if k % 300 < 2 else ""
        rows.append((k, "http://big.example/", f"<body>{menu}<div><p>Story {k}.</p></div>{rare}</body>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    got = {r.page_id: r.text for r in htmltext.extract(df).collect()}
    assert got == {k: f"Story {k}." + (f"\nSaid twice {k // 2}" if k % 300 < 2 else "") for k in range(3000)}


def test_layout_and_names_lose_no_text():
    read = lambda s: htmltext.read(s).text()
    body = "<h1>Title</h1><p>A long paragraph of the page's own text, all of it.</p>"
    text = "Title\nA long paragraph of the page's own text, all of it."
    for open_, close in (("<form id='aspnetForm'>", "</form>"), ("<div class='page has-sidebar'>", "</div>"),
                         ("<div class='no-comments'>", "</div>"), ("<div class='content-sidebar-wrap'>", "</div>"),
                         ("<div id='mainBanner'>", "</div>"), ("<fieldset><form>", "</form></fieldset>")):
        assert read(f"<body>{open_}{body}{close}<div class='site-footer'>Imprint</div></body>") == text
    assert read("<div class='overlay'><p>All there is</p></div>") == "All there is"  # names never take all
    assert read("<nav><p>Only a menu</p></nav>") == ""
    assert read("<article><p class='notice-period'>Three months.</p><div class='alert'>Mind this.</div></article>") == \
        "Three months.\nMind this."
    assert read("<article class='ad-free'><p>one</p></article><article><p>two</p></article>") == "one\ntwo"
    assert read("<article><p>x</p><div id='siteComments'>c</div><div class='ad-slot left'>b</div></article>") == "x"
    assert read("<p>x</p><div class='cookie-notice'>c</div><div class='alert'>b</div><form>f</form>") == "x"


def test_headings_cells_and_items_are_no_template(spark):
    rows = [(k, "http://t.example/", f"<body><h2>Introduction</h2><p>Own text {k}.</p><table><tr><td>Status<td>"
             f"{'Yes' if k % 2 else 'No'}<td>{k}</table><ul><li>same<li>{k}</ul></body>") for k in range(12)]
    # A paragraph on 3 of a hundred pages among paragraphs of their own stays, and a long page comes back whole.
    rows += [(100 + k, "http://u.example/", f"<body><p>{'Once more.' if k < 3 else f'Line {k}.'}</p><p>End {k}.</p></body>")
             for k in range(100)]
    rows.append((999, "http://v.example/", "<p>" + "word " * 400_000 + "</p>"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in htmltext.extract(df).collect()}
    for k in range(12):
        assert got[k] == f"Introduction\nOwn text {k}.\nStatus\n{'Yes' if k % 2 else 'No'}\n{k}\nsame\n{k}"
    assert [got[100 + k] for k in range(100)] == [f"{'Once more.' if k < 3 else f'Line {k}.'}\nEnd {k}." for k in range(100)]
    assert got[999] == ("word " * 400_000).strip()


def brute_template(rows, min_pages=3, min_share=0.5, min_pure=0.5):
    """{host: {(hash, place)}} by counting in plain Python."""
    mains, any_, at = {}, {}, {}
    for _, host, h, place, main in rows:
        mains.setdefault(host, set()).add(main)
        any_.setdefault((host, h), set()).add(main)
        at.setdefault((host, place), {}).setdefault(h, set()).add(main)
    out = {}
    for (host, place), hs in at.items():
        total, again = sum(map(len, hs.values())), sum(len(x) for x in hs.values() if len(x) > 1)
        for h, x in hs.items():
            n = len(any_[host, h])
            if len(x) >= min_pages and again >= total * min_pure or n >= min_pages and n >= min_share * len(mains[host]):
                out.setdefault(host, set()).add((h, place))
    return out


def test_site_template_equals_brute_force(spark):
    rng = random.Random(8)
    rows = []
    for k in range(200):
        site = rng.choice(["a", "b", "c"])
        parts = [f"<div class='m{rng.randrange(9)}'><p>menu {rng.randrange(4)}</p></div>", f"<p>own {k}</p>",
                 rng.choice(["<p>shared</p>", f"<p>pair {k // 2}</p>", "<section><p>box</p><h2>x</h2></section>"]),
                 f"<div><ul><li>{rng.randrange(3)}</ul></div>"]
        rng.shuffle(parts)
        page = "".join(parts)
        rows.append((k, f"http://{site}.example/{k}", f"<article>{page}</article>" if rng.random() < 0.3 else page))
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    found = [tuple(r) for r in htmltext.subtree_rows(df).collect()]
    want = brute_template(found)
    got = {}
    for r in htmltext.site_template(spark.createDataFrame(found, "page long, host long, hash long, place long, main long"),
                                    3, 0.5, 0.5).collect():
        got.setdefault(r.host, set()).add((r.hash, r.place))
    assert got == want and sum(map(len, want.values())) > 20
    key = {r.page_id: (r.h, r.page) for r in df.select(
        "page_id", htmltext._key().alias("page"), htmltext.F.xxhash64(htmltext.host(htmltext.F.col("url"))).alias("h")).collect()}
    texts = {r.page_id: r.text for r in htmltext.extract(df).collect()}
    for k, _, source in rows:
        assert texts[k] == htmltext.read(source).text(frozenset(want.get(key[k][0], ())))


def test_given_pages(spark):
    out = htmltext.extract(table(spark, "pages")).join(table(spark, "pages").select("page_id", "html"), "page_id")
    for r in out.collect():
        body = r.html[r.html.index("<article>"):r.html.index("</article>")]
        blocks = htmltext.re.split(r"</?(?:p|h1)>", body)
        plain = [" ".join(htmltext._html.unescape(htmltext.re.sub(r"<[^>]*>", " " if "<br>" in b else "", b)).split())
                 for b in blocks]
        assert r.text == "\n".join(b for b in plain if b)
