import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from metrolake.llm import content_sort, fim


def sha(t):
    return hashlib.sha256((t or "").encode()).hexdigest()


# ---- exact dedup ------------------------------------------------------------

def copies(docs, keep=max):
    """[(id, text)] -> sorted (id, keep id, size, sha) and how many rows stay of each (id, text)."""
    groups = defaultdict(list)
    for i, t in docs:
        groups[t or ""].append(i)
    top = {t: keep((i for i in g if i is not None), default=None) for t, g in groups.items()}
    return sorted([(i, top[t or ""], len(groups[t or ""]), sha(t)) for i, t in docs], key=str), top


def some_docs():
    rng = random.Random(1)
    head = "the same long head of very many documents " * 4
    docs = [(k, f"{head} and its own end {k % 90}") for k in range(300)]
    docs += [(1000 + k, "one hot text") for k in range(400)] + [(2000 + k, None) for k in range(30)]
    docs += [(3000 + k, "") for k in range(30)] + [(4000 + k, "x" * 200_000) for k in range(3)]
    docs += [(None, "only null ids"), (None, "only null ids"), (None, "one hot text"), (1000, "one hot text"),
             (1399, "one hot text"), (1399, "another text"), (5, "café"), (6, "café"), (7, "Café "), (8, "café")]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("partitions,hold", [(1, 10_000), (7, 10_000), (40, 10_000), (7, 3), (200, 1)])
@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_exact_dedup_equals_brute_force(spark, partitions, hold, keep):
    docs = some_docs()
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    out = content_sort.mark_copies(df, partitions=partitions, hold=hold, keep=keep).collect()
    want, top = copies(docs, max if keep == "largest" else min)
    assert sorted([(r.id, r.keep_id, r.group_size, r.sha256) for r in out], key=str) == want
    stay = [(r.sha256, r.id) for r in out if r.kept]
    assert sorted(stay, key=str) == sorted([(sha(t), i) for t, i in top.items()], key=str)


def test_exact_dedup_compares_texts_that_share_head_and_hash(spark, monkeypatch):
    # Every text of one head and one hash: only the full comparison tells them apart, at partition edges too.
    monkeypatch.setattr(content_sort.F, "xxhash64", lambda *_: content_sort.F.lit(7).cast("long"))
    docs = [(k, "h" * 64 + f" end {k % 5}") for k in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = content_sort.mark_copies(df, partitions=9).collect()
    assert sorted([(r.id, r.keep_id, r.group_size, r.sha256) for r in out], key=str) == copies(docs)[0]


def test_exact_dedup_normalises_and_keeps_columns(spark):
    docs = spark.createDataFrame([(1, "A b", "x", None), (2, "a  B", "y", 2), (3, None, "z", 3)],
                                 "doc_id long, text string, run string, `keep` long")
    out = content_sort.drop_copies(docs, normalise=lambda c: content_sort.F.lower(
        content_sort.F.regexp_replace(c, r"\s+", " ")))
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect())) == [(2, "a  B", "y", 2), (3, None, "z", 3)]
    assert content_sort.drop_copies(docs.limit(0)).count() == 0
    assert content_sort.mark_copies(docs.limit(0)).count() == 0


# ---- fill in the middle -----------------------------------------------------

UNIT = re.compile("[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def test_skip_list_equals_sums():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 9, 100, 5000):
        w = rng.integers(1, 30, n)
        lanes = fim.SkipList(w)
        assert n < 100 or len(lanes.lanes) > 2
        want = np.concatenate([[0], np.cumsum(w)])
        assert (lanes.points_before(np.arange(n + 1)) == want).all()


def odd_texts():
    rng = random.Random(4)
    out = [None, "", " ", "\n\t ", "word", " word ", "a b", "é ß \U0001f600x\ty", "has <P> in it", "<S>", "<M", "a<",
           "long " * 60_000, "y" * 100_000]
    for _ in range(300):
        out.append("".join(rng.choices("ab<>PSM \n\té \U0001f600", k=rng.randrange(40))))
    return out


def one(ident, text):
    text = text or ""
    u = UNIT.findall(text)
    d = hashlib.sha256(f"42:{'' if ident is None else ident}".encode()).hexdigest()
    h = [int(d[k:k + 8], 16) for k in (0, 8, 16, 24)]
    a, z = sorted((h[0] % (len(u) + 1), h[1] % (len(u) + 1)))
    if not text or any(m in text for m in fim.MARKS) or h[2] % 100 >= 50:
        return len(u), "plain", None, None, text
    p, m, s = "".join(u[:a]), "".join(u[a:z]), "".join(u[z:])
    if h[3] % 100 < 80:
        return len(u), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(u), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_equals_brute_force(spark):
    docs = [(k if k % 50 else None, t) for k, t in enumerate(odd_texts())]
    docs += docs[20:25]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    out = fim.fill_in_middle(df).withColumn("back", fim.restore("output", "form")).collect()
    got = sorted([(r.doc_id, r.text, r.n_units, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out], key=str)
    assert got == sorted([(i, t, *one(i, t)) for i, t in docs], key=str)
    assert {r.form for r in out} == {"plain", "spm", "psm"}
    assert all(r.back == (r.text or "") for r in out)


def test_fill_in_middle_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, "q", 1), (2, None, None, None, None)],
                                 "doc_id long, text string, n_units int, id string, `row` int")
    out = fim.fill_in_middle(docs, percent=100)
    assert out.columns == ["doc_id", "text", "id", "row", "n_units", "form", "prefix_chars", "middle_chars", "output"]
    assert {r.doc_id: (r.id, r["row"], r.n_units) for r in out.collect()} == {1: ("q", 1, 3), 2: (None, None, 0)}
    assert fim.fill_in_middle(docs.limit(0)).count() == 0
