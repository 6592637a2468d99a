import base64

import public_tokenizers
import tiktoken

import corpus_pipeline
from metrolake.llm import quality
from tests.llm import brute

DATA = "/root/testdata/sf0.001"


def rows(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_each_stage_equals_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").select("item_id", "text").collect()]
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        had = rows(docs)
        if name == "quality_classifier":
            model = brute.kneser_ney([t for i, t in had if i in good])
            limit = {r.doc: (r.entropy, r.top) for r in quality.classify(docs, labels).collect()}
            for i, t in had:
                mid = (limit[i][0] * (len(t) + 20) + model(t)) / 20  # the language's median, as the prior holds it
                assert limit[i][0] > 0 and 0 < mid < limit[i][1]
            want = [(i, t) for i, t in had if limit[i][0] <= limit[i][1]]
        elif name == "line_dedup":
            want = [(i, k) for i, _, k in brute.line_dedup(had)]
        elif name == "simhash_near_dedup":
            keep = {c for *_, c in brute.simhash(had)}
            want = [(i, t) for i, t in had if i in keep]
        elif name == "benchmark_decontamination":
            want = None
            texts = dict(rows(out))
            for (i, n, hit, _), (_, t) in zip(brute.contamination(had, items), had, strict=True):
                if len(hit) > 0.2 * n:
                    assert i not in texts
                else:
                    assert brute.words(texts[i]) == [w for k, w in enumerate(brute.words(t)) if k not in hit]
                    assert hit or texts[i] == t
        else:
            for r, (_, t) in zip(sorted(out.collect(), key=lambda r: r.doc_id), sorted(had), strict=True):
                assert list(r.token_ids) == enc.encode_ordinary(t) and r.round_trip and r.n_tokens == len(r.token_ids)
            return
        if want is not None:
            assert sorted(rows(out)) == sorted(want)
        assert out.columns == docs.columns and out.filter("n_chars <> length(text)").count() == 0
        docs = out


def test_stages_take_odd_rows_and_empty_tables(spark):
    odd = [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, None, "de", None, None),
           (3, "a line of text that three documents hold\nx", None, "s", 43), (None, "word " * 30000, "fr", "s", 150000),
           *[(k, f"a line of text that three documents hold\nown {k}", "en", "s", 46) for k in range(4, 8)]]
    docs = spark.createDataFrame(odd, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.selectExpr("*", "1 AS fp", "'a' AS kept", "2 AS spans", "3 AS token_ids", "4 AS h", "5 AS quality")
    for name, stage in corpus_pipeline.STAGES:
        for given in (docs, docs.limit(0)):
            out = stage(spark, given, DATA)
            n = out.count()
            assert n <= given.count() and (n or not given.count())
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns
