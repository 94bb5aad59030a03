"""Input columns that are named like an operator's own, and the model's space sign."""
import random

import public_tokenizers as P
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from contractgate.llm import mixing, registry, token_count

SF = "/root/testdata/sf0.001"


def test_counts_of_texts_with_the_space_sign(spark):
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab á▁▁  ​\nń.中s") for _ in range(rng.randrange(20))) for _ in range(3000)]
    model = P.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=model)
    counter = token_count.PieceCounter(model)
    assert [counter.total(t) for t in texts] == [len(x) for x in library.encode(texts)]
    rows = spark.createDataFrame(list(enumerate(texts[:300])), "doc_id bigint, text string")
    got = {r.doc_id: r.n_tokens for r in token_count.token_counts(rows, model).collect()}
    assert got == {i: len(library.encode(t)) for i, t in enumerate(texts[:300])}


def test_mixture_keeps_columns_named_like_its_own(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clash = docs.withColumns({n: F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")) for n in ("passes", "last_key", "tokens", "budget", "key", "range", "rest")})
    plain = {r.doc_id: r.mix_copies for r in mixing.mix(docs, F.expr(registry.DOMAIN), **registry.MIX).collect()}
    got = mixing.mix(clash, F.expr(registry.DOMAIN), **registry.MIX).collect()
    assert {r.doc_id: r.mix_copies for r in got} == plain
    assert all(r[n] == f"{n}-{r.doc_id}" for r in got for n in ("passes", "last_key", "tokens", "budget", "key", "range", "rest"))


def test_pipeline_stages_keep_columns_named_like_their_results(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = ["score", "lines_in", "lines_dropped", "mix_copies", "mix_domain", "mix_lang", "mix_source", "passes"]
    clash = docs.withColumns({n: F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")) for n in names})
    for name, stage in (s for s in corpus_pipeline.STAGES if s[0] in ("quality classifier", "line dedup", "mixture")):
        plain = {(r.doc_id, r.text) for r in stage(spark, docs, SF).collect()}
        out = stage(spark, clash, SF)
        assert out.columns == clash.columns, name
        got = out.collect()
        assert {(r.doc_id, r.text) for r in got} == plain, name
        assert all(r[n] == f"{n}-{r.doc_id}" for r in got for n in names), name
