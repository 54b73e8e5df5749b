import corpus_pipeline
from millrace.llm import langid, lines, ngram_join, packing, suffix_dedup
from millrace.llm.queries import public_tokenizer

SF = "/root/testdata/sf0.001"


def test_stages_follow_each_other(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, SF).cache()
        assert found.columns == docs.columns, name
        assert found.dtypes == docs.dtypes, name
        assert 0 < found.count() <= docs.count()
        docs = found
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == docs.count()


def test_run_equals_its_operators(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = langid.keep_identified(docs, langid.fit(docs), corpus_pipeline.MIN_MARGIN)
    docs = suffix_dedup.remove_repeats(ngram_join.keep_one(lines.dedup_lines(docs)))
    want = packing.tokenize_pieces(docs, public_tokenizer("word_bpe_49k.json"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(map(tuple, want.select(*columns).collect()))
