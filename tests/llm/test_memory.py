"""What a Python worker still holds once it is done with a batch, or goes on to another operator."""

import os

import pyarrow as pa

from millrace.llm import common, langid, ngram_join, packing
from millrace.llm.queries import public_tokenizer

TEXTS = pa.RecordBatch.from_arrays([pa.array([1, 2], pa.int64()), pa.array(["der Hund und die Katze", "the dog and the cat"])], ["doc_id", "text"])


def resident():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")


def test_free_memory_goes_back_after_a_batch():
    before = resident()
    held = [bytes(700) for _ in range(100_000)]  # the C library's, as they are too large for Python's own pools
    top = held[-100:]
    del held
    assert resident() - before > 40 << 20  # free, but not the system's
    assert list(common.slices(iter([TEXTS]), "text"))
    assert resident() - before < 20 << 20
    assert len(top) == 100


def test_caches_of_an_operator_are_dropped_by_the_next():
    path = public_tokenizer("word_bpe_49k.json")
    list(packing.pieces_of(path, 2048, 0)(iter([TEXTS])))
    assert list(common._kept) == [f"word-ids {path}"]
    again = common._kept[f"word-ids {path}"]
    list(packing.pieces_of(path, 2048, 0)(iter([TEXTS])))
    assert common._kept[f"word-ids {path}"] is again
    list(ngram_join._signatures(5)(iter([TEXTS])))
    assert list(common._kept) == ["word-hashes"]


def test_language_id_holds_batches_small_and_no_other_cache(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    session = spark.newSession()
    session.conf.set(name, 64 << 20)
    docs = session.createDataFrame([(1, "ein Text", "de")], "doc_id long, text string, lang string")
    langid.keep_identified(docs, langid.fit(docs))
    assert int(session.conf.get(name)) == 8 << 20
