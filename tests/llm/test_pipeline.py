"""The pipeline on the smallest tables: each stage against what its operator says, columns, and odd rows."""

from pyspark.sql import functions as F

import corpus_pipeline
from locuslake.llm import bpe, mixing, neardup, pii, toxicity

D = "/root/testdata/sf0.001"


def test_stages_on_the_smallest_tables(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    labels = spark.read.parquet(f"{D}/labels.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, D).cache()
        kept[name] = out.collect()
        if name != "bpe":
            assert out.columns == docs.columns and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        if name == "toxicity":
            bad = {r["doc_id"] for r in toxicity.op5_toxicity(docs, labels).where("predicted = 1").collect()}
            assert {r["doc_id"] for r in kept[name]} == {r["doc_id"] for r in docs.collect()} - bad
        elif name == "near_dedup":
            assert sorted(r["doc_id"] for r in kept[name]) == sorted({r["class_id"] for r in neardup.classes(docs).collect()})
        elif name == "pii":
            assert len(kept[name]) == docs.count()
            assert not any(pii.base_spans(r["text"] or "") and [s for s in pii.base_spans(r["text"]) if s[0] == 0] for r in kept[name])
        elif name == "mixing":
            taken = mixing.mix(docs, labels).agg(F.sum("taken")).first()[0]
            assert out.select(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0] == taken
        else:
            codec = bpe.Codec()
            texts = {(r["doc_id"], r["n_chars"]): r["text"] for r in docs.collect()}
            for r in kept[name][:60]:
                assert r["ids"] == codec.encode(texts[r["doc_id"], r["n_chars"]]) and r["n_tokens"] == len(r["ids"])
        docs = out
    assert corpus_pipeline.run(spark, D).count() == len(kept["bpe"])


def test_odd_rows_pass_every_stage(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "a", 0), (2, None, "en", "a", 0), (3, "x y z", None, None, 5), (3, "x y z", None, None, 5)], "doc_id long, text string, lang string, source string, n_chars long")
    for d in (docs, docs.where("false")):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, d, D)
            got = out.collect()
            if name == "toxicity":  # without words there is no evidence
                assert len(got) == d.count()
            elif name == "near_dedup":  # the repeated row stands once; texts without words stay
                assert sorted(str(r["doc_id"]) for r in got) == (["1", "2", "3", "None"] if d is docs else [])
            elif name == "pii":
                assert sorted(str((r["doc_id"], r["text"])) for r in got) == sorted(str((r["doc_id"], r["text"])) for r in d.collect())
            elif name == "mixing":  # nothing to take of a text without words: the null source has all six words, its target is one epoch
                assert sorted(r["doc_id"] for r in got) == ([3] * 2 if d is docs else [])
            else:
                assert [r["n_tokens"] for r in got] == [len(r["ids"]) for r in got] and len(got) == d.count()
