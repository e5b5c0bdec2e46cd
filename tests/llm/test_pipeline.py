"""The pipeline's stages on the driver tables, each against its own input."""

import corpus_pipeline
from cellspan.llm.common import DOCUMENT_COLUMNS, stored, table

SF = "/root/testdata/sf0.01"


def test_stages(spark):
    docs, seen = table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF), "t")
        seen[name] = (docs, out)
        docs = out
    for name, (before, after) in seen.items():
        if name != "packing":
            assert tuple(after.columns) == DOCUMENT_COLUMNS and after.count() <= before.count()
            assert after.select("doc_id").distinct().count() == after.count()
    before, after = seen["quality classifier"]
    labels = table(spark, SF, "labels")
    good = before.join(labels.where("quality = 1"), "doc_id", "left_semi").count()
    assert after.join(labels.where("quality = 1"), "doc_id", "left_semi").count() >= 0.99 * good
    assert after.join(labels.where("quality = 0"), "doc_id", "left_semi").count() == 0
    before, after = seen["line dedup"]
    assert before.count() == after.count() and after.where("n_chars <> char_length(text)").isEmpty()
    before, after = seen["mixing"]
    assert after.count() > 0.8 * before.count()
    before, after = seen["packing"]
    assert after.select("doc_id").distinct().count() == before.count()
    assert after.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").isEmpty()
