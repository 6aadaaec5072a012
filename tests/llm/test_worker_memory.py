"""What bounds the memory of Python tasks holds for stages that are run by themselves."""

import corpus_pipeline
import numpy as np

from lendmill.llm import segments, words


def test_stages_bound_the_batches_of_tasks(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    own, docs = spark.conf.get(key), spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    try:
        spark.conf.set(key, str(1 << 30))
        dict(corpus_pipeline.STAGES)["near_duplicates"](spark, docs, "")
        assert spark.conf.get(key) == str(16 << 20)
    finally:
        spark.conf.set(key, own)


def test_documents_are_sent_to_tasks_once(spark, monkeypatch):
    sent, original = {}, segments.in_tasks

    def tasks(df, function, schema):
        sent[len(sent)] = df.columns
        return original(df, function, schema)

    monkeypatch.setattr(segments, "in_tasks", tasks)
    docs = spark.createDataFrame([(k, f"vile bad w{k}" if k % 2 else f"good kind w{k}") for k in range(40)] + [(40, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, toxic int")
    left = {r["doc_id"]: r["text"] for r in segments.clean_documents(docs, labels).collect()}
    assert sent[len(sent) - 1] == ["doc_id", "text"]
    assert left[40] is None and 1 not in left and left[2] == "good kind w2"


def test_powers_that_workers_keep(monkeypatch):
    monkeypatch.setattr(words, "_POWERS", {})
    words.powers(words.KEPT_POWERS)
    assert sum(x.nbytes for x in words._POWERS.values()) < 4 * 8 * (1 << 20) + 1000
    short = words._POWERS["up"].copy()
    words.powers(words.KEPT_POWERS + 5)
    assert len(words._POWERS["up"]) > words.KEPT_POWERS and np.array_equal(words._POWERS["up"][: len(short)], short)
