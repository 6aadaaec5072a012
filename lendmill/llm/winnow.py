"""Repeated passages by seed and extend.

Seeds: of every run of W neighbouring k-word shingles the smallest hash is an anchor, with
W + k - 1 the length of a window, so a window and its copies elsewhere choose the same
anchor. Documents are joined on anchors. An anchor is responsible for the windows that chose
it; they span a stretch of words around it. Extending: anchors that meet are first compared
on their whole stretch, which settles the inside of a long repeat at once; only where the
stretches differ, at the ends of repeats, the windows are compared one by one. The union of
the repeated windows of a document are its maximal repeats.

Counts are made by aggregates and joins of written tables, so an anchor, stretch or window
that stands in a third of all documents is reduced before it is shuffled and its join is
split; pairs of documents are never formed.

Defined cases: null and empty texts have no words; texts shorter than a window keep all their
words; repeated rows are repeats of each other, so all of their windows go (each row is told
apart by its place in the input, not by its id); null ids take part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.llm import tokens, words
from lendmill.llm.common import in_tasks, written

WINDOW = 35
SHINGLE = 8


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each row under a name of its own: its id and a hash of its text. Rows that are equal in
    both have the same repeats, and count as often as they occur."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.xxhash64(F.col(id_col), text).alias("row"), text.alias("text"))


def _anchored(marks: np.ndarray, window: int, shingle: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the word hashes of a text: places of its anchors, and the first and last start of the
    windows that chose each."""
    grams = words.windows(marks, shingle)
    width = window - shingle + 1
    n = len(grams) - width + 1
    # Place of the smallest hash among each run of shingles; of equal ones the last.
    best = np.arange(len(grams))
    reach = 1
    while reach < width:
        step = min(reach, width - reach)
        later = best[step:]
        earlier = best[: len(later)]
        best = np.where(grams[later] <= grams[earlier], later, earlier)
        reach += step
    best = best[:n]
    new = np.flatnonzero(np.concatenate([[True], best[1:] != best[:-1]]))
    return best[new], new, np.append(new[1:], n) - 1


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """Row number and word hashes of each text of a batch."""
    for start, _, data, offsets in tokens.slices(batch.column("text")):
        starts, ends, of_text = words.words(data, offsets)
        marks = words.word_hashes(data, starts, ends)
        for k in range(len(of_text) - 1):
            yield start + k, marks[of_text[k] : of_text[k + 1]]


def _seeds(window: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            parts: list[tuple[np.ndarray, ...]] = []
            for k, marks in _texts(batch):
                if len(marks) < window:
                    continue
                at, first, last = _anchored(marks, window, shingle)
                anchor = words.range_hashes(marks, at, at + shingle)
                stretch = words.mix(words.range_hashes(marks, first, last + window) ^ (at - first).astype(np.uint64))
                parts.append((np.full(len(at), rows[k]), anchor.view(np.int64), stretch.view(np.int64), first, last))
            if parts:
                columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "anchor", "stretch", "first", "last"])

    return run


def _windows(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("row").to_numpy()
            spans = batch.column("spans").to_pylist()
            parts: list[tuple[np.ndarray, ...]] = []
            for k, marks in _texts(batch):
                starts = np.concatenate([np.arange(s["first"], s["last"] + 1) for s in spans[k]])
                found = words.range_hashes(marks, starts, starts + window)
                parts.append((np.full(len(starts), rows[k]), found.view(np.int64), starts))
            if parts:
                columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "window", "first"])

    return run


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """(row, spans) of rows with repeated windows; spans are (first, last) starts of windows."""
    rows = _rows(docs, id_col, text_col)
    seeds = written(in_tasks(rows, _seeds(window, shingle), "row long, anchor long, stretch long, first long, last long"), "seeds")
    stretches = written(seeds.groupBy("anchor", "stretch").agg(F.count(F.lit(1)).alias("n")), "stretches")
    anchors = written(stretches.groupBy("anchor").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds")).filter("n > 1"), "anchors")
    met = written(seeds.join(anchors.select("anchor", "kinds"), "anchor"), "met")
    same = written(stretches.filter("n > 1").select("anchor", "stretch", F.lit(True).alias("same")), "same")
    judged = written(met.join(same, ["anchor", "stretch"], "left"), "judged")
    # One by one where a stretch is alone, or where other stretches share its anchor.
    whole = judged.filter("same").select("row", "first", "last")
    ends = judged.filter(F.col("same").isNull() | (F.col("kinds") > 1))
    asked = written(ends.groupBy("row").agg(F.collect_set(F.struct("first", "last")).alias("spans")), "asked")
    texts = rows.join(asked, "row")
    single = written(in_tasks(texts.select("row", "text", "spans"), _windows(window), "row long, window long, first long"), "windows")
    twice = written(single.groupBy("window").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("window"), "twice")
    some = single.join(twice, "window").select("row", "first", F.col("first").alias("last"))
    return written(whole.union(some).groupBy("row").agg(F.collect_set(F.struct("first", "last")).alias("spans")), "repeats")


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("spans").to_pylist()
            total, removed, kept = [], [], []
            for start, _, data, offsets in tokens.slices(batch.column("text")):
                starts, ends, of_text = words.words(data, offsets)
                raw = data.tobytes()
                for k in range(len(of_text) - 1):
                    a, b = int(of_text[k]), int(of_text[k + 1])
                    change = np.zeros(b - a + 1, np.int64)
                    for s in spans[start + k] or ():
                        change[s["first"]] += 1
                        change[s["last"] + window] -= 1
                    left = np.flatnonzero(np.cumsum(change)[:-1] == 0) + a
                    total.append(b - a)
                    removed.append(b - a - len(left))
                    kept.append(b" ".join([raw[i:j] for i, j in zip(starts[left].tolist(), ends[left].tolist(), strict=True)]))
            sizes = [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            keep = [i for i, name in enumerate(batch.schema.names) if name not in ("text", "spans")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in keep], *sizes], names=[*[batch.schema.names[i] for i in keep], "n_words", "n_removed", "kept_text"]
            )

    return run


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The documents' ids with ``n_words``, ``n_removed`` and ``kept_text``, the words that no
    repeated window covers, joined by one space."""
    found = repeats(docs, id_col, text_col, window)
    text = F.coalesce(F.col(text_col), F.lit(""))
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col), text).alias("row"), text.alias("text"))
    joined = named.join(found, "row", "left").select("doc_id", "text", "spans")
    return in_tasks(joined, _cut(window), "doc_id long, n_words long, n_removed long, kept_text string")


def without_repeats_in_place(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with all their columns; a text that has repeats is replaced by its kept
    words, any other stays as it is (null as well)."""
    found = repeats(docs, window=window)
    named = docs.withColumn("__row", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    joined = named.join(found.withColumnRenamed("row", "__row").withColumnRenamed("spans", "__spans"), "__row", "left").drop("__row")
    cut = _cut(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column("text"), batch.column("__spans")
            changed = spans.is_valid()
            rows = pa.RecordBatch.from_arrays([texts.filter(changed), spans.filter(changed)], names=["text", "spans"])
            new = [b.column("kept_text") for b in cut(iter([rows]))][0]
            whole = pa.compute.replace_with_mask(texts, changed, new)
            names = [n for n in batch.schema.names if n != "__spans"]
            yield pa.RecordBatch.from_arrays([whole if n == "text" else batch.column(n) for n in names], names=names)

    return in_tasks(joined, run, docs.schema)


def kept_table(docs: DataFrame) -> DataFrame:
    return without_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
