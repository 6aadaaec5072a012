"""Toxic passages by maximum-scoring segments.

Training counts in how many toxic and clean documents a word stands, and smooths the odds by
a Dirichlet prior: a word's prior is its prefix's share of toxic documents, a prefix's prior
the overall share. A token scores its log-odds less a fixed cost, so clean text drifts down.
One scan over a document finds all maximal scoring segments (each toxic passage, however
many). Segment scores are set against the extreme-value law of the best segment of clean
documents, whose scale and place are fitted on clean training documents; the significance
of the best segment and the sum over all significant ones give the probability of the label.

Words are fitted on one half of the training documents, the calibration on the other. Both
come from a sample of ``TRAIN_ROWS`` labelled rows at most (those of least hash), so the model
has a bounded size whatever the corpus; every document is scored on its whole text.

Defined cases: null and empty texts, and texts without words, have no segment and the least
probability; labels that are null are not used; without labels of both kinds every document
scores 0; repeated rows score alike; labels, language and source are no inputs of a score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.llm import tokens, words
from lendmill.llm.common import in_tasks, text_rows, written

#: Labelled rows that training reads at most; entries of the model at most, by weight of evidence.
TRAIN_ROWS, MODEL_WORDS = 20_000, 100_000
PREFIX_BYTES = 6
#: Documents that a prior counts as.
PREFIX_PRIOR, WORD_PRIOR = 4.0, 2.0
#: What each token costs.
COST = 1.5
THRESHOLD = 0.3
#: Segments count towards the sum from this significance on (minus the logarithm of a chance).
SIGNIFICANT = 3.0


def letter_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hashes of the words (runs of letters, lower case) and of their prefixes, starts and ends
    of the words, and the first word of each text."""
    low = words.lower_ascii(data)
    # Capitals of Latin-1 are two bytes, the second 32 below the small letter's.
    second = np.zeros(len(low), bool)
    second[1:] = (low[:-1] == 0xC3) & (low[1:] >= 0x80) & (low[1:] <= 0x9E) & (low[1:] != 0x97)
    low = low + second.astype(np.uint8) * np.uint8(32)
    letter = ((low >= 97) & (low <= 122)) | (low >= 0x80)
    border = np.zeros(len(low) + 1, bool)
    border[offsets] = True
    before = np.concatenate([[True], ~letter])[: len(low)] | border[:-1]
    after = np.concatenate([~letter[1:], [True]])[: len(low)] | border[1:]
    starts, ends = np.flatnonzero(letter & before), np.flatnonzero(letter & after) + 1
    whole = words.word_hashes(low, starts, ends)
    prefix = words.word_hashes(low, starts, np.minimum(ends, starts + PREFIX_BYTES)) ^ np.uint64(0x5555)
    return whole, prefix, starts, ends, np.searchsorted(starts, offsets)


def maximal_segments(scores: Sequence[float], places: Sequence[int], cost: float, end: int) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first place, end place, score) of tokens 0 .. end - 1 that
    score ``-cost`` but for those at ``places``. One pass; each token is put on the list once
    and taken off at most once."""
    found: list[list[float]] = []  # first, end, sum before, sum after, link
    total, at = 0.0, 0
    for score, place in zip(scores, places, strict=True):
        total -= cost * (place - at)
        if score <= 0:
            total += score
            at = place + 1
            continue
        item = [place, place + 1, total, total + score, -1]
        total, at = total + score, place + 1
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= item[2]:
                j = int(found[j][4])
            item[4] = j
            if j < 0 or found[j][3] >= item[3]:
                found.append(item)
                break
            item[0], item[2] = found[j][0], found[j][2]
            del found[j:]
    return [(int(a), int(b), after - before) for a, b, before, after, _ in found]


@dataclass(frozen=True)
class Model:
    """Token scores by hash, the extreme-value law of clean documents, and the calibration."""

    keys: np.ndarray
    values: np.ndarray
    place: float = 0.0
    slope: float = 0.0
    scale: float = 1.0
    weights: tuple[float, ...] = (0.0, 0.0, 0.0)
    fitted: bool = False

    def token_scores(self, whole: np.ndarray, prefix: np.ndarray) -> np.ndarray:
        """Score of each token before its cost: its word's, or its prefix's, or nothing."""
        if not len(self.keys):
            return np.zeros(len(whole))
        out = np.zeros(len(whole))
        for hashes in (prefix, whole):
            at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
            hit = self.keys[at] == hashes
            out[hit] = self.values[at[hit]]
        return out

    def significance(self, best: float, n: int) -> float:
        """Minus the logarithm of the chance that a clean document of n tokens has such a best
        segment."""
        x = (best - self.place - self.slope * math.log(max(n, 1))) / self.scale
        if x > 30:
            return x
        return -math.log(max(-math.expm1(-math.exp(-x)), 1e-300)) if x > -6 else 0.0

    def probability(self, features: tuple[float, float]) -> float:
        if not self.fitted:
            return 0.0
        z = self.weights[0] + self.weights[1] * features[0] + self.weights[2] * features[1]
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, z))))

    def features(self, segments: list[tuple[int, int, float]], n: int) -> tuple[float, float]:
        best = max((s for _, _, s in segments), default=0.0)
        total = sum(s for _, _, s in segments if self.significance(s, n) > SIGNIFICANT)
        return math.log1p(self.significance(best, n)), math.log1p(total)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, label: str = "toxic", limit: int = TRAIN_ROWS) -> DataFrame:
    """A bounded sample of labelled documents outside the held-out quarter, with ``half``."""
    chosen = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.col(label).cast("int").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = text_rows(docs).join(F.broadcast(chosen), "doc_id")  # at most ``limit`` rows
    return written(rows.withColumn("half", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2))).select("label", "half", "text"), "training")


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels = batch.column("label").to_numpy()
        for start, _, data, offsets in tokens.slices(batch.column("text")):
            whole, prefix, _, _, of_text = letter_words(data, offsets)
            for k in range(len(of_text) - 1):
                part = slice(of_text[k], of_text[k + 1])
                pairs = np.unique(np.stack([whole[part], prefix[part]]), axis=1) if of_text[k + 1] > of_text[k] else np.zeros((2, 0), np.uint64)
                if pairs.shape[1]:
                    n = pairs.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(pairs[0].view(np.int64)), pa.array(pairs[1].view(np.int64)), pa.array(np.full(n, int(labels[start + k]), np.int32))],
                        names=["word", "prefix", "label"],
                    )


def fit_words(rows: DataFrame) -> Model:
    """Log-odds of words and prefixes from the documents that hold them."""
    totals = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return Model(np.zeros(0, np.uint64), np.zeros(0))
    share, base = n1 / (n1 + n0), math.log(n1 / n0)
    terms = in_tasks(rows.select("text", "label"), _terms, "word long, prefix long, label int")
    by_word = written(terms.groupBy("word", "prefix").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c")), "terms")
    by_prefix = by_word.groupBy("prefix").agg(F.sum("t").alias("tp"), F.sum("c").alias("cp"), F.count(F.lit(1)).alias("kinds"))

    def odds(t: Column, c: Column, prior: float, mean: Column) -> Column:
        return F.log((t + prior * mean) / (c + prior * (1 - mean))) - base

    mean = (F.col("tp") + PREFIX_PRIOR * share) / (F.col("tp") + F.col("cp") + PREFIX_PRIOR)
    prefixes = by_prefix.withColumn("mean", mean).withColumn("value", odds(F.col("tp"), F.col("cp"), PREFIX_PRIOR, F.lit(share)))
    scored = by_word.join(prefixes.select("prefix", "mean"), "prefix").withColumn("value", odds(F.col("t"), F.col("c"), WORD_PRIOR, F.col("mean")))
    every = scored.select("word", "value", (F.col("t") + F.col("c")).alias("n")).unionByName(
        prefixes.filter("kinds > 1").select(F.col("prefix").alias("word"), "value", (F.col("tp") + F.col("cp")).alias("n"))
    )
    kept = every.orderBy((F.abs("value") * F.sqrt("n")).desc(), "word").limit(MODEL_WORDS).collect()  # at most MODEL_WORDS rows
    keys = np.array([r["word"] for r in kept], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Model(keys[order], np.array([r["value"] for r in kept])[order])


def _segments(model: Model, batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[tuple[int, int, float]], np.ndarray, np.ndarray, bytes]]:
    """Row, number of tokens, segments, and the bytes of the tokens."""
    for start, _, data, offsets in tokens.slices(batch.column("text")):
        whole, prefix, starts, ends, of_text = letter_words(data, offsets)
        scores = model.token_scores(whole, prefix)
        for k in range(len(of_text) - 1):
            a, b = int(of_text[k]), int(of_text[k + 1])
            own = scores[a:b]
            places = np.flatnonzero(own > COST)
            # Tokens that gain nothing over their neighbours all cost the same: a clean word
            # is not rewarded, and its score below nothing makes no segment longer.
            found = maximal_segments((own[places] - COST).tolist(), places.tolist(), COST, b - a)
            yield start + k, b - a, found, starts[a:b] - offsets[k], ends[a:b] - offsets[k], data[offsets[k] : offsets[k + 1]].tobytes()


def calibrate(model: Model, rows: DataFrame) -> Model:
    """Fit the extreme-value law to the best segments of clean documents (by moments), and the
    weights of the two features to the labels (by Newton steps)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(n, [s for _, _, s in found]) for _, n, found, *_ in _segments(model, batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([n for n, _ in out], pa.int64()), pa.array([s for _, s in out], pa.list_(pa.float64()))], names=["label", "n", "scores"]
            )

    got = [(r["label"], r["n"], r["scores"]) for r in in_tasks(rows.select("text", "label"), run, "label int, n long, scores array<double>").collect()]  # at most TRAIN_ROWS rows
    label = np.array([one for one, _, _ in got], float)
    if not len(got) or label.min() == label.max():
        return model
    # The best of n tokens grows with the logarithm of n; what is left follows Gumbel's law,
    # placed by quantiles, which wrong labels do not move.
    clean = np.array([(max(scores, default=0.0), math.log(max(n, 1))) for one, n, scores in got if not one])
    low = clean[clean[:, 0] <= np.quantile(clean[:, 0], 0.9)]
    spread = float(low[:, 1].var())
    slope = max(0.0, float(np.cov(low.T, bias=True)[0, 1]) / spread) if spread > 0 else 0.0
    half, upper = np.quantile(clean[:, 0] - slope * clean[:, 1], [0.5, 0.75]).tolist()
    scale = max((upper - half) / 0.8794, 0.1)
    law = Model(model.keys, model.values, half - 0.3665 * scale, slope, scale)
    x = np.array([[1.0, *law.features([(0, 1, s) for s in scores], n)] for _, n, scores in got])
    w = np.zeros(3)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        gradient = x.T @ (label - p) - 1e-2 * w
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(3), gradient)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return Model(law.keys, law.values, law.place, law.slope, law.scale, tuple(w.tolist()), True)


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Model:
    rows = training_rows(docs, labels, label)
    return calibrate(fit_words(rows.filter("half = 0")), rows.filter("half = 1"))


SCORED = "doc_id long, score double, passages array<struct<start:int,end:int,score:double,text:string>>"


def score(docs: DataFrame, model: Model, passages: bool = True) -> DataFrame:
    """doc_id, score and the toxic passages (code points, end exclusive) of each document."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MODEL_WORDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            scores, found_all = [], []
            for _, n, found, starts, ends, raw in _segments(own, batch):
                scores.append(own.probability(own.features(found, n)))
                spans = []
                for a, b, value in found if passages else ():
                    i, j = int(starts[a]), int(ends[b - 1])
                    at = len(raw[:i].decode())
                    passage = raw[i:j].decode()
                    spans.append({"start": at, "end": at + len(passage), "score": value, "text": passage})
                found_all.append(spans)
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("text", pa.string())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(found_all, kind)], names=["doc_id", "score", "passages"])

    return in_tasks(text_rows(docs), run, SCORED)


def verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs, train(docs, labels), passages=False)
    return scored.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def clean_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below the threshold, with all their columns. The text itself is
    scored next to them, so nothing is joined by id."""
    model = train(docs, labels)
    shipped = docs.sparkSession.sparkContext.broadcast(model)  # bounded by MODEL_WORDS
    fields = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch.column("text").fill_null("")], names=["text"])
            good = pa.array([own.probability(own.features(found, n)) < THRESHOLD for _, n, found, *_ in _segments(own, texts)], pa.bool_())
            yield batch.filter(good)

    return in_tasks(docs, run, fields)
