"""BPE encoding with content-defined chunk reuse.

A rolling hash over the bytes of a text sets chunk borders by content, so passages that
documents share fall into equal chunks wherever they stand. A chunk that stands in more than
one place is encoded once, by its first owner; all other chunks are encoded where they are.
A border may cut a word. So a chunk is encoded only between its first and last unit border
(a place across which the tokenizer never joins), and the join of two chunks, from the last
unit border of the left to the first of the right, is encoded anew as one. A chunk without a
unit border belongs to the join, which grows until both sides agree on a border. The result
is exactly the library's for the whole text, and is decoded from the ids alone.

For vocabularies that drop white space (``tokens.splits_words``).

Defined cases: null text is empty and has no ids; repeated rows and copies share all their
chunks; null ids are kept; other columns are ignored; no rows give no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.llm import tokens
from lendmill.llm.common import in_tasks, salted, text_rows, written

#: Bytes of the rolling window, mean bytes between candidate borders, least and most bytes of a chunk.
ROLL, MEAN, LEAST, MOST = 32, 1 << 10, 256, 1 << 14
#: Bytes of texts that a task opens at a time, but for a single longer text.
OPEN_BYTES = 1 << 25


def borders(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Chunk borders of each text (from its first byte to its end), set by content."""
    at = np.arange(max(len(data) - ROLL + 1, 0))
    rolled = tokens.range_hashes(tokens._byte_values()[data], at, at + ROLL)
    candidate = np.flatnonzero(rolled & np.uint64(MEAN - 1) == 0) + ROLL
    candidate = candidate[candidate < len(data)]
    candidate = candidate[data[candidate] & 0xC0 != 0x80]  # between characters
    found = []
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        cuts, last = [a], a
        for c in candidate[np.searchsorted(candidate, a + ROLL) : np.searchsorted(candidate, b)].tolist():
            while c - last > MOST:
                step = last + MOST
                while data[step] & 0xC0 == 0x80:
                    step -= 1
                cuts.append(step)
                last = step
            if c - last >= LEAST:
                cuts.append(c)
                last = c
        while b - last > MOST:
            last += MOST
            while data[last] & 0xC0 == 0x80:
                last -= 1
            cuts.append(last)
        if b > a:
            cuts.append(b)
        found.append(np.array(cuts, np.int64))
    return found


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.column("row").to_numpy()
        for start, _, data, offsets in tokens.slices(batch.column("text")):
            cuts = borders(data, offsets)
            sizes = np.array([max(len(c) - 1, 0) for c in cuts])
            if not sizes.sum():
                continue
            first = np.concatenate([c[:-1] for c in cuts])
            last = np.concatenate([c[1:] for c in cuts])
            raw = memoryview(data)
            digests = b"".join([hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(first.tolist(), last.tolist(), strict=True)])
            hashes = np.frombuffer(digests, "<i8").reshape(-1, 2).T.copy()
            number = np.arange(len(first)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(rows[start : start + len(cuts)], sizes)), pa.array(number.astype(np.int32)), *map(pa.array, hashes)], names=["row", "k", "h1", "h2"]
            )


def _squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as they travel to the joins, which otherwise move every text twice."""
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        body = [packer.compress(t) for t in batch.column("text").cast(pa.binary()).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row"), pa.array(body, pa.binary())], names=["doc_id", "row", "body"])


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.Array]]:
    """First row and texts of parts of a batch."""
    opener = zstandard.ZstdDecompressor()
    first, size, texts = 0, 0, []
    for i, body in enumerate(batch.column("body")):
        texts.append(opener.decompress(body.as_py()))
        size += len(texts[-1])
        if size >= OPEN_BYTES:
            yield first, pa.array(texts, pa.binary()).cast(pa.string())
            first, size, texts = i + 1, 0, []
    if texts:
        yield first, pa.array(texts, pa.binary()).cast(pa.string())


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for first, texts in _opened(batch):
        for start, _, data, offsets in tokens.slices(texts):
            yield first + start, data, offsets


def _core(text: bytes) -> tuple[int, int]:
    """First and last unit border of a chunk (-1, -1 if it has none)."""
    places = [p for p in (text.find(b" "), text.find(b"\n")) if p >= 0]
    return (min(places), max(text.rfind(b" "), text.rfind(b"\n"))) if places else (-1, -1)


def _kind(path: str) -> str:
    """Ids are moved in 16 bits where the vocabulary allows it."""
    return "<u2" if tokens.tokenizer(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def _owned(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys: list[tuple[int, int]] = []
            cores: list[bytes] = []
            wanted = batch.column("own").to_pylist()
            for start, data, offsets in _slices(batch):
                raw = data.tobytes()
                for i, cuts in enumerate(borders(data, offsets)):
                    for chunk in wanted[start + i]:
                        text = raw[cuts[chunk["k"]] : cuts[chunk["k"] + 1]]
                        a, b = _core(text)
                        keys.append((chunk["h1"], chunk["h2"]))
                        cores.append(text[a:b] if a >= 0 else b"")
            for start, end, ids, at in tokens.encoded(path, pa.array(cores, pa.binary())):
                values = [ids[at[i] : at[i + 1]].astype(_kind(path)).tobytes() for i in range(end - start)]
                part = keys[start:end]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([h for h, _ in part], pa.int64()), pa.array([h for _, h in part], pa.int64()), pa.array(values, pa.binary())], names=["h1", "h2", "ids"]
                )

    return run


def _assembled(path: str, batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    """Row number and ids of each text of a batch."""
    shared = batch.column("shared").to_pylist()
    for start, data, offsets in _slices(batch):
        raw = data.tobytes()
        plans: list[list[bytes | int]] = []
        texts: list[bytes] = []

        def later(text: bytes, plan: list[bytes | int], texts: list[bytes] = texts) -> None:
            if text:
                plan.append(len(texts))
                texts.append(text)

        for i, cuts in enumerate(borders(data, offsets)):
            known = {s["k"]: s["ids"] for s in shared[start + i] or ()}
            plan: list[bytes | int] = []
            join = b""
            places = cuts.tolist()
            for k in range(len(places) - 1):
                text = raw[places[k] : places[k + 1]]
                a, b = _core(text)
                if a < 0:
                    join += text
                    continue
                later(join + text[:a], plan)
                if k in known:
                    plan.append(np.frombuffer(known[k], _kind(path)).astype("<u4").tobytes())
                else:
                    later(text[a:b], plan)
                join = text[b:]
            later(join, plan)
            plans.append(plan)
        parts: list[bytes] = []
        for one, end, ids, at in tokens.encoded(path, pa.array(texts, pa.binary())):
            coded = ids.astype("<u4").tobytes()
            parts += [coded[4 * at[j] : 4 * at[j + 1]] for j in range(end - one)]
        for i, plan in enumerate(plans):
            yield start + i, b"".join([p if isinstance(p, bytes) else parts[p] for p in plan])


@functools.lru_cache(maxsize=2)
def _strings(path: str) -> list[str] | None:
    """The token strings, if decoding is joining them by spaces (a file without a decoder)."""
    found = tokens.tokenizer(path)
    if found.decoder is not None:
        return None
    return [found.id_to_token(i) or "" for i in range(found.get_vocab_size(with_added_tokens=True))]


def decode(path: str, ids: np.ndarray) -> str:
    """As the library's decode, special tokens included."""
    strings = _strings(path)
    if strings is None:
        return tokens.tokenizer(path).decode(ids.tolist(), skip_special_tokens=False)
    return " ".join(map(strings.__getitem__, ids.tolist()))


def _with_shared(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, text (compressed) and the ids of its shared chunks, each encoded once."""
    rows = text_rows(docs).select("doc_id", F.xxhash64("doc_id", "text").alias("row"), "text")
    places = written(in_tasks(rows.select("row", "text"), _cut, "row long, k int, h1 long, h2 long"), "chunks")
    shared = written(places.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "k")).alias("owner")).filter("n > 1"), "shared-chunks")
    roles = written(places.join(shared, ["h1", "h2"]).select("row", "k", "h1", "h2", "n", (F.col("owner.row").eqNullSafe(F.col("row")) & (F.col("owner.k") == F.col("k"))).alias("own")), "roles")
    own = roles.filter("own").groupBy("row").agg(F.collect_set(F.struct("k", "h1", "h2")).alias("own"))
    bodies = in_tasks(rows, _squeeze, "doc_id long, row long, body binary")
    coded = in_tasks(bodies.join(own, "row").select("body", "own"), _owned(path), "h1 long, h2 long, ids binary")
    coded = coded.groupBy("h1", "h2").agg(F.first("ids").alias("ids")).join(shared.select("h1", "h2", "n"), ["h1", "h2"])
    coded = written(coded, "coded-chunks")
    uses = salted(roles.select("row", "k", "h1", "h2", "n"), coded, ["h1", "h2"], ["row", "k"], "n")
    lists = uses.groupBy("row").agg(F.collect_set(F.struct("k", "ids")).alias("shared"))
    return bodies.join(lists, "row", "left").select("doc_id", "body", "shared")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids and the text decoded from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            coded = [np.frombuffer(ids, "<u4") for _, ids in _assembled(path, batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(coded, pa.list_(pa.int64())), pa.array([decode(path, i) for i in coded], pa.string())], names=["doc_id", "ids", "decoded"]
            )

    return in_tasks(_with_shared(docs, path), run, "doc_id long, ids array<bigint>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """Number of ids, and hashes of the ids and of the decoded text, without shipping either."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, of_ids, of_text = [], [], []
            for _, ids in _assembled(path, batch):
                n.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(decode(path, np.frombuffer(ids, "<u4")).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return in_tasks(_with_shared(docs, path), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
