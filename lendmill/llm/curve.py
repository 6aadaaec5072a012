"""Packing along a space-filling curve.

Each document becomes a hashed vector of its token ids, projected by fixed random signs to
three dimensions and quantised; its place on the Hilbert curve through those cells is its
sort key. Documents are range-sorted by key and laid end to end, so a sequence holds
neighbours on the curve; it is cut wherever it is full, and only the last sequence of each
range is not.

Defined cases: null text is empty (the end id alone); equal texts have equal keys and are
ordered by id, so a group of copies of any size is spread over ranges; null ids and repeated
rows are kept; a document longer than a sequence goes on in the next; no rows give no pieces.
"""

from __future__ import annotations

import functools
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.llm import tokens
from lendmill.llm.common import in_tasks, text_rows, written

DIMENSIONS, BITS = 3, 12
FEATURES = 1 << 10
#: Ids of one range. A range leaves at most one sequence unfilled.
RANGE_IDS = 4_000_000


@functools.lru_cache(maxsize=1)
def _signs() -> np.ndarray:
    return np.random.default_rng(11).choice([-1.0, 1.0], (FEATURES, DIMENSIONS))


def project(ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Cells (0 .. 2**BITS - 1 per dimension) of the documents' hashed id counts. The
    projection of a unit vector is about normal with variance 1, so the normal distribution
    function spreads it evenly, whatever the corpus."""
    n = len(at) - 1
    bucket = ((ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(54)).astype(np.int64)
    cells = np.empty((n, DIMENSIONS), np.uint32)
    for k in range(n):
        counts = np.sqrt(np.bincount(bucket[at[k] : at[k + 1]], minlength=FEATURES))
        norm = math.sqrt(float(counts @ counts)) or 1.0
        for d, x in enumerate((counts @ _signs() / norm).tolist()):
            cells[k, d] = int(0.5 * (1 + math.erf(x / math.sqrt(2))) * ((1 << BITS) - 1))
    return cells


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of cells (one row each), by exchanging and inverting the
    lower bits along the axes from the top bit down and undoing the Gray code."""
    x = cells.T.astype(np.int64).copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in reversed(range(bits)):
        for i in range(n):
            key = key << 1 | (x[i] >> b & 1)
    return key


def encoded_documents(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """doc_id, curve key, n_tokens and ids (unsigned 16 bits where the vocabulary allows it)
    with the end id."""
    kind = id_kind(tokenizer_path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, ids, at in tokens.encoded(tokenizer_path, batch.column("text")):
                keys = hilbert_key(project(ids, at))
                whole = np.insert(ids, at[1:], end_id).astype(kind)
                at = at + np.arange(len(at))
                offsets = pa.py_buffer((at * whole.itemsize).astype(np.int32).tobytes())
                body = pa.BinaryArray.from_buffers(pa.binary(), end - start, [None, offsets, pa.py_buffer(whole.tobytes())])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[start:end], pa.array(keys), pa.array(np.diff(at)), body], names=["doc_id", "curve_key", "n_tokens", "ids"]
                )

    return in_tasks(text_rows(docs), encode, "doc_id long, curve_key long, n_tokens long, ids binary")


def id_kind(tokenizer_path: str) -> type:
    return np.uint16 if tokens.tokenizer(tokenizer_path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else np.uint32


PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, curve_key long, ids binary"


def pack(docs: DataFrame, tokenizer_path: str, end_id: int = 1, length: int = 2048) -> DataFrame:
    """Pieces of all documents, placed in sequences of ``length`` ids along the curve. ``ids``
    holds the ids of the piece as unsigned 32-bit little-endian numbers."""
    coded = written(encoded_documents(docs, tokenizer_path, end_id), "curve")
    total = coded.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    ranges = max(1, math.ceil(total / RANGE_IDS))
    kind = id_kind(tokenizer_path)

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        filled, first = 0, TaskContext.get().partitionId() << 36
        for batch in batches:
            sizes = batch.column("n_tokens").to_numpy()
            data, at = tokens.buffers(batch.column("ids"))
            ids = data.view(np.uint8).tobytes()
            ids = np.frombuffer(ids, kind).astype("<u4")
            begin = filled + np.concatenate([[0], np.cumsum(sizes)[:-1]])
            # A piece for each sequence that a document touches.
            touched = (begin + sizes - 1) // length - begin // length + 1
            row = np.repeat(np.arange(len(sizes)), touched)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(touched) - touched, touched)
            sequence = begin[row] // length + nth
            low = np.maximum(sequence * length, begin[row])
            high = np.minimum((sequence + 1) * length, begin[row] + sizes[row])
            offsets = pa.py_buffer(((np.append(low, high[-1:]) - filled) * 4).astype(np.int32).tobytes())
            pieces = pa.BinaryArray.from_buffers(pa.binary(), len(row), [None, offsets, pa.py_buffer(ids.tobytes())])
            where = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(where), pa.array(low - begin[row]), pa.array(high - low), pa.array(sizes[row]),
                 pa.array(first + sequence), pa.array(low - sequence * length), batch.column("curve_key").take(where), pieces],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "curve_key", "ids"],
            )
            filled += int(sizes.sum())

    ordered = coded.repartitionByRange(ranges, "curve_key", "doc_id", "n_tokens").sortWithinPartitions("curve_key", "doc_id", "n_tokens", "ids")
    return in_tasks(ordered, lay, PIECES)


def piece_table(docs: DataFrame, tokenizer_path: str, end_id: int = 1, length: int = 2048) -> DataFrame:
    """Pieces with the checksum of their ids in place of the ids."""
    return pack(docs, tokenizer_path, end_id, length).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
