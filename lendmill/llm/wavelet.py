"""Token-id output: one wavelet matrix per shard.

Documents are range-sorted by id, encoded, and laid end to end (each with an end id). A
shard holds some million ids as a wavelet matrix: one bit-plane per bit of an id, most
significant first, each plane stably dividing the order of the next by its bit. Planes are
compressed with their rank directories, so a shard answers access, rank, select, count and
occurrence lookups on its own. Shards are rows of a Parquet folder, one file per range of
documents: written atomically by Spark and readable from any store.

Defined cases: null text is empty (the end id alone); a null id sorts first; equal ids keep
all their rows, in the order of a hash of the text; a document longer than a shard has a shard of its own; no
rows give no shards; columns other than id and text are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lendmill.llm import tokens
from lendmill.llm.common import in_tasks, text_rows, work_dir

SHARD_IDS = 1 << 20
#: Documents of a shard that are handed on at a time.
READ_DOCUMENTS = 2000
#: Bits between two entries of a rank directory.
BLOCK = 512


class WaveletMatrix:
    """A sequence of ids as bit-planes with rank directories."""

    def __init__(self, n: int, zeros: list[int], planes: list[np.ndarray], ranks: list[np.ndarray]):
        self.n, self.zeros, self.planes, self.ranks = n, zeros, planes, ranks

    @classmethod
    def of(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        zeros, planes, ranks, left = [], [], [], ids
        for level in reversed(range(bits)):
            bit = (left >> level).astype(np.uint8) & 1
            on = bit.view(bool)
            zeros.append(len(left) - int(np.count_nonzero(on)))
            planes.append(np.packbits(bit))
            ranks.append(_directory(planes[-1]))
            left = np.concatenate([left[~on], left[on]])
        return cls(len(ids), zeros, planes, ranks)

    def to_bytes(self) -> bytes:
        head = np.array([self.n, len(self.planes), *self.zeros], "<i8").tobytes()
        body = b"".join(p.tobytes() for p in self.planes) + b"".join(r.tobytes() for r in self.ranks)
        return zstandard.ZstdCompressor(level=1).compress(head + body)

    @classmethod
    def from_bytes(cls, raw: bytes) -> WaveletMatrix:
        raw = zstandard.ZstdDecompressor().decompress(raw)
        n, bits = np.frombuffer(raw, "<i8", 2).tolist()
        zeros = np.frombuffer(raw, "<i8", bits, 16).tolist()
        at, width, blocks = 16 + 8 * bits, (n + 7) // 8, n // BLOCK + 1
        planes = [np.frombuffer(raw, np.uint8, width, at + k * width) for k in range(bits)]
        at += bits * width
        ranks = [np.frombuffer(raw, "<u4", blocks, at + 4 * k * blocks) for k in range(bits)]
        return cls(n, zeros, planes, ranks)

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3]) >> (7 - (i & 7)) & 1

    def _ones(self, level: int, i: int) -> int:
        """One bits before place i of a plane."""
        block = i // BLOCK
        count, at = int(self.ranks[level][block]), block * BLOCK
        part = self.planes[level][at // 8 : (i + 7) // 8]
        return count + int(np.unpackbits(part)[: i - at].sum())

    def access(self, i: int) -> int:
        value = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, i), self._ones(level, i)
            value = value << 1 | bit
            i = self.zeros[level] + ones if bit else i - ones
        return value

    def _span(self, symbol: int, i: int) -> tuple[int, int]:
        """Where the symbol's places before i stand below the last plane."""
        start, end, bits = 0, i, len(self.planes)
        if symbol >> bits:
            return 0, 0
        for level in range(bits):
            a, b = self._ones(level, start), self._ones(level, end)
            if symbol >> (bits - 1 - level) & 1:
                start, end = self.zeros[level] + a, self.zeros[level] + b
            else:
                start, end = start - a, end - b
        return start, end

    def rank(self, symbol: int, i: int) -> int:
        """How often the symbol stands before place i."""
        start, end = self._span(symbol, i)
        return end - start

    def count(self, symbol: int) -> int:
        return self.rank(symbol, self.n)

    def _select_bit(self, level: int, bit: int, k: int) -> int:
        """The place of the k-th bit (from 0) of this value in a plane."""
        ones = self.ranks[level].astype(np.int64)
        before = ones if bit else np.arange(len(ones)) * BLOCK - ones
        block = int(np.searchsorted(before, k, side="right")) - 1
        part = np.unpackbits(self.planes[level][block * BLOCK // 8 : (block + 1) * BLOCK // 8])
        return block * BLOCK + int(np.flatnonzero(part == bit)[k - int(before[block])])

    def select(self, symbol: int, k: int) -> int:
        """The place of the symbol's k-th occurrence, counted from 0."""
        start, end = self._span(symbol, self.n)
        if not 0 <= k < end - start:
            raise IndexError(k)
        place, bits = start + k, len(self.planes)
        for level in reversed(range(bits)):
            bit = symbol >> (bits - 1 - level) & 1
            place = self._select_bit(level, bit, place - self.zeros[level] if bit else place)
        return place

    def ids(self) -> np.ndarray:
        """The whole sequence, plane by plane from the last."""
        values = np.zeros(self.n, np.uint32 if len(self.planes) > 16 else np.uint16)
        for level in reversed(range(len(self.planes))):
            on = np.unpackbits(self.planes[level], count=self.n).view(bool)
            above = np.empty_like(values)
            z = self.zeros[level]
            above[~on] = values[:z]
            above[on] = values[z:] | (1 << (len(self.planes) - 1 - level))
            values = above
        return values


def _directory(plane: np.ndarray) -> np.ndarray:
    wide = np.zeros((len(plane) // (BLOCK // 8) + 1) * (BLOCK // 8), np.uint8)
    wide[: len(plane)] = plane
    sums = np.bitwise_count(wide).reshape(-1, BLOCK // 8).sum(axis=1, dtype=np.int64)
    return np.concatenate([[0], np.cumsum(sums)])[: len(sums)].astype("<u4")


SHARDS = "part int, shard int, before long, n_ids long, docs array<bigint>, sizes array<bigint>, matrix binary"


def write_shards(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, shard_ids: int = SHARD_IDS) -> DataFrame:
    """Encode documents into shards under ``path``, in ascending id order, and open them."""
    bits = max(1, int(tokens.tokenizer(tokenizer_path).get_vocab_size(with_added_tokens=True) - 1).bit_length())
    kind = np.uint32 if bits > 16 else np.uint16

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, shard = TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        sizes: list[int] = []
        held: list[np.ndarray] = []
        total = before = 0

        def close() -> pa.RecordBatch:
            matrix = WaveletMatrix.of(np.concatenate(held), bits).to_bytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([before], pa.int64()), pa.array([total], pa.int64()),
                 pa.array([names], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())), pa.array([matrix], pa.binary())],
                names=["part", "shard", "before", "n_ids", "docs", "sizes", "matrix"],
            )

        for batch in batches:
            doc_ids = batch.column("doc_id").to_pylist()
            for start, end, ids, at in tokens.encoded(tokenizer_path, batch.column("text")):
                # The end id after each document.
                whole = np.insert(ids, at[1:], end_id).astype(kind)
                at = at + np.arange(len(at))
                lengths = np.diff(at)
                row = start
                while row < end:
                    room = max(shard_ids - total, 1)
                    stop = row + max(1, int(np.searchsorted(at, at[row - start] + room, side="right")) - 1 - (row - start))
                    stop = min(stop, end)
                    held.append(whole[at[row - start] : at[stop - start]])
                    names += doc_ids[row:stop]
                    sizes += lengths[row - start : stop - start].tolist()
                    total += len(held[-1])
                    row = stop
                    if total >= shard_ids or row < end:
                        yield close()
                        shard, before, names, sizes, held, total = shard + 1, before + total, [], [], [], 0
        if held:
            yield close()

    # Bounds are sampled from keys, so the text itself is none of them.
    ordered = text_rows(docs).repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text")
    in_tasks(ordered, build, SHARDS).write.parquet(path)
    return docs.sparkSession.read.schema(SHARDS).parquet(path)


def placed(shards: DataFrame) -> DataFrame:
    """Shards with ``base``, the ids of all shards before. A shard knows what stands before it
    in its part, so only one row per part is summed up."""
    parts, base = [], 0
    for part, n in shards.groupBy("part").agg(F.sum("n_ids")).orderBy("part").collect():  # as many rows as written files
        parts.append((part, base))
        base += n
    bases = shards.sparkSession.createDataFrame(parts, "part int, part_base long")
    return shards.join(F.broadcast(bases), "part").withColumn("base", F.col("part_base") + F.col("before")).drop("part_base")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, np.ndarray, np.ndarray, np.ndarray]]:
    """Runs of documents of shards: doc_ids, their starts, their offsets within ``ids``, ids."""
    for batch in batches:
        for row in range(batch.num_rows):
            one = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
            ids = WaveletMatrix.from_bytes(one["matrix"]).ids().astype("<u4")
            at = np.concatenate([[0], np.cumsum(np.array(one["sizes"], np.int64))])
            for k in range(0, len(at) - 1, READ_DOCUMENTS):
                stop = min(k + READ_DOCUMENTS, len(at) - 1)
                yield one["docs"][k:stop], at[k:stop] + one["base"], at[k : stop + 1] - at[k], ids[at[k] : at[stop]]


def read_documents(shards: DataFrame) -> DataFrame:
    """Every document from its shard: doc_id, start, n_tokens, ids."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs, starts, at, ids in _documents(batches):
            raw, offsets = pa.py_buffer(ids.tobytes()), pa.py_buffer((at * 4).astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array(starts), pa.array(np.diff(at)), pa.BinaryArray.from_buffers(pa.binary(), len(docs), [None, offsets, raw])],
                names=["doc_id", "start", "n_tokens", "ids"],
            )

    return in_tasks(placed(shards), read, "doc_id long, start long, n_tokens long, ids binary")


def occurrences(shards: DataFrame, token: int) -> DataFrame:
    """Where a token stands: doc_id, position in the document, position among all ids. Found
    by select on the planes; nothing else of a shard is decoded."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                matrix = WaveletMatrix.from_bytes(batch.column("matrix")[row].as_py())
                places = np.array([matrix.select(token, k) for k in range(matrix.count(token))], np.int64)
                at = np.concatenate([[0], np.cumsum(np.array(batch.column("sizes")[row].as_py(), np.int64))])
                document = np.searchsorted(at, places, side="right") - 1
                names = batch.column("docs")[row].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[d] for d in document.tolist()], pa.int64()), pa.array(places - at[document]), pa.array(places + batch.column("base")[row].as_py())],
                    names=["doc_id", "position", "place"],
                )

    return in_tasks(placed(shards), look, "doc_id long, position long, place long")


def token_counts(shards: DataFrame, token: int) -> DataFrame:
    """How often a token stands in each shard: part, shard, n."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [WaveletMatrix.from_bytes(m.as_py()).count(token) for m in batch.column("matrix")]
            yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("shard"), pa.array(found, pa.int64())], names=["part", "shard", "n"])

    return in_tasks(shards.select("part", "shard", "matrix"), count, "part int, shard int, n long")


def document_table(spark: SparkSession, docs: DataFrame, tokenizer_path: str, end_id: int = 0) -> DataFrame:
    """Write shards to the working folder, read them back, and digest each document."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names, starts, at, ids in _documents(batches):
            raw, cuts = memoryview(ids).cast("B"), (at * 4).tolist()
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(starts), pa.array(np.diff(at)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"]
            )

    shards = write_shards(docs, work_dir(spark, "wavelet"), tokenizer_path, end_id)
    return in_tasks(placed(shards), digest, "doc_id long, start long, n_tokens long, ids_crc32 long")
