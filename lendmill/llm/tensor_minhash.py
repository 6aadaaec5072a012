"""Near-duplicates by MinHash with tensored banding.

Two small collections of half-keys, each of two minhash values, are computed per document.
A table key is a pair of one half-key of either collection: 12 + 12 half-keys (48 minhash
values) make 144 tables that would take 576 values if each had its own. A pair of documents
of similarity 0.75 shares a key with probability 0.9999, more similar ones almost surely.
Keys are not stored: rows are grouped by the half-keys of the first collection that are not
alone, and a pair of a group is a candidate if a half-key of the second agrees as well.

Documents with equal shingle sets are one node. Pairs of nodes never become rows:

1. candidates are held to the ratio of set sizes (exact) and to a sketch, and of each group
   just a forest of its candidate pairs is written. What they connect is a family;
2. in each family all pairs that the sketches leave are compared on their full sets, and just
   a forest of the links is written. Each text goes to one family, so no link between
   different texts that share a table is left out.

Groups and families are dealt to pairs of blocks, whose rows meet in one task: of n rows each is
repeated about sqrt(n / ``PER_BLOCK``) times, and blocks of large sets are smaller. The pairs
of a group that are compared grow with the square of its size; what is kept, sent and written
does not.

A sketch has 1,024 bits: the least shingle of each of 1,024 bins, an empty bin taking the
first filled one in a drawn order of its own, and one bit of each. Two equal bits more often
than not estimate the similarity, with a deviation of 0.023 at 0.75 whatever the size of the
sets, so a pair of similarity 0.75 falls below the limit of 0.65 with probability 1e-5. Small
sets, where two shingles in one bin weigh more, are held to a lower limit.

Defined cases: null and empty texts, and texts without words, are linked with nothing; fewer
words than a shingle are one shingle; null ids take part, and a component's id is its
smallest id that is not null; repeated rows are linked; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.llm import tokens, words
from lendmill.llm.common import in_tasks, text_rows, written
from lendmill.llm.components import components

SHINGLE = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
HALVES, VALUES = 12, 2
#: Bits of a sketch, and least estimates of the similarity of a candidate pair: where both sets
#: have ``SMALL_SET`` shingles or more, and below.
SKETCH_BITS, LEAST_ESTIMATE, LEAST_OF_SMALL, SMALL_SET = 1024, 0.65, 0.5, 50
#: Of a group of n rows about sqrt(n / this) blocks are made, of half-key groups and of families;
#: shingles of a block, about.
PER_BLOCK, PER_FAMILY_BLOCK, BLOCK_SHINGLES = 64, 16, 1 << 19
#: Bits of the filter that rows pass before they are joined by mark (a power of two); bits of a row of it.
FILTER_BITS, FILTER_ROW = 1 << 25, 1 << 15


def _parameters() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(5).integers(0, 1 << 64, (2, 2 * HALVES * VALUES), dtype=np.uint64)
    return draw[0] | np.uint64(1), draw[1]


@functools.cache
def _bin_orders() -> np.ndarray:
    """For each bin all bins in the order in which it looks for a filled one."""
    return np.argsort(np.random.default_rng(6).random((SKETCH_BITS, SKETCH_BITS)), axis=1).astype(np.uint16)


def sketch_bits(shingles: np.ndarray, orders: np.ndarray) -> bytes:
    """The sketch of a set of sorted hashes, which has one at least."""
    # The bin is the top of the hash, so the first of a bin is its least.
    bins = (shingles >> np.uint64(65 - SKETCH_BITS.bit_length())).astype(np.intp)
    first = np.flatnonzero(np.concatenate([[True], bins[1:] != bins[:-1]]))
    values, filled = np.zeros(SKETCH_BITS, np.uint64), np.zeros(SKETCH_BITS, bool)
    values[bins[first]] = shingles[first]
    filled[bins[first]] = True
    empty, at, width = np.flatnonzero(~filled), 0, 8
    while len(empty):
        seen = orders[empty, at : at + width]
        hit = filled[seen]
        one = hit.argmax(axis=1)
        good = hit[np.arange(len(empty)), one]
        values[empty[good]] = values[seen[good, one[good]]]
        empty, at, width = empty[~good], at + width, 2 * width
    drawn = words.mix(words.mix(values + np.arange(SKETCH_BITS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return np.packbits(((drawn >> np.uint64(40)) & np.uint64(1)).astype(bool)).tobytes()


def estimates(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Similarities by the sketches in the rows of two arrays of bits, or of one and a row."""
    return 1 - 2 * np.bitwise_count(one ^ two).sum(axis=-1, dtype=np.int64) / SKETCH_BITS


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = _parameters()
    orders = _bin_orders()
    for batch in batches:
        for start, end, data, offsets in tokens.slices(batch.column("text")):
            sets = words.shingle_sets(words.lower_ascii(data), offsets, SHINGLE)
            names, halves, sketches = [], [], []
            for s in sets:
                if not len(s):
                    names.append(None)
                    halves.append([])
                    sketches.append(b"")
                    continue
                least = np.full(len(a), np.iinfo(np.uint64).max)
                for k in range(0, len(s), 4096):
                    np.minimum(least, words.mix(s[k : k + 4096, None] * a + b).min(axis=0), out=least)
                pairs = least.reshape(2 * HALVES, VALUES)
                key = words.mix(pairs[:, 0] * np.uint64(0x9E3779B97F4A7C15) + pairs[:, 1] + np.arange(2 * HALVES, dtype=np.uint64))
                names.append(_name(s))
                halves.append(key.view(np.int64))
                sketches.append(sketch_bits(s, orders))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c)[start:end] for c in ("doc_id", "mark", "row")], pa.array([len(s) for s in sets], pa.int64()), pa.array(names, pa.int64()),
                 pa.array(halves, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                names=["doc_id", "mark", "row", "n_shingles", "node", "halves", "sketch"],
            )


def sketches(docs: DataFrame, row: Column | None = None) -> DataFrame:
    """doc_id, mark (hash of the text), row (its number, if there is one), n_shingles, node (hash
    of the shingle set), half-keys and sketch."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), (F.lit(0) if row is None else row).cast("long").alias("row"), text.alias("text"))
    return in_tasks(rows, _sketch, "doc_id long, mark long, row long, n_shingles long, node long, halves array<bigint>, sketch binary")


def blocked(rows: DataFrame, group: str, blocks: Column) -> DataFrame:
    """Rows of a group dealt to ``blocks`` blocks by node. A row is repeated for each pair
    (i, j) of its own block and another, so that all pairs of a group meet, and rows of one
    (group, i, j) stand together in one partition."""
    own = rows.withColumn("own", F.pmod(F.xxhash64("node"), blocks))
    met = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    dealt = met.select("*", F.col(group).alias("at"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    return dealt.repartition("at", "i", "j").sortWithinPartitions("at", "i", "j")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of each (at, i, j) that has several."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in ("at", "i", "j")], axis=1)
        starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            key = tuple(keys[a].tolist())
            if key != last:
                if sum(map(len, held)) > 1:
                    yield pa.concat_batches(held)
                held, last = [], key
            held.append(batch.slice(a, b - a))
    if sum(map(len, held)) > 1:
        yield pa.concat_batches(held)


def forest(run: pa.RecordBatch, links: Callable[[int, np.ndarray], np.ndarray]) -> tuple[list[int], list[int]]:
    """Of the rows of one (at, i, j): places x and y of linked pairs that connect all that links
    connect. ``links`` gives of a row and others those that are linked, and is asked about
    pairs of alike sizes and sketches that are not connected yet."""
    own, sizes = run.column("own").to_numpy(), run.column("n_shingles").to_numpy()
    sketches = tokens.buffers(run.column("sketch"))[0].reshape(run.num_rows, -1).copy().view(np.uint64)
    across = run.column("i")[0] != run.column("j")[0]
    label, xs, ys = np.arange(run.num_rows), [], []
    for x in range(run.num_rows - 1):
        others = x + 1 + np.flatnonzero(label[x + 1 :] != label[x])
        if across:
            others = others[own[others] != own[x]]
        least = np.minimum(sizes[others], sizes[x])
        ratio = 100 * least >= PERCENT * np.maximum(sizes[others], sizes[x])
        others, least = others[ratio], least[ratio]
        others = others[estimates(sketches[others], sketches[x]) >= np.where(least < SMALL_SET, LEAST_OF_SMALL, LEAST_ESTIMATE)]
        for y in links(x, others).tolist() if len(others) else ():
            if label[y] != label[x]:
                xs.append(x)
                ys.append(y)
                label[label == label[y]] = label[x]
    return xs, ys


def _edges(run: pa.RecordBatch, xs: list[int], ys: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([run.column("node").take(pa.array(places, pa.int64())) for places in (xs, ys)], names=["x", "y"])


def _related(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for run in _runs(batches):
        second = run.column("second").flatten().to_numpy().reshape(run.num_rows, -1)
        xs, ys = forest(run, lambda x, others, second=second: others[(second[others] == second[x]).any(axis=1)])
        if xs:
            yield _edges(run, xs, ys)


def families(nodes: DataFrame) -> DataFrame:
    """node and label of every node that candidate pairs connect with others."""
    half = written(nodes.select("node", F.explode(F.slice("halves", 1, HALVES)).alias("half")), "halves")
    shared = written(half.groupBy("half").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared-halves")
    facts = nodes.select("node", "n_shingles", "sketch", F.slice("halves", HALVES + 1, HALVES).alias("second"))
    members = half.join(shared, "half").join(facts, "node")
    dealt = blocked(members, "half", F.greatest(F.floor(F.sqrt(F.col("n") / PER_BLOCK)), F.lit(1)))
    related = in_tasks(dealt.select("at", "i", "j", "own", "node", "n_shingles", "sketch", "second"), _related, "x long, y long")
    return components(written(related, "related"))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for run in _runs(batches):
        raw = pa.array([unpack.decompress(packed) for packed in run.column("packed").to_pylist()], pa.large_binary())
        sets = [found for _, _, data, offsets in tokens.slices(raw) for found in words.shingle_sets(data, offsets, SHINGLE)]
        names, ids = np.unique(np.concatenate(sets), return_inverse=True)
        at, seen = np.cumsum([0, *map(len, sets)]), np.zeros(len(names), bool)
        sizes = np.diff(at)

        def links(x: int, others: np.ndarray, ids=ids, at=at, seen=seen, sizes=sizes) -> np.ndarray:
            own = ids[at[x] : at[x + 1]]
            seen[own] = True
            hits = seen[np.concatenate([ids[at[y] : at[y + 1]] for y in others.tolist()])]
            seen[own] = False
            ends = np.cumsum(sizes[others])
            common = np.add.reduceat(hits, ends - sizes[others], dtype=np.int64)
            return others[100 * common >= PERCENT * (sizes[x] + sizes[others] - common)]

        xs, ys = forest(run, links)
        if xs:
            yield _edges(run, xs, ys)


def confirmed(nodes: DataFrame, grouped: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (x, y) of full shingle sets that connect what all links of a family connect."""
    members = written(grouped.join(nodes.select("node", "n_shingles", "sketch"), "node"), "members")
    sizes = members.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("shingles"))
    blocks = F.greatest(F.floor(F.sqrt(F.col("n") / PER_FAMILY_BLOCK)), F.ceil(F.col("shingles") / BLOCK_SHINGLES), F.lit(1))
    dealt = blocked(members.join(sizes, "label").join(texts, "node"), "label", blocks)
    return written(in_tasks(dealt.select("at", "i", "j", "own", "node", "n_shingles", "sketch", "packed"), _confirm, "x long, y long"), "links")


def _name(shingles: np.ndarray) -> int:
    """A node's name: a 64-bit hash of its shingle set."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        packed = []
        nodes = batch.column("node").to_pylist()
        for start, _, data, at in tokens.slices(batch.column("text")):
            lower = words.lower_ascii(data)
            raw = lower.tobytes()
            for k, (shingles, i, j) in enumerate(zip(words.shingle_sets(lower, at, SHINGLE), at[:-1].tolist(), at[1:].tolist(), strict=True)):
                # Another text of the same id and hash is not this node's.
                packed.append(pack.compress(raw[i:j]) if _name(shingles) == nodes[start + k] else None)
        right = pa.RecordBatch.from_arrays([batch.column("node"), pa.array(packed, pa.binary())], names=["node", "packed"])
        yield right.filter(right.column("packed").is_valid())


def maybe_among(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows whose ``mark`` may be one of the wanted: all that are and, of 2**25 bits where n
    are set, a share n / 2**25 of the others, which are not shuffled then."""

    def place(of: int) -> Column:
        return F.pmod("mark", F.lit(FILTER_BITS)) % of

    row = F.floor(place(FILTER_BITS) / FILTER_ROW).alias("__bits")
    bits = F.broadcast(wanted.groupBy(row).agg(F.bitmap_construct_agg(place(FILTER_ROW)).alias("__set")))  # FILTER_BITS / 8 bytes at most
    byte = F.conv(F.hex(F.substring("__set", F.floor(place(FILTER_ROW) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return rows.withColumn("__bits", row).join(bits, "__bits").filter(F.pmod(F.floor(byte / F.pow(F.lit(2), place(8))), F.lit(2)) == 1).select(*rows.columns)


def _least(*names: str) -> Column:
    """Of the rows the one with the least values; an id that is null comes after all others."""
    return F.min(F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", *names))


def grouped_nodes(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Of the documents and their sketches: node, label (of its component), and doc_id, mark
    and row of the node's least row."""
    nodes = written(
        rows.filter("n_shingles > 0").groupBy("node").agg(
            _least("mark", "row").alias("least"), F.first("n_shingles").alias("n_shingles"), F.first("halves").alias("halves"), F.first("sketch").alias("sketch")
        ).select("node", "least.doc_id", "least.mark", "least.row", "n_shingles", "halves", "sketch"),
        "nodes",
    )
    family = families(nodes)
    wanted = written(family.select("node").join(nodes.select("node", "doc_id", "mark"), "node"), "wanted")
    lost = F.lit(-(1 << 62))
    # By id and text, so that rows of one id, or of none, meet just the node of their own text.
    marked = text_rows(docs).select(F.coalesce("doc_id", lost).alias("id"), F.xxhash64("text").alias("mark"), "text")
    found = maybe_among(marked, wanted).join(wanted.select("node", F.coalesce("doc_id", lost).alias("id"), "mark"), ["id", "mark"])
    packed = in_tasks(found.select("node", "text"), _pack, "node long, packed binary")
    # Rows that are equal in both: one of them is enough.
    texts = written(packed.groupBy("node").agg(F.first("packed").alias("packed")), "texts")
    labels = components(confirmed(nodes, family, texts))
    return written(nodes.select("node", "doc_id", "mark", "row").join(labels, "node", "left").select("node", "doc_id", "mark", "row", F.coalesce("label", "node").alias("label")), "grouped")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    rows = written(sketches(docs), "sketches")
    grouped = grouped_nodes(docs, rows)
    names = written(grouped.groupBy("label").agg(F.min("doc_id").alias("component_id")), "names")
    of_node = written(grouped.join(names, "label").select("node", "component_id"), "classes")
    linked = rows.filter("n_shingles > 0").select("doc_id", "n_shingles", "node").join(of_node, "node").select("doc_id", "n_shingles", "component_id")
    alone = rows.filter("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents with all their columns, one row of each component: of the smallest id, of
    these the text of least hash. Texts without words are linked with nothing and stay."""
    # Rows that are equal in everything are told apart by a number, which is written with them.
    numbered = written(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    rows = written(sketches(numbered, F.col("__row")), "sketches")
    first = grouped_nodes(numbered, rows).groupBy("label").agg(_least("mark", "row").alias("least")).select("least.row")
    stay = first.union(rows.filter("n_shingles = 0").select("row"))
    return numbered.join(stay, numbered["__row"] == stay["row"], "left_semi").drop("__row")
