"""A Merkle manifest of a dataset, by checkpoint and recompute.

Every row is a leaf. The leaves of a source, in the order of their ids, are hashed up in runs
of ``FAN``; the roots of the sources are hashed up in the same way to one root. Of a tree only
every ``KEEP``-th level is stored. Between two stored levels lie aligned subtrees of at most
FAN ** KEEP stored nodes each: building climbs from these to the one node of the next stored
level, and forgets what lies between. Proofs are extracted from the top down: for each subtree
the missing inner nodes are computed again from its stored nodes, the siblings along the way of
each are appended to what leads from the subtree to the root, and the inner nodes are
discarded.

A source is no task's load: places of leaves come from ranges (``ranks.placed``), and what a
task holds at a time is one subtree.

Defined cases: a null field is ``-``; rows without an id come first in their source, and are
not tampered with; rows that share source and id are ordered by their leaves; repeated rows
are leaves of their own; a null source is a source of its own, before all others; a source of
one leaf has that leaf as its root, a table of one source that source's root; an empty table
has no rows and no root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.llm.common import in_tasks, written
from lendmill.llm.ranks import placed

#: Nodes of a run; levels between two stored ones.
FAN, KEEP = 3, 3
SUBTREE = FAN**KEEP
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Subtrees that a task opens at a time.
OPEN = 256
GROUP = ["named", "src"]


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above n leaves."""
    levels, nodes = 0, 1
    while nodes < n:
        levels, nodes = levels + 1, nodes * FAN
    return levels


def risen(nodes: Sequence[str], levels: int) -> list[list[str]]:
    """The nodes of a subtree, level by level from the given ones on."""
    found = [list(nodes)]
    for _ in range(levels):
        below = found[-1]
        found.append([digest(*below[i : i + FAN]) for i in range(0, len(below), FAN)])
    return found


def climbs(nodes: Sequence[str], levels: int) -> list[list[str]]:
    """For each node the steps of its way up: its place in the run, then its siblings."""
    by_level = risen(nodes, levels)
    ways: list[list[str]] = []
    for i in range(len(nodes)):
        way, at = [], i
        for level in by_level[:levels]:
            first = at - at % FAN
            siblings = level[first : first + FAN]
            own = at - first
            way.append(str(own) + "".join(siblings[:own] + siblings[own + 1 :]))
            at //= FAN
        ways.append(way)
    return ways


def folded(node: str, way: Sequence[str]) -> str:
    """The root that a node and the siblings on its way lead to."""
    for step in way:
        own, others = int(step[0]), step[1:]
        cut = 64 * own
        node = digest(others[:cut], node, others[cut:])
    return node


def _levels(n: int, stored: int) -> int:
    """Levels from a stored level to the next, or to the top of a tree of n leaves."""
    return min(KEEP, height(n) - KEEP * stored)


def _tops(stored: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            top = []
            for at in range(0, batch.num_rows, OPEN):
                part = batch.slice(at, OPEN)
                for n, nodes in zip(part.column("n").to_pylist(), part.column("nodes").to_pylist(), strict=True):
                    top.append(risen([x["digest"] for x in nodes], _levels(n, stored))[-1][0])
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (*GROUP, "pos", "n")], pa.array(top, pa.string())], names=[*GROUP, "pos", "n", "digest"])

    return run


def _ways(stored: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, OPEN):
                part = batch.slice(at, OPEN).to_pylist()
                rows = []
                for one in part:
                    nodes = one["nodes"]
                    for x, way in zip(nodes, climbs([x["digest"] for x in nodes], _levels(one["n"], stored)), strict=True):
                        rows.append((one["named"], one["src"], x["pos"], one["subroot"], [*way, *one["way"]]))
                yield pa.RecordBatch.from_pylist([dict(zip(_WAY.names, r, strict=True)) for r in rows], schema=_WAY)

    return run


_WAY = pa.schema([("named", pa.bool_()), ("src", pa.string()), ("pos", pa.int64()), ("subroot", pa.string()), ("way", pa.list_(pa.string()))])
_WAY_SQL = "named boolean, src string, pos long, subroot string, way array<string>"


class Tree:
    """The stored levels of the trees of all groups, as tables of subtrees."""

    def __init__(self, leaves: DataFrame, more: Sequence[str] = ()):
        """``leaves``: named, src, pos, n, digest and what else leaves carry."""
        most = leaves.agg(F.max("n")).first()[0] or 0
        self.stored: list[DataFrame] = []
        self.tops: list[DataFrame] = []
        nodes = leaves
        while True:
            level = len(self.stored)
            fields = ["pos", "digest", *(() if level else more)]
            # A subtree of the next stored level has SUBTREE nodes of this one at most.
            subtrees = nodes.groupBy(*GROUP, F.floor(F.col("pos") / SUBTREE).alias("pos")).agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct(*fields))).alias("nodes"))
            self.stored.append(written(subtrees, f"manifest-level-{KEEP * level}"))
            above = written(in_tasks(self.stored[-1], _tops(level), "named boolean, src string, pos long, n long, digest string"), f"manifest-tops-{KEEP * level}")
            reach = SUBTREE ** (level + 1)
            self.tops.append(above.filter(F.col("n") <= reach))
            if most <= reach:
                break
            nodes = above.filter(F.col("n") > reach)

    def roots(self) -> DataFrame:
        """named, src, digest of the root of each group."""
        found = [t.select(*GROUP, "digest") for t in self.tops]
        whole = found[0]
        for other in found[1:]:
            whole = whole.unionByName(other)
        return whole

    def subtrees(self, beyond: DataFrame) -> DataFrame:
        """The lowest stored level with what leads from each subtree's top to the end of ``beyond``
        (named, src, subroot, way: from the root of each group on)."""
        below = None
        for level in reversed(range(len(self.stored))):
            whole = self.tops[level].select(*GROUP).join(beyond, GROUP).select(*GROUP, F.lit(0).cast("long").alias("pos"), "subroot", "way")
            ways = whole if below is None else whole.unionByName(below)
            found = self.stored[level].join(ways, [*GROUP, "pos"])
            if not level:
                return found
            below = written(in_tasks(found, _ways(level), _WAY_SQL), f"manifest-ways-{KEEP * level}")
        raise AssertionError


def field(name: str, value: Column) -> Column:
    text = value.cast("string") if name in ("doc_id", "n_chars") else value
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(text: Column) -> Column:
    return F.sha2(F.concat(*[field(name, text if name == "text" else F.col(name)) for name in FIELDS]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """named, src, doc_id, digest, and tampered: the leaf after line breaks are deleted from the
    texts of every second row (by the checksum of the id), null where nothing changes."""
    odd = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    without = F.replace(F.col("text"), F.lit("\n"))
    return docs.select(
        F.col("source").isNotNull().alias("named"), F.coalesce("source", F.lit("")).alias("src"), F.col("doc_id").cast("long").alias("doc_id"), leaf_of(F.col("text")).alias("digest"),
        F.when(odd & F.contains(F.col("text"), F.lit("\n")), leaf_of(without)).alias("tampered"),
    )


SCHEMA = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _proofs(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, OPEN):
                part = batch.slice(at, OPEN)
                out: list[list] = [[] for _ in range(7)]
                for one in part.to_pylist():
                    nodes = one["nodes"]
                    for x, way in zip(nodes, climbs([x["digest"] for x in nodes], _levels(one["n"], 0)), strict=True):
                        way = [*way, *one["way"]]
                        end = folded(x["tampered"] or x["digest"], way)
                        row = (x["doc_id"], x["digest"], one["subroot"], root, digest(*[step[1:] for step in way]), end, end == root)
                        for column, value in zip(out, row, strict=True):
                            column.append(value)
                kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
                )

    return run


def trees(docs: DataFrame) -> tuple[Tree, DataFrame, Tree]:
    """The trees of the sources, their roots in order (named, src: one group; key and what the
    source was), and the tree over these."""
    lower = Tree(placed(leaves(docs), GROUP, ["doc_id", "digest"], "leaves"), ["doc_id", "tampered"])
    one = F.lit(True).alias("named"), F.lit("").alias("src")
    roots = lower.roots().select(*one, F.col("named").alias("of_named"), F.col("src").alias("of_src"), "digest")
    ordered = written(placed(roots, GROUP, ["of_named", "of_src"], "sources"), "source-roots")
    return lower, ordered, Tree(ordered.select(*GROUP, "pos", "n", "digest"))


def proofs(docs: DataFrame) -> DataFrame:
    """Leaf, roots, a digest of the proof, and the root that a tampered row leads to."""
    lower, sources, upper = trees(docs)
    found = upper.roots().select("digest").first()  # one row
    if found is None:
        return docs.sparkSession.createDataFrame([], SCHEMA)
    empty = upper.roots().select(*GROUP, F.col("digest").alias("subroot"), F.array().cast("array<string>").alias("way"))
    ways = in_tasks(upper.subtrees(empty), _ways(0), _WAY_SQL)
    beyond = sources.join(ways.select("pos", "way"), "pos").select(F.col("of_named").alias("named"), F.col("of_src").alias("src"), F.col("digest").alias("subroot"), "way")
    return in_tasks(lower.subtrees(written(beyond, "source-ways")), _proofs(found["digest"]), SCHEMA)
