"""The prefix trie of conversations, by van Emde Boas recursion on its depth.

A conversation is a sequence of turns; each distinct prefix is a node. Depths are halved again
and again:

* Naming. A sequence is cut at half its depth. The cut prefix is named by a hash of the name
  at the cut above and the hash of the block between the two cuts; then the upper half is
  named below the old name and the lower half below the new one. Blocks of ``SEGMENT`` turns
  are cut by this recursion inside a task, the cuts between them by joins, one per halving.
* Totals. At each halving, from the smallest halves to the whole, the lower trees (rooted at
  the cuts) have their totals already. They are grafted upward: summed over the roots that
  share a parent, and added to the nodes of the upper trie from that parent up to its root.
  Every pair of a node and an ancestor is parted by exactly one cut, so each node's share
  reaches each ancestor once. The shares of one halving are at most half as many as turns.

Names are 128 bits of SHA-256 and serve only to find equal prefixes; afterwards a node is its
smallest member and its depth. A conversation of any length spans as many tasks as it needs:
places of turns come from ranges (``ranks.placed``), and a task holds one block at a time.
The members that end at a node are sorted by ranges too, and hashed as a stream of
joined runs of ids.

Defined cases: null role and text are empty; turns of equal number are ordered by role, then
by their whole text; repeated rows are turns of their own;
rows without a conversation id belong to no conversation and are left out; a conversation whose
prefix is absent or short may have no turns and ends at the root; an empty table has no
nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendmill.llm.common import in_tasks, written
from lendmill.llm.ranks import placed

#: Conversations of so many neighbouring ids share the first turns of the first of them.
FAMILY = 20
#: Most turns that are taken over, and one more.
TAKEN = 4
#: Turns of a block that a task cuts by itself (a power of two).
SEGMENT = 64
#: Ids in a run of the members that end at a node.
RUN = 4096
WORD = "[^\\x20\\x09-\\x0D]+"
ROOT = b"\0" * 16


def _hash(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).digest()[:16]


def turns(conversations: DataFrame) -> DataFrame:
    """conv, pos and n of every turn, with the hash and the words of what was said."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    said = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    whole = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").cast("long").alias("turn"), role.alias("role"), F.left(text, F.lit(16)).alias("head"),
        F.unhex(F.substring(said, 1, 32)).alias("mark"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), text.alias("text"),
    )
    return placed(text_ranks(whole), ["conv"], ["turn", "role", "head", "rank"], "turns").select("conv", "pos", "n", "mark", "words")


def text_ranks(whole: DataFrame) -> DataFrame:
    """The rows without their texts, and ``rank``: the place of a text among the others of one
    conversation, number and role that begin alike. Just the texts of such ties are sorted."""
    place = ["conv", "turn", "role", "head"]
    rows = whole.drop("text")
    apart = rows.groupBy(*place).agg(F.min("mark").alias("least"), F.max("mark").alias("most")).filter("least <> most")
    ties = written(apart.select(*place, F.monotonically_increasing_id().alias("tie")), "ties")
    if not ties.limit(1).count():
        return rows.withColumn("rank", F.lit(0).cast("long"))

    def with_tie(some: DataFrame, how: str) -> DataFrame:
        named = ties.select(*[F.col(c).alias(f"__{c}") for c in place], "tie")
        alike = [some[c].eqNullSafe(named[f"__{c}"]) if c == "turn" else some[c] == named[f"__{c}"] for c in place]
        return some.join(named, alike, how).drop(*[f"__{c}" for c in place])

    texts = with_tie(whole.select(*place, "mark", "text"), "inner").select("tie", "mark", "text").distinct()
    ranks = written(placed(texts, ["tie"], ["text"], "tied-texts").select("tie", "mark", F.col("pos").alias("rank")), "ranks")
    return with_tie(rows, "left").join(ranks, ["tie", "mark"], "left").select(*rows.columns, F.coalesce("rank", F.lit(0)).cast("long").alias("rank"))


def rebuilt(found: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sequences (conv, depth from 1, mark, words) and the conversations (conv, len): the first
    turns come from the first conversation of the family."""
    found = written(found, "turns")
    taken = F.crc32(F.col("conv").cast("string")) % TAKEN
    whole = found.filter("pos = 0").select("conv", "n", taken.alias("taken"), (F.col("conv") - F.col("conv") % FAMILY).alias("family"))
    heads = whole.select(F.col("conv").alias("family"), F.col("n").alias("family_n"))
    convs = whole.join(heads, "family", "left").select("conv", "family", "n", "taken", F.least("taken", F.coalesce("family_n", F.lit(0))).alias("given"))
    convs = written(convs.withColumn("len", F.col("given") + F.greatest(F.col("n") - F.col("taken"), F.lit(0))), "conversations")
    first = found.filter(F.col("pos") < TAKEN - 1).select(F.col("conv").alias("family"), "pos", "mark", "words")
    over = convs.filter("given > 0").join(first, "family").filter(F.col("pos") < F.col("given")).select("conv", (F.col("pos") + 1).alias("depth"), "mark", "words")
    own = found.join(convs.select("conv", "taken", "given"), "conv").filter(F.col("pos") >= F.col("taken"))
    own = own.select("conv", (F.col("given") + F.col("pos") - F.col("taken") + 1).alias("depth"), "mark", "words")
    return written(over.unionByName(own), "sequences"), convs.select("conv", "len")


def block(marks: list[bytes], lo: int, hi: int, known: dict[tuple[int, int], bytes]) -> bytes:
    """The hash of a block, from those of its halves."""
    if hi - lo == 1:
        return marks[lo]
    if (lo, hi) not in known:
        mid = (lo + hi) // 2
        known[lo, hi] = _hash(block(marks, lo, mid, known), block(marks, mid, hi, known))
    return known[lo, hi]


def cut_names(marks: list[bytes], start: bytes) -> list[bytes]:
    """Names of the prefixes of 1, 2, ... SEGMENT - 1 turns of a block that begins under the name
    ``start``: the prefix at half depth is named, then the upper and the lower half."""
    names: list[bytes] = [b""] * (SEGMENT + 1)
    known: dict[tuple[int, int], bytes] = {}
    halves = [(0, SEGMENT, start)]
    while halves:
        lo, hi, name = halves.pop()
        if hi - lo < 2:
            continue
        mid = (lo + hi) // 2
        halves.append((lo, mid, name))
        if mid <= len(marks):
            names[mid] = _hash(name, block(marks, lo, mid, known))
            halves.append((mid, hi, names[mid]))
    return names[1:SEGMENT]


def _segments(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, list[dict]]]:
    """Runs of rows of one block (conv, segment), across batches."""
    key, rows = None, []
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            for row in batch.slice(at, 1024).to_pylist():
                here = (row["conv"], row["segment"])
                if here != key:
                    if rows:
                        yield key, rows
                    key, rows = here, []
                rows.append(row)
    if rows:
        yield key, rows


def _flushed(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= 5000:
            yield batch()
            held = []
    if held:
        yield batch()


_BLOCKS = pa.schema([("conv", pa.int64()), ("at", pa.int64()), ("block", pa.binary())])
_NAMES = pa.schema([("conv", pa.int64()), ("depth", pa.int64()), ("name", pa.binary()), ("words", pa.int64())])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[tuple]:
        for (conv, segment), rows in _segments(batches, []):
            if len(rows) == SEGMENT:
                yield conv, segment, block([r["mark"] for r in rows], 0, SEGMENT, {})

    return _flushed(found(), _BLOCKS)


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def found() -> Iterator[tuple]:
        for (conv, segment), rows in _segments(batches, []):
            names = [*cut_names([r["mark"] for r in rows], rows[0]["start"]), rows[0]["end"]]
            for row, name in zip(rows, names, strict=False):
                yield conv, row["depth"], name, row["words"]

    return _flushed(found(), _NAMES)


def _together(*parts: Column | str) -> Column:
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def segment_names(sequences: DataFrame, longest: int) -> DataFrame | None:
    """conv, segment, start and end: the names of the prefixes before and after each block, for
    conversations of at least one full block."""
    if longest < SEGMENT:
        return None
    full = in_tasks(sequences.repartition("conv", "segment").sortWithinPartitions("conv", "segment", "depth").select("conv", "segment", "mark"), _blocks, "conv long, at long, block binary")
    blocks = [written(full, "blocks")]
    while 1 << len(blocks) <= longest // SEGMENT:
        pairs = blocks[-1].groupBy("conv", F.shiftright("at", 1).alias("pair")).agg(F.sort_array(F.collect_list(F.struct("at", "block"))).alias("two")).filter(F.size("two") == 2)
        blocks.append(written(pairs.select("conv", F.col("pair").alias("at"), _together(F.col("two")[0]["block"], F.col("two")[1]["block"]).alias("block")), "blocks"))
    cuts = blocks[0].select("conv").distinct().select("conv", F.lit(0).cast("long").alias("cut"), F.lit(ROOT).alias("name"))
    for level in reversed(range(len(blocks))):
        # Between two cuts of the level above lies one more, where the upper block is whole.
        upper = blocks[level].filter(F.col("at") % 2 == 0).select("conv", F.shiftleft("at", level).alias("cut"), "block")
        lower = cuts.join(upper, ["conv", "cut"]).select("conv", (F.col("cut") + (1 << level)).alias("cut"), _together("name", "block").alias("name"))
        cuts = written(cuts.unionByName(lower), "cuts")
    after = cuts.select("conv", (F.col("cut") - 1).alias("cut"), F.col("name").alias("end"))
    return cuts.join(after, ["conv", "cut"], "left").select("conv", F.col("cut").alias("segment"), F.col("name").alias("start"), "end")


def prefixes(sequences: DataFrame, longest: int) -> DataFrame:
    """conv, depth, words, and name: equal for equal prefixes."""
    rows = sequences.withColumn("segment", F.floor((F.col("depth") - 1) / SEGMENT))
    known = segment_names(rows, longest)
    if known is None:
        rows = rows.withColumns({"start": F.lit(ROOT), "end": F.lit(None).cast("binary")})
    else:
        rows = rows.join(known, ["conv", "segment"], "left").withColumn("start", F.coalesce("start", F.lit(ROOT)))
    ordered = rows.repartition("conv", "segment").sortWithinPartitions("conv", "segment", "depth")
    return in_tasks(ordered.select("conv", "segment", "depth", "mark", "words", "start", "end"), _names, "conv long, depth long, name binary, words long")


def totals(nodes: DataFrame, chain: DataFrame, longest: int) -> DataFrame:
    """rep, depth, n_leaves and saved of every node's subtree.

    ``nodes``: rep, depth, parent and the node's own n_leaves and saved; ``chain``: for every
    conversation and depth the node there (rep) and its parent."""
    shares = [nodes.select("rep", "depth", "parent", "n_leaves", "saved")]
    half = 1
    while half <= longest:
        roots = None
        for some in shares:
            # The roots of the lower trees: below an odd number of halves.
            part = some.filter(F.col("depth").bitwiseAND(2 * half - 1) == half)
            roots = part if roots is None else roots.unionByName(part)
        grafts = roots.groupBy("parent", "depth").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
        # The parent's own way up to the upper trie's root is in its smallest member's chain.
        step = half.bit_length() - 1
        upper = chain.select(F.col("conv").alias("parent"), F.shiftright("depth", step).alias("part"), "rep", F.col("depth").alias("at"), F.col("parent").alias("above"))
        met = grafts.withColumn("part", F.shiftright(F.col("depth") - half, step)).select("parent", "part", "n_leaves", "saved").join(upper, ["parent", "part"])
        shares.append(written(met.select("rep", F.col("at").alias("depth"), F.col("above").alias("parent"), "n_leaves", "saved"), "grafts"))
        half *= 2
    whole = shares[0]
    for some in shares[1:]:
        whole = whole.unionByName(some)
    return whole.groupBy("rep", "depth").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted ids of one node, joined by commas, under their first id."""

    def found() -> Iterator[tuple]:
        key, ids = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("rep", "depth", "conv")]
            for rep, depth, conv in zip(*columns, strict=True):
                if key != (rep, depth) or len(ids) >= RUN:
                    if ids:
                        yield *key, ids[0], ",".join(map(str, ids))
                    key, ids = (rep, depth), []
                ids.append(conv)
        if ids:
            yield *key, ids[0], ",".join(map(str, ids))

    return _flushed(found(), pa.schema([("rep", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())]))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each node's runs in order, joined by commas; runs pass one by one."""

    def found() -> Iterator[tuple]:
        key, running = None, hashlib.sha256()
        for batch in batches:
            for rep, depth, ids in zip(batch.column("rep").to_pylist(), batch.column("depth").to_pylist(), batch.column("ids"), strict=True):
                if key == (rep, depth):
                    running.update(b",")
                else:
                    if key is not None:
                        yield *key, running.hexdigest()
                    key, running = (rep, depth), hashlib.sha256()
                running.update(ids.as_py().encode())
        if key is not None:
            yield *key, running.hexdigest()

    return _flushed(found(), pa.schema([("rep", pa.int64()), ("depth", pa.int64()), ("ends", pa.string())]))


def end_digests(ends: DataFrame) -> DataFrame:
    """rep, depth and the hash of the ids (rep, depth, conv) that end there."""
    keys = ["rep", "depth", "conv"]
    ordered = ends.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*keys)
    runs = written(in_tasks(ordered, _runs, "rep long, depth long, first long, ids string"), "runs")
    streams = runs.repartition("rep", "depth").sortWithinPartitions("rep", "depth", "first")
    return in_tasks(streams, _digests, "rep long, depth long, ends string")


def node_table(conversations: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
    of every node."""
    sequences, convs = rebuilt(turns(conversations))
    bounds = convs.agg(F.min("conv").alias("least"), F.max("len").alias("longest"), F.count(F.lit(1)).alias("n")).first()  # one row
    root, longest = bounds["least"], bounds["longest"] or 0
    named = written(prefixes(sequences, longest), "prefixes")
    groups = written(named.groupBy("name").agg(F.min("conv").alias("rep"), F.count(F.lit(1)).alias("n"), F.first("depth").alias("depth"), F.first("words").alias("words")), "prefix-groups")
    at = written(named.select("conv", "depth", "name").join(groups.select("name", "rep"), "name").select("conv", "depth", "rep"), "members")
    above = at.select("conv", (F.col("depth") + 1).alias("depth"), F.col("rep").alias("parent"))
    top = convs.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(root).cast("long").alias("rep"), F.lit(None).cast("long").alias("parent"))
    below = at.join(above, ["conv", "depth"], "left").select("conv", "depth", "rep", F.coalesce("parent", F.lit(root)).cast("long").alias("parent"))
    chain = written(below.unionByName(top), "chain")
    one = groups.select("rep", "depth", "n", "words")
    if root is not None:
        one = one.unionByName(convs.filter(F.col("conv") == root).select(F.col("conv").alias("rep"), F.lit(0).cast("long").alias("depth"), F.lit(bounds["n"]).alias("n"), F.lit(0).cast("long").alias("words")))
    nodes = chain.filter("conv = rep").select("rep", "depth", "parent").join(one, ["rep", "depth"])
    nodes = written(nodes, "trie-nodes")
    children = nodes.filter("depth > 0").groupBy(F.col("parent").alias("rep"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    facts = nodes.join(children, ["rep", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    facts = written(facts.withColumns({"n_leaves": (F.col("n_children") == 0).cast("long"), "saved": (F.col("n") - 1) * F.col("words")}), "trie-facts")
    ends = convs.select("conv", F.col("len").alias("depth")).join(chain.select("conv", "depth", "rep"), ["conv", "depth"])
    whole = facts.drop("n_leaves", "saved").join(totals(facts, chain, longest), ["rep", "depth"]).join(end_digests(ends), ["rep", "depth"], "left")
    return whole.select(
        F.col("rep").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
