"""The prefix trie of conversations against a plain trie."""

import collections
import hashlib
import random
import re
import zlib

import pytest

from lendmill.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, conv long, depth long, name string, rep long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "n", 3) for r in rows], SCHEMA)


def plain(rows):
    said = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            said[c].append((turn is not None, turn or 0, role.encode(), text[:16].encode(), mark, (role, text)))
    own = {c: [t[-1] for t in sorted(ts, key=lambda t: t[:-1])] for c, ts in said.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:h] + own[c][h:]
    members = collections.defaultdict(list)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = collections.defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall("[^\x20\x09-\x0d]+", node[-1][1])) if node else 0
        below = [totals[x] for x in children[node]]
        totals[node] = (sum(x[0] for x in below) or 1, (len(members[node]) - 1) * words + sum(x[1] for x in below))
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(node))
        yield (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children[node]), *totals[node], hashlib.sha256(ends.encode()).hexdigest())


def same(spark, rows):
    got = [tuple(r) for r in trie.node_table(frame(spark, rows)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain(rows)))


def test_short_conversations(spark):
    draw = random.Random(3)
    rows = [(c, t, draw.choice(["user", "assistant", None]), draw.choice(["hello there", "", None, "a b  c", "x"])) for c in range(-30, 130) for t in range(draw.randint(1, 9))]
    rows += [(45, None, "user", "first"), (45, 3, "user", "tie"), (45, 3, "user", "tie"), (45, 3, "assistant", "tie"), (45, 3, "user", None), (None, 1, "user", "lost"), (9001, 0, "user", "far"), (9002, 0, "user", "far")]
    draw.shuffle(rows)
    same(spark, rows)


@pytest.mark.parametrize("size", [63, 64, 65, 129, 300])
def test_long_conversations(spark, size):
    rows = []
    for c, parting in ((20, size), (21, size), (22, size - 1), (23, size // 2), (24, 63), (25, 65), (26, 3), (40, 1)):
        rows += [(c, t, "user", f"turn {t}" if t < parting else f"turn {t} of {c}") for t in range(size - (c == 22))]
    same(spark, rows)


def test_many_copies_end_at_one_node(spark, monkeypatch):
    monkeypatch.setattr(trie, "RUN", 7)
    same(spark, [(c * 20, t, "user", f"t{t}") for c in range(-60, 400) for t in range(3)])


def test_turns_of_equal_number_are_ordered_by_their_whole_text(spark):
    draw = random.Random(11)
    ended = [f"the same beginning of {x}" for x in ("a", "b b", "c c c", "\u00e9", "\uffee x", "\U0001f600 y z", "")]
    said = sorted(((role, text) for role in ("assistant", "user") for text in [*ended, "short", ""]), key=lambda s: (s[0].encode(), s[1].encode()))
    convs = {c: [(turn, said if c % 3 else said[: 9 + c % 5]) for turn in (None, 1, 7)] for c in (20, 21, 22, 23, 27, 39, 40, 41)}
    rows, numbered = [], []
    for c, blocks in convs.items():
        rows += [(c, turn, *s) for turn, block in blocks for s in block]
        numbered += [(c, t, *s) for t, s in enumerate(s for _, block in blocks for s in block)]
    draw.shuffle(rows)
    got = [tuple(r) for r in trie.node_table(frame(spark, rows)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, plain(numbered)))


def test_no_rows(spark):
    assert trie.node_table(frame(spark, [])).count() == 0
    assert trie.node_table(frame(spark, [(None, 1, "user", "x")])).count() == 0
