"""Line deduplication and the Merkle manifest against plain versions."""

import collections
import hashlib
import zlib

import pytest

from lendmill.llm import lines, manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, line string, pos long, digest string, key string"
BLANK = " \t\n\x0b\x0c\r"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "l", 2, "d", "k") for r in rows], SCHEMA)


def plain_lines(rows):
    small = str.maketrans(lines.CAPITALS, lines.SMALL)
    holders = collections.defaultdict(set)
    lowest = -(1 << 63)
    for k, text, *_ in rows:
        for x in (text or "").split("\n"):
            if len(x.strip(BLANK)) >= 20:
                holders[x.strip(BLANK).translate(small)].add(lowest if k is None else k)
    for k, text, *_ in rows:
        kept, all_lines = [], (text or "").split("\n")
        for x in all_lines:
            holding = holders.get(x.strip(BLANK).translate(small), ())
            if len(holding) < 3 or max(holding) == (lowest if k is None else k):
                kept.append(x)
        yield (k, len(all_lines), len(all_lines) - len(kept), sha("\n".join(kept)))


LICENSE, ACCENT = "All rights of this text are reserved", "Äußerst häufige Zeile ÄÖÜ"
TEXTS = [None, "", "\n", "one line", f"{LICENSE}\nown text here", f"  {LICENSE.upper()}\t\nmore\n", f"x\n{LICENSE}\r\n{LICENSE}", f"{ACCENT}\na", f"{ACCENT} \nb", f"b\n{ACCENT.swapcase()}\n{ACCENT}",
         f"{ACCENT}", "12345678901234567890\n1234567890123456789", "12345678901234567890 ", "\x0b12345678901234567890\n\n", "1234567890123456789", "1234567890123456789", "\n".join(f"line number {i} of a long text" for i in range(3000))]


def test_lines(spark):
    rows = [(i * 2, t, "x", "s", 1) for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[4], (None, LICENSE, None, None, None), (None, LICENSE, None, None, None), (8, "other text of an id", None, None, None), (-5, TEXTS[-1] + "\nend", "x", None, 1), (-6, TEXTS[-1], "x", None, 1)]
    same([tuple(r) for r in lines.kept_table(frame(spark, rows)).collect()], plain_lines(rows))
    assert lines.kept_table(frame(spark, [])).count() == 0


def test_lines_of_a_hot_line(spark):
    rows = [(i, f"{LICENSE}\nnumber {i}\n{LICENSE}", "x", "s", 1) for i in range(3000)]
    same([tuple(r) for r in lines.kept_table(frame(spark, rows)).collect()], plain_lines(rows))


def plain_manifest(rows):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, text):
        return sha("".join(field(v) for v in (r[0], r[3], r[2], r[4], text)))

    def siblings(nodes, at):
        ways = []
        while len(nodes) > 1:
            run = at - at % 3
            ways.append((nodes[run:at], nodes[at + 1 : run + 3]))
            nodes, at = [sha("".join(nodes[i : i + 3])) for i in range(0, len(nodes), 3)], at // 3
        return ways, nodes[0]

    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[3]].append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(g, key=lambda x: x[:3]) for s, g in groups.items()}
    roots = [siblings([x[2] for x in trees[s]], 0)[1] for s in order]
    for i, s in enumerate(order):
        above, root = siblings(roots, i)
        nodes = [x[2] for x in trees[s]]
        for at, (_, _, own, r) in enumerate(trees[s]):
            way = siblings(nodes, at)[0] + above
            bad = r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0
            end = leaf(r, r[1].replace("\n", "")) if bad else own
            for left, right in way:
                end = sha("".join([*left, end, *right]))
            yield (r[0], own, roots[i], root, sha("".join("".join(a + b) for a, b in way)), end, end == root)


@pytest.mark.parametrize("sizes", [[1], [3], [1, 1, 1, 1], [2, 28, 27, 9], [800, 5, 82, 81]])
def test_manifest(spark, sizes):
    rows = [(k * 3 - 7, f"text {k}\nof {i}", "de", ["b", None, "ä", "B"][i], k) for i, n in enumerate(sizes) for k in range(n)]
    same([tuple(r) for r in manifest.proofs(frame(spark, rows)).collect()], plain_manifest(rows))


def test_manifest_of_awkward_rows(spark):
    rows = [(1, "a\nb", None, "s", None), (1, "a\nb", None, "s", None), (1, "c", "x", "s", 3), (None, None, None, None, None), (None, "x\ny", "", "", 0), (None, "x\ny", "", "s", 0), (2, "", "é", "日本", -4), (0, "\n" * 70000, "x", "s", 9)]
    rows += [(5, "same\nrow", "x", "hot", 1)] * 100
    got = [tuple(r) for r in manifest.proofs(frame(spark, rows)).collect()]
    same(got, plain_manifest(rows))
    assert {r[-1] for r in got} == {True, False}
    assert manifest.proofs(frame(spark, [])).count() == 0
