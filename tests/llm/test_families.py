"""Near-duplicates are linked by brute force's links, while no pair of a group becomes a row."""

import random

import pytest

from lendmill.llm import tensor_minhash as M


def edited(n, places, seed):
    """Texts that differ from one original at some places."""
    draw, base, texts = random.Random(seed), [f"v{i}" for i in range(120)], []
    for _ in range(n):
        own = list(base)
        for at in draw.sample(range(120), draw.choice(places)):
            own[at] = f"n{draw.randrange(10**9)}"
        texts.append(" ".join(own))
    return texts


def smallest(texts):
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    label = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j in range(i):
            if label[i] != label[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if one == old else one for one in label]
    return dict(enumerate(label))


def found(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r["component_id"] for r in M.near_duplicates(docs).collect()}


def test_rows_do_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    # Most pairs are alike by their sketches, few are linked.
    texts, seen, kept = edited(160, [2], 1), {}, M.written

    def counted(df, label):
        out = kept(df, label)
        seen[label] = out.count()
        return out

    monkeypatch.setattr(M, "written", counted)
    assert found(spark, texts) == smallest(texts)
    assert max(seen.values()) <= 13 * len(texts)


@pytest.mark.parametrize("shingles", [1 << 19, 500])
def test_blocks_meet_in_pairs(spark, monkeypatch, shingles):
    monkeypatch.setattr(M, "PER_BLOCK", 2)
    monkeypatch.setattr(M, "PER_FAMILY_BLOCK", 2)
    monkeypatch.setattr(M, "BLOCK_SHINGLES", shingles)
    texts = edited(120, [1, 2, 3], 2) + ["", "a b", "a b", "a b c d e f g"]
    expected = smallest(texts)
    assert found(spark, texts) == {**expected, 120: 120, 121: 121, 122: 121}


def test_filter_lets_all_wanted_marks_pass(spark):
    rows = spark.range(20_000).select("id", M.F.xxhash64("id").alias("mark"))
    wanted = rows.filter("id % 100 = 0")
    got = M.maybe_among(rows, wanted)
    assert got.columns == ["id", "mark"]
    assert got.filter("id % 100 = 0").count() == 200 and got.count() < 230
