"""Sketches estimate the similarity of sets, and near-duplicates near the limit equal brute force."""

import numpy as np
import pytest

from lendmill.llm import tensor_minhash as M


@pytest.mark.parametrize("size", [1, 4, 60, 400, 3000])
def test_estimate_is_close_to_the_similarity(size):
    draw = np.random.default_rng(size)
    orders = M._bin_orders()
    for shared in (0.0, 0.5, 0.75, 1.0):
        seen = []
        for _ in range(40):
            hashes = np.unique(draw.integers(0, 1 << 64, size, dtype=np.uint64))
            order = draw.permutation(len(hashes))
            common = round(shared * len(hashes))
            cut = int(draw.integers(common, len(hashes) + 1))
            one, two = np.sort(hashes[order[:cut]]), np.sort(hashes[np.concatenate([order[:common], order[cut:]])])
            if len(one) and len(two):
                bits = [np.frombuffer(M.sketch_bits(s, orders), np.uint8)[None, :] for s in (one, two)]
                seen.append(float(M.estimates(*bits)[0]) - common / len(hashes))
        if seen:
            assert abs(np.mean(seen)) < 0.03
            if size >= M.SMALL_SET:
                assert np.max(np.abs(seen)) < 0.14


def test_groups_near_the_limit_equal_brute_force(spark):
    draw = np.random.default_rng(2)
    base = [f"w{i}" for i in range(120)]
    texts = []
    for k in range(90):
        own = list(base if k % 2 else base[:60])
        for at in draw.choice(len(own), int(draw.integers(1, 7)), replace=False):
            own[at] = f"x{k}-{at}"
        texts.append(" ".join(own))
    texts += ["", None, "one", "one", "a b c d e f g", "a b c d e f g h"]
    sets = []
    for text in texts:
        found = (text or "").split()
        sets.append({tuple(found[i : i + 5]) for i in range(max(len(found) - 4, 1))} if found else set())
    smallest = list(range(len(texts)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b) and smallest[j] < smallest[i]:
                    smallest[i] = smallest[j]
                    changed = True
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in M.near_duplicates(docs).collect()}
    assert got == dict(enumerate(smallest))
