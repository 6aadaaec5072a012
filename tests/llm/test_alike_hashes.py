"""Texts made so that sums modulo a power of two agree are told apart."""

import hashlib

import public_tokenizers as P

from lendmill.llm import chunks, tensor_minhash, tokens, winnow

WORD = P.path("word_bpe_49k.json")


def twins(n, symbols):
    """A sequence by the parity of the ones of each place, and its complement."""
    bits = [i.bit_count() % 2 for i in range(n)]
    return "".join(symbols[b] for b in bits), "".join(symbols[1 - b] for b in bits)


def test_chunks(spark):
    rows = list(enumerate(twins(2048, "a "), 1))
    got = {r["doc_id"]: r["ids_sha256"] for r in chunks.digests(spark.createDataFrame(rows, "doc_id long, text string"), WORD).collect()}
    for k, text in rows:
        assert got[k] == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in tokens.plain_ids(WORD, text))).hexdigest()


def test_repeats(spark):
    a, b = twins(1024, "ab")
    same = " ".join(f"w{i}" for i in range(34))
    rows = [(1, f"{same} {a}"), (2, f"{same} {b}"), (3, f"{same} {a} x")]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in winnow.kept_table(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (35, 35), 2: (35, 0), 3: (36, 35)}


def test_near_duplicates(spark):
    a, b = twins(1024, "ab")
    rows = [(1, f"a b c d {a}"), (2, f"a b c d {b}"), (3, f"a b c d {a}")]
    got = {r["doc_id"]: r["component_id"] for r in tensor_minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
