"""Operators over documents against brute force, on small tables with awkward rows."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest

from lendmill.llm import chunks, curve, order_minhash, pii, quality, segments, tensor_minhash, tokens, wavelet, winnow

WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, row string, node int, spans string"
LONG = " ".join(f"w{i * 7919 % 1013}" for i in range(3000))
BASE = " ".join(f"term{i}" for i in range(80))
TEXTS = [
    None, "", "  ", "one", "one two three", BASE, BASE, BASE.replace("term40", "other"), BASE.upper(), LONG, LONG + " end",
    "intro words here " + BASE + " outro words", "a  b\n c\t\td  <|endoftext|> é x ", "mail a.b@c.example.org or call +1 (555) 123-4567 now",
    "card 4111 1111 1111 1111 ip 10.0.0.255 and 10.0.0.256", "日本語" * 400, "x" * 5000, "same line\nsame line\nother\n\n", "the end of it. " * 30,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3, t, "r", i, "s") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame([*rows, (3 * 5, TEXTS[5], "r", 5, "s"), (None, "null id text", None, None, None)], SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(docs):
    return [(r["doc_id"], r["text"] or "") for r in docs.collect()]


def same(got, want):
    assert sorted(map(repr, got)) == sorted(map(repr, want))


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_unit_encoding_is_exact(path):
    texts = [t or "" for t in TEXTS] + [" ", " a", "a ", "a 　 b", " x  y", "don't I'll", "b" * 300 + " " + "b" * 300]
    got = []
    for start, end, ids, at in tokens.encoded(path, pa.array(texts)):
        got += [ids[at[i] : at[i + 1]].tolist() for i in range(end - start)]
    assert got == [tokens.plain_ids(path, t) for t in texts]


def test_hilbert_curve_visits_neighbours():
    cells = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)], np.uint32)
    keys = curve.hilbert_key(cells, 3)
    assert sorted(keys.tolist()) == list(range(512))
    assert (np.abs(np.diff(cells[np.argsort(keys)].astype(int), axis=0)).sum(axis=1) == 1).all()


def test_packing(docs, none):
    pieces = curve.piece_table(docs, WORD, length=256).collect()
    ids = {k: tokens.plain_ids(WORD, t) + [1] for k, t in texts_of(docs)}
    total = sum(len(tokens.plain_ids(WORD, t)) + 1 for _, t in texts_of(docs))
    assert sum(p["length"] for p in pieces) == total
    for p in pieces:
        part = np.array(ids[p["doc_id"]][p["start"] : p["start"] + p["length"]], "<u4")
        assert zlib.crc32(part.tobytes()) == p["ids_crc32"] and p["doc_tokens"] == len(ids[p["doc_id"]])
    by = collections.defaultdict(list)
    for p in pieces:
        by[p["sequence_id"]].append((p["offset"], p["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert curve.piece_table(none, WORD).count() == 0


def test_chunk_reuse(docs, none):
    tokenizer = tokens.tokenizer(WORD)
    want = []
    for k, t in texts_of(docs):
        ids = tokenizer.encode(t, add_special_tokens=False).ids
        want.append((k, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(tokenizer.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    same([tuple(r) for r in chunks.digests(docs, WORD).collect()], want)
    whole = {r["doc_id"]: r for r in chunks.encode(docs, WORD).collect()}
    assert whole[27]["ids"] == tokens.plain_ids(WORD, LONG)
    assert chunks.digests(none, WORD).count() == 0


def test_wavelet_documents(docs, none, spark):
    got = sorted(((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in wavelet.document_table(spark, docs, BYTE).collect()), key=repr)
    want = {}
    for k, t in texts_of(docs):
        ids = tokens.plain_ids(BYTE, t) + [0]
        want[k] = (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    at, last = 0, -1
    for start, k, n, crc in sorted(got):
        assert start == at and (n, crc) == want[k] and (k if k is not None else -1) >= last
        at, last = at + n, k if k is not None else -1
    assert wavelet.document_table(spark, none, BYTE).count() == 0


def test_wavelet_matrix():
    ids = np.random.default_rng(1).integers(0, 300, 5000).astype(np.uint16)
    matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.of(ids, 9).to_bytes())
    assert (matrix.ids() == ids).all()
    assert [matrix.access(i) for i in range(0, 5000, 97)] == ids[::97].tolist()
    for symbol in (0, 7, 299, 511, 5000):
        places = np.flatnonzero(ids == symbol)
        assert matrix.count(symbol) == len(places) and matrix.rank(symbol, 2500) == (places < 2500).sum()
        assert [matrix.select(symbol, k) for k in range(len(places))] == places.tolist()


def test_wavelet_lookups(docs, spark, tmp_path):
    shards = wavelet.write_shards(docs, f"file://{tmp_path}/shards", BYTE, 0, shard_ids=500)
    token = tokens.plain_ids(BYTE, " term41")[0]
    want = [(k, i) for k, t in texts_of(docs) for i, x in enumerate([*tokens.plain_ids(BYTE, t), 0]) if x == token]
    same([(r["doc_id"], r["position"]) for r in wavelet.occurrences(shards, token).collect()], want)
    assert sum(r["n"] for r in wavelet.token_counts(shards, token).collect()) == len(want)


def test_personal_data(docs, none):
    got = {r["doc_id"]: r for r in pii.span_table(docs).collect()}
    assert got[3 * 13]["n_email"] == 1 and got[3 * 13]["n_phone"] == 1 and got[3 * 13]["spans"] == "email:5:22,phone:31:48"
    assert (got[3 * 14]["n_card"], got[3 * 14]["n_ip"]) == (1, 1)
    assert got[0]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    assert pii.span_table(none).count() == 0
    masked = {r["doc_id"]: r for r in pii.mask(docs).collect()}
    assert masked[3 * 13]["text"] == "mail <EMAIL> or call <PHONE> now" and masked[0]["text"] is None and masked[3]["row"] == "r"


def test_account_numbers_and_long_runs(spark):
    rows = [(1, "iban DE89370400440532013000 end"), (2, "iban DE89370400440532013001 end"), (3, "a." * 40000 + "@x"), (4, "1 " * 30000), (5, "x@y" * 20000), (6, "tel 555 123 4567")]
    got = {r["doc_id"]: r["spans"] for r in pii.span_table(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == "iban:5:27" and "iban" not in got[2] and got[6] == "local_phone:4:16"


def test_account_numbers_before_other_words(spark):
    number, spaced = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00"
    rows = [
        (1, f"iban {number} End"), (2, f"iban {spaced} BIC COBADEFF"), (3, f"iban {spaced} 2024 x"), (4, f"{number} {spaced}"), (5, f"SE20 {spaced} A"), (6, f"{number}0"),
        (7, "GB29 NWBK 6016 1331 9268 19 NO93 8601 1117 947 MT84 MALT 0110 0001 2345 MTLC AST0 01S FR14 2004 1010 0505 0001 3M02 606 Le"), (8, f"{number[:21]} End"), (9, "AB12 CD34 " * 9000),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: [x for x in r["spans"].split(",") if x.startswith("iban")] for r in pii.span_table(frame).collect()}
    assert got[1] == ["iban:5:27"] and got[2] == got[3] == ["iban:5:32"] and got[4] == ["iban:0:22", "iban:23:50"] and got[5] == ["iban:5:32"]
    assert got[7] == ["iban:0:27", "iban:28:46", "iban:47:85", "iban:86:119"] and not got[6] and not got[8]
    masked = {r["doc_id"]: r["text"] for r in pii.mask(frame).collect()}
    assert masked[1] == "iban <IBAN> End" and masked[5] == "SE20 <IBAN> A"


def clusters(pairs):
    sets = []
    for k, t in pairs:
        w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
        sets.append((k, {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()))
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(sets):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return [(k, len(s), least.get(find(i)), k == least.get(find(i))) for i, (k, s) in enumerate(sets)]


def test_near_duplicates(docs, none):
    same([tuple(r) for r in tensor_minhash.near_duplicates(docs).collect()], clusters(texts_of(docs)))
    assert tensor_minhash.near_duplicates(none).count() == 0


def test_near_duplicates_of_a_spread_group(spark):
    import random

    draw, base = random.Random(4), [f"v{i}" for i in range(120)]
    rows = []
    for k in range(150):
        words = list(base)
        for _ in range(draw.randint(1, 5)):
            words[draw.randrange(120)] = f"n{draw.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    same([tuple(r) for r in tensor_minhash.near_duplicates(frame).collect()], clusters(rows))


def test_near_duplicates_without_ids_fetch_each_text_once(spark, monkeypatch):
    base = [f"v{i}" for i in range(120)]
    rows = [(None if k % 2 else 7, " ".join([*base[:k], f"n{k}", *base[k + 1 :]])) for k in range(40)] * 2
    seen, kept = {}, tensor_minhash.written

    def counted(df, label):
        out = kept(df, label)
        seen[label] = out.count()
        return out

    original = tensor_minhash.in_tasks

    def tasks(df, function, schema):
        if function is tensor_minhash._pack:
            seen["fetched"] = df.count()
        return original(df, function, schema)

    monkeypatch.setattr(tensor_minhash, "written", counted)
    monkeypatch.setattr(tensor_minhash, "in_tasks", tasks)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    same([tuple(r) for r in tensor_minhash.near_duplicates(frame).collect()], clusters(rows))
    assert seen["nodes"] == seen["texts"] == 40 and seen["fetched"] == 80


def test_order_minhash(docs, none, spark):
    rows = {r["doc_id"]: r for r in order_minhash.compare_edited(docs.dropDuplicates(["doc_id"])).collect()}
    ordered = sorted(((k, t) for k, t in dict(texts_of(docs)).items()), key=lambda x: -1 if x[0] is None else x[0], reverse=True)
    for i, (k, t) in enumerate(ordered):
        follower = ordered[(i + 1) % len(ordered)][1]
        n = len(t) // 3
        assert rows[k]["n_chars"] == len(t) and rows[k]["edited_sha256"] == hashlib.sha256((t[: len(t) - n] + follower[:n]).encode()).hexdigest()
        assert 0 <= rows[k]["near_edited"] <= 1 and 0 <= rows[k]["near_next"] <= 1
    assert rows[15]["fingerprint"] == rows[18]["fingerprint"] != rows[21]["fingerprint"]
    assert order_minhash.compare_edited(none).count() == 0
    words = LONG.split()
    frame = spark.createDataFrame([(LONG, " ".join(words[1500:] + words[:1500]), " ".join(words[::-1]))], "a string, b string, c string")
    for name in "abc":
        frame = order_minhash.with_fingerprint(frame, name, f"f{name}")
    turned, reversed_ = frame.select(order_minhash.likeness("fa", "fb"), order_minhash.likeness("fa", "fc")).first()
    assert turned > 0.5 > reversed_


def test_repeats(docs, none):
    pairs = texts_of(docs)
    split = [(k, re.findall("[^\x20\x09-\x0d]+", t)) for k, t in pairs]
    counts = collections.Counter(tuple(w[i : i + 35]) for _, w in split for i in range(len(w) - 34))
    want = []
    for k, w in split:
        gone = set()
        for i in range(len(w) - 34):
            if counts[tuple(w[i : i + 35])] > 1:
                gone.update(range(i, i + 35))
        want.append((k, len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    same([tuple(r) for r in winnow.kept_table(docs).collect()], want)
    assert winnow.kept_table(none).count() == 0
    placed = {r["doc_id"]: r for r in winnow.without_repeats_in_place(docs).collect()}
    assert placed[15]["text"] == "" and placed[0]["text"] is None and placed[36]["text"] == TEXTS[12] and placed[3]["row"] == "r"


def test_quality(docs, none):
    for r in quality.judge(docs).collect():
        t = dict(texts_of(docs))[r["doc_id"]]
        w = re.findall("[^\x20\x09-\x0d]+", t)
        counts = collections.Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
        twice = {j for i in range(len(w) - 7) if counts[tuple(w[i : i + 8])] > 1 for j in range(i, i + 8)}
        lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"], r["n_dup_lines"]) == (len(w), sum(map(len, w)), len(twice), len(lines) - len(set(lines)))
        assert r["base_failed"] == (len(w) < 20 or 100 * len(twice) > 30 * len(w))
        assert not (r["base_failed"] and r["kept"])
    assert quality.verdicts(none).count() == 0


def test_maximal_segments_against_brute_force():
    import random

    draw = random.Random(2)
    for _ in range(200):
        scores = [draw.choice((-1.0, -1.0, -1.0, 2.0, 0.5)) for _ in range(draw.randint(0, 25))]
        places = [i for i, s in enumerate(scores) if s > 0]

        def split(a, b, scores=scores):
            best = max(((sum(scores[i:j]), -(j - i), -i, j) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0, 0))
            if best[0] <= 0:
                return []
            i, j = -best[2], best[3]
            return [*split(a, i), (i, j, best[0]), *split(j, b)]

        assert segments.maximal_segments([scores[i] for i in places], places, 1.0, len(scores)) == split(0, len(scores))


def test_toxicity(spark, none):
    calm, rude = "the day was fine and we went out ", "you vile rotten fool "
    rows = [(i, calm * (1 + i % 4) + (rude if i % 5 == 0 else f"token{i} ") + calm) for i in range(400)] + [(400, None), (401, ""), (402, "...")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(None, 1), (7, None)], "doc_id long, toxic int")
    for r in segments.verdicts(docs, labels).collect():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["doc_id"] < 400 and r["doc_id"] % 5 == 0)
    found = segments.score(docs.filter("doc_id = 5"), segments.train(docs, labels)).first()["passages"]
    assert "vile rotten fool" in found[0]["text"] and rows[5][1][found[0]["start"] : found[0]["end"]] == found[0]["text"]
    assert segments.clean_documents(docs, labels).count() == 403 - 80
    assert segments.verdicts(none, labels).count() == 0
    assert {r["score"] for r in segments.verdicts(docs, labels.filter("toxic = 0")).collect()} == {0.0}
