"""Main text of pages, and the pipeline, on small tables."""

import itertools
import random

import numpy as np

from lendmill.llm import crf

PAGE = '<html><head><title>T</title></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><article><h1>A&amp;B</h1><p>First  line\n here.<p>Second&nbsp;one.</article><footer>&copy; us</footer>'


def test_extract(spark):
    rows = [(i, f"u{i}", PAGE, 1) for i in range(6)] + [(7, None, None, 1), (8, "u", "", 1), (9, "u", "<p", 1), (None, "u", PAGE, 1)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {r["page_id"]: r for r in crf.extract(frame).collect()}
    assert got[1]["text"] == got[None]["text"] == "A&B First line here. Second one." and got[1]["n_chars"] == 32
    assert got[7]["text"] == got[8]["text"] == "" and got[9]["n_chars"] in (0, 2)
    assert crf.extract(frame.limit(0)).count() == 0


def test_open_heads_and_self_closing_icons():
    def texts(html):
        return [b.text for b in crf.leaf_blocks(html)]

    assert texts("<html><head><title>T</title><body><p>One</p>") == ["One"]
    assert texts("<head><meta charset=x><title>T</title><style>s{}</style><script>v</script><p>One<p>Two") == ["One", "Two"]
    assert texts("<head><title>T</title><a href=x>One</a> two") == ["One two"]
    assert texts("<head><title>T</title> One <p>Two") == ["One", "Two"]
    assert texts("<head><noscript><p>no</p></noscript><template><div>no</div></template><title>T</title></head><body>One") == ["One"]
    assert texts("<head><title>T</title><noscript><p>no</p><body>One") == ["One"]
    assert texts("<p>One <svg/>two <math/>three</p><p>Four") == ["One two three", "Four"]
    assert texts("<article><svg class=i /><p>One</p><svg><title>no</title><path/></svg>Two<svg><svg/><text>no</text></svg></article>") == ["One", "Two"]


def test_what_stands_beside_inside_articles(spark):
    draw = random.Random(8)

    def some(low, high):
        return " ".join(f"word{draw.randrange(500)}" for _ in range(draw.randint(low, high)))

    rows, want = [], {}
    for i in range(60):
        body = [some(15, 40) + "." for _ in range(5)]
        beside = [
            f'<div class="ad"><p>{some(15, 40)}.</p></div>', f'<div class="notice"><p>{some(15, 40)}.</p></div>', f'<div class="related-posts"><p>{some(15, 40)}.</p></div>',
            f'<section id="comments"><article class="comment"><p>{some(15, 40)}.</p></article><article class="comment"><p>{some(15, 40)}.</p></article></section>',
        ]
        inside = f'<h1>T {i}</h1><p>{body[0]}</p>{beside[0]}<p>{body[1]}</p><p>{body[2]}</p>{beside[1]}<p>{body[3]}</p><div class="entry has-sidebar"><p>{body[4]}</p></div>{beside[2]}{beside[3]}'
        rows.append((i, f"u{i}", f'<html><head><title>T</title><body class="ad"><nav><a href=x>Home</a></nav><article class="post category-notice">{inside}</article></body></html>'))
        want[i] = " ".join([f"T {i}", *body])
    blocks = crf.leaf_blocks(rows[0][2], learn=True)
    assert " ".join(b.text for b in blocks if b.label) == want[0]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in crf.extract(frame).collect()}
    assert sum(got[i] == want[i] for i in want) >= 57
    assert [crf.is_beside(n) for n in ("ad", "comment-list", "reader-comments", "has-sidebar", "category-notice", "entry-content", "added", "")] == [True] * 3 + [False] * 5


def test_other_layouts():
    draw = random.Random(1)
    texts = [f"Sentence {i} has some words, and it ends here." for i in range(12)]
    train = []
    for _ in range(200):
        blocks = crf.leaf_blocks(crf.built_page(draw.sample(texts, 5), draw))
        for b in blocks:
            b.label = b.label or 0
        train.append(blocks)
    field, right = crf.fit(train[:150]), 0
    for blocks in train[150:]:
        right += field.decode(blocks) == [b.label for b in blocks]
    assert right >= 45


def test_viterbi_against_enumeration():
    draw = np.random.default_rng(4)
    for n in (1, 2, 5, 9):
        field = crf.Field({f"f{i}": i for i in range(n)}, draw.normal(size=(n, 2)), draw.normal(size=(2, 2)))
        blocks = [crf.Block("", [f"f{i}", f"f{(i * 3) % n}", "unknown"]) for i in range(n)]
        emit = field.scores(blocks)

        def value(labels):
            return sum(emit[i, x] for i, x in enumerate(labels)) + sum(field.move[x, y] for x, y in itertools.pairwise(labels))

        assert tuple(field.decode(blocks)) == max(itertools.product((0, 1), repeat=n), key=value)


def test_deep_pages_and_links_far_above():
    # A walk over all open elements for each block would take minutes.
    deep = crf.leaf_blocks('<div class="a">text ' * 30_000)
    assert len(deep) == 30_000 and deep[-1].features[:3] == ["in:div", "named:a", "at:div"]
    many = crf.leaf_blocks("<p>text</i></div>" * 30_000)
    assert len(many) == 30_000
    far = crf.leaf_blocks("<a href=x><b><i><u><em><span>far</span></em></u></i></b></a> near")
    assert "links:part" in far[0].features


def test_training_sample_has_one_page_of_each_id(spark):
    # One id with most rows is one page of the sample, and rows without an id are none.
    rows = [(1, PAGE)] * 300 + [(1, PAGE.replace("First", "Other"))] * 300 + [(i, PAGE) for i in range(2, 40)] + [(None, PAGE)] * 50 + [(99, None)]
    frame = spark.createDataFrame(rows, "page_id long, html string").repartition(7)
    once = spark.createDataFrame([(i, PAGE) for i in range(1, 40)], "page_id long, html string")
    fields = [crf.train(f) for f in (frame, once)]
    assert fields[0].index == fields[1].index and np.array_equal(fields[0].emit, fields[1].emit)


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text, "en", "s", 0), (2, text, "en", "s", 0), (3, "mail a@b.org please", "en", "s", 0), (4, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"file://{tmp_path}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, f"file://{tmp_path}")
        assert left.columns == docs.columns, name
    kept = {r["doc_id"]: r["text"] for r in left.collect()}
    assert kept == {1: text, 3: "mail <EMAIL> please", 4: None}
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, f"file://{tmp_path}").collect()} == {1, 3, 4}


def test_pipeline_keeps_one_of_repeated_rows(spark, tmp_path):
    import corpus_pipeline

    def text(name):
        return " ".join(f"{name}{i}" for i in range(60))

    rows = [(1, text("a")), (1, text("a")), (1, text("b")), (2, text("c")), (None, text("c")), (None, text("d")), (None, text("d")), (None, text("d") + " end"), (None, text("e")), (5, text("e")), (None, None), (None, None), (6, "")]
    docs = spark.createDataFrame([(k, t, "en", "s", 0) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"file://{tmp_path}/labels.parquet")
    left = spark.read.parquet(f"file://{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, f"file://{tmp_path}")
    got = [(r["doc_id"], r["text"]) for r in left.collect()]
    d = [t for k, t in got if k is None and t]
    assert len(d) == 1 and d[0] in (text("d"), text("d") + " end")
    want = [(1, text("a")), (1, text("b")), (2, text("c")), (None, d[0]), (5, text("e")), (None, None), (None, None), (6, "")]
    assert sorted(got, key=repr) == sorted(want, key=repr)
