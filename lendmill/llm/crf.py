"""Main text of web pages by a linear-chain conditional random field over leaf blocks.

A page is read as a tree; its leaf blocks (runs of text between block-level tags) form a
chain. Features of a block are the tags above it, words of their class, id and role, and
simple measures of its text. The field is trained on labelled pages: a bounded sample of the
given pages, labelled by their article element less what is named as standing beside the
main part in it (adverts, notices, related links, comments), and pages put together from their paragraphs
in many other layouts, with menus, notices, adverts, forms, sidebars and reader comments in
and around the main part. Viterbi decoding labels whole pages; blocks labelled main are
joined in page order.

Defined cases: null and empty html, and pages without text, give an empty text; broken
markup is read as far as it goes; script, style, comments and the head have no text; repeated
rows are treated alike (of pages with one id, one may train the field); other columns are
ignored; without pages to learn from, the built layouts alone train the field.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendmill.llm.common import in_tasks

#: Pages that training reads at most (those of least hash), and layouts built from each.
TRAIN_PAGES, LAYOUTS, EPOCHS = 120, 3, 12

# Fixed values of HTML: elements that stand on lines of their own, have no end tag, or no text.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html label legend li main menu nav ol option p pre section select summary table tbody td textarea tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style noscript template head title svg iframe object canvas math audio video".split())
#: The head ends with the first start tag or text that cannot stand in it; of elements that are open in it, only the title ends with it.
HEAD = frozenset("html head title base link meta script style noscript template".split())
#: Elements of other vocabularies, which a slash ends.
FOREIGN = frozenset("svg math".split())
ENDS_BY_NEXT = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


@dataclass
class Block:
    text: str
    features: list[str]
    label: int | None = None


@dataclass(frozen=True)
class Open:
    """An open element, with what its ancestors and itself give to the blocks in it; an element
    that adds nothing shares the features of its parent."""

    tag: str
    #: The innermost mark.
    mark: str | None = None
    above: frozenset[str] = frozenset()
    ordered: tuple[str, ...] = ()
    #: The innermost block-level tag.
    block: str = "none"

    def inside(self, tag: str, names: list[str], mark: str | None) -> Open:
        own = [*names, f"in:{tag}"] if tag in BLOCK else names
        above, ordered = self.above, self.ordered
        if not above.issuperset(own):
            above = above.union(own)
            ordered = tuple(sorted(above))
        return Open(tag, self.mark if mark is None else mark, above, ordered, tag if tag in BLOCK else self.block)


OUTSIDE = Open("")


class Leaves(HTMLParser):
    """Collects leaf blocks with their features."""

    def __init__(self, learn: bool = False) -> None:
        """``learn``: label blocks by the article element and what stands beside in it, not by
        ``data-main``."""
        super().__init__(convert_charrefs=True)
        self.learn = learn
        self.stack: list[Open] = []
        self.opened: Counter[str] = Counter()
        self.parts: list[str] = []
        self.linked = self.total = 0
        self.silent = 0
        self.blocks: list[Block] = []

    def parse_html_declaration(self, i: int) -> int:
        if self.rawdata.startswith("<![", i):
            return self.parse_bogus_comment(i)
        return super().parse_html_declaration(i)

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append(Block(text, self._features(text), self._label()))
        self.parts, self.linked, self.total = [], 0, 0

    @property
    def here(self) -> Open:
        return self.stack[-1] if self.stack else OUTSIDE

    def _label(self) -> int | None:
        return None if self.here.mark is None else int(self.here.mark)

    def _learned(self, tag: str, attrs: list[tuple[str, str | None]]) -> str | None:
        """The mark of an element of a real page: the outermost article or main is the main part,
        elements below it that are named as something beside it are not."""
        if self.here.mark is None:
            return "1" if tag in ("article", "main") else None
        return "0" if tag in ASIDE or any(key in ("class", "id", "role") and value and any(map(is_beside, value.lower().split())) for key, value in attrs) else None

    def _features(self, text: str) -> list[str]:
        near = self.here.block
        n = text.count(" ") + 1
        size = "1" if n == 1 else "few" if n < 6 else "some" if n < 20 else "many"
        links = "all" if self.linked > 0.8 * self.total else "part" if self.linked else "none"
        found = [*self.here.ordered, f"at:{near}", f"words:{size}", f"links:{links}", f"at:{near},words:{size}", f"stop:{text[-1] in '.!?…'}"]
        if "©" in text:
            found.append("copyright")
        return found

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in HEAD:
            self._close_head(tag)
        if tag in BLOCK:
            self.flush()
            self._close_open(tag)
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        names, mark = [], None
        for key, value in attrs:
            if key in ("class", "id", "role") and value:
                names += [f"named:{w}" for w in re.split(r"[^a-z]+", value.lower()) if w]
            elif key == "data-main" and not self.learn:
                mark = value
        if self.learn:
            mark = self._learned(tag, attrs)
        self.stack.append(self.here.inside(tag, names, mark))
        self.opened[tag] += 1
        if tag in SILENT:
            self.silent += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # A slash means nothing on elements that have an end tag.
        self.handle_starttag(tag, attrs)
        if tag in FOREIGN:
            self.handle_endtag(tag)

    def _close_head(self, tag: str | None) -> None:
        """Before a start tag that is no element of the head, or text: end the head."""
        if not self.silent or not self.opened["head"]:
            return
        k = next(i for i, element in enumerate(self.stack) if element.tag == "head")
        inner = {element.tag for element in self.stack[k + 1 :]} - {"head"}
        if not inner or tag == "body" or (tag in BLOCK and inner == {"title"}):
            self._pop_to(k)

    def _close_open(self, tag: str) -> None:
        ends = {"p"} | ENDS_BY_NEXT.get(tag, set())
        for k in range(len(self.stack) - 1, -1, -1):
            name = self.stack[k].tag
            if name in ends:
                self._pop_to(k)
                return
            if name in BLOCK:
                return

    def _pop_to(self, k: int) -> None:
        for element in self.stack[k:]:
            self.opened[element.tag] -= 1
            if element.tag in SILENT:
                self.silent -= 1
        del self.stack[k:]

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        if not self.opened[tag]:
            return
        for k in range(len(self.stack) - 1, -1, -1):
            name = self.stack[k].tag
            if name == tag:
                self._pop_to(k)
                return
            if name in BLOCK and tag not in BLOCK and tag not in SILENT:
                return

    def handle_data(self, data: str) -> None:
        if data.strip():
            self._close_head(None)
        if self.silent:
            return
        self.parts.append(data)
        n = len(data.strip())
        self.total += n
        if self.opened["a"]:
            self.linked += n


def leaf_blocks(html: str, learn: bool = False) -> list[Block]:
    parser = Leaves(learn)
    parser.feed(html)
    parser.close()
    parser.flush()
    last = len(parser.blocks) - 1
    for i, block in enumerate(parser.blocks):
        block.features += [f"first:{i == 0}", f"last:{i == last}"]
    return parser.blocks


@dataclass(frozen=True)
class Field:
    """Weights per feature and label, and per pair of neighbouring labels."""

    index: dict[str, int]
    emit: np.ndarray
    move: np.ndarray

    def scores(self, blocks: list[Block]) -> np.ndarray:
        out = np.zeros((len(blocks), 2))
        for i, block in enumerate(blocks):
            known = [self.index[f] for f in block.features if f in self.index]
            out[i] = self.emit[known].sum(axis=0)
        return out

    def decode(self, blocks: list[Block]) -> list[int]:
        """The best labelling of the chain (Viterbi)."""
        if not blocks:
            return []
        emit = self.scores(blocks).tolist()
        (m00, m01), (m10, m11) = self.move.tolist()
        a, b = emit[0]
        back = []
        for e0, e1 in emit[1:]:
            from0, from1 = (a + m00, b + m10), (a + m01, b + m11)
            back.append((from0[1] > from0[0], from1[1] > from1[0]))
            a, b = max(from0) + e0, max(from1) + e1
        labels = [int(b > a)]
        for step in reversed(back):
            labels.append(int(step[labels[-1]]))
        return labels[::-1]


def fit(pages: list[list[Block]], epochs: int = EPOCHS) -> Field:
    """Stochastic gradient ascent on the log-likelihood of labelled chains."""
    names = sorted({f for blocks in pages for b in blocks for f in b.features})
    index = {f: i for i, f in enumerate(names)}
    emit, move = np.zeros((len(names), 2)), np.zeros((2, 2))
    chains = [([np.array([index[f] for f in b.features]) for b in blocks], [b.label for b in blocks]) for blocks in pages if blocks]
    order = random.Random(3)
    for epoch in range(epochs):
        order.shuffle(chains)
        rate = 0.2 / (1 + epoch)
        for features, labels in chains:
            n = len(labels)
            score = np.array([emit[f].sum(axis=0) for f in features])
            forward, backward = np.empty((n, 2)), np.zeros((n, 2))
            forward[0] = score[0]
            for i in range(1, n):
                forward[i] = score[i] + np.logaddexp(forward[i - 1][0] + move[0], forward[i - 1][1] + move[1])
            for i in range(n - 2, -1, -1):
                ahead = score[i + 1] + backward[i + 1]
                backward[i] = np.logaddexp(move[:, 0] + ahead[0], move[:, 1] + ahead[1])
            total = np.logaddexp(*forward[-1])
            share = np.exp(forward + backward - total)
            move *= 1 - 1e-3 * rate
            for i in range(n):
                step = -share[i]
                step[labels[i]] += 1
                np.add.at(emit, features[i], rate * step - 1e-3 * rate * emit[features[i]])
                if i:
                    pair = np.exp(forward[i - 1][:, None] + move + (score[i] + backward[i])[None, :] - total)
                    move -= rate * pair
                    move[labels[i - 1], labels[i]] += rate
    return Field(index, emit, move)


# Layouts for training: names in common use for the parts of a page.
MAIN = (("article", ""), ("main", ""), ("div", "post content"), ("div", "entry-content"), ("div", "article-body"), ("section", "story"), ("div", "content main"), ("div", "post-body text"))
BESIDE = (
    ("aside", "sidebar"), ("div", "sidebar widget"), ("div", "related links"), ("div", "ad"), ("div", "advert banner"), ("div", "ads sponsored promo"), ("div", "cookie-notice"),
    ("div", "notice consent popup"), ("div", "newsletter subscribe"), ("div", "share social"), ("div", "breadcrumb"), ("form", "search"), ("form", "login"), ("form", ""), ("section", "comments"),
    ("div", "comment-list"), ("div", "reader-comments discussion"), ("aside", ""), ("nav", ""), ("nav", "menu"), ("div", "menu navigation"), ("ul", "menu"), ("dialog", "modal"),
)
#: Elements beside the main part by their kind, and words of names that say so: those of the
#: layouts (but for words that stand for something else when alone) and others in common use.
ASIDE = frozenset("aside nav footer form dialog".split())
BESIDE_WORDS = frozenset(w for _, name in BESIDE for w in re.split("[ -]", name) if w) - frozenset("banner links list reader search".split()) | frozenset(
    "ads advertisement adverts advertising breadcrumbs complementary disqus notices paywall recommended respond sharing sponsor".split()
)
#: Words before them that make a name a state or a topic of what is there.
STATES = frozenset("category format has hide is no not tag topic type with without".split())


def is_beside(name: str) -> bool:
    """Whether a class, id or role names a part beside the main text: by its first or last word
    (comment-list, reader-comments), not as a state (has-sidebar, category-social)."""
    parts = [w for w in re.split(r"[^a-z]+", name) if w]
    return bool(parts) and parts[0] not in STATES and (parts[0] in BESIDE_WORDS or parts[-1] in BESIDE_WORDS)


FALLBACK = ("This is a paragraph of the story, with several words and an end.", "Another one follows it. It is short.", "And the last one closes the page, with a few more words than before.")


def built_page(paragraphs: list[str], draw: random.Random) -> str:
    """A page in a random layout; ``data-main`` holds the labels."""
    from html import escape

    words = " ".join(paragraphs).split() or ["word"]

    def some(low: int, high: int) -> str:
        start = draw.randrange(len(words))
        return escape(" ".join(words[start : start + draw.randint(low, high)]) or words[0])

    def part(tag: str, name: str) -> str:
        kind = f' {draw.choice(("class", "id"))}="{name}"' if name else ""
        if tag in ("nav", "ul") or "menu" in name or "links" in name or "breadcrumb" in name:
            inner = "".join(f'<li><a href="#">{some(1, 3)}</a></li>' for _ in range(draw.randint(2, 6)))
            inner = inner if tag == "ul" else f"<ul>{inner}</ul>"
        elif tag == "form":
            inner = f"<label>{some(1, 3)}</label><input type=text><button>{some(1, 2)}</button>"
        elif "comment" in name:
            inner = "".join(f'<div class="comment"><p>{some(3, 40)}.</p></div>' for _ in range(draw.randint(1, 4)))
        else:
            inner = draw.choice((some(2, 25), f"<p>{some(3, 40)}.</p>", f"<h3>{some(1, 3)}</h3><p>{some(2, 15)}</p>", f'<a href="#">{some(2, 8)}</a>'))
        return f'<{tag}{kind} data-main="0">{inner}</{tag}>'

    tag, name = draw.choice(MAIN)
    body = [f"<h1>{some(3, 9)}</h1>"] if draw.random() < 0.8 else []
    for text in paragraphs:
        style = draw.random()
        text = escape(text)
        body.append(f"<p>{text}</p>" if style < 0.75 else f"<p><b>{text}<br>" if style < 0.85 else f"<ul><li>{text}</li></ul>" if style < 0.9 else f"<blockquote>{text}</blockquote>" if style < 0.95 else f"<h2>{some(2, 6)}</h2><p>{text}</p>")
    for _ in range(draw.choice((0, 0, 1, 2))):
        body.insert(draw.randint(0, len(body)), part(*draw.choice(BESIDE)))
    kind = f' {draw.choice(("class", "id"))}="{name}"' if name else ""
    main = f'<{tag}{kind} data-main="1">{"".join(body)}</{tag}>'
    before = [part(*draw.choice(BESIDE)) for _ in range(draw.randint(0, 3))]
    after = [part(*draw.choice(BESIDE)) for _ in range(draw.randint(0, 3))]
    if draw.random() < 0.6:
        before.insert(0, f'<header data-main="0">{draw.choice((f'<div class="logo">{some(1, 3)}</div>', f"<h1>{some(1, 3)}</h1>"))}<p>{some(2, 8)}</p></header>')
    if draw.random() < 0.8:
        after.append(f'<footer data-main="0">&copy; {some(1, 12)}</footer>')
    inside = "".join([*before, main, *after])
    if draw.random() < 0.3:
        inside = f'<div class="{draw.choice(("wrapper", "container", "page", "row"))}">{inside}</div>'
    return f"<html><body>{inside}</body></html>"


def train(pages: DataFrame, html_col: str = "html") -> Field:
    """The field of the given pages. Ids are drawn first, then one page of each is read, so that
    nothing but the sample reaches the driver; a page without an id is not drawn."""
    known = pages.select("page_id", F.col(html_col).alias("html")).filter("page_id IS NOT NULL AND html IS NOT NULL")
    ids = [row[0] for row in known.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(TRAIN_PAGES).collect()]
    chosen = known.filter(F.col("page_id").isin(ids)).groupBy("page_id").agg(F.min("html").alias("html")).orderBy(F.xxhash64("page_id"), "page_id").collect() if ids else []
    draw, chains = random.Random(17), []
    for row in chosen or [None] * 40:
        blocks = leaf_blocks(row["html"], learn=True) if row else []
        for block in blocks:
            block.label = int(block.label == 1 and not any(f in ("in:nav", "in:aside", "in:footer", "in:form") for f in block.features))
        if any(b.label for b in blocks):
            chains.append(blocks)
        paragraphs = [b.text for b in blocks if b.label and "at:h1" not in b.features][:12] or list(FALLBACK)
        for _ in range(LAYOUTS):
            built = leaf_blocks(built_page(draw.sample(paragraphs, draw.randint(1, len(paragraphs))), draw))
            for block in built:
                block.label = block.label or 0
            chains.append(built)
    return fit(chains)


def extract(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """page_id, url, text and n_chars (code points) of the main text of each page."""
    shipped = pages.sparkSession.sparkContext.broadcast(field or train(pages))  # as large as the training sample's features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in batches:
            texts = []
            for html in batch.column("html"):
                blocks = leaf_blocks(html.as_py())
                texts.append(" ".join(b.text for b, label in zip(blocks, own.decode(blocks), strict=True) if label))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    return in_tasks(rows, run, "page_id long, url string, text string, n_chars long")
