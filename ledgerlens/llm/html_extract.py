"""Main text of web pages by boosted trees over DOM-node features.

Every block node of a page gets a probability of belonging to the article from a
gradient-boosted tree model (Spark ML) over its features: subtree density, attribute tokens of
itself and of those above it, depth, place and sibling statistics. The nodes of a page are
then labelled together, by the likeliest labelling in which nothing below a dropped node is
kept (``dom.decode``).

The model is trained here, on a bounded sample of the pages at hand (``sample`` different pages,
those of least hash; of a text, the first 2,000 characters fill a paragraph of a layout, and
the first four texts stand for long comments): their paragraphs and their menu, advert and footer texts are taken from
elements whose tag says what they are, set into page layouts drawn at random (other tags,
class names, nesting, side columns, notices, forms, reader comments, links in the text,
scripts; or with the article, or a few words beside it, directly under the page), and every
block of a layout is labelled by the slot that it was set into. So the
trees learn what the parts of a page look like, not one site's layout; the pages as they are,
labelled where a tag says it, are among the examples.

Cases: null and empty pages, and pages without an article, have an empty text; broken and cut
markup is read as far as it goes; repeated rows are extracted alike; very long pages are taken
whole; an empty table gives an empty result (and needs no model); other columns are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from html import escape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common as C
from . import dom

#: Slot -> (tags, class names) that layouts draw from; "" stands for no class.
_SLOTS = {
    "menu": (["nav", "div", "ul", "header"], ["nav", "menu", "main-menu", "navbar", "breadcrumbs", "site-nav", "topbar", ""]),
    "head": (["header", "div"], ["header", "site-header", "masthead", "banner", "page-head", ""]),
    "foot": (["footer", "div"], ["footer", "site-footer", "page-bottom", "colophon", ""]),
    "side": (["aside", "div", "section"], ["sidebar", "side", "widget-area", "related", "right-rail", "trending", ""]),
    "ad": (["div", "section", "aside", "p"], ["ad", "ads", "advert", "ad-slot", "sponsored", "promo-box"]),
    "notice": (["div", "section", "dialog", "p"], ["cookie-notice", "consent", "notice", "alert", "gdpr-banner", "popup"]),
    "form": (["form", "form", "div"], ["newsletter", "subscribe", "login-form", "search", "contact", ""]),
    "comment": (["section", "div", "ol"], ["comments", "comment-list", "reader-comments", "discussion", "replies", "disqus"]),
}
_MAIN = (["article", "main", "div", "section"], ["", "content", "post", "article-body", "entry-content", "story", "main-content", "post-body"])

#: Characters of a text that is rather a paragraph than a menu item or a heading.
_LONG = 60


def _attrs(rnd: random.Random, name: str) -> str:
    return f' {rnd.choice(["class", "class", "id"])}="{name}"' if name else ""


def _element(tag: str, attrs: str, inner: str, kept: int) -> str:
    return f'<{tag}{attrs} data-kept="{kept}">{inner}</{tag}>'


def _links(rnd: random.Random, words: list[str]) -> str:
    items = [f'<a href="/{i}">{escape(w)}</a>' for i, w in enumerate(words)]
    if rnd.random() < 0.7:
        return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
    return " | ".join(items)


def _slot(rnd: random.Random, slot: str, short: list[str], long: list[str]) -> str:
    tags, names = _SLOTS[slot]
    tag, name = rnd.choice(tags), rnd.choice(names)
    if tag == "div" and not name and slot in ("side", "comment", "head"):
        name = names[0]
    text = lambda: escape(rnd.choice(short))
    words = lambda k: [rnd.choice(rnd.choice(short).split() or ["x"]) for _ in range(k)]
    if slot == "menu":
        inner = _links(rnd, words(rnd.randint(2, 12)))
    elif slot == "head":
        inner = f"<p>{text()}</p>" if rnd.random() < 0.5 else f"<div>{text()}</div>" + _links(rnd, words(rnd.randint(0, 6)))
    elif slot == "foot":
        inner = rnd.choice([f"&copy; {text()}", f"<p>&copy; 2020 {text()}</p>", f"&copy; {text()} &middot; {text()}"]) + (_links(rnd, words(4)) if rnd.random() < 0.4 else "")
    elif slot == "side":
        inner = f"<h3>{text()}</h3>" + (_links(rnd, words(rnd.randint(3, 9))) if rnd.random() < 0.6 else "".join(f"<p>{text()}</p>" for _ in range(rnd.randint(1, 4))))
    elif slot == "comment":
        one = lambda: rnd.choice(["<div{}>{}</div>", "<li{}>{}</li>"]).format(_attrs(rnd, rnd.choice(["comment", "reply", ""])), f"<p>{escape(rnd.choice(short + long))}</p>")
        inner = (f"<h3>{text()}</h3>" if rnd.random() < 0.6 else "") + "".join(one() for _ in range(rnd.randint(1, 6)))
    elif slot == "form":
        inner = f'<label>{text()}</label><input type="text">' * rnd.randint(1, 3) + f"<button>{escape(words(1)[0])}</button>"
        inner = f"<p>{text()}</p>{inner}" if rnd.random() < 0.5 else inner
        inner = f"<form>{inner}</form>" if tag == "div" else inner
    else:
        inner = rnd.choice([text(), text(), f"<p>{text()}</p>", f"<p>{text()}</p><p>{text()}</p>"])
        if slot == "notice" and rnd.random() < 0.5:
            inner += f"<button>{escape(words(1)[0])}</button>"
    return _element(tag, _attrs(rnd, name), inner, 0)


def layout(rnd: random.Random, paragraphs: list[str], short: list[str], long: list[str]) -> str:
    """A page with ``paragraphs`` as its article; every slot says whether it is kept."""
    body = []
    if rnd.random() < 0.85:
        body.append(f"<h1>{escape(rnd.choice(short))}</h1>")
    for i, p in enumerate(paragraphs):
        t = escape(p)
        if rnd.random() < 0.15:
            cut = t.split(" ")
            k = rnd.randrange(len(cut))
            t = " ".join([*cut[:k], f'<a href="/l">{" ".join(cut[k:k + 3])}</a>', *cut[k + 3:]])
        t = f"<b>{t}" if i == 0 and rnd.random() < 0.3 else t
        kind = rnd.random()
        if kind < 0.04:
            body.append(f"<h2>{escape(rnd.choice(short))}</h2>")
        if kind > 0.96:
            body.append("<ul>" + "".join(f"<li>{escape(rnd.choice(short))}</li>" for _ in range(3)) + "</ul>")
        elif kind > 0.92:
            t = f"<p>{t}</p>"
            t = f"<blockquote>{t}</blockquote>"
        body.append(t if t.startswith("<blockquote") else f"<p>{t}" + ("</p>" if rnd.random() < 0.8 else ""))
        if rnd.random() < 0.05:
            body.append(_slot(rnd, rnd.choice(["ad", "notice", "form", "side"]), short, long))
    if rnd.random() < 0.25:
        body.append(_slot(rnd, rnd.choice(["comment", "ad", "side", "form", "foot"]), short, long))
    tag, name = rnd.choice(_MAIN[0]), rnd.choice(_MAIN[1])
    main = _element(tag, _attrs(rnd, name or ("content" if tag in ("div", "section") else "")), "".join(body), 1)
    draw = lambda slots, odds: [_slot(rnd, s, short, long) for s in slots if rnd.random() < odds]
    before = draw(["head", "menu", "menu", "notice", "ad", "form"], 0.45)
    after = draw(["comment", "side", "side", "ad", "form", "notice"], 0.4)
    rnd.shuffle(before)
    rnd.shuffle(after)
    middle = "".join([*before, main, *after])
    if rnd.random() < 0.5:
        middle = f'<div{_attrs(rnd, rnd.choice(["wrapper", "page", "container", "layout", "site"]))}>{middle}</div>'
    if rnd.random() < 0.8:
        middle += _slot(rnd, "foot", short, long)
    return f"<!DOCTYPE html><html><head><title>{escape(rnd.choice(short))}</title></head><body><script>var t='</p>';</script>{middle}</body></html>"


def bare(rnd: random.Random, paragraphs: list[str], short: list[str], long: list[str]) -> str:
    """A page with ``paragraphs`` directly under the page or its body, not all in elements of
    their own; the body, if it has one, and every slot say whether they are kept."""
    body = [f"<h1>{escape(rnd.choice(short))}</h1>"] if rnd.random() < 0.6 else []
    for i, p in enumerate(paragraphs):
        words = escape(p).split(" ")
        if rnd.random() < 0.4:
            k, tag = rnd.randrange(len(words)), rnd.choice(["b", "i", "em", "a"])
            words[k:k + 3] = [f"<{tag}>{' '.join(words[k:k + 3])}</{tag}>"]
        t = " ".join(words)
        body.append(f"<p>{t}</p>" if i and rnd.random() < 0.4 else t + rnd.choice(["<br>", "<br><br>", "\n", "<hr>"]))
    draw = lambda slots, odds: [_slot(rnd, s, short, long) for s in slots if rnd.random() < odds]
    odds = rnd.choice([0.0, 0.35])
    inner = "".join([*draw(["head", "menu", "notice", "form"], odds), *body, *draw(["comment", "side", "ad", "foot"], odds)])
    if rnd.random() < 0.5:
        return rnd.choice(["", f"<!DOCTYPE html><title>{escape(rnd.choice(short))}</title>"]) + inner
    return f'<!DOCTYPE html><html><head><title>{escape(rnd.choice(short))}</title></head><body data-kept="1">{inner}</body></html>'


def _unwrapped(rnd: random.Random, paragraphs: list[str], short: list[str], long: list[str]) -> tuple[list[dom.Node], np.ndarray]:
    """Nodes and labels of a page with text directly under the page or its body: its article,
    or a few words beside it."""
    if rnd.random() < 0.6:
        nodes, _runs = dom.parse(bare(rnd, paragraphs, short, long))
        if nodes[0].own:
            nodes[0].label = 1
        return nodes, _labels(nodes)
    html = layout(rnd, paragraphs, short, long)
    inner = html[html.index("<body>") + 6:html.index("</body>")]
    few = escape(" ".join(rnd.choice(short).split()[:rnd.randint(1, 5)]))
    few = few if rnd.random() < 0.5 else f'<a href="#c">{few}</a>'
    nodes, _runs = dom.parse(rnd.choice([few + inner, f"{inner}{few}", f"<html><body>{few}{inner}</body></html>"]))
    labels = _labels(nodes)
    labels[[i for i, x in enumerate(nodes) if x.own and x.tag in ("#page", "body")]] = 0
    return nodes, labels


def _labels(nodes: list[dom.Node]) -> np.ndarray:
    """1 kept, 0 dropped, -1 a wrapper of both; from the nearest marked slot."""
    out = np.full(len(nodes), -1)
    index = {id(x): i for i, x in enumerate(nodes)}
    for i, x in enumerate(nodes):
        if x.label is not None:
            out[i] = x.label if not (x.parent and out[index[id(x.parent)]] == 0) else 0
        elif x.parent:
            out[i] = out[index[id(x.parent)]]
    return out


def _tag_labels(nodes: list[dom.Node]) -> np.ndarray:
    """Labels of a page's nodes by their tags: 1 in an article, 0 in elements that are none,
    -1 where no tag says it."""
    inside: dict[int, int] = {}
    for x in nodes:
        up = inside[id(x.parent)] if x.parent else -1
        inside[id(x)] = 0 if x.tag in ("nav", "footer", "aside", "header", "form") else up if up >= 0 else 1 if x.tag == "article" else -1
    return np.array([inside[id(x)] for x in nodes])


def _by_tag(html: str) -> tuple[list[str], list[str]]:
    """Texts of a page in elements whose tag says what they are: (article, other)."""
    nodes, runs = dom.parse(html)
    label = _tag_labels(nodes)
    return [t for i, t in runs if label[i] == 1], [t for i, t in runs if label[i] == 0]


def _fill(html: str) -> tuple[list[str], list[str]]:
    """Texts of a page to fill layouts with: (article, other). Where no tag names an article,
    its texts outside of menus, footers and the like stand in, long ones if there are any."""
    main, other = _by_tag(html)
    if not main:
        nodes, runs = dom.parse(html)
        label = _tag_labels(nodes)
        main = [t for i, t in runs if label[i] < 0]
        main = [t for t in main if len(t) >= _LONG] or main
    return main, other


class Trees:
    """A boosted ensemble as arrays, for numpy: one row per node of a tree."""

    def __init__(self, model):
        self.trees, self.weights = [], list(model.treeWeights)
        for t in model.trees:
            rows: list[list[float]] = []

            def walk(node) -> int:
                at = len(rows)
                rows.append([-1, 0.0, 0, 0, node.prediction()])
                if node.subtreeDepth() > 0:
                    rows[at][:2] = [node.split().featureIndex(), node.split().threshold()]
                    rows[at][2] = walk(node.leftChild())
                    rows[at][3] = walk(node.rightChild())
                return at

            walk(t._call_java("rootNode"))
            self.trees.append(np.array(rows))

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(x))
        every = np.arange(len(x))
        for tree, weight in zip(self.trees, self.weights):
            at = np.zeros(len(x), np.int64)
            while True:
                f = tree[at, 0].astype(np.int64)
                go = f >= 0
                if not go.any():
                    break
                left = x[every, np.maximum(f, 0)] <= tree[at, 1]
                at = np.where(go, np.where(left, tree[at, 2], tree[at, 3]).astype(np.int64), at)
            margin += weight * tree[at, 4]
        return 1 / (1 + np.exp(-2 * margin))


def train(pages: DataFrame, sample: int = 300, layouts: int = 3, seed: int = 11, html_col: str = "html", id_col: str = "page_id") -> Trees | None:
    """Boosted trees from at most ``sample`` pages in ``layouts`` drawn layouts each; None if
    no sampled page has a text outside of menus, footers and the like (then none has a main text)."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import array_to_vector

    full = C.picked(pages, id_col, html_col).where("c1 is not null and c1 <> ''").withColumn("h", F.xxhash64("c0", "c1"))
    named = full.select("h", "c0")  # pages are chosen by name; only the chosen ones are moved
    n = named.count()
    share = 4 * sample / max(n, 1)
    if share < 0.5:  # a hash bound that about 4 * sample rows pass: no task sees the others
        some = named.where(F.col("h") < F.lit(int((share - 0.5) * 2 ** 64)))
        named = some if some.count() >= sample else named
    chosen = F.broadcast(named.distinct().orderBy("h", "c0").limit(sample).toDF("chosen", "id"))
    few = full.join(chosen, (F.col("h") == F.col("chosen")) & F.col("c0").eqNullSafe(F.col("id")), "left_semi").dropDuplicates(["h", "c0"])
    few = few.repartition(4, "h").sortWithinPartitions("h", "c0").select("c1")

    def examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for html in batch.column(0).to_pylist():
                main, other = _fill(html)
                if not main:
                    continue
                rnd = random.Random(f"{seed} {len(html)} {html[:64]}")
                nodes, _runs = dom.parse(html)
                rows, labels = [dom.features(nodes)], [_tag_labels(nodes)]
                for _ in range(layouts):
                    some = [t[:2000] for t in rnd.sample(main, rnd.randint(1, min(8, len(main))))]
                    if rnd.random() < 0.3:
                        some = [" ".join(t.split()[:rnd.randint(3, 25)]) for t in some]
                    short = [" ".join(t.split()[:rnd.randint(1, 14)]) for t in [*other, *main]]
                    nodes, _runs = dom.parse(layout(rnd, some, short, main[:4]))
                    rows.append(dom.features(nodes))
                    labels.append(_labels(nodes))
                nodes, few = _unwrapped(rnd, some, short, main[:4])
                rows.append(dom.features(nodes))
                labels.append(few)
                x, y = np.concatenate(rows), np.concatenate(labels)
                good = (y >= 0) & (x[:, dom.CHARS] > 0)
                x, y = x[good], y[good]
                yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), pa.array(y.astype(np.float64))], names=["x", "label"])

    data = C.stored(few.mapInArrow(examples, "x array<double>, label double"), "page-examples")
    if data.select("label").distinct().count() < 2:
        return None
    fitted = GBTClassifier(maxIter=24, maxDepth=5, stepSize=0.3, seed=seed, featuresCol="features", labelCol="label", maxBins=64,
                           subsamplingRate=1.0).fit(data.select(array_to_vector("x").alias("features"), "label").coalesce(2))
    return Trees(fitted)


def main_text(html: str | None, trees: Trees | None) -> str:
    if not html or trees is None:
        return ""
    nodes, runs = dom.parse(html)
    kept = dom.decode(nodes, trees.probability(dom.features(nodes)))
    return "\n".join(t for i, t in runs if kept[i])


def extract(pages: DataFrame, trees: Trees | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, url, text, n_chars) per row of ``pages``; trains on them if no model is given."""
    trees = trees or train(pages, html_col=html_col, id_col=id_col)
    src = C.picked(pages, id_col, url_col, html_col)
    shared = pages.sparkSession.sparkContext.broadcast(trees)
    ddl = f"`{id_col}` {C.type_of(pages, id_col)}, `{url_col}` string, text string, n_chars bigint"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = []
            for a in range(0, batch.num_rows, 256):
                part = [dom.parse(h.as_py() or "") for h in batch.column(2).slice(a, 256)]
                p = model.probability(np.concatenate([dom.features(nodes) for nodes, _ in part])) if model else None
                at = 0
                for nodes, runs in part:
                    kept = dom.decode(nodes, p[at:at + len(nodes)]) if model else np.zeros(len(nodes), bool)
                    texts.append("\n".join(t for i, t in runs if kept[i]))
                    at += len(nodes)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=[id_col, url_col, "text", "n_chars"])

    return src.mapInArrow(read, ddl)
