"""Main text of web pages by wrapper induction.

Some pages of each host are parsed, grouped by layout, and the DOM trees of a
layout aligned by simple tree matching into one template tree. Slots that say the
same on most pages are the template; slots that vary are content. The induced
wrapper is the template tree with its content slots marked, and its constant
blocks. Every page of the host is aligned with it, and what lands in the content
slots is the main text. Tag and class names don't choose the content; they are asked about
what varies, as alignment can't tell an advert that changes from an article.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoloom.llm.common import column, cut, ship, table

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|</([a-zA-Z][^\s/>]*)[^>]*>|<([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>|<[a-zA-Z/!?][^>]*\Z", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "xmp", "noembed", "noframes"}
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCK - {"body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr"}
#: A start tag ends an open one of these, up to the nearest of those.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
#: Elements that aren't shown as text, and forms.
LEFT_OUT = set("head script style noscript template iframe object svg canvas math audio video form button select textarea input dialog title xmp noembed noframes".split())
#: Elements around articles, and class, id and role names that say so.
AROUND = {"nav", "aside", "footer", "menu"}
HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|adsense|sponsor(?:ed)?|promos?|promotion|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscribe|subscription|signup|"
    r"share|sharing|social|sidebar|related|recommended|recommendations|trending|comments?|disqus|discussion|respond|replies|menu|nav|navbar|navigation|breadcrumbs?|footer|contentinfo|complementary|"
    r"masthead|pagination|pager|widget|toolbar|login|search|skip|disclaimer|copyright|legal)(?:$|[\s_-])"
)
SPACE = re.compile(r"\s+")
#: Pages of a host that its wrapper is fitted on.
PAGES = 16
#: The share of a layout's pages that a constant text is on, and of the varying text that the content holds; how alike pages of a layout are.
CONSTANT, CONTENT, ALIKE = 0.6, 0.8, 0.6


class Node:
    """out: never text. hint: a name says that it is none of the article's."""

    __slots__ = ("tag", "label", "parent", "kids", "out", "hint", "shape", "n")

    def __init__(self, tag: str, label: str, parent: Node | None, out: bool = False, hint: bool = False):
        self.tag, self.label, self.parent, self.out, self.hint = tag, label, parent, out, hint
        self.kids: list[Node | str] = []
        self.shape = self.n = 0

    @property
    def below(self) -> list[Node]:
        return [k for k in self.kids if isinstance(k, Node)]


def parse(page: str) -> list[Node]:
    """The DOM's nodes, each after its parent. Unclosed tags end where HTML ends them; a tag cut off at the end is dropped."""
    root = Node("html", "html", None, False)
    nodes, top, at = [root], root, 0
    find = TOKEN.search
    while m := find(page, at):
        if m.start() > at:
            top.kids.append(page[at : m.start()])
        at = m.end()
        if (name := m[2]) is not None:
            tag = name.lower()
            if tag in ("html", "body"):
                if tag == "body":
                    top = root
                continue
            if tag in ENDS_P or tag in ENDS:
                own, stop = ENDS.get(tag, (set(), set()))
                walk = top
                while walk.parent is not None and walk.tag not in stop and walk.tag not in own and walk.tag not in ("td", "th", "table", "button"):
                    if walk.tag == "p" and tag in ENDS_P:
                        top = walk.parent
                        break
                    walk = walk.parent
                else:
                    if walk.tag in own:
                        top = walk.parent
                        while top.tag in own:
                            top = top.parent
            marks = ""
            hidden = False
            if m[3].strip(" /"):
                found = {a[0].lower(): a[1] or a[2] or a[3] for a in ATTRIBUTE.findall(m[3])}
                marks = " ".join(x for k in ("class", "id", "role") if (x := found.get(k)))
                hidden = "hidden" in found
                marks = re.sub(r"\d+", "#", marks.lower())
            node = Node(tag, f"{tag} {marks}" if marks else tag, top, hidden or tag in LEFT_OUT)
            if tag == "header":
                node.hint = not any(a.tag in ("article", "main") for a in above(node))
            else:
                node.hint = tag in AROUND or bool(marks and HINT.search(marks)) and tag not in ("article", "main")
            top.kids.append(node)
            nodes.append(node)
            if tag in RAW:
                end = re.compile(f"</{tag}", re.I).search(page, at)
                if end is None:
                    at = len(page)
                else:
                    at = page.find(">", end.end()) + 1 or len(page)
            elif tag not in VOID:
                top = node
        elif m[1] is not None:
            tag, walk = m[1].lower(), top
            while walk.parent is not None and walk.tag != tag:
                walk = walk.parent
            if walk.parent is not None:
                top = walk.parent
    if at < len(page):
        top.kids.append(page[at:])
    return nodes


def above(node: Node) -> Iterator[Node]:
    while (node := node.parent) is not None:
        yield node


def own_text(node: Node) -> str:
    return SPACE.sub(" ", entities.unescape(" ".join(k for k in node.kids if isinstance(k, str)))).strip()


class Shapes:
    """Trees without their texts, numbered so that equal ones have one number; and simple tree matching of them."""

    def __init__(self):
        self.number: dict[tuple, int] = {}
        self.label: list[str] = []
        self.kids: list[tuple[int, ...]] = []
        self.size: list[int] = []
        self.scores: dict[tuple[int, int], int] = {}

    def add(self, nodes: list[Node]) -> None:
        """Numbers the subtree of each node; parents come before their children."""
        for node in reversed(nodes):
            key = node.label, *(k.shape for k in node.below)
            if (n := self.number.setdefault(key, len(self.size))) == len(self.size):
                self.label.append(node.label)
                self.kids.append(key[1:])
                self.size.append(1 + sum(self.size[k] for k in key[1:]))
            node.shape = n

    def known(self, a: int, b: int) -> int:
        return self.size[a] if a == b else 0 if self.label[a] != self.label[b] else self.scores[a, b]

    def score(self, a: int, b: int) -> int:
        """Nodes of the largest mapping that puts root on root, children on children, and keeps their order; 0 for roots of different labels.

        Without recursion, as pages may nest deeply.
        """
        todo = [(a, b)] if a != b and self.label[a] == self.label[b] else []
        while todo:
            pair = todo[-1]
            if pair in self.scores:
                todo.pop()
                continue
            x, y = self.kids[pair[0]], self.kids[pair[1]]
            first, last = ends(x, y)
            x_mid, y_mid = x[first : len(x) - last], y[first : len(y) - last]
            wanted = [(i, j) for i in set(x_mid) for j in set(y_mid) if i != j and self.label[i] == self.label[j] and (i, j) not in self.scores]
            if wanted:
                todo += wanted
                continue
            same = sum(self.size[k] for k in (*x[:first], *x[len(x) - last :]))
            self.scores[pair] = 1 + same + self.table(x_mid, y_mid)[-1][-1]
            todo.pop()
        return self.known(a, b)

    def table(self, x: tuple[int, ...], y: tuple[int, ...]) -> list[list[int]]:
        """The best sums of scores over order-keeping pairs of the first i of x and the first j of y."""
        rows = [[0] * (len(y) + 1)]
        for i in x:
            before, row = rows[-1], [0]
            for k, j in enumerate(y):
                row.append(max(before[k + 1], row[k], before[k] + self.known(i, j)))
            rows.append(row)
        return rows

    def aligned(self, a: Node, b: Node) -> list[tuple[Node, Node]]:
        """The children of two nodes of one label that the mapping puts on each other, in order."""
        x, y = a.below, b.below
        xs, ys = tuple(k.shape for k in x), tuple(k.shape for k in y)
        self.score(a.shape, b.shape)
        first, last = ends(xs, ys)
        x_mid, y_mid = xs[first : len(xs) - last], ys[first : len(ys) - last]
        for i in set(x_mid):
            for j in set(y_mid):
                self.score(i, j)
        m, i, j = self.table(x_mid, y_mid), len(x_mid), len(y_mid)
        pairs = []
        while i and j:
            s = self.known(x_mid[i - 1], y_mid[j - 1])
            if s and m[i][j] == m[i - 1][j - 1] + s:
                i, j = i - 1, j - 1
                pairs.append((x[first + i], y[first + j]))
            elif m[i][j] == m[i - 1][j]:
                i -= 1
            else:
                j -= 1
        return [*zip(x[:first], y[:first], strict=True), *reversed(pairs), *zip(x[len(x) - last :], y[len(y) - last :], strict=True)]


def ends(x: tuple, y: tuple) -> tuple[int, int]:
    """How many equal trees begin and end both rows of children: some best mapping pairs them, as no pair can score more."""
    short = min(len(x), len(y))
    first = last = 0
    while first < short and x[first] == y[first]:
        first += 1
    while last < short - first and x[-1 - last] == y[-1 - last]:
        last += 1
    return first, last


def below_all(root: Node) -> list[Node]:
    """The nodes of the tree in page order, each after its parent."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += reversed(node.below)
    return out


def slot(node: Node) -> tuple:
    """Siblings of one label are one slot: alignment can't tell them apart."""
    return id(node.parent), node.label


class Template:
    """The merged tree of a layout. texts: of each node, its own text on each page that has it. said: of each slot, on how many pages it has a text."""

    def __init__(self, root: Node):
        self.root, self.pages = root, 0
        self.texts: dict[int, list[str]] = {}
        self.said: dict[tuple, Counter] = {}
        self.take([(x, x) for x in below_all(root)])

    def take(self, pairs: list[tuple[Node, Node]]) -> None:
        self.pages += 1
        on_page: dict[tuple, set[str]] = {}
        for mine, other in pairs:
            self.texts.setdefault(id(mine), []).append(text := own_text(other))
            on_page.setdefault(slot(mine), set()).add(text)
        for key, texts in on_page.items():
            self.said.setdefault(key, Counter()).update(texts)

    def constant(self, node: Node) -> set[str]:
        """What the node's slot says on at least the share CONSTANT of three pages or more."""
        return {t for t, n in self.said[slot(node)].items() if t and self.pages >= 3 and n >= CONSTANT * self.pages}

    def merge(self, root: Node, shapes: Shapes) -> None:
        """Aligns one more page: its nodes lie on the template's, or join it beside the ones before them."""
        pairs, todo, grown = [], [(self.root, root)], []
        while todo:
            mine, other = todo.pop()
            pairs.append((mine, other))
            found = {id(y): x for x, y in shapes.aligned(mine, other)}
            todo += [(x, y) for y in other.below if (x := found.get(id(y))) is not None]
            if len(found) < len(other.below):
                grown.append((mine, other, found))
        for mine, other, found in grown:
            after: dict[int | None, list[Node]] = {}
            last = None
            for y in other.below:
                if (x := found.get(id(y))) is not None:
                    last = id(x)
                else:
                    y.parent = mine
                    after.setdefault(last, []).append(y)
                    pairs += [(z, z) for z in below_all(y)]
            mine.kids = [*after.get(None, []), *(z for k in mine.kids for z in ([k, *after.get(id(k), [])] if isinstance(k, Node) else [k]))]
        self.take(pairs)
        if grown:
            shapes.add(below_all(self.root))


def way(node: Node, top: Node) -> str:
    """The labels from the node up to below `top`."""
    out = []
    while node is not top:
        out.append(node.label)
        node = node.parent
    return "/".join(out)


def mass(nodes: list[Node], names: bool) -> None:
    """Sums n over subtrees, without what is never text and, with names, without what names leave out."""
    for node in reversed(nodes):
        if node.out or names and node.hint:
            node.n = 0
        if node.parent is not None:
            node.parent.n += node.n


def densest(root: Node) -> Node:
    """The lowest node that holds the share CONTENT of its parent's n, and so on from the root; the article around it, if a tag names one."""
    now = root
    while (best := max((k for k in now.below if k.tag in BLOCK and k.tag not in ("p", "li", "td", "th", "tr")), key=lambda k: k.n, default=None)) is not None:
        if not best.n or best.n < CONTENT * now.n:
            break
        now = best
    named = [x for x in (now, *above(now)) if x.tag in ("article", "main")]
    return next((x for x in named if x.tag == "article"), named[0] if named else now)


def headings(content: Node) -> list[Node]:
    """Headings beside the content or a node around it, before it."""
    out = []
    for node in (content, *above(content)):
        if node.parent is not None:
            kids = node.parent.below
            out += [k for k in kids[: [id(k) for k in kids].index(id(node))] if k.tag in ("h1", "h2") and not k.hint]
    return out


def induce(pages: list[str]) -> list[dict]:
    """The wrappers of a host, one a layout, the layout of most pages first.

    Pages whose longest block is the same are copies and count once. A page joins the
    layout whose template it matches best, if that maps the share ALIKE of the
    smaller tree. Constant blocks are left out of the content unless they are most of it.
    """
    shapes, layouts, seen = Shapes(), [], set()
    for page in dict.fromkeys(pages):
        nodes = parse(page)
        longest = max((own_text(x) for x in nodes if not x.out), key=len)
        if longest in seen:
            continue
        seen.add(longest)
        shapes.add(nodes)
        scored = [(shapes.score(t.root.shape, nodes[0].shape) / min(shapes.size[t.root.shape], len(nodes)), -k) for k, t in enumerate(layouts)]
        if scored and max(scored)[0] >= ALIKE:
            layouts[-max(scored)[1]].merge(nodes[0], shapes)
        else:
            layouts.append(Template(nodes[0]))
    return [wrapper(t) for t in sorted(layouts, key=lambda t: -t.pages) if t.pages > 1]


def wrapper(template: Template) -> dict:
    """tree: of the template's nodes in page order the label, whether it is a content slot, and its parent's place. constant: (way from the content, text) of the constant blocks in it."""
    nodes = below_all(template.root)
    fixed = {key: template.constant(x) for x in nodes if (key := slot(x))}
    for names in (True, False):
        for x in nodes:
            x.n = sum(len(t) for t in template.texts[id(x)] if t not in fixed[slot(x)])
        mass(nodes, names)
        if template.root.n:
            break
    content = densest(template.root)
    inner = [x for x in below_all(content) if x is not content]
    constant = sorted({(way(x, content), t) for x in inner for t in fixed[slot(x)]})
    lengths = [(len(t), t in fixed[slot(x)]) for x in inner for t in template.texts[id(x)]]
    if 2 * sum(n for n, same in lengths if same) > sum(n for n, _ in lengths):
        constant = []
    slots = {id(x) for x in (content, *headings(content)) if x is content or not fixed[slot(x)]}
    place = {id(x): k for k, x in enumerate(nodes)}
    return {"tree": [[x.label, id(x) in slots, place.get(id(x.parent), -1)] for x in nodes], "constant": constant}


class Wrapper:
    """An induced wrapper, ready to be laid on pages."""

    def __init__(self, made: dict, shapes: Shapes):
        self.shapes, self.constant, self.slots, self.ways = shapes, {tuple(x) for x in made["constant"]}, set(), set()
        self.nodes: list[Node] = []
        for label, wanted, parent in made["tree"]:
            node = Node(label.partition(" ")[0], label, self.nodes[parent] if parent >= 0 else None)
            self.nodes.append(node)
            if parent >= 0:
                node.parent.kids.append(node)
            if wanted:
                self.slots.add(id(node))
                self.ways |= {id(node), *map(id, above(node))}
        shapes.add(self.nodes)

    def fit(self, root: Node) -> float:
        a, b = self.nodes[0].shape, root.shape
        return self.shapes.score(a, b) / min(self.shapes.size[a], self.shapes.size[b])

    def contents(self, root: Node) -> list[Node]:
        """The page's nodes that lie on content slots; only the way to them is aligned."""
        out, todo = [], [(self.nodes[0], root)]
        while todo:
            mine, other = todo.pop()
            if id(mine) in self.slots:
                out.append(other)
            else:
                todo += [(x, y) for x, y in reversed(self.shapes.aligned(mine, other)) if id(x) in self.ways]
        return out


def unaided(nodes: list[Node]) -> list[Node]:
    """Content of a page that no wrapper fits, by weight and names alone."""
    for names in (True, False):
        for x in nodes:
            x.n = sum(len(k) - k.count(" ") for k in x.kids if isinstance(k, str))
        mass(nodes, names)
        if nodes[0].n:
            break
    named = [x for x in nodes if x.tag in ("article", "main") and 2 * x.n >= nodes[0].n > 0]
    return [min(reversed(named), key=lambda x: (x.n, x.tag != "article"))] if named else [densest(nodes[0])]


def extract(page: str | None, wrappers: list[Wrapper], shapes: Shapes) -> str:
    """The page's main text: what lies in the content slots of the wrapper that fits best; without one, the page's own best node."""
    if not page:
        return ""
    nodes = parse(page)
    contents: list[Node] = []
    constant: set[tuple[str, str]] = set()
    if wrappers:
        shapes.add(nodes)
        best = max(wrappers, key=lambda w: w.fit(nodes[0])) if len(wrappers) > 1 else wrappers[0]
        contents = best.contents(nodes[0])
        constant = best.constant if contents else constant
    contents = contents or unaided(nodes)
    blocks: list[str] = []
    now: list[str] = []

    def close() -> None:
        text = SPACE.sub(" ", entities.unescape("".join(now))).strip()
        if text:
            blocks.append(text)
        now.clear()

    for content in contents:
        todo: list[Node | str | None] = [content]
        while todo:
            item = todo.pop()
            if item is None:
                close()
            elif isinstance(item, str):
                now.append(item)
            elif item.tag == "br":
                now.append(" ")
            elif item is content or not (item.out or item.hint or constant and (way(item, content), own_text(item)) in constant):
                if item.tag in BLOCK:
                    close()
                    todo.append(None)
                todo += reversed(item.kids)
        close()
    return "\n".join(blocks)


HOST = r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/@?#]*@)?([^/?#:]*)"


def main_text(pages: DataFrame, url: str = "url", html: str = "html", out: str = "text", pages_per_host: int = PAGES, most_broadcast: int = 8_000_000) -> DataFrame:
    """Adds `out`, the main text of each page.

    A host's wrappers are fitted on at most `pages_per_host` of its pages, picked
    by a hash, and laid on all. They go out by broadcast if they measure
    at most `most_broadcast` bytes, else by a join that can split a hot host.
    Children and levels are aligned without a bound.

    Null and empty pages give an empty text. Pages without a url share one
    nameless host. On a host of a single page, and on pages that no wrapper fits, weight
    and names alone decide. Pages without markup are one block. Repeated rows stay, an
    empty table stays empty, a column already named `out` is replaced.
    """
    spark = pages.sparkSession
    ship(spark)
    kept = [c for c in pages.columns if c.lower() != out.lower()]
    host = F.lower(F.coalesce(F.regexp_extract(column(url), HOST, 1), F.lit("")))
    ranked = pages.where(F.length(column(html)) > 0).select(host.alias("host"), column(html).alias("html"), F.xxhash64(column(url), column(html)).alias("draw"))
    place = F.row_number().over(Window.partitionBy("host").orderBy("draw", F.md5("html")))

    def fit(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values(["draw", "html"])
        return pd.DataFrame({"host": [group["host"].iloc[0]], "wrappers": [json.dumps(induce(ordered["html"].tolist()))]})

    sample = ranked.withColumn("place", place).where(F.col("place") <= pages_per_host).drop("place")
    wrappers = cut(sample.groupBy("host").applyInPandas(fit, "host string, wrappers string"))
    size = wrappers.agg(F.sum(F.length("wrappers") + F.length("host"))).first()[0] or 0
    side = F.broadcast(wrappers) if size <= most_broadcast else wrappers
    rows = pages.select(F.struct(*map(column, kept)).alias("row"), column(html).alias("html"), host.alias("host"))
    schema = pages.select(*map(column, kept)).schema.add(out, "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shapes, ready = Shapes(), {None: []}
        for batch in batches:
            texts = []
            for page, made in zip(batch.column("html"), batch.column("wrappers").to_pylist(), strict=True):
                if len(shapes.size) + len(shapes.scores) > 300_000 or len(ready) > 300:
                    shapes, ready = Shapes(), {None: []}
                if made not in ready:
                    ready[made] = [Wrapper(w, shapes) for w in json.loads(made)]
                texts.append(extract(page.as_py(), ready[made], shapes))
            yield pa.RecordBatch.from_arrays([*batch.column("row").flatten(), pa.array(texts, pa.string())], [*kept, out])

    return rows.join(side, "host", "left").select("row", "html", "wrappers").mapInArrow(run, schema)


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    found = main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
