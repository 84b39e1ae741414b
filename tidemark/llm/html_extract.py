"""Main text of web pages by a site style tree.

The DOMs of a host's pages are merged into one tree: a node is a path of elements
(tag, class and role), and it keeps how often each *presentation* (its sequence of child
elements) and each *content* (a hash of each text block right below it) occurs over the host's
distinct pages.  With m pages:

* presentation importance of a node = entropy of its child sequences, to base m;
* content importance of a node = 1 - mean over its texts of the entropy (to base m) of
  that text's spread over pages: a text on one page counts 1, one on all pages 0.

A branch's composite importance on a page is ``(1 - DECAY^l)`` times its node's
presentation importance plus ``DECAY^l`` times the mean importance of its children (l
children that hold text), down to the texts.  Branches below ``LOW`` are removed, inside ``article`` and
``main`` too, unless one of their texts is above ``LOW`` by itself.  Elements whose tag or
class names a page part that is no article text (menu, footer, advert, form ...) are removed
beforehand with everything below them.  If statistics would leave nothing of a page, they are not applied to it.

Pages of a host are distinct by their texts outside such parts, so copies that differ in an advert or
a script count once.  Keys hold no ids and no class or role name that is on fewer than ``MIN_PAGES``
pages of the host, so a name made for one page does not split the tree.

Statistics are combined per task before their shuffle and keyed by (host, node, content),
so a host with a third of all pages is spread over tasks.  Pages get the importances of all nodes on at
least ``MIN_PAGES`` pages by an equi-join on (host, node): broadcast below ``BROADCAST_ROWS`` nodes, else
with ``SALT`` copies of each node.  Pages without a text below ``LOW`` lose nothing and take no part in the
join that brings the importances to the html.

Text rules: character references decoded; white space inside a block becomes one
space, trimmed; blocks joined in page order by an empty line; nothing else dropped.
Defined cases: null or empty html gives an empty text; unclosed and stray tags are
read as browsers do in the main (a block element closes an open paragraph); a null url is
the empty host; repeated rows give a row each.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Collection, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import Out, rows_of, ship, staged

DECAY = 0.9
LOW = 0.25
MIN_PAGES = 4
BROADCAST_ROWS = 500_000
SALT = 32

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
                  "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary "
                  "table tbody td tfoot th thead tr ul".split())
NOISE_TAGS = frozenset("head script style noscript template nav footer aside form menu dialog button select input textarea iframe svg "
                       "canvas object embed audio video map search title xmp noembed noframes label legend fieldset optgroup option".split())
NOISE_NAMES = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar navigation menu menubar "
                        "breadcrumb breadcrumbs sidebar aside footer header masthead topbar cookie cookies consent gdpr notice notices "
                        "alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
                        "comment comments disqus replies reply discussion pagination pager skip widget widgets toolbar "
                        "form search searchbox copyright legal disclaimer".split())
ARTICLE = frozenset(("article", "main"))
CLOSES = {"li": ("li", ("ul", "ol", "menu")), "dt": ("dt dd", ("dl",)), "dd": ("dt dd", ("dl",)), "tr": ("tr td th", ("table",)),
          "td": ("td th", ("tr", "table")), "th": ("td th", ("tr", "table")), "option": ("option", ("select",))}

_TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
_CLASS = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_NAME = re.compile(r"[a-z]+")


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1


class Node:
    __slots__ = ("tag", "names", "key", "parent", "children", "noise", "article", "texts", "live", "depth")

    def __init__(self, tag: str, attrs: str, parent: "Node | None"):
        found = [(kind.lower(), (a or b or c).lower()) for kind, a, b, c in _CLASS.findall(attrs)] if attrs else []
        names = " ".join(text for _, text in found)
        self.tag, self.parent, self.children, self.texts = tag, parent, [], []
        self.names = sorted({n for kind, text in found if kind != "id" for n in text.split()})
        self.key, self.live = 0, False
        self.depth = 0 if parent is None else parent.depth + 1
        inside = parent is not None and parent.article
        self.article = inside or tag in ARTICLE
        found = set(_NAME.findall(names)) & NOISE_NAMES if names and tag not in ("html", "body", "article", "main") else set()
        named = bool(found - {"header"} if inside else found)  # an article's own header holds its title
        self.noise = (parent is not None and parent.noise) or tag in NOISE_TAGS or named or (tag == "header" and not inside)
        if parent is not None:
            parent.children.append(self)


def parse(source: str) -> tuple[Node, list[tuple[Node, str]]]:
    """The element tree of a page and its text blocks in page order, each with the element that holds it."""
    root = Node("#page", "", None)
    blocks: list[tuple[Node, str]] = []
    node, words, holder = root, [], root
    at, n = 0, len(source)

    def cut() -> None:
        nonlocal words
        if words:
            text = " ".join(html.unescape("".join(words)).split())
            if text:
                blocks.append((holder, text))
                holder.texts.append(text)
            words = []

    # the open elements: by tag, those that end a line, and those that own the text in them; the deepest comes last
    opened: dict[str, list[Node]] = {}
    lines: list[Node] = []
    holders: list[Node] = []

    def enter(x: Node) -> None:
        nonlocal node
        node = x
        opened.setdefault(x.tag, []).append(x)
        if x.tag in BLOCK:
            lines.append(x)
        if x.tag in BLOCK or x.tag in NOISE_TAGS:
            holders.append(x)

    def say(text: str) -> None:
        nonlocal holder
        if not words:
            if not text.strip():
                return
            holder = holders[-1] if holders else root
        words.append(text)

    def close(stop: Node) -> None:
        nonlocal node
        while True:  # every element is left once
            x, node = node, node.parent or node
            opened[x.tag].pop()
            if x.tag in BLOCK:
                lines.pop()
            if x.tag in BLOCK or x.tag in NOISE_TAGS:
                holders.pop()
            if x is stop:
                return

    def deepest(tags) -> Node | None:
        return max((opened[t][-1] for t in tags if opened.get(t)), key=lambda x: x.depth, default=None)

    def up(tags, stops) -> Node | None:
        """The deepest open element of ``tags`` that lies below every open element of ``stops``."""
        x, stop = deepest(tags), deepest(stops)
        return x if x is not None and (stop is None or x.depth > stop.depth) else None

    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            say(source[at:])
            break
        if lt > at:
            say(source[at:lt])
        if source.startswith("<!--", lt):
            end = source.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if source.startswith(("<!", "<?"), lt):
            end = source.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(source, lt)
        if not m:
            say("<")
            at = lt + 1
            continue
        at = m.end()
        tag = m[1].lower()
        if source[lt + 1] == "/":
            if tag in BLOCK or tag in NOISE_TAGS:
                cut()
            open_one = deepest((tag,))
            if open_one is not None and (tag in BLOCK or tag in NOISE_TAGS or not lines or open_one.depth >= lines[-1].depth):
                close(open_one)
            continue
        if tag in BLOCK or tag in NOISE_TAGS:
            cut()
        if tag in BLOCK and (p := up(("p",), ("#page", "button", "table", "td", "th", "article", "section", "div", "body"))) is not None:
            close(p)
        if tag in CLOSES:
            tags, stops = CLOSES[tag]
            if (x := up(tags.split(), stops)) is not None:
                close(x)
        if tag == "br":
            say(" ")
        if tag in VOID:
            continue
        new = Node(tag, m[2], node)
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
            if tag in ("textarea", "title") or end is None:
                pass  # their text is no page text either
            at = n if end is None else end.start()
            if end is not None:
                gt = source.find(">", at)
                at = n if gt < 0 else gt + 1
            continue
        if not m[2].endswith("/") or tag in BLOCK:
            enter(new)
    cut()
    return root, blocks


def nodes_of(root: Node) -> Iterator[Node]:
    todo = [root]
    while todo:
        x = todo.pop()
        yield x
        todo.extend(x.children)


def live_nodes(root: Node) -> list[Node]:
    """Elements with text below them that are no noise, parents before children."""
    order = list(nodes_of(root))
    for x in reversed(order):
        x.live = not x.noise and bool(x.texts or any(c.live for c in x.children))
    return [x for x in order if x.live]


def path_key(above: int, tag: str, names: Iterable[str], rare: Collection[str]) -> int:
    return _hash(f"{above}/{tag}.{' '.join(n for n in names if n not in rare)}")


def keep_blocks(root: Node, blocks: list[tuple[Node, str]], importance: dict[int, float], rare: Collection[str] = ()) -> list[str]:
    """Texts of the page after noise parts and low-importance branches are gone; ``rare``: names that are not in keys."""
    live = [(n, t) for n, t in blocks if not n.noise]
    if not importance:
        return [t for _, t in live]
    order = live_nodes(root)
    for x in order:
        x.key = path_key(x.parent.key if x.parent else 0, x.tag, x.names, rare)
    composite: dict[int, float] = {}
    worth: dict[int, bool] = {}  # whether a text in the branch is above LOW by itself
    for x in reversed(order):
        own = importance.get(x.key, 1.0)
        below = [c for c in x.children if c.live]
        fade = DECAY ** len(below) if below else 0.0
        composite[id(x)] = (1 - fade) * own + (fade * sum(composite[id(c)] for c in below) / len(below) if below else 0.0)
        worth[id(x)] = bool(x.texts) and own >= LOW or any(worth[id(c)] for c in below)

    gone: set[int] = set()
    for x in order:
        low = x.tag not in ("#page", "html", "body") and composite[id(x)] < LOW and not worth[id(x)]
        if low or x.parent is not None and id(x.parent) in gone:
            gone.add(id(x))
    kept = [t for n, t in live if id(n) not in gone]
    return kept or [t for _, t in live]


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _form_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page as the elements that hold text: parent (its place in the list), tag, names, child sequence and texts."""
    node = pa.struct([("parent", pa.int32()), ("tag", pa.string()), ("names", pa.list_(pa.string())), ("style", pa.int64()), ("texts", pa.list_(pa.int64()))])
    out = Out(pa.schema([("host", pa.int64()), ("page", pa.int64()), ("digest", pa.int64()), ("names", pa.list_(pa.string())), ("nodes", pa.list_(node))]))
    for url, source in rows_of(batches, "url", "html"):
        root, blocks = parse(source or "")
        order = live_nodes(root)
        place = {id(x): i for i, x in enumerate(order)}
        nodes = [{"parent": place[id(x.parent)] if x.parent else -1, "tag": x.tag, "names": x.names,
                  "style": _hash(" ".join(c.tag for c in x.children)), "texts": [_hash(t) for t in x.texts]} for x in order]
        digest = _hash("\n\n".join(t for n, t in blocks if not n.noise))
        names = sorted({n for x in nodes for n in x["names"]})
        yield from out.add((_hash(host_of(url)), _hash(source or ""), digest, names, nodes), 100 * len(nodes))
    yield from out.flush()


def _key_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The elements of each page by key; ``rare``: the page's names that do not count."""
    node = pa.struct([("node", pa.int64()), ("style", pa.int64()), ("texts", pa.list_(pa.int64()))])
    out = Out(pa.schema([("host", pa.int64()), ("page", pa.int64()), ("digest", pa.int64()), ("nodes", pa.list_(node))]))
    for host, page, digest, nodes, rare in rows_of(batches, "host", "page", "digest", "nodes", "rare"):
        keys: list[int] = []
        for x in nodes:
            keys.append(path_key(keys[x["parent"]] if x["parent"] >= 0 else 0, x["tag"], x["names"], rare or ()))
        yield from out.add((host, page, digest, [{"node": k, "style": x["style"], "texts": x["texts"]} for k, x in zip(keys, nodes)]), 60 * len(nodes))
    yield from out.flush()


def _tree_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages per (host, node, kind, feature) in the task; kind 0: child sequence, 1: text, 2: the node itself."""
    schema = pa.schema([("host", pa.int64()), ("node", pa.int64()), ("kind", pa.int32()), ("feature", pa.int64()), ("n", pa.int64())])
    counts: Counter = Counter()

    def send():
        if counts:
            keys = list(counts)
            cols = [pa.array([k[i] for k in keys], f.type) for i, f in enumerate(list(schema)[:4])]
            yield pa.record_batch([*cols, pa.array([counts[k] for k in keys], pa.int64())], schema=schema)
            counts.clear()

    for host, nodes in rows_of(batches, "host", "nodes"):
        facts = set()
        for x in nodes:
            facts.add((host, x["node"], 2, 0))
            facts.add((host, x["node"], 0, x["style"]))
            facts.update((host, x["node"], 1, t) for t in x["texts"])
        counts.update(facts)
        if len(counts) > 200_000:
            yield from send()
    yield from send()


def rare_names(forms: DataFrame) -> DataFrame:
    """(host, page, rare): each page's names that are on fewer than MIN_PAGES pages of the host.

    Such a name has at most three pages, which its smallest, largest and xor of page hashes tell,
    so nothing is gathered by name and no frequent name is joined.
    """
    assert MIN_PAGES == 4
    few = (forms.select("host", "page", F.explode("names").alias("name")).groupBy("host", "name")
           .agg(F.count("*").alias("c"), F.min("page").alias("a"), F.max("page").alias("b"), F.bit_xor("page").alias("x")).where(F.col("c") < MIN_PAGES))
    third = F.when(F.col("c") == 3, F.col("x").bitwiseXOR(F.col("a")).bitwiseXOR(F.col("b"))).otherwise(F.col("a"))
    owners = few.select("host", "name", F.explode(F.array_distinct(F.array("a", "b", third))).alias("page"))
    return owners.groupBy("host", "page").agg(F.collect_list("name").alias("rare"))


def style_tree(keyed: DataFrame) -> DataFrame:
    """(host, node, importance) of the merged trees' judged nodes, hosts and nodes as hashes."""
    distinct = keyed.groupBy("host", "digest").agg(F.min_by("nodes", "page").alias("nodes"))
    facts = distinct.select("host", "nodes").mapInArrow(_tree_task, "host long, node long, kind int, feature long, n long")
    facts = facts.groupBy("host", "node", "kind", "feature").agg(F.sum("n").alias("c"))
    per = facts.groupBy("host", "node").agg(
        F.sum(F.when(F.col("kind") == 2, F.col("c"))).alias("m"),
        F.sum(F.when(F.col("kind") == 0, F.col("c"))).alias("all"),
        F.sum(F.when(F.col("kind") == 0, F.col("c") * F.log("c"))).alias("style"),
        F.sum(F.when(F.col("kind") == 1, F.log("c"))).alias("spread"),
        F.count(F.when(F.col("kind") == 1, 1)).alias("texts"))
    log_m = F.log("m")
    style = F.least((F.log("all") - F.col("style") / F.col("all")) / log_m, F.lit(1.0))
    content = 1 - F.col("spread") / (F.col("texts") * log_m)
    return (per.where(F.col("m") >= MIN_PAGES)
            .select("host", "node", F.when(F.col("texts") > 0, F.greatest(content, F.lit(0.0))).otherwise(style).alias("importance")))


def page_nodes(keyed: DataFrame, tree: DataFrame) -> DataFrame:
    """(host, page, nodes): importances of each page's judged nodes; one row for each node and page, hot nodes salted.

    A branch goes only if each text in it is below LOW, so pages without such a text need no row.
    """
    held = F.transform("nodes", lambda x: F.struct(x["node"].alias("node"), (F.size(x["texts"]) > 0).alias("held")))
    rows = keyed.select("host", "page", F.inline(F.array_distinct(held)))
    if tree.count() <= BROADCAST_ROWS:
        found = rows.join(F.broadcast(tree), ["host", "node"])
    else:
        copies = tree.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        found = rows.withColumn("salt", F.pmod("page", F.lit(SALT)).cast("int")).join(copies, ["host", "node", "salt"])
    low = F.max(F.col("held") & (F.col("importance") < LOW))
    return found.groupBy("host", "page").agg(F.collect_list(F.struct("node", "importance")).alias("nodes"), low.alias("low")).where("low").drop("low")


def _extract_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = Out(pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())]))
    for page, url, source, nodes, rare in rows_of(batches, "page_id", "url", "html", "nodes", "rare"):
        root, blocks = parse(source or "")
        text = "\n\n".join(keep_blocks(root, blocks, {x["node"]: x["importance"] for x in nodes or ()}, rare or ()))
        text = text.encode("utf-8", "replace").decode()
        yield from out.add((page, url, text, len(text)), len(text))
    yield from out.flush()


EXTRACTED = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                          T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def _host_key_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        urls, pages = (b.column(b.schema.get_field_index(n)).to_pylist() for n in ("url", "html"))
        keys = [pa.array([_hash(host_of(u)) for u in urls], pa.int64()), pa.array([_hash(p or "") for p in pages], pa.int64())]
        yield pa.record_batch([*keys, *b.columns], names=["host", "page", *b.schema.names])


FORM = ("host long, page long, digest long, names array<string>, "
        "nodes array<struct<parent: int, tag: string, names: array<string>, style: bigint, texts: array<bigint>>>")
KEYED = "host long, page long, digest long, nodes array<struct<node: bigint, style: bigint, texts: array<bigint>>>"


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every page."""
    ship(pages.sparkSession)
    own = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    forms = staged(own.select("url", "html").mapInArrow(_form_task, FORM).dropDuplicates(["host", "page"]), "style_forms")
    rare = staged(rare_names(forms), "style_rare")
    keyed = staged(forms.drop("names").join(rare, ["host", "page"], "left").mapInArrow(_key_task, KEYED), "style_pages")
    tree = staged(style_tree(keyed).where(F.col("importance") < 1), "style_tree")
    known = staged(page_nodes(keyed, tree).join(rare, ["host", "page"], "left"), "style_known")
    sourced = own.mapInArrow(_host_key_task, "host long, page long, page_id long, url string, html string")
    return sourced.join(known, ["host", "page"], "left").select("page_id", "url", "html", "nodes", "rare").mapInArrow(_extract_task, EXTRACTED)
