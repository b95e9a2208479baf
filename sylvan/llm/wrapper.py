"""HTML extraction by wrapper induction.

A host's pages are grouped by layout (the containers they have, by tag and class), those of rare
layouts together. Every page is parsed to a DOM tree and aligned, by simple tree matching, with
its group's reference page (the one with the smallest id hash). Each page votes on each text node
of the reference: matched, and with the same text. For what the reference lacks, it votes on each
other text of its article by the tags above it. What (nearly) all differing pages of the group
show alike is constant: template. A group of fewer than ``CONSTANT_PAGES`` + 1 pages has none; of
its pages, only tags, roles and names tell what is no article. Blocks of a page that hold constant nodes only go; of the
varying slots, those in the article stay. A page's roles (navigation, advert, comments ...) are
read from tags and class names, and the article is the ``article``/``main`` element or, without
one, the whole body. Reader comments always go. Any other name or a form takes no article away: such an
element stays if nothing else could be the article (no prose outside such elements; within an article or main
element, no text at all), or if it holds the page's only article or main element.

A null or empty page gives '' and 0. Pages without a host are a host of their own. Repeated
pages agree with each other: they do not vote (only pages that differ from the reference do),
so copies never make content look constant. Very long pages are read whole; aligning the children of two
elements takes the product of their numbers. Extra columns are not read, whatever their names. An empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import html as _html
import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sylvan.llm.common import T_to_arrow, pick, slices
from sylvan.operators.features import maybe_broadcast
from sylvan.session import write_table

#: A node is constant if at least CONSTANT_SHARE of the differing pages, and at least
#: CONSTANT_PAGES of them, show its text at its place. A page differs if less than half of its
#: article's characters lie in nodes that equal the reference's.
CONSTANT_SHARE, CONSTANT_PAGES = 0.9, 5
#: A layout with fewer pages of a host cannot have a template: such layouts form one group.
LAYOUT_PAGES = CONSTANT_PAGES + 1
#: Elements nested deeper become siblings, as in browsers; no text is lost.
MAX_DEPTH = 256

# ---- fixed values: element kinds and class words --------------------------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup "
    "time tt u var wbr".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)
DROPPED = frozenset(
    "aside button canvas datalist dialog footer head iframe input menu nav noscript object option script select style "
    "svg template textarea title video audio".split()
)
DROPPED_ROLES = frozenset("alert banner complementary contentinfo dialog menu menubar navigation search".split())
DROPPED_WORDS = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer "
    "discussion disqus footer gdpr menu modal nav navbar navigation newsletter notice notices notification popup promo "
    "promotion recommended related replies reply respond share sharing sidebar social sponsor sponsored subscribe toolbar "
    "widget".split()
)
#: Words that say nothing of an element's role. A compound class or id counts as a dropped name
#: only if its other words are among these: 'comment-list', but not 'no-comments'.
PLAIN_WORDS = frozenset(
    "above area bar below block body bottom box btn button buttons center col column container content desktop entry fb fixed form "
    "global google group header holder icon icons inline inner item items left link links list main mobile outer page panel post "
    "primary region right row secondary section site slot sticky text title top unit wp wrap wrapper x".split()
)
#: Names of reader comments, and words that go with them.
COMMENT_WORDS = frozenset("comment commentform commentlist comments disqus replies reply respond".split())
COMMENT_CONTEXT = frozenset("article blog facebook news reader readers story thread user users".split())
#: Characters that make prose: a named element is overruled only if no more than this lies elsewhere.
LEAST_KEPT = 100
# ------------------------------------------------------------------------------------------

_TOKEN = re.compile(
    r"<!--(?s:.*?)(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
)
_ATTR = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NONE = re.compile(r"(?i)display\s*:\s*none")
_WORD = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "attrs", "kids", "text", "shape", "size", "up", "depth")

    def __init__(self, tag: str, attrs: str = "", text: str = "", up: Node | None = None):
        self.tag, self.attrs, self.text, self.up = tag, attrs, text, up
        self.kids: list[Node] = []
        self.shape, self.size = 0, 1
        self.depth = 0 if up is None else up.depth + 1


def parse(page: str) -> Node:
    """The DOM tree of a page; broken markup is mended as browsers do in the common cases
    (unclosed paragraphs, items and cells, stray end tags, a cut end)."""
    root = here = Node("#root")
    at = depth = 0

    def add_text(s: str) -> None:
        if s and not s.isspace():
            here.kids.append(Node("#text", text=_html.unescape(s), up=here))
        elif s:
            here.kids.append(Node("#blank", up=here))

    for m in iter(lambda: _TOKEN.search(page, at), None):
        add_text(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            node = here
            while node.up is not None and node.tag != tag:
                node = node.up
            if node.up is not None:
                here = node.up
                depth = here.depth
            continue
        attrs = m[3] if m[2] else m[6]
        ends = {"p"} if tag in CLOSES_P else {tag} if tag in ("li", "tr", "option") else {"td", "th"} if tag in ("td", "th") else (
            {"dt", "dd"} if tag in ("dt", "dd") else ())
        if ends:  # an open one of these ends here, through inline elements only
            node = here
            while node.up is not None and (node.tag in INLINE or node.tag in ends):
                if node.tag in ends:
                    here = node.up
                    depth = here.depth
                    break
                node = node.up
        node = Node(tag, attrs, up=here)
        here.kids.append(node)
        if tag in RAW:
            end = re.compile(rf"(?i)</{re.escape(tag)}\b[^>]*(?:>|\Z)").search(page, at)
            at = end.end() if end else len(page)
        elif tag not in VOID and not attrs.rstrip().endswith("/") and depth < MAX_DEPTH:
            here = node
            depth = node.depth
    add_text(page[at:])
    return root


def shapes(root: Node, known: dict) -> None:
    """Numbers equal shapes (tags only) alike, and counts nodes."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(node.kids)
    for node in reversed(order):
        kids = [k for k in node.kids if k.tag != "#blank"]
        node.size = 1 + sum(k.size for k in kids)
        node.shape = known.setdefault((node.tag, *[k.shape for k in kids]), len(known) + 1)


class Matcher:
    """Simple tree matching: the largest order-preserving matching of two trees, roots paired,
    children aligned by dynamic programming. Scores depend on shapes alone and are kept."""

    def __init__(self):
        sys.setrecursionlimit(max(sys.getrecursionlimit(), 32 * MAX_DEPTH))  # score() descends both trees
        self.known: dict = {}
        self.scores: dict[tuple[int, int], int] = {}

    def tree(self, page: str) -> Node:
        if len(self.known) > 200_000:
            self.known.clear()
            self.scores.clear()
        root = parse(page)
        shapes(root, self.known)
        return root

    def score(self, a: Node, b: Node) -> int:
        if a.tag != b.tag:
            return 0
        if a.shape == b.shape:
            return a.size
        key = (a.shape, b.shape)
        got = self.scores.get(key)
        if got is None:
            got = 1 + sum(self.score(x, y) for x, y in self.children(a, b))
            if len(self.scores) > 500_000:
                self.scores.clear()
            self.scores[key] = got
        return got

    def children(self, a: Node, b: Node) -> list[tuple[Node, Node]]:
        """The aligned pairs of children."""
        x = [k for k in a.kids if k.tag != "#blank"]
        y = [k for k in b.kids if k.tag != "#blank"]
        lo = 0
        while lo < min(len(x), len(y)) and x[lo].shape == y[lo].shape:
            lo += 1  # equal shapes at either end are best paired with each other
        hi = 0
        while hi < min(len(x), len(y)) - lo and x[-1 - hi].shape == y[-1 - hi].shape:
            hi += 1
        pairs = list(zip(x[:lo], y[:lo], strict=True))
        u, v = x[lo : len(x) - hi], y[lo : len(y) - hi]
        if u and v:
            table = [[0] * (len(v) + 1)]
            for i, p in enumerate(u):
                above, row = table[-1], [0]
                for j, q in enumerate(v):
                    row.append(max(above[j + 1], row[j], above[j] + self.score(p, q)))
                table.append(row)
            i, j, middle = len(u), len(v), []
            while i and j:
                s = self.score(u[i - 1], v[j - 1])
                if s and table[i][j] == table[i - 1][j - 1] + s:
                    i, j = i - 1, j - 1
                    middle.append((u[i], v[j]))
                elif table[i][j] == table[i - 1][j]:
                    i -= 1
                else:
                    j -= 1
            pairs += middle[::-1]
        if hi:
            pairs += zip(x[-hi:], y[-hi:], strict=True)
        return pairs

    def align(self, a: Node, b: Node) -> Iterator[tuple[Node, Node]]:
        """All matched pairs of nodes."""
        stack = [(a, b)] if a.tag == b.tag else []
        while stack:
            p, q = stack.pop()
            yield p, q
            stack.extend(self.children(p, q))


def text_nodes(root: Node) -> list[Node]:
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.tag == "#text":
            out.append(node)
        stack.extend(reversed(node.kids))
    return out


def same_text(a: Node, b: Node) -> bool:
    return a.text == b.text or a.text.split() == b.text.split()


@lru_cache(maxsize=20_000)
def _kind(attrs: str) -> str:
    """What an element's attributes say: "hidden" (or a role outside the article), "comment", "named", "form", "main" or ""."""
    kind = ""
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value.strip() == "true" or name == "style" and _NONE.search(value):
            return "hidden"
        if name == "role":
            roles = value.split()
            if not DROPPED_ROLES.isdisjoint(roles):
                return "hidden"
            kind = kind or ("form" if "form" in roles else "main" if "main" in roles else "")
        elif name in ("class", "id"):
            for token in value.split():
                words = set(_WORD.findall(token))
                if words & COMMENT_WORDS and words <= COMMENT_WORDS | DROPPED_WORDS | PLAIN_WORDS | COMMENT_CONTEXT:
                    kind = "comment"
                elif kind != "comment" and words & DROPPED_WORDS and words <= DROPPED_WORDS | PLAIN_WORDS:
                    kind = "named"
    return kind


def is_dropped(node: Node, in_article: bool) -> bool:
    """Whether the element's tag, role or hiding attributes say that it is no article text."""
    if node.tag in DROPPED or node.tag == "header" and not in_article:
        return True
    return bool(node.attrs) and node.tag not in ("html", "body") and _kind(node.attrs) == "hidden"


def is_named(node: Node) -> str:
    """ "comment", "named" or "form" if a name or a form says that the element is no article text."""
    if node.tag in ("#text", "#blank", "html", "body"):
        return ""
    kind = _kind(node.attrs) if node.attrs else ""
    return kind if kind in ("comment", "named") else "form" if node.tag == "form" or kind == "form" else ""


class Weights:
    """Characters of text below an element that are neither template nor dropped for tag or role: in all,
    without reader comments, and outside any element that goes by a name or is a form."""

    def __init__(self, template: set[int]):
        self.template, self.kept = template, {}

    def of(self, top: Node) -> tuple[int, int, int]:
        if id(top) not in self.kept:
            stack = [(top, False)]
            while stack:
                node, done = stack.pop()
                if done:
                    self.kept[id(node)] = self._sum(node)
                elif node.tag == "#text":
                    n = 0 if id(node) in self.template else len(" ".join(node.text.split()))
                    self.kept[id(node)] = (n, n, n)
                elif node.tag != "#blank" and (node is top or not is_dropped(node, True)):
                    stack.append((node, True))
                    stack.extend((k, False) for k in node.kids)
        return self.kept[id(top)]

    def _sum(self, node: Node) -> tuple[int, int, int]:
        whole = said = plain = 0
        for k in node.kids:
            if id(k) in self.kept:
                a, b, c = self.kept[id(k)]
                name = is_named(k)
                whole += a
                said += 0 if name == "comment" else b
                plain += 0 if name else c
        return whole, said, plain

    def goes(self, node: Node, whole: Node) -> bool:
        """Whether a name or a form takes the element away from ``whole``.

        Comments always go. Any other name is overruled only where nothing else could be the article:
        ``whole`` has no text outside such elements (for a whole page: less than prose), and most of
        its text, comments aside, is here."""
        kind = is_named(node)
        if not kind:
            return False
        if kind == "comment":
            return True
        own, (_, said, plain) = self.of(node)[1], self.of(whole)
        if plain and (whole.tag != "#root" or plain >= LEAST_KEPT or own < LEAST_KEPT):
            return True
        return 2 * own < said or own < (LEAST_KEPT if kind == "named" else 1)


def _holds_article(node: Node) -> bool:
    stack = list(node.kids)
    while stack:
        node = stack.pop()
        if node.tag in ("article", "main") and is_named(node) not in ("comment", "named"):
            return True
        stack.extend(node.kids)
    return False


def main_nodes(root: Node, weights: Weights | None = None) -> list[Node]:
    """The article elements (outermost), else the main elements, else the whole page. Articles in
    elements that go by their name (comments, teasers) count only if the page has no others."""
    weights = weights or Weights(set())
    articles, mains, named_articles, named_mains = [], [], [], []
    stack = [(root, False, False)]
    while stack:
        node, inside, named = stack.pop()
        name = is_named(node)
        if node.tag[0] == "#" and node.tag != "#root" or is_dropped(node, inside) or name == "comment":
            continue
        named = named or name == "named" and weights.goes(node, root)
        if node.tag == "article" and not inside:
            (named_articles if named else articles).append(node)
            inside = True
        elif node.tag == "main" or node.attrs and _kind(node.attrs) == "main":
            (named_mains if named else mains).append(node)
        stack.extend((k, inside, named) for k in reversed(node.kids))
    if articles:
        return articles
    mains = mains or named_mains
    if not mains and named_articles and not any(n is not None and n.tag == "#text" for n in _kept_nodes(root, weights)):
        return named_articles
    return [m for m in mains if not any(o is not m and _within(m, o) for o in mains)] or [root]


def _within(node: Node, other: Node) -> bool:
    while node is not None:
        if node is other:
            return True
        node = node.up
    return False


def _kept_nodes(main: Node, weights: Weights) -> Iterator[Node | None]:
    """The text and blank nodes of the article in page order, None where a block ends."""
    inside = main.tag == "article"
    stack: list[Node | None] = [main]
    while stack:
        node = stack.pop()
        if node is None or node.tag in ("#text", "#blank"):
            yield node
        elif node is main or not is_dropped(node, inside):
            # without an article element, one in a named container is kept with it
            if node is not main and weights.goes(node, main):
                if main.tag != "#root" or is_named(node) == "comment" or not _holds_article(node):
                    continue
            if node.tag not in INLINE:
                yield None
                stack.append(None)
            stack.extend(reversed(node.kids))
    yield None


def article_blocks(root: Node, template: set[int] = frozenset()) -> list[list[Node]]:
    """The article's blocks in page order, each with its text nodes ("#blank" ones between words)."""
    blocks: list[list[Node]] = []
    run: list[Node] = []
    weights = Weights(template)
    for main in main_nodes(root, weights):
        for node in _kept_nodes(main, weights):
            if node is not None:
                run.append(node)
                continue
            if any(n.tag == "#text" for n in run):
                blocks.append(run.copy())
            run.clear()
    return blocks


def main_text(root: Node, template: set[int]) -> str:
    """The article's text. A block goes if all its text nodes (by ``id``) are template."""
    out = []
    for block in article_blocks(root, template):
        if template and all(id(n) in template for n in block if n.tag == "#text"):
            continue
        out += "".join(n.text if n.tag == "#text" else " " for n in block).split()
    return " ".join(out)


def host(url: Column) -> Column:
    """Lower-case host of a URL ('' without one)."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def layout(html: Column) -> Column:
    """A number for the set of a page's containers, by tag and the letters that their class begins with."""
    tags = F.regexp_extract_all(html, F.lit(r"(?i)<((?:body|main|article|section|div|header|footer|aside|nav|form|table)\b[^>]*)"), F.lit(1))

    def kind(tag: Column) -> Column:
        of = F.regexp_extract(tag, r"(?i)\sclass\s*=\s*[\"']?\s*([a-z_-]*)", 1)
        return F.lower(F.concat_ws(" ", F.regexp_extract(tag, r"^\w+", 0), of))

    return F.xxhash64(F.array_join(F.array_sort(F.array_distinct(F.transform(tags, kind))), "\n"))


def grouped(pages: DataFrame) -> DataFrame:
    """The pages with their group in ``host``: the host and the layout, if the host has enough pages of it."""
    pages = pages.withColumn("layout", layout(F.col("html")))
    sizes = pages.filter("length(html) > 0").groupBy(F.col("host").alias("of"), F.col("layout").alias("common")).count()
    sizes = write_table(sizes.filter(F.col("count") >= LAYOUT_PAGES).drop("count"), "wrapper-layouts")
    small = maybe_broadcast(sizes, sizes.count(), 96)
    both = pages.join(small, (F.col("host") == F.col("of")) & (F.col("layout") == F.col("common")), "left")
    group = F.concat_ws(" ", "host", F.col("common").cast("string"))
    return both.withColumn("host", group).drop("of", "common", "layout")


def text_key(node: Node, text: str, paths: dict[int, str]) -> int:
    """A number below -1 for a text under its tags, from the root down."""
    up, todo = node.up, []
    while up is not None and id(up) not in paths:
        todo.append(up)
        up = up.up
    for one in reversed(todo):
        paths[id(one)] = hashlib.blake2b(f"{'' if one.up is None else paths[id(one.up)]}/{one.tag}".encode(), digest_size=8).hexdigest()
    mark = hashlib.blake2b(f"{paths[id(node.up)]} {text}".encode("utf-8", "replace"), digest_size=8).digest()
    return -2 - (int.from_bytes(mark, "big") >> 2)


def other_texts(blocks: list[list[Node]], taken: set[int]) -> dict[int, int]:
    """``id`` and number of the article's text nodes that are not in ``taken``."""
    paths: dict[int, str] = {}
    nodes = (n for block in blocks for n in block if n.tag == "#text" and id(n) not in taken)
    return {id(n): text_key(n, " ".join(n.text.split()), paths) for n in nodes}


def _columns(batch: pa.RecordBatch, *names: str) -> list[list]:
    return [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names]


def induce(pages: DataFrame) -> DataFrame:
    """``host, seed, constant``: each group's reference page, the numbers (in page order) of its
    constant text nodes and those (below -1, see ``text_key``) of constant texts that it lacks, from
    the votes of all ``grouped`` pages ``(page_id, host, html)``.

    Votes are summed per group before they leave a task. Votes on texts that the reference lacks
    carry a digest of the article: equal articles have one vote. The reference pages are found on ids
    and joined by host: broadcast when their counted bytes are small, else by a shuffle whose
    hot hosts AQE splits (no step needs a host's pages together).
    """
    rank = F.struct(F.xxhash64("page_id"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    ids = pages.filter("length(html) > 0").groupBy("host").agg(F.min(rank).alias("first"))
    ids = write_table(ids.select(F.col("host").alias("seed_host"), "first"), "wrapper-ids")
    small = maybe_broadcast(ids, ids.count(), 256)
    seeds = pages.filter("length(html) > 0").join(small, (F.col("host") == F.col("seed_host")) & (rank == F.col("first")))
    # rows with the same id: one of them (the smallest page) is the reference
    seeds = write_table(seeds.groupBy("host").agg(F.min("html").alias("seed")), "wrapper-seeds")
    voting = pages.filter("length(html) > 0").select("host", "html").join(_sized(seeds), "host")
    schema = T.StructType().add("host", "string").add("node", "long").add("mark", "binary").add("same", "long").add("pages", "long")
    arrow = T_to_arrow(schema)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, trees, votes, others = Matcher(), {}, {}, set()

        def flush():
            rows = [(h, n, None, s, p) for h, (p, per) in votes.items() for n, s in [(-1, 0), *per.items()]]
            rows += [(h, n, mark, 0, 0) for h, n, mark in others]
            votes.clear()
            others.clear()
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in arrow]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

        for whole in batches:
            for part in slices(whole, "html"):
                for name, page, seed in zip(*_columns(part, "host", "html", "seed"), strict=True):
                    ref, at = _reference(matcher, trees, name, seed)
                    tree = matcher.tree(page)
                    same = [(p, at[id(q)]) for p, q in matcher.align(tree, ref) if q.tag == "#text" and same_text(p, q)]
                    blocks = article_blocks(tree)
                    own = {id(n): len(n.text) for block in blocks for n in block if n.tag == "#text"}
                    if 2 * sum(own.get(id(p), 0) for p, _ in same) >= sum(own.values()):
                        continue  # a copy of the reference, or nearly
                    total, per = votes.get(name, (0, {}))
                    for _, n in same:
                        per[n] = per.get(n, 0) + 1
                    votes[name] = (total + 1, per)
                    words = " ".join(" ".join(n.text.split()) for block in blocks for n in block if n.tag == "#text")
                    mark = hashlib.blake2b(words.encode("utf-8", "replace"), digest_size=8).digest()
                    others.add((name, -1, mark))
                    others.update((name, n, mark) for n in other_texts(blocks, {id(p) for p, _ in same}).values())
                if len(votes) > 1000 or len(others) > 100_000:
                    yield flush()
        yield flush()

    got = voting.mapInArrow(vote, schema).groupBy("host", "node", "mark").agg(F.sum("same").alias("same"), F.sum("pages").alias("pages"))
    # a marked row is one article: it counts once, whatever the number of its copies
    once = F.col("mark").isNotNull()
    counts = [F.sum(F.when(once, 1).otherwise(F.col("same"))).alias("same"), F.sum(F.when(~once, F.col("pages"))).alias("pages")]
    voted = got.groupBy("host", "node").agg(*counts).filter(F.col("node").eqNullSafe(-1) | (F.col("same") >= CONSTANT_PAGES))
    voted = write_table(voted, "wrapper-votes")
    voters = voted.filter("node = -1").select("host", F.col("pages").alias("voters"), F.col("same").alias("articles"))
    least = CONSTANT_SHARE * F.when(F.col("node") >= 0, F.col("voters")).otherwise(F.col("articles"))
    constant = voted.filter("node <> -1").join(voters, "host").filter(F.col("same") >= least)
    constant = constant.groupBy("host").agg(F.sort_array(F.collect_list("node")).alias("constant"))  # nodes of one page
    none = F.array().cast("array<bigint>")
    return seeds.join(constant, "host", "left").select("host", "seed", F.coalesce("constant", none).alias("constant"))


def _sized(seeds: DataFrame) -> DataFrame:
    """Broadcast hint if the counted bytes of the pages in it are small."""
    total = seeds.agg(F.sum(F.octet_length("seed") + 64)).first()[0] or 0
    return maybe_broadcast(seeds, total, 1)


def _reference(matcher: Matcher, trees: dict, name: str, seed: str) -> tuple[Node, dict[int, int]]:
    """The host's parsed reference page and the number of each of its text nodes."""
    if matcher.known and (kept := trees.get(name)):
        return kept
    if len(trees) > 1000 or not matcher.known:
        trees.clear()
    ref = matcher.tree(seed)
    trees[name] = ref, {id(n): i for i, n in enumerate(text_nodes(ref))}
    return trees[name]


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    pages = grouped(pick(df, page_id=id_col, url=url_col, html=html_col).withColumn("host", host(F.col("url"))))
    wrappers = write_table(induce(pages), "wrappers")
    # a wrapper without constant nodes takes nothing away: its pages need no alignment
    wrappers = wrappers.filter(F.size("constant") > 0)
    rows = pages.join(_sized(wrappers), "host", "left").select("page_id", "url", "host", "html", "seed", "constant")
    schema = T.StructType([rows.schema["page_id"], rows.schema["url"]]).add("text", "string").add("n_chars", "long")
    arrow = T_to_arrow(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, trees = Matcher(), {}
        for whole in batches:
            for part in slices(whole, "html"):
                texts = []
                for name, page, seed, constant in zip(*_columns(part, "host", "html", "seed", "constant"), strict=True):
                    if not page:
                        texts.append("")
                        continue
                    if not constant:
                        texts.append(main_text(parse(page), set()))
                        continue
                    ref, at = _reference(matcher, trees, name, seed)
                    tree, gone = matcher.tree(page), set(constant)
                    pairs = matcher.align(tree, ref)
                    template = {id(p) for p, q in pairs if q.tag == "#text" and at[id(q)] in gone and same_text(p, q)}
                    if constant[0] < -1:
                        blocks = article_blocks(tree, template)
                        own = {id(n): len(n.text) for block in blocks for n in block if n.tag == "#text"}
                        more = {n for n, key in other_texts(blocks, template).items() if key in gone}
                        # pages that share most of their text are copies of each other, not template
                        if 2 * sum(own[n] for n in more) < sum(own.values()):
                            template |= more
                    texts.append(main_text(tree, template))
                cols = [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    return rows.mapInArrow(run, schema)
