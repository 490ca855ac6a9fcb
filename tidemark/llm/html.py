"""Main text of web pages, with site templates removed by counting subtrees per host.

Pass one parses every page, hashes each block-level subtree (tag, attributes, text and children;
the host is part of the hash) and counts in Spark on how many pages of the host it stands. A
subtree is template if it stands on at least ``LEAST_PAGES`` pages and on a share of
``LEAST_SHARE`` of the host's pages or on ``MANY_PAGES`` of them. Pass two parses again, deletes template subtrees and
what its markup says is no article (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles, reader comments), and takes the text of the rest: of the article if the page
marks one (``article``, else ``main`` and its like), else of the body without blocks of links.

Inside the marked article a subtree counts once for each distinct article, so that copies of one
article make no template of its paragraphs. There a template subtree goes unless it holds at least
``WHOLE`` of the article's letters, and none goes if less than ``OWN`` of the letters would be
left: both tell an article that is repeated as a whole. List items, table rows and cells recur as
data and go only with their list or table; a template heading goes only if the next element goes.

Template hashes go to the executors as one sorted array if there are at most ``SENT`` (8 MB); a
larger number is joined to the pages' own subtrees by hash and gathered per page instead. Both
ways give the same result. A host with very many pages only adds partial counts.

Text: character references are decoded, white space inside a block becomes one space, blocks are
trimmed and joined in page order by an empty line; nothing else is dropped or cut.

Defined cases: null or empty html has the empty text. A page whose url is null or has no host has
no template. Repeated rows are pages of their own; rows that repeat a page_id are extracted one by
one. Markup may be unclosed, wrongly nested or endless: parsing is linear and needs no recursion.
Other columns are never read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from html import unescape
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, map_batches, table, texts_of, written

LEAST_PAGES, LEAST_SHARE, SENT = 8, 0.25, 1 << 20
#: Pages from which a subtree is template whatever its share of the host.
MANY_PAGES = 100
#: Shares of an article's letters: of one subtree that is never template, and least left of the article's own.
WHOLE, OWN = 0.5, 0.2

#: Fixed values of HTML: elements without content, raw text, blocks, and what ends an open p.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
ENDS_P = BLOCK - frozenset("body caption dd dt head html legend li option tbody td tfoot th thead tr".split())
#: An element in the first column ends an open one of the second, searched up to the third.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr",), ("table", "tbody", "thead", "tfoot")),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select", "datalist")),
    "tbody": (("thead", "tbody", "tfoot"), ("table",)),
    "tfoot": (("thead", "tbody"), ("table",)),
}
#: Elements, roles and name parts that hold no article text.
NO_TEXT = frozenset(
    "script style noscript template svg math iframe object embed canvas audio video map nav footer aside form button select textarea "
    "input option datalist dialog menu head title search".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
PARTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices "
    "newsletter subscribe subscription signup popup modal overlay menu nav navbar navigation breadcrumb breadcrumbs sidebar sidebars footer masthead "
    "comment comments disqus respond share sharing social related recommended recommendations widget widgets toolbar pagination pager login copyright "
    "skiplink topbar bottombar alert".split()
)
#: What else a name of such a block may say. With any other word it names something of the article's own.
FILLERS = frozenset(
    "main site page post posts article articles entry block box section container wrapper wrap inner outer content area body top bottom left right primary secondary header list item items link links title text "
    "button buttons btn bar icon icons form field input group row col column columns panel card cards slot unit zone region global local user reader "
    "html js fixed sticky mobile desktop small large big dark light new more read other all the our your us up to in on of for and by email mail letter news rss feed facebook twitter media follow "
    "stories story topics tags tag category categories archive latest popular trending most also like you might may privacy legal terms policy bottomline id area thread threads reply replies count form".split()
)
HEADERS = frozenset(("header", "topbar", "masthead"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
#: Blocks that are parts of a larger one, whose small values recur as data.
PIECES = frozenset("li dt dd tr td th tbody thead tfoot caption legend summary figcaption".split())
CONTENT = frozenset(("article", "articlebody", "content", "main", "maincontent", "post", "postbody", "entry", "story", "storybody"))

#: Most tags. Its bounds only keep a failed try short: what it does not match goes to ``Tokens.tag``.
SHORT_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]{0,64}+)(?=[\s/>])((?:[^>"']{1,256}+|"[^"]{0,256}+"|'[^']{0,256}+'){0,16}+)>""")
NAME_END = re.compile(r"[\s/>]")
SPECIAL = re.compile(r"""[>"']""")
ATTRIBUTE = re.compile(r"""([^\s=/"'<>]++)\s*+(?:=\s*+("[^"]*"|'[^']*'|[^\s>"']++))?""")
NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")


class Node:
    __slots__ = ("attributes", "children", "digest", "tag")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.attributes, self.children, self.digest = tag, attributes, [], 0

    def close(self) -> None:
        h = xxhash.xxh3_64(f"{self.tag}\0{' '.join(self.attributes.split())}\0")
        for child in self.children:
            if isinstance(child, Node):
                h.update(child.digest.to_bytes(8, "little"))
            elif words := child.split():
                h.update(f"\1{' '.join(words)}\1")
        self.digest = h.intdigest()


class Tokens:
    """The tags, comments and declarations of a page, found in linear time without a bound on their length.

    In a tag a quote opens a value if the same quote follows anywhere, else it is a character like
    others; the tag ends at the first ``>`` outside values. A ``<`` whose tag never ends is text.
    """

    def __init__(self, html: str):
        self.html = html
        self.last = {c: html.rfind(c) for c in "\"'>"}
        self.near: dict[re.Pattern, tuple[int, int]] = {}
        self.endless: set[int] = set()  # quotes outside values from which no tag ends

    def first(self, what: re.Pattern, at: int) -> int:
        """Where ``what`` stands first from ``at`` on; not sought again while that place lies ahead."""
        since, found = self.near.get(what, (0, -1))
        if not since <= at <= found:
            m = what.search(self.html, at)
            found = m.start() if m else len(self.html)
            self.near[what] = (at, found)
        return found

    def tag(self, at: int) -> tuple | None:
        html = self.html
        slash = html[at + 1] == "/"
        name = at + 1 + slash
        if not (html[name : name + 1].isascii() and html[name : name + 1].isalpha()):
            return None
        stop = self.first(NAME_END, name)
        here, passed = self.first(SPECIAL, stop), []
        while here <= self.last[">"]:
            quote = html[here]
            if quote == ">":
                return at, here + 1, "/" * slash, html[name:stop], html[stop:here]
            if here in self.endless:
                break
            passed.append(here)
            after = (html.index(quote, here + 1) if here < self.last[quote] else here) + 1
            m = SPECIAL.search(html, after)
            here = m.start() if m else len(html)
        self.endless.update(passed)
        return None

    def next(self, at: int) -> tuple | None:
        """(start, end, slash, name, attributes) of the first token from ``at`` on; no name for a comment."""
        html = self.html
        while (at := html.find("<", at)) >= 0 and at + 1 < len(html):
            if m := SHORT_TAG.match(html, at):
                return at, m.end(), m[1], m[2], m[3]
            if html[at + 1] in "!?":
                for start, end in (("<!--", "-->"), ("<![CDATA[", "]]>")):
                    if html.startswith(start, at):
                        close = html.find(end, at + len(start))
                        return at, close + len(end) if close >= 0 else len(html), "", None, ""
                if at + 2 <= self.last[">"]:
                    return at, html.index(">", at + 2) + 1, "", None, ""
            elif found := self.tag(at):
                return found
            at += 1
        return None


def parse(html: str) -> Node:
    """The tree of a page. Text children stay as written; every node knows its subtree's hash."""
    root = Node("#root")
    stack, at = [root], 0

    def up_to(place: int) -> None:
        while len(stack) > place:
            stack.pop().close()

    def ended(tags, bounds) -> None:
        for place in range(len(stack) - 1, 0, -1):
            if stack[place].tag in tags:
                return up_to(place)
            if stack[place].tag in bounds:
                return None
        return None

    open_tags: dict[str, int] = {}  # upper bounds, to look for an end tag's element only if there may be one
    end, tokens = len(html), Tokens(html)
    while at < end:
        token = tokens.next(at)
        if token is None:
            stack[-1].children.append(html[at:])
            break
        if token[0] > at:
            stack[-1].children.append(html[at : token[0]])
        at, slash, tag, written_attributes = token[1:]
        if tag is None:
            continue
        tag = tag.lower()
        if slash:
            if open_tags.get(tag):
                block = tag in BLOCK
                for place in range(len(stack) - 1, 0, -1):
                    if stack[place].tag == tag:
                        up_to(place)
                        break
                    if not block and stack[place].tag in BLOCK:
                        break
                open_tags[tag] -= 1
            continue
        if tag in ENDS_P and open_tags.get("p"):
            ended(("p",), ("table", "td", "th", "caption", "button", "object", "html"))
        if tag in IMPLIED and any(open_tags.get(t) for t in IMPLIED[tag][0]):
            ended(*IMPLIED[tag])
        node = Node(tag, written_attributes)
        stack[-1].children.append(node)
        if tag in VOID or (written_attributes.endswith("/") and tag not in BLOCK and tag not in RAW):
            node.close()
        elif tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            node.children.append(html[at : close.start() if close else end])
            node.close()
            at = close.end() if close else end
        else:
            stack.append(node)
            open_tags[tag] = open_tags.get(tag, 0) + 1
    up_to(0)
    return root


def attributes(node: Node) -> dict[str, str]:
    return {m[1].lower(): unescape((m[2] or "").strip("\"'")) for m in ATTRIBUTE.finditer(node.attributes)}


def names(value: dict[str, str], least: frozenset) -> bool:
    """Whether a class or id names a block of no article: one word of ``least`` and none but those and fillers."""
    for name in f"{value.get('class', '')} {value.get('id', '')}".split():
        words = [w.lower() for w in NAME_PARTS.findall(name) if not w.isdigit()]
        if name.lower().replace("-", "").replace("_", "") in least or (any(w in least for w in words) and all(w in PARTS or w in least or w in FILLERS or len(w) == 1 for w in words)):
            return True
    return False


def no_article(node: Node, inside: bool) -> bool:
    """Whether an element's own markup says that it holds no article text."""
    if node.tag in NO_TEXT or (node.tag == "header" and not inside):
        return True
    if node.tag in ("#root", "html", "body", "article", "main") and not node.attributes:
        return False
    if not node.attributes:
        return False
    value = attributes(node)
    if "hidden" in value or value.get("aria-hidden", "").lower() == "true" or "display:none" in value.get("style", "").replace(" ", "").lower():
        return True
    if value.get("role", "").lower() in ROLES:
        return True
    if node.tag in ("html", "body", "main", "h1"):
        return False
    return names(value, PARTS) or (not inside and names(value, HEADERS))


def content_name(node: Node) -> bool:
    if not node.attributes or node.tag in ("html", "body"):
        return False
    value = attributes(node)
    if value.get("itemprop", "").lower() == "articlebody" or value.get("role", "").lower() in ("main", "article"):
        return True
    names = {n.lower().replace("-", "").replace("_", "") for n in f"{value.get('class', '')} {value.get('id', '')}".split()}
    return bool(names & CONTENT)


def outside(root: Node, stop) -> list[Node]:
    """All nodes in page order; below a node for which ``stop`` is true, none."""
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        if not stop(node):
            todo += [c for c in reversed(node.children) if isinstance(c, Node)]
    return out


def letters(node: Node) -> int:
    total, todo = 0, [node]
    while todo:
        n = todo.pop()
        for child in n.children:
            if isinstance(child, Node):
                if child.tag not in NO_TEXT:
                    todo.append(child)
            else:
                total += len(child)
    return total


def article_of(root: Node) -> Node | None:
    """The element that the page marks as its article, if it marks one."""
    dropped = lambda n: no_article(n, False)
    nodes = [n for n in outside(root, lambda n: n.tag == "article" or dropped(n)) if not dropped(n)]
    for found in ([n for n in nodes if n.tag == "article"], [n for n in nodes if n.tag == "main"], [n for n in nodes if content_name(n)]):
        if found:
            best = max(found, key=letters)
            if letters(best):
                return best
    return None


def host_of(url: str | None) -> str:
    try:
        host = (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""
    return host.removeprefix("www.")


def in_host(host: int, digest: int) -> int:
    """A subtree's hash within a host, as a signed 64-bit number."""
    return xxhash.xxh3_64_intdigest(host.to_bytes(8, "little") + digest.to_bytes(8, "little")) - (1 << 63)


def host_hash(url: str | None) -> int | None:
    host = host_of(url)
    return xxhash.xxh3_64_intdigest(host) if host else None


def inside(article: Node) -> list[Node]:
    """The nodes within an article that hold its text, in page order."""
    out, todo = [], list(reversed(article.children))
    while todo:
        node = todo.pop()
        if isinstance(node, Node) and not no_article(node, True):
            out.append(node)
            todo += reversed(node.children)
    return out


def counted(node: Node) -> bool:
    """Whether a node within an article may be template."""
    return node.tag in BLOCK and node.tag not in PIECES


def hashes(html: str, url: str | None) -> tuple[set[int], set[int], int]:
    """Hashes of a page's block-level subtrees outside and only inside its article, and the article's own."""
    host = host_hash(url)
    if host is None or not html:
        return set(), set(), 0
    root = parse(html)
    article = article_of(root)
    around = [n for n in outside(root, lambda n: n is article or n.tag in NO_TEXT) if n is not article and n.tag in BLOCK and n.tag not in NO_TEXT and n.tag not in ("html", "body")]
    out = {in_host(host, n.digest) for n in around}
    if article is None:
        return out, set(), 0
    return out, {in_host(host, n.digest) for n in inside(article) if counted(n)} - out, in_host(host, article.digest)


def subtrees(html: str, url: str | None) -> set[int]:
    """Hashes of the block-level subtrees of a page."""
    out, within, _ = hashes(html, url)
    return out | within


def repeated(article: Node, host: int, is_template) -> set[Node]:
    """The nodes within an article that are a host's template and not the article's own text."""
    nodes = inside(article)
    found = {n for n in nodes if counted(n) and is_template(in_host(host, n.digest))}
    if not found:
        return found
    size: dict[Node, int] = {}
    for node in (*reversed(nodes), article):  # children before parents
        size[node] = sum(size.get(c, 0) if isinstance(c, Node) else len("".join(c.split())) for c in node.children)
    total = size[article]
    found = {n for n in found if size[n] < WHOLE * total}
    gone = {n for n in found if n.tag not in HEADINGS}
    lost, todo = 0, [article]
    while todo:
        children = [c for c in todo.pop().children if isinstance(c, Node) and c in size]
        headed = False
        for child in reversed(children):  # a heading goes with what it heads
            if headed and child in found and child.tag in HEADINGS:
                gone.add(child)
            headed = child in gone
        lost += sum(size[c] for c in children if c in gone)
        todo += [c for c in children if c not in gone]
    return gone if total - lost >= OWN * total else set()


def extract(html: str, url: str | None, is_template) -> str:
    """The main text of a page; ``is_template`` tells of a hash whether it is a host's template."""
    if not html:
        return ""
    root, host = parse(html), host_hash(url)
    article = article_of(root)
    gone = set() if article is None or host is None else repeated(article, host, is_template)
    blocks: list[str] = []
    held: list[str] = []
    linked = [0, 0]  # characters of the block, and of links in it

    def flush() -> None:
        text = " ".join("".join(held).split())
        if text and (article is not None or linked[1] * 2 <= linked[0]):
            blocks.append(text)
        held.clear()
        linked[:] = [0, 0]

    todo: list = [(article or root, False, article is not None)]
    while todo:
        node, in_link, leave = todo.pop()
        if isinstance(node, str):
            held.append(unescape(node))  # each by itself: no reference crosses a tag
            size = len(node.strip())
            linked[0] += size
            linked[1] += size if in_link else 0
            continue
        if node is None:
            flush()
            continue
        if node in gone or (node is not article and no_article(node, leave)):
            continue
        block = node.tag in BLOCK
        if article is None and block and host is not None and node.tag not in ("html", "body") and is_template(in_host(host, node.digest)):
            continue
        if node.tag == "br":
            held.append(" ")
            continue
        if block:
            flush()
            todo.append((None, False, leave))
        inner = in_link or node.tag == "a"
        todo += [(c, inner, leave) for c in reversed(node.children)]
    flush()
    return "\n\n".join(blocks)


def _templates(pages: DataFrame) -> DataFrame:
    """(hash) of the template subtrees of all hosts. ``pages``: url, html."""

    def count(batch: pa.RecordBatch) -> dict:
        out = {"host": [], "hash": [], "article": []}
        for url, html in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
            host = host_hash(url)
            if host is not None:
                around, within, article = hashes(html, url)
                out["hash"] += [0, *around, *within]  # 0 stands for the page itself
                out["article"] += [None] * (1 + len(around)) + [article] * len(within)
                out["host"] += [host - (1 << 63)] * (1 + len(around) + len(within))
        return out

    each = map_batches(pages.select("url", "html"), count, "host long, hash long, article long").groupBy("host", "hash", "article").agg(F.count(F.lit(1)).alias("n"))
    counts = each.groupBy("host", "hash").agg(F.sum(F.when(F.col("article").isNull(), F.col("n")).otherwise(1)).alias("n"))
    counts = written(counts.where(f"n >= {LEAST_PAGES}"), "subtrees")
    size = counts.where("hash = 0").select(F.col("host").alias("h"), F.col("n").alias("pages"))
    many = F.least(F.col("pages") * LEAST_SHARE, F.lit(float(MANY_PAGES)))
    return counts.where("hash <> 0").join(size, F.col("host") == F.col("h")).where(F.col("n") >= many).select("hash").distinct()


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", sent: int = SENT) -> DataFrame:
    """Per row: ``key``, ``url`` and ``text``."""
    rows = documents(pages, key, url, html).toDF("key", "url", "html")
    kind = rows.schema["key"].dataType.simpleString()
    templates = written(_templates(rows), "templates")
    if templates.count() <= sent:
        known = pages.sparkSession.sparkContext.broadcast(np.sort(templates.toPandas()["hash"].to_numpy(np.int64)))  # at most `sent` numbers

        def run(batch: pa.RecordBatch) -> dict:
            table = known.value

            def is_template(h: int) -> bool:
                at = int(np.searchsorted(table, h))
                return at < len(table) and table[at] == h

            out = [extract(h, u, is_template) for u, h in zip(batch.column(1).to_pylist(), texts_of(batch.column(2)), strict=True)]
            return {"key": batch.column(0), "url": batch.column(1), "text": out}

        found = map_batches(rows, run, f"key {kind}, url string, text string")
    else:

        def own(batch: pa.RecordBatch) -> dict:
            out = {"same": [], "hash": []}
            for same, u, h in zip(batch.column(3).to_pylist(), batch.column(1).to_pylist(), texts_of(batch.column(2)), strict=True):
                found = subtrees(h, u)
                out["hash"] += found
                out["same"] += [same] * len(found)
            return out

        # pages with the same address and markup have the same subtrees, whatever their keys
        rows = rows.withColumn("same", F.xxhash64("url", "html"))
        each = map_batches(rows, own, "same long, hash long").join(templates.withColumnRenamed("hash", "t"), F.col("hash") == F.col("t"))
        sets = each.groupBy(F.col("same").alias("k")).agg(F.collect_set("hash").alias("hashes"))  # at most a page's subtrees

        def run_own(batch: pa.RecordBatch) -> dict:
            out = []
            for u, h, hashes in zip(batch.column(1).to_pylist(), texts_of(batch.column(2)), batch.column(3).to_pylist(), strict=True):
                out.append(extract(h, u, set(hashes or ()).__contains__))
            return {"key": batch.column(0), "url": batch.column(1), "text": out}

        joined = rows.join(sets, F.col("same") == F.col("k"), "left").select("key", "url", "html", "hashes")
        found = map_batches(joined, run_own, f"key {kind}, url string, text string")
    return found.toDF(key, url, "text")


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
