"""HTML extraction: main text after site template removal.

Pages are parsed into light element trees in two passes.  The first hashes the
subtrees of all containers, menus and footers included, and Spark counts, per
host and per section of a host, on how many distinct pages each hash stands.
A subtree has a hash of all that it says; one that is mostly links has a hash of
its shape, too, as a menu says something else on every page and looks the same.
The second pass deletes subtrees that recur across many pages of their host or
section, and takes the text of the article; names of furniture come last, for
what no other page tells.  Pages with equal html count once, so copies of an
article do not make it a template.  Counting is split by (host, section, hash)
and combined map-side; a page's list of templates is bounded by the shares it
asks for.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.llm.rows import row_function
from candlewick.llm.url_filter import host_of, path_of
from candlewick.session import written

MIN_PAGES = 5  # distinct pages of a host or section that must share a template subtree
MIN_SHARE = 0.2  # and the share of the distinct pages of that host or section

# Elements of HTML by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset(
    "head script style noscript template iframe object embed svg math canvas audio video map "
    "nav aside footer form button input select option textarea label fieldset menu dialog".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small "
    "span strike strong sub sup time tt u var wbr img".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SAME_LEVEL = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
              "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
SCOPE = frozenset("article main section div td th table ul ol dl body blockquote aside nav".split())
TEMPLATE = frozenset(
    "div section aside nav header footer ul ol dl table form details figure center".split())
# Words of a class, id or role that name page furniture.
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe "
    "subscription signup login sidebar sidenav menu nav navbar navigation breadcrumb breadcrumbs "
    "pagination pager footer masthead comment comments disqus reply replies respond share sharing "
    "social related recommended search toolbar widget contentinfo complementary skip".split())
COMMENTS = frozenset(["comment", "comments", "disqus"])
ADVERTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion".split())
# Words that beside those make a class of page furniture inside an article too.
NEUTRAL = frozenset(
    "area block bottom box button buttons container content form inner item items left link links "
    "list outer post posts reader readers right section slot thread top unit user users wrap wrapper".split())
NAMED = frozenset("h1 h2 h3 h4 h5 h6 p".split())  # their ids are made from their text

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"<]*\"|'[^'<]*')*+[^>]*+)(?:>|\Z)", re.S)
_ATTR = re.compile(r"([^\s/=>]+)(?:\s*=\s*(\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>]+))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_UNSEEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\b", re.I)


class Node:
    """An element; ``h1`` and ``core`` tell what it holds (see ``_CORE``),
    ``size`` how many characters of text outside elements of ``DROPPED``,
    ``all`` and ``links`` how many in all and in links."""

    __slots__ = ("tag", "attrs", "kids", "h1", "core", "size", "all", "links")

    def __init__(self, tag: str, attrs: str):
        self.tag, self.attrs, self.kids, self.h1, self.core = tag, attrs, [], False, False
        self.size = self.all = self.links = 0


def parse(html: str) -> Node:
    """A light element tree: text is kept as it stands, end tags that are
    missing or too many are forgiven, raw-text elements are not parsed."""
    root = Node("#root", "")
    stack, at, nodes = _Open(root), 0, [root]
    m = _TAG.search(html)
    while m:
        if m.start() > at:
            stack[-1].kids.append(html[at:m.start()])
        at = m.end()
        tag = m[2]
        if tag is not None:
            tag = tag.lower()
            if m[1]:
                stack.close(tag)
            else:
                if tag in CLOSES_P:
                    stack.leave(("p",))
                elif tag in SAME_LEVEL:
                    stack.leave(SAME_LEVEL[tag])
                node = Node(tag, m[3])
                stack[-1].kids.append(node)
                nodes.append(node)
                if tag in RAW:
                    end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                    node.kids.append(html[at:end.start() if end else len(html)])
                    at = end.end() if end else len(html)
                elif tag not in VOID and not (m[3].endswith("/") and tag in ("svg", "path")):
                    stack.push(node)  # a slash does not close an HTML element
        m = _TAG.search(html, at)
    if at < len(html):
        stack[-1].kids.append(html[at:])
    for node in reversed(nodes):  # elements begin before those they hold
        for k in node.kids:
            if isinstance(k, Node):
                node.h1 |= k.h1 or k.tag == "h1"
                node.core |= k.core or k.tag in _CORE
                if k.tag not in RAW:
                    node.all += k.all
                    node.links += k.all if k.tag == "a" else k.links
                if k.tag not in DROPPED:
                    node.size += k.size
            else:
                node.size += len(k.strip())
                node.all += len(k.strip())
    return root


class _Open(list):
    """The open elements, with how many there are of each tag."""

    def __init__(self, root: Node):
        super().__init__([root])
        self.tags = Counter()

    def push(self, node: Node) -> None:
        self.append(node)
        self.tags[node.tag] += 1

    def cut(self, k: int) -> None:
        self.tags.subtract(x.tag for x in self[k:])
        del self[k:]

    def leave(self, tags: tuple[str, ...]) -> None:
        """Close an open element of ``tags`` in the present scope."""
        if any(self.tags[t] for t in tags):
            for k in range(len(self) - 1, 0, -1):
                if self[k].tag in tags:
                    return self.cut(k)
                if self[k].tag in SCOPE:
                    return None
        return None

    def close(self, tag: str) -> None:
        if self.tags[tag]:
            for k in range(len(self) - 1, 0, -1):
                if self[k].tag == tag:
                    return self.cut(k)
                if tag in INLINE and self[k].tag not in INLINE:
                    return None  # an inline end tag does not close blocks
                if tag == "p" and self[k].tag in SCOPE:
                    return None
        return None


def _attributes(node: Node) -> dict[str, str]:
    """Value by name of the attributes of an element, read as whole
    name[=value] pairs; the first of a name counts."""
    found = {}
    for k, v in _ATTR.findall(node.attrs):
        found.setdefault(k.lower(), v[1:].rstrip(v[0]) if v[:1] in ("'", '"') else v)
    return found


def _traits(node: Node) -> tuple[frozenset[str], bool]:
    """(words of class, id and role; hidden)."""
    if not node.attrs:
        return frozenset(), False
    of = _attributes(node)
    words = {w.lower() for k in ("class", "id", "role") for w in _WORD.findall(of.get(k, ""))}
    unseen = "hidden" in of or of.get("aria-hidden", "").strip().lower() == "true"
    return frozenset(words), unseen or bool(_UNSEEN.search(of.get("style", "")))


_CORE = frozenset(["h1", "article", "main", "body"])


def _named(node: Node, in_article: bool) -> tuple[bool, bool]:
    """Whether class, id or role name an element page furniture, and comments.

    Classes that tell what an element has or has not (``has-sidebar``) do not
    name it.  Outside the article one word is enough, but for ids of sections,
    headings and paragraphs.  Inside, and in those ids, a name counts as a
    whole, and so does a class of such words and neutral ones
    (``related-posts``); only containers go, and paragraphs that a class names
    an advert."""
    if not node.attrs:
        return False, False
    if in_article and node.tag not in TEMPLATE and node.tag != "article":
        names = _attributes(node).get("class", "").lower().split()
        return node.tag == "p" and not ADVERTS.isdisjoint(names), False
    of, found, comments = _attributes(node), False, False
    for key in ("class", "id", "role"):
        if key == "id" and node.tag in NAMED:
            continue
        for name in of.get(key, "").split():
            words = [w.lower() for w in _WORD.findall(name)]
            if not words or words[0] in ("has", "no", "with") and len(words) > 1:
                continue
            own = [w for w in words if w in FURNITURE]
            whole = len(words) == 1 or not (key == "id" and node.tag == "section") and NEUTRAL.issuperset(
                set(words) - set(own))
            if own and (whole or not in_article and not (key == "id" and node.tag == "section")):
                found = True
                comments |= whole and not COMMENTS.isdisjoint(own)
    return found, comments


def furniture(node: Node, in_article: bool, whole: int) -> bool:
    """Whether an element is page furniture by its name or attributes.  By its
    class, id or role alone, one with most of the ``whole`` characters of the
    article or page is not, unless it is named comments."""
    if node.tag in DROPPED or _traits(node)[1]:
        return True
    if node.tag == "header":
        return not (in_article and node.h1)
    if node.tag in ("html", "body", "main"):
        return False
    found, comments = _named(node, in_article)
    return found and (comments or not node.core and 2 * node.size <= whole)


def subtree_hashes(top: Node, shape: bool = False) -> dict[int, int]:
    """Signed 64-bit hash by ``id`` of the elements of a subtree that hold
    text: of the tag, the words of its attributes, its text with white space
    as one blank and the hashes of the elements in it, from the leaves up.
    With ``shape`` a text counts by being there, not by what it says."""
    import xxhash

    order, todo, out = [], [top], {}
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [k for k in node.kids if isinstance(k, Node) and k.tag not in RAW]
    for node in reversed(order):
        parts = []
        for k in node.kids:
            if isinstance(k, str):
                k = " ".join(k.split())
                if k:
                    parts.append("\2" if shape else k)
            elif id(k) in out:
                parts.append(f"\1{out[id(k)]}")
        if parts:
            head = " ".join([node.tag, *sorted(_traits(node)[0])])
            out[id(node)] = xxhash.xxh3_64_intdigest("\0".join([head, *parts])) - (1 << 63)
    return out


def is_template(node: Node) -> bool:
    """Whether an element can be site template: a container that holds
    neither the heading nor the article."""
    return node.tag in TEMPLATE and not node.core


def is_menu(node: Node) -> bool:
    """Whether a container counts by its shape, too: most of it is links."""
    return 2 * node.links > node.all


def hashed(root: Node) -> Iterator[tuple[Node, int, int | None]]:
    """(element, hash, hash of the shape or None) of the containers of a page
    that can be site template, nested ones included; menus inside an article
    have no shape."""
    todo = [(root, False)]
    while todo:
        node, inside = todo.pop()
        if not is_template(node):
            inside |= node.tag in ("article", "main")
            todo += [(k, inside) for k in node.kids if isinstance(k, Node)]
            continue
        told, shapes, inner = subtree_hashes(node), {}, [node]
        while inner:
            x = inner.pop()
            if is_template(x) and id(x) in told:
                menu = not inside and is_menu(x)
                if menu and id(x) not in shapes:  # of the outermost, then those in it are there
                    shapes.update(subtree_hashes(x, shape=True))
                yield x, told[id(x)], shapes[id(x)] if menu else None
            inner += [k for k in x.kids if isinstance(k, Node)]


def template_hashes(html: str) -> set[int]:
    """Hashes of the subtrees of a page that can be site template."""
    return {h for _, told, shape in hashed(parse(html)) for h in (told, shape) if h is not None}


def main_text(html: str, templates=frozenset()) -> str:
    """Text of the article: blocks in page order, white space as one blank.
    Templates go first; what is left goes by what it is named."""
    root = parse(html)
    gone = {id(x) for x, told, shape in hashed(root) if told in templates or shape in templates} if templates else ()

    def bad(k: Node, inside: bool, whole: int) -> bool:
        return id(k) in gone or furniture(k, inside, whole)

    tops, todo = [], [root]
    while todo:  # the outermost articles, else the outermost main, else the page
        node = todo.pop()
        if node.tag == "article":
            tops.append(node)
        else:
            todo += [k for k in reversed(node.kids) if isinstance(k, Node) and not bad(k, False, root.size)]
    if not tops:
        todo = [root]
        while todo:
            node = todo.pop()
            if node.tag == "main" or "main" in _attributes(node).get("role", "").split():
                tops.append(node)
            else:
                todo += [k for k in reversed(node.kids) if isinstance(k, Node) and not bad(k, False, root.size)]
    inside, own, whole = bool(tops), {id(x) for x in tops}, root.size
    parts, todo = [], list(reversed(tops or [root]))
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            parts.append(x)
        elif x is None:
            parts.append("\n")
        elif id(x) in own or not bad(x, inside, whole):
            if id(x) in own:
                whole = x.size
            block = x.tag not in INLINE
            if block:
                parts.append("\n")
                todo.append(None)
            todo.extend(reversed(x.kids))
    return " ".join(entities.unescape("".join(parts)).split())


def section_of(url: Column) -> Column:
    """The first part of the path if more path or a query follows it; else
    empty, the section of the pages at the top of a host."""
    deep = F.regexp_extract(path_of(url), r"(?s)^/+([^/]+)/", 1)
    asked = F.regexp_extract(url, r"(?s)^[^/?#]*://[^/?#]*/+([^/?#]+)\?", 1)
    return F.coalesce(F.when(deep != "", deep).otherwise(asked), F.lit(""))


def site_templates(pages: DataFrame, url_col: str = "url", html_col: str = "html", *,
                   min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, section, templates): hashes of the subtrees that recur on at
    least ``min_pages`` distinct pages and ``min_share`` of those of their
    host, or of those of the section."""
    url = F.col(url_col)
    base = (pages.select(host_of(url).alias("host"), section_of(url).alias("section"),
                         F.coalesce(html_col, F.lit("")).alias("html"))
            .withColumn("page", F.xxhash64("html")))
    # "/" is no section: it stands for the whole host
    scope = F.explode(F.array(F.lit("/"), F.col("section"))).alias("scope")

    hashes = row_function(lambda: lambda t: sorted(template_hashes(t)), "array<bigint>")
    sizes = (base.select("host", "page", scope).distinct()
             .groupBy("host", "scope").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages))
    marks = (base.select("host", "section", "page", F.explode(hashes("html")).alias("hash"))
             .select("host", "page", "hash", scope).distinct()
             .groupBy("host", "scope", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages))
    lists = written(marks.join(sizes, ["host", "scope"]).where(F.col("n") >= min_share * F.col("pages"))
                    .groupBy("host", "scope").agg(F.collect_list("hash").alias("templates")), "template-lists")
    whole = lists.where("scope = '/'").select("host", F.col("templates").alias("w"))
    own = lists.where("scope <> '/'").select("host", F.col("scope").alias("section"), F.col("templates").alias("o"))
    none = F.array().cast("array<bigint>")
    return (base.select("host", "section").distinct().join(whole, "host", "left")
            .join(own, ["host", "section"], "left").where("w IS NOT NULL OR o IS NOT NULL")
            .select("host", "section", F.array_union(F.coalesce("w", none), F.coalesce("o", none)).alias("templates")))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html", *, min_pages: int = MIN_PAGES,
            min_share: float = MIN_SHARE) -> DataFrame:
    """Main text of every page.

    Returns one row per input row: ``id_col``, ``url`` and ``text``.  Null
    html counts as empty and gives an empty text; pages without a host (null
    or odd urls) share the empty host.  Repeated rows give repeated results,
    and count as one page.  Malformed html is read as far as it goes, html of
    any length whole; no pages give no rows.  Other columns are not read.
    """
    # written: small files make the join a broadcast that leaves the pages where
    # they are, large ones a join whose skewed hosts AQE splits
    found = written(site_templates(pages, url_col, html_col, min_pages=min_pages,
                                   min_share=min_share), "site-templates")
    rows = (pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                         host_of(F.col(url_col)).alias("host"), section_of(F.col(url_col)).alias("section"),
                         F.coalesce(html_col, F.lit("")).alias("html"))
            .join(found.select(F.col("host").alias("t_host"), F.col("section").alias("t_section"), "templates"),
                  (F.col("host") == F.col("t_host")) & (F.col("section") == F.col("t_section")), "left")
            .select("id", "url", "html", "templates"))

    texts = row_function(lambda: lambda r: main_text(r["html"], frozenset(r["templates"] or ())), "string")
    return rows.select(F.col("id").alias(id_col), "url", texts(F.struct("html", "templates")).alias("text"))


def op10_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).withColumn(
        "n_chars", F.char_length("text").cast("long"))
