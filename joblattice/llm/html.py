"""Main text of web pages, with the templates of each site removed.

Every page is parsed to a tree of elements. A hash of each subtree, its tags, attributes, text and all
below it, is counted over the pages of a host; subtrees that many different pages of the host carry are
its template and are deleted from every page of it. What a page marks as its article is its text:
plain prose in there is never template, however often a licence line or a quotation recurs, while
elements with attributes or links of their own, such as sharing bars and teasers, can be. Elements that
by their kind, role or class hold menus, adverts, forms, comments and the like go as well, counted or not.
Pages are parsed twice, once to count and once to extract; only hashes are shuffled.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from joblattice.llm.shared import staged
from joblattice.session import broadcast_if_small, is_small

#: A subtree is template when so many different pages of its host, and this share of them, carry it.
MIN_PAGES, MIN_SHARE = 5, 0.01
#: A table of templates up to this size goes to every task; past it, pages are dealt by host in parts of about so many rows.
SMALL_ROWS, SMALL_BYTES, PART = 500_000, 32 * 1024 * 1024, 20_000

# Fixed values of HTML: elements by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea title iframe xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select"
    " summary table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "head script style noscript template textarea title iframe object embed canvas svg math audio video map nav aside footer"
    " form button select option datalist dialog menu search input xmp".split()
)
PROSE = frozenset(
    "p h1 h2 h3 h4 h5 h6 blockquote pre ul ol li dl dt dd table thead tbody tfoot tr td th caption figure figcaption b i em strong"
    " u s small big sub sup span code kbd samp var q cite abbr dfn mark time del ins tt font center br hr wbr bdi bdo ruby rt rp".split()
)
#: What an opening tag ends, each up to the nearest of the elements behind the bar.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tbody": ({"thead", "tbody", "tfoot"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "body": ({"head"}, set()),
}
#: Words of a class, id or role that mark what is no main text.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies"
    " disqus footer gdpr masthead menu menubar modal nav navbar navigation newsletter notice notices notification overlay pager"
    " pagination paywall popup promo promoted promotion related reply replies respond share sharing sidebar signup skip social"
    " sponsor sponsored sponsors subscribe subscription teaser toolbar widget widgets complementary contentinfo search".split()
)
#: Of those, what makes an article no article of the page.
ARTICLE_MARKS = frozenset("ad advert comment comments promo promoted related reply sponsored teaser".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?|</[^a-zA-Z>][^>]*>?"
    r"|<([a-zA-Z][^\s/>]*)((?>[^>\"']+|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)",
    re.S,
)
NAMED = re.compile(r"(?:^|[\s\"'])(class|id|role|hidden|itemprop)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(?=[\s/\"']|$))", re.I)
WORDS = re.compile(r"[a-z]+|[0-9]+")


class Element:
    """An element with its children, texts among them, and the hash of all it holds."""

    __slots__ = ("tag", "attributes", "children", "digest", "within", "plain", "text", "holds")

    def __init__(self, tag: str, attributes: str, within: bool):
        self.tag, self.attributes, self.within = tag, attributes, within
        self.children: list[Element | str] = []
        self.digest = 0
        self.plain = tag in PROSE and not attributes  # prose only, here and below
        self.text = False  # any that is not blank, here or below
        self.holds = tag in ("article", "main", "body", "html", "") or (bool(attributes) and _names_article(attributes))

    def close(self) -> None:
        h = xxhash.xxh64(f"{self.tag} {self.attributes}\x00".encode("utf-8", "surrogatepass"))
        for child in self.children:
            if isinstance(child, str):
                h.update(b"\x01" + child.strip().encode("utf-8", "surrogatepass"))
                self.text = self.text or not child.isspace()
            else:
                h.update(b"\x02" + child.digest.to_bytes(8, "big", signed=True))
                self.plain = self.plain and child.plain
                self.text = self.text or child.text
                self.holds = self.holds or child.holds
        if self.tag in RAW:
            self.text = False
        self.digest = int.from_bytes(h.digest(), "big", signed=True)

    def is_candidate(self) -> bool:
        """Whether it may be of the site's template: with text, no article in it and no plain prose of one."""
        return self.text and not self.holds and not (self.within and self.plain)


def parse(page: str) -> tuple[Element, list[Element]]:
    """(tree, all its elements); elements left open end with what holds them, stray end tags are passed over."""
    root = Element("", "", False)
    stack, elements, at, size = [root], [], 0, len(page)

    def leave(depth: int) -> None:
        while len(stack) > depth:
            stack.pop().close()

    while at < size:
        found = TOKEN.search(page, at)
        if found is None:
            stack[-1].children.append(page[at:])
            break
        if found.start() > at:
            stack[-1].children.append(page[at : found.start()])
        at = found.end()
        end, start = found[1], found[2]
        if end:
            end = end.lower()
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == end:
                    leave(depth)
                    break
                if stack[depth].tag in FENCES and end not in OUTER:
                    break
            continue
        if not start:
            continue
        tag, attributes = start.lower(), " ".join(found[3].rstrip("/").split())
        if tag in BLOCK:
            _end(stack, leave, {"p"}, BLOCK - {"p"})
        if tag in HEADINGS:
            _end(stack, leave, HEADINGS, BLOCK - HEADINGS)
        if tag in ENDS:
            _end(stack, leave, *ENDS[tag])
        element = Element(tag, attributes, stack[-1].within or stack[-1].tag in ("article", "main"))
        stack[-1].children.append(element)
        elements.append(element)
        if tag in VOID:
            element.close()
        elif tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            element.children.append(page[at : close.start() if close else size])
            element.close()
            at = close.end() if close else size
        else:
            stack.append(element)
    leave(0)
    return root, elements


#: An end tag does not reach out of these elements, save the end tags behind them.
FENCES, OUTER = frozenset("article main td th".split()), frozenset("html body table tr article main".split())


def _end(stack: list[Element], leave: Callable[[int], None], closed: frozenset | set, fence: frozenset | set) -> None:
    """Closes the outermost open element of ``closed`` that no element of ``fence`` stands before."""
    at = 0
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in closed:
            at = depth
        elif stack[depth].tag in fence:
            break
    if at:
        leave(at)


def _value(m: re.Match) -> str:
    return references.unescape(m[2] or m[3] or m[4] or "").lower()


def _names_article(attributes: str) -> bool:
    named = [(m[1].lower(), _value(m)) for m in NAMED.finditer(attributes)]
    return any(n in (("itemprop", "articlebody"), ("role", "main"), ("role", "article")) for n in named)


def marked(element: Element) -> bool:
    """Whether kind, role, class or id say that this is no main text."""
    if element.tag in DROPPED:
        return True
    if element.tag == "header":
        return not element.within and not element.holds
    if not element.attributes or (element.holds and element.tag != "article"):
        return False
    marks = ARTICLE_MARKS if element.tag == "article" else MARKS if element.within else MARKS | {"header"}
    for m in NAMED.finditer(element.attributes):
        name = m[1].lower()
        if name == "hidden" or (name in ("class", "id", "role") and marks.intersection(WORDS.findall(_value(m)))):
            return True
    return False


def articles(root: Element, gone: set[int]) -> list[Element]:
    """The outermost articles that stand in nothing marked or deleted; else the main element, else the page."""
    found, mains, todo = [], [], [root]
    while todo:
        element = todo.pop()
        if element.tag == "article":
            found.append(element)
            continue
        if element.tag == "main" or (element.attributes and _names_article(element.attributes)):
            mains.append(element)
        for child in reversed(element.children):
            if not isinstance(child, str) and child.digest not in gone and (child.tag == "form" or not marked(child)):
                todo.append(child)
    return found or mains[:1] or [root]


def blocks(root: Element, gone: set[int]) -> list[str]:
    """The texts of an element's blocks in page order, without what is deleted or marked."""
    out: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        text = " ".join(references.unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append(text)

    todo: list[tuple[Element | str | None, bool]] = [(root, False)]  # None ends a block; the flag: headings only
    while todo:
        item, headings = todo.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            if not headings:
                parts.append(item)
        elif item.tag in ("br", "hr"):
            parts.append(" ")
            if item.tag == "hr":
                flush()
        elif item is root or not (marked(item) or (item.digest in gone and item.is_candidate())):
            headings = (headings or (item.tag == "header" and item.within)) and item.tag not in HEADINGS
            if item.tag in BLOCK:
                flush()
                todo.append((None, False))
            todo += [(child, headings) for child in reversed(item.children)]
    flush()
    return out


def main_text(page: str | None, template: frozenset[int] | set[int] = frozenset()) -> tuple[str, int]:
    """(text, number of template subtrees deleted) of one page."""
    root, elements = parse(page or "")
    gone = {e.digest for e in elements if e.digest in template and e.is_candidate()} if template else set()
    texts = [t for a in articles(root, gone) for t in blocks(a, gone)]
    if not texts:  # an article left inside an element that was never closed
        texts = [t for e in elements if e.tag == "article" and not e.within for t in blocks(e, gone)]
    return "\n".join(texts), len(gone)


def host(url: str) -> str:
    """SQL for the lower-case host of a URL column, an empty text when it has none."""
    return rf"lower(coalesce(regexp_extract({url}, '^(?:[^:/?#]*:)?//(?:[^/?#@]*@)?([^/?#:]*)', 1), ''))"


def site_templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, n_pages, template): hashes of the subtrees that recur on a host; ``pages`` holds host and html.

    Pages that are alike count once, so a page crawled often is no template of its own. A host has at most
    1 / ``min_share`` times the subtrees of an average page. Pages without a host belong to no site.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, found = [], []
            for page in batch.column("html").to_pylist():
                root, elements = parse(page or "")
                digests.append(root.digest)
                found.append(list({e.digest for e in elements if e.is_candidate()}))
            columns = [batch.column("host"), pa.array(digests, pa.int64()), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["host", "page", "subtrees"])

    hashed = pages.where("host <> ''").select("host", "html").mapInArrow(run, "host string, page bigint, subtrees array<bigint>")
    hashed = staged(hashed.groupBy("host", "page").agg(F.first("subtrees").alias("subtrees")), "html-subtrees")
    sizes = hashed.groupBy("host").agg(F.count("*").alias("n_pages"))
    counts = hashed.select("host", F.explode("subtrees").alias("subtree")).groupBy("host", "subtree").agg(F.count("*").alias("n"))
    often = counts.where(F.col("n") >= min_pages).join(sizes, "host").where(F.col("n") >= min_share * F.col("n_pages"))
    return often.groupBy("host", "n_pages").agg(F.collect_list("subtree").alias("template"))


def extract(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    min_pages: int = MIN_PAGES,
    min_share: float = MIN_SHARE,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """id, url, text, n_chars, n_deleted: the main text of every page, blocks joined by one newline.

    White space inside a block becomes one space, references are decoded; ``n_deleted`` counts the
    template subtrees taken out. A null or empty page, or one without main text, has an empty text; a
    null or odd URL is no site, its pages lose only what marks itself. Repeated rows each give a row, an
    empty table none; other columns are not looked at.
    """
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    ).withColumn("host", F.expr(host("url")))
    spark, kind = pages.sparkSession, rows.schema["id"].dataType.simpleString()
    known = staged(site_templates(rows, min_pages, min_share), "html-templates")
    schema = f"id {kind}, url string, text string, n_deleted int"
    if is_small(known, small_rows, SMALL_BYTES):
        sites = spark.sparkContext.broadcast({r["host"]: frozenset(r["template"]) for r in known.collect()})
        out = rows.mapInArrow(lambda batches: _extracted(batches, sites.value), schema)
    else:
        out = _beside_templates(rows, known).mapInArrow(lambda batches: _extracted(batches, None), schema)
    return out.select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("bigint").alias("n_chars"), "n_deleted"
    )


def _beside_templates(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Pages joined with the template of their host; hosts of many pages are dealt to parts."""
    hot = known.where(F.col("n_pages") > PART).select("host", F.ceil(F.col("n_pages") / PART).alias("parts"))
    dealt = rows.join(broadcast_if_small(hot), "host", "left")
    part = F.pmod(F.xxhash64("id", "url", "html"), F.coalesce("parts", F.lit(1)))
    parts = F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("n_pages") / PART) - 1)
    copies = known.select("host", F.explode(parts).alias("part"), "template")
    return dealt.withColumn("part", part).join(copies, ["host", "part"], "left")


def _extracted(batches: Iterator[pa.RecordBatch], sites: dict[str, frozenset[int]] | None) -> Iterator[pa.RecordBatch]:
    nothing: frozenset[int] = frozenset()
    for batch in batches:
        if sites is None:
            templates = (frozenset(t.as_py() or ()) for t in batch.column("template"))
        else:
            templates = (sites.get(h.as_py(), nothing) for h in batch.column("host"))
        found = [main_text(page.as_py(), template) for page, template in zip(batch.column("html"), templates)]
        texts = pa.array([t.encode("utf-8", "replace").decode() for t, _ in found], pa.string())
        columns = [batch.column("id"), batch.column("url"), texts, pa.array([n for _, n in found], pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, ["id", "url", "text", "n_deleted"])
