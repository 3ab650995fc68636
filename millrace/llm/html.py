"""Main text of HTML pages: structure first, then site templates counted over each host.

A page becomes a list of blocks. Elements that are never main text by what they are (menus,
headers, footers, sidebars, forms, scripts, styles) or by what their class, id or role says
(adverts, notices, comments, ...) are left out, and so is all outside the article, if the page
has one. What is left can still be the site's: every element's subtree is hashed, the
hashes are counted over the pages of a host in Spark, and subtrees that recur across many
of its pages are deleted. Pages of which the same is left are copies and count as one, so
only what recurs around differing content is a template. Outside an article that means a
tenth of the host's differing pages, at least TEMPLATE_PAGES of them (of fewer than three
times as many, a third); inside an article half of them, at least INSIDE_PAGES. A host of
fewer than TEMPLATE_PAGES differing pages has no templates.

Copies are grouped by (host, digest) before subtrees are counted, and a class's by (host, class,
hash); all counts are partial sums before the shuffle, so neither a hot host nor a group of
copies is a hot task. A host's
recurring subtrees are few, since each needs its share of the host's pages; they are joined
to the pages from a written table.

Text: character references are decoded, white space inside a block becomes one space, and
blocks are joined in page order by two line breaks. Null and empty pages give an empty
text; a null url is a host of its own. Repeated rows are pages of their own. Empty tables
give no rows. Unclosed, stray and cut-off markup is read as browsers do, roughly. Other
columns are carried along; helper names start with `_html`.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from millrace.llm.joins import join_keyed
from millrace.llm.words import utf8
from millrace.session import written

#: A subtree recurs if it is on so many pages of its host at least (on a host of few differing pages, copies count),
TEMPLATE_PAGES = 5
#: and on this share of its differing pages: outside an article, and inside one.
OUTSIDE_SHARE, INSIDE_SHARE, INSIDE_PAGES = 0.1, 0.5, 20

#: Characters of the blocks by which pages are near copies.
LONG = 200

# Elements of HTML by their role here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody tfoot thead tr ul".split()
)
SPACED = frozenset("br td th img".split())
DROPPED = frozenset(
    "head title script style noscript template svg math canvas iframe object embed audio video map nav menu aside "
    "footer form button input select textarea label fieldset dialog search noembed noframes xmp".split()
)
ARTICLE = frozenset("article main".split())
# An opening tag that ends an open element of the same or a like kind.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "thead": ("thead", "tbody", "tfoot", "tr", "td", "th"), "tbody": ("thead", "tbody", "tfoot", "tr", "td", "th"),
    "tfoot": ("thead", "tbody", "tfoot", "tr", "td", "th"), "option": ("option",), "optgroup": ("option", "optgroup"),
}
SCOPES = frozenset("ul ol dl table body html article main section div aside nav select".split())
# Words of a class, id or role that name what is not main text, alone or in a
# compound of words of these lists; those that may also name a part of an article, if another
# word says so; those that name comments and adverts that are articles by their element; and
# those that only say where something is or what it looks like. Any other word in a compound
# means that the name is the page's own.
NAMED = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense adbox adslot sponsor sponsored promo promotion "
    "promoted nav navbar navigation menu submenu breadcrumb breadcrumbs masthead footer sidebar aside widget widgets "
    "cookie cookies consent gdpr popup modal overlay subscribe subscription newsletter signup login share sharing social "
    "comment comments commentlist respond disqus reply replies related recommended pagination pager toolbar complementary contentinfo".split()
)
NAMED_UNLESS = frozenset("header banner notice notices notification alert discussion skip search form".split())
CONTENT = frozenset("article articles post posts entry entries content story stories text title titles body main".split())
NAMED_ARTICLE = frozenset("comment comments reply ad ads advert promo promoted sponsored related teaser".split())
PLACED = frozenset(
    "site page web global top bottom left right middle center upper lower inner outer first last primary secondary tertiary "
    "sub mini small big large mobile desktop sticky fixed floating box bar block area section row col column panel pane list item items link links button "
    "buttons icon icons image img wrapper wrap container holder group inline slot unit zone space region element component module "
    "tag label heading head foot count counter author avatar meta toggle tabs tab drawer dropdown dialog close open active js".split()
)
LAYOUT = ("has-", "has_", "with-", "no-", "is-", "layout-")
#: What elements deeper than this hold is read as part of the one around them; what is dropped is dropped at any depth.
DEPTH = 256

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)",
    re.S,
)
_NAMES = re.compile(r"""(?:^|[\s"'])(class|id|role|aria-hidden|hidden)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_PART = re.compile(r"[A-Za-z][a-z]*|[A-Z]+(?![a-z])")


@dataclass
class Element:
    tag: str
    dropped: bool
    parts: list = field(default_factory=list)  # blocks (str) and elements, in page order


def _named(tag: str, attributes: str) -> bool:
    """Whether class, id, role or a hidden attribute say that an element is not main text."""
    for match in _NAMES.finditer(attributes):
        name, value = match[1].lower(), (match[2] or "").strip("\"'").lower()
        if name in ("hidden", "aria-hidden"):
            if value == "true" or name == "hidden" and value != "until-found":
                return True
            continue
        for token in (match[2] or "").strip("\"'").split():
            parts = {part.lower() for part in _PART.findall(token)}
            if tag in ARTICLE:
                if parts & NAMED_ARTICLE:
                    return True
            elif not token.lower().startswith(LAYOUT) and parts <= NAMED | NAMED_UNLESS | CONTENT | PLACED:
                if parts & NAMED or parts & NAMED_UNLESS and not parts & CONTENT:
                    return True
    return False


def parse(page: str) -> Element:
    """The page's elements that hold blocks, each block's text decoded and trimmed."""
    root = Element("", False)
    open_: list[Element] = [root]
    tags = Counter()  # of open elements
    text: list[str] = []
    deep: dict[tuple[str, bool], Element] = {}  # one element for all alike, of the last parts they share

    def flush() -> None:
        if text:
            joined = " ".join(references.unescape("".join(text)).split())
            text.clear()
            if joined:  # nothing is gathered in what is dropped, so it is of what is around that
                next(e for e in reversed(open_) if not e.dropped).parts.append(joined)

    def close(depth: int) -> None:
        if any(e.tag in BLOCK for e in open_[depth:]):
            flush()
        tags.subtract(e.tag for e in open_[depth:])
        del open_[depth:]

    at = 0
    while at < len(page):
        start = page.find("<", at)
        if start < 0:
            start = len(page)
        if start > at and not open_[-1].dropped:
            text.append(page[at:start])
        if start == len(page):
            break
        match = _TOKEN.match(page, start)
        if not match:
            if not open_[-1].dropped:
                text.append("<")
            at = start + 1
            continue
        at = match.end()
        tag = (match[2] or match[5] or "").lower()
        if not tag:
            continue
        closing, attributes = match[1] or match[4], match[3] or match[6] or ""
        if not closing and tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I).search(page, at)
            stop = page.find(">", end.end()) if end else -1
            at = stop + 1 if stop >= 0 else len(page)
            continue
        tracked = tag in BLOCK or tag in DROPPED
        if closing:
            if tag == "p" and not tags["p"]:
                flush()
            elif tracked and tags[tag]:
                for depth in range(len(open_) - 1, 0, -1):
                    if open_[depth].tag == tag:
                        close(depth)
                        break
                    if open_[depth].tag in ("table", "article", "main", "nav", "footer", "header", "aside") and tag in ("p", "li", "span"):
                        break
            elif open_[-1].tag == f"~{tag}":
                close(len(open_) - 1)
            elif tag in SPACED and not open_[-1].dropped:
                text.append(" ")
            continue
        if tag in SPACED and not open_[-1].dropped:
            text.append(" ")
        named = bool(attributes) and tag not in ("html", "body") and _named(tag, attributes)
        named = named or open_[-1].tag == f"~{tag}"
        if tag in VOID or not (tracked or named):
            if tag == "hr":
                flush()
            continue
        if tag in BLOCK:
            flush()
            if open_[-1].tag == "p":
                close(len(open_) - 1)
            for other in CLOSES.get(tag, ()):
                if not tags[other]:
                    continue
                for depth in range(len(open_) - 1, 0, -1):
                    if open_[depth].tag == other:
                        close(depth)
                        break
                    if open_[depth].tag in SCOPES:
                        break
        inside = any(tags[t] for t in ARTICLE)
        header = tag == "header" and not inside
        around, own = open_[-1], tag if tracked else f"~{tag}"
        dropped = around.dropped or tag in DROPPED or named or header
        if len(open_) > DEPTH:
            element = deep.get((own, dropped))
            if element is None or element.parts is not around.parts:
                element = deep[own, dropped] = Element(own, dropped, around.parts)
        else:
            element = Element(own, dropped)
            if not dropped:
                around.parts.append(element)
        open_.append(element)
        tags[own] += 1
    flush()
    return root


def _articles(root: Element) -> list[Element]:
    """The outermost articles; a `main` counts where there is no article."""
    found: dict[str, list[Element]] = {"article": [], "main": []}

    def walk(element: Element) -> None:
        for part in element.parts:
            if isinstance(part, Element):
                if part.tag in found:
                    found[part.tag].append(part)
                if part.tag != "article":
                    walk(part)

    walk(root)
    return [a for a in found["article"] if _has_text(a)] or [m for m in found["main"] if _has_text(m)][:1]


def _has_text(element: Element) -> bool:
    return any(isinstance(p, str) or _has_text(p) for p in element.parts)


def _hashed(element: Element, inside: bool, out: list[tuple[int, Element, bool]]) -> bytes:
    """Digest of a subtree, from its tag, its blocks and its children's digests; `out` gets all with text."""
    import xxhash

    digest = xxhash.xxh3_64(f"<{element.tag}>".encode())
    text = False
    for part in element.parts:
        if isinstance(part, str):
            digest.update(b"\x01" + part.encode("utf-8", "surrogatepass"))
            text = True
        else:
            below = _hashed(part, inside, out)
            digest.update(b"\x02" + below)
            text = text or bool(below)
    if not text:
        return b""
    value = digest.digest()
    out.append((int.from_bytes(value, "big", signed=True), element, inside))
    return value


def _blocks(element: Element) -> Iterator[str]:
    for part in element.parts:
        if isinstance(part, str):
            yield part
        else:
            yield from _blocks(part)


def _size(element: Element) -> int:
    return sum(map(len, _blocks(element)))


def _trees(page: str) -> tuple[list[Element], list[tuple[int, Element, bool]], bool, bytes]:
    """What structure leaves of a page, its subtrees, whether it is of articles, and a digest of it all."""
    import xxhash

    root = parse(page)
    articles = _articles(root)
    found: list[tuple[int, Element, bool]] = []
    digest = xxhash.xxh3_128()
    for top in articles or [root]:
        for part in top.parts:
            if isinstance(part, Element):
                digest.update(b"\x02" + _hashed(part, bool(articles), found))
            else:
                digest.update(b"\x01" + part.encode("utf-8", "surrogatepass"))
        digest.update(b"\x03")
    return articles or [root], found, bool(articles), digest.digest()


def _alike(tops: list[Element], digest: bytes) -> bytes:
    """The same for near copies: a digest of the longest blocks that are most of the text, if they are long."""
    import xxhash

    blocks = [b for top in tops for b in _blocks(top)]
    most, taken = sum(map(len, blocks)) / 2, 0
    out = xxhash.xxh3_128()
    for block in sorted(blocks, key=lambda b: (-len(b), b)):
        out.update(block.encode("utf-8", "surrogatepass") + b"\x01")
        taken += len(block)
        if taken > most:
            break
    return out.digest() if taken >= LONG else digest


def subtrees(page: str) -> set[tuple[int, bool]]:
    """(hash, inside an article) of every subtree that main text may hold."""
    return {(value, inside) for value, _, inside in _trees(page)[1]}


def main_text(page: str, template: set[int]) -> str:
    """The blocks of the article, or of the page if it has none, without the template's subtrees."""
    tops, found, _, _ = _trees(page)
    whole = sum(map(_size, tops)) if template else 0
    gone = {id(element) for value, element, inside in found if value in template and not (inside and 2 * _size(element) > whole)} if template else set()
    blocks: list[str] = []

    def walk(element: Element) -> None:
        for part in element.parts:
            if isinstance(part, str):
                blocks.append(part)
            elif id(part) not in gone:
                walk(part)

    for top in tops:
        walk(top)
    return "\n\n".join(blocks)


def templates(pages: DataFrame) -> DataFrame:
    """(_html_host, _html_template): per host the hashes of subtrees that recur across its pages."""
    fields = pages.select("_html_host").schema.fields
    schema = StructType(fields).add("inside", "boolean").add("digest", "binary").add("alike", "binary").add("hashes", ArrayType(LongType()))

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside, digests, alike, hashes = [], [], [], []
            for page in utf8(batch.column(1)):
                tops, subtrees_, within, digest = _trees(page.decode())
                inside.append(within), digests.append(digest), alike.append(_alike(tops, digest))
                hashes.append(sorted({value for value, _, _ in subtrees_}))
            columns = [batch.column(0), pa.array(inside, pa.bool_()), *(pa.array(x, pa.binary()) for x in (digests, alike)), pa.array(hashes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    differing = pages.select("_html_host", "_html").mapInArrow(found, schema).groupBy("_html_host", "inside", "digest")
    differing = written(differing.agg(F.count("*").alias("copies"), F.first("alike").alias("alike"), F.first("hashes").alias("hashes")), "html_pages")
    classes = differing.select("_html_host", "inside", "alike").distinct()
    hosts = written(classes.groupBy("_html_host").agg(F.count("*").alias("pages")), "html_hosts")
    counted = differing.select("_html_host", "inside", "alike", "copies", F.explode("hashes").alias("hash"))
    counted = counted.groupBy("_html_host", "hash", "inside", "alike").agg(F.sum("copies").alias("copies"))
    counted = counted.groupBy("_html_host", "hash", "inside").agg(F.count("*").alias("around"), F.sum("copies").alias("rows"))
    counted = written(counted.where((F.col("around") > 1) & (F.col("rows") >= TEMPLATE_PAGES)), "html_subtrees")
    few = F.least(F.lit(TEMPLATE_PAGES), F.col("pages") / 3)
    least = F.when(F.col("inside"), F.greatest(F.lit(INSIDE_PAGES), INSIDE_SHARE * F.col("pages"))).otherwise(F.greatest(few, OUTSIDE_SHARE * F.col("pages")))
    recurring = join_keyed(counted, hosts.where(F.col("pages") >= TEMPLATE_PAGES), ["_html_host"], "inner").where(F.col("around") >= least)
    return written(recurring.groupBy("_html_host").agg(F.collect_set("hash").alias("_html_template")), "html_templates")


def extract(pages: DataFrame, html: str = "html", url: str = "url", keep: list[str] | None = None) -> DataFrame:
    """`pages` (or only its columns `keep`) with `text` and `n_chars`, its code points.

    Columns of those names are replaced.
    """
    kept = [c for c in (pages.columns if keep is None else keep) if c not in ("text", "n_chars")]
    host = F.lower(F.regexp_extract(F.col(f"`{url}`"), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    page = F.col(f"`{html}`").alias("_html")
    own = html if html in kept else "_html"  # carried once
    rows = pages.select(*[F.col(f"`{c}`") for c in kept], host.alias("_html_host"), *([] if own == html else [page]))
    recurring = templates(pages.select(host.alias("_html_host"), page))
    found = join_keyed(rows, recurring, ["_html_host"], "left").drop("_html_host")
    schema = StructType([f for f in found.schema.fields if f.name in kept]).add("text", "string").add("n_chars", "long")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            column = batch.column("_html_template")
            for row, page in enumerate(utf8(batch.column(own))):
                out.append(main_text(page.decode(), set(column[row].as_py() or ())))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(out, pa.string()), pa.array(list(map(len, out)), pa.int64())], names=schema.names
            )

    return found.mapInArrow(texts, schema)
