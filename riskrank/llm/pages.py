"""Main text of web pages: elements that recur across a site are its template, and go.

Each page is read once to hash its block elements with all that is in them. Pages of one host whose article is the same
count once; the hashes are counted per host, and those on a large share of its pages are the host's template. Then each
page is read again and loses the template's elements, along with those whose tag or class says that they are no part
of the article.
"""

from __future__ import annotations

import html as references
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskrank.llm.common import Workspace
from riskrank.llm.url_filter import host_of

# An element is template where it is on this share of the host's pages, in an article on this one; and on so many.
SHARE = 0.5
ARTICLE_SHARE = 0.8
MIN_PAGES = 10

# Elements of HTML by what they are to a reader.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p "
    "pre search section select summary svg table tbody td template tfoot th thead tr ul".split()
)
ASIDE = frozenset(
    "aside button dialog fieldset footer form head iframe input menu nav noscript object option search select svg template".split()
)
# Words of a class, id or role that name what is beside the article.
BESIDE = frozenset(
    "ad ads adbox adslot adsense advert advertisement advertising advertorial alert banner breadcrumb breadcrumbs commentlist "
    "comment comments complementary consent contentinfo cookie cookies dfp disqus footer gdpr login masthead menu menubar modal "
    "nav navbar navigation newsletter notice notification outbrain pagination pager paywall popup promo promoted promotion "
    "recommendations recommended related replies reply respond search share sharing sidebar signup skyscraper social sponsor "
    "sponsored subscribe subscription taboola toolbar topbar widget widgets".split()
)
# With these, a word speaks of a layout, as in "with-sidebar".
LAYOUT = frozenset("with has no without is layout page main content left right one two three".split())
MAIN = frozenset("html body main article".split())
# Whose start ends an open element: a paragraph, an item, a cell or a row.
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("td", "th", "tr", "thead", "tbody"), "tfoot": ("td", "th", "tr", "tbody"),
}
# An open element beyond these is not ended by them.
SCOPE = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",)}

TAG = re.compile(
    r"<(?:!--(?:>|->|.*?(?:--!?>|\Z))|[!?][^>]*(?:>|\Z)"
    r"|/([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)"
    # Quotes count where they begin a value; a value without its end is read up to the next >.
    r"""|([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*(?:"[^"]{0,65536}"|'[^']{0,65536}')|=)*+(?:>|\Z)))""",
    re.DOTALL,
)
NAMED = re.compile(r"""(?<![\w-])(class|id|role|style|hidden|itemtype|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
WORD = re.compile(r"[a-z]+")


def attributes(text: str) -> dict[str, str]:
    """Those that say what an element is; the first of a name counts."""
    found: dict[str, str] = {}
    for name, *values in NAMED.findall(text):
        found.setdefault(name.lower(), next(filter(None, values), ""))
    return found


def is_beside(name: str, named: dict[str, str], in_article: bool, by_class: bool = True) -> bool:
    """Whether tag, class, id, role or style say that an element is no part of the article."""
    if name in ASIDE or (name == "header" and not in_article):
        return True
    if not named or not by_class or name in ("html", "body"):
        return False
    if "hidden" in named or named.get("aria-hidden", "").lower() == "true" or UNSEEN.search(named.get("style", "")):
        return True
    if name in MAIN and not in_article:
        return False
    if "comment" in named.get("itemtype", "").lower():
        return True
    for value in (named.get("class", ""), named.get("id", ""), named.get("role", "")):
        for word in value.split():
            words = WORD.findall(word.lower())
            if not BESIDE.isdisjoint(words) and LAYOUT.isdisjoint(words):
                return True
    return False


class Page:
    """Blocks of text of a page, and its elements with the blocks they hold.

    ``blocks`` has the texts in page order, white space as one space, empty ones left out. ``zones`` has (first block, end)
    of the articles, and of main elements. ``beside`` and ``elements`` have (first block, end) of what is no part of the
    article by its mark, and (hash, first block, end, whether in an article) of block elements that hold text.
    """

    def __init__(self, html: str, with_hashes: bool = True, by_class: bool = True):
        self.blocks: list[str] = []
        self.articles: list[tuple[int, int]] = []
        self.mains: list[tuple[int, int]] = []
        self.beside: list[tuple[int, int]] = []
        self.elements: list[tuple[int, int, int, bool]] = []
        self.with_hashes, self.by_class = with_hashes, by_class
        self.buffer: list[str] = []
        # Open elements: name, first block, zone or mark, parts to be hashed.
        self.open: list[list] = []
        self.outside = 0  # open elements that are beside the article
        self.in_article = self.in_main = 0
        self._read(html)

    def _text(self, piece: str) -> None:
        if piece:
            self.buffer.append(references.unescape(piece))

    def _flush(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            self.buffer.clear()
            if text:
                self.blocks.append(text)
                if self.open:
                    self.open[-1][3].append(text)

    def _read(self, html: str) -> None:
        at = 0
        for found in TAG.finditer(html):
            if found.start() < at:
                continue
            self._text(html[at : found.start()])
            at = found.end()
            end, name = found.group(1), found.group(2)
            if name:
                name = name.lower()
                if name in RAW:
                    stop = re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, at)
                    at = stop.end() if stop else len(html)
                elif name == "br":
                    self.buffer.append(" ")
                elif name in BLOCKS:
                    self._flush()
                    self._start(name, found.group(3))
            elif end and end.lower() in BLOCKS:
                self._flush()
                self._end(end.lower())
        self._text(html[at:])
        self._flush()
        while self.open:
            self._close()

    def _start(self, name: str, text: str) -> None:
        if name in VOID:
            return
        while self.open and self.open[-1][0] == "p":
            self._close()
        for other in reversed(self.open) if name in ENDS else ():
            if other[0] in SCOPE.get(name, ()):
                break
            if other[0] in ENDS[name]:
                self._end(other[0])
                break
        named = attributes(text) if "=" in text or "hidden" in text else {}
        mark = ""
        nested = name == "article" and self.in_article > 0
        if not self.outside and (nested or is_beside(name, named, self.in_article > 0, self.by_class)):
            mark = "beside"
        if mark or self.outside:
            self.outside += 1
        elif name == "article":
            mark = "article"
            self.in_article += 1
        elif name == "main" or named.get("role", "").lower() == "main":
            mark = "main"
            self.in_main += 1
        self.open.append([name, len(self.blocks), mark, [f"<{name} {named.get('class', '')} {named.get('id', '')}>"]])

    def _end(self, name: str) -> None:
        """Close the innermost open element of that name and those in it; nothing if there is none."""
        if any(e[0] == name for e in self.open):
            while self._close() != name:
                pass

    def _close(self) -> str:
        name, first, mark, parts = self.open.pop()
        end = len(self.blocks)
        article = self.in_article > 0
        if self.outside:
            self.outside -= 1
        if mark == "article":
            self.in_article -= 1
        elif mark == "main":
            self.in_main -= 1
        if end > first:
            if mark:
                {"beside": self.beside, "article": self.articles, "main": self.mains}[mark].append((first, end))
            if self.with_hashes:
                # What is inside an element beside the article goes with it and needs no hash of its own.
                digest = xxhash.xxh64_intdigest("\0".join(parts).encode("utf-8", "replace"))
                if not self.outside and name not in MAIN:
                    self.elements.append((digest - (1 << 63), first, end, article))
                if self.open:
                    self.open[-1][3].append(f"{digest:x}")
        return name

    def kept(self, template=frozenset(), in_articles=frozenset()) -> list[str]:
        """The blocks of the article: without what is beside it and without the template's elements."""
        gone = bytearray(len(self.blocks))
        for digest, first, end, article in self.elements:
            if digest in (in_articles if article else template):
                gone[first:end] = b"\1" * (end - first)
        for first, end in self.beside:
            gone[first:end] = b"\1" * (end - first)
        for zones in (self.articles, self.mains):
            inside = [i for first, end in sorted(zones) for i in range(first, end) if not gone[i]]
            if inside:
                return [self.blocks[i] for i in dict.fromkeys(inside)]
        return [b for b, g in zip(self.blocks, gone, strict=True) if not g]


def main_text(page: Page, html: str, template=frozenset(), in_articles=frozenset()) -> str:
    """The article of a page. Where a class hides all of one, as on an element around the whole page, classes do not count."""
    kept = page.kept(template, in_articles)
    if not kept and page.blocks:
        again = Page(html, page.with_hashes, by_class=False)
        if again.articles or again.mains:
            kept = again.kept(template, in_articles)
    return "\n".join(kept)


def _hashes(pages: DataFrame) -> DataFrame:
    """(host, article, template, in_article) of every page: a hash of its text, and those of its elements."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            articles, outside, inside = [], [], []
            for text in batch.column(1):
                page = Page(text.as_py())
                main = main_text(page, text.as_py())
                articles.append(xxhash.xxh64_intdigest(main.encode("utf-8", "replace")) - (1 << 63))
                outside.append(sorted({e[0] for e in page.elements if not e[3]}))
                inside.append(sorted({e[0] for e in page.elements if e[3]}))
            numbers = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(articles, pa.int64()), pa.array(outside, numbers), pa.array(inside, numbers)],
                names=["host", "article", "outside", "inside"],
            )

    schema = "host string, article long, outside array<long>, inside array<long>"
    return pages.where("host <> ''").select("host", "html").mapInArrow(run, schema)


def templates(
    pages: DataFrame, ws: Workspace, *, share: float = SHARE, article_share: float = ARTICLE_SHARE, min_pages: int = MIN_PAGES
) -> DataFrame:
    """(host, template, in_article): hashes of the elements that recur across each host's pages (host, html).

    Pages of a host with equal articles count once, so copies of a page are no template. An element counts once a page.
    Counts are summed up before they are shuffled by host and hash, so a host with very many pages is no burden.
    A host's template has at most 1 / ``share`` times as many elements as its pages have on average.
    """
    different = ws.keep(
        _hashes(pages).groupBy("host", "article").agg(F.first("outside").alias("outside"), F.first("inside").alias("inside")),
        "elements",
    )
    sizes = different.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= min_pages)

    def marked(column: str, zone: bool) -> Column:
        return F.transform(column, lambda h: F.struct(h.alias("hash"), F.lit(zone).alias("article_zone")))

    counted = (
        different.select("host", F.explode(F.concat(marked("outside", False), marked("inside", True))).alias("e"))
        .groupBy("host", "e.hash", "e.article_zone")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= min_pages)
    )
    needed = F.when(F.col("article_zone"), article_share).otherwise(share)
    recurring = counted.join(sizes, "host").where(F.col("n") >= needed * F.col("pages"))
    zone = F.col("article_zone")
    return recurring.groupBy("host").agg(
        F.collect_list(F.when(~zone, F.col("hash"))).alias("template"), F.collect_list(F.when(zone, F.col("hash"))).alias("in_article")
    )


def extract(
    pages: DataFrame,
    ws: Workspace,
    *,
    id: str = "page_id",
    url: str = "url",
    html: str = "html",
    share: float = SHARE,
    article_share: float = ARTICLE_SHARE,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """Per row: page_id, url, text and n_chars (code points).

    The text is that of the page's articles, without them of its main element, without that of the whole body; in each case
    without elements of the host's template, and without menus, headers, footers, sidebars, notices, adverts, forms,
    scripts, styles and reader comments as tags, classes, ids and roles tell them. Character references are decoded;
    white space in a block is one space, ends are trimmed, and blocks are joined by a line end. A page that
    is damaged or cut short is read as far as it goes.

    A null html counts as empty and gives an empty text; pages without a host (a null url too) have no
    template. Repeated rows are returned each; an empty table gives no rows; other columns are ignored.
    """
    rows = pages.select(
        F.col(id).alias("page_id"), F.col(url).alias("url"), host_of(F.col(url)).alias("host"), F.coalesce(html, F.lit("")).alias("html")
    )
    found = ws.keep(templates(rows, ws, share=share, article_share=article_share, min_pages=min_pages), "templates")
    joined = rows.join(found, "host", "left").select("page_id", "url", "host", "template", "in_article", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, tuple[frozenset, frozenset]] = {}
            texts = []
            for i, (host, text) in enumerate(zip(batch.column(2).to_pylist(), batch.column(5), strict=True)):
                if host not in known:
                    known[host] = tuple(frozenset(batch.column(c)[i].as_py() or ()) for c in (3, 4))
                template, in_article = known[host]
                page = Page(text.as_py(), with_hashes=bool(template or in_article))
                texts.append(main_text(page, text.as_py(), template, in_article))
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text"])

    types = {f.name: f.dataType.simpleString() for f in joined.schema}
    read = joined.mapInArrow(run, f"page_id {types['page_id']}, url string, text string")
    return read.withColumn("n_chars", F.char_length("text").cast("long"))
