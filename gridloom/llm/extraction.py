"""Main text of web pages by removing what a site repeats.

Every element subtree with text is hashed, inside the article the blocks that
are no headings, items or cells. Spark counts on how many pages of its host each
hash occurs; subtrees on many of them are the site's template and are deleted,
but never an article or what stands around one. What a template cannot show,
because it differs from page to page or the host has few pages, goes by element
and class name.
"""

from __future__ import annotations

import html as html_module
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import BROADCAST_BYTES, arrow_rows, texts_of
from gridloom.session import materialise

SHARE = 0.5  # of a host's pages on which a subtree is template
LEAST_PAGES = 3
MANY_PAGES = 10  # below, the pages must also differ in the longest text beside the subtree
HELD_COUNTS = 200_000  # in a task before it passes them on

# Elements and names of HTML and of common page parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre search section summary "
    "table tbody td tfoot th thead tr ul".split()
)
DROPPED = frozenset(
    "nav footer aside form head menu search dialog button select input option datalist svg canvas object "
    "applet audio video map".split()
) | RAW
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split()
)
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adbox adslot sponsor sponsored promo "
    "promotion banner cookie cookies consent gdpr notice notices notification alert sidebar aside menu nav navbar "
    "navigation breadcrumb breadcrumbs comment comments commentlist disqus reply replies respond discussion "
    "share sharing social related recommended newsletter subscribe subscription signup login popup modal overlay "
    "footer header masthead topbar toolbar pagination pager widget skip".split()
)
# In an article most of these words also name content: there a whole class or id
# must consist of them and of words for boxes. These decide as part of a name too.
CLEAR_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising adbox adslot navbar breadcrumb breadcrumbs "
    "commentlist disqus gdpr sidebar popup topbar masthead pagination pager".split()
)
BOX_WORDS = frozenset(
    "area bar block box button buttons container content count form group icon icons inner item items link links list "
    "outer panel post posts section slot tools unit wrap wrapper".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
WHOLE = frozenset("html body article main".split())  # never deleted by their name
# Blocks that can be a site's box inside an article. A heading, an item or a cell
# may be the same on many pages and still belong to what it stands in.
BOXES = frozenset(
    "address blockquote details div dl fieldset figure footer header hgroup ol p pre section table ul".split()
)
CLOSES_PARAGRAPH = BLOCKS - {"html", "body"}
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
               "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<[!?][^>]*+>?|<[/a-zA-Z][^<]*\Z",
    re.S,
)
_NAMED = re.compile(r"""(?<![\w-])(class|id)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_ROLE = re.compile(r"""\brole\s*=\s*["']?([a-z]+)""", re.I)
_HIDDEN = re.compile(r"""\s(?:hidden(?=[\s>=/]|\Z)|aria-hidden\s*=\s*["']?true)""", re.I)
_PARTS = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=[0-9])")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


def by_name(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element is no part of the article, going by its own tag."""
    if tag in DROPPED or (tag == "header" and not in_article):
        return True
    if not attributes or tag in WHOLE:
        return False
    role = _ROLE.search(attributes)
    if role and role[1].lower() in DROPPED_ROLES or _HIDDEN.search(attributes):
        return True
    if in_article and (tag in HEADINGS or tag == "header"):
        return False
    for kind, *value in _NAMED.findall(attributes):
        if in_article and kind.lower() == "id" and tag in ("p", "section"):  # made from what it says
            continue
        for token in "".join(value).split():
            words = {w for w in _PARTS.split(_CAMEL.sub("-", token).lower()) if w}
            named = words & DROPPED_NAMES
            if named and (not in_article or words & CLEAR_NAMES or words - named <= BOX_WORDS):
                return True
    return False


class _Open:
    __slots__ = ("tag", "hash", "drops", "pieces", "article", "before", "texts")

    def __init__(self, tag: str, markup: str, drops: bool, pieces: int, article: bool, before: int, texts: int):
        self.tag, self.hash, self.drops, self.pieces = tag, xxhash.xxh3_64(_bytes(markup)), drops, pieces
        self.article, self.before, self.texts = article, before, texts


def _bytes(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


class Page:
    """One walk over the markup: text pieces, block borders and subtrees.

    An element's hash is taken over its own markup and text and the hashes of
    its children, so a page takes time in proportion to its length however
    deep its elements stand in each other.
    """

    def __init__(self, source: str, template: frozenset[int] = frozenset(), *, subtrees: bool = False):
        self.source, self.template, self.want = source, template, subtrees
        self.pieces: list[str | None] = []  # None is a block border
        self.inside: list[bool] = []  # whether the piece stands in an article or main element
        self.marked = False  # whether there is any such piece, deleted ones included
        self.subtrees: dict[int, tuple[int, int]] = {}  # the pieces of each
        self.stack: list[_Open] = []
        self.standing: Counter = Counter()  # open elements by tag
        self.dropping = self.articles = self.opened = self.texts = 0
        self._walk()

    def _add(self, piece: str | None) -> None:
        if not self.dropping:
            self.pieces.append(piece)
            self.inside.append(self.articles > 0)
            self.marked |= self.articles > 0
            self.texts += piece is not None and not piece.isspace()

    def _hashed(self, text: str) -> None:
        if self.stack:
            self.stack[-1].hash.update(_bytes(text))

    def _open(self, tag: str, attributes: str, markup: str) -> None:
        if tag in CLOSES_PARAGRAPH:
            self._close_open({"p"}, {"table", "td", "article", "section", "div"})
            if tag in SAME_CLOSES:
                self._close_open(SAME_CLOSES[tag], {"ul", "ol", "dl", "table"})
            self._add(None)
        elif tag == "br":
            self._add(" ")
        if tag in VOID:
            self._hashed(markup)
            return
        article = tag in ("article", "main")
        drops = by_name(tag, attributes, self.articles > 0)
        self.stack.append(_Open(tag, markup, drops, len(self.pieces), article, self.opened, self.texts))
        self.standing[tag] += 1
        self.dropping += drops
        self.articles += article
        self.opened += article

    def _close_open(self, tags: set[str], stop: set[str]) -> None:
        if not any(self.standing[tag] for tag in tags):
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].tag in tags:
                self._pop(i)
                return
            if self.stack[i].tag in stop:
                return

    def _pop(self, to: int) -> None:
        """Close the elements from ``to`` on."""
        while len(self.stack) > to:
            node = self.stack.pop()
            self.standing[node.tag] -= 1
            digest = node.hash.intdigest()
            if self.stack:
                self.stack[-1].hash.update(node.hash.digest())
            self.dropping -= node.drops
            self.articles -= node.article
            whole = node.tag in WHOLE or self.opened != node.before  # an article or around one
            box = not self.articles or node.tag in BOXES
            if box and not whole and self.texts > node.texts and (self.want or self.template):
                digest -= (digest >> 63) << 64  # as a signed number
                if self.want:
                    self.subtrees.setdefault(digest, (node.pieces, len(self.pieces)))
                if digest in self.template:
                    del self.pieces[node.pieces:], self.inside[node.pieces:]
            if node.tag in BLOCKS:
                self._add(None)

    def _walk(self) -> None:
        source, at = self.source, 0
        while True:
            found = _MARKUP.search(source, at)
            if not found:
                break
            if found.start() > at:
                self._add(source[at:found.start()])
                self._hashed(source[at:found.start()])
            at = found.end()
            tag = found[2]
            if not tag:
                continue
            tag = tag.lower()
            if found[1]:
                for i in range(len(self.stack) - 1 if self.standing[tag] else -1, -1, -1):
                    if self.stack[i].tag == tag:
                        self._pop(i)
                        break
            elif tag in RAW:  # its content is no markup
                end = re.compile(rf"</{re.escape(tag)}\s*>|\Z", re.I).search(source, at)
                self._hashed(source[found.start():end.end()])
                at = end.end()
            else:
                self._open(tag, found[3], found[0])
        if at < len(source):
            self._add(source[at:])
            self._hashed(source[at:])
        self._pop(0)

    def beside(self) -> dict[int, int]:
        """For each subtree, a hash of the longest piece of the text not in it."""
        def longest(places):
            best, found = (0, -1), []
            for i in places:
                piece = self.pieces[i]
                if piece and (self.inside[i] or not self.marked) and len(piece) > best[0]:
                    best = len(piece), i
                found.append(best)
            return found

        n = len(self.pieces)
        before = [(0, -1), *longest(range(n))]
        after = [(0, -1), *longest(range(n - 1, -1, -1))]
        found = {subtree: max(before[a], after[n - b])[1] for subtree, (a, b) in self.subtrees.items()}
        hashes = {i: xxhash.xxh3_64_intdigest(self.pieces[i].encode("utf-8", "surrogatepass")) >> 1 if i >= 0 else 0
                  for i in set(found.values())}
        return {subtree: hashes[i] for subtree, i in found.items()}

    def text(self) -> str:
        """Blocks of the article joined by two line ends; of the whole page
        where nothing is marked as one."""
        blocks, parts = [], []
        for piece, inside in [*zip(self.pieces, self.inside), (None, True)]:
            if piece is None:
                block = " ".join(html_module.unescape("".join(parts)).split())
                if block:
                    blocks.append(block)
                parts = []
            elif inside or not self.marked:
                parts.append(piece)
        return "\n\n".join(blocks)


_COUNTS = pa.schema([("host", pa.string()), ("subtree", pa.int64()), ("n", pa.int64()),
                     ("low", pa.int64()), ("high", pa.int64()), ("least", pa.int64()), ("most", pa.int64())])
_TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _count_subtrees(batches):
    counts: dict[tuple[str, int | None], list[int]] = {}

    def rows():
        values = [list(column) for column in zip(*counts.values())] or [[]] * 5
        return arrow_rows(_COUNTS, {"host": [k[0] for k in counts], "subtree": [k[1] for k in counts],
                                    "n": values[0], "low": values[1], "high": values[2],
                                    "least": values[3], "most": values[4]})

    for batch in batches:
        for host, source in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
            page = xxhash.xxh3_64_intdigest(source.encode("utf-8", "surrogatepass")) >> 1
            beside = Page(source, subtrees=True).beside()
            for subtree, other in (None, 0), *beside.items():  # None counts the page
                known = counts.setdefault((host, subtree), [0, page, page, other, other])
                known[0] += 1
                known[1], known[2] = min(known[1], page), max(known[2], page)
                known[3], known[4] = min(known[3], other), max(known[4], other)
            if len(counts) >= HELD_COUNTS:
                yield rows()
                counts.clear()
    yield rows()


def _extract(batches):
    for batch in batches:
        ids, urls, _, templates = (c.to_pylist() for c in batch.columns)
        texts = [Page(source, frozenset(template or ())).text()
                 for source, template in zip(texts_of(batch.column(2)), templates)]
        yield arrow_rows(_TEXTS, {"page_id": ids, "url": urls, "text": texts, "n_chars": [len(t) for t in texts]})


def host_of(url):
    return F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))


def site_templates(
    pages: DataFrame, *, url: str = "url", html: str = "html", share: float = SHARE, least_pages: int = LEAST_PAGES,
    many_pages: int = MANY_PAGES,
) -> DataFrame:
    """``(host, template)``: hashes of the subtrees that recur on a host.

    A subtree is template when it stands on at least ``least_pages`` pages and
    ``share`` of the host's pages, which are not all copies of one page. On fewer
    than ``many_pages`` the longest text beside the subtree must differ as well,
    so that near copies do not make each other's text a template. An article
    and what stands around one are never template; boxes in it may be. Counts are
    added up within tasks before they are shuffled by host and subtree, so a host with a third of all pages sends
    one row per task and subtree. A host has at most its subtrees per page
    divided by ``share`` template hashes. Pages without a host have none.
    """
    counts = (
        pages.select(host_of(F.col(url)).alias("host"), F.col(html).alias("html"))
        .where("host <> ''")
        .mapInArrow(_count_subtrees,
                    "host string, subtree long, n long, low long, high long, least long, most long")
        .groupBy("host", "subtree")
        .agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
             F.min("least").alias("least"), F.max("most").alias("most"))
        .where(F.col("subtree").isNull() | (
            (F.col("n") >= least_pages) & (F.col("low") < F.col("high"))
            & ((F.col("n") >= many_pages) | (F.col("least") < F.col("most")))))
    )
    counts = materialise(counts, "subtree-counts")
    hosts = counts.where("subtree IS NULL").select("host", F.col("n").alias("pages"))
    return (
        counts.where("subtree IS NOT NULL").join(hosts, "host")
        .where(F.col("n") >= F.col("pages") * share)
        .groupBy("host").agg(F.collect_list("subtree").alias("template"))
    )


def main_texts(pages: DataFrame, *, share: float = SHARE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every page.

    The text is that of ``article`` or ``main`` elements where a page has them,
    else of its body, without template subtrees and without menus, headers,
    footers, sidebars, notices, adverts, forms, scripts, styles and comments.
    Character references are decoded, white space inside a block is one space,
    blocks are joined by two line ends. Null or empty html gives an empty text,
    as does a page that is template only. Repeated rows count as pages each;
    a null url has no template; other columns are ignored; an empty table gives
    none. Unclosed elements end with their parent, cut-off markup at the end of
    a page is no text. Long pages are taken whole, in time that grows with their
    length. Pages are not shuffled as long as the templates of all hosts, whose
    size is measured, can be broadcast; beyond that the join by host is one that
    adaptive execution splits.
    """
    templates = materialise(site_templates(pages, share=share, least_pages=least_pages), "templates")
    held = templates.agg(F.sum(F.octet_length("host") + 64 + 8 * F.size("template"))).first()[0] or 0
    if held <= BROADCAST_BYTES:
        templates = F.broadcast(templates)
    known = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html",
        host_of(F.col("url")).alias("host"),
    ).join(templates, "host", "left")
    return known.select("page_id", "url", "html", "template").mapInArrow(
        _extract, "page_id long, url string, text string, n_chars long"
    )
