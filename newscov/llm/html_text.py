"""Main text of web pages by equivalence classes of tokens across the pages of a host."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newscov.llm.common import stored, working_columns
from newscov.llm.ngram_join import WordHashes, shingles
from newscov.llm.url_filter import host_of

#: Pages of a host in which a class of tokens must occur to be part of its template, and tokens of a class.
LEAST_PAGES = 3
LEAST_TOKENS = 2
#: Share of a host's free text that the element taken for the article holds, where none says that it is one.
MAIN_SHARE = 0.6
#: Runs of words by which the article of a page is compared with others of its host.
SAMPLE = 16
#: Kinds of tokens: elements, texts of blocks, runs of words.
ELEMENT, TEXT, RUN = range(3)

# --- fixed values: elements and names as HTML uses them ---------------------------
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|textarea|title|noscript|iframe|xmp|noembed|noframes|template|svg|select|button"
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
#: Blocks that hold a run of text rather than other blocks.
LEAVES = frozenset("address caption dd dt figcaption h1 h2 h3 h4 h5 h6 legend li option p pre summary".split())
CHROME = frozenset("aside dialog footer form head header menu nav search".split())
MAIN = frozenset("article main".split())
#: Chrome that stands around an article; other chrome may stand inside it.
FENCES = frozenset(
    "banner contentinfo footer header masthead menu nav navbar navigation search sidebar toolbar".split()
)
CHROME_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu navigation search toolbar".split())
CHROME_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices pager pagination "
    "popup promo promotion recommended related reply replies search share sharing sidebar signup skip social sponsor "
    "sponsored sponsors subscribe subscription toolbar widget widgets".split()
)
# --- end of fixed values ----------------------------------------------------------

COMMENT = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)", re.DOTALL)
RAW_START = re.compile(rf"<({RAW})\b", re.IGNORECASE)
RAW_END = {name: re.compile(rf"</{name}\s*+>", re.IGNORECASE) for name in RAW.split("|")}
TAG_START = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
DELIMITER = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Block(NamedTuple):
    """A run of text between block elements: where it lies and whether that is chrome, main, the container or an h1."""

    text: str
    path: int
    chrome: bool
    main: bool
    contained: bool
    title: bool


def _tag_ends(source: str) -> tuple[list[int], list[int]]:
    """Places of all ``>`` and quotes, and where a tag ends whose attributes go on from each: the next ``>`` that no
    quotes enclose, or -1.

    Worked out once from the end of the page, so that tags that never close cost no more than others.
    """
    places = [m.start() for m in DELIMITER.finditer(source)]
    ends = [-1] * (len(places) + 1)
    after = {"'": -1, '"': -1}  # where the next quote of each kind leads to
    for k in range(len(places) - 1, -1, -1):
        mark = source[places[k]]
        if mark == ">":
            ends[k] = places[k]
        else:
            ends[k], after[mark] = after[mark], ends[k + 1]
    return places, ends


def markup(source: str) -> Iterator[tuple[int, int, str, str | None, str]]:
    """Start, end, slash, name and attributes of every tag; comments, declarations and raw elements have no name.

    Linear in the page. A ``<`` that begins none of these is text.
    """
    places, ends = _tag_ends(source)
    k, i = 0, source.find("<")
    while i >= 0:
        if source.startswith(("!", "?"), i + 1):
            end = COMMENT.match(source, i).end()
            yield i, end, "", None, ""
        elif tag := TAG_START.match(source, i):
            raw = RAW_START.match(source, i)
            begin = raw.end() if raw else tag.end()
            while k < len(places) and places[k] < begin:
                k += 1
            close = ends[k]
            if close < 0:
                i = source.find("<", i + 1)
                continue
            end = close + 1
            if raw:
                last = RAW_END[raw[1].lower()].search(source, end)
                end = last.end() if last else len(source)
                yield i, end, "", None, ""
            else:
                yield i, end, tag[1], tag[2], source[begin:close]
        else:
            end = i + 1
        i = source.find("<", end)


def digest(*parts: object) -> int:
    return xxhash.xxh3_64_intdigest("\0".join(map(str, parts)).encode("utf-8", "surrogatepass")) - (1 << 63)


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(text)} if text.strip(" /") else {}


def _is_chrome(name: str, attributes: dict[str, str], in_main: bool) -> bool:
    if name in CHROME and not (name == "header" and in_main):
        return True
    if not attributes:
        return False
    if attributes.get("role", "").lower() in CHROME_ROLES or "hidden" in attributes:
        return True
    if attributes.get("aria-hidden", "").lower() == "true" or "display:none" in attributes.get("style", "").replace(" ", "").lower():
        return True
    if name in MAIN or name in ("html", "body"):  # their classes name the kind of page
        return False
    names = {n.lower() for key in ("class", "id") for n in NAME.findall(attributes.get(key, ""))}
    return not names.isdisjoint(CHROME_NAMES) and not (in_main and names & {"header"} and not names & (CHROME_NAMES - {"header"}))


def _is_fence(name: str, attributes: dict[str, str]) -> bool:
    names = {n.lower() for key in ("class", "id") for n in NAME.findall(attributes.get(key, ""))}
    return not FENCES.isdisjoint({name, attributes.get("role", "").lower(), *names})


class Page:
    """Blocks and elements of a page. Each element knows its path, as a digest, and its free text's length."""

    def __init__(self, source: str | None, container: int | None = None) -> None:
        self.blocks: list[Block] = []
        self.paths: Counter[int] = Counter()
        self.depths: dict[int, int] = {}
        self.chars: Counter[int] = Counter()
        self.unfenced: Counter[int] = Counter()  # as chars, of elements without chrome that stands around articles
        self.container = container
        # open elements: name, path, chrome, main, contained, length of free text, fence in it
        self.open: list[list] = [["", 0, False, False, False, 0, False]]
        self.names: Counter[str] = Counter()
        self.text: list[str] = []
        self.known: dict[tuple, tuple] = {}
        source, at = source or "", 0
        for start, end, slash, name, attributes in markup(source):
            if start > at:
                self.text.append(source[at:start])
            at = end
            if name:
                self._end(name.lower()) if slash else self._start(name.lower(), attributes)
        if at < len(source):
            self.text.append(source[at:])
        while len(self.open) > 1:
            self._pop()
        self._flush()

    def _flush(self) -> None:
        if self.text:
            text = " ".join(html.unescape("".join(self.text)).split())
            self.text = []
            if text:
                _, path, chrome, main, contained, _, _ = self.open[-1]
                self.blocks.append(Block(text, path, chrome, main, contained, self.names["h1"] > 0))
                if not chrome:
                    self.open[-1][5] += len(text)

    def _start(self, name: str, attributes: str) -> None:
        if name == "br":
            self.text.append(" ")
        if name in BLOCKS:
            if self.names["p"] and name not in ("html", "body"):  # a paragraph ends where a block begins
                self._end("p")
            if name == "li" and self.names["li"]:
                self._close_item()
            self._flush()
        if name not in BLOCKS or name in VOID:
            return
        parent = self.open[-1]
        found = self.known.get((parent[1], parent[3], name, attributes))
        if found is None:
            given = _attributes(attributes)
            label = f"{name}.{'.'.join(sorted(given.get('class', '').split()))}#{given.get('id', '') if not given.get('id', '').isdigit() else ''}"
            main = name in MAIN or given.get("role", "").lower() == "main" or given.get("itemprop", "").lower() == "articlebody"
            chrome = _is_chrome(name, given, parent[3])
            found = digest(parent[1], label), chrome, main, chrome and _is_fence(name, given)
            self.known[parent[1], parent[3], name, attributes] = found
        path, chrome, main, fence = found
        self.paths[path] += 1
        self.depths[path] = len(self.open)
        self.names[name] += 1
        self.open.append([name, path, parent[2] or chrome, parent[3] or main, parent[4] or path == self.container, 0, fence])

    def _close_item(self) -> None:
        """A list item ends where the next of the same list begins."""
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i][0] in ("ul", "ol", "menu", "dir"):
                return
            if self.open[i][0] == "li":
                self._end("li")
                return

    def _pop(self) -> None:
        self._flush()
        name, path, _, _, _, chars, fence = self.open.pop()
        self.names[name] -= 1
        if name not in LEAVES:  # only these can be the container of an article
            self.chars[path] += chars
            if not fence:
                self.unfenced[path] += chars
        self.open[-1][5] += chars
        self.open[-1][6] |= fence

    def _end(self, name: str) -> None:
        if name not in BLOCKS:
            return
        if not self.names[name]:
            self._flush()
            return
        while self.open[-1][0] != name:
            self._pop()
        self._pop()


def main_blocks(source: str | None, container: int | None, constants: frozenset[int]) -> list[str]:
    """The blocks that fill the template's main slots, in page order."""
    page = Page(source, container)
    free = [b for b in page.blocks if not b.chrome and digest(b.path, b.text) not in constants]
    chosen = [b for b in free if b.main]
    if not chosen and any(b.contained for b in free):
        chosen = [b for b in free if b.contained or b.title]
    return [b.text for b in chosen or free]


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of a page with their number: paths of elements, paths with a whole block's text, runs of words.

    ``page`` is a digest of the text that may be the article and ``copy`` one of the whole source.
    """
    kinds = (
        pa.string(), pa.int64(), pa.int64(), pa.int8(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(),
    )
    names = ["host", "page", "copy", "kind", "token", "of", "n", "depth", "chars", "unfenced", "main"]
    hashes = WordHashes()
    for batch in batches:
        rows: list[tuple] = []
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html")):
            page = Page(source.as_py())
            free = [b for b in page.blocks if not b.chrome]
            own = [b.text for b in free if b.main]
            marked = any(b.main for b in page.blocks)
            key = (host, digest(*(own or [b.text for b in free])), digest(source.as_py() or ""))
            rows += [
                (*key, ELEMENT, t, None, n, page.depths[t], *((0, 0) if marked else (page.chars[t], page.unfenced[t])), marked)
                for t, n in page.paths.items()
            ]
            texts = Counter((digest(b.path, b.text), b.path) for b in free)
            rows += [(*key, TEXT, t, of, n, None, 0, 0, marked) for (t, of), n in texts.items()]
            runs = shingles(" ".join(own), hashes)[:SAMPLE].view("int64").tolist()
            rows += [(*key, RUN, t, None, 1, None, 0, 0, marked) for t in runs]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def deduce_templates(pages: DataFrame, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``(host, container, constants)`` from ``pages(host, html)``.

    Tokens of a host with the same occurrence vector (their number in each page) form an
    equivalence class. The vector is kept as a digest to which each page adds, so a host of any
    size is summed up piece by piece. Classes that occur in enough pages and have enough tokens
    are valid; they nest as the paths of their elements do. A text that is in the class of the
    element it stands in is the same wherever that element occurs: template, not content. All
    other text fills slots. On pages where no element says that it is the article, the outermost one
    that holds most of such pages' free text and no chrome of the kind that stands around articles
    is the container of the main slots; if every one holds such chrome, the innermost one. Titles
    (h1) outside the container belong to it.

    Pages are counted by their articles, lest copies make an article a template: pages with the
    same text in their declared main elements, or else outside chrome, are one page, the copy with
    the smallest digest. A page whose declared main text is for the most part on ``c`` pages counts
    ``1 / c``, so that near copies of one article add up to about one page. The smallest hashes of
    its runs of words stand for the text.
    """
    tokens = pages.where("host IS NOT NULL").select("host", "html").mapInArrow(
        _tokens,
        "host STRING, page LONG, copy LONG, kind BYTE, token LONG, of LONG, n INT, depth INT, chars LONG, unfenced LONG, "
        "main BOOLEAN",
    )
    tokens = stored(tokens, "page-all-tokens")
    runs = tokens.where(F.col("kind") == RUN).select("host", "page", "token").distinct()
    often = runs.groupBy("host", "token").agg(F.count("*").alias("pages")).where("pages > 1")
    near = runs.join(often, ["host", "token"], "left").groupBy("host", "page")
    near = near.agg(F.median(F.coalesce("pages", F.lit(1))).alias("alike")).where("alike > 1")
    copies = tokens.groupBy("host", "page").agg(F.min("copy").alias("first"), F.max("copy").alias("last"))
    # as small as copies are few
    copies = stored(copies.where("first < last").join(near, ["host", "page"], "full").drop("last"), "page-copies")
    once = tokens.where(F.col("kind") != RUN).join(copies, ["host", "page"], "left").where("first IS NULL OR copy = first")
    once = once.dropDuplicates(["host", "page", "kind", "token"])  # pages with equal source
    counted = once.groupBy("host", "token", "of").agg(
        F.bit_xor(F.xxhash64("page", "n")).alias("vector"), F.sum(F.coalesce(1 / F.col("alike"), F.lit(1.0))).alias("pages"),
        F.max("depth").alias("depth"), F.sum("chars").alias("chars"), F.sum("unfenced").alias("unfenced"),
    )
    enough = F.col("pages") > least_pages - 0.01  # a sum of parts
    counted = stored(counted.where(enough | F.col("of").isNull()), "page-tokens")

    elements = counted.where("of IS NULL")
    classes = counted.where(enough).groupBy("host", "vector").agg(F.count("*").alias("tokens"))
    valid = classes.where(F.col("tokens") >= LEAST_TOKENS).select("host", "vector")
    owners = elements.select("host", F.col("token").alias("of"), "vector").join(valid, ["host", "vector"], "left_semi")
    constants = counted.where("of IS NOT NULL").join(owners, ["host", "of", "vector"], "left_semi")
    constants = constants.groupBy("host").agg(F.collect_set("token").alias("constants"))

    sized = elements.join(elements.groupBy("host").agg(F.max("chars").alias("all")), "host").where("all > 0")
    inner = sized.where(F.col("chars") >= MAIN_SHARE * F.col("all"))
    outer = F.when(F.col("unfenced") >= MAIN_SHARE * F.col("all"), F.struct("depth", -F.col("chars"), "token"))
    containers = inner.groupBy("host").agg(
        F.coalesce(F.min_by("token", outer), F.max_by("token", F.struct("depth", "chars", "token"))).alias("container")
    )
    return containers.join(constants, "host", "full")


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for source, container, constants in zip(
            batch.column("html"), batch.column("container").to_pylist(), batch.column("constants").to_pylist()
        ):
            texts.append("\n\n".join(main_blocks(source.as_py(), container, frozenset(constants or ()))))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            ["id", "url", "text", "n_chars"],
        )


def main_text(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html") -> DataFrame:
    """``(id, url, text, n_chars)`` of every page: the blocks of its article joined by empty lines.

    Null sources and pages without main text give an empty text. Pages without a host have no
    template and are judged by their own elements, as are hosts with fewer than ``LEAST_PAGES``
    different articles. Repeated rows return as often as they come; an empty table gives an empty
    result; other columns are not read. Templates are joined by host; how depends on their size.
    """
    rows = working_columns(pages, id=id_column, url=url_column, html=html_column)
    rows = rows.withColumn("id", F.col("id").cast("long")).withColumn("html", F.coalesce("html", F.lit("")))
    host = host_of(F.col("url"))
    rows = rows.withColumn("host", F.when(host != "", host))
    templates = stored(deduce_templates(rows.select("host", "html")), "page-templates")
    joined = rows.join(templates, "host", "left").select("id", "url", "html", "container", "constants")
    found = joined.mapInArrow(_extracted, "id LONG, url STRING, text STRING, n_chars LONG")
    return found.withColumnRenamed("id", id_column).withColumnRenamed("url", url_column)
