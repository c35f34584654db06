"""Main text of web pages: removal of site templates by counts of subtrees, then structure.

The subtrees of all elements are hashed from their leaves up; Spark counts on how
many different articles of a host each occurs, and subtrees that most of the
host's articles share are deleted.  An element whose tag or class names speak
for a menu, an advert and the like has a second hash, of its tag and these words
alone: as its text may change from page to page, that hash needs a far smaller
share.  What no count and no element of fixed meaning removes is the page; where
it has an article, the article is kept.
"""

import re
from collections import Counter, namedtuple
from html import unescape
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmart.llm.common import staged, text_slices

SHARE = 0.5  # of a host's different articles; a subtree on more of them belongs to the template
LEAST = 5  # articles on which a subtree occurs at least before it counts as template
ALMOST = 0.9  # share of a main part's text that makes an article within hints the main part's article
HINTED_SHARE = 0.01  # share that an element needs whose class names speak for furniture

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|</([a-zA-Z][^\s/>]*)[^>]*>?|"
    r"<([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)|([^<]+|<)",
    re.S,
)
_NAMES = re.compile(r"(?:^|\s)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_RAW = frozenset("script style textarea title noscript xmp iframe noembed noframes".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img math semantics mrow mi mn mo ms mtext mspace msup msub msubsup mfrac "
    "msqrt mroot mover munder munderover mtable mtr mtd mstyle mpadded mphantom menclose merror".split()
)
_DROP = frozenset(  # elements whose text no reader sees as text
    "script style noscript template button select option textarea iframe svg object embed canvas audio video head title "
    "annotation input".split()
)
_APART = frozenset("nav footer aside dialog menu".split())  # never part of an article
_FORM = frozenset("form fieldset".split())  # may wrap a whole page
_BODY = frozenset("article main".split())
#: Parts of class names, ids and roles that mark what is no article.
_MARKS = frozenset(
    "ad ads advert adverts advertisement promo promotion banner sponsor sponsored cookie cookies consent gdpr notice "
    "notices alert sidebar menu nav navbar navigation breadcrumb breadcrumbs footer comment comments reply replies "
    "respond disqus share sharing social related recommended newsletter subscribe subscription signup login popup modal "
    "overlay widget toolbar pagination pager search contentinfo complementary skip".split()
)
_BESIDE = frozenset("has with no without".split())  # a name that starts so tells of another element
_CLOSED_BY = {  # an open element that a start of one of these ends
    "p": frozenset(
        "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
        "hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "td": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "th": frozenset(["td", "th", "tr", "tbody", "tfoot"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "head": frozenset(["body"]),
}
_BARRIER = frozenset("table ul ol dl article section div body html main".split())


_ENDS = {tag: [k for k, starts in _CLOSED_BY.items() if tag in starts] for starts in _CLOSED_BY.values() for tag in starts}
CLASSED, WRAPPER, FIXED = 1, 2, 3  # how an element speaks for furniture: class names, a form, its meaning


def _hints(attributes: str) -> str:
    """The words of class names, ids and roles that speak for furniture."""
    if "=" not in attributes:
        return ""
    words = set()
    for found in _NAMES.findall(attributes):
        for name in "".join(found).lower().split():
            parts = [w for w in re.split(r"[^a-z0-9]+", name) if w]
            if parts and parts[0] not in _BESIDE:
                words.update(w for w in parts if w in _MARKS)
    return " ".join(sorted(words))


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


class Element:
    """An element with text: hash of its subtree, hash of its hints, place in the page's elements and blocks."""

    __slots__ = ("tag", "hints", "level", "drop", "body", "parent", "begin", "end", "parts", "mark", "sign")

    def __init__(self, tag, hints, level, drop, body, parent, begin):
        self.tag, self.hints, self.level, self.drop, self.body = tag, hints, level, drop, body
        self.parent, self.begin, self.end, self.parts, self.mark, self.sign = parent, begin, begin, [], 0, 0


def parse(html: str) -> tuple[list[str], list[Element]]:
    """All text blocks of a page in order, and its elements in order of their starts, the page itself first."""
    root = Element("", "", 0, False, False, -1, 0)
    stack, elements, blocks = [(0, root)], [root], []
    opened: Counter[str] = Counter()
    inside = 0  # open articles
    words: list[str] = []

    def flush():
        text = " ".join("".join(words).split())
        words.clear()
        if text and not stack[-1][1].drop:
            blocks.append(text)
            stack[-1][1].parts.append(text)

    def close(upto: int):
        nonlocal inside
        flush()
        while len(stack) > upto:
            _, element = stack.pop()
            opened[element.tag] -= 1
            inside -= element.body
            element.end = len(blocks)
            if element.parts:
                element.mark = _hash("\0".join([element.tag, element.hints, *element.parts]))
                if element.level:
                    element.sign = _hash(f"{element.tag}\0{element.hints}")
                if stack:
                    stack[-1][1].parts.append(f"\1{element.mark}")
            element.parts = []

    at = 0
    while at < len(html):
        m = _TOKEN.match(html, at)
        at = m.end()
        ending, starting, attributes, text = m.groups()
        if text is not None:
            if not stack[-1][1].drop:
                words.append(unescape(text))
        elif starting is not None:
            tag = starting.lower()
            if tag in _RAW:
                found = re.compile(f"</{tag}[^>]*>?", re.I).search(html, at)
                at = found.end() if found else len(html)
                continue
            if tag in _INLINE or tag == "br":
                if tag in ("br", "img"):
                    words.append(" ")
                continue
            if any(opened[k] for k in _ENDS.get(tag, ())):
                for k in range(len(stack) - 1, 0, -1):
                    if tag in _CLOSED_BY.get(stack[k][1].tag, ()):
                        close(k)
                        break
                    if stack[k][1].tag in _BARRIER:
                        break
            flush()
            if tag in _VOID or attributes.endswith("/"):
                continue
            hints = "" if tag in ("html", "body") else _hints(attributes)
            fixed = tag in _APART or (tag == "header" and not inside)
            level = FIXED if fixed else WRAPPER if tag in _FORM else CLASSED if hints else 0
            drop = stack[-1][1].drop or tag in _DROP
            element = Element(tag, hints, level, drop, tag in _BODY, stack[-1][0], len(blocks))
            stack.append((len(elements), element))
            elements.append(element)
            opened[tag] += 1
            inside += element.body
        elif ending is not None:
            tag = ending.lower()
            if tag in _INLINE:
                continue
            if opened[tag] > 0:
                k = next(k for k in range(len(stack) - 1, 0, -1) if stack[k][1].tag == tag)
                close(k)
            else:
                flush()
    close(0)
    return blocks, elements


def _article(elements: list, size: list[int], hinted: list[bool], depth: list[int], lost: list[bool]) -> int | None:
    """The element that is the article: fewest hints on it and around it, then the longest."""
    found = [i for i, e in enumerate(elements) if e.body and size[i] and not lost[i]]
    if not found:
        return None
    best = min(found, key=lambda i: (depth[i], -size[i]))
    within = [i for i in found if i > best and elements[i].end <= elements[best].end]
    if within and all(depth[i] > depth[best] for i in within):  # hints between a main part and all its articles
        longest = max(within, key=lambda i: (size[i], -i))
        if size[longest] > ALMOST * size[best]:
            best = longest
    if depth[best]:  # among hints only: it must be most of what the hints leave
        plain = size[0] - sum(size[i] for i in range(len(elements)) if hinted[i] and depth[i] == 1)
        if size[best] <= plain:
            return None
    return best


def choose(blocks: list[str], elements: list, template: set[int] | None) -> list[str]:
    """The blocks that belong to the article, given the host's template; None takes all hints for furniture."""
    total = [0, *accumulate(map(len, blocks))]
    n = len(elements)
    size = [total[e.end] - total[e.begin] for e in elements]
    hinted, depth, lost, shared = [False] * n, [0] * n, [False] * n, [False] * n
    for i, e in enumerate(elements):
        up = e.parent
        shared[i] = template is not None and bool(size[i]) and e.mark in template
        hinted[i] = e.level >= WRAPPER or (e.level == CLASSED and (template is None or e.sign in template))
        depth[i] = hinted[i] + (depth[up] if i else 0)
        lost[i] = shared[i] or e.level == FIXED or (lost[up] if i else False)
    best = _article(elements, size, hinted, depth, lost)
    spared = set()
    if best is not None:
        i = best
        while i >= 0:  # hints never remove what is the article or holds it
            spared.add(i)
            i = elements[i].parent
        if hinted[best]:
            spared.update(i for i, e in enumerate(elements) if e.body and e.sign == elements[best].sign)

    def left() -> list[int]:
        gone, inside, kept = [False] * n, [False] * n, bytearray(len(blocks))
        for i, e in enumerate(elements):
            up = e.parent
            gone[i] = (i > 0 and gone[up]) or shared[i] or (hinted[i] and i not in spared)
            inside[i] = not gone[i] and ((i > 0 and inside[up]) or (e.body and size[i] > 0))
        whole = not any(inside)
        for i, e in enumerate(elements):
            if (inside[i] or (whole and i == 0)) and (i == 0 or not inside[e.parent]):
                kept[e.begin : e.end] = b"\1" * (e.end - e.begin)
        for i, e in enumerate(elements):
            if gone[i] and (i == 0 or not gone[e.parent]):
                kept[e.begin : e.end] = bytes(e.end - e.begin)
        return [k for k, on in enumerate(kept) if on]

    found = left()
    if not found:  # a page within one hinted element: the longest of them holds the article
        around = [i for i in range(n) if elements[i].level == CLASSED and hinted[i] and depth[i] == 1 and not lost[i]]
        if around:
            spared.add(max(around, key=lambda i: (size[i], -i)))
            found = left()
    return [blocks[k] for k in found]


def _host(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", url or "")
    return (m[1].rpartition("@")[2].lower() if m else "").rstrip(".")


_Stored = namedtuple("_Stored", "mark sign level body parent begin end")


def _with_text(elements: list[Element]) -> list[dict]:
    """The page and its elements that hold text, numbered anew; an element with text has parents with text."""
    place, out = {0: 0}, []
    for i, e in enumerate(elements):
        if i == 0 or e.end > e.begin:
            place[i] = len(out)
            parent = place[e.parent] if i else -1
            out.append(_Stored(e.mark, e.sign, e.level, e.body, parent, e.begin, e.end)._asdict())
    return out


_ELEMENT = "mark:long,sign:long,level:int,body:boolean,parent:int,begin:int,end:int"


def extract(pages: DataFrame) -> DataFrame:
    """``page_id``, ``url`` and ``text`` of every row of ``pages``.

    ``text`` holds the article's blocks in page order with two line feeds between
    them, white space inside a block turned into one space.  A null html is empty
    and has an empty text.  Null ids and urls are kept, rows without a host count
    as one host.  Copies of an article count once for the template, so that a
    page is not deleted for having copies.  Repeated rows are kept.

    A subtree on over ``SHARE`` of its host's different articles, ``LEAST`` at least,
    is deleted.  An element with class names that speak for furniture is deleted
    if elements of its kind are on ``HINTED_SHARE`` of them, its own page included.
    Menus, footers, asides, page headers and forms are so by their meaning and need
    no count.  No hint removes an element that is the article or holds it.
    """
    element = pa.struct(
        [("mark", pa.int64()), ("sign", pa.int64()), ("level", pa.int32()), ("body", pa.bool_())]
        + [(name, pa.int32()) for name in ("parent", "begin", "end")]
    )
    names = [field.name for field in element]

    def read(batches):
        for rows in text_slices(batches, "html"):
            hosts, articles, texts, found = [], [], [], []
            for url, html in zip(rows.column("url").to_pylist(), rows.column("html").to_pylist()):
                blocks, elements = parse(html or "")
                hosts.append(_host(url))
                articles.append(_hash("\n".join(choose(blocks, elements, None))))
                texts.append(blocks)
                found.append(_with_text(elements))
            columns = [rows.column("page_id"), rows.column("url"), pa.array(hosts, pa.string()), pa.array(articles, pa.int64())]
            columns += [pa.array(texts, pa.list_(pa.string())), pa.array(found, pa.list_(element))]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "host", "article", "blocks", "elements"])

    def write(batches):
        for rows in batches:
            texts = []
            for blocks, elements, template in zip(*(rows.column(c).to_pylist() for c in ("blocks", "elements", "template"))):
                kept = choose(blocks, [_Stored(*(e[c] for c in names)) for e in elements], set(template or ()))
                texts.append("\n\n".join(kept))
            yield pa.RecordBatch.from_arrays(
                [rows.column("page_id"), rows.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"]
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    schema = f"page_id long, url string, host string, article long, blocks array<string>, elements array<struct<{_ELEMENT}>>"
    rows = staged(rows.mapInArrow(read, schema), "pages", compression="zstd")
    sizes = rows.select("host", "article").distinct().groupBy("host").agg(F.count("*").alias("articles"))
    hinted = F.transform(F.filter("elements", lambda e: e["level"] > 0), lambda e: F.struct(e["sign"].alias("mark"), F.lit(True).alias("hint")))
    plain = F.transform("elements", lambda e: F.struct(e["mark"].alias("mark"), F.lit(False).alias("hint")))
    seen = rows.select("host", "article", F.explode(F.array_distinct(F.concat(plain, hinted))).alias("m"))
    seen = seen.select("host", "article", "m.mark", "m.hint").distinct()
    seen = seen.groupBy("host", "mark", "hint").agg(F.count("*").alias("seen"))
    # a host keeps at most 1 / SHARE times the subtrees of its mean article, 1 / HINTED_SHARE times its hints
    seen = seen.where(F.col("hint") | (F.col("seen") >= LEAST)).join(sizes, "host")
    enough = F.when(F.col("hint"), F.col("seen") >= HINTED_SHARE * F.col("articles"))
    seen = seen.where(enough.otherwise(F.col("seen") > SHARE * F.col("articles")))
    template = staged(seen.groupBy("host").agg(F.collect_set("mark").alias("template")), "template")
    marks = F.concat(F.transform("elements", lambda e: e["mark"]), F.transform("elements", lambda e: e["sign"]))
    own = F.array_intersect(marks, F.coalesce("template", F.array().cast("array<long>"))).alias("template")
    joined = rows.join(template, "host", "left").select("page_id", "url", "blocks", "elements", own)
    return joined.mapInArrow(write, "page_id long, url string, text string")
