"""Main text of web pages: markup first, then differences to the page with the nearest URL.

A page is cut into blocks of text at block tags.  Parts that markup names as something else are left
out: menus, site headers, footers, sidebars, notices, adverts, forms, scripts, reader comments.  If a page
marks its article (or main part), its lines are the blocks in it, else all that are left.

Markup leaves open which of these lines belong to the site.  Every page is paired within its host with
the neighbour in the order of URL paths that shares the longer beginning of its path (pages that
are made from one template lie side by side).  The lines of the two are aligned by their longest common
subsequence, and the lines that both have are deleted.  A neighbour that shares nearly everything
is a copy and says nothing about the site: then the other neighbour is asked, and if both are
copies nothing is deleted.  Articles may share passages, so a line of a marked article is deleted only if both neighbours
mark theirs too and have the line outside of it.

Only keys and line hashes travel for the pairing, in an ordered scan that cuts large hosts into blocks.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from quern import settings
from quern.llm.common import binaries, text_column
from quern.operators.ordered import Ordered, shift

#: share of a page's lines from which its neighbour is a copy of it
COPY = 0.8

#: fixed values: elements without any of the page's text, and elements that are not part of an article
SILENT = "script style noscript template textarea title svg math iframe object canvas head select datalist"
ASIDE = "nav footer aside form dialog menu button fieldset"
#: fixed values: words of class, id and role that name something other than the article
NAMES = (
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer form gdpr masthead menu nav navbar navigation newsletter notice notification pagination popup promo related "
    "replies search share sharing sidebar skip social sponsor sponsored subscribe toolbar widget"
)
#: fixed values: inline elements, which do not end a block
INLINE = (
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr"
)
#: fixed values: parts of a longer class or id that tell by themselves, in the first or the last place
FIRST_PARTS = set("ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies footer gdpr menu nav navbar "
                  "newsletter pagination popup promo related share sharing sidebar sponsor sponsored subscribe".split())
LAST_PARTS = set("ad ads advert advertisement banner breadcrumb breadcrumbs comments consent cookies footer menu nav navbar navigation newsletter "
                 "pagination popup promo sidebar sponsor toolbar widget".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
SILENT, ASIDE, NAMES, INLINE = (set(x.split()) for x in (SILENT, ASIDE, NAMES, INLINE))

#: fixed values: elements whose end tag may be left out, and the tags that then begin after them
BLOCKS = set(
    "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hr main menu nav ol p pre section summary table ul".split())
TABLE = set("caption colgroup thead tbody tfoot tr td th".split())
CLOSED_BY = {
    "p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"},
    "td": TABLE, "th": TABLE, "tr": TABLE - {"td", "th"}, "head": BLOCKS | {"body"},
}

ATTRIBUTES = r"(?:[^>\"']|\"[^\"]*\"|'[^']*')*"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(?P<raw>(?i:script|style|textarea|title))(?=[\s/>]){ATTRIBUTES}(?:(?<=[\s\"']/)>|>.*?(?:</(?i:(?P=raw))(?=[\s/>])[^>]*>|\Z))"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|(?P<cut><[a-zA-Z/][^<>]*\Z)|(?P<text>[^<]+|<)", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")


#: a class attribute with a token that begins with "comment"
COMMENT = r"(?:^|\s)class\s*=\s*(?:\"(?:[^\"]*\s)?|'(?:[^']*\s)?)?comments?\b"


def hidden(rest: str) -> bool:
    return any(name.lower() == "hidden" or name.lower() == "aria-hidden" and value.strip("\"'").lower() == "true" for name, value in ATTRIBUTE.findall(rest))


def is_aside(token: str) -> bool:
    """Whether a class or id names what is not the article: as a whole, or by a part that says so wherever it stands."""
    if token in NAMES:
        return True
    parts = re.split(r"[-_]+", token)
    return parts[0] in FIRST_PARTS or parts[-1] in LAST_PARTS


def named_aside(rest: str, in_article: bool = False) -> bool:
    """Attributes that hide an element or name it; ids inside an article are its own anchors."""
    if hidden(rest):
        return True
    for name, value in ATTRIBUTE.findall(rest):
        name, value = name.lower(), value.strip("\"'").lower()
        if (name in ("class", "role") or name == "id" and not in_article) and any(map(is_aside, value.split())):
            return True
    return False


def blocks(page: str) -> tuple[bool, list[str], list[str]]:
    """(whether the page marks its article, blocks of it, blocks outside of what markup leaves out)."""
    inside, outside, mains = [], [], []
    parts: list[str] = []
    skip, skip_at, level, main_level = "", 0, 0, 0
    role_at = -1  # depth of the element that has the role of the main one
    stack: list[str] = []  # open elements: blocks, and what is skipped

    def end_block() -> None:
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            (inside if level else mains if main_level or role_at >= 0 else outside).append(text)

    for m in TOKEN.finditer(page):
        if (text := m["text"]) is not None:
            if not skip:
                parts.append(text)
            continue
        if m["raw"] is not None and not skip:
            end_block()
        if m["tag"] is None:
            continue
        tag, closing = m["tag"].lower(), bool(m["close"])
        content = tag in ("article", "main")
        selfclosed = tag in VOID or m["rest"].rstrip().endswith("/")
        if tag not in INLINE or tag == skip:
            at = ended(stack, tag) if closing else followed(stack, tag)
            del stack[at:]
            if skip and at <= skip_at:
                own, skip = closing and at == skip_at and tag == skip, ""
                if own:
                    continue
        if skip:
            # an element that is never closed ends where the article begins
            if content and not closing and skip not in SILENT and not depth_in_article(level, main_level) and not hidden(m["rest"]):
                skip = ""
            else:
                if not closing and not selfclosed and (tag not in INLINE or tag == skip):
                    stack.append(tag)
                continue
        if tag not in INLINE:
            end_block()
        if len(stack) <= role_at:
            role_at = -1
        if closing:
            if tag == "article" and level:
                level -= 1
            elif tag == "main" and main_level:
                main_level -= 1
            continue
        # a marked article is dropped by its name only inside another one, or if it is a reader's comment
        own = hidden(m["rest"]) or (named_aside(m["rest"]) if level else re.search(COMMENT, m["rest"], re.I) is not None)
        aside = own if content else (
            tag in ASIDE or tag in SILENT or tag == "header" and not level or named_aside(m["rest"], level > 0 or main_level > 0 or role_at >= 0))
        skipped = aside and not selfclosed and tag not in ("html", "body")
        if not selfclosed and (skipped or tag not in INLINE):
            stack.append(tag)
        if skipped:
            skip, skip_at = tag, len(stack) - 1
        elif tag == "article":
            level += 1
        elif tag == "main":
            main_level += 1
        elif role_at < 0 and not selfclosed and tag not in INLINE and re.search(r"(?:^|\s)role\s*=\s*[\"']?main\b", m["rest"], re.I):
            role_at = len(stack) - 1
    end_block()
    if inside:
        return True, inside, outside + mains
    if mains:
        return True, mains, outside
    return False, [], outside


def ended(stack: list[str], tag: str) -> int:
    """Number of elements that stay open after an end tag; what lies open in its element ends with it."""
    for i in range(len(stack) - 1, -1, -1):
        if stack[i] == tag:
            return i
        if stack[i] in ("table", "td", "th", "caption") and tag not in TABLE and tag not in ("table", "body", "html"):
            break
    return len(stack)


def followed(stack: list[str], tag: str) -> int:
    """Number of elements that stay open where this one begins."""
    keep = len(stack)
    for i in range(len(stack) - 1, -1, -1):
        if tag in CLOSED_BY.get(stack[i], ()):
            keep = i
        elif stack[i] == "table" if tag in TABLE else stack[i] not in ("div", "p", "address"):
            break
    return keep


def depth_in_article(level: int, main_level: int) -> bool:
    return level > 0 or main_level > 0


def line_hash(line: str) -> int:
    return xxhash.xxh64_intdigest(line.encode("utf-8", "replace"), 42) - (1 << 63)


def parsed(page: Column) -> Column:
    """Struct: whether the page marks its article, its lines (of the article, or all), and the hashes of lines outside of the article."""
    kind = "struct<marked: boolean, lines: array<string>, hashes: array<long>>"

    @arrow_udf(kind)
    def of_batch(pages: pa.Array) -> pa.Array:
        marks, lines, hashes = [], [], []
        for data in binaries(pages):
            marked, own, rest = blocks(data.decode())
            marks.append(marked)
            lines.append(own if marked else rest)
            hashes.append([line_hash(x) for x in rest])
        return pa.StructArray.from_arrays(
            [pa.array(marks, pa.bool_()), pa.array(lines, pa.list_(pa.string())), pa.array(hashes, pa.list_(pa.int64()))],
            ["marked", "lines", "hashes"])

    return of_batch(page)


def common(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence of the two lists."""
    where: dict[int, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        where.setdefault(b[j], []).append(j)
    tails: list[int] = []  # the smallest end in b of a common subsequence of each length
    steps: list[tuple] = []
    for i, x in enumerate(a):
        for j in where.get(x, ()):
            k = bisect_left(tails, j)
            step = (i, steps[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                steps.append(step)
            else:
                tails[k], steps[k] = j, step
    out, step = [], steps[-1] if steps else None
    while step:
        out.append(step[0])
        step = step[1]
    return out[::-1]


def different(marked: Column, lines: Column, nearest: Column, other: Column) -> Column:
    """The page's own lines, joined: without those that it shares with a neighbour that is no copy of it.

    Neighbours: struct of marked and hashes.  From a marked article only lines go that both show outside of theirs.
    """

    @arrow_udf("string")
    def of_batch(marked: pa.Array, lines: pa.Array, nearest: pa.Array, other: pa.Array) -> pa.Array:
        out = []
        for is_article, own, *neighbours in zip(*(x.to_pylist() for x in (marked, lines, nearest, other))):
            own_hashes = [line_hash(x) for x in own]
            if is_article and not all(x and x["marked"] for x in neighbours):
                neighbours = []
            found = []
            for neighbour in neighbours:
                shared = set(common(own_hashes, (neighbour or {"hashes": []})["hashes"]))
                found.append(shared if len(shared) < COPY * len(own) else set())
                if found[-1] and not is_article:
                    break
            gone = (set.intersection(*found) if is_article else found[-1]) if found else set()
            out.append(" ".join(x for i, x in enumerate(own) if i not in gone))
        return pa.array(out, pa.string())

    return of_batch(marked, lines, nearest, other)


def neighbours(keys: DataFrame) -> DataFrame:
    """(k0, k1, k2, nearest, other): marked and line hashes of the two neighbours of every page in its host's order of paths."""
    around = F.struct("path", F.struct("marked", "hashes").alias("page"))
    rows = Ordered(keys, ["host"], ["path", "k0", "k1", "k2"]).scan(before=shift(around), after=shift(around, reverse=True)).rows()
    alike = lambda c: F.size(F.filter(F.sequence(F.lit(1), F.greatest(F.length("path"), F.lit(1))), lambda i: F.substring(
        F.col("path"), F.lit(1), i) == F.substring(F.col(f"{c}.path"), F.lit(1), i)))
    second = F.coalesce(alike("after"), F.lit(-1)) > F.coalesce(alike("before"), F.lit(-1))
    return rows.select("k0", "k1", "k2", F.when(second, F.col("after.page")).otherwise(F.col("before.page")).alias("nearest"),
                       F.when(second, F.col("before.page")).otherwise(F.col("after.page")).alias("other"))


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars), one row per row of ``pages``.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by one
    space.  A null or empty page has an empty text.  A null URL counts as the empty URL of a host of its own; pages
    with equal id, URL and html count once as neighbours, and their rows repeat.  Null ids stay; pages are read
    whole; other columns play no part; an empty table gives no rows.
    """
    settings.ensure_checkpoint_dir(pages.sparkSession)
    page = text_column(pages, "html")
    rows = pages.select(pages["page_id"], pages["url"], F.xxhash64(page).alias("h"), parsed(page).alias("x")).select(
        "page_id", "url", "h", "x.*")
    address = F.coalesce(F.col("url").cast("string"), F.lit(""))
    keys = rows.select(F.col("page_id").alias("k0"), F.col("url").alias("k1"), F.col("h").alias("k2"),
                       F.lower(F.regexp_extract(address, r"^[A-Za-z]+://([^/?#]*)", 1)).alias("host"),
                       F.regexp_extract(address, r"^(?:[A-Za-z]+://[^/?#]*)?([^?#]*)", 1).alias("path"),
                       "marked", "hashes").checkpoint()
    beside = neighbours(keys.dropDuplicates(["k0", "k1", "k2"]))
    found = rows.join(beside, F.col("page_id").eqNullSafe(F.col("k0")) & F.col("url").eqNullSafe(F.col("k1")) & (F.col("h") == F.col("k2"))).select(
        "page_id", "url", different(F.col("marked"), F.col("lines"), F.col("nearest"), F.col("other")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
