"""Main text of web pages by equivalence-class template deduction.

The tokens of a page are its block elements, each by its path of element names
and classes, and its text blocks. A token's occurrence vector is how often each
page of the same host has it; tokens with one vector form an equivalence class.
Classes of enough tokens and pages whose tokens nest (all hang below one other
class) make the host's template. What no template token covers is a slot: the
text below its nearest template element. All slots whose texts differ between
pages hold the article, wherever they stand; slots with the same texts on every
page are notices, and slots of many short links are lists of links. Neither is
dropped inside an article or main element. Where a host has too few pages to
tell, the page's article element decides, else all its text is kept. Copies of
a page are one page for all this; if a host's pages share more text than they
differ in, they are near copies of an article and no text is a notice.

Besides, fixed lists name elements (navigation, footers, forms) and words of
class, id and role (advertisements, comments) that mark other regions; a word of
several parts counts if all of them are such words or name a container. The
template overrules the words where nearly all of a host's differing text stands
in marked regions and none in an article element, and it keeps a header that
differs between pages.

Vectors are compared by two sums of hashes, so they are aggregated before they
are shuffled, and a host with a third of all pages is no larger group than
another. Templates have a row per host; Spark joins them to the pages by
broadcast if the written table is small enough, else by a sorted join whose
skewed partitions it splits.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fleetlens.llm.common import written

#: Pages that must share a text before it counts as the template's: one page
#: alone says nothing.
SAME_TEXT_PAGES = 2
#: Elements deeper than this stand for the element around them at this depth, so
#: that the paths of a page grow with its size alone.
DEPTH = 256
#: Tokens of a class in the template, at least.
CLASS_TOKENS = 2
#: A list of links: fewer characters a text than this, and more than one a page.
LINK_CHARS = 50
#: Words are overruled if marked text is more than so many times the plain one.
OVERRULE = 4
# What a slot is: texts differ; too few pages to tell; notices; links.
VARIED, UNKNOWN, FIXED, LINKS = range(4)

# HTML's elements by how they are parsed.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span "
    "strike strong sub sup time tt u var wbr br img".split())
# An element that a new one of the group's closes, up to the group's container.
CLOSED_BY_SIBLING = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
# Regions that are not the article, by element and by words of class, id or role.
OTHER_ELEMENTS = frozenset(
    "head nav footer aside form button select dialog menu template svg math object audio video canvas".split()) | RAW
OTHER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs masthead topbar footer comment comments reply replies cookie cookies consent "
    "notice notices alert popup modal overlay newsletter subscribe subscription share sharing social related "
    "recommended widget toolbar pagination pager login signup search complementary contentinfo".split())
# Parts beside them that only say what kind of container it is.
CONTAINER_WORDS = frozenset(
    "area bar block body bottom box button buttons col column container content entry form group head header holder inner "
    "item items left link links list main module outer page panel post posts primary right row secondary section side site "
    "slot space spot thread top unit wrap wrapper zone".split())
# Words that inside an article may as well name what it is about.
SUBJECT_WORDS = frozenset("social search menu banner alert notice notices complementary widget".split())

# A quote opens a value only behind "=".
TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)(?:>|\Z)", re.S)
HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)\s*(?:!\s*important\s*)?(?:;|$)")
NUMBER = re.compile(r"\d+")
PART = re.compile(r"[-_]+")
ATTRIBUTE = re.compile(r"([^\s\"'>/=][^\s>/=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
# How surely a text is not the article's: a header can be the page's own, a
# word of a class can mislead, an element or a hidden one does not.
PLAIN, HEADER, WORD, ELEMENT = range(4)
#: Elements that hold the article, never marked by words.
WHOLE = frozenset("html body main article".split())
# Elements that some sites wrap a whole page in.
WRAPPERS = frozenset("aside dialog form".split())
#: A path in an article.
ARTICLE = re.compile(r"/(?:article|main)(?:[./]|$)")


class Block(NamedTuple):
    path: str  # of the block elements around it, from the root
    text: str  # white space runs as one space, trimmed, not empty
    other: int  # inside a region that is not the article: PLAIN to ELEMENT
    linked: int  # about how many of its characters are links'


class Element(NamedTuple):
    name: str
    path: str
    other: int
    link: bool
    depth: int  # block elements around it and itself


def _named(attributes: str) -> tuple[str, set[str], bool]:
    """First class, whole words of class, id and role, and whether it is
    hidden. Numbers in a class are one sign: ``post-17`` and ``post-18`` are one."""
    first, words, hidden = "", set(), False
    for key, *values in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values).lower()
        hidden = hidden or key == "hidden" or (key == "style" and HIDDEN.search(value) is not None)
        if key == "class" and value.strip() and not first:
            first = NUMBER.sub("#", value.split()[0])
        if key in ("class", "id", "role"):
            words.update(value.split())
    return first, words, hidden


def other_word(word: str) -> str | None:
    """The part of a class word that names another region, if all its parts
    are such words, containers or numbers."""
    if word in OTHER_WORDS:
        return word
    parts = [p for p in PART.split(word) if p]
    if len(parts) > 1 and all(p in OTHER_WORDS or p in CONTAINER_WORDS or p.isdigit() for p in parts):
        return next((p for p in parts if p in OTHER_WORDS), None)
    return None


def mark(name: str, words: set[str], hidden: bool, in_article: bool) -> int:
    """How surely an element is not the article, by itself."""
    if name in WHOLE:
        return ELEMENT if hidden and name not in ("html", "body") else PLAIN
    if hidden or (name in OTHER_ELEMENTS and name not in WRAPPERS):
        return ELEMENT
    if name in WRAPPERS or any((w := other_word(x)) and not (in_article and w in SUBJECT_WORDS) for x in words):
        return WORD
    return HEADER if not in_article and (name == "header" or "header" in words) else PLAIN


def parse(page: str) -> tuple[list[Block], Counter]:
    """Text blocks in page order, and how often each block path opens."""
    blocks: list[Block] = []
    paths: Counter = Counter()
    stack = [Element("", "", PLAIN, False, 0)]
    opened: Counter = Counter()  # elements on the stack, by name
    pending: list[str] = []
    linked = 0

    def push(e: Element) -> None:
        stack.append(e)
        opened[e.name] += 1

    def cut(depth: int) -> None:
        opened.subtract(e.name for e in stack[depth:])
        del stack[depth:]

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(pending)).split()) if pending else ""
        pending.clear()
        if text:
            top = stack[-1]  # an inline element has the path of the block around it
            blocks.append(Block(top.path, text, top.other, min(linked, len(text))))
        linked = 0

    def close(names: set[str], barriers: set[str]) -> None:
        if not any(opened[n] for n in names):
            return
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in names:
                flush()
                cut(depth)
                return
            if stack[depth].name in barriers:
                return

    at, end = 0, len(page)
    while at < end:
        m = TAG.search(page, at)
        stop = end if m is None else m.start()
        if stop > at:
            pending.append(page[at:stop])
            if stack[-1].link:
                linked += len(pending[-1].strip())
        if m is None:
            break
        at = m.end()
        name = m[2]
        if name is None:
            if m[0].startswith("<![CDATA["):
                pending.append(html.escape(m[0][9:].removesuffix("]]>")))
            continue
        name, closing, attributes = name.lower(), m[1], m[3] or ""
        if closing:
            if name not in INLINE:
                close({name}, set())
            elif opened[name]:  # not beyond the block it stands in
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].name not in INLINE:
                        break
                    if stack[depth].name == name:
                        if stack[depth].other != stack[depth - 1].other:
                            flush()
                        cut(depth)
                        break
            continue
        if name in VOID:
            if name not in INLINE:
                flush()
            elif name == "br":
                pending.append(" ")
            continue
        first, words, hidden = _named(attributes) if attributes.strip() else ("", set(), False)
        if name not in INLINE:
            flush()
            if name in CLOSED_BY_SIBLING:
                close(*CLOSED_BY_SIBLING[name])
            else:
                close({"p"}, {"table", "td", "th", "li", "button", "object", "article", "section", "div"})
        in_article = opened["article"] + opened["main"] > 0
        other = max(stack[-1].other, mark(name, words, hidden, in_article))
        if name in INLINE:
            if other != stack[-1].other:
                flush()
            push(Element(name, stack[-1].path, other, name == "a" or stack[-1].link, stack[-1].depth))
            continue
        depth = stack[-1].depth + 1
        path = f"{stack[-1].path}/{name}" + (f".{first}" if first else "") if depth <= DEPTH else stack[-1].path
        paths[path] += depth <= DEPTH
        if name in RAW:
            close_tag = re.compile(rf"</{re.escape(name)}\b[^>]*>?", re.I).search(page, at)
            at = close_tag.end() if close_tag else end
            continue
        push(Element(name, path, other, stack[-1].link, depth))
    flush()
    return blocks, paths


def host_of(url: str | None) -> str:
    """The host a URL names, empty if none."""
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


TOKEN = ("struct<token: bigint, path: string, at: bigint, one: bigint, two: bigint, plain: bigint, marked: bigint, "
         "linked: bigint, blocks: bigint>")


def tokens(pages: DataFrame) -> DataFrame:
    """The tokens of every distinct page of a host: host, token, path (null for
    a text's token), at (the token of the path it stands at, a path's its own),
    the page's vector entry as two hashes; chars of plain and of marked text,
    chars of links and number of texts at a path.

    A page's tokens are one row until copies are gone, so that a page counts
    once however often its host has it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh64_intdigest
        low = (1 << 32) - 1
        for b in batches:
            hosts, contents, ends = [], [], [0]
            columns: list[list] = [[] for _ in range(9)]

            def add(*values, columns=columns):
                for column, value in zip(columns, values, strict=True):
                    column.append(value)

            for url, source in zip(*(c.to_pylist() for c in b.columns), strict=True):
                content = xxhash.xxh128_hexdigest(source or "")
                hosts.append(host_of(url))
                contents.append(content)
                blocks, found = parse(source or "")
                size: dict[str, list[int]] = {}
                texts: dict[int, list] = {}
                for x in blocks:
                    here = size.setdefault(x.path, [0, 0, 0, 0])
                    mine = texts.setdefault(text_token(x), [0, x.path, 0, 0])
                    mine[0] += 1
                    if x.other < ELEMENT:
                        n = len(x.text)
                        here[int(x.other == WORD)] += n
                        here[2] += min(n, x.linked)
                        here[3] += 1
                        mine[2 + int(x.other == WORD)] += n
                names = {}
                for path, n in [("", 1), *found.items()]:
                    names[path] = name = digest(path) - (1 << 63)
                    h = digest(f"{content} {n}")
                    add(name, path, name, h >> 32, h & low, *size.get(path, (0, 0, 0, 0)))
                for name, (n, path, plain, marked) in texts.items():
                    if plain or marked:
                        add(name, None, names[path], 0, 0, plain, marked, 0, 0)
                ends.append(len(columns[0]))
            fields = ["token", "path", "at", "one", "two", "plain", "marked", "linked", "blocks"]
            made = pa.StructArray.from_arrays(
                [pa.array(c, pa.string() if f == "path" else pa.int64()) for f, c in zip(fields, columns, strict=True)], fields)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(contents, pa.string()),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), made)], ["host", "content", "tokens"])

    made = pages.select("url", "html").mapInArrow(run, f"host string, content string, tokens array<{TOKEN}>")
    return (made.groupBy("host", "content").agg(F.first("tokens").alias("tokens"))
            .select("host", F.explode("tokens").alias("t")).select("host", "t.*"))


def text_token(block: Block) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(f"{block.path}\0{block.text}", 1) - (1 << 63)


def templates(found: DataFrame, same_text_pages: int = SAME_TEXT_PAGES, class_tokens: int = CLASS_TOKENS) -> DataFrame:
    """Per host: ``slots``, the template's paths that have text, with what
    each is, and ``overruled``, whether words do not mark other regions."""
    vectors = written(
        found.groupBy("host", "token").agg(
            F.count("*").alias("pages"), F.sum("one").alias("one"), F.sum("two").alias("two"),
            F.first("path").alias("path"), F.first("at").alias("at"),
            *[F.sum(c).alias(c) for c in ("plain", "marked", "linked", "blocks")])
        .filter("path is not null or pages > 1"), "vectors")
    roots = vectors.filter("path = ''").select("host", F.col("pages").alias("host_pages"),
                                               F.col("one").alias("root_one"), F.col("two").alias("root_two"))
    paths = vectors.filter("path is not null").join(roots, "host")
    # Elements that at least half of the pages have, by class.
    members = (paths.filter("2 * pages >= host_pages")
               .select("host", "path", "pages", F.struct("pages", "one", "two").alias("class"),
                       (F.struct("pages", "one", "two") == F.struct(
                           F.col("host_pages"), F.col("root_one"), F.col("root_two"))).alias("in_root"),
                       F.regexp_replace("path", "/[^/]*$", "").alias("parent")))
    above = members.select("host", F.col("path").alias("parent"), F.col("class").alias("parent_class"))
    nested = members.join(above, ["host", "parent"], "left")
    outside = F.when(F.col("parent_class") != F.col("class"), F.col("parent_class"))
    valid = (nested.groupBy("host", "class").agg(
        F.count("*").alias("tokens"), F.count_distinct(outside).alias("parents"), F.max("in_root").alias("in_root"))
        .filter(F.col("in_root") | ((F.col("tokens") >= class_tokens) & (F.col("parents") <= 1))))
    template = members.join(valid.select("host", "class"), ["host", "class"]).select(
        "host", "path", F.col("pages").alias("slot_pages"))
    # Texts on every page that has their path.
    same = (vectors.filter("path is null")
            .join(paths.filter("2 * pages >= host_pages").select("host", "at", F.col("pages").alias("path_pages")), ["host", "at"])
            .filter("pages = path_pages").groupBy("host", "at")
            .agg(F.sum("plain").alias("same_plain"), F.sum("marked").alias("same_marked")))
    # Each path's text goes to its nearest template element, its slot.
    sums = ["plain", "marked", "linked", "blocks", "same_plain", "same_marked"]
    texts = (paths.filter("plain + marked > 0").join(same, ["host", "at"], "left")
             .select("host", "host_pages", "path", *[F.coalesce(c, F.lit(0)).alias(c) for c in sums]))
    parts = F.split("path", "/")
    up = texts.withColumn("depth", F.explode(F.sequence(F.lit(1), F.size(parts)))).select(
        "host", "host_pages", F.col("path").alias("of"), "depth", *sums,
        F.array_join(F.slice(parts, F.lit(1), F.col("depth")), "/").alias("path"))
    slots = (up.join(template, ["host", "path"]).groupBy("host", "of")
             .agg(F.max(F.struct("depth", "path", "slot_pages", "host_pages", *sums)).alias("slot"))
             .groupBy("host", "slot.path", "slot.slot_pages", "slot.host_pages")
             .agg(*[F.sum(f"slot.{c}").alias(c) for c in sums])
             .withColumn("in_article", F.col("path").rlike(ARTICLE.pattern))
             .withColumn("links", F.expr(
                 f"not in_article and not path rlike '/h[1-6](?:[.][^/]*)?$' and 5 * linked >= 4 * (plain + marked) "
                 f"and blocks >= 2 * slot_pages and plain + marked < {LINK_CHARS} * blocks"))
             .withColumn("same", F.expr("same_plain + same_marked >= plain + marked")))
    kind = (F.when(F.col("links"), LINKS).when(F.col("host_pages") < 2, UNKNOWN).when(~F.col("same"), VARIED)
            .when(F.col("host_pages") < same_text_pages, UNKNOWN).otherwise(FIXED))
    per_host = (slots.groupBy("host").agg(
        F.max("host_pages").alias("host_pages"),
        F.collect_list(F.struct("path", kind.alias("kind"))).alias("slots"),
        F.sum(F.expr("if(links, 0, plain - same_plain)")).alias("plain"),
        F.sum(F.expr("if(links, 0, marked - same_marked)")).alias("marked"),
        F.sum(F.expr("if(same and not links and not in_article, same_plain, 0)")).alias("fixed"),
        F.max(F.expr("in_article and plain > 0")).alias("has_article")))
    # Pages that share more than they differ in are near copies.
    copies = F.col("fixed") > F.col("plain") + F.col("marked")
    known = F.transform("slots", lambda x: F.struct(x["path"].alias("path"), F.when(
        copies & (x["kind"] == FIXED), UNKNOWN).otherwise(x["kind"]).alias("kind")))
    overruled = (~F.col("has_article") & (F.col("host_pages") >= same_text_pages)
                 & (F.col("marked") > OVERRULE * F.col("plain")))
    return written(per_host.select("host", known.alias("slots"), overruled.alias("overruled")), "templates")


def main_text(blocks: list[Block], slots: dict[str, int], overruled: bool = False) -> str:
    """The blocks that are neither other regions' nor in a slot of notices or
    links; of a page without such blocks, all but other regions'; of a page
    that words mark as a whole, all that elements do not mark."""
    kinds: dict[str, tuple[int, bool]] = {}
    for b in blocks:
        if b.path not in kinds:
            at = b.path
            while at and at not in slots:
                at = at.rpartition("/")[0]
            kinds[b.path] = slots.get(at, UNKNOWN), ARTICLE.search(b.path) is not None
    articles = [b.other for b in blocks if b.other < ELEMENT and kinds[b.path][1]]
    # An article in a marked region is the page's, if it is the only one.
    lost = bool(articles) and min(articles) == WORD

    def holds(b: Block) -> bool:
        kind, inside = kinds[b.path]
        if b.other == ELEMENT or (b.other == WORD and not overruled and not (lost and inside)):
            return False
        if b.other == HEADER and kind != VARIED:
            return False
        return inside or kind == VARIED or (kind == UNKNOWN and not articles)

    kept = ([b for b in blocks if holds(b)] or [b for b in blocks if b.other == PLAIN]
            or [b for b in blocks if b.other < ELEMENT])
    return "\n".join(b.text for b in kept)


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row per row: page_id, url, text, n_chars (code points), host.

    A null or empty page, or one without text, has the empty text. Pages
    without a URL or host share the host ''. Repeated rows give repeated
    results; an empty table gives an empty result; other columns are not read.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.col(source).cast("string").alias("html"))
    learned = templates(tokens(rows))
    host = F.regexp_extract(F.lower(F.coalesce("url", F.lit(""))),
                            r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    joined = rows.withColumn("host", host).join(learned, "host", "left").select(
        "page_id", "url", "html", "host", "slots", "overruled")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            known: dict[str, dict[str, int]] = {}  # a host's slots are read once a batch
            texts = []
            for i, (h, host, overruled) in enumerate(zip(*(b.column(k).to_pylist() for k in (2, 3, 5)), strict=True)):
                if host not in known:
                    known[host] = {x["path"]: x["kind"] for x in b.column(4)[i].as_py() or ()}
                texts.append(main_text(parse(h or "")[0], known[host], bool(overruled)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64()), b.column(3)],
                ["page_id", "url", "text", "n_chars", "host"])

    kind = rows.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint, host string")
