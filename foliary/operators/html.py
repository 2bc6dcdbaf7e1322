"""HTML pages as rows: a tag stream, articles, images, and books' XHTML as markdown. Parsing is the standard library's."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.entities import html5
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.core import collapse
from ..functions.urls import strip_site_suffix

VOID = frozenset(("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"))
#: Parts of class names and an attribute that mark furniture around an article; inline emphasis.
CHROME_CLASSES = ("newsletter", "latest-posts", "latest-stories", "third-party--", "print:hidden", "recirc", "recommended-stories")
CHROME_ATTRIBUTE = "data-mrf-recirculation"
EMPHASIS = frozenset(("strong", "b", "em", "i", "u", "mark", "small", "s", "strike", "del", "ins"))
#: Elements without prose for a reader of articles; inline elements that are no emphasis.
NO_PROSE = frozenset(("script", "style", "noscript", "template", "svg", "iframe", "nav", "aside", "footer", "form", "button"))
INLINE = frozenset(("span", "font", "sup", "sub", "code", "abbr", "q", "time", "label"))
#: For images: class and id tokens of furniture, and those of content, which outweigh them.
FURNITURE_CLASSES = frozenset(("ad", "ads", "advert", "advertisement", "banner", "breadcrumb", "comments", "cookie", "menu", "modal", "nav", "newsletter", "popup", "promo", "related", "share", "sharing", "sidebar", "social", "sponsor", "subscribe", "toolbar", "widget"))
CONTENT_CLASSES = frozenset(("article", "content", "entry", "figure", "main", "post", "story"))
CHROME_URL = re.compile(r"(?i)(?:logo|icon|avatar|sprite|pixel|spacer|badge|button|emoji|tracking|1x1)")
MIN_PIXELS = 100
#: An ampersand, with what follows it up to a semicolon where that may be a character reference.
AMPERSAND = re.compile(r"&(#[0-9]+;|#[xX][0-9a-fA-F]+;|[A-Za-z][A-Za-z0-9]*;)?")


@dataclass
class Node:
    """An element. Trees are walked with stacks of their own: a page may nest as deeply as it likes."""

    tag: str
    attrs: dict[str, str]
    children: list = field(default_factory=list)
    parent: "Node | None" = None

    def events(self) -> Iterator[tuple[str, "Node | str"]]:
        """What is inside, in reading order: ("text", string), and ("in", node) and ("out", node) around what a node holds."""
        stack = [iter(self.children)]
        open_ = []
        while stack:
            c = next(stack[-1], None)
            if c is None:
                stack.pop()
                if open_:
                    yield "out", open_.pop()
            elif isinstance(c, str):
                yield "text", c
            else:
                yield "in", c
                open_.append(c)
                stack.append(iter(c.children))

    def text(self) -> str:
        return "".join(x for what, x in self.events() if what == "text")

    def walk(self) -> Iterator["Node"]:
        return (x for what, x in self.events() if what == "in")


class Tree(HTMLParser):
    """A tolerant tree: an end tag closes up to its start tag, one without a start is passed over.

    A character reference ends in a semicolon; what looks like one and was cut, or is the next parameter of a URL, stays as
    it is. The parser would read its beginning, so there another character, which the page has not, stands for the
    ampersand meanwhile.
    """

    def __init__(self, source: str):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {})
        self.open: Counter[str] = Counter()
        source = source or ""
        self.bare = next(c for c in map(chr, range(0xFDD0, 0x110000)) if c not in source)
        self.feed(AMPERSAND.sub(lambda m: m[0] if m[1] and (m[1][0] == "#" or m[1] in html5) else self.bare + (m[1] or ""), source))
        self.close()

    def whole(self, text: str) -> str:
        return text.replace(self.bare, "&")

    def handle_starttag(self, tag, attrs):
        tag = self.whole(tag)
        node = Node(tag, {self.whole(k): self.whole(v or "") for k, v in attrs}, parent=self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node
            self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        tag = self.whole(tag)
        if not self.open[tag]:
            return
        while True:
            closed, self.at = self.at, self.at.parent
            self.open[closed.tag] -= 1
            if closed.tag == tag:
                return

    def handle_data(self, data):
        self.at.children.append(self.whole(data))


def tokens(node: Node) -> set[str]:
    return set(re.findall(r"[a-z0-9]+", f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}".lower()))


def is_chrome(node: Node) -> bool:
    """SCL-28: furniture by a part of its class, in the case it is written in, or by its attribute."""
    return CHROME_ATTRIBUTE in node.attrs or any(c in node.attrs.get("class", "") for c in CHROME_CLASSES)


def is_furniture(node: Node) -> bool:
    """FLT-12, for images: by element, or by a class or id token unless another token says content."""
    t = tokens(node)
    return node.tag in NO_PROSE or (bool(t & FURNITURE_CLASSES) and not t & CONTENT_CLASSES)


def strip_chrome(root: Node) -> None:
    """SCL-28: take furniture out, and put what emphasis holds in its place."""
    todo = [root]
    while todo:
        node = todo.pop()
        kept, queue = [], list(reversed(node.children))
        while queue:
            c = queue.pop()
            if isinstance(c, str):
                kept.append(c)
            elif is_chrome(c):
                continue
            elif c.tag in EMPHASIS:
                queue += reversed(c.children)
            else:
                c.parent = node
                kept.append(c)
                todo.append(c)
        node.children = kept


def collapsed(text: str) -> str:
    return re.sub(r"\s+", " ", text).strip()


@dataclass
class _Frame:
    """A node being read: its finished blocks (those of the node around it where it adds nothing of its own) and the inline text since."""

    node: Node
    blocks: list[str]
    inline: list[str] = field(default_factory=list)

    def flush(self) -> None:
        if text := collapsed("".join(self.inline)):
            self.blocks.append(text)
        self.inline.clear()


def blocks(root: Node, out: list[str]) -> list[str]:
    """Markdown blocks of a tree in reading order: headings, paragraphs, list items, preformatted text."""
    frames, skipped = [_Frame(root, out)], None
    for what, x in root.events():
        top = frames[-1]
        if skipped is not None:  # inside a link or an image, which are written whole
            skipped = None if what == "out" and x is skipped else skipped
        elif what == "text":
            top.inline.append(x)
        elif what == "in":
            if x.tag == "a":
                href, text = x.attrs.get("href", ""), collapsed(x.text())
                top.inline.append(f"[{text}]({href})" if text and href.startswith(("http://", "https://", "mailto:")) else text)
                skipped = x
            elif x.tag in ("br", "img"):
                src = image_source(x) if x.tag == "img" else ""
                top.inline.append("\n" if x.tag == "br" else f"![{x.attrs.get('alt', '')}]({src})" if src else "")
                skipped = x
            elif x.tag in EMPHASIS or x.tag in INLINE:
                frames.append(_Frame(x, []))
            else:
                top.flush()
                own = re.fullmatch("h[1-6]|li|pre|blockquote", x.tag)
                frames.append(_Frame(x, [] if own else top.blocks))
        else:
            frames.pop()
            around = frames[-1]
            if x.tag in EMPHASIS or x.tag in INLINE:
                if any(isinstance(c, Node) for c in x.children):
                    top.flush()
                    around.inline.append(" ".join(top.blocks))
                else:
                    around.inline.append("".join(top.inline))
                continue
            top.flush()
            if re.fullmatch("h[1-6]", x.tag):
                text = " ".join(top.blocks)
                around.blocks += [f"{'#' * int(x.tag[1])} {text}"] if text else []
            elif x.tag == "li":
                around.blocks += [f"- {' '.join(top.blocks)}"] if top.blocks else []
            elif x.tag == "pre":
                around.blocks.append(x.text().strip("\n"))
            elif x.tag == "blockquote":
                around.blocks += [f"> {b}" for b in top.blocks]
    frames[0].flush()
    return out


def article(source: str, url: str = "") -> dict | None:
    """SCL-29: the main text of a page with its title, author and date, or None under ten characters.

    The main element is the article or main element with most text, else the element whose own paragraphs hold most, less
    half of what they link.
    """
    root = Tree(source).root
    meta = {(n.attrs.get("property") or n.attrs.get("name") or "").lower(): n.attrs.get("content", "") for n in root.walk() if n.tag == "meta"}
    title = meta.get("og:title") or next((collapsed(n.text()) for n in root.walk() if n.tag == "title"), "")
    strip_chrome(root)
    for n in [root, *root.walk()]:
        n.children = [c for c in n.children if isinstance(c, str) or c.tag not in NO_PROSE]
    size = lambda n: len(collapsed(n.text()))
    main = max((n for n in root.walk() if n.tag in ("article", "main")), key=size, default=None)
    if main is None or size(main) < 10:
        scores: dict[int, list] = {}
        for n in root.walk():
            if n.tag == "p" and n.parent:
                linked = sum(size(a) for a in n.walk() if a.tag == "a")
                scores.setdefault(id(n.parent), [n.parent, 0])[1] += size(n) - linked / 2
        main = max(scores.values(), key=lambda x: x[1])[0] if scores else next((n for n in root.walk() if n.tag == "body"), root)
    text = "\n\n".join(b for b in blocks(main, []) if b)
    if len(text.strip()) < 10:
        return None
    return {"title": title, "author": meta.get("author") or meta.get("article:author"), "date": meta.get("article:published_time") or meta.get("date"), "sitename": meta.get("og:site_name"), "text": text}


def without_title(text: Column, title: Column, sitename: Column, url: Column) -> Column:
    """SCL-29: a text less its leading heading, if that repeats the title, with or without the site's name behind it."""
    lead = r"^\n*#{1,6}[ \t]+([^\n]+?)[ \t]*(?:\n|$)"
    same = lambda c: F.lower(collapse(c))
    heading = same(F.regexp_extract(text, lead, 1))
    repeats = F.coalesce(title != "", F.lit(False)) & (heading != "") & ((heading == same(title)) | (heading == same(strip_site_suffix(title, sitename, url))))
    return F.when(repeats, F.regexp_replace(F.regexp_replace(text, lead, ""), r"^\n+", "")).otherwise(text)


def articles(pages: DataFrame, key: str) -> DataFrame:
    """SCL-28, SCL-29: (key, title, author, date, sitename, text) for each page; text is null where there is no article."""
    kind = pages.schema[key].dataType.simpleString()
    names = ["title", "author", "date", "sitename", "text"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [article(h, u) or {} for h, u in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), *[pa.array([g.get(c) for g in got], pa.string()) for c in names]], [key, "_url", *names])

    found = pages.select(key, "html", F.col("url").alias("_url")).mapInArrow(each, f"{key} {kind}, _url string, " + ", ".join(f"{c} string" for c in names))
    return found.withColumn("text", without_title(F.col("text"), F.col("title"), F.col("sitename"), F.col("_url"))).drop("_url")


def image_source(node: Node) -> str:
    """SCL-44: an image's URL, lazy attributes and the first of a srcset before a placeholder src."""
    a = node.attrs
    first = lambda s: s.split(",")[0].strip().split(" ")[0] if s else ""
    return next((v for v in (a.get("data-src"), a.get("data-lazy-src"), a.get("data-original"), first(a.get("data-srcset", "")), first(a.get("srcset", "")), a.get("src")) if v and not v.startswith("data:")), "")


def keeps_image(node: Node, url: str) -> bool:
    """FLT-12: no chrome in its URL, its ancestors or its classes, and no declared side under 100 pixels."""
    at = node
    while at:
        if at.tag in ("nav", "aside", "footer") or (at is not node and is_furniture(at)):
            return False
        at = at.parent
    t = tokens(node)
    sides = [int(m[0]) for k in ("width", "height") if (m := re.match(r"\d+", node.attrs.get(k, "")))]
    return not CHROME_URL.search(url.rsplit("/", 1)[-1]) and not (t & FURNITURE_CLASSES and not t & CONTENT_CLASSES) and all(s >= MIN_PIXELS for s in sides)


def page_images(source: str, url: str) -> list[dict]:
    """SCL-44, JOI-18: the content images of a page in order: absolute URL, alt, caption, the text before it as an anchor."""
    out, before, inside = [], "", []
    for what, x in Tree(source).root.events():
        if what == "in":
            inside.append(x.tag)
        elif what == "out":
            inside.pop()
        elif x.strip() and not (inside and inside[-1] in ("script", "style", "figcaption", "title")):
            before = collapsed(x)
        if what != "in" or x.tag != "img":
            continue
        src = image_source(x)
        if src and keeps_image(x, src):
            fig = x.parent
            while fig and fig.tag != "figure":
                fig = fig.parent
            caption = next((collapsed(n.text()) for n in fig.walk() if n.tag == "figcaption"), None) if fig else None
            out.append({"ord": len(out), "url": urljoin(url or "", src), "alt": x.attrs.get("alt", "").strip() or None, "caption": caption or None, "anchor": before})
    return out


def harvest_images(pages: DataFrame, key: str) -> DataFrame:
    """FLT-12, SCL-44: (key, ord, url, alt, caption, anchor) for each content image of each page."""
    kind = pages.schema[key].dataType.simpleString()
    names = ["ord", "url", "alt", "caption", "anchor"]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, *(i[c] for c in names)) for k, h, u in zip(*(b.column(n).to_pylist() for n in range(3))) for i in page_images(h, u)]
            types = [b.column(0).type, pa.int32(), *[pa.string()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * 6, types)], [key, *names])

    return pages.select(key, "html", "url").mapInArrow(each, f"{key} {kind}, ord int, url string, alt string, caption string, anchor string")


def image_extension(mime: Column, url: Column) -> Column:
    """SCL-44, FLT-15: by the type, else the URL's suffix, else bin."""
    by_type = F.create_map(*[F.lit(x) for kv in {"image/png": "png", "image/jpeg": "jpg", "image/jpg": "jpg", "image/gif": "gif", "image/webp": "webp", "image/svg+xml": "svg", "image/tiff": "tiff"}.items() for x in kv])
    suffix = F.nullif(F.lower(F.regexp_extract(url, r"\.([A-Za-z0-9]+)(?:[?#].*)?$", 1)), F.lit(""))
    return F.coalesce(F.try_element_at(by_type, F.lower(mime)), suffix, F.lit("bin"))


def is_image_file(name: Column) -> Column:
    """FLT-15."""
    return F.coalesce(F.lower(name).rlike(r"\.(jpg|jpeg|png|webp)$"), F.lit(False))


def render_images(body: str, images: list[dict]) -> str:
    """SCL-45: markdown images become annotations with file, alt and caption; a caption that stands below as a line folds in.

    Images that the text lost go behind the line that their anchor names, else to the end.
    """
    note = lambda i: "<!--\nimage:\n" + "".join(f"  {k}: {i[k]}\n" for k in ("file", "alt", "caption") if i.get(k)) + "-->"
    by_url, placed = {i["url"]: i for i in reversed(images)}, set()

    def one(m: re.Match) -> str:
        i = by_url.get(m[1])
        if i is None or m[1] in placed:
            return ""
        placed.add(m[1])
        return note(i)

    body = re.sub(r"!\[[^\]]*\]\(([^)\s]+)[^)]*\)", one, body)
    for i in images:
        if i.get("caption") and i["url"] in placed:
            body = re.sub(r"(?m)^" + re.escape(i["caption"]) + r"\n*", "", body, count=1) if f"\n{i['caption']}\n" in f"\n{body}\n" else body
    lines = body.split("\n")
    squashed = lambda s: re.sub(r"\W+", "", s).lower()
    for i in images:
        if i["url"] in placed:
            continue
        placed.add(i["url"])
        anchor = squashed(i.get("anchor") or "")
        at = next((n for n, x in enumerate(lines) if anchor and anchor in squashed(x) and (len(anchor) >= 40 or 2 * len(anchor) >= len(squashed(x)))), None)
        where = len(lines) if at is None else at + 1
        lines[where:where] = ["", note(i)]
    return re.sub(r"\n{3,}", "\n\n", "\n".join(lines)).strip("\n") + "\n"


def with_images(bodies: DataFrame, images: DataFrame, key: str) -> DataFrame:
    """SCL-45: bodies (key, body) with their images (key, ord, url, file, alt, caption, anchor) rendered in; a page's images are one row's list."""
    kind = bodies.schema[key].dataType.simpleString()
    lists = images.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("ord", "url", "file", "alt", "caption", "anchor"))).alias("images"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [render_images(t or "", i or []) for t, i in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.string())], [key, "body"])

    return bodies.join(lists, key, "left").select(key, "body", "images").mapInArrow(each, f"{key} {kind}, body string")
