"""Main text of web pages by a template deduced from the pages of a host."""

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

from .common import importable, stored

#: Fixed facts of the markup language: elements without an end, inside a line, and of raw or unshown text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr".split()
)
HIDDEN = frozenset("head script style noscript template svg math iframe object canvas audio video title".split())
#: Elements, roles and words of class and id that mark what is not the article.
APART = frozenset("nav header footer aside form button select option textarea dialog menu fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert dialog alertdialog form menu".split())
WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr"
    " notice notices notification popup modal overlay newsletter subscribe signup sidebar widget widgets related"
    " recommended menu nav navbar navigation breadcrumb breadcrumbs masthead header footer comment comments reply replies"
    " respond disqus share sharing social login search toolbar pagination pager copyright skip".split()
)
#: Elements that hold an article by their name.
MAIN = frozenset(("article", "main"))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: A template token stands on at least this share of a host's pages; a container holds this share of the text that is
#: not set apart.
SUPPORT, SHARE = 0.5, 0.8
#: Page counts of hosts are broadcast up to this many (about 20 MB); beyond it they are joined by a shuffle.
BROADCAST_HOSTS = 200_000
#: Elements below so many others count as parts of the one above them, as in browsers.
DEEPEST = 512
#: Elements that hold running text and so are no containers of an article.
TEXTUAL = frozenset("p li ul ol dl dt dd blockquote pre table tbody tr td th".split()) | HEADINGS

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|"
    r"<(?P<raw>script|style|noscript|template|textarea|svg|iframe|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)|"
    r"<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|</?[a-zA-Z][^<>]*\Z",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([^\s=/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_END = re.compile(r"</([a-zA-Z][^\s/>]*)")
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Frame(NamedTuple):
    """An open element: its name, path number and depth, and what its text is in."""

    name: str
    path: int
    depth: int
    apart: bool
    main: bool
    heading_only: bool
    headed: bool
    linked: bool
    inside: bool


class Node(NamedTuple):
    """A run of text: its path, the text, and whether it stands apart, in an article, in a link, in the container."""

    path: int
    text: str
    apart: bool
    main: bool
    linked: bool
    inside: bool


class Path(NamedTuple):
    """An element path: the number of the path above it, and its own name."""

    parent: int
    name: str


ROOT = Frame("", 0, 0, False, False, False, False, False, False)
#: Starting one of these ends an open paragraph or list item of the same kind.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"),
        "option": ("option",)}


def _marked(name: str, rest: str) -> tuple[str, bool]:
    """A label of the element for its path (name, and first class or else id), and whether its marks set it apart."""
    if "=" not in rest and "hidden" not in rest:
        return name, name in APART
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(rest)}
    marks = f"{found.get('class', '')} {found.get('id', '')}"
    words = {w.lower() for w in _NAME_PARTS.findall(marks)}
    style = found.get("style", "").replace(" ", "").lower()
    apart = (
        name in APART or bool(words & WORDS) and name not in ("html", "body", *HEADINGS)
        or found.get("role", "").lower() in ROLES or found.get("aria-hidden") == "true"
        or "display:none" in style or bool(re.search(r"(?:^|\s)hidden(?:\s|$)", re.sub(_ATTRIBUTE, " ", rest)))
    )
    first = (found.get("class") or found.get("id") or "").split()[:1]
    return f"{name}.{first[0]}" if first else name, apart


def numbered(parent: int, label: str) -> int:
    """The number of a path, the same on every page: a hash of the number above it and the element's label."""
    return xxhash.xxh3_64_intdigest(f"{parent}/{label}".encode()) - (1 << 63)


def parse(page: str, container: int | None = None) -> tuple[Counter[int], dict[int, Path], list[Node]]:
    """Occurrences and names of the element paths, and the text nodes in page order. Blocks end with a node of one blank.

    Time and memory grow with the page, however deep it is nested: a path is a number, and what an element's text is in
    is known from the element above it.
    """
    counts: Counter[int] = Counter()
    paths: dict[int, Path] = {}
    known: dict[tuple[int, str], int] = {}
    nodes: list[Node] = []
    stack = [ROOT]
    opened: Counter[str] = Counter()
    at = 0
    ends = {m[1].lower(): m.start() for m in _END.finditer(page)}  # the last end tag of each element name

    def text(to: int) -> None:
        if to > at:
            top = stack[-1]
            apart = top.apart or top.heading_only and not top.headed
            nodes.append(Node(top.path, html.unescape(page[at:to]), apart, top.main, top.linked, top.inside))

    def drop(to: int) -> None:
        opened.subtract(f.name for f in stack[to:])
        del stack[to:]

    def close(names: tuple[str, ...], stop: frozenset[str]) -> None:
        if not any(opened[name] for name in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].name in names:
                drop(k)
                return
            if stack[k].name in stop:
                return

    for m in _TOKEN.finditer(page):
        text(m.start())
        at = m.end()
        name = (m["name"] or "").lower()
        if not name:
            continue
        top = stack[-1]
        if name not in INLINE and (not nodes or nodes[-1].text != " " or nodes[-1].path != top.path):
            nodes.append(Node(top.path, " ", top.apart, top.main, False, top.inside))
        if m["end"]:
            close((name,), frozenset())
            continue
        if name in MAIN:
            # An article begins: what was set apart and never closed ends here, except a list of comments.
            while len(stack) > 1 and stack[-1].apart and ends.get(stack[-1].name, -1) < at:
                drop(len(stack) - 1)
        if name not in INLINE and name not in VOID:
            close(ENDS.get(name, ("p",)), frozenset(("table", "ul", "ol", "dl", "div", "section", *MAIN)))
        label, apart = _marked(name, m["rest"] or "")
        top = stack[-1]
        header = name == "header" and top.main
        path = top.path
        if name not in INLINE and top.depth < DEEPEST:
            path = known.get((top.path, label))
            if path is None:
                path = known[top.path, label] = numbered(top.path, label)
                paths[path] = Path(top.path, name)
            counts[path] += 1
        if name not in VOID and not (m["rest"] or "").endswith("/"):
            opened[name] += 1
            stack.append(Frame(
                name, path, top.depth + 1, top.apart or name in HIDDEN or apart and not header, top.main or name in MAIN,
                top.heading_only or header, top.headed or name in HEADINGS, top.linked or name == "a",
                top.inside or path == container,
            ))
    text(len(page))
    return counts, paths, nodes


def joined(nodes: list[Node]) -> str:
    return " ".join("".join(n.text for n in nodes).split())


def blocks(nodes: list[Node]) -> Iterator[tuple[int | None, list[Node]]]:
    """The blocks of text that nothing sets apart: the number of each block's text in its path (None: blank), its nodes."""
    block: list[Node] = []
    for n in [*nodes, Node(0, " ", False, False, False, False)]:
        block.append(n)
        if n.text == " ":
            shown = [k for k in block[:-1] if not k.apart]
            line = joined(shown)
            yield numbered(shown[-1].path, f"#{line}") if line else None, block
            block = []


def tokens(pages: DataFrame) -> DataFrame:
    """(host, page_id, token, parent, name, n, chars, links): occurrences of template token candidates on each page.

    Tokens are element paths and blocks of text (name `#`), by number. `chars` and `links` are the characters of text
    right in the elements of a path that are not set apart, and those of them in links.
    """

    def one(page: str) -> dict[int, list]:
        counts, paths, nodes = parse(page)
        found = {t: [*paths[t], n, 0, 0] for t, n in counts.items()}
        for n in nodes:
            if not n.apart and n.text != " " and n.path in found:
                size = len(n.text.strip())
                found[n.path][3] += size
                found[n.path][4] += size * n.linked
        for token, block in blocks(nodes):
            if token is not None:
                found.setdefault(token, [block[0].path, "#", 0, 0, 0])[2] += 1
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, page in enumerate(b.column(2).to_pylist()):
                found = one(page or "")
                take = pa.array([i] * len(found), pa.int64())
                parent, name, n, chars, links = zip(*found.values(), strict=True) if found else ((),) * 5
                yield pa.RecordBatch.from_arrays([
                    b.column(0).take(take), b.column(1).take(take), pa.array(list(found), pa.int64()),
                    pa.array(parent, pa.int64()), pa.array(name, pa.string()),
                    *(pa.array(x, pa.int64()) for x in (n, chars, links)),
                ], ["host", "page_id", "token", "parent", "name", "n", "chars", "links"])

    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"host string, page_id {kind}, token long, parent long, name string, n long, chars long, links long"
    return pages.mapInArrow(run, schema)


def templates(pages: DataFrame) -> DataFrame:
    """(host, container, constants): what the tokens of a host's pages say about its template.

    Tokens with the same vector of occurrences over all pages of the host form an equivalence class; a vector is known
    by its number of pages and the sum of a hash of page and count, which folds map-side over any number of pages. A
    class counts if it stands on SUPPORT of the pages. The class that occurs exactly once on every page is the frame;
    paths nest in it as elements do. Text in the frame is part of the template, in articles as well; the rest of its
    slots hold what differs. The container is the innermost path of the frame that holds SHARE of the text outside parts
    set apart, lists of links left out. One page alone has no template.
    """
    found = stored(tokens(pages))
    # A page's fingerprint has its row in it: repeated rows of one page are pages of their own.
    sizes = stored(pages.groupBy("host").agg(F.count("*").alias("pages")))
    # Few hosts are broadcast, so that the tokens of a large host stay dealt over tasks until few are left.
    side = F.broadcast(sizes) if sizes.count() <= BROADCAST_HOSTS else sizes
    folded = found.groupBy("host", "token", "parent", "name").agg(
        F.count("*").alias("on"), F.sum("n").alias("n"), F.min("n").alias("least"), F.max("n").alias("most"),
        F.sum(F.xxhash64("page_id", "n").cast("decimal(38,0)")).alias("vector"),
        F.sum("chars").alias("chars"), F.sum("links").alias("links"),
    )
    # Of the blocks of text only those of the frame matter; paths also say where the text of the slots is.
    due = F.when(F.col("name") == "#", F.col("on") == F.col("pages")).otherwise(F.col("on") >= SUPPORT * F.col("pages"))
    usual = folded.join(side, "host").where((F.col("pages") > 1) & due)
    classes = usual.groupBy("host", "pages", "on", "vector", "least", "most").agg(
        F.collect_list(F.struct("token", "parent", "name", "chars", "links")).alias("members")
    )
    listed = classes.groupBy("host", "pages").agg(F.collect_list(F.struct("on", "least", "most", "members")).alias("classes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [deduce(n, c) for n, c in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([m[0] for m in made], pa.int64()), pa.array([m[1] for m in made], pa.list_(pa.int64())),
            ], ["host", "container", "constants"])

    return listed.mapInArrow(run, "host string, container long, constants array<long>")


def deduce(pages: int, classes: list[dict]) -> tuple[int | None, list[int]]:
    """The container path (None: no path holds enough) and the constant text of a host."""
    frame = [c for c in classes if c["on"] == pages and c["least"] == c["most"] == 1]
    constants = [m["token"] for c in frame for m in c["members"] if m["name"] == "#"]
    members = {m["token"]: m for c in classes for m in c["members"] if m["name"] != "#"}
    held: Counter[int] = Counter()
    total = 0
    for m in members.values():
        if m["chars"] and 2 * m["links"] <= m["chars"]:
            total += m["chars"]
            above = m
            while above is not None:  # a path stands on every page that its parts stand on, so the chain is whole
                held[above["token"]] += m["chars"]
                above = members.get(above["parent"])

    def depth(token: int) -> int:
        steps = 0
        while token in members:
            token, steps = members[token]["parent"], steps + 1
        return steps

    once = {m["token"] for c in frame for m in c["members"]}
    able = [t for t, n in held.items() if t in once and n > SHARE * total and members[t]["name"] not in TEXTUAL]
    return (max(able, key=depth) if able else None), constants


def extract_one(page: str, container: int | None, constants: frozenset[int]) -> str:
    """The main text of a page.

    The template is asked first: its constant text goes, and of the rest what stands in its container stays. Marks decide
    where it does not: an article inside the container, or on a page without it, is the text; without either, all that
    nothing sets apart. If all text is constant, the pages are copies of one another, and nothing of it is template.
    """
    _, _, nodes = parse(page, container)
    shown = [n for n in nodes if not n.apart]
    slots = [n for t, block in blocks(nodes) if t not in constants for n in block if not n.apart] if constants else shown
    for rest in (slots, shown):
        inside = [n for n in rest if n.inside]
        for part in ([n for n in inside if n.main], [n for n in rest if n.main], inside, rest):
            found = joined(part)
            if found:
                return found
    return ""


def extract(pages: DataFrame) -> DataFrame:
    """The main text of every page: page_id, url, text and n_chars.

    Pages are grouped by the host of their url (null or no host: a group of its own). A null or empty page has empty
    text. Repeated rows and null ids are pages like others. An empty table gives no rows. Templates are one row per
    host; the join to the pages is a broadcast while their table is small, else a sort join that AQE splits by host.
    """
    importable(pages)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    read = pages.select(host.alias("host"), "page_id", "html", "url")
    known = stored(templates(read.select("host", "page_id", "html")))
    named = known.withColumnRenamed("host", "_host")
    placed = read.join(named, F.col("host") == F.col("_host"), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*[b.column(k).to_pylist() for k in (2, 3, 4)], strict=True)
            texts = [extract_one(page or "", container, frozenset(constants or ())) for page, container, constants in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    columns = placed.select("page_id", "url", "html", "container", "constants")
    return columns.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
