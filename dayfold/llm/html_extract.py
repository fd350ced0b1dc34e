"""Main texts of web pages by wrapper induction over the pages of a host."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dayfold.llm.tables import Scratch, known_text, need

# Fixed values of the markup language: elements without an end tag, elements whose content is not
# markup, elements that start a block of text, and what closes an element left open.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noembed noframes".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr output q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr".split()
)
CLOSED_BY = {
    "p": frozenset(
        "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 "
        "h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
    ),
    "li": frozenset({"li"}),
    "dt": frozenset({"dt", "dd"}),
    "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr", "tbody", "tfoot", "thead"}),
    "td": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "th": frozenset({"td", "th", "tr", "tbody", "tfoot"}),
    "thead": frozenset({"tbody", "tfoot"}),
    "tbody": frozenset({"tbody", "tfoot"}),
    "option": frozenset({"option", "optgroup"}),
}
# What an end tag of an inner element does not reach beyond.
SCOPES = frozenset("table td th caption html body article section main div ul ol dl".split())

# Elements, roles and words of class and id names that mark what is not the article.
BOILER_TAGS = frozenset(
    "head nav header footer aside form script style noscript template iframe button select input textarea menu dialog "
    "svg canvas object embed audio video title option datalist".split()
)
BOILER_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
BOILER_WORDS = frozenset(
    "ad ads adv advert advertisement advertising sponsor sponsored promo banner nav navbar navigation menu breadcrumb "
    "breadcrumbs header masthead footer sidebar aside widget related share sharing social comment comments reply replies "
    "disqus cookie cookies consent notice gdpr popup modal overlay newsletter subscribe subscription login signup search "
    "pagination pager toolbar copyright thread".split()
)
# Words that may stand beside them in one class or id name without changing what it says ...
PLAIN_WORDS = frozenset(
    "site page main top bottom left right box bar block list lists link links container wrapper inner outer section area "
    "global item items icon icons button buttons group panel slot unit zone text small mobile desktop sticky primary "
    "secondary user reader content form row col column".split()
)
# ... and these only beside what is about an article and not in it.
ABOUT_ARTICLES = frozenset("article entry post posts story".split())
AROUND_WORDS = frozenset(
    "ad ads advert promo banner nav navigation related share sharing social comment comments reply replies newsletter "
    "subscribe pagination pager".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ARTICLE_TAGS = frozenset({"article", "main"})
ARTICLE_WORDS = frozenset({"article", "content", "post", "entry", "story", "main", "body"})

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    # A tag with an odd quote ends at the next bracket, one that never ends takes the rest.
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
# Elements nested deeper than this count as children of the last one above, as in browsers.
DEEPEST = 200
NAME = re.compile(r"[^a-z0-9:-]+")
ATTRIBUTE = re.compile(r"([^\s=\"'/>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
SPACES = re.compile(r"\s+")


@dataclass(slots=True)
class Node:
    """An element, or a run of text if ``tag`` is empty; ``at`` is its place among its parent's shapes."""

    tag: str
    label: str = ""
    text: str = ""
    children: list[Node] = field(default_factory=list)
    at: int = -1


def _label(tag: str, attributes: str) -> str:
    """Tag, class and role of an element: what has to agree for two nodes to match."""
    if not attributes.strip():
        return tag
    out = tag
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id", "role"):
            value = entities.unescape(value.strip("\"'")).lower()
            names = {"-".join(re.findall(r"[^\W\d_]+", own)) for own in value.split()} - {""}
            out += f" {name}" + "".join(f".{own}" for own in sorted(names))
        elif name == "hidden" or (name == "style" and re.search(r"display\s*:\s*none", value, re.I)):
            out += " hidden"
    return out


def parse(page: str) -> Node:
    """The element tree of a page; never fails, as browsers do not."""
    root = Node("page", "page")
    stack = [root]
    at, end = 0, len(page)
    while at < end:
        low = page.find("<", at)
        found = TAG.match(page, low) if low >= 0 else None
        while low >= 0 and found is None:
            low = page.find("<", low + 1)
            found = TAG.match(page, low) if low >= 0 else None
        text = page[at : low if low >= 0 else end]
        if text:
            stack[-1].children.append(Node("", "", entities.unescape(text)))
        if found is None:
            break
        at = found.end()
        cdata, *strict = found.groups()
        closing, name, attributes = strict[:3] if strict[1] else strict[3:]
        if cdata:
            stack[-1].children.append(Node("", "", cdata))
        if not name:
            continue
        tag = NAME.sub("", name.lower()) or "x"
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
                if stack[depth].tag in SCOPES and tag not in SCOPES:
                    break
            continue
        for depth in range(len(stack) - 1, 0, -1):
            own = stack[depth].tag
            if tag in CLOSED_BY.get(own, ()):
                del stack[depth:]
            elif own in SCOPES or own in CLOSED_BY and own != "p":
                break
        node = Node(tag, _label(tag, attributes))
        stack[-1].children.append(node)
        if tag in VOID or attributes.rstrip().endswith("/") and tag not in INLINE and tag not in CLOSED_BY:
            continue
        if tag in RAW or tag == "xmp":
            close = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            if tag == "xmp":  # its text is shown as it is
                node.children.append(Node("", "", page[at : close.start() if close else end]))
            at = close.end() if close else end
            continue
        if len(stack) < DEEPEST:
            stack.append(node)
    return root


def _words_of(label: str) -> tuple[str, list[frozenset[str]], set[str]]:
    """Tag, the words of each class and id name, and the roles."""
    tag, *marks = label.split(" ")
    names: list[frozenset[str]] = []
    roles = {"hidden"} & set(marks)
    for mark in marks:
        kind, *own = mark.split(".")
        if kind == "role":
            roles.update(w for name in own for w in name.split("-"))
        else:
            names += [frozenset(name.split("-")) for name in own]
    return tag, names, roles


@lru_cache(maxsize=100_000)
def is_boiler(label: str) -> bool:
    """Whether the markup itself says that an element is not part of the article.

    A class or id says so if all its words do or are plain: ``site-footer`` is a footer, but ``has-sidebar``,
    ``related-work`` and ``copyright-law`` say something else. Headings are not judged by their names.
    """
    tag, names, roles = _words_of(label)
    if tag in BOILER_TAGS or roles & BOILER_ROLES or "hidden" in roles:
        return True
    if tag in ("body", "html", *ARTICLE_TAGS, *HEADINGS):
        return False
    return any(
        name & BOILER_WORDS
        and (
            name <= BOILER_WORDS | PLAIN_WORDS
            or (name & AROUND_WORDS and name <= BOILER_WORDS | PLAIN_WORDS | ABOUT_ARTICLES)
        )
        for name in names
    )


@lru_cache(maxsize=100_000)
def is_article(label: str) -> bool:
    tag, names, _ = _words_of(label)
    return tag in ARTICLE_TAGS or any(n & ARTICLE_WORDS for n in names) and tag in ("div", "section", "td")


# A skeleton: label and the skeletons of the child elements, repeats of equal neighbours left out.
Skeleton = tuple[str, tuple]


def skeleton(node: Node) -> Skeleton:
    """The block structure of a page, in which equal neighbours, also taking turns with one other kind, count once."""
    shapes: list[Skeleton] = []
    for child in node.children:
        if child.tag and child.tag not in INLINE and child.tag not in VOID:
            own = skeleton(child)
            if own in shapes[-2:]:
                child.at = len(shapes) - 1 - (shapes[-1] != own)
            else:
                child.at = len(shapes)
                shapes.append(own)
    return (node.label, tuple(shapes))


def written(tree: Skeleton) -> str:
    return tree[0] + ("(" + ",".join(written(c) for c in tree[1]) + ")" if tree[1] else "")


def read_skeleton(text: str) -> Skeleton:
    """The inverse of :func:`written`."""
    stack: list[tuple[str, list]] = [("", [])]
    for token in re.findall(r"[(),]|[^(),]+", text):
        if token == "(":
            stack.append((stack[-1][1].pop()[0], []))
        elif token == ")":
            label, children = stack.pop()
            stack[-1][1].append((label, tuple(children)))
        elif token != ",":
            stack[-1][1].append((token, ()))
    return stack[0][1][0] if stack[0][1] else ("", ())


# Steps of one alignment of siblings that keeps its whole table; longer rows are halved.
MOST_CELLS = 250_000


def align_rows(xs: tuple, ys: tuple, size: Callable[[Skeleton, Skeleton], int]) -> tuple[int, tuple[tuple[int, int], ...]]:
    """The best match of two long rows of siblings, and the pairs of places in it, in memory for a few rows only.

    Equal ends are matched at once, which is never worse. What is left is halved (Hirschberg): the one row in its middle, the
    other at the best place, by the sums of the best matches before and after; and each half likewise.
    """
    by_label: dict[str, dict[Skeleton, list[int]]] = {}
    for n, y in enumerate(ys):
        by_label.setdefault(y[0], {}).setdefault(y, []).append(n)
    labelled = {label: [(y, np.array(own)) for y, own in kinds.items()] for label, kinds in by_label.items()}
    # Only siblings of a label that both rows have can match.
    kept = [n for n, x in enumerate(xs) if x[0] in labelled]

    ids: dict[Skeleton, int] = {}
    kinds = [ids.setdefault(x, len(ids)) for x in xs]
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    held = 0

    def sizes(row: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of the second row that match one of the first, rising, and the sizes of the matches."""
        nonlocal held
        if kinds[row] in known:
            return known[kinds[row]]
        x = xs[row]
        places = np.concatenate([own for _, own in labelled[x[0]]])
        values = np.concatenate([np.full(len(own), size(x, y), dtype="int64") for y, own in labelled[x[0]]])
        order = np.argsort(places)
        found = places[order], values[order]
        # Kept within some memory, and else made again.
        if held + len(places) <= 16 * MOST_CELLS:
            held += len(places)
            known[kinds[row]] = found
        return found

    def totals(rows: list[int], first: int, last: int, backwards: bool) -> np.ndarray:
        """Best matches of ``rows`` with each number of siblings from one end of first..last of the second row."""
        best = np.zeros(last - first + 1, dtype="int64")
        for row in reversed(rows) if backwards else rows:
            places, values = sizes(row)
            some = slice(*places.searchsorted((first, last)))
            places, values = places[some] - first, values[some]
            if backwards:
                places, values = last - first - 1 - places[::-1], values[::-1]
            if len(places) > 4:
                best[places + 1] = np.maximum(best[places + 1], best[places] + values)
                np.maximum.accumulate(best, out=best)
                continue
            # The last place first, as each raises what is behind it.
            for place, value in zip(places[::-1].tolist(), values[::-1].tolist()):
                total = best[place] + value
                best[place + 1 : max(best.searchsorted(total), place + 1)] = total
        return best

    pairs: list[tuple[int, int]] = []
    todo = [(0, len(kept), 0, len(ys))]
    while todo:
        top, bottom, first, last = todo.pop()
        while top < bottom and first < last and xs[kept[top]] == ys[first]:
            pairs.append((kept[top], first))
            top, first = top + 1, first + 1
        while top < bottom and first < last and xs[kept[bottom - 1]] == ys[last - 1]:
            bottom, last = bottom - 1, last - 1
            pairs.append((kept[bottom], last))
        if top == bottom or first == last:
            continue
        if bottom - top == 1:
            places, values = sizes(kept[top])
            some = slice(*places.searchsorted((first, last)))
            if len(places[some]):
                pairs.append((kept[top], int(places[some][np.argmax(values[some])])))
            continue
        middle = (top + bottom) // 2
        before = totals(kept[top:middle], first, last, False)
        after = totals(kept[middle:bottom], first, last, True)[::-1]
        cut = first + int(np.argmax(before + after))
        todo += [(top, middle, first, cut), (middle, bottom, cut, last)]
    return sum(size(xs[m], ys[n]) for m, n in pairs), tuple(sorted(pairs))


def tree_match(a: Skeleton, b: Skeleton) -> tuple[int, list[tuple[tuple[int, ...], tuple[int, ...]]]]:
    """Simple tree matching: the size of the largest order-keeping match and its pairs of paths.

    Roots match if their labels are equal; the children of matched nodes are aligned by
    dynamic programming over the sizes of their own matches. Where both have so many children that its table
    would have more than ``MOST_CELLS`` cells, the same is done by halves (:func:`align_rows`).
    """

    @lru_cache(maxsize=1_000_000)
    def size(x: Skeleton, y: Skeleton) -> int:
        return 0 if x[0] != y[0] else 1 + aligned(x[1], y[1])[0]

    @lru_cache(maxsize=None)
    def aligned(xs: tuple, ys: tuple) -> tuple[int, tuple[tuple[int, int], ...]]:
        """The best match of two rows of siblings, and the pairs of places in it."""
        if len(xs) * len(ys) > MOST_CELLS:
            return align_rows(xs, ys, size)
        rows = [[0] * (len(ys) + 1)]
        for x in xs:
            above, row = rows[-1], [0]
            for j, y in enumerate(ys):
                row.append(max(row[-1], above[j + 1], above[j] + size(x, y)))
            rows.append(row)
        places, i, j = [], len(xs), len(ys)
        while i and j:
            own = size(xs[i - 1], ys[j - 1])
            if own and rows[i][j] == rows[i - 1][j - 1] + own:
                i, j = i - 1, j - 1
                places.append((i, j))
            elif rows[i][j] == rows[i - 1][j]:
                i -= 1
            else:
                j -= 1
        return rows[-1][-1], tuple(places[::-1])

    pairs: list = []

    def collect(x: Skeleton, y: Skeleton, px: tuple, py: tuple) -> None:
        pairs.append((px, py))
        for i, j in aligned(x[1], y[1])[1]:
            collect(x[1][i], y[1][j], (*px, i), (*py, j))

    if a[0] != b[0]:
        return 0, []
    collect(a, b, (), ())
    return size(a, b), pairs


@lru_cache(maxsize=20_000)
def aligned_paths(reference: str, page: str) -> dict[str, str]:
    """Paths of a page's skeleton that match the reference's, with those they match."""
    _, pairs = tree_match(read_skeleton(reference), read_skeleton(page))
    return {_path(theirs): _path(ours) for ours, theirs in pairs}


def _path(path: tuple[int, ...]) -> str:
    return "/".join(map(str, path))


@dataclass(slots=True)
class Block:
    path: tuple[int, ...]
    text: str
    boiler: bool
    region: int  # 3 in an article element, 2 in a main one, 1 in one named like it, 0 elsewhere


def _region(label: str) -> int:
    tag = label.split(" ", 1)[0]
    return 3 if tag == "article" else 2 if tag == "main" else int(is_article(label))


def blocks_of(page: Node) -> list[Block]:
    """The text blocks in page order, after :func:`skeleton` has placed the nodes."""
    out: list[Block] = []
    pending: list[str] = []

    def flush(path: tuple, boiler: bool, region: int) -> None:
        text = SPACES.sub(" ", "".join(pending)).strip()
        pending.clear()
        if text:
            out.append(Block(path, text, boiler, region))

    def walk(node: Node, path: tuple, boiler: bool, region: int) -> None:
        for child in node.children:
            if not child.tag:
                pending.append(child.text)
            elif child.tag in VOID or child.tag in RAW:
                if child.tag != "wbr" and (child.tag in ("br", "hr") or child.tag in RAW):
                    flush(path, boiler, region)
            elif child.tag in INLINE and not is_boiler(child.label):
                walk(child, path, boiler, region)
            else:
                flush(path, boiler, region)
                below = (*path, child.at) if child.at >= 0 else path
                inner = boiler or is_boiler(child.label), max(region, _region(child.label))
                walk(child, below, *inner)
                flush(below, *inner)

    walk(page, (), False, 0)
    flush((), False, 0)
    return out


def article_blocks(blocks: list[Block]) -> list[Block]:
    """Blocks that the markup does not exclude, of its article regions if these hold a quarter of their text or more.

    Smaller regions are teasers, or name a part of an article that has no region of its own.
    """
    left = [b for b in blocks if not b.boiler]
    inside = [b for b in left if b.region]
    chars = sum(len(b.text) for b in inside)
    return inside if chars and 4 * chars >= sum(len(b.text) for b in left) else left


def align_to_best(references: list[str], shape: str) -> list[tuple[str, str]]:
    """Paths of a skeleton with the slots they match: number and path of the reference that matches most of it."""
    best = max(range(len(references)), key=lambda n: (len(aligned_paths(references[n], shape)), -n))
    return [(path, f"{best}:{slot}") for path, slot in aligned_paths(references[best], shape).items()]


def extract_pages(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    least_pages: int = 3,
    least_share: float = 0.5,
    references: int = 8,
) -> DataFrame:
    """The main text of every page, by the wrappers of its host.

    Each page is parsed once into blocks and a skeleton: its tree of block elements, with repeated
    neighbours counted once. The most frequent skeletons of a host are its references (up to ``references``, each with a tenth of
    its pages at least, the first in any case), and every skeleton of the host is aligned to the one it matches best, by
    simple tree matching. The nodes of a reference are slots, and what texts stand in a slot is counted over all pages
    of the host, each different page once. A text that ``least_pages`` pages or more, and ``least_share`` of those with the slot,
    have in it is template; other texts are content, also beside template texts in one slot. A page that is nothing but
    template is left as it is.

    What the markup itself marks as no article (navigation, footers, forms, adverts, comments and so on) varies between
    pages like content does and is left out by its names (:func:`is_boiler`); on pages with article regions other text goes
    too (:func:`article_blocks`).

    Pages of a host are never gathered: counts are combined in map tasks, and alignment sees one
    row per host and skeleton. NULL urls share one nameless host.

    Returns per page the id, url, ``text`` (blocks in page order joined by one blank, white space in a
    block turned into one, character references decoded) and ``n_chars``. NULL and empty html give empty text. Repeated rows
    are extracted each; other columns are ignored; an empty table gives no rows.
    """
    need(pages, [id_col, url_col, html_col])
    scratch = Scratch(pages.sparkSession, "pages")
    host = F.lower(F.regexp_extract(known_text(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    given = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).alias("url"), host.alias("host"), known_text(html_col).alias("html")
    )

    def parse_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pa.list_(pa.struct([("path", pa.string()), ("text", pa.string())]))
        for batch in batches:
            shapes, found = [], []
            for page in batch.column(3).to_pylist():
                tree = parse(page)
                shapes.append(written(skeleton(tree)))
                found.append([{"path": _path(b.path), "text": b.text} for b in article_blocks(blocks_of(tree))])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(shapes, pa.string()), pa.array(found, block)],
                names=["id", "url", "host", "shape", "blocks"],
            )

    id_type = given.schema["id"].dataType.simpleString()
    block_type = "array<struct<path:string,text:string>>"
    parsed = scratch.write(
        given.mapInArrow(parse_all, f"id {id_type}, url string, host string, shape string, blocks {block_type}")
        .withColumn("form", F.xxhash64("shape"))
        .withColumn("whole", F.xxhash64(F.transform("blocks", lambda b: b["text"])))
    )

    # Each different page text of a form counts once.
    different = parsed.groupBy("host", "form", "whole").agg(F.min("shape").alias("shape"))
    forms = scratch.write(
        different.groupBy("host", "form").agg(F.count(F.lit(1)).alias("n"), F.min("shape").alias("shape"))
    )
    nth = F.row_number().over(Window.partitionBy("host").orderBy(F.desc("n"), F.desc("shape")))
    frequent = forms.withColumn("nth", nth).where(F.col("nth") <= references)
    totals = forms.groupBy("host").agg(F.sum("n").alias("pages")).where(F.col("pages") >= least_pages)
    hosts = (
        frequent.join(totals, "host")
        .where((F.col("nth") == 1) | (10 * F.col("n") >= F.col("pages")))
        .groupBy("host")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("nth", "shape"))), lambda r: r["shape"]).alias("references"))
    )

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column(3).to_pylist()
            found = [align_to_best(refs, shape) for shape, refs in zip(listed, batch.column(4).to_pylist())]
            lengths = [len(f) for f in found]
            rows = pa.array([n for n, length in enumerate(lengths) for _ in range(length)], pa.int64())
            columns = [batch.column(n).take(rows) for n in range(3)]
            sides = zip(*[pair for f in found for pair in f]) if sum(lengths) else ((), ())
            yield pa.RecordBatch.from_arrays(
                [*columns, *[pa.array(side, pa.string()) for side in sides]], names=["host", "form", "n", "path", "slot"]
            )

    slots = scratch.write(
        forms.join(scratch.write(hosts), "host")
        .select("host", "form", "n", "shape", "references")
        .mapInArrow(align, "host string, form bigint, n bigint, path string, slot string")
    )
    own = F.array_distinct(F.transform("blocks", lambda b: F.struct(b["path"].alias("path"), F.xxhash64(b["text"]).alias("hash"))))
    texts = (
        parsed.select("host", "form", "whole", F.explode(own).alias("block"))
        .select("host", "form", "whole", "block.*")
        .distinct()
        .groupBy("host", "form", "path", "hash")
        .agg(F.count(F.lit(1)).alias("with_text"))
    )
    placed = scratch.write(texts.join(slots.drop("n"), ["host", "form", "path"]))
    with_slot = slots.groupBy("host", "slot").agg(F.sum("n").alias("with_slot"))
    template = (
        placed.groupBy("host", "slot", "hash")
        .agg(F.sum("with_text").alias("with_text"))
        .where(F.col("with_text") >= least_pages)
        .join(with_slot, ["host", "slot"])
        .where(F.col("with_text") >= least_share * F.col("with_slot"))
        .select("host", "slot", "hash")
    )
    wrappers = scratch.write(
        placed.join(template, ["host", "slot", "hash"], "left_semi")
        .groupBy("host", "form")
        .agg(F.collect_set(F.struct("path", "hash")).alias("template"))
    )
    in_template = lambda b: F.coalesce(
        F.array_contains("template", F.struct(b["path"].alias("path"), F.xxhash64(b["text"]).alias("hash"))), F.lit(False)
    )
    kept = F.filter("blocks", lambda b: ~in_template(b))
    joined = parsed.join(wrappers, ["host", "form"], "left").withColumn("kept", kept)
    blocks = F.when(F.size("kept") > 0, F.col("kept")).otherwise(F.col("blocks"))
    out = joined.select("id", "url", F.array_join(F.transform(blocks, lambda b: b["text"]), " ").alias("text"))
    return out.select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("bigint").alias("n_chars")
    )
