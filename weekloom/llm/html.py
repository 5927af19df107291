"""Main text of web pages by wrapper induction over the pages of a host.

Pages become small DOM trees of blocks; siblings of one shape that follow each other are
one repeated node. The trees of a host are aligned by simple tree matching into a wrapper:
a node whose own text is the same on all pages that have it is template, one whose text
varies is a slot. Wrappers merge in any number of steps, so a host with a third of all
pages is merged in parts, and parts of parts, never in one group: a task folds its pages
per host, and rounds of at most ``FAN_IN`` partial wrappers follow.

A page is aligned with its host's wrapper from the root down. The main slot are all the
elements of the lowest wrapper node outside of which nothing on the page is text of its
own: what stays outside is a menu, header, footer, sidebar, notice, advert, form or comment
by its tag, role or class, or says the same on the pages that have it. A container whose
text is fixed but for a field of less than a third ("Read our ... page") says the same in
that sense. An ``article`` or ``main`` with most of a page's text is the slot as it stands.
The text of a page is that of the blocks under its slot, without such parts and without
containers that are template on three or more different pages; copies of a page count as one.
A page that has no slot is read by the same rules alone.

Blocks keep page order. Null and empty pages have empty text. Repeated rows each get a
row, a null url is a host of its own, an empty table gives no rows, other columns are
ignored. Nothing is cut: text is as long as the page's.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterable, Iterator
from hashlib import blake2b
from html import unescape
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weekloom.llm.common import long_rows, pick
from weekloom.sources.staging import stage

FAN_IN = 32
#: Wrappers a task holds before it gives its parts out.
HELD = 2_000
#: Characters of wrappers that are sent to every task.
BROADCAST = 8 << 20
#: Children of a wrapper node. Beyond them, those that the fewest different pages have go,
#: and are matched by the rules alone; a node that is template on its host stays.
WIDTH = 128
#: Levels of a page's tree. Elements nested deeper lie side by side in page order on the
#: last level; what was inside boilerplate stays marked as such.
DEPTH = 120

# The elements of HTML that these rules rest on.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol option p pre section select summary table tbody td tfoot th thead title tr ul".split()
)
DROPPED = frozenset(
    "head script style textarea title noscript template iframe svg math nav footer aside form "
    "button select menu dialog object canvas audio video".split()
)
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar form".split()
)
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising banner banners bottombar "
    "breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer "
    "footers gdpr masthead menu menus modal nav navbar navigation newsletter notification "
    "notifications overlay pager pagination popup popups promo promos promoted promotion "
    "recommended replies share sharing sidebar sidebars signup social sponsor sponsored "
    "subscribe subscription toolbar topbar".split()
)
#: Words that mean boilerplate only as a whole class or id.
WHOLE_NOISE = frozenset(
    "discussion header hidden login notice notices related reply respond search site-header "
    "page-header skip tags warning widget widgets".split()
)
#: A class such as ``with-sidebar`` speaks of what is inside.
ABOUT = frozenset("has have with no without is show hide".split())
CLOSED_BY = {
    "p": BLOCKS, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "tbody", "tfoot", "thead"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"}, "head": {"body", "article", "div", "main", "nav", "header"},
}
#: Different pages that make a container template.
TEMPLATE_PAGES = 3
CONTAINERS = frozenset("div section ul ol dl table details address fieldset figure".split())
#: What a main slot may be; tables, lists and quotes are content as they stand.
LAYOUT = frozenset("html body div section center article main".split())
#: Characters kept of the start and the end that texts share.
FIXED = 64
_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|$|(?=[\"']))", re.S
)
_ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""", re.I)
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[a-z]+")


class Node:
    """An element: tag, its class words, children, and the text runs right inside it."""

    __slots__ = ("tag", "marks", "items")

    def __init__(self, tag: str, marks: str = "") -> None:
        self.tag, self.marks, self.items = tag, marks, []

    @property
    def children(self) -> list[Node]:
        return [x for x in self.items if isinstance(x, Node)]


def marks_of(attrs: str) -> str:
    """Class words, id and role as one string; ``!`` marks what is hidden or noise."""
    if not attrs or not _ATTR.search(attrs):
        return ""
    words, noise = [], False
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), unescape(a or b or c).lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            noise = True
        elif name == "role":
            noise |= value in ROLES
        elif name in ("class", "id"):
            for word in value.split():
                parts = _WORDS.findall(word)
                noise |= word in WHOLE_NOISE or (
                    any(part in NOISE for part in parts) and parts[0] not in ABOUT
                )
                if name == "class":
                    words.append(word)
    return ("!" if noise else "") + " ".join(sorted(words))


def parse(html: str) -> Node:
    """A lenient tree of the block elements; inline elements leave only their text."""
    root = Node("#root")
    stack, at, end = [root], 0, len(html)
    while at < end:
        m = _TOKEN.search(html, at)
        text = html[at : m.start() if m else end]
        if text:
            stack[-1].items.append(text)
        if not m:
            break
        at = m.end()
        closing, tag = m.group(1), (m.group(2) or "").lower()
        if not tag:
            continue
        if closing:
            if tag in BLOCKS:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].tag == tag:
                        del stack[i:]
                        if len(stack) > DEPTH:
                            # What follows in this element comes after the one just closed.
                            stack[-1] = Node(stack[-1].tag, stack[-1].marks)
                            stack[DEPTH - 1].items.append(stack[-1])
                        break
                    if tag in ("p", "li", "td", "tr") and stack[i].tag in ("table", "article", "body"):
                        break
            continue
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = stop.end() if stop else end
            continue
        if tag in VOID:
            stack[-1].items.append(" ")
        if tag in VOID or (tag not in BLOCKS and tag not in DROPPED):
            continue
        while tag in CLOSED_BY.get(stack[-1].tag, ()):
            stack.pop()
        node = Node(tag, marks_of(m.group(3)))
        if len(stack) > DEPTH and is_noise(stack[-1], True) and not node.marks.startswith("!"):
            node.marks = f"!{node.marks}"
        stack[min(len(stack), DEPTH) - 1].items.append(node)
        stack.append(node)
        if tag in ("button", "canvas", "audio", "video", "object"):
            stop = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            if stop:
                at = stop.end()
            stack.pop()
    return root


def clean(raw: str) -> str:
    return _SPACE.sub(" ", unescape(raw)).strip()


def is_noise(node: Node, inside: bool) -> bool:
    """Boilerplate by tag, role or class; a header within the article is part of it."""
    return noisy(label(node), inside)


def noisy(name: str, inside: bool) -> bool:
    tag, _, marks = name.partition(" ")
    if tag in ("html", "body", "main", "article"):
        return False
    return tag in DROPPED or marks.startswith("!") or (tag == "header" and not inside)


# Wrappers --------------------------------------------------------------------------
# A wrapper node is [label, text hash or None where it varies, witnesses, chars, children,
# start and end that the texts of a container share]. Witnesses are the smallest
# TEMPLATE_PAGES of the hashes of the different pages that have the node: copies of a page
# are one witness, whatever part or round they meet in.


def label(node: Node) -> str:
    return f"{node.tag} {node.marks}".strip()


def page_hash(html: str) -> int:
    return int.from_bytes(blake2b(html.encode("utf-8", "replace"), digest_size=8).digest())


def skeleton(node: Node, page: int = 0) -> list:
    """The collapsed tree of a page, of this hash, as a wrapper of one page."""
    out: list = []
    for child in node.children:
        made = skeleton(child, page)
        if out and out[-1][0] == made[0]:
            fold_run(out[-1], made)
        else:
            out.append(made)
    made = bare(node, page)
    made[4] = supported(out)
    return made


def supported(kids: list) -> list:
    """At most ``WIDTH`` children, in page order: those that the most different pages have."""
    if len(kids) <= WIDTH:
        return kids
    best = sorted(range(len(kids)), key=lambda i: (-len(kids[i][2]), i))[:WIDTH]
    return [kids[i] for i in sorted(best)]


def bare(node: Node, page: int = 0) -> list:
    """The wrapper of a page's element without its children."""
    own = " ".join(filter(None, (clean(x) for x in node.items if isinstance(x, str))))
    ends = [own[:FIXED], own[-FIXED:]] if node.tag in CONTAINERS else ["", ""]
    return [label(node), zlib.crc32(own.encode()) if own else 0, [page], len(own), [], *ends]


def fold_run(a: list, b: list) -> None:
    """Neighbours of one label are one repeated node; its hash covers all of their texts."""
    a[1], a[3] = zlib.crc32(f"{a[1]},{b[1]}".encode()), a[3] + b[3]
    a[5:] = shared_ends(a, b)
    kids = []
    for x, y in align(a[4], b[4]):
        if x and y:
            fold_run(x, y)
        kids.append(x or y)
    a[4] = supported(kids)


def score(a: list, b: list) -> int:
    """Simple tree matching: the most node pairs of equal label in equal order."""
    if a[0] != b[0]:
        return 0
    x, y = a[4], b[4]
    if [n[0] for n in x] == [n[0] for n in y]:
        return 1 + sum(score(p, q) for p, q in zip(x, y, strict=True))
    return 1 + table(x, y)[-1][-1]


def table(x: list, y: list) -> list[list[int]]:
    best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i, p in enumerate(x):
        for j, q in enumerate(y):
            pair = score(p, q)
            best[i + 1][j + 1] = max(
                best[i][j + 1], best[i + 1][j], best[i][j] + pair if pair else 0
            )
    return best


def align(x: list, y: list) -> list[tuple]:
    """Children of both in one order: matched pairs, and those of one side alone."""
    if [n[0] for n in x] == [n[0] for n in y]:
        return list(zip(x, y, strict=True))
    best, out, i, j = table(x, y), [], len(x), len(y)
    while i or j:
        if i and best[i][j] == best[i - 1][j]:
            i -= 1
            out.append((x[i], None))
        elif j and best[i][j] == best[i][j - 1]:
            j -= 1
            out.append((None, y[j]))
        else:
            i, j = i - 1, j - 1
            out.append((x[i], y[j]))
    return out[::-1]


def merged(a: list, b: list) -> list:
    same = a[1] if a[1] == b[1] else None
    kids = [merged(x, y) if x and y else (x or y) for x, y in align(a[4], b[4])]
    seen = a[2] if a[2] == b[2] else sorted({*a[2], *b[2]})[:TEMPLATE_PAGES]
    return [a[0], same, seen, max(a[3], b[3]), supported(kids), *shared_ends(a, b)]


def shared_ends(a: list, b: list) -> list[str]:
    tails = commonprefix([a[6][::-1], b[6][::-1]])
    return [commonprefix([a[5], b[5]]), tails[::-1]]


def open_text(node: list) -> bool:
    """Whether a node's own text differs by page, by more than a small field."""
    if not node[3] or (node[1] is not None and len(node[2]) > 1):
        return False
    fixed = len(node[5]) + len(node[6])
    return len(node[2]) < TEMPLATE_PAGES or 3 * fixed < 2 * node[3]


def varying(node: list, inside: bool) -> bool:
    """Whether there is text of single pages under a node, without boilerplate."""
    if noisy(node[0], inside):
        return False
    inside = inside or within(node[0])
    return open_text(node) or any(varying(c, inside) for c in node[4])


def within(name: str) -> bool:
    """A header below such an element is no page header."""
    return name.split(" ")[0] not in ("#root", "html", "body")


# Extraction ------------------------------------------------------------------------


def collect(node: Node, wrapper: list | None, inside: bool, out: list[str]) -> None:
    """Blocks under a node in page order; containers that are template are left out."""
    run: list[str] = []

    def close() -> None:
        text = clean("".join(run))
        if text:
            out.append(text)
        run.clear()

    kids = {}
    if wrapper:
        for part, own in paired(node.children, wrapper[4]):
            gone = own and template(own) and template(merged(own, folded(map(skeleton, part))))
            kids |= {id(c): (own, gone) for c in part}
    for x in node.items:
        if isinstance(x, str):
            run.append(x)
            continue
        close()
        own, gone = kids.get(id(x), (None, False))
        if not is_noise(x, inside) and not gone:
            collect(x, own, inside or within(x.tag), out)
    close()


def folded(made: Iterable[list]) -> list:
    first, *others = made
    for other in others:
        fold_run(first, other)
    return first


def paired(children: list[Node], slots: list) -> Iterator[tuple[list[Node], list | None]]:
    """Runs of children with the wrapper node they align with, if there is one."""
    heads: list[tuple[list, list[Node]]] = []
    for c in children:
        name = label(c)
        if heads and heads[-1][0][0] == name:
            heads[-1][1].append(c)
        else:
            heads.append(([name, 0, [0], 0, [], "", ""], [c]))
    nodes = {id(head): own for head, own in heads}
    for head, slot in align([h for h, _ in heads], slots):
        if head is not None:
            yield nodes[id(head)], slot


def template(node: list) -> bool:
    """A container that says the same on every page that has it."""
    return (
        node[0].split(" ")[0] in CONTAINERS
        and len(node[2]) >= TEMPLATE_PAGES
        and constant(node)
    )


def constant(node: list) -> bool:
    return node[1] is not None and all(constant(c) for c in node[4])


def main_slot(root: Node, wrapper: list) -> tuple[list[Node], list] | None:
    """All elements of a page's main slot, and the wrapper node that they stand for."""
    nodes, slot = [root], wrapper
    while nodes[0].tag not in ("article", "main"):
        inside = within(slot[0])
        here = folded(map(bare, nodes))
        here[2] = slot[2]  # the page is one of the witnesses already
        if open_text(merged([*slot[:4], [], *slot[5:]], here)):
            break
        groups: dict[int, tuple[list | None, list[list[Node]]]] = {}
        for node in nodes:
            for part, own in paired(node.children, slot[4]):
                groups.setdefault(id(own or part), (own, []))[1].append(part)
        found = []
        for own, parts in groups.values():
            flat = [c for part in parts for c in part]
            size = sum(weight(c, inside) for c in flat)
            if not size:
                continue
            if own and not varying(own, inside):
                made = folded(folded(map(skeleton, part)) for part in parts)
                if not varying(merged(own, made), inside):
                    continue
            found.append((size, flat, own))
        if not found:
            return None
        size, flat, own = max(found, key=lambda f: f[0])
        if not own or flat[0].tag not in LAYOUT:
            break
        if len(found) > 1 and not (
            any(map(articles, flat)) and size >= 0.8 * sum(f[0] for f in found)
        ):
            break
        if flat[0].tag == "article":
            # Several articles next to each other are one page's text.
            flat = [c for n in nodes for c in n.children if label(c) == own[0]]
        nodes, slot = flat, own
    return nodes, slot


def weight(node: Node, inside: bool) -> int:
    if is_noise(node, inside):
        return 0
    inside = inside or within(node.tag)
    return sum(len(x.strip()) if isinstance(x, str) else weight(x, inside) for x in node.items)


def articles(node: Node) -> list[Node]:
    """The outermost article or main elements that are no boilerplate."""
    if is_noise(node, False):
        return []
    if node.tag in ("article", "main"):
        inner = [a for c in node.children for a in articles(c)] if node.tag == "main" else []
        return inner or [node]
    return [a for c in node.children for a in articles(c)]


def extract(html: str | None, wrapper: list | None) -> str:
    """Main text of a page, given its host's wrapper."""
    if not html:
        return ""
    root, out = parse(html), []
    found = main_slot(root, wrapper) if wrapper and len(wrapper[2]) > 1 else None
    if found:
        for part in found[0]:
            collect(part, found[1], within(part.tag), out)
    if not out:
        for part in articles(root) or [root]:
            collect(part, None, part is not root, out)
    return "\n".join(out)


# Spark -----------------------------------------------------------------------------


def hosted(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"(?s)://([^/?#]*)", 1))
    return pick(long_rows(pages), "page_id", "url", "html").withColumn("host", host)


def wrappers(rows: DataFrame) -> DataFrame:
    """(host, wrapper): one wrapper per host, as JSON, merged over rounds."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        for batch in batches:
            for host, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if html:
                    made = skeleton(parse(html), page_hash(html))
                    held[host] = merged(held[host], made) if host in held else made
                if len(held) > HELD:
                    yield packed(held)
                    held = {}
        yield packed(held)

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, made = None, None
        for batch in batches:
            for host, lot, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (host, lot) != key:
                    if key is not None:
                        yield packed({key[0]: made})
                    key, made = (host, lot), json.loads(text)
                else:
                    made = merged(made, json.loads(text))
        if key is not None:
            yield packed({key[0]: made})

    kind = "host string, wrapper string"
    parts = stage(rows.select("host", "html").mapInArrow(first, kind), "wrappers")
    while True:
        most = parts.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            return parts
        # By content, so that every run forms the same lots whatever the partitions.
        spread = F.when(F.lit(most) > FAN_IN, F.pmod(F.xxhash64("wrapper"), F.lit(-(-most // FAN_IN))))
        lots = parts.withColumn("lot", spread.otherwise(0))
        ordered = lots.repartition("host", "lot").sortWithinPartitions("host", "lot", "wrapper")
        parts = stage(ordered.select("host", "lot", "wrapper").mapInArrow(again, kind), "wrappers")


def packed(held: dict[str, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.string()),
         pa.array([json.dumps(w, separators=(",", ":")) for w in held.values()], pa.string())],
        names=["host", "wrapper"],
    )


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text): the main text of every page."""
    rows = hosted(pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list | None] = {}
        for batch in batches:
            texts = []
            for html, text in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if text is not None and text not in known:
                    if len(known) > HELD:
                        known.clear()
                    known[text] = json.loads(text)
                texts.append(extract(html, known.get(text)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())],
                names=["page_id", "url", "text"],
            )

    found = wrappers(rows)
    size = found.agg(F.sum(F.length("wrapper") + F.length("host"))).first()[0] or 0
    if size <= BROADCAST:  # measured; beyond it pages meet their wrapper by a shuffle
        found = F.broadcast(found)
    joined = rows.join(found, "host", "left").select("page_id", "url", "html", "wrapper")
    return joined.mapInArrow(run, "page_id long, url string, text string")
