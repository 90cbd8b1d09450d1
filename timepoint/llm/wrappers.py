"""HTML extraction by wrappers: union-free regular expressions inferred per host.

A page is a stream of block tags and text. A wrapper describes the streams of a host: at each
level a sequence of slots (a tag and its class, with what it holds) that are required,
optional (``?``), repeated (``+``, ``*``) or gathered into a repeated group, and the text
in each slot. It is inferred by aligning one page after the other: what only one side has
becomes optional, what comes again or in another order becomes a repeated group, and texts
become slots that only keep their amounts. As no key occurs twice in a level, a wrapper stays
as small as the host's templates, however many pages are aligned.

Every task aligns its own pages, then partial wrappers are aligned by host and salt, and
those by host; no task sees more than partial wrappers. The finished wrapper says where the
host's main text is: the article slot that holds most text outside links and page furniture.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from hashlib import blake2b

from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timepoint.llm.common import arrow_map, durable

#: Fixed by the HTML standard: elements of which only the text flows into the block around.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
    "math nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
#: Fixed by the HTML standard: elements without an end tag.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Elements that are never part of an article.
FURNITURE = frozenset(
    "aside button canvas dialog datalist footer form head header iframe map menu nav noscript "
    "object script search select style svg template textarea title".split()
)
#: Class names, ids and roles, or their heads before a hyphen or underscore, that mark furniture;
#: what holds an article or, on a page without one, most of the text, is none all the same.
MARKS = frozenset(
    "ad ads adv advert advertisement advertising adsense banner breadcrumb breadcrumbs comment "
    "comments commentlist consent cookie cookies copyright disqus footer gdpr header masthead "
    "menu modal nav navbar navigation newsletter notice notification pagination pager popup "
    "promo promoted recommended related replies reply respond share sharing sidebar signup "
    "skip social sponsor sponsored subscribe toc toolbar widget widgets".split()
)
#: An open element is closed by the start of one of these.
CLOSED_BY = {
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "tbody", "tfoot"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
MAIN = ("article", "main")
#: After a head these say that there is none of it.
_WITHOUT = frozenset(["free", "less", "off", "none", "no", "without"])
BROADCAST_BYTES = 16 << 20
SALTS = 32
SAME_PAGES = 3

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<svg(?=[\s/>])[^>]*/>"
    r"|<(script|style|textarea|title|noscript|template|svg|iframe)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)>",
    re.S | re.I,
)
_NAMED = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HOST = re.compile(r"^[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")
_SPACES = re.compile(r"\s+")


def _is_marked(attributes: str) -> bool:
    for m in _NAMED.finditer(attributes):
        for name in (m[2] or m[3] or m[4] or "").lower().split():
            head, _, rest = re.sub(r"_", "-", name).partition("-")
            if name in MARKS or (head in MARKS and rest.split("-")[0] not in _WITHOUT):
                return True
    return False


class Node:
    """A block element: its key, whether it is furniture, and what it holds in order."""

    __slots__ = ("tag", "key", "marked", "furniture", "holds")

    def __init__(self, tag: str, attributes: str = "") -> None:
        names = sorted(
            {
                w
                for m in _NAMED.finditer(attributes)
                for w in re.split(r"[^a-z]+", (m[2] or m[3] or m[4] or "").lower())
                if w
            }
        )
        self.tag, self.key = tag, ".".join([tag, *names])
        # a form may be around a whole page, and a name say little
        self.marked = tag == "form" or (
            tag not in ("html", "body", *MAIN) and tag not in FURNITURE and _is_marked(attributes)
        )
        self.furniture = tag in FURNITURE or self.marked
        self.holds: list[Node | tuple[str, bool]] = []


def parse(page: str) -> Node:
    """The tree of block elements; texts are decoded and know whether they stand in a link."""
    root = Node("")
    open_nodes, links, at = [root], 0, 0

    def text(part: str) -> None:
        if part:
            open_nodes[-1].holds.append((html.unescape(part), links > 0))

    for token in _TOKEN.finditer(page):
        text(page[at : token.start()])
        at = token.end()
        raw, closing, name, attributes = token.groups()
        if raw or not name:
            continue
        tag = name.lower()
        if tag in INLINE:
            if tag == "br":
                text(" ")
            elif tag == "a":
                links = 0 if closing else 1
            continue
        links = 0
        if closing:
            for depth in range(len(open_nodes) - 1, 0, -1):
                if open_nodes[depth].tag == tag:
                    del open_nodes[depth:]
                    break
            else:
                open_nodes[-1].holds.append(("\n", False))
            continue
        if open_nodes[-1].tag == "p" or tag in CLOSED_BY.get(open_nodes[-1].tag, ()):
            open_nodes.pop()
        node = Node(tag, attributes)
        open_nodes[-1].holds.append(node)
        if tag not in VOID and not attributes.endswith("/"):
            open_nodes.append(node)
    text(page[at:])
    _decide(root)
    return root


def _decide(root: Node) -> None:
    """Marked elements and forms around a page's articles are content: those of the articles
    with fewest around them, so that comments which are articles too stay out. On a page
    without any it is what holds most of the text outside links."""
    around: list[list[Node]] = []  # of each article
    amounts: list[tuple[Node, int]] = []

    def look(node: Node, within: list[Node]) -> int:
        amount = 0
        if node.tag in MAIN:
            around.append(within)
        for part in node.holds:
            if isinstance(part, tuple):
                amount += 0 if part[1] else len(part[0].strip())
            elif part.marked:
                inner = look(part, [*within, part])
                amounts.append((part, inner))
                amount += inner
            elif not part.furniture:
                amount += look(part, within)
        return amount

    whole = look(root, [])
    fewest = min(map(len, around), default=0)
    content = [n for nodes in around if len(nodes) == fewest for n in nodes]
    if not around:
        content = [node for node, amount in amounts if 2 * amount > whole]
    for node in content:
        node.furniture = False


def blocks(node: Node) -> Iterator[str]:
    """Texts of the blocks in a node, without furniture, white space made single."""
    own: list[str] = []
    for part in node.holds:
        if isinstance(part, tuple) and part[0] != "\n":
            own.append(part[0])
            continue
        if flat := _SPACES.sub(" ", "".join(own)).strip():
            yield flat
        own = []
        if isinstance(part, Node) and not part.furniture:
            yield from blocks(part)
    if flat := _SPACES.sub(" ", "".join(own)).strip():
        yield flat


# A pattern is a list of items [key, quantifier, text, [print, pages], furniture, pattern]; a
# group has the key "" and no text of its own. The print is one of all text in the slot outside
# links and furniture, "" where there is none and "*" where pages differ. All keys of a level, groups included, differ.
Item = list
_OPTIONAL = {"1": "?", "?": "?", "+": "*", "*": "*"}
_REPEATED = {"1": "+", "?": "*", "+": "+", "*": "*"}


def _keys(item: Item) -> set[str]:
    return {k for inner in item[5] for k in _keys(inner)} if not item[0] else {item[0]}


def _either(a: str, b: str) -> str:
    """The quantifier that allows what each of two allows."""
    once = a in "1+" and b in "1+"
    return ("+" if once else "*") if "+" in a + b or "*" in a + b else ("1" if once else "?")


def _seen(a: list, b: list) -> list:
    """The print of a slot on the pages of both, and the pages that have text in it."""
    if not a[0] or not b[0]:
        return b if not a[0] else a
    return [a[0] if a[0] == b[0] else "*", a[1] + b[1]]


def _same(a: Item, b: Item) -> Item:
    """Two slots, or slots and groups that share keys, made one."""
    if a[0] and b[0]:
        seen = _seen(a[3], b[3])
        return [a[0], _either(a[1], b[1]), a[2] + b[2], seen, a[4], align(a[5], b[5])]
    inner = align(a[5] if not a[0] else [a], b[5] if not b[0] else [b])
    return ["", _either(a[1], b[1]), 0, ["", 0], False, inner]


def _folded(items: list[Item]) -> list[Item]:
    """Items whose keys differ: what comes again is gathered from its first to its last place."""
    out: list[Item] = []
    for item in items:
        keys = _keys(item)
        at = next((i for i, done in enumerate(out) if keys & _keys(done)), None)
        if at is None:
            out.append(item)
        elif at == len(out) - 1:
            both = _same(out[at], item)
            out[at] = [both[0], _REPEATED[both[1]], *both[2:]]
        else:
            between = [[x[0], _OPTIONAL[x[1]], *x[2:]] for x in out[at + 1 :]]
            flat = [y for x in [out[at], *between] for y in (x[5] if not x[0] else [x])]
            merged = align(flat, item[5] if not item[0] else [item])
            out[at:] = [["", "+", 0, ["", 0], False, merged]]
    return out


def align(a: list[Item], b: list[Item]) -> list[Item]:
    """One pattern for both: common items in order, the rest optional, crossings a group."""
    if not a or not b:
        return [[x[0], _OPTIONAL[x[1]], *x[2:]] for x in a or b]
    ka, kb = [_keys(x) for x in a], [_keys(x) for x in b]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = (
                1 + best[i + 1][j + 1] if ka[i] & kb[j] else max(best[i + 1][j], best[i][j + 1])
            )
    out, i, j = [], 0, 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and ka[i] & kb[j]:
            out.append(_same(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            out.append([a[i][0], _OPTIONAL[a[i][1]], *a[i][2:]])
            i += 1
        else:
            out.append([b[j][0], _OPTIONAL[b[j][1]], *b[j][2:]])
            j += 1
    seen: set[str] = set()
    if all(seen.isdisjoint(k) and not seen.update(k) for k in map(_keys, out)):
        return out
    return _folded(out)


def _print(texts: list[str]) -> list:
    flat = _SPACES.sub(" ", " ".join(texts)).strip()
    return [blake2b(flat.encode("utf-8", "surrogatepass"), digest_size=6).hexdigest(), 1] if flat else ["", 0]


def _unlinked(node: Node) -> Iterator[str]:
    """Texts outside links and furniture in a node."""
    for part in node.holds:
        if isinstance(part, tuple):
            if not part[1]:
                yield part[0]
        elif not part.furniture:
            yield from _unlinked(part)


def pattern(node: Node) -> list[Item]:
    """The pattern of one page below a node; text beside all elements has a slot "#text"."""
    items, prints = [], {}
    for part in node.holds:
        if isinstance(part, Node):
            own = sum(len(t.strip()) for p in part.holds if isinstance(p, tuple) for t in p[:1] if not p[1])
            texts = [] if part.furniture else list(_unlinked(part))
            prints.setdefault(part.key, []).extend(texts)
            items.append([part.key, "1", own, ["", 0], part.furniture, pattern(part)])
    for item in items:  # slots of one key are one slot, also with one print
        item[3] = _print(prints.pop(item[0], []))
    own = [p[0] for p in node.holds if isinstance(p, tuple) and not p[1] and p[0].strip()]
    if own and not node.tag:
        items.append(["#text", "?", sum(len(x.strip()) for x in own), _print(own), False, []])
    return _folded(items)


def _weights(items: list[Item]) -> int:
    """Text outside links and furniture."""
    return sum(0 if x[4] else x[2] + _weights(x[5]) for x in items)


def main_place(items: list[Item]) -> list[str]:
    """Keys on the way to the host's main text: the heaviest article, else the slot beside
    which, in all that holds it, there is only boilerplate: links, furniture and texts that are the
    same on ``SAME_PAGES`` pages and more, less than a fifth of all."""
    found: list[tuple[int, int, list[str]]] = []

    def look(items: list[Item], way: list[str]) -> None:
        for key, _, text, _, furniture, inner in items:
            if furniture:
                continue
            here = [*way, key] if key else way
            if key.split(".")[0] in MAIN:
                found.append((text + _weights(inner), -len(here), here))
            look(inner, here)

    look(items, [])
    if found and max(found)[0]:
        return max(found)[2]
    way: list[str] = []
    own = 0
    while True:
        flat = [y for x in items for y in ([x] if x[0] else _flat(x[5]))]
        weighed = [(0 if x[4] else x[2] + _weights(x[5]), x) for x in flat]
        weight = own + sum(w for w, _ in weighed)
        heavy = [x for w, x in weighed if 5 * w >= 4 * weight > 0]
        # a block of text itself is not the place, what holds the blocks is
        if own or not heavy or not any(not x[4] for x in heavy[0][5]):
            return way
        if any(w and x is not heavy[0] and not _boilerplate(x) for w, x in weighed):
            return way
        way.append(heavy[0][0])
        own, items = heavy[0][2], heavy[0][5]


def _flat(items: list[Item]) -> list[Item]:
    return [y for x in items for y in ([x] if x[0] else _flat(x[5]))]


def _boilerplate(item: Item) -> bool:
    return item[3][0] != "*" and item[3][1] >= SAME_PAGES


def main_text(page: str | None, way: list[str]) -> str:
    """Blocks at the wrapper's place; a page that has none there gives its whole body."""
    root = parse(page or "")
    places = [root]
    for key in way:
        places = [n for p in places for n in p.holds if isinstance(n, Node) and n.key == key]
    found = [b for p in places for b in blocks(p)] if way else []
    return "\n".join(found or blocks(root))


def host(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _merge_by(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Partial wrappers of each key aligned, in a fixed order."""

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        at, whole = None, []
        out: dict[str, list] = {"host": [], "wrapper": []}
        for batch in batches:
            for *key, own in zip(*(batch[k] for k in keys), batch["wrapper"], strict=True):
                if key == at:
                    whole = align(whole, json.loads(own))
                    continue
                if at is not None:
                    out["host"].append(at[0])
                    out["wrapper"].append(json.dumps(whole))
                at, whole = key, json.loads(own)
            yield out
            out = {"host": [], "wrapper": []}
        if at is not None:
            yield {"host": [at[0]], "wrapper": [json.dumps(whole)]}

    together = rows.repartition(*keys).sortWithinPartitions(*keys, "wrapper")
    return arrow_map(together, "host string, wrapper string", work)


def wrappers(pages: DataFrame) -> DataFrame:
    """One wrapper per host: (host, wrapper as JSON)."""

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        known: dict[str, list[Item]] = {}
        part = TaskContext.get().partitionId()
        for batch in batches:
            for url, page in zip(batch["url"], batch["html"], strict=True):
                name, own = host(url), pattern(parse(page or ""))
                known[name] = align(known[name], own) if name in known else own
            if len(known) >= 10_000:  # many hosts: hand on what there is
                yield _rows(known, part)
                known = {}
        yield _rows(known, part)

    partial = arrow_map(
        pages.select(F.col("url").cast("string"), F.col("html").cast("string")),
        "host string, part int, wrapper string",
        work,
    )
    salted = partial.withColumn("salt", F.pmod("part", F.lit(SALTS)))
    return _merge_by(_merge_by(salted, ["host", "salt"]), ["host"])


def _rows(known: dict[str, list[Item]], part: int) -> dict[str, list]:
    return {
        "host": list(known),
        "part": [part] * len(known),
        "wrapper": [json.dumps(w) for w in known.values()],
    }


def main_texts(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, url, text and n_chars (code points).

    NULL and empty html give an empty text; a NULL or relative url is a host of its own;
    repeated rows each get theirs; other columns are ignored. Where the places of all hosts
    are small they are broadcast (their size is summed first), else joined.
    """

    def places(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            ways = [main_place(json.loads(w)) for w in batch["wrapper"]]
            yield {"host": batch["host"], "way": ways}

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        for batch in batches:
            texts = [
                main_text(page, way or [])
                for page, way in zip(batch["html"], batch["way"], strict=True)
            ]
            yield {
                "page_id": batch["page_id"],
                "url": batch["url"],
                "text": texts,
                "n_chars": [len(text) for text in texts],
            }

    ways = durable(arrow_map(wrappers(pages), "host string, way array<string>", places))
    size = ways.agg(F.sum(F.length("host") + F.length(F.to_json("way")) + 64)).first()[0] or 0
    small = F.broadcast(ways) if size <= BROADCAST_BYTES else ways
    name = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), _HOST.pattern, 1))
    slim = pages.select(
        "page_id",
        F.col("url").cast("string").alias("url"),
        F.col("html").cast("string").alias("html"),
        name.alias("host"),
    )
    kind = slim.schema["page_id"].dataType.simpleString()
    return arrow_map(
        slim.join(small, "host", "left"),
        f"page_id {kind}, url string, text string, n_chars bigint",
        work,
    )
