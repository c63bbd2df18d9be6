"""Main text of web pages by wrappers inferred for each host.

A wrapper is a regular expression without unions over a page's stream of tags
and texts: a node with its children in order, each of them once, optional,
repeated, or both, with slots where texts stand. It is inferred by alignment:

* Inside a page, neighbours with the same tag are aligned with each other and become a repeated group.
* Two expressions are aligned child by child on the longest common run of
  tags; what only one of them has becomes optional, a group that is longer in one is repeated.
* Pages of a host with equal expressions are counted as one, so the alignment
  folds over the distinct expressions of the host, in two steps (by salted
  parts, then over the parts' wrappers), and a host with a third of all pages is no
  larger than its templates.

Every node of a host's wrapper has a number. Pages are then matched against the wrapper from the left: neighbours with one key
go together to the next child of the wrapper with that key. Alignment only puts children in or joins equal neighbours, so every
page of the host has such a match, and elements with equal tags and names are told apart by their position.
For every slot, a place where text stands, it is aggregated how many different pages fill it, how much with, how much of that
in links, and whether all say the same. From that and the tags the article's slots are told from the rest, and a page's text
is what its blocks in the article's slots hold. That is done for each template of a host: pages whose strongest element named
as an article is of one rank, and among pages without one, those that the article found first leaves without text, again.

Names are whole tokens of class, id and role. A token such as ``no-sidebar`` or ``with-comments`` says what an element
holds, not what it is. Names of layout above an article, such as ``sidebar-left``, are overlooked on pages that have
more text in articles below such names than outside of them.

Defined results: a null or empty html, or a page without an article, gives an empty
text; pages without a host belong to one host of their own; repeated rows get equal results;
columns besides ``page_id``, ``url`` and ``html`` are not read.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from propensa.llm.tables import ship
from propensa.session import stored

PARTS = 32  # salted parts of a host's expressions
DEEPEST = 60  # deeper nodes count as children of the last level; their text stays
RELIEVED = 10  # added to the rank of a page whose article stands below names of layout
BATCH_CHARS = 8_000_000  # of text that a task holds before it hands rows on
# Kinds of HTML elements, as the standard names them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp
    small span strike strong sub sup time tt u var wbr""".split())
CLOSES = {  # an opening tag ends these open elements
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"tbody", "tr", "td", "th"}, "body": {"head"},
}
# Kinds of elements that running text is made of; what holds them is the article.
RUNNING = frozenset("""address blockquote caption dd dl dt figcaption figure h1 h2 h3 h4 h5 h6 li ol p pre table tbody td tfoot th thead
    tr ul""".split())
# Elements and names that do not belong to an article.
ASIDE_TAGS = frozenset("""nav header footer aside form button select option input textarea menu dialog noscript template svg canvas
    iframe object head title figure-credit""".split())
ASIDE_NAMES = frozenset("""ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs byline-share comment comments
    consent cookie cookies disqus footer form gdpr header login masthead menu message modal nav navbar navigation newsletter notice
    notices notification overlay pagination popup promo promoted promotion recommended related reply replies respond rss search share
    sharing sidebar signup skip social sponsor sponsored sponsors subscribe subscription tags toolbar widget widgets""".split())
ARTICLE_NAMES = frozenset("article main content post entry story body text".split())
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?P<raw>script|style|noscript|template|svg|textarea|iframe|select)\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<[!?][^>]*>|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:\"[^\"]*\"|'[^']*'|[^'\">])*)>", re.S | re.I)
_NAMES = re.compile(r"(?:\s|^)(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_NAME = re.compile(r"[a-z]+")
HOLDING = frozenset("has have hide is no not show with without".split())  # a name that begins so is none of the element itself
_SPACE = re.compile(r"\s+")


def _names(rest: str) -> tuple[str, ...]:
    """Tokens of an element's class, id and role; tokens with digits are of one page and left out."""
    found = " ".join(next(filter(None, m), "") for m in _NAMES.findall(rest)).lower() if "=" in rest else ""
    return tuple(sorted({"-".join(_NAME.findall(token)) for token in found.split() if not any(map(str.isdigit, token))} - {""}))


class Page:
    """A page's block elements and texts.

    ``tree`` is nested [key, children, number in the wrapper]; ``blocks`` are (leaf of the tree, text, characters in
    links) in page order. Leaves have the key ``#``.
    """

    def __init__(self, source: str):
        self.blocks: list[tuple[list, str, int]] = []
        self.tree: list = ["", [], 0]
        open_: list[tuple[str, list]] = [("", self.tree)]  # tag, node
        self.pieces: list[str] = []
        links = 0
        self.linked = 0
        end = 0
        for m in _TOKEN.finditer(source):
            if m.start() > end:
                self._say(source[end:m.start()], links > 0)
            end = m.end()
            tag = m["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if tag in INLINE:
                if tag == "a":
                    links = max(0, links + (-1 if m["close"] else 1))
                elif tag == "br":
                    self.pieces.append(" ")
                continue
            if m["close"]:
                if any(t == tag for t, _ in open_):
                    self._flush(open_[-1])
                    while open_.pop()[0] != tag:
                        pass
                    links = 0
                continue
            self._flush(open_[-1])
            links = 0
            ends = CLOSES.get(tag, set()) | {"p"}
            while len(open_) > 1 and open_[-1][0] in ends:
                open_.pop()
            if tag in VOID:
                continue
            key = tag if tag in ("html", "body") else ".".join((tag, *_names(m["rest"])))
            parent = open_[-1][1]
            node = parent
            if len(open_) <= DEEPEST:
                node = [key, [], -1]
                parent[1].append(node)
            open_.append((tag, node))
        self._say(source[end:], links > 0)
        self._flush(open_[-1])

    def _say(self, text: str, linked: bool) -> None:
        self.pieces.append(text)
        if linked:
            self.linked += len(text.strip())

    def _flush(self, element: tuple[str, list]) -> None:
        """Close the block of text that stands in ``element``."""
        if self.pieces:
            text = _SPACE.sub(" ", html.unescape("".join(self.pieces))).strip()
            if text:
                children = element[1][1]
                if not children or children[-1][0] != "#":
                    children.append(["#", [], -1])
                self.blocks.append((children[-1], text, self.linked))
        self.pieces, self.linked = [], 0

    def match(self, wrapper: Wrapper) -> None:
        """Number the nodes by their places in the wrapper; what has no place keeps -1."""
        todo = [self.tree]
        while todo:
            _, children, number = todo.pop()
            places = wrapper.children[number]
            key, place, at = None, -1, 0
            for child in children:
                if child[0] != key:
                    key = child[0]
                    found = next((k for k in range(at, len(places)) if wrapper.keys[places[k]] == key), None)
                    place = -1 if found is None else places[found]
                    at = at if found is None else found + 1
                child[2] = place
                if place >= 0 and child[1]:
                    todo.append(child)


class Wrapper:
    """A wrapper's nodes by number, from the root down and from the left: keys, parents, children."""

    def __init__(self, expression: list):
        self.keys: list[str] = []
        self.parents: list[int] = []
        self.children: list[list[int]] = []
        todo = [(expression, -1)]
        while todo:
            (key, _, children), parent = todo.pop()
            number = len(self.keys)
            self.keys.append(key)
            self.parents.append(parent)
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(number)
            todo += [(child, number) for child in reversed(children)]


# An expression is [key, quantifier, children]; the quantifier is "" (once), "?" (optional), "+" (repeated) or "*" (both).

def _quantifier(optional: bool, repeated: bool) -> str:
    return "*" if optional and repeated else "?" if optional else "+" if repeated else ""


def _with(expression: list, optional: bool = False, repeated: bool = False) -> list:
    quantifier = _quantifier(optional or expression[1] in "?*" and expression[1] != "", repeated or expression[1] in "+*" and expression[1] != "")
    return [expression[0], quantifier, expression[2]]


def expression(node: list) -> list:
    """A page's node as an expression: neighbours with one key are one repeated group."""
    children: list[list] = []
    for child in node[1]:
        made = expression(child)
        if children and children[-1][0] == made[0]:
            children[-1] = _with(align(children[-1], made), repeated=True)
        else:
            children.append(made)
    return [node[0], "", children]


def align(one: list, two: list) -> list:
    """The least expression without unions, of this form, that holds both; their keys are equal."""
    a, b = one[2], two[2]
    longest = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            longest[i][j] = longest[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(longest[i + 1][j], longest[i][j + 1])
    children: list[list] = []

    def put(child: list) -> None:
        if children and children[-1][0] == child[0]:
            both = align(children[-1], child)
            optional = all(c[1] in ("?", "*") for c in (children[-1], child))
            children[-1] = [both[0], _quantifier(optional, True), both[2]]
        else:
            children.append(child)

    i = j = 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i][0] == b[j][0]:
            put(align(a[i], b[j]))
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and longest[i + 1][j] >= longest[i][j + 1]:
            put(_with(a[i], optional=True))
            i += 1
        else:
            put(_with(b[j], optional=True))
            j += 1
    marks = one[1] + two[1]
    return [one[0], _quantifier("?" in marks or "*" in marks, "+" in marks or "*" in marks), children]


def fold(expressions: list[str]) -> str:
    """The wrapper of serialized expressions, aligned one after the other in a fixed order."""
    wrapper = None
    for text in sorted(set(expressions), key=lambda e: (len(e), e)):
        wrapper = json.loads(text) if wrapper is None else align(wrapper, json.loads(text))
    return json.dumps(wrapper, ensure_ascii=False, separators=(",", ":"))


def _parts(key: str) -> list[list[str]]:
    """The words of each name of an element that tells what the element is."""
    names = (name.split("-") for name in key.split(".")[1:])
    return [words for words in names if words[0] not in HOLDING]


def _aside_tag(key: str) -> bool:
    return key.split(".")[0] in ASIDE_TAGS


def _aside(key: str) -> bool:
    return _aside_tag(key) or any(w in ASIDE_NAMES for words in _parts(key) for w in words)


def _rank(key: str) -> int:
    """3, 2 or 1 for an element named as an article, 0 for others."""
    tag = key.split(".")[0]
    return 3 if tag == "article" else 2 if tag == "main" else 1 if any(w in ARTICLE_NAMES for words in _parts(key) for w in words) else 0


def strongest(page: Page) -> int:
    """The highest rank of a page's elements that do not stand aside.

    If none of them is an article by its tag and there is more text in such articles below elements that stand aside by name,
    the highest rank of those, and ``RELIEVED`` more.
    """
    size: dict[int, int] = {}
    for leaf, text, _ in page.blocks:
        size[id(leaf)] = size.get(id(leaf), 0) + len(text)
    rank = below = free = held = 0
    todo = [(page.tree, False, False)]  # node, below a name that stands aside, in an article there
    while todo:
        (key, children, _), named, inside = todo.pop()
        if not named:
            rank = max(rank, _rank(key))
        elif inside:
            below = max(below, _rank(key))
        for child in children:
            if child[0] == "#":
                free += 0 if named else size.get(id(child), 0)
                held += size.get(id(child), 0) if inside else 0
            elif not _aside(child[0]):
                todo.append((child, named, inside or named and _rank(child[0]) > 1))
            elif not _aside_tag(child[0]) and not inside:
                todo.append((child, True, False))
    return RELIEVED + below if rank < 2 and held > free else rank


def article_slots(wrapper: Wrapper, slots: dict[int, tuple[int, int, int, bool]], relieved: bool = False) -> tuple[bool, list[int]]:
    """Whether the article is named, and the numbers of the wrapper's slots that make it.

    ``slots`` holds (pages, characters, characters in links, whether all say the same) by number, of the different pages of
    one template. The article is under the elements of the highest rank that hold a quarter of the text; without such elements,
    under the deepest element that holds at least two thirds of the text that is no link and no notice. A notice is what says
    the same on all pages that have it, at least half of the different ones and more than one, if the notices together
    hold less text than the rest. What stands under a named element is no notice. If the deepest element is
    itself running text, such as a paragraph, the other running text beside it belongs to the article, unless it is mostly links.
    ``relieved``: names do not put an element aside that holds the article with the most text.
    """
    holding: set[int] = set()
    if relieved:
        held = [slots.get(n, (0, 0))[1] for n in range(len(wrapper.keys))]
        for number in range(len(held) - 1, 0, -1):
            held[wrapper.parents[number]] += held[number]
        bare = [n for n, key in enumerate(wrapper.keys) if _rank(key) > 1 and not _aside(key)]
        above = wrapper.parents[max(bare, key=lambda n: held[n])] if bare else -1
        while above > 0:
            holding.add(above)
            above = wrapper.parents[above]
    found: list[tuple[int, tuple[int, ...], bool]] = []  # slot, chain of elements, whether it stands aside
    named: dict[int, int] = {}  # elements named as an article, with their rank
    tags = [key.split(".")[0] for key in wrapper.keys]
    todo = [(0, (0,), False)]
    while todo:
        number, chain, aside = todo.pop()
        key = wrapper.keys[number]
        if not aside and _rank(key):
            named[number] = _rank(key)
        for child in wrapper.children[number]:
            key = wrapper.keys[child]
            if key == "#":
                found.append((child, chain, aside))
            else:
                own = _aside_tag(key) if child in holding else _aside(key)
                todo.append((child, (*chain, child), aside or own))

    most = max((pages for pages, *_ in slots.values()), default=0)
    loose = [s for s, chain, aside in found if s in slots and not aside and not named.keys() & set(chain)]
    notices = {s for s in loose if slots[s][3] and slots[s][0] > 1 and 2 * slots[s][0] >= most}
    if 2 * sum(slots[s][1] for s in notices) >= sum(slots[s][1] for s, _, aside in found if s in slots and not aside):
        notices = set()

    def weight(slot: int) -> float:
        _, chars, linked, _ = slots.get(slot, (0, 0, 0, False))
        return 0.0 if slot in notices else max(0, chars - 2 * linked)

    inside: dict[int, float] = {}
    for slot, chain, aside in found:
        if not aside:
            for element in chain:
                inside[element] = inside.get(element, 0.0) + weight(slot)
    whole = inside.get(0, 0.0)
    for rank in sorted(set(named.values()), reverse=True):
        roots = {e for e, r in named.items() if r == rank and inside.get(e, 0.0) > 0}
        if roots and sum(inside[e] for e in roots) >= whole / 4:
            return True, [s for s, chain, aside in found if not aside and roots & set(chain)]
    enough = [chain for slot, chain, aside in found if not aside]
    best = max(((len(c[: i + 1]), e) for c in enough for i, e in enumerate(c) if inside[e] >= whole * 2 / 3), default=(0, 0))[1]
    trunk = next((c[: c.index(best) + 1] for c in enough if best in c), (0,))
    depth = next((i for i, e in enumerate(trunk) if tags[e] in RUNNING), None)

    def beside(slot: int, chain: tuple[int, ...]) -> bool:
        return depth is not None and chain[:depth] == trunk[:depth] and len(chain) > depth and tags[chain[depth]] in RUNNING and weight(slot) > 0

    return False, [s for s, chain, aside in found if not aside and s not in notices and (best in chain or beside(s, chain))]


def _rows(columns: list[tuple[list, pa.DataType, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t, _ in columns], names=[n for _, _, n in columns])


def expressions(pages: DataFrame) -> DataFrame:
    """The distinct (host, expression) of all pages."""
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [json.dumps(expression(Page(source.as_py() or "").tree), ensure_ascii=False, separators=(",", ":"))
                    for source in batch.column("html")]
            yield _rows([(batch.column("host"), pa.string(), "host"), (made, pa.string(), "expression")])

    return pages.select(host().alias("host"), "html").mapInArrow(describe, "host string, expression string").distinct()


_SLOT = pa.list_(pa.struct([("slot", pa.int32()), ("said", pa.int64()), ("chars", pa.int64()), ("linked", pa.int64())]))
_BLOCK = pa.list_(pa.struct([("slot", pa.int32()), ("text", pa.string())]))


def _hash(value: bytes) -> int:
    return int.from_bytes(blake2b(value, digest_size=8).digest(), "big", signed=True)


def matched(pages: DataFrame, whole: DataFrame) -> DataFrame:
    """Pages matched against their hosts' wrappers, written once.

    Per page: page_id, url, host, rank of its strongest named element, blocks (slot, text), slots (number, hash of what it says,
    characters, those in links) and their hash.
    """
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Wrapper] = {}
        for batch in batches:
            start, held, ranks, blocks, slots, hashes = 0, 0, [], [], [], []
            for n, (source, serialized) in enumerate(zip(batch.column("html"), batch.column("expression"), strict=True)):
                serialized = serialized.as_py()
                if serialized not in known:
                    if len(known) >= 100:
                        known.clear()
                    known[serialized] = Wrapper(json.loads(serialized))
                page = Page(source.as_py() or "")
                page.match(known[serialized])
                ranks.append(strongest(page))
                said: dict[int, list] = {}
                for (_, _, slot), text, linked in page.blocks:
                    entry = said.setdefault(slot, [blake2b(digest_size=8), 0, 0])
                    entry[0].update(text.encode("utf-8", "replace"))
                    entry[1] += len(text)
                    entry[2] += linked
                    held += len(text)
                blocks.append([{"slot": leaf[2], "text": text} for leaf, text, _ in page.blocks])
                slots.append([{"slot": s, "said": int.from_bytes(h.digest(), "big", signed=True), "chars": c, "linked": k}
                              for s, (h, c, k) in said.items()])
                hashes.append(_hash(repr([tuple(s.values()) for s in slots[-1]]).encode()))
                if held >= BATCH_CHARS or n + 1 == len(batch):
                    part = batch.slice(start, n + 1 - start)
                    own = pa.RecordBatch.from_arrays([
                        part.column("page_id"), part.column("url"), part.column("host"), pa.array(ranks, pa.int32()),
                        pa.array(blocks, _BLOCK), pa.array(slots, _SLOT), pa.array(hashes, pa.int64())],
                        names=["page_id", "url", "host", "rank", "blocks", "slots", "whole"])
                    yield own
                    start, held, ranks, blocks, slots, hashes = n + 1, 0, [], [], [], []

    added = T.StructType.fromDDL("host string, rank int, blocks array<struct<slot: int, text: string>>, "
                                 "slots array<struct<slot: int, said: long, chars: long, linked: long>>, whole long")
    schema = T.StructType([*pages.select("page_id", "url").schema.fields, *added.fields])
    rows = pages.select("page_id", "url", "html", host().alias("host")).join(whole, "host")
    return stored(rows.select("page_id", "url", "host", "html", "expression").mapInArrow(place, schema))


def host():
    return F.lower(F.coalesce(F.regexp_extract("url", r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def wrappers(pages: DataFrame) -> DataFrame:
    """Per host: its wrapper, serialized as ``expression``. Written once."""
    def folded(table: pa.Table) -> pa.Table:
        return pa.table({"host": table.column("host").slice(0, 1), "expression": [fold(table.column("expression").to_pylist())]})

    parts = expressions(pages).withColumn("part", F.pmod(F.xxhash64("expression"), F.lit(PARTS)))
    parts = parts.groupBy("host", "part").applyInArrow(folded, "host string, expression string")
    return stored(parts.groupBy("host").applyInArrow(folded, "host string, expression string"))


def articles_of(rows: DataFrame, whole: DataFrame) -> DataFrame:
    """Per host, the articles of its templates in the order they were found. Written once.

    ``rows`` are those of :func:`matched`. An article is (round, rank, whether it is named, numbers of its slots). Pages of a
    rank without a named article that have no text in the article of one round are a template of their own in the next;
    each round takes two thirds of the text.
    """
    rows = rows.select("host", "rank", "slots", "whole")

    def articles(rows: DataFrame, turn: int) -> DataFrame:
        different = rows.where(F.size("slots") > 0).dropDuplicates(["host", "rank", "whole"])
        slots = different.select("host", "rank", F.explode("slots").alias("s")).groupBy("host", "rank", "s.slot").agg(
            F.count("*").alias("pages"), F.sum("s.chars").alias("chars"), F.sum("s.linked").alias("linked"),
            (F.min("s.said") == F.max("s.said")).alias("same"))

        def marked(wrapper: pa.Table, table: pa.Table) -> pa.Table:
            known: dict[int, dict] = {}
            for r in table.to_pylist():
                known.setdefault(r["rank"], {})[r["slot"]] = (r["pages"], r["chars"], r["linked"], r["same"])
            nodes = Wrapper(json.loads(wrapper.column("expression")[0].as_py()))
            found = [(rank, *article_slots(nodes, k, rank >= RELIEVED)) for rank, k in sorted(known.items())]
            return pa.table({
                "host": pa.array([wrapper.column("host")[0].as_py()] * len(found), pa.string()), "round": pa.array([turn] * len(found), pa.int32()),
                "rank": pa.array([f[0] for f in found], pa.int32()), "named": pa.array([f[1] for f in found], pa.bool_()),
                "article": pa.array([f[2] for f in found], pa.list_(pa.int32()))})

        return stored(whole.groupBy("host").cogroup(slots.groupBy("host")).applyInArrow(
            marked, "host string, round int, rank int, named boolean, article array<int>"))

    found, rest, left = [articles(rows, 0)], rows, None
    while True:
        rest = rest.join(found[-1].where("not named"), ["host", "rank"]).where(
            (F.size("slots") > 0) & ~F.arrays_overlap("slots.slot", "article")).select(*rows.columns)
        rest = stored(rest)
        before, left = left, rest.count()
        if left == 0 or left == before:
            break
        found.append(articles(rest, len(found)))
    templates = found[0]
    for more in found[1:]:
        templates = templates.unionByName(more)
    return stored(templates.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("round", "rank", "named", "article"))).alias("articles")))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) of every page: the blocks of its article, joined by empty lines."""
    ship(pages.sparkSession)
    whole = wrappers(pages)
    rows = matched(pages, whole)

    def said(article):
        blocks = F.filter("blocks", lambda b: F.array_contains(article["article"], b["slot"]))
        return F.struct(F.array_join(F.transform(blocks, lambda b: b["text"]), "\n\n").alias("text"), article["named"].alias("named"))

    own = F.transform(F.filter("articles", lambda a: a["rank"] == F.col("rank")), said)
    first = F.get(F.filter(own, lambda t: t["named"] | (t["text"] != "")), F.lit(0))
    return rows.join(articles_of(rows, whole), "host", "left").select("page_id", "url", F.coalesce(first["text"], F.lit("")).alias("text"))
