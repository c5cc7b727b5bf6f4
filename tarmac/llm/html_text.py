"""Main text of web pages by wrappers: union-free regular expressions inferred from the pages of each host.

A page is a stream of block tags and text slots; inline markup belongs to the slot around it. Neighbouring copies of a
group fold into ``(group)+``. Streams of one host are then aligned two at a time: what both have stays, a group that one
has once and the other repeatedly becomes repeated, and what only one has becomes ``(group)?``. Where many such groups
follow one another the order means nothing, and they become one slot that takes any of these elements in any number, an
element once for all its forms; so a wrapper's size follows the kinds of elements and not the pages. The result accepts
all pages of the host, and says so in ``matched``. Words of a class or id are part of a stream only if they are hints
(below), so pages whose elements carry words of their own have no wrappers of their own.

A host's slots, by their place in the element tree, are classified by what the host's pages have there. Text that stands
unchanged on several pages is template text. The rest is summed by the container it is in (article, main, an element
named like one, or none) and by the number of hints above it: elements that look like a menu, sidebar, notice, advert,
form or comments by tag, role or a name of such words alone (``ad-slot``, not ``search-methods``); headings never do. Hints
inside a container rule text out. Hints around it do not: the article is
under the fewest hints that leave a fair share of the changing text, so a layout element with a telling class is passed
over, and comments or teasers deeper in hints are not. Without a container, template slots go, and the container is the
deepest element with most of the changing text.

All pages take part. Streams and slot statistics are combined per host in each task and again after the shuffle, so a host
with a third of all pages sends its few different streams; alignment works on at most ``FOLD`` streams to a task and is
repeated until a host has one wrapper. Slot statistics are summed by Spark, and what a host keeps of them is bounded: a
template slot stands on a share of its pages. Pages are never moved to their host: the small table of wrappers comes to
them.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tarmac.llm.text import cut, whole
from tarmac.session import scratch_path

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|iframe|textarea|title|svg)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)(?:>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)"
    r"|[^<]+|<",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|(\bhidden\b)")
#: Markup inside running text. ``br`` is white space.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr input br picture source".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end an open paragraph or item of the same kind.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table select body article main section div".split())

#: What is not main text, by tag and by role; and what hints at it, by tag and by word of a class or id.
BOILERPLATE_TAGS = frozenset("head nav footer aside button select menu dialog object".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice alert popup modal overlay newsletter subscribe subscription signup sidebar side menu nav navbar navigation "
    "breadcrumb breadcrumbs footer masthead toolbar share sharing social related recommended comment comments disqus reply "
    "replies respond widget login search pagination pager skip".split()
)
HINT_TAGS = frozenset(("form",))
HEADER_WORDS = frozenset(("header", "topbar"))
#: Words that say nothing about what an element holds, and headings, whose names belong to their section.
PLAIN_WORDS = frozenset(
    "area bar block body bottom box buttons button cell col column container count grid group holder icon icons inner item "
    "items layout left link links list module outer panel primary region right row secondary section site slot "
    "text thread title toggle top unit wrap wrapper zone".split()
)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
ARTICLE_WORDS = frozenset("article post entry story content main maincontent articlebody".split())
HINTS = BOILERPLATE_WORDS | HEADER_WORDS | ARTICLE_WORDS
#: Containers of the article, best first.
CONTAINERS = ("article", "main", "named")
#: Of the changing text, the share of what is under more hints that text under fewer must have; and the share of a host's
#: pages on which a template text stands.
FAIR, TEMPLATE = 0.1, 0.1
#: Marked groups in a row from which on their order is given up.
LOOSE = 8
#: Depth from which on elements are no part of a stream; their text is.
DEEPEST = 60
#: Streams aligned in one task, longest repeated group, and share of the text that the container of the rest must hold.
FOLD, LONGEST_GROUP, MOST = 64, 24, 0.6
#: Streams and slots a task combines before it passes them on.
HELD = 20_000


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for name, a, b, c, hidden in ATTRIBUTE.findall(text):
        found.setdefault((name or hidden).lower(), a or b or c)
    return found


@lru_cache(maxsize=50_000)
def _element(tag: str, attributes: str) -> tuple[str, str, bool, bool, str | None]:
    """Labels in streams and in places, whether it is boilerplate, a hint, and which kind of article container it is."""
    found = _attributes(attributes) if attributes.strip() else {}
    names = [set(re.split(r"[_-]+", name)) - {""} for name in f"{found.get('class', '')} {found.get('id', '')}".lower().split()]
    words = set().union(*names)
    known = HINTS | PLAIN_WORDS
    telling = set().union(*(n for n in names if tag not in HEADINGS and all(w in known or w.isdigit() for w in n)))
    role = found.get("role", "").lower()
    boilerplate = tag in BOILERPLATE_TAGS or role in BOILERPLATE_ROLES or "hidden" in found or found.get("aria-hidden") == "true"
    own = tag in ("html", "body", "article", "main")
    hint = tag in HINT_TAGS or bool(telling & BOILERPLATE_WORDS)
    container = "article" if tag == "article" else "main" if tag == "main" or role == "main" else "named" if words & ARTICLE_WORDS else None
    container = None if tag in ("html", "body") else container
    header = "^" if tag == "header" or telling & HEADER_WORDS else ""
    # ids and words with digits are mostly those of one page
    classes = {w for w in re.split(r"[\s_-]+", found.get("class", "").lower()) if w and not any(map(str.isdigit, w))}
    label, place = (header + ".".join([tag, *sorted(w)]) for w in (words & HINTS, classes | words & HINTS))
    return label, place, boilerplate and not own, hint and not own, container


class Page:
    """Text blocks of a page with their candidacies and places, and its stream of block tags and slots.

    A candidacy is a container the block is in, "" for none, and the number of hints around that container.
    """

    def __init__(self, html: str) -> None:
        self.stream: list[str] = []
        self.blocks: list[tuple[tuple[tuple[str, int], ...], tuple[str, ...], str]] = []
        self.path: list[tuple[str, str, str, bool, bool, str | None]] = []  # tag, then as _element
        self.text: list[str] = []
        for token in TOKEN.finditer(html):
            piece = token.group()
            tag = token[3] or token[6]
            if tag is None:
                if piece[0] != "<" or piece == "<":
                    self.text.append(piece)
                continue
            tag = tag.lower()
            closing = token[2] or token[5]
            if tag in INLINE:
                if tag in ("br", "img", "input"):
                    self.text.append(" ")
            elif closing:
                self._close(tag)
            else:
                self._open(tag, token[4] or token[7] or "")
        self._flush()
        while self.path:  # what the page leaves open ends with it
            self._pop()

    def _flush(self) -> None:
        """Ends the slot of running text, if it holds any."""
        joined = " ".join(unescape("".join(self.text)).split()) if self.text else ""
        self.text.clear()
        if joined:
            self.stream.append("#")
            candidacies = self._candidacies()
            if candidacies:
                self.blocks.append((candidacies, tuple(p[2] for p in self.path), joined))

    def _candidacies(self) -> tuple[tuple[str, int], ...]:
        """None for a block in boilerplate, or in a header outside an article."""
        found: dict[str, int] = {}
        hints, header = 0, False
        for _, label, _, boilerplate, hint, container in self.path:
            if boilerplate:
                return ()
            hints += hint
            header |= label[0] == "^"
            if container:
                found[container] = hints  # the innermost
        if header and "article" not in found:
            return ()
        return (*((c, n) for c, n in found.items() if n == hints), ("", hints))

    def _pop(self) -> None:
        label = self.path.pop()[1]
        if len(self.path) < DEEPEST:
            self.stream.append(f"/{label}")

    def _open(self, tag: str, attributes: str) -> None:
        self._flush()
        if any(t == "p" for t, *_ in self.path[-1:]):
            self._pop()
        ends = CLOSES.get(tag, ())
        for at in range(len(self.path) - 1, -1, -1):
            if self.path[at][0] in ends:
                while len(self.path) > at:
                    self._pop()
            elif self.path[at][0] in SCOPES:
                break
        element = _element(tag, attributes.rstrip("/"))
        if len(self.path) < DEEPEST:
            self.stream.append(element[0])
        if tag not in VOID:
            self.path.append((tag, *element))

    def _close(self, tag: str) -> None:
        self._flush()
        if any(t == tag for t, *_ in self.path):
            while self.path[-1][0] != tag:
                self._pop()
            self._pop()


Node = str | tuple  # a tag or slot, ("+" or "?", nodes), ("*", alternatives), or an alternative ("|", nodes)


def folded(nodes: list[Node]) -> list[Node]:
    """Neighbouring copies of a group of elements as one repeated group, short groups first, inside elements as well."""
    units = [(u[0], *folded(list(u[1:-1])), u[-1]) if len(u) > 2 and u[-1] == f"/{u[0]}" else u for u in _units(nodes)]
    for size in range(1, min(LONGEST_GROUP, len(units) // 2) + 1):
        out, i = [], 0
        while i < len(units):
            group, times = units[i : i + size], 1
            if len(group) == size and (size > 1 or not _is_marked(group[0])):
                while units[i + times * size : i + (times + 1) * size] == group:
                    times += 1
            if times > 1:
                out.append((("+", tuple(n for u in group for n in u)),))
                i += times * size
            else:
                out.append(units[i])
                i += 1
        units = out
    return [n for u in units for n in u]


def _marked(units: list[tuple], other: list[tuple]) -> list[tuple]:
    """Elements that ``other`` has as repeated, optional or free groups marked likewise, at this level alone."""
    for sign, group in dict.fromkeys(u[0] for u in other if _is_marked(u)):
        wanted = [a[1] for a in group] if sign == "*" else _units(list(group))
        mark, out, i = ((sign, group),), [], 0
        while i < len(units):
            if sign == "*":
                met = int(units[i] == mark or units[i] in wanted)
            else:
                met = len(wanted) if units[i : i + len(wanted)] == wanted else 0
            if not met:
                out.append(units[i])
            elif sign == "?" or not out or out[-1] != mark:
                out.append(mark)
            i += met or 1
        units = out
    return units


def _alternatives(node: tuple) -> list[tuple]:
    """The elements that a marked group is made of."""
    sign, group = node
    if sign == "*":
        return [a[1] for a in group]
    found = []
    for unit in _units(list(group)):
        found += _alternatives(unit[0]) if len(unit) == 1 and isinstance(unit[0], tuple) else [unit]
    return found


def _label(unit: tuple) -> Node:
    """What two elements must share to become one: the label of a whole element, else all of it."""
    whole_ = len(unit) > 1 and isinstance(unit[0], str) and unit[-1] == f"/{unit[0]}"
    return unit[0] if whole_ or len(unit) == 1 else unit


def _merged(a: tuple, b: tuple) -> tuple:
    """One element for two of the same label."""
    return a if a == b else (a[0], *aligned(list(a[1:-1]), list(b[1:-1])), a[-1])


def _free(units: list[tuple]) -> tuple:
    """One free slot for elements in any order and number; elements of one label become one alternative."""
    by_label: dict[Node, tuple] = {}
    for unit in dict.fromkeys(units):
        label = _label(unit)
        by_label[label] = _merged(by_label[label], unit) if label in by_label else unit
    return ("*", tuple(("|", by_label[k]) for k in sorted(by_label, key=repr)))


def _is_marked(unit: tuple) -> bool:
    return len(unit) == 1 and isinstance(unit[0], tuple)


def generalised(nodes: list[Node]) -> list[Node]:
    """Runs of ``LOOSE`` marked groups as one free slot, which also takes in what is marked beside it and elements of its
    labels."""
    units, out, i = _units(nodes), [], 0
    while i < len(units):
        run = i
        while run < len(units) and _is_marked(units[run]):
            run += 1
        held = [a for u in units[i:run] for a in _alternatives(u[0])]
        free = [u for u in units[i:run] if u[0][0] == "*" or (u[0][0] == "?" and len(u[0][1]) == 1 and u[0][1][0][0] == "*")]
        if run - i >= LOOSE or free:
            known = set(map(_label, held))
            while out and (_is_marked(out[-1]) or _label(out[-1]) in known):
                taken = out.pop()
                held += _alternatives(taken[0]) if _is_marked(taken) else [taken]
                known = set(map(_label, held))
            while run < len(units) and (_is_marked(units[run]) or _label(units[run]) in known):
                held += _alternatives(units[run][0]) if _is_marked(units[run]) else [units[run]]
                known = set(map(_label, held))
                run += 1
            out.append((_free(held),))
        else:
            out += units[i:run]
            if run < len(units):
                out.append(units[run])
                run += 1
        i = run
    return [n for u in out for n in u]


def _units(nodes: list[Node]) -> list[tuple]:
    """The nodes as whole elements where they are some, else as one group."""
    units, start, open_ = [], 0, []
    for i, node in enumerate(nodes):
        if isinstance(node, str) and node[0] == "/":
            if not open_ or node[1:] != open_.pop():
                return [tuple(nodes)]
        elif isinstance(node, str) and node != "#" and node.split(".")[0].lstrip("^") not in VOID:
            open_.append(node)
        if not open_:
            units.append(tuple(nodes[start : i + 1]))
            start = i + 1
    return units if not open_ else [tuple(nodes)]


def aligned(a: list[Node], b: list[Node]) -> list[Node]:
    """A wrapper for what either of two wrappers accepts: elements of one label are aligned inside, mismatches resolved into
    repeated, optional and free groups."""
    if a == b:
        return a
    ours, theirs = _units(a), _units(b)
    ours, theirs = _marked(ours, theirs), _marked(theirs, ours)
    out: list[Node] = []
    for kind, i, j, k, m in SequenceMatcher(None, [*map(_label, ours)], [*map(_label, theirs)], autojunk=False).get_opcodes():
        if kind == "equal":
            for x, y in zip(ours[i:j], theirs[k:m]):
                out += _merged(x, y)
        else:
            for unit in [*ours[i:j], *theirs[k:m]]:
                out += unit if _is_marked(unit) and unit[0][0] in "?*" else [("?", unit)]
    return folded(generalised(out))


def _plain(node):
    return [node[0], [_plain(n) for n in node[1]]] if isinstance(node, tuple) else node


def _node(plain) -> Node:
    return (plain[0], tuple(_node(n) for n in plain[1])) if isinstance(plain, list) else plain


def written(nodes: list[Node]) -> str:
    return json.dumps([_plain(n) for n in nodes], ensure_ascii=False, separators=(",", ":"))


def loaded(text: str) -> list[Node]:
    return [_node(n) for n in json.loads(text)]


def labels(nodes) -> set[str]:
    found = set()
    for node in nodes:
        found |= labels(node[1]) if isinstance(node, tuple) else {node}
    return found


def accepts(nodes: list[Node], stream: list[str]) -> bool:
    """The wrapper as a regular expression over the tags of a stream: first without going back into a group, as nearly
    all pages need, then through all ways at once."""
    letters = {label: chr(0xE000 + i) for i, label in enumerate(sorted(labels(nodes) | set(stream)))}

    def pattern(of) -> str:
        return "".join(letters[n] if isinstance(n, str) else f"(?:{inside(n)}){n[0]}+" for n in of)

    def inside(node: tuple) -> str:
        return "|".join(pattern(a[1]) for a in node[1]) if node[0] == "*" else pattern(node[1])

    if re.fullmatch(pattern(nodes), "".join(letters[s] for s in stream)):
        return True
    return _reaches(nodes, stream)


def _reaches(nodes: list[Node], stream: list[str]) -> bool:
    """All states of the expression that a stream leads to, one tag after another."""
    moves: list[dict[str, list[int]]] = [{}]
    jumps: list[list[int]] = [[]]

    def state() -> int:
        moves.append({})
        jumps.append([])
        return len(moves) - 1

    def laid(of, at: int) -> int:
        for node in of:
            end = state()
            if isinstance(node, str):
                moves[at].setdefault(node, []).append(end)
            else:
                sign, group = node
                begin = state()
                jumps[at].append(begin)
                for part in [a[1] for a in group] if sign == "*" else [group]:
                    last = laid(part, begin)
                    jumps[last].append(begin if sign in "*+" else end)
                    if sign == "+":
                        jumps[last].append(end)
                if sign in "?*":
                    jumps[begin].append(end)
            at = end
        return at

    def closed(states: set[int]) -> set[int]:
        found, left = set(states), list(states)
        while left:
            new = [n for n in jumps[left.pop()] if n not in found]
            found.update(new)
            left += new
        return found

    final = laid(nodes, 0)
    states = closed({0})
    for tag in stream:
        states = closed({n for at in states for n in moves[at].get(tag, ())})
        if not states:
            return False
    return final in states


def host(url: str | None) -> str:
    found = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


SEEN = "host string, kind string, item string, chars bigint, pages bigint, least bigint, most bigint, from bigint, to bigint"
_SEEN_TYPES = [pa.string()] * 3 + [pa.int64()] * 6


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) >> 1


def _slot(candidacies: tuple[tuple[str, int], ...], path: tuple[str, ...]) -> str:
    return "\t".join([",".join(f"{c}:{n}" for c, n in candidacies), *path])


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams (kind s), slots (kind t) and pages (kind n), combined per task.

    Slots have the text length, the number of pages, and the smallest and largest hash of the text and of the page.
    """
    held: dict[tuple[str, str, str], tuple[int, ...]] = {}

    def out() -> pa.RecordBatch:
        columns = zip(*[(*key, *value) for key, value in held.items()])
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _SEEN_TYPES)], [c.split()[0] for c in SEEN.split(", ")])

    for batch in batches:
        for url, html in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = html.as_py()
            page, at, whole_page = Page(text), host(url), _hash(text)
            held[at, "s", written(folded(page.stream))] = (0,) * 6
            held[at, "n", ""] = (0, held.get((at, "n", ""), (0, 0))[1] + 1, 0, 0, 0, 0)
            met = set()
            for candidacies, path, block in page.blocks:
                key, hashed = (at, "t", _slot(candidacies, path)), _hash(block)
                chars, pages, least, most, first, last = held.get(key, (0, 0, hashed, hashed, whole_page, whole_page))
                pages += key not in met
                met.add(key)
                held[key] = (chars + len(block), pages, min(least, hashed), max(most, hashed), min(first, whole_page), max(last, whole_page))
            if len(held) > HELD:
                yield out()
                held.clear()
    if held:
        yield out()


def _align(table: pa.Table) -> pa.Table:
    streams = sorted(table.column("item").to_pylist(), key=lambda s: (len(s), s))
    wrapper = loaded(streams[0])
    for stream in streams[1:]:
        wrapper = aligned(wrapper, loaded(stream))
    return pa.table({"host": table.column("host")[:1], "item": pa.array([written(wrapper)])})


SUMS = "host string, kind string, hints int, depth int, hashed bigint, chars bigint"


def _prefixes(path) -> Iterator[int]:
    """A hash of each path from the root, without the element of the text itself."""
    so_far = xxhash.xxh64()
    for label in path[:-1]:
        yield so_far.intdigest() >> 1
        so_far.update(label + "\t")
    if path:
        yield so_far.intdigest() >> 1


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Changing text by candidacy (depth -1), and under each element (kind p), combined per task."""
    names = [c.split()[0] for c in SUMS.split(", ")]
    types = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    held: dict[tuple, int] = {}

    def out() -> pa.RecordBatch:
        columns = zip(*[(*key, chars) for key, chars in held.items()])
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    for batch in batches:
        for at, item, chars in zip(*(c.to_pylist() for c in batch.columns)):
            candidacies, *path = item.split("\t")
            keys = []
            for candidacy in candidacies.split(","):
                kind, hints = candidacy.split(":")
                keys.append((at, kind, int(hints), -1, 0))
            keys += [(at, "p", int(hints), depth, hashed) for depth, hashed in enumerate(_prefixes(path))]  # the last is ""
            for key in keys:
                held[key] = held.get(key, 0) + chars
            if len(held) > HELD:
                yield out()
                held.clear()
    if held:
        yield out()


def chosen(sums: dict[tuple[str, int], int]) -> tuple[str, int] | None:
    """The container and number of hints for text lengths by candidacy; None if there is no container.

    The fewest hints, unless more of them leave over ten times the text; at equal hints the best container. A container
    under hints must hold more than what stands free of them outside any container.
    """
    inside = {k: n for k, n in sums.items() if k[0]}
    for kind, hints in sorted(inside, key=lambda k: (k[1], CONTAINERS.index(k[0]))):
        here = inside[kind, hints]
        if here >= FAIR * max((n for (_, h), n in inside.items() if h > hints), default=0):
            free = sum(n for (k, h), n in sums.items() if not k and h < hints)
            return (kind, hints) if here > free or not hints else None
    return None


def free_hints(sums: dict[tuple[str, int], int]) -> int:
    """The number of hints under which text outside containers still counts."""
    levels = {h: n for (k, h), n in sums.items() if not k}
    return next((h for h in sorted(levels) if levels[h] >= FAIR * max((n for g, n in levels.items() if g > h), default=0)), 0)


@F.udf(StructType().add("container", "string").add("hints", "integer").add("free", "integer"))
def _chosen(rows):
    sums = {(kind, hints): chars for kind, hints, chars in rows}
    return *(chosen(sums) or (None, None)), free_hints(sums)


def wrappers(pages: DataFrame) -> DataFrame:
    """host, wrapper, and rest: where the text of the host is, and which slots never change."""
    read = pages.select("url", whole("html").alias("html"))
    seen = cut(
        read.mapInArrow(_observed, SEEN)
        .groupBy("host", "kind", "item")
        .agg(*(F.sum(c).alias(c) for c in ("chars", "pages")), *(F.min(c).alias(c) for c in ("least", "from")), *(F.max(c).alias(c) for c in ("most", "to")))
    )
    now = seen.where("kind = 's'").select("host", "item")
    while True:
        counts = now.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
        if (counts.agg(F.max("n")).first()[0] or 0) <= 1:
            break
        sliced = now.join(counts, "host").withColumn("slice", F.pmod(F.xxhash64("item"), F.ceil(F.col("n") / FOLD)))
        now = cut(sliced.select("host", "slice", "item").groupBy("host", "slice").applyInArrow(_align, "host string, item string"))

    total = seen.where("kind = 'n'").select("host", F.col("pages").alias("all"))
    # the same text on several pages that are not copies of each other
    fixed = (F.col("least") == F.col("most")) & (F.col("from") != F.col("to")) & (F.col("pages") >= TEMPLATE * F.col("all"))
    slots = cut(seen.where("kind = 't'").join(total, "host").select("host", "item", "chars", fixed.alias("fixed")))
    summed = slots.where("NOT fixed").select("host", "item", "chars").mapInArrow(_summed, SUMS)
    summed = cut(summed.groupBy("host", "kind", "hints", "depth", "hashed").agg(F.sum("chars").alias("chars")))
    levels = summed.where("depth < 0").groupBy("host").agg(F.collect_list(F.struct("kind", "hints", "chars")).alias("rows"))
    choice = cut(levels.select("host", _chosen("rows").alias("c")).select("host", "c.*"))
    under = summed.where("depth >= 0").join(choice.select("host", "free"), "host").where("hints <= free")
    under = under.groupBy("host", "depth", "hashed").agg(F.sum("chars").alias("chars"))
    # at most one element of a depth has most of the text; every changing text is under the root, at depth 0
    most = under.join(under.where("depth = 0").select("host", F.col("chars").alias("of")), "host").where(F.col("chars") >= MOST * F.col("of"))
    deepest = most.groupBy("host").agg(F.max(F.struct("depth", "hashed")).alias("at"))
    constant = slots.where("fixed").groupBy("host").agg(F.sort_array(F.collect_set("item")).alias("constant"))
    rest = total.join(choice, "host", "left").join(deepest, "host", "left").join(constant, "host", "left")
    rest = rest.select("host", F.to_json(F.struct("container", "hints", "free", "at.depth", "at.hashed", "constant")).alias("rest"))
    return now.select("host", F.col("item").alias("wrapper")).join(rest, "host", "left")


@lru_cache(maxsize=10_000)
def _wrapper(text: str, rest: str | None) -> tuple[list[Node], tuple[str, int] | None, int, tuple[int, int] | None, frozenset[str]]:
    found = json.loads(rest) if rest else {}
    container = (found["container"], found["hints"]) if "container" in found else None
    deepest = (found["depth"], found["hashed"]) if "depth" in found else None
    return loaded(text), container, found.get("free", 0), deepest, frozenset(found.get("constant", ()))


def main_text(html: str, wrapper: str, rest: str | None = None) -> tuple[str, bool]:
    """Text of the host's main slots on a page, and whether the wrapper accepts the page's tags."""
    page = Page(html)
    nodes, container, free, deepest, constant = _wrapper(wrapper, rest)

    def inside(kind: str, most: int) -> list[str]:
        return [text for candidacies, _, text in page.blocks if any(c == kind and n <= most for c, n in candidacies)]

    kept = inside(*container) if container else []
    if not kept:  # the host has it on other pages only, or not at all
        sums: dict[tuple[str, int], int] = {}
        for candidacies, _, text in page.blocks:
            for key in candidacies:
                sums[key] = sums.get(key, 0) + len(text)
        own = chosen(sums)
        kept = inside(*own) if own else []
    if not kept:
        blocks = [(_slot(c, path), path, text) for c, path, text in page.blocks if c[-1][1] <= free]
        changing = [b for b in blocks if b[0] not in constant] or blocks
        kept = [t for _, path, t in changing if deepest and deepest in enumerate(_prefixes(path))] or [t for *_, t in changing]
    return "\n\n".join(kept), accepts(nodes, page.stream)


def extracted(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text (empty if none), n_chars, and matched: its wrapper accepts its tags.

    Null html counts as empty, a null or odd url as the host "". Repeated rows are extracted one by one; other columns
    are never read, whatever their names; an empty table gives no rows.
    """
    spark = pages.sparkSession
    place = scratch_path(spark, "wrappers")
    wrappers(pages).write.parquet(place)  # a table, so that Spark knows its size and joins it without moving pages if small
    known = spark.read.parquet(place).select(F.col("host").alias("__host"), "wrapper", "rest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html, wrapper, rest = (batch.column(i) for i in (2, 3, 4))
            found = [main_text(h.as_py(), w.as_py(), r.as_py()) for h, w, r in zip(html, wrapper, rest)]
            columns = [pa.array([t for t, _ in found], pa.string()), pa.array([len(t) for t, _ in found], pa.int64())]
            columns.append(pa.array([m for _, m in found], pa.bool_()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["page_id", "url", "text", "n_chars", "matched"])

    at = F.coalesce(F.lower(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", whole("html").alias("html"), at.alias("host"))
    met = rows.join(known, F.col("host") == F.col("__host"), "left").select("page_id", "url", "html", F.coalesce("wrapper", F.lit("[]")), "rest")
    return met.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint, matched boolean")
