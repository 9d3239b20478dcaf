"""Main text of web pages by wrapper induction: trees of same-host pages aligned by simple tree matching.

Pages of a host share a template. Every page's tree is aligned with one
reference tree of its host; over all pages of the host, an aligned node whose
text is always the same belongs to the template, and one whose text varies is a
slot. The wrapper of a host is the path to the node that holds the varying text,
and the constant nodes below it. Pages of hosts with too few pages, or whose
tree lacks that path, fall back on the meaning of tags and class names.
"""

from __future__ import annotations

import html as entities
import json
import math
import re
import zlib
from collections import Counter
from collections.abc import Generator, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.spread import cut, drop, skewed_join

# Elements of HTML by kind.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr nobr img picture source audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe xmp noembed noframes svg math".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split()
)
SIBLING = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
NOT_TEXT = frozenset("head nav footer aside form button select menu dialog object canvas applet datalist".split())
#: Words of class, id or role that name what is no article text.
BOILERPLATE = frozenset(
    "ad ads adv advert advertisement advertisements adsense banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies copyright disclaimer disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notification pagination paywall popup promo promoted related reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar topbar widget widgets complementary contentinfo alert".split()
)

_TAG = re.compile(r"""<(?:!--(?:.*?--!?>|.*\Z)|[!?][^>]*+>|(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>)""", re.S)
_NAMES = re.compile(r"""(?:^|\s)(class|id|role|hidden|style|aria-hidden)(?=[\s=/]|$)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[a-z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: A node is constant with one text on that share of the pages that have it; inside the content it is template only if by
#: the rule of succession the next page has that text too with so much certainty, which no host of a few pages can give.
CONSTANT = 0.95
CERTAIN = 0.9
#: What a matching holds at once: weights of pairs of shapes, and cells of one pair of lists. Beyond it they are computed again.
HELD_WEIGHTS, HELD_CELLS = 500_000, 4 << 20


class Page:
    """A tree of block elements: tags, keys (tag and class), parents, flags; and text blocks in page order."""

    __slots__ = ("blocks", "keys", "named", "parents", "tags")

    def __init__(self, source: str):
        self.tags, self.keys, self.parents, self.named = ["#"], ["#"], [-1], [False]
        self.blocks: list[tuple[int, str]] = []
        self._read(source)

    def _read(self, source: str) -> None:
        stack, pieces, pos = [0], [], 0
        open_ = Counter({"#": 1})  # how many elements of each tag are open: no search of the stack for one that is not
        tags, size, search = self.tags, len(source), _TAG.search
        closed = source.rfind(">") + 1  # nothing behind it is a tag, so none is looked for there

        def flush() -> None:
            if pieces:
                text = " ".join(entities.unescape("".join(pieces)).split())
                if text:
                    self.blocks.append((stack[-1], text))
                pieces.clear()

        while pos < size:
            found = search(source, pos, closed) if pos < closed else None
            if not found:
                open_comment = source.find("<!--", max(pos, closed))
                pieces.append(source[pos : open_comment if open_comment >= 0 else size])
                break
            if found.start() > pos:
                pieces.append(source[pos : found.start()])
            pos = found.end()
            if pos == closed and found[0].startswith("<!--") and not found[0].endswith(("-->", "--!>")):
                break  # a comment that never ends
            tag = found[2] or found[5]
            if not tag:
                continue
            tag, closing, rest = tag.lower(), found[1] or found[4], (found[3] or found[6] or "")
            if tag == "br":
                pieces.append(" ")
            elif tag in RAW and not closing:
                if not rest.endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(source, pos)
                    pos = source.find(">", end.start()) + 1 if end else size
                    pos = pos or size
            elif tag in INLINE or tag in RAW:
                continue
            elif closing:
                flush()
                if open_[tag]:
                    self._leave(stack, open_, next(depth for depth in range(len(stack) - 1, 0, -1) if tags[stack[depth]] == tag))
            else:
                flush()
                if tag in CLOSES_P and open_["p"]:
                    self._close(stack, open_, {"p"}, {"button", "table"})
                if tag in SIBLING:
                    while any(open_[t] for t in SIBLING[tag][0]) and self._close(stack, open_, *SIBLING[tag]):
                        pass
                if tag in ("html", "body") and open_[tag]:
                    continue
                if tag in VOID:
                    continue
                self._open(stack, tag, rest)
                open_[tag] += 1
                if rest.endswith("/") and tag not in CLOSES_P:
                    self._leave(stack, open_, len(stack) - 1)
        flush()

    def _leave(self, stack: list[int], open_: Counter, depth: int) -> None:
        for n in stack[depth:]:
            open_[self.tags[n]] -= 1
        del stack[depth:]

    def _close(self, stack: list[int], open_: Counter, which: set[str], scope: set[str]) -> bool:
        """Leave the innermost open element of `which`, unless one of `scope` stands in between."""
        for depth in range(len(stack) - 1, 0, -1):
            tag = self.tags[stack[depth]]
            if tag in which:
                self._leave(stack, open_, depth)
                return True
            if tag in scope:
                return False
        return False

    def _open(self, stack: list[int], tag: str, rest: str) -> None:
        named, key = tag in NOT_TEXT, tag
        if rest.strip():
            for name, *values in _NAMES.findall(rest):
                value, name = "".join(values).lower(), name.lower()
                if name == "hidden" or (name == "style" and _HIDDEN.search(value)) or (name == "aria-hidden" and value == "true"):
                    named = True
                elif name in ("class", "id", "role"):
                    words = _WORD.findall(value)
                    named = named or not BOILERPLATE.isdisjoint(words)
                    if name == "class":
                        key = f"{tag}.{'.'.join(sorted(value.split()))}"
        self.tags.append(tag)
        self.keys.append(key)
        self.parents.append(stack[-1])
        self.named.append(named)
        stack.append(len(self.tags) - 1)

    def inside(self, root: int) -> list[bool]:
        out = [False] * len(self.tags)
        for n in range(root, len(self.tags)):
            out[n] = n == root or out[self.parents[n]]
        return out

    def left_out(self, root: int) -> list[bool]:
        """Nodes that tags or names call no article text; one that holds the article, its heading or most of the text stays."""
        mass, holds = [0] * len(self.tags), [t in ("article", "main", "h1") for t in self.tags]
        for n, text in self.blocks:
            mass[n] += len(text)
        for n in range(len(self.tags) - 1, 0, -1):
            mass[self.parents[n]] += mass[n]
            holds[self.parents[n]] = holds[self.parents[n]] or holds[n]
        out = [False] * len(self.tags)
        for n in range(1, len(self.tags)):
            own = self.named[n] and n > root and not (holds[n] and self.tags[n] not in NOT_TEXT and self.tags[n] != "article") and (self.tags[n] in NOT_TEXT or mass[n] * 2 < mass[root] or self.tags[n] == "article")
            if self.tags[n] == "header" and n > root and not holds[n]:
                own = True
            out[n] = own or out[self.parents[n]]
        return out

    def main_root(self) -> int:
        """The node that tags call the article; the body or the whole page if there is none."""
        mass = [0] * len(self.tags)
        for n, text in self.blocks:
            mass[n] += len(text)
        for n in range(len(self.tags) - 1, 0, -1):
            mass[self.parents[n]] += mass[n]
        named = self.left_out(0)
        for tag in ("article", "main", "body"):
            nodes = [n for n, t in enumerate(self.tags) if t == tag and not named[n]]
            if nodes:
                return max(nodes, key=lambda n: (mass[n], -n))
        return 0

    def find(self, path: list[str]) -> int | None:
        """The first node at the end of the path of keys."""
        depth = [0] * len(self.tags)
        for n in range(1, len(self.tags)):
            at = depth[self.parents[n]]
            depth[n] = at + 1 if 0 <= at < len(path) and self.keys[n] == path[at] else -1
            if depth[n] == len(path):
                return n
        return None

    def text(self, wrapper: dict | None = None) -> str:
        root = self.find(wrapper["root"]) if wrapper and wrapper["root"] else None
        if root is None:
            root = self.main_root()
        inside, out = self.inside(root), self.left_out(root)
        if not (wrapper and wrapper["constant"]):
            return "\n".join(text for n, text in self.blocks if inside[n] and not out[n])
        steps, constant = {(parent, key): i for i, (parent, key) in enumerate(wrapper["steps"])}, {tuple(x) for x in wrapper["constant"]}
        place = [-1] * len(self.tags)  # -1 for the page itself, then the step of the node's path, -2 where no constant node lies below
        for n in range(1, len(self.tags)):
            place[n] = steps.get((place[self.parents[n]], self.keys[n]), -2)
        return "\n".join(text for n, text in self.blocks if inside[n] and not out[n] and (place[n], zlib.crc32(text.encode())) not in constant)

    def tree(self) -> list:
        """[key, text hash, text length, children]; in a run of alike leaves only the first and last stand alone."""
        texts: dict[int, list[str]] = {}
        for n, text in self.blocks:
            texts.setdefault(n, []).append(text)
        children: dict[int, list[int]] = {}
        for n in range(1, len(self.tags)):
            children.setdefault(self.parents[n], []).append(n)

        top: list = []
        todo = [(0, "#", top)]
        while todo:
            n, key, into = todo.pop()
            text = "\n".join(texts.get(n, ()))
            own: list = [key, zlib.crc32(text.encode()), len(text), []]
            into.append(own)
            below, later, i = children.get(n, []), [], 0
            while i < len(below):
                j = i
                while j < len(below) and self.keys[below[j]] == self.keys[below[i]] and below[j] not in children:
                    j += 1
                name = self.keys[below[i]]
                if j - i > 2:
                    middle = "\n".join(t for m in below[i + 1 : j - 1] for t in texts.get(m, ()))
                    first, last = ("\n".join(texts.get(m, ())) for m in (below[i], below[j - 1]))
                    leaves = [(name, first), (f"{name}+", middle), (f"{name}$", last)]
                    own[3] += [[k, zlib.crc32(t.encode()), len(t), []] for k, t in leaves]
                    i = j
                else:
                    # Children are filled in page order: a place is kept for each, what is below follows later.
                    later.append((below[i], name, len(own[3])))
                    own[3].append(None)
                    i += 1
            for m, name, at in later:
                todo.append((m, name, _Slot(own[3], at)))
        return top[0]


class _Slot:
    """A place in a list that one append fills."""

    __slots__ = ("at", "rows")

    def __init__(self, rows: list, at: int):
        self.rows, self.at = rows, at

    def append(self, value: list) -> None:
        self.rows[self.at] = value


class _Matching:
    """Weights of pairs of nodes of two trees. They depend on the nodes' shapes alone (key, and shapes of what is below), so nodes of one shape are weighed once.

    Generators ask for the weights they need, so depth is no limit. A weight
    asks for those of its children row by row; what is known of others only
    saves time and may be forgotten, so memory is bounded for any size.
    """

    def __init__(self, a: list, b: list):
        self.shapes: list[tuple[str, tuple[int, ...], int]] = []  # key, shapes below, nodes
        self.of: dict[int, int] = {}
        self.weights: dict[tuple[int, int], int] = {}
        known: dict[tuple[str, tuple[int, ...]], int] = {}
        for node in [*reversed(number(a)), *reversed(number(b))]:
            own = node[0], tuple([self.of[id(c)] for c in node[3]])
            if own not in known:
                known[own] = len(self.shapes)
                self.shapes.append((*own, 1 + sum(self.shapes[c][2] for c in own[1])))
            self.of[id(node)] = known[own]

    def _run(self, asking: Generator):
        stack, out = [asking], None
        while stack:
            try:
                pair = stack[-1].send(out)
            except StopIteration as end:
                stack.pop()
                out = end.value
            else:
                stack.append(self._weigh(*pair))
                out = None
        return out

    @staticmethod
    def _alike(xs: tuple[int, ...], ys: tuple[int, ...]) -> int:
        """How many of the last are of one shape: of such two at the end no other pairing weighs more."""
        n = 0
        while n < len(xs) and n < len(ys) and xs[-1 - n] == ys[-1 - n]:
            n += 1
        return n

    def _weigh(self, s: int, t: int) -> Generator:
        xs, ys = self.shapes[s][1], self.shapes[t][1]
        n = self._alike(xs, ys)
        total = 1 + sum(self.shapes[c][2] for c in xs[len(xs) - n :])
        xs, ys = xs[: len(xs) - n], ys[: len(ys) - n]
        if xs and ys:
            row, known = self._first(ys), {}
            for c in xs:
                row, _ = yield from self._row(c, ys, row, known)
            total += int(row[-1])
        if len(self.weights) >= HELD_WEIGHTS:
            self.weights.clear()
        self.weights[s, t] = total
        return total

    @staticmethod
    def _first(ys: tuple[int, ...]):
        return [0] * (len(ys) + 1) if len(ys) < 64 else np.zeros(len(ys) + 1, np.int64)

    def _row(self, c: int, ys: tuple[int, ...], above, known: dict) -> Generator:
        """The most that can be paired up to c with the first of ys, and the last step to each: 2 a pair, 1 to the left, 0 up."""
        own = known.get(c)
        if own is None:
            own, (key, below, _) = [], self.shapes[c]
            for d in ys:
                other = self.shapes[d]
                weight = other[2] if c == d else -(1 << 40) if key != other[0] else 1 if not (below and other[1]) else self.weights.get((c, d))
                if weight is None:
                    weight = yield c, d
                own.append(weight)
            if len(ys) >= 64:
                own = np.array(own, np.int64)
            if len(known) * len(ys) >= HELD_CELLS:
                known.clear()
            known[c] = own
        if len(ys) >= 64:
            best = above[:-1] + own
            row = np.append(0, np.maximum.accumulate(np.maximum(best, above[1:])))
            return row, np.where(best == row[1:], 2, row[:-1] == row[1:]).astype(np.uint8)
        row, went = [0], bytearray()
        for j, weight in enumerate(own):
            best = above[j] + weight
            most = max(best, row[j], above[j + 1])
            went.append(2 if best == most else 1 if row[j] == most else 0)
            row.append(most)
        return row, went

    def below(self, x: list, y: list) -> list[tuple[list, list]]:
        """The pairs of children of two paired nodes. Steps are kept for a block of rows at a time, of the others the first row."""
        xs, ys = self.shapes[self.of[id(x)]][1], self.shapes[self.of[id(y)]][1]
        n = self._alike(xs, ys)
        i, j = len(xs) - n, len(ys) - n
        out = list(zip(x[3][i:], y[3][j:], strict=True))
        if not i or not j:
            return out
        ys, known = ys[:j], {}
        height = max(HELD_CELLS // j, math.isqrt(i) + 1)
        heads = [self._first(ys)]
        row = heads[0]
        for k in range((i - 1) // height * height):
            row, _ = self._run(self._row(xs[k], ys, row, known))
            if (k + 1) % height == 0:
                heads.append(row)
        for block in reversed(range(len(heads))):
            row, moves, first = heads[block], [], block * height
            for k in range(first, i):
                row, went = self._run(self._row(xs[k], ys, row, known))
                moves.append(went)
            while i > first and j:
                move = moves[i - 1 - first][j - 1]
                if move == 2:
                    out.append((x[3][i - 1], y[3][j - 1]))
                i, j = i - (move != 1), j - (move != 0)
            if not j:
                break
        return out


def match_trees(a: list, b: list) -> tuple[int, list[tuple[list, list]]]:
    """Simple tree matching: the most nodes that can be paired in order under paired parents, and the pairs; exact for trees of any size."""
    if a[0] != b[0]:
        return 0, []
    matching = _Matching(a, b)
    pairs, todo = [], [(a, b)]
    while todo:
        x, y = todo.pop()
        if matching.of[id(x)] == matching.of[id(y)]:
            pairs += zip(number(x), number(y), strict=True)
        else:
            pairs.append((x, y))
            todo += matching.below(x, y)
    return len(pairs), pairs


def number(tree: list) -> list[list]:
    """The nodes in preorder."""
    out, todo = [], [tree]
    while todo:
        node = todo.pop()
        out.append(node)
        todo.extend(reversed(node[3]))
    return out


def above(nodes: list[list]) -> list[int]:
    """The parent of each node in preorder, -1 for the first."""
    place, out = {id(n): i for i, n in enumerate(nodes)}, [-1] * len(nodes)
    for i, n in enumerate(nodes):
        for child in n[3]:
            out[place[id(child)]] = i
    return out


def write_tree(tree: list) -> str:
    nodes = number(tree)
    return json.dumps([[n[0] for n in nodes], [n[1] for n in nodes], [n[2] for n in nodes], above(nodes)], separators=(",", ":"))


def read_tree(text: str) -> list:
    keys, hashes, sizes, parents = json.loads(text)
    nodes = [[k, h, n, []] for k, h, n in zip(keys, hashes, sizes, strict=True)]
    for node, parent in zip(nodes[1:], parents[1:], strict=True):
        nodes[parent][3].append(node)
    return nodes[0]


def beyond(tree: list, pairs: list[tuple[list, list]]) -> dict[int, int]:
    """By id of each paired node of the tree: the characters below it that no node of the reference has a place for."""
    nodes = number(tree)
    parents, size = above(nodes), [n[2] for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        size[parents[i]] += size[i]
    paired, out = {id(y) for _, y in pairs}, {}
    for i, n in enumerate(nodes):
        if i and id(n) not in paired and id(nodes[parents[i]]) in paired:
            out[id(nodes[parents[i]])] = out.get(id(nodes[parents[i]]), 0) + size[i]
    return out


def induce(reference: list, aligned: list[int], most: list[int], unlike: list[int], mass: list[int], common: list[int], extra: list[int]) -> dict:
    """The wrapper of a host from what its distinct pages say of each node of the reference tree."""
    nodes = number(reference)
    parents, place = above(nodes), {id(n): i for i, n in enumerate(nodes)}
    pages = aligned[0]
    constant = [a >= 2 and unlike[i] > 0 and most[i] >= CONSTANT * a for i, a in enumerate(aligned)]
    varying = [(0 if c else m) + e for c, m, e in zip(constant, mass, extra, strict=True)]
    for i in range(len(nodes) - 1, 0, -1):
        varying[parents[i]] += varying[i]
    if pages < 2 or not varying[0]:
        return {"root": [], "steps": [], "constant": []}
    at, path = 0, []
    while True:
        below = [place[id(c)] for c in nodes[at][3]]
        lead = max(((varying[i], i) for i in below if nodes[i][3]), default=(0, 0))
        if lead[0] < 0.8 * max(1, sum(varying[i] for i in below)) or (0 if constant[at] else mass[at]) + extra[at] > lead[0]:
            break
        at = lead[1]
        path.append(nodes[at][0])
    # Steps of paths from the page down, and the constant nodes of the content by the step they end at.
    sure = lambda i: constant[i] and mass[i] and aligned[i] >= CONSTANT * pages and most[i] + 1 >= CERTAIN * (aligned[i] + 2) and not nodes[i][0].endswith("+")
    steps: dict[tuple[int, str], int] = {}
    ends, inside, fixed = [-1] * len(nodes), [i == at for i in range(len(nodes))], []
    for i in range(1, len(nodes)):
        ends[i] = steps.setdefault((ends[parents[i]], nodes[i][0].rstrip("$+")), len(steps))
        inside[i] = inside[i] or inside[parents[i]]
        if inside[i] and i != at and sure(i):
            fixed.append([ends[i], common[i]])
    return {"root": path if path and path[-1] not in ("html", "body") else [], "steps": [list(x) for x in steps] if fixed else [], "constant": fixed}


def _host(url):
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        trees = [write_tree(Page(x.as_py()).tree()) for x in batch.column(2)]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(trees, pa.string())], names=["_host", "_order", "_tree"])


#: Sums that a task holds before it hands them on.
SAID = 200_000


def _say(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each page says of its host's reference nodes, summed over SAID sums or a batch."""
    known: tuple[str, list, dict[int, int]] = ("", [], {})

    def sums(said: dict[tuple[str, int, int], list[int]]) -> pa.RecordBatch:
        keys, values = list(said), list(said.values())
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), *(pa.array([k[n] for k in keys], pa.int64()) for n in (1, 2)), *(pa.array([v[n] for v in values], pa.int64()) for n in (0, 1, 2))],
            names=["_host", "_node", "_hash", "_n", "_chars", "_extra"],
        )

    for batch in batches:
        said: dict[tuple[str, int, int], list[int]] = {}
        for host, tree, reference in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if known[0] != reference:
                tree_of = read_tree(reference)
                known = (reference, tree_of, {id(n): i for i, n in enumerate(number(tree_of))})
            place = known[2]
            page = read_tree(tree)
            pairs = match_trees(known[1], page)[1]
            more = beyond(page, pairs)
            for ours, theirs in pairs:
                x = said.setdefault((host, place[id(ours)], theirs[1]), [0, 0, 0])
                x[0] += 1
                x[1] += theirs[2]
                x[2] += more.get(id(theirs), 0)
            if len(said) >= SAID:
                yield sums(said)
                said = {}
        yield sums(said)


def _induce(said: pd.DataFrame, references: pd.DataFrame) -> pd.DataFrame:
    if said.empty or references.empty:
        return pd.DataFrame({"_host": [], "_wrapper": []})
    reference = read_tree(references["_reference"].iloc[0])
    size = len(number(reference))
    columns = {c: [0] * size for c in ("_n", "_most", "_unlike", "_chars", "_common", "_extra")}
    for row in said.to_dict("records"):
        for c, values in columns.items():
            values[int(row["_node"])] = int(row[c])
    wrapper = induce(reference, columns["_n"], columns["_most"], columns["_unlike"], columns["_chars"], columns["_common"], columns["_extra"])
    return pd.DataFrame({"_host": [references["_host"].iloc[0]], "_wrapper": [json.dumps(wrapper)]})


#: Wrappers of so many characters in all are broadcast; more are joined by a shuffle dealt over salts.
MAX_BROADCAST = 20_000_000
#: Characters of the wrappers that a task keeps read.
MAX_KNOWN = 10_000_000


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: id, url, text.

    Null html counts as empty and gives an empty text; a null or odd url has no
    host, and such pages and those of a host of one page are read by the meaning
    of their tags. Repeated pages each give a row; a passage that pages share is
    kept unless it stands in the same place on nearly all pages of its host.
    Other columns are ignored; no rows give no rows.
    """
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), F.coalesce(F.col(html_col), F.lit("")).alias("_html"), _host(F.col(url_col)).alias("_host"))
    order = F.struct(F.xxhash64("_html").alias("h"), F.col("_id").cast("string").alias("i"))
    trees = cut(rows.where("_host <> ''").select("_host", F.to_json(order), "_html").mapInArrow(_trees, "_host string, _order string, _tree string"))
    references = cut(trees.groupBy("_host").agg(F.min_by("_tree", "_order").alias("_reference"), F.count(F.lit(1)).alias("_pages")).where("_pages > 1").select("_host", "_reference"))
    joined = skewed_join(trees.select("_host", "_tree").distinct(), references, "_host").select("_host", "_tree", "_reference")
    said = joined.mapInArrow(_say, "_host string, _node long, _hash long, _n long, _chars long, _extra long")
    by_text = said.groupBy("_host", "_node", "_hash").agg(F.sum("_n").alias("_n"), F.sum("_chars").alias("_chars"), F.sum("_extra").alias("_extra"))
    by_node = by_text.groupBy("_host", "_node").agg(F.sum("_n").alias("_n"), F.max("_n").alias("_most"), F.count(F.lit(1)).alias("_unlike"), F.sum("_chars").alias("_chars"), F.sum("_extra").alias("_extra"), F.max_by("_hash", F.struct("_n", "_hash")).alias("_common"))
    wrappers = cut(by_node.groupBy("_host").cogroup(references.groupBy("_host")).applyInPandas(_induce, "_host string, _wrapper string"))
    if (wrappers.agg(F.sum(F.length("_wrapper") + F.length("_host"))).first()[0] or 0) <= MAX_BROADCAST:
        dressed = rows.join(F.broadcast(wrappers), "_host", "left")
    else:
        dressed = skewed_join(rows, wrappers, "_host", "left")
    kind = pages.schema[id_col].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        held = 0
        for batch in batches:
            texts = []
            for source, wrapper in zip(batch.column(2), batch.column(3), strict=True):
                wrapper = wrapper.as_py()
                if wrapper and wrapper not in known:
                    if held > MAX_KNOWN:
                        known, held = {}, 0
                    known[wrapper] = json.loads(wrapper)
                    held += len(wrapper)
                texts.append(Page(source.as_py()).text(known[wrapper] if wrapper else None))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=[id_col, url_col, "text"])

    out = dressed.select("_id", "_url", "_html", "_wrapper").mapInArrow(read, f"{id_col} {kind}, {url_col} string, text string")
    drop(trees)
    return out


def op10(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
