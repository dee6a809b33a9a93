"""Tolerant HTML reading for one page: block elements, text blocks, and trees to align."""

from __future__ import annotations

import hashlib
import html
import json
import re

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)[\"']?[^>]*+>?", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_TELLING = re.compile(r"\b(?:class|id|role|hidden|aria-hidden|style|itemprop)\b", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

# Element names of HTML by kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section select summary "
    "table tbody td template tfoot th thead tr ul".split()
)
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
LISTS = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
# Elements, roles and words of class or id that name what is not the article.
NOISE_TAGS = frozenset(
    "head nav footer aside form button select textarea script style noscript template iframe svg canvas object audio video menu dialog search".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar toolbar".split())
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer "
    "gdpr menu menubar modal nav navbar navigation newsletter notice notices overlay popup promo promoted related replies reply respond "
    "share sharing sidebar signup social sponsor sponsored subscribe subscription teaser toast toolbar widget widgets".split()
)
CONTENT_WORDS = frozenset("article content entry main post story".split())
#: Elements below this depth count with their ancestor when trees are aligned.
DEPTH = 60


class Page:
    """Block elements in page order (parallel lists) and the text blocks they hold."""

    def __init__(self, source: str | None):
        self.tag, self.parent, self.label, self.depth, self.noise, self.words = ["#root"], [-1], ["#root"], [0], [False], [frozenset()]
        self.blocks: list[tuple[int, str, bool]] = []  # element, text, all of it in links
        self._read(source or "")
        self._settle()

    def _attributes(self, text: str) -> tuple[frozenset, bool, bool]:
        """(words of class, id and itemprop; hidden or of a noise role; main by its role)."""
        words, noise, main = set(), False, False
        for name, *values in _ATTRIBUTE.findall(text):
            name, value = name.lower(), next((v for v in values if v), "")
            if name in ("class", "id", "itemprop"):
                words |= {w.lower() for w in _WORDS.findall(value)}
            elif name == "role":
                noise |= value.strip().lower() in NOISE_ROLES
                main |= value.strip().lower() in ("main", "article")
            elif name == "hidden" or (name == "aria-hidden" and value.strip().lower() == "true"):
                noise = True
            elif name == "style":
                noise |= re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None
        return frozenset(words), noise, main

    def _read(self, source: str) -> None:
        stack: list[tuple[str, int, int]] = [("#root", 0, 0)]  # tag, block element, inline elements hidden so far
        count: dict[str, int] = {}
        here, links, hidden, text, linked, plain = 0, 0, 0, [], 0, 0
        at, end = 0, len(source)

        def flush():
            nonlocal text, linked, plain
            if text:
                joined = "".join(text)
                block = " ".join((html.unescape(joined) if "&" in joined else joined).split())
                if block:
                    self.blocks.append((here, block, linked > 0 and plain == 0))
            text, linked, plain = [], 0, 0

        def take(piece: str):
            nonlocal linked, plain
            if hidden:
                return
            text.append(piece)
            if piece and not piece.isspace():
                if links:
                    linked += 1
                else:
                    plain += 1

        def pop():
            nonlocal here, links, hidden
            tag, _, was = stack.pop()
            count[tag] -= 1
            if tag in BLOCK:
                flush()
            elif tag == "a":
                links -= 1
            here, hidden = stack[-1][1], was

        def close(tags: set, scope: set):
            """Ends the innermost open element of ``tags`` above one of ``scope``."""
            if any(count.get(t) for t in tags):
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] in scope:
                        return
                    if stack[depth][0] in tags:
                        while len(stack) > depth:
                            pop()
                        return

        while at < end:
            found = _TOKEN.search(source, at)
            if not found:
                take(source[at:])
                break
            if found.start() > at:
                take(source[at : found.start()])
            at = found.end()
            cdata, ends, name, rest = found.groups()
            if cdata:
                take(cdata.replace("&", "&amp;"))
            if not name:
                continue
            name = name.lower()
            if ends:
                if count.get(name):
                    while stack[-1][0] != name:
                        pop()
                    pop()
                elif name == "p":
                    flush()
                continue
            if name == "br":
                take(" ")
                continue
            if name in CLOSED_BY:
                close(CLOSED_BY[name], LISTS[name])
            if name in BLOCK:
                if name not in ("option", "optgroup"):
                    close({"p"}, {"table", "td", "th", "button", "caption"})
                flush()
            words, noise, main = self._attributes(rest) if rest and _TELLING.search(rest) else (frozenset(), False, False)
            raw = name in RAW and not rest.rstrip().endswith("/")
            if raw:
                closing = re.compile(rf"</{name}(?=[\s/>])[^>]*+>?", re.I).search(source, at)
                at = closing.end() if closing else end
            if name in VOID or raw or (rest.rstrip().endswith("/") and name not in BLOCK):
                continue
            block, was = here, hidden
            if name in BLOCK:
                block = len(self.tag)
                self.tag.append("main" if main and name != "article" else name)
                self.parent.append(here)
                self.depth.append(self.depth[here] + 1)
                self.words.append(words)
                self.label.append(".".join([name, *sorted(words)]))
                self.noise.append(noise or name in NOISE_TAGS)
            elif noise or name in NOISE_TAGS or words & NOISE_WORDS:
                hidden += 1
            if name == "a":
                links += 1
            stack.append((name, block, was))
            count[name] = count.get(name, 0) + 1
            here = block
        while len(stack) > 1:
            pop()
        flush()

    def _settle(self) -> None:
        """Marks what is not the article: ``self.kept`` holds the blocks of the region, ``self.loose`` whether no element names one."""
        n = len(self.tag)
        core = [t in ("article", "main", "h1") for t in self.tag]
        off = self.noise[:]
        for i in range(n - 1, 0, -1):  # children come after their parents, so here they are settled
            named = bool(self.words[i] & NOISE_WORDS)
            if self.tag[i] in ("article", "main"):
                off[i] = off[i] or bool(self.words[i] & {"comment", "comments", "reply", "replies", "teaser", "related", "promo", "ad", "ads", "sponsored"})
                core[i] = not off[i]
            elif self.tag[i] in ("html", "body"):
                off[i] = False
            elif core[i] and self.tag[i] != "h1" and (named or self.tag[i] == "form"):
                off[i] = self.noise[i] and self.tag[i] != "form"  # it wraps the article
            elif named:
                off[i] = True
            if off[i]:
                core[i] = False
            if core[i]:
                core[self.parent[i]] = True
        inside = [""] * n
        for i in range(1, n):
            up = self.parent[i]
            off[i] = off[i] or off[up] or (self.tag[i] == "header" and inside[up] != "article")
            own = self.tag[i] if self.tag[i] in ("article", "main") else "content" if self.words[i] & CONTENT_WORDS and self.tag[i] in ("div", "section", "td") else ""
            inside[i] = "article" if "article" in (own, inside[up]) else "main" if "main" in (own, inside[up]) else own or inside[up]
        open_ = [(e, text, links) for e, text, links in self.blocks if not off[e]]
        for kind in ("article", "main", "content"):
            kept = [(e, text) for e, text, _ in open_ if inside[e] == kind or (kind != "article" and inside[e] == "article")]
            if kept:
                break
        else:
            kept = [(e, text) for e, text, links in open_ if not links]
        self.kept = kept

    def tree(self) -> tuple[Tree, list[int]]:
        """The page's folded tree: same-labelled children of an element are one node; and each element's node."""
        tree, number, place = Tree([self.label[0]], [-1]), [0] * len(self.tag), {}
        for i in range(1, len(self.tag)):
            up = number[self.parent[i]]
            if self.depth[i] > DEPTH:
                number[i] = up
                continue
            number[i] = place.setdefault((up, self.label[i]), len(tree.labels))
            if number[i] == len(tree.labels):
                tree.labels.append(self.label[i])
                tree.parents.append(up)
        return tree, number


class Tree:
    """Labels and parents of nodes; a node's children are in the order of their numbers."""

    def __init__(self, labels: list[str], parents: list[int]):
        self.labels, self.parents = labels, parents

    def children(self) -> list[list[int]]:
        out: list[list[int]] = [[] for _ in self.labels]
        for i, up in enumerate(self.parents):
            if up >= 0:
                out[up].append(i)
        return out

    def dump(self) -> str:
        return json.dumps([self.labels, self.parents])

    @classmethod
    def load(cls, text: str) -> Tree:
        return cls(*json.loads(text))


def digest(text: str) -> int:
    """A 64-bit hash, the same in every task."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def simple_tree_matching(a: Tree, b: Tree) -> dict[int, int]:
    """Node of ``a`` to node of ``b``, of a largest order-preserving alignment in which matched nodes have matched parents."""
    below_a, below_b = a.children(), b.children()

    def match(x: int, y: int) -> list[tuple[int, int]]:
        rows, columns = below_a[x], below_b[y]
        best = [[0] * (len(columns) + 1) for _ in range(len(rows) + 1)]
        part: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for i, u in enumerate(rows, 1):
            for j, v in enumerate(columns, 1):
                both = 0
                if a.labels[u] == b.labels[v]:
                    part[i, j] = match(u, v)
                    both = best[i - 1][j - 1] + len(part[i, j])
                best[i][j] = max(best[i][j - 1], best[i - 1][j], both)
        pairs, i, j = [(x, y)], len(rows), len(columns)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                pairs += part[i, j]
                i, j = i - 1, j - 1
        return pairs

    return dict(match(0, 0)) if a.labels[0] == b.labels[0] else {}
