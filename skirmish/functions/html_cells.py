"""HTML field extraction for job_extract: the one Python stage.

Runs inside ``mapInPandas`` over the pages table: Spark partitions the pages,
each task parses its pages with the standard-library ``html.parser`` and
emits long rows (page_id, field, pos, raw). Everything after that (typing,
pivoting, joins) is native Spark.

Selector subset (what the field specs need): ``tag``, ``.class``, ``#id``,
``[attr]``, ``[attr=value]``, compound (``a.cls[href]``), descendant
(``div a``) and child (``ul > li``) combinators, ``:nth-child(n)``.
Source is the element's own text, its full text, or an attribute.
Unclosed tags, comments and script/style bodies are tolerated.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW_TEXT = {"script", "style"}
_BLOCK = {"p", "div", "ul", "ol", "table", "h1", "h2", "h3", "h4", "h5", "h6", "section", "article", "header",
          "footer", "nav", "form", "pre", "blockquote", "hr"}
# Opening tag -> open elements it ends implicitly (HTML's optional end tags).
IMPLIED_CLOSE = {"li": {"li", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "tr": {"td", "th", "tr", "p"},
                 "option": {"option"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"},
                 **{b: {"p"} for b in _BLOCK}}


@dataclass
class Node:
    tag: str
    attrs: dict
    parent: "Node | None" = None
    children: list = field(default_factory=list)
    content: list = field(default_factory=list)  # text pieces and child nodes, in document order
    index: int = 0  # 1-based position among element siblings

    @property
    def own_text(self) -> list:
        return [c for c in self.content if isinstance(c, str)]

    def text(self) -> str:
        return "".join(c if isinstance(c, str) else c.text() for c in self.content)

    def classes(self) -> set:
        return set((self.attrs.get("class") or "").split())


class _TreeBuilder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {})
        self.cur = self.root

    def handle_starttag(self, tag, attrs):
        while self.cur.parent is not None and self.cur.tag in IMPLIED_CLOSE.get(tag, ()):
            self.cur = self.cur.parent
        node = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, parent=self.cur)
        node.index = len(self.cur.children) + 1
        self.cur.children.append(node)
        self.cur.content.append(node)
        if tag not in VOID:
            self.cur = node

    def handle_startendtag(self, tag, attrs):
        node = Node(tag, {k: (v if v is not None else "") for k, v in attrs}, parent=self.cur)
        node.index = len(self.cur.children) + 1
        self.cur.children.append(node)
        self.cur.content.append(node)

    def handle_endtag(self, tag):
        n = self.cur
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:  # close up to the matching open tag
            self.cur = n.parent

    def handle_data(self, data):
        if self.cur.tag in RAW_TEXT:
            return
        self.cur.content.append(data)


def parse(html: str) -> Node:
    b = _TreeBuilder()
    b.feed(html or "")
    b.close()
    return b.root


_SIMPLE = re.compile(r"^(?P<tag>[a-zA-Z0-9*]+)?(?P<rest>.*)$")
_PART = re.compile(r"\.(?P<cls>[\w-]+)|#(?P<id>[\w-]+)|\[(?P<attr>[\w-]+)(?:=\"?(?P<val>[^\]\"]*)\"?)?\]"
                   r"|:nth-child\((?P<nth>\d+)\)")


def _compile_simple(sel: str):
    m = _SIMPLE.match(sel)
    tag = m.group("tag")
    conds = []
    for p in _PART.finditer(m.group("rest")):
        if p.group("cls"):
            conds.append(("cls", p.group("cls")))
        elif p.group("id"):
            conds.append(("id", p.group("id")))
        elif p.group("attr"):
            conds.append(("attr", p.group("attr"), p.group("val")))
        elif p.group("nth"):
            conds.append(("nth", int(p.group("nth"))))
    return tag, conds


def _match_simple(node: Node, simple) -> bool:
    tag, conds = simple
    if tag and tag != "*" and node.tag != tag:
        return False
    for c in conds:
        if c[0] == "cls" and c[1] not in node.classes():
            return False
        if c[0] == "id" and node.attrs.get("id") != c[1]:
            return False
        if c[0] == "attr" and (c[1] not in node.attrs or (c[2] is not None and node.attrs[c[1]] != c[2])):
            return False
        if c[0] == "nth" and node.index != c[1]:
            return False
    return True


def compile_selector(selector: str):
    tokens = selector.replace(">", " > ").split()
    steps, comb = [], " "
    for t in tokens:
        if t == ">":
            comb = ">"
            continue
        steps.append((comb, _compile_simple(t)))
        comb = " "
    return steps


def _matches(node: Node, steps) -> bool:
    if not _match_simple(node, steps[-1][1]):
        return False
    comb = steps[-1][0]
    rest = steps[:-1]
    if not rest:
        return True
    p = node.parent
    if comb == ">":
        return p is not None and _matches(p, rest)
    while p is not None:
        if _matches(p, rest):
            return True
        p = p.parent
    return False


def select(root: Node, selector: str) -> list[Node]:
    steps = compile_selector(selector)
    out, stack = [], list(reversed(root.children))
    while stack:
        n = stack.pop()
        if _matches(n, steps):
            out.append(n)
        stack.extend(reversed(n.children))
    return out


def extract(html: str, specs: list[tuple[str, str, str]]) -> list[tuple[str, int, str]]:
    """specs: (field, selector, source) with source 'text' (full text),
    'own' (own text only) or 'attr:<name>'. Returns (field, pos, raw)."""
    root = parse(html)
    rows = []
    for name, selector, source in specs:
        for pos, node in enumerate(select(root, selector)):
            if source == "text":
                raw = node.text()
            elif source == "own":
                raw = "".join(node.own_text)
            elif source.startswith("attr:"):
                key = source[5:]
                if key not in node.attrs:
                    continue
                raw = node.attrs[key]
            else:
                raise ValueError(f"unknown source {source}")
            rows.append((name, pos, raw))
    return rows
