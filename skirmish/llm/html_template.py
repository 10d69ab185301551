"""HTML extraction (operator 2): equivalence-class template deduction.

Pages are cut into tokens: tags (with their class and id) and whole text runs.
Over the pages of a host, tokens with equal occurrence vectors (how often the
token stands on each page) form an equivalence class; the vector is kept as a
combined hash, so classes come from one grouped aggregation that combines
before the shuffle and holds a hot host easily. Large and frequent classes are
the host's template. On each page the classes that keep their order and nest
properly are laid over the tokens; what stands between template tokens are
slots. Slots inside the page's furniture (navigation, footers, adverts, forms,
comments, ...) are dropped, and the remaining ones are the main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skirmish.llm.storage import stored
from skirmish.llm.tokens import slices

MIN_PAGES = 5  # pages of a host below which it has no template
TAG_SHARE, TEXT_SHARE = 0.5, 0.9  # share of a host's pages that a template token stands on
MIN_CLASS = 2  # tokens of a class
FLUSH = 200_000  # token counts that a task holds before it hands them on

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^'">])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|"""
    r"""<[!?/][^>]*(?:>|\Z)|[^<]+|<""", re.S)
_NAMED = re.compile(r"""(?:^|[\s"'])(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_SPACE = re.compile(r"\s+")
_PARTS = re.compile(r"[^a-z]+")

# Fixed values of HTML: elements by their part in the text.
RAW = set("script style textarea title noscript iframe xmp noembed noframes template".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q ruby rb rp rt s samp small "
             "span strike strong sub sup time tt u var wbr br img".split())
OUTSIDE = set("head nav footer aside form button select option svg canvas object audio video map menu dialog".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
#: Words of a class or id that mark page furniture.
FURNITURE = set("ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies "
                "consent gdpr notice notification popup modal overlay newsletter subscribe sidebar aside menu nav navbar "
                "navigation breadcrumb breadcrumbs masthead footer comment comments discussion replies respond disqus share "
                "sharing social related recommended widget toolbar pagination pager login signin signup search".split())
#: An element closed by the start of another of its kind (its end tag may be left out).
CLOSES = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}


class Token:
    """A tag or a text run: its key names it in the template."""

    __slots__ = ("kind", "name", "text", "key", "furniture")

    def __init__(self, kind: str, name: str, text: str, key: str, furniture: bool):
        self.kind, self.name, self.text, self.key, self.furniture = kind, name, text, key, furniture


def tokens(page: str) -> Iterator[Token]:
    """Tokens of a page in order; comments, declarations and the contents of
    scripts, styles and the like are left out."""
    at, match = 0, _TOKEN.match
    while at < len(page):
        m = match(page, at)
        at = m.end()
        name = m.group(2) or m.group(5)
        if name is None:
            if page[m.start()] != "<" or m.end() - m.start() == 1:
                text = _SPACE.sub(" ", html.unescape(m.group()))
                if text:
                    yield Token("text", "", text, "t" + text.strip(), False)
            continue
        name = name.lower()
        if m.group(1) or m.group(4):
            yield Token("close", name, "", f"</{name}>", False)
            continue
        attributes = m.group(3) or m.group(6) or ""
        marks, bad = _marks(attributes) if attributes else ("", False)
        yield Token("open", name, "", f"<{name}{marks}>", bad)
        if name in RAW:
            end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
            at = end.start() if end else len(page)


def _marks(attributes: str) -> tuple[str, bool]:
    """Class and id of a tag for its key, and whether they mark furniture."""
    key, bad = "", False
    for m in _NAMED.finditer(attributes):
        name, value = m.group(1).lower(), (m.group(2) or m.group(3) or m.group(4) or "").lower()
        if name in ("class", "id"):
            key += f" {name}={value}"
            bad = bad or not FURNITURE.isdisjoint(_PARTS.split(value))
        elif name == "role":
            bad = bad or value in ROLES
        elif name == "hidden":
            bad = bad or value != "until-found"
        elif name == "aria-hidden":
            bad = bad or value == "true"
        else:
            bad = bad or re.search(r"display\s*:\s*none", value) is not None
    return key, bad


def number(key: str) -> int:
    """Signed 64-bit name of a token key."""
    h = xxhash.xxh64_intdigest(key)
    return h - (1 << 64) if h >> 63 else h


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def host_key():
    """Hash of a URL's host in lower case, that of the empty host without ://."""
    host = F.regexp_extract(F.coalesce(F.col("url"), F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.xxhash64(F.lower(host))


def occurrences(pages: DataFrame) -> DataFrame:
    """Per host and token: pages, vector (hash of the occurrence vector),
    place (sum of first positions) and is_text; token 0 counts the pages."""

    def run(batches):
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            for part in slices(batch, "html"):
                for host, page, text in zip(*(part.column(c).to_pylist() for c in ("host", "page", "html"))):
                    counts, first, kinds = Counter(), {}, {}
                    for i, t in enumerate(tokens(text)):
                        if t.key != "t":
                            counts[t.key] += 1
                            if t.key not in first:
                                first[t.key], kinds[t.key] = i, t.kind == "text"
                    held.setdefault((host, 0), [0, 0, 0, False])[0] += 1
                    for key, n in counts.items():
                        row = held.setdefault((host, number(key)), [0, 0, 0, kinds[key]])
                        row[0] += 1
                        row[1] ^= _signed(xxhash.xxh64_intdigest(b"%d %d" % (page, n)))
                        row[2] += first[key]
                    if len(held) > FLUSH:
                        yield hand_on(held)
                        held = {}
        yield hand_on(held)

    def hand_on(held):
        keys, rows = list(held), list(held.values())
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()),
             *[pa.array([r[i] for r in rows], pa.int64()) for i in range(3)], pa.array([r[3] for r in rows], pa.bool_())],
            names=["host", "token", "pages", "vector", "place", "is_text"])

    counted = pages.select("host", "page", "html").mapInArrow(
        run, "host long, token long, pages long, vector long, place long, is_text boolean")
    return counted.groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.bit_xor("vector").alias("vector"),
                                                F.sum("place").alias("place"), F.max("is_text").alias("is_text"))


def templates(pages: DataFrame) -> DataFrame:
    """(host, classes): the large and frequent equivalence classes of every
    host with ``MIN_PAGES``; a class is its tokens in the order of their mean
    first positions. At most 1 / ``TAG_SHARE`` times the tokens of a mean page."""
    found = stored(occurrences(pages).where(f"pages >= {MIN_PAGES}"), "occurrences")
    sizes = found.where("token = 0").select("host", F.col("pages").alias("all"))
    frequent = found.where("token <> 0").join(sizes, "host").where(
        F.col("pages") >= F.col("all") * F.when(F.col("is_text"), TEXT_SHARE).otherwise(TAG_SHARE))
    classes = (frequent.groupBy("host", "vector", "pages")
               .agg(F.array_sort(F.collect_list(F.struct((F.col("place") / F.col("pages")).alias("place"), "token"))).alias("t"))
               .where(F.size("t") >= MIN_CLASS))
    return classes.groupBy("host").agg(F.collect_list(F.col("t.token")).alias("classes"))


def template_places(keys: list[int], classes: list[list[int]]) -> set[int]:
    """Positions of the page's tokens that belong to the template: classes
    whose tokens keep their order in every repetition, and whose repetitions
    nest in a slot of each other. A class that breaks this is no template here."""
    member = {token: (c, i) for c, tokens_ in enumerate(classes) for i, token in enumerate(tokens_)}
    invalid: set[int] = set()
    while True:
        places, stack, broken = set(), [], None
        for at, key in enumerate(keys):
            c, i = member.get(key, (-1, 0))
            if c < 0 or c in invalid:
                continue
            if i == 0:
                stack.append([c, 0])
            elif stack and stack[-1] == [c, i - 1]:
                stack[-1][1] = i
            else:
                # Of two classes that overlap the smaller one goes.
                broken = c if not stack or len(classes[c]) <= len(classes[stack[-1][0]]) else stack[-1][0]
                break
            places.add(at)
            if i == len(classes[c]) - 1:
                stack.pop()
        if broken is None and stack:
            broken = min((c for c, _ in stack), key=lambda c: len(classes[c]))
        if broken is None:
            return places
        invalid.add(broken)


def main_text(page: str, classes: list[list[int]]) -> str:
    """Blocks of the slots outside the furniture, one per line; a block that
    is template from end to end is none, unless the page has no other. If the
    page has an article or main element, only what stands in one."""
    found = list(tokens(page))
    places = template_places([number(t.key) for t in found], classes) if classes else set()
    marked = any(t.kind == "open" and t.name in ("article", "main") and not t.furniture for t in found)
    blocks: list[tuple[str, bool]] = []  # text, and whether all of it is template
    block: list[tuple[str, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # name, furniture, inside the article

    def flush():
        text = _SPACE.sub(" ", "".join(x for x, _ in block)).strip()
        if text:
            blocks.append((text, all(fixed for x, fixed in block if x.strip())))
        block.clear()

    for at, t in enumerate(found):
        out, inside = (stack[-1][1], stack[-1][2]) if stack else (False, not marked)
        if t.kind == "text":
            if inside and not out:
                block.append((t.text, at in places))
            continue
        if t.name == "br":
            block.append((" ", False))
        elif t.name not in INLINE:
            flush()
        if t.kind == "open":
            closed = CLOSES.get(t.name)
            while closed and stack and (stack[-1][0] in closed or stack[-1][0] in INLINE and any(s[0] in closed for s in stack[-4:])):
                stack.pop()
            out, inside = (stack[-1][1], stack[-1][2]) if stack else (False, not marked)
            if t.name not in VOID:
                enters = t.name in ("article", "main") and not t.furniture
                header = t.name == "header" and not (marked and inside)
                stack.append((t.name, out or t.furniture and t.name not in ("body", "html", "article", "main") or t.name in OUTSIDE
                              or t.name in RAW or header, inside or enters))
        else:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == t.name), None)
            if depth is not None and (t.name not in INLINE and t.name != "p" or len(stack) - depth <= 4):
                del stack[depth:]
    flush()
    slots = [text for text, fixed in blocks if not fixed]
    return "\n".join(slots or [text for text, _ in blocks])


def extract_main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Main text of every page: ``id_col``, ``url_col``, text, n_chars.

    A null or empty page has the empty text; a page without a host belongs to
    the empty host; a host with fewer than ``MIN_PAGES`` pages has no template
    and goes by the furniture alone; repeated rows are extracted each (as one
    page more on their host); null ids stay null; other columns are not read;
    an empty table gives an empty result.
    """
    pages = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"),
                      F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    pages = pages.withColumn("host", host_key()).withColumn("page", F.xxhash64("id", "url", "html"))
    template = stored(templates(pages), "templates")
    joined = pages.join(template, "host", "left").select("id", "url", "html", "classes")
    id_type, url_type = (df.schema[c].dataType.simpleString() for c in (id_col, url_col))

    def run(batches):
        for batch in batches:
            for part in slices(batch, "html"):
                texts = [main_text(h, c or []) for h, c in zip(part.column("html").to_pylist(), part.column("classes").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("url"), pa.array(texts, pa.string()),
                                                  pa.array(list(map(len, texts)), pa.int64())],
                                                 names=[id_col, url_col, "text", "n_chars"])

    return joined.mapInArrow(run, f"`{id_col}` {id_type}, `{url_col}` {url_type}, text string, n_chars long")
