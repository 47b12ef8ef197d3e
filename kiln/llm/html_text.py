"""Main text of web pages: maximum-scoring subsequence of words and tags, with
weights learned from pages whose markup labels the article."""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import table
from kiln.llm.registry import query

# Names of HTML elements by their part in the page.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title iframe".split())
_UNSHOWN = frozenset("noscript template svg select button canvas annotation annotation-xml".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                    "small span strike strong sub sup time tt u var wbr img object "
                    "math merror mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub "
                    "msubsup msup mtable mtd mtext mtr munder munderover semantics".split())
_AUTO_CLOSE = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}, "option": {"option"}}
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header "
                      "hr main nav ol p pre section table ul".split())
_MAIN = frozenset(("article", "main"))
_HOLDERS = frozenset(("div", "section", "td"))
_BOILER_TAGS = frozenset("nav footer aside form head menu dialog".split())
_BOILER_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation "
                          "menu breadcrumb breadcrumbs header masthead footer sidebar aside cookie cookies consent notice alert "
                          "popup modal newsletter subscribe signup share sharing social comment comments commentlist respond "
                          "replies reply disqus related recommended widget pagination pager search login form skip".split())
_HEADERS = frozenset(("header", "masthead"))
_LOOSE = frozenset("search reply replies login skip form menu".split())  # inside an article also what it is about
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']+|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
                    r"|</?[a-zA-Z][^>]*(?:>|\Z)|(?P<text>[^<]+|<)", re.S)
_ATTR = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")


@dataclass
class Block:
    """A run of text between block boundaries: its pieces, the numbers of the
    elements around it, the contexts of those, its first event, and how many of
    its words are links."""
    pieces: list = field(default_factory=list)
    path: tuple = ()
    contexts: frozenset = frozenset()
    first: int = 0
    linked: int = 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.pieces).split())


def _contexts(tag: str, attrs: str) -> tuple[frozenset, bool]:
    """Words of an element's class, id and role, and its name; whether it is hidden."""
    names, hidden = {f"<{tag}>"}, False
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), (m[2] or "").strip("\"'").lower()
        if key in ("class", "id", "role"):
            names.update(w for w in _SPLIT.split(value) if w)
        elif key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            hidden = True
    return frozenset(names), hidden


def parse(page: str) -> tuple[list[Block], list[tuple[str, int]], dict[int, tuple]]:
    """(blocks, events, elements) of a page. An event is a tag's name or a piece
    of text of a block ("", block); elements has (name, contexts, whether an
    article or a main heading lies inside) by number.

    Scripts, styles, text areas, titles and frames hold no markup and end with their
    own end tag. Buttons, lists to choose from, drawings and the like are left out
    without breaking the paragraph around them; where one is not closed before the
    next of its name, or at all, it ends with its parent or the next paragraph."""
    blocks, events, elements, holders = [], [], {}, set()
    stack: list[tuple[int, str, frozenset, bool]] = []  # number, name, contexts, hidden
    block, raw, pos, endless = None, None, 0, set()

    def close(to: int):
        nonlocal block
        if any(e[1] not in _INLINE for e in stack[to:]):
            block = None
        del stack[to:]

    while pos < len(page):
        if raw:
            m = re.compile(rf"</{raw}\b[^>]*(?:>|\Z)", re.I).search(page, pos) if raw not in endless else None
            if not m:
                endless.add(raw)
            if m or raw in ("script", "style"):
                pos = m.end() if m else len(page)
            raw = None
            continue
        m = _TOKEN.match(page, pos)
        pos = m.end()
        if m["tag"]:
            tag = m["tag"].lower()
            events.append((tag, -1))
            if m["end"]:
                at = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][1] == tag), -1)
                if at >= 0:
                    close(at)
                elif tag not in _INLINE:
                    block = None
                continue
            if tag in _RAW:
                raw = None if m["attrs"].rstrip().endswith("/") else tag
                continue
            if tag in _UNSHOWN:
                if m["attrs"].rstrip().endswith("/"):
                    continue
                e = re.compile(rf"<(/?){tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, pos)
                if e and e[1]:
                    pos = e.end()
                else:
                    elements[len(elements)] = (tag, frozenset({f"<{tag}>"}))
                    stack.append((len(elements) - 1, tag, frozenset({f"<{tag}>"}), True))
                continue
            if tag in _CLOSES_P:
                open_ = next((i for i, e in enumerate(stack) if e[1] in _UNSHOWN), None)
                if open_ is not None:
                    close(open_)
            if tag in _CLOSES_P or tag in _AUTO_CLOSE:
                ends = _AUTO_CLOSE.get(tag, set()) | ({"p"} if tag in _CLOSES_P else set())
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][1] in ends:
                        close(i)
                        break
                    if stack[i][1] not in _INLINE:
                        break
            if tag == "br" or tag in ("td", "th"):
                if block is not None:
                    block.pieces.append(" ")
                if tag == "br":
                    continue
            elif tag not in _INLINE:
                block = None
            if tag in _VOID:
                continue
            names, hidden = _contexts(tag, m["attrs"])
            if tag in _MAIN or tag == "h1":
                holders.update(e[0] for e in stack)
            elements[len(elements)] = (tag, names)
            stack.append((len(elements) - 1, tag, names, hidden or bool(stack) and stack[-1][3]))
        elif m["text"] is not None and not (stack and stack[-1][3]):
            text = html.unescape(m["text"])
            if block is None:
                if not text.strip():
                    continue
                block = Block(path=tuple(e[0] for e in stack if e[1] not in _INLINE), first=len(events),
                              contexts=frozenset().union(*(e[2] for e in stack)))
                blocks.append(block)
            block.pieces.append(text)
            if any(e[1] == "a" for e in stack):
                block.linked += len(text.split())
            events.append(("", len(blocks) - 1))
    return blocks, events, {n: (*e, n in holders) for n, e in elements.items()}


@dataclass(frozen=True)
class PageModel:
    """Weights of tags (words weigh 1), and contexts that hold no main text."""
    tags: dict
    boiler: frozenset

    def tag(self, name: str) -> float:
        return self.tags.get(name, self.tags.get("?", -1.0))


DEFAULT = PageModel({"?": -1.0, "a": -2.0, "li": -1.5}, frozenset())


def _is_boiler(block: Block, elements: dict, model: PageModel) -> bool:
    """Whether a block lies in an element without main text, by the name of one
    around it, by its class, id or role (unless an article or main heading lies
    inside: then it describes the page), or by the contexts learned. An article's
    own header holds its title."""
    in_main = False
    for n in block.path:
        tag, names, holds = elements[n]
        words = names & _BOILER_WORDS
        if tag in _MAIN:
            in_main = True
        elif tag in _BOILER_TAGS or (tag == "header" and not in_main):
            return True
        elif in_main and words - _HEADERS - _LOOSE:
            return True
        elif not in_main and not holds and (words or names & model.boiler):
            return True
    return False


def highest_run(scores: list) -> tuple[int, int] | None:
    """First and last index of the run with the highest sum, in one scan; of equal
    ones the first to end. None if no sum is above 0."""
    best, run, total, start = 0.0, None, 0.0, 0
    for i, score in enumerate(scores):
        total += score
        if total <= 0:
            total, start = 0.0, i + 1
        elif total > best:
            best, run = total, (start, i)
    return run


def main_text(page: str, model: PageModel = DEFAULT) -> str:
    """Main text of a page: its blocks joined by two line feeds, "" if none.

    A linear scan finds the run of tags and words with the largest sum; words in
    a context without main text (menus, adverts, comments ...) count against it
    and are left out. Of the article, main or innermost div, section or cell around
    the whole run all is taken, so that it keeps its first and last lines; outside
    of an article, lines that are nothing but links are left out there.
    """
    blocks, events, elements = parse(page)
    boiler = [_is_boiler(b, elements, model) for b in blocks]
    sizes = [len(b.text.split()) for b in blocks]
    scores, seen = [], set()
    for tag, b in events:
        scores.append(model.tag(tag) if tag else 0 if b in seen else -sizes[b] if boiler[b] else sizes[b])
        if not tag:
            seen.add(b)
    best_run = highest_run(scores)
    if best_run is None:
        return ""
    chosen = [k for k, b in enumerate(blocks) if best_run[0] <= b.first <= best_run[1] and not boiler[k]]
    if not chosen:
        return ""
    shared = blocks[chosen[0]].path
    for k in chosen[1:]:
        shared = tuple(x for x, y in zip(shared, blocks[k].path) if x == y)
    around = next((n for n in shared if elements[n][0] in _MAIN), None)
    if around is not None:
        chosen = [k for k, b in enumerate(blocks) if around in b.path and not boiler[k]]
    else:
        around = next((n for n in reversed(shared) if elements[n][0] in _HOLDERS), None)
        chosen += [k for k, b in enumerate(blocks) if around in b.path and not boiler[k] and b.linked < sizes[k]]
        chosen = sorted(set(chosen))
    return "\n\n".join(t for t in (blocks[k].text for k in chosen) if t)


def page_counts(page: str) -> Counter | None:
    """Words and tags inside and outside the article of a page that marks one
    (article or main element): (kind, name, inside) -> number. None without."""
    blocks, events, elements = parse(page)
    if not any(e[0] in _MAIN for e in elements.values()):
        return None
    out, inside = Counter(), 0
    for tag, b in events:
        if tag in _MAIN:
            inside = 1 - inside
        elif tag:
            out[("tag", tag, bool(inside))] += 1
    for b in blocks:
        own = any(elements[n][0] in _MAIN for n in b.path)
        n = len(b.text.split())
        for c in b.contexts:
            out[("context", c, own)] += n
    return out


def fit_pages(pages: DataFrame, html_col: str = "html", url_col: str = "url", max_pages: int = 20000) -> PageModel:
    """Weights from about ``max_pages`` labelled pages, by a hash of the url.

    A tag costs 0.3 plus the logarithm of how much likelier it is outside an
    article than inside, 4 at most. A context with 50 words or more outside
    articles and hardly any inside holds no main text.
    """
    n = pages.count()
    span = 1 << 30
    some = pages.where(F.pmod(F.xxhash64(url_col, F.length(html_col)), F.lit(span)) < int(span * min(1.0, max_pages / max(n, 1))))

    def counts(batches):
        total = Counter()
        for b in batches:
            for v in b.column("_html"):
                total.update(page_counts(v.as_py() or "") or ())
        keys = list(total)
        yield pa.RecordBatch.from_pydict({"kind": pa.array([k[0] for k in keys], pa.string()), "name": pa.array([k[1] for k in keys], pa.string()),
                                          "inside": pa.array([k[2] for k in keys], pa.bool_()), "n": pa.array([total[k] for k in keys], pa.int64())})
    rows = (some.select(F.col(html_col).alias("_html")).mapInArrow(counts, "kind string, name string, inside boolean, n long")
                .groupBy("kind", "name").agg(F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("i"),
                                             F.sum(F.when(F.col("inside"), 0).otherwise(F.col("n"))).alias("o"))
                .where("kind = 'tag' OR o >= 50").collect())
    tags = {r.name: (r.i, r.o) for r in rows if r.kind == "tag"}
    if not tags:
        return DEFAULT
    total_in, total_out = (1 + sum(v[k] for v in tags.values()) for k in (0, 1))
    weights = {t: -0.3 - min(3.7, max(0.0, math.log(((o + 1) / total_out) / ((i + 1) / total_in)))) for t, (i, o) in tags.items()}
    boiler = frozenset(r.name for r in rows if r.kind == "context" and r.o >= 50 * (r.i + 1) and r.name not in ("<html>", "<body>", "<div>"))
    return PageModel(DEFAULT.tags | weights, boiler)


def extract_pages(pages: DataFrame, model: PageModel, html_col: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the main text of each whole page in ``name`` (added or
    replaced). Null, empty and broken pages give what text they have, else "".
    Rows pass one by one; repeated rows get the same text; other columns stay."""
    names = [c for c in pages.columns if c != name]
    kept = pages.select(*names, F.col(html_col).alias("_kiln_html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields[:-1]) + f", `{name}` string"

    def texts(batches):
        for b in batches:
            got = pa.array([main_text(v.as_py() or "", model) for v in b.column("_kiln_html")], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], got], names=[*names, name])
    return kept.mapInArrow(texts, schema)


@query("op7_html_extraction")
def op7_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    got = extract_pages(pages, fit_pages(pages))
    return got.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
