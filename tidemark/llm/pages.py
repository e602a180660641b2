"""Main text of HTML pages: the contiguous stretch of a page with the greatest score.

A page is a row of words and tags. Every word scores above zero, by how often words in the same kind of
element belong to the article; every tag scores below zero, the more so the rarer it is inside articles. One scan
finds the maximum-scoring subsequence, whose words are the text. The weights come from labelled pages:
those that mark up exactly one article or main element, whose words are content unless they stand in
an element that never is (`BOILERPLATE`, or a class of `ASIDE`; but see `_spared`). Pages without such markup are judged by the weights alone.

About `SAMPLE` labelled pages are used, chosen by a hash.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrays import reach

SAMPLE = 2000
#: Elements whose content is never text of a page; they are left out before scoring.
SILENT = frozenset("script style noscript template svg iframe object textarea title head select option button".split())
#: Elements whose content is raw text: only their own end tag means anything there.
RAW = frozenset("script style noscript iframe textarea title".split())
#: Elements that can stand in a head; its end tag may be left out, so any other one ends it.
HEAD = frozenset("base head html link meta noscript script style template title".split())
#: Elements that are part of no article, and words that say so as a class, id or role or as the first part of one, unless a state follows.
BOILERPLATE = frozenset("nav aside footer form menu dialog".split())
ASIDE = re.compile(
    r"(?i)(?:^|\s)(?:ad|ads|advert[a-z]*|sponsor[a-z]*|promo[a-z]*|banner|cookie[a-z]*|notice|consent|comment[a-z]*|sidebar|menu|nav[a-z]*|breadcrumbs?|footer"
    r"|related|share|social|newsletter|subscribe|popup|modal)"
    r"(?![_-]+(?:open(?:ed)?|closed?|on|off|active|inactive|enabled|disabled|allowed|visible|hidden|shown|expanded|collapsed|free|less)(?:$|\s))(?:$|[\s_-])"
)
#: Elements that begin and end no block of text.
INLINE = frozenset(
    "a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q s samp small span strike strong sub sup time tt u var wbr img br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end an open p, and those that end an open one of their own kind.
_ENDS_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
_ENDS_OWN = frozenset("li dt dd tr td th option p".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)", re.S
)
_RAW_END = {name: re.compile(rf"(?i)</{name}(?=[\s/>])") for name in RAW}
_SCRIPT = re.compile(r"(?i)<!--|-->|<(/?)script(?=[\s/>])")
_NAMED = re.compile(r"""(?i)(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")


@dataclass
class Weights:
    """Scores: of a word by the kind of its element, of a tag by its kind. Kinds that were not seen take the defaults."""

    word: dict[str, float] = field(default_factory=dict)
    tag: dict[str, float] = field(default_factory=dict)

    def of_word(self, kind: str) -> float:
        return self.word.get(kind, 0.02 if kind.endswith("!") else 1.0)

    def of_tag(self, kind: str) -> float:
        plain = kind.rstrip("!")
        return -self.tag.get(kind, 2.0 if kind.endswith("!") else 0.05 if plain in INLINE or plain in _ENDS_P else 0.5)


@dataclass
class Token:
    """A run of text or a tag; `kind` is the element (marked ! inside boilerplate), `label` whether it is part of a marked article."""

    text: str | None
    kind: str
    breaks: bool
    label: bool


@dataclass(slots=True)
class Element:
    """An element, by the place of its parent; `aside` if its class, id or role says boilerplate, `size` of its own text."""

    name: str
    parent: int
    aside: bool
    size: int = 0
    bad: bool = False
    inside: bool = False


def tokens(page: str) -> tuple[list[Token], int]:
    """A page as runs of text and tags, and how many article (or else main) elements it marks."""
    found: list[tuple[str | None, str, bool, int]] = []  # text, kind, breaks, element
    elements = [Element("", 0, False)]  # the first stands for the page
    open_: list[tuple[str, int]] = []
    marks, mains, at, seek, silent, head = 0, 0, 0, 0, "", False

    def text(raw: str) -> None:
        if raw and not silent:
            name, own = open_[-1] if open_ else ("", 0)
            elements[own].size += len(raw)
            found.append((raw, name, False, own))

    while m := _TOKEN.search(page, seek):
        closing, name = m[1], (m[2] or "").lower()
        opens = bool(name) and not closing and not m[3].rstrip().endswith("/")
        seek = _raw_end(page, name, m.end()) if opens and name in RAW else m.end()
        if silent == "option" and name and name != "option" and name not in INLINE:
            silent, at = "", m.start()  # its end tag may be left out as well
        if silent:
            if closing and name == silent:
                silent, at = "", m.end()
            continue
        if head:
            head = not page[at : m.start()].strip() and (name not in ("body", "html", "br") if closing else not name or name in HEAD)
            if head:
                at, head = m.end(), not (closing and name == "head")
                if opens and name in SILENT and name != "head":
                    silent = name
                continue
        text(page[at : m.start()])
        at = m.end()
        if not name:
            continue
        if name in SILENT:
            if opens and name == "head":
                head = True
            elif opens:
                silent = name
            found.append((None, name, name != "button", 0))
            continue
        if closing:
            place = next((i for i in range(len(open_) - 1, -1, -1) if open_[i][0] == name), None)
            if place is None:
                own = open_[-1][1] if open_ else 0
            else:
                own = open_[place][1]
                del open_[place:]
        else:
            if name in _ENDS_P:
                _close(open_, "p")
            elif name in _ENDS_OWN:
                _close(open_, name)
            marks += name == "article"
            mains += name == "main"
            said = " ".join("".join(x) for x in _NAMED.findall(m[3]))
            elements.append(Element(name, open_[-1][1] if open_ else 0, bool(said and ASIDE.search(said))))
            own = len(elements) - 1
            if name not in VOID and opens:
                open_.append((name, own))
        found.append((None, name, name not in INLINE, own))
    text(page[at:])
    _judge(elements)
    out = []
    for raw, name, breaks, own in found:
        bad, inside = elements[own].bad, elements[own].inside
        label = inside and not bad and (raw is not None or name not in ("article", "main"))
        out.append(Token(raw, name + "!" * bad, breaks, label))
    return out, marks or mains


def _judge(elements: list[Element]) -> None:
    """Say of each element whether it is in boilerplate and whether in an article; parents come before their children."""
    spared = _spared(elements) if any(e.aside for e in elements) else set()
    for i, e in enumerate(elements[1:], 1):
        up = elements[e.parent]
        e.bad = up.bad or e.name in BOILERPLATE or e.aside and i not in spared
        e.inside = up.inside or e.name in ("article", "main")


def _spared(elements: list[Element]) -> set[int]:
    """Elements that are no boilerplate whatever their class says: html, body, main, articles that stand in no other one, and what holds
    the page's longest main, or its longest article if that has half as much text (shorter ones can be comments or teasers)."""
    size, within, out = [e.size for e in elements], [False] * len(elements), set()
    for i in range(len(elements) - 1, 0, -1):
        size[elements[i].parent] += size[i]
    longest: dict[str, int] = {}
    for i, e in enumerate(elements[1:], 1):
        within[i] = within[e.parent] or elements[e.parent].name == "article"
        outer = e.name == "main" or e.name == "article" and not within[i]
        if outer and (e.name not in longest or size[i] > size[longest[e.name]]):
            longest[e.name] = i
        if outer or e.name in ("html", "body"):
            out.add(i)
    if len(longest) == 2 and 2 * size[longest["article"]] < size[longest["main"]]:
        del longest["article"]
    for i in longest.values():
        while i:
            out.add(i)
            i = elements[i].parent
    return out


def _raw_end(page: str, name: str, at: int) -> int:
    """Where the end tag of a raw element is whose content begins at `at`, or the end of the page. In a script, one that stands in a
    comment after a start tag of a script is not it."""
    if name != "script":
        end = _RAW_END[name].search(page, at)
        return end.start() if end else len(page)
    comment = inner = False
    while m := _SCRIPT.search(page, at):
        at = m.end()
        if m[0] == "<!--":
            comment, at = True, m.start() + 2  # <!--> is over at once
        elif m[0] == "-->":
            comment = inner = False
        elif not m[1]:
            inner = comment
        elif not inner:
            return m.start()
        else:
            inner = False
    return len(page)


def _close(open_: list[tuple[str, bool, bool]], name: str) -> None:
    """End the innermost open element of a name, unless another block stands between."""
    for i in range(len(open_) - 1, -1, -1):
        if open_[i][0] == name:
            del open_[i:]
            return
        if open_[i][0] not in INLINE:
            return


def count_labels(page: str) -> Counter:
    """How often each kind of word and tag is inside (1) and outside (0) the one marked article of a page."""
    found, marks = tokens(page)
    counts: Counter = Counter()
    if marks == 1:
        for t in found:
            n = 1 if t.text is None else len(t.text.split())
            if n:
                counts["tag" if t.text is None else "word", t.kind, int(t.label)] += n
    return counts


def learn(counts: Counter) -> Weights:
    """A word weighs its chance to be content, a tag the chance of its kind not to be (and a little)."""
    out = Weights()
    for what, kind in {k[:2] for k in counts}:
        inside, outside = counts[what, kind, 1], counts[what, kind, 0]
        chance = inside / (inside + outside)
        if what == "word":
            out.word[kind] = max(chance, 1 / (inside + outside + 10))
        else:
            out.tag[kind] = 0.001 + 4 * (1 - chance) * (outside + 1) / (outside + 2)
    return out


def extract(page: str | None, weights: Weights) -> str:
    """The text of the best region without boilerplate in it: blocks joined by line feeds, white space inside them made one space."""
    found, _ = tokens(page or "")
    texts = [html.unescape(t.text) if t.text is not None else None for t in found]
    best, best_range, total, begin = 0.0, (0, 0), 0.0, 0
    for i, (t, own) in enumerate(zip(found, texts, strict=True)):
        total += weights.of_tag(t.kind) if own is None else weights.of_word(t.kind) * len(own.split())
        if total <= 0:
            total, begin = 0.0, i + 1
        elif total > best:
            best, best_range = total, (begin, i + 1)
    blocks, line = [], []
    for t, own in zip(found[slice(*best_range)], texts[slice(*best_range)], strict=True):
        if own is not None:
            line.append(" " if t.kind.endswith("!") else own)
        elif t.breaks:
            blocks.append(line)
            line = []
        elif t.kind.rstrip("!") == "br":
            line.append(" ")
    blocks.append(line)
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(x for x in lines if x)


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter = Counter()
    for batch in batches:
        for page in batch.column(0).to_pylist():
            total.update(count_labels(page or ""))
    keys = list(total)
    yield pa.RecordBatch.from_pydict(
        {"what": [k[0] for k in keys], "kind": [k[1] for k in keys], "inside": [k[2] for k in keys], "n": [total[k] for k in keys]},
        schema=pa.schema([("what", pa.string()), ("kind", pa.string()), ("inside", pa.int64()), ("n", pa.int64())]),
    )


#: Kinds of elements that are told apart; rarer ones take the defaults.
KINDS = 1000


def fit(pages: DataFrame, sample: int = SAMPLE) -> Weights:
    """Learn weights from about `sample` of the pages that mark up an article; the defaults if none does."""
    reach(pages.sparkSession)
    marked = pages.select("html").where(F.lower("html").rlike("<(article|main)[\\s>]"))
    n = marked.count()
    if n > sample:
        marked = marked.where(F.pmod(F.xxhash64("html"), F.lit(1 << 30)) < F.lit(int((1 << 30) * sample / n)))
    counted = marked.mapInArrow(_counter, "what string, kind string, inside long, n long")
    sides = [F.sum(F.when(F.col("inside") == i, F.col("n")).otherwise(0)).alias(f"n{i}") for i in (0, 1)]
    rows = counted.groupBy("what", "kind").agg(*sides).orderBy(F.desc(F.expr("n0 + n1")), "what", "kind").limit(KINDS)
    return learn(Counter({(r.what, r.kind, i): n for r in rows.collect() for i, n in enumerate((r.n0, r.n1)) if n}))


def _extractor(weights: Weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page, weights) for page in batch.column(2).to_pylist()]
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars"])

    return run


def extracted(pages: DataFrame, weights: Weights) -> DataFrame:
    """A row for each page: page_id, url, text, n_chars (code points).

    A page that is missing, empty or without words gives an empty text. page_id and url are only passed on; other columns
    are ignored. Of equal regions the first is taken.
    """
    reach(pages.sparkSession)
    kinds = dict(pages.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return pages.select("page_id", "url", "html").mapInArrow(_extractor(weights), schema)
