"""Main-text extraction by consensus host paths.

1. Every page is parsed into containers by one linear scan. Boilerplate (menus, headers, footers, sidebars, notices, adverts,
   forms, reader comments, scripts, hidden parts) is told by tag, role and class; the rest of a container's text, less
   the text of its links, is its score. A form, a header or a class name may be a frame around the article itself, so these only
   mark a part: a marked part that holds a heading, article or main element and more text than all that is unmarked is no boilerplate,
   nor is the largest one where nothing but headings is left without it. From the body downwards the page follows the one child that holds
   all of the score, so only boilerplate and link text is left outside; from there it climbs to the nearest article or main
   element, or else out of lists, tables and quotes, so that pages of a host with the same frame vote for the same path.
2. The path of that container, generalised to tags with their first class (digits dropped), is the page's vote,
   and Spark counts votes per host. The path with the most votes wins (ties: the larger score, then the lesser path).
3. Every page is extracted again with its host's winning path. Where that path is not on the page, or holds less than a ``BIT`` of what
   the host's pages have there on average and of what the page's own choice holds, that choice stands: the article is elsewhere on this page.

The text is that of all containers on the path, in page order: one line a block, white space inside a block turned into
one space, character references decoded. Nothing is capped. Null pages have no text; pages without a known host
vote together under ''. Votes are counted in every task before they are shuffled; the winners are broadcast when they
are few, and joined under ``SALTS`` salts otherwise, so that no host is a hot task. Unclosed tags, quotes and scripts cost no second scan, however
long a page is. Pictures, formulas, players and form controls inside a line are left out without ending it. Repeated rows get equal texts (each votes), an
empty table gives an empty one.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, configure, with_fields

#: A path that holds less than one part in so many of what is usual is not where the article is.
BIT = 10
#: Salts of a host, where hosts are too many to be broadcast.
SALTS = 64

#: HTML elements by their role in a page.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
CONTAINERS = frozenset("html body main article section div td table tbody tr blockquote details figure fieldset center dl ul ol".split())
#: Parts of an article, not frames of one.
PIECES = frozenset("table tbody tr td blockquote details figure fieldset center dl ul ol".split())
#: Elements whose content is no markup.
RAW = frozenset("script style textarea iframe xmp noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LEFT_OUT = frozenset("head title nav footer aside menu dialog noscript template".split())
#: Left out inside a line, which goes on behind them.
INLINE_OUT = frozenset("svg math object canvas audio video button select label".split())
FRAMES = frozenset("article main h1".split())
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
#: Class and id words of boilerplate; the second set counts only where no word of the third is beside it.
STRONG = frozenset("ad ads adv advert adverts advertisement advertising adbox breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr menu modal nav navbar navigation newsletter pager pagination popup promo promos related respond share sharing signup social sponsor sponsored subscribe toolbar".split())
NOTICES = frozenset("alert masthead notice notices notification".split())
WEAK = frozenset("alert aside banner bar form header login masthead notice notices notification reply search side sidebar tags widget widgets".split())
POSITIVE = frozenset("article body content entry main post story text".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: A quote opens a value only behind an equals sign. What was matched is never given back, so the scan is linear; of a quote that
#: nothing closes (there is one of each kind at most) only its tag is taken.
TAG = re.compile(r"""<(?:!--(?:.*?-->|.*\Z)|(/?)([a-zA-Z][^\s/>]*+)((?>[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|["'][^>]*+|[^\s>]*+))*+)(?:>|\Z)|[!?/][^>]*+(?:>|\Z))""", re.S)
ATTR = re.compile(r"""([^\s=/>]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?""")
RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: A new element of the first kind closes an open one of these, up to the nearest container.
CLOSES = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}


#: Marks of an element: a part of the article, boilerplate unless it frames the article, boilerplate.
PLAIN, DOUBTFUL, OUT = range(3)


def mark(tag: str, attrs: dict[str, str], sectioned: bool, in_form: bool = False) -> int:
    """``sectioned``: inside an article or main element, where a header is the article's own, and of weak words only a notice's marks a paragraph."""
    if tag in LEFT_OUT or (tag == "fieldset" and in_form) or "hidden" in attrs or attrs.get("aria-hidden") == "true" or HIDDEN.search(attrs.get("style", "")):
        return OUT
    if tag in ("html", "body", "main"):
        return PLAIN
    if tag == "form" or (tag == "header" and not sectioned) or attrs.get("role", "").lower() in LEFT_OUT_ROLES:
        return DOUBTFUL
    names = [{p.lower() for p in PARTS.findall(name)} for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split()]
    if tag == "article" and any(words & POSITIVE for words in names):
        return PLAIN
    weak = NOTICES if tag == "p" and sectioned else WEAK
    found = set().union(*names)
    return DOUBTFUL if any(words & STRONG for words in names) or (found & weak and not found & POSITIVE) else PLAIN


def attributes(raw: str) -> dict[str, str]:
    """Names in lower case with their values; the first of a name counts."""
    found: dict[str, str] = {}
    for name, value in ATTR.findall(raw):
        quoted = len(value) > 1 and value[0] in "\"'" and value[-1] == value[0]
        found.setdefault(name.lower(), html.unescape(value[1:-1] if quoted else value))
    return found


class Page:
    """Blocks of a page with their nodes: containers and marked parts, each behind its parent."""

    __slots__ = ("blocks", "frames", "label", "marks", "parent", "score")

    def __init__(self, source: str) -> None:
        self.parent, self.label, self.marks, self.frames = [-1], ["html"], [PLAIN], {0}
        self.blocks: list[tuple[int, str, int, bool]] = []  # (node, text, characters of links, heading)
        self._parse(source)
        self._clean()
        self.score = [0] * len(self.parent)
        for c, line, linked, _ in self.blocks:
            self.score[c] += max(0, len(line) - linked)
        for c in range(len(self.parent) - 1, 0, -1):
            self.score[self.parent[c]] += self.score[c]

    def _parse(self, source: str) -> None:
        stack = [("html", 0)]  # (tag, node)
        opened: Counter[str] = Counter()
        text, links, in_link, pos = [], 0, False, 0
        last = source.rfind(">") + 1  # no tag ends behind

        skip: list | None = None  # the inline element that is being left out, the open elements around it, and how often it is open

        def flush() -> None:
            nonlocal text, links
            if text and not skip:
                line = " ".join(html.unescape("".join(text)).split())
                if line:
                    self.blocks.append((stack[-1][1], line, links, stack[-1][0] in HEADINGS))
                text, links = [], 0

        def say(s: str) -> None:
            nonlocal links
            if skip:
                return
            text.append(s)
            if in_link:
                links += len(s.strip())

        def pop(k: int) -> None:
            nonlocal skip
            if skip and k < skip[1]:  # the element around it ends
                skip = None
                flush()
            for tag, _ in stack[k:]:
                opened[tag] -= 1
            del stack[k:]

        while m := TAG.search(source, pos, last):
            if m.start() > pos:
                say(source[pos : m.start()])
            pos = m.end()
            if not m[2]:
                continue
            tag, closing = m[2].lower(), bool(m[1])
            if tag == "br" or tag == "wbr":
                say(" " if tag == "br" else "")
            elif tag == "a":
                in_link = not closing
            elif tag in RAW:
                if not closing and not m[3].endswith("/"):
                    end = RAW_END[tag].search(source, pos)
                    closed = source.find(">", end.end()) if end else -1
                    pos = closed + 1 if closed >= 0 else len(source)
                    last = max(last, pos)
            elif tag in INLINE_OUT:
                if skip:
                    if tag == skip[0] and not m[3].endswith("/"):
                        skip[2] += -1 if closing else 1
                        if not skip[2]:
                            pop(skip[1])  # what was left open inside
                            skip = None
                elif not closing and not m[3].endswith("/"):
                    skip = [tag, len(stack), 1]
            elif tag in BLOCKS or tag in LEFT_OUT:
                flush()
                if closing:
                    if opened[tag]:
                        k = len(stack) - 1
                        while stack[k][0] != tag:
                            k -= 1
                        pop(k)
                        in_link = False
                    continue
                if tag in VOID or (m[3].endswith("/") and tag not in BLOCKS):
                    continue
                if skip:
                    stack.append((tag, stack[-1][1]))
                    opened[tag] += 1
                    continue
                in_link = False
                if stack[-1][0] == "p":  # a paragraph ends where another block begins
                    pop(len(stack) - 1)
                elif tag in CLOSES:
                    while stack[-1][0] in CLOSES[tag]:
                        pop(len(stack) - 1)
                attrs, node = attributes(m[3]) if m[3].strip(" /") else {}, stack[-1][1]
                if tag == "html":
                    continue
                marked = mark(tag, attrs, bool(opened["article"] or opened["main"]), bool(opened["form"]))
                if tag in CONTAINERS or marked != PLAIN:
                    first = re.sub(r"[\d>]+", "", (attrs.get("class", "").split() or [""])[0])
                    self.parent.append(node)
                    self.label.append(tag + (f".{first}" if first else ""))
                    self.marks.append(marked)
                    node = len(self.parent) - 1
                if tag in FRAMES:
                    self.frames.add(node)
                stack.append((tag, node))
                opened[tag] += 1
        say(source[pos:])
        skip = None
        flush()

    def _clean(self) -> None:
        """Keeps the blocks outside boilerplate. A doubtful part that frames the article is cleared; each clearing more than
        doubles the text that is kept, so there are few."""
        n = len(self.parent)
        out, inner = [False] * n, [0] * n  # in a part that is out; the innermost doubtful part
        for c in range(1, n):
            out[c] = out[self.parent[c]] or self.marks[c] == OUT
            inner[c] = c if self.marks[c] == DOUBTFUL else inner[self.parent[c]]
        blocks = [b for b in self.blocks if not out[b[0]]]
        if not any(self.marks[c] == DOUBTFUL for c in range(n)):
            self.blocks = blocks
            return
        text, body = [0] * n, [0] * n  # by innermost doubtful part (0: none); without headings
        for c, line, linked, heading in blocks:
            text[inner[c]] += max(0, len(line) - linked)
            body[inner[c]] += 0 if heading else max(0, len(line) - linked)
        framed = {inner[c] for c in self.frames}
        while True:
            found = [c for c in range(1, n) if inner[c] == c and not out[c] and text[c] and (body[0] == 0 < body[c] or (c in framed and text[c] > text[0]))]
            if not found:
                break
            at = max(found, key=lambda c: (c in framed and body[c] > 0, text[c], -c))
            while at:  # with all that it lies in
                self.marks[at] = PLAIN
                at = self.parent[at]
            text, body = [0] * n, [0] * n
            for c in range(1, n):
                inner[c] = c if self.marks[c] == DOUBTFUL else inner[self.parent[c]]
            for c, line, linked, heading in blocks:
                text[inner[c]] += max(0, len(line) - linked)
                body[inner[c]] += 0 if heading else max(0, len(line) - linked)
            framed = {inner[c] for c in self.frames}
        self.blocks = [b for b in blocks if not inner[b[0]]]

    def path(self, c: int) -> str:
        """Labels from the root to a node."""
        names = []
        while c >= 0:
            names.append(self.label[c])
            c = self.parent[c]
        return ">".join(reversed(names))

    def at(self, path: str) -> set[int]:
        """Nodes with that path."""
        names, depth = path.split(">"), [0] * len(self.parent)  # labels that agree so far, or none
        depth[0] = int(self.label[0] == names[0])
        for c in range(1, len(self.parent)):
            d = depth[self.parent[c]]
            depth[c] = d + 1 if 0 < d < len(names) and self.label[c] == names[d] else 0
        return {c for c, d in enumerate(depth) if d == len(names)}

    def choice(self) -> int:
        """The container that the page itself would take."""
        best: dict[int, int] = {}
        for c in range(1, len(self.parent)):
            p = self.parent[c]
            if p not in best or self.score[c] > self.score[best[p]]:
                best[p] = c
        at = 0
        while at in best and self.score[best[at]] == self.score[at] > 0:
            at = best[at]
        tag = lambda c: self.label[c].partition(".")[0]
        up = at
        while up > 0 and tag(up) not in ("article", "main"):
            up = self.parent[up]
        if up > 0:
            return up
        while at > 0 and tag(at) in PIECES:
            at = self.parent[at]
        return at

    def text(self, chosen: set[int]) -> str:
        inside = [c in chosen for c in range(len(self.parent))]
        for c in range(1, len(self.parent)):
            inside[c] = inside[c] or inside[self.parent[c]]
        return "\n".join(line for c, line, *_ in self.blocks if inside[c])


def extract(source: str | None, winner: str | None, usual: int = 0) -> str:
    """The main text by the host's ``winner``, which has a score of ``usual`` on the host's pages."""
    page = Page(source or "")
    found, own = page.at(winner) if winner else set(), page.choice()
    if found and BIT * sum(page.score[c] for c in found) < min(usual, page.score[own]):
        found = set()
    return (page.text(found) if found else "") or page.text({own})


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", url or "")
    return m[1].lower() if m else ""


def votes(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """(host, path, pages, score): the votes of every batch of pages, counted in the task."""
    configure(spark)
    rows = pages.select("url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counted: dict[tuple[str, str], list[int]] = {}
            for url, source in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
                page = Page(source or "")
                c = page.choice()
                if page.score[c]:
                    v = counted.setdefault((host_of(url), page.path(c)), [0, 0])
                    v[0] += 1
                    v[1] += page.score[c]
            rows = [(h, p, n, s) for (h, p), (n, s) in counted.items()]
            columns = list(zip(*rows, strict=True)) or [(), (), (), ()]
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds, strict=True)], names=["host", "path", "pages", "score"])

    return rows.mapInArrow(run, "host string, path string, pages long, score long")


def winners(counted: DataFrame) -> DataFrame:
    """(host, winner, usual): the path with the most votes on each host, and its average score there."""
    total = counted.groupBy("host", "path").agg(F.sum("pages").alias("pages"), F.sum("score").alias("score"))
    best = F.min_by(F.struct("path", F.expr("score div pages").alias("usual")), F.struct(-F.col("pages"), -F.col("score"), "path"))
    return total.groupBy("host").agg(best.alias("best")).select("host", F.col("best.path").alias("winner"), "best.usual")


def extract_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars, host of every row of ``pages`` (page_id, url, html)."""
    configure(spark)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    best = winners(votes(spark, pages)).checkpoint()
    rows = pages.select("page_id", "url", "html", host.alias("host"))
    if best.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        kept = rows.join(F.broadcast(best), "host", "left")
    else:
        salted = best.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        kept = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")).join(salted, ["host", "salt"], "left")
    kept = kept.select("page_id", "url", "host", "html", "winner", F.coalesce("usual", F.lit(0)).alias("usual"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(*row) for row in zip(*(batch.column(c).to_pylist() for c in ("html", "winner", "usual")), strict=True)]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64()), batch.column("host")]
            yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text", "n_chars", "host"])

    return kept.mapInArrow(run, with_fields(pages.select("page_id", "url"), ("text", "string"), ("n_chars", "long"), ("host", "string")))
