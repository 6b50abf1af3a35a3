"""Main text of HTML pages by line-block distribution.

1. Markup is stripped to block lines: comments, scripts, styles, forms and
   regions that are never the article (navigation, page header and footer,
   sidebars, and elements whose class, id or role names a menu, advert,
   notice or comment list) are blanked, a block-level tag starts a new line,
   character references are decoded and white space becomes one space.
2. Text lengths, less twice the text inside links, are summed over sliding
   windows of ``WINDOW`` lines of one box (the innermost element that holds
   blocks).  The lines that a page marks as its article (``article`` or
   ``main`` elements, ``articleBody``, ``role=main``) are one box, whatever
   elements divide them; their whole text counts, ``MARK_WEIGHT`` times.
3. A box is dense where its window sums surge past the page's level; lines of
   other boxes count as empty.  A dense marked box is the article: it goes
   before all others and keeps its short paragraphs.  A marked box that does
   not surge, such as a teaser, gives way to the boxes that do; where none
   does it stands.  A surge point is the first line with text of a stretch,
   its dive point the next empty one.
4. The text between surge and dive points is kept, blocks joined by one line
   feed.

Per page, one pass over the whole html inside a Spark task; nothing is
shuffled.  Edge cases: a null or empty html and a page without text give an
empty string and 0; unclosed elements end with their parent or the page, an
unclosed script or style takes the rest of the page, other raw elements
without an end are empty; text of formulas and drawings is text; broken
references stay as text; repeated rows are treated one by one; extra
columns pass through unless they carry an output name."""
from __future__ import annotations

import html as _html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship

WINDOW = 3
MIN_SURGE = 40
PEAK_SHARE = 0.2
MARK_WEIGHT = 10
MARKED = -1     # the box of all lines that the page marks
SMALL_BATCH = 64

_BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p
pre section summary table tbody td tfoot th thead title tr ul br option select""".split())
_RAW = "script|style|noscript|template|textarea|iframe|head"
#: Without an end tag these take the rest of the page with them, as in a browser; others are then empty.
_TO_THE_END = frozenset(["script", "style"])
_SKIP = frozenset("nav footer aside form menu dialog head select button".split())
#: Elements that hold blocks; a line's box is the innermost one round it.
_BOXES = frozenset("article aside body center details dialog div dd fieldset footer form header li main menu nav section td".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# A name is noise if one of its parts is a word for it and the others only say where or what kind of box it is.
_NOISE = re.compile(
    r"ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu|breadcrumbs?|sidebar|side|footer|cookies?|"
    r"consent|notice|popup|modal|share|sharing|social|related|newsletter|subscribe|comments?|commentlist|respond|"
    r"disqus\w*|replies|pagination|pager|toolbar|masthead|widget\w*|alert|gdpr", re.I)
_PLACE = re.compile(
    r"top|bottom|left|right|main|site|page|global|primary|secondary|fixed|sticky|bar|box|block|area|section|wrap\w*|"
    r"container|inner|outer|list|item|items|link|links|post|posts|icons?|buttons?|slot|unit|panel|row|column|col|body|"
    r"content|form|text|title|head|header|message|overlay|thread|reply|story|stories|article|articles|more|\d+", re.I)
_NOISE_ROLE = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|"
                    r"<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)/?>", re.S)
_RAW_END = {t: re.compile(rf"</{t}\s*>", re.I) for t in _RAW.split("|")}
_ATTR = re.compile(r"([\w:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_SPACES = re.compile(r"\s+")
_BODY = re.compile(r"<body\b", re.I)
#: Opening one of these closes an open paragraph.
_CLOSES_P = _BLOCK - {"br", "body", "html", "head"}


def is_noise(names: str) -> bool:
    """Whether one of the class names or ids, taken whole, names a region that is never the article."""
    for name in names.split():
        parts = [p for p in re.split(r"[_-]+", name) if p]
        said = [bool(_NOISE.fullmatch(p)) for p in parts]
        if any(said) and all(n or _PLACE.fullmatch(p) for n, p in zip(said, parts, strict=True)):
            return True
    return False


def lines_of(page: str) -> list[tuple[str, int, bool, bool, int]]:
    """Block lines in page order: (text, link characters, in noise, in marked article, box)."""
    out: list[tuple[str, int, bool, bool, int]] = []
    stack: list[tuple[str, bool, bool, int]] = []  # tag, noise, article, box
    opened: Counter = Counter()  # open elements by tag, so that a stray end tag needs no search
    missing: set[str] = set()  # raw elements without another end tag ahead
    box = boxes = 0
    buf: list[str] = []
    links = 0
    noise = article = False
    in_link = 0

    def flush():
        nonlocal links
        if buf:
            text = _SPACES.sub(" ", _html.unescape("".join(buf))).strip()
            if text:
                out.append((text, links, noise, article, box))
            buf.clear()
        links = 0

    def leave(depth: int):
        nonlocal noise, article, in_link, box
        for tag, *_rest in stack[depth:]:
            in_link -= tag == "a"
            opened[tag] -= 1
        del stack[depth:]
        noise, article, box = stack[-1][1:] if stack else (False, False, 0)

    at, end = 0, len(page)
    while at < end:
        m = _TOKEN.search(page, at)
        text = page[at:m.start()] if m else page[at:]
        if text:
            buf.append(text)
            if in_link:
                links += len(text)
        if not m:
            break
        at = m.end()
        name = m[2]
        if not name:
            continue
        tag = name.lower()
        if tag in _BLOCK:
            flush()
        if m[1]:  # closing
            for i in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                if stack[i][0] == tag:
                    leave(i)
                    break
            continue
        if tag in _RAW_END and not m[0].endswith("/>"):
            close = None if tag in missing else _RAW_END[tag].search(page, at)
            if close:
                at = close.end()
                continue
            missing.add(tag)
            if tag in _TO_THE_END:
                at = end
            elif tag == "head" and "body" not in missing:
                body = _BODY.search(page, at)
                at = body.start() if body else at
                missing.update(() if body else ("body",))
            continue
        if tag in _VOID or m[0].endswith("/>"):
            continue
        if tag in _CLOSES_P and (opened["p"] or opened["li"]):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p" or (tag == "li" and stack[i][0] == "li"):
                    leave(i)
                    break
                if stack[i][0] in _BLOCK:
                    break
        attrs = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(m[3])} if m[3] else {}
        marks = f"{attrs.get('class', '')} {attrs.get('id', '')}"
        role = attrs.get("role", "").lower()
        bad = tag in _SKIP or role in _NOISE_ROLE or (bool(attrs) and tag not in ("body", "html")
                                                      and is_noise(marks))
        if tag == "header" and not article:
            bad = True
        good = tag in ("article", "main") or role in ("main", "article") or "articleBody" in attrs.get("itemprop", "")
        if tag == "body":
            leave(0)
        noise = noise or bad
        article = (article or good) and not noise
        in_link += tag == "a"
        opened[tag] += 1
        if tag in _BOXES:
            boxes += 1
            box = boxes
        stack.append((tag, noise, article, box))
    flush()
    return out


def surges(sizes: list[int], least: int = MIN_SURGE, share: float = PEAK_SHARE,
           window: int = WINDOW) -> list[tuple[int, int]]:
    """[surge, dive) line ranges of a block-length distribution: a stretch
    whose window sum surges past ``least`` and ``share`` of the page's peak,
    from the first line with text before that point to the next one without."""
    n = len(sizes)
    sums = [sum(sizes[i:i + window]) for i in range(n)]
    level = max(least, share * max(sums, default=0))
    runs, i = [], 0
    while i < n:
        j = i
        while j < n and sizes[j]:
            j += 1
        if j > i and max(sums[i:j]) >= level:
            runs.append((i, j))
        i = max(j, i + 1)
    return runs


def dense_boxes(boxes: list[int], sizes: list[int]) -> set[int]:
    """Boxes whose own lines, in order, surge somewhere: window sums pass ``MIN_SURGE`` and ``PEAK_SHARE`` of the
    highest sum of any box."""
    own: dict[int, list[int]] = {}
    for b, n in zip(boxes, sizes, strict=True):
        own.setdefault(b, []).append(n)
    peak = {b: max(sum(x[i:i + WINDOW]) for i in range(len(x))) for b, x in own.items()}
    level = max(MIN_SURGE, PEAK_SHARE * max(peak.values(), default=0))
    return {b for b, v in peak.items() if v >= level}


def extract(page: str | None) -> str:
    """Main text of one page."""
    lines = lines_of(page or "")
    # the lines that the page marks are one box; elsewhere a block made of links adds nothing
    boxes = [MARKED if a and not x else b for _, _, x, a, b in lines]
    sizes = [0 if x else MARK_WEIGHT * len(t) if a else max(0, len(t) - 2 * k) for t, k, x, a, _ in lines]
    dense = dense_boxes(boxes, sizes)
    if MARKED in dense or not dense:
        dense = {MARKED}
    sizes = [n if b in dense else 0 for n, b in zip(sizes, boxes, strict=True)]
    return "\n".join(lines[i][0] for lo, hi in surges(sizes, 1, 0.0) for i in range(lo, hi))


def extract_main_text(pages: DataFrame, html_col: str = "html", out: str = "text") -> DataFrame:
    """Columns of ``pages`` but the html, plus the text and its code points ``n_chars``."""
    ship(pages.sparkSession)
    keep = [c for c in pages.columns if c not in (html_col, out, "n_chars")]
    src = pages.select(*[F.col(f"`{c}`") for c in keep], F.col(html_col).alias("__html"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.select(*[F.col(f"`{c}`") for c in keep])
                       .schema) + (", " if keep else "") + f"`{out}` string, n_chars bigint"

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, SMALL_BATCH):
                part = b.slice(lo, SMALL_BATCH)
                texts = [extract(h) for h in part.column(part.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(part.num_columns - 1)]
                    + [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=[*keep, out, "n_chars"])

    return src.mapInArrow(run, schema)
