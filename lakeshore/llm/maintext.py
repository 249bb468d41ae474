"""Main-text extraction by the maximum-scoring subsequence of a page's words and tags.

A page becomes a sequence of pieces: words score positive, tags negative. The weights come from
labelled pages, those whose markup names one article: for each (element, surrounding section) the share of
words and tags that lie inside. A word scores that share, a tag costs ``TAG_COST`` plus ``OUTSIDE_COST`` times
the share outside. One linear scan finds the contiguous region of the largest score; its blocks are
returned without those inside sections that are never article text (menus, forms, comments, ...). Elements of HTML that
say so (``NEVER``) always are; names only where they do not wrap the page: a form, or an element of which a part of a name says so, is
no such section if it holds ``WRAPS`` of the words outside the others; one of which a whole name says so (or a part of it, comments), if
it holds the main element, or ``WRAPS`` of all words with no article beside it and at most ``BEFORE`` of them ahead of it.

``fit`` reads at most ``SAMPLE`` labelled pages (those with the smallest hash of their page_id); everything else is one scan without
a shuffle. Every page is read whole.

Null html is empty; a page without words gives the empty text. Repeated rows get equal results, an empty
table none (the weights then fall back to priors).
"""
from __future__ import annotations

import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import ship, table

SAMPLE = 2000            # labelled pages used to learn the weights
LEAST_SEEN = 20          # words or tags behind a weight of its own
TAG_COST, OUTSIDE_COST = 0.2, 3.0
NOISE_COST = 0.05        # a tag inside a section that is never article text
WRAPS = 0.7              # share of the words that tells a wrapper from a section
BEFORE = 0.05            # share of the words that may stand, outside noise, ahead of a wrapper whose whole name is one of noise
RAW = "script|style|textarea|title|noscript|iframe"          # text up to the end tag, or to the end of the page
EMBEDDED = "template|svg|select|object|canvas|math|audio|video"     # left out from start tag to end tag, if it has one
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*(?:>|\Z)|[^<]+|<", re.S | re.I)
EMBED = re.compile(rf"<(/?)({EMBEDDED})(?=[\s/>])((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.I)
STRICT = frozenset(("svg", "math", "select"))       # unclosed, they end at the next element that cannot be theirs
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary "
                   "table tbody td tfoot th thead tr ul".split())
FOREIGN_END = BLOCKS - {"option"} | frozenset("b big br code em embed font i iframe img small span strong sub sup u".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES_P = BLOCKS - {"body", "html", "head", "option", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "summary", "legend"}
NEVER = frozenset("nav footer aside menu dialog head button label".split())
FORMS = frozenset(("form", "fieldset"))
WORDS = re.compile(r"[^\W_]+")
NOISE = re.compile(r"^(ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|menu|nav\w*|breadcrumbs?|side-?bar|widget|foot(er)?|comments?|"
                   r"reply|replies|respond|disqus|discussion|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|"
                   r"subscribe|signup|login|share|sharing|social|related|recommend\w*|more-?stories|masthead|pagination|pager|toolbar|"
                   r"search|copyright|legal|disclaimer|tags?|skip-?link|toc)$", re.I)
REPLIES = re.compile(r"^(comments?|reply|replies|respond|disqus|discussion)$", re.I)
LAYOUT = re.compile(r"^(has|have|with|no|without|layout)$", re.I)       # "has-sidebar" is no sidebar
MAIN = re.compile(r"^(article\w*|post|entry|story|main|content)$", re.I)
BY_NAME = ("named", "weak")
NOISY = ("noise", *BY_NAME)
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)


def section(tag: str, attributes: str, inside_main: bool) -> str | None:
    """'noise'; 'named' or 'weak' (noise by a whole name or by a part of one, unless it wraps the page); 'main' or None:
    what the element says about the text in it."""
    if tag in NEVER or tag == "header" and not inside_main:
        return "noise"
    names = [n for m in ATTRIBUTE.finditer(attributes) for n in re.split(r"[\s]+", next(x for x in m.groups()[1:] if x is not None))]
    main, weak, named = any(MAIN.match(n) for n in names), tag in FORMS, False
    if tag not in ("html", "body") and not main:
        for n in names:
            parts = re.split(r"[-_]+", n)
            if NOISE.match(n) or any(map(NOISE.match, parts)) and not any(map(LAYOUT.match, parts)):
                weak = True
                named = named or any(map(REPLIES.match, parts)) or NOISE.match(n) is not None
    return "named" if named else "weak" if weak else "main" if main or tag in ("article", "main") else None


def embedded(page: str) -> dict[int, int]:
    """Embedded elements by the position of their start tag: the end of their end tag, 0 without one. The last open
    element of a name takes the end tag. A slash ends svg and math, and no other element."""
    ends: dict[int, int] = {}
    open_: dict[str, list[int]] = {}
    for m in EMBED.finditer(page):
        tag = m[2].lower()
        if not m[1]:
            if tag not in ("svg", "math") or not m[3].endswith("/"):
                ends[m.start()] = 0
                open_.setdefault(tag, []).append(m.start())
        elif open_.get(tag):
            ends[open_[tag].pop()] = m.end()
    return ends


def pieces(page: str) -> list[tuple]:
    """(kind, key, value, noise, main) in page order: kind 't' a tag, 'w' text, 'b' a block boundary
    before the piece; key is 'element|section'; noise tells text that is never main text (3: by its HTML element, 2: by
    a whole name, 1: by weak marks only)."""
    items, marked, loose = _walk(page, frozenset(), frozenset())
    spared = _named_wrappers(items, marked) - loose
    if spared:
        items, marked, _ = _walk(page, spared, loose)
    spared |= _wrappers(items, marked)
    return _walk(page, spared, loose)[0] if spared or loose else items


def _tokens(page: str, ends: dict[int, int]):
    """The tokens of a page without those of embedded elements."""
    at, foreign = 0, False
    while m := TOKEN.match(page, at):
        end = ends.get(at)
        at = end or m.end()
        tag = (m[3] or "").lower()
        foreign = not end and (tag in STRICT if end == 0 else foreign and tag not in FOREIGN_END)
        if end is None and not foreign:
            yield m


def _wrappers(items: list[tuple], marked: dict[int, list]) -> frozenset[int]:
    """The weakly marked elements that hold most of the words, or the page's article or main element."""
    weak = {at: m[:3] for at, m in marked.items() if m[3] == "weak"}
    if not weak:
        return frozenset()
    sums = _sums(items, 2)
    return frozenset(at for at, (low, high, holds) in weak.items() if holds or sums[high] - sums[low] > WRAPS * sums[-1])


def _named_wrappers(items: list[tuple], marked: dict[int, list]) -> frozenset[int]:
    """The elements with a whole name of noise that hold the page's main element, or, where no article stands outside such
    elements, most of all words."""
    named = {at: m[:3] for at, m in marked.items() if m[3] == "named"}
    if not named:
        return frozenset()
    if any(main and noise < 2 and kind == "w" and WORDS.search(value) for kind, _, value, noise, main in items):
        return frozenset(at for at, (_, _, holds) in named.items() if holds)
    sums, plain = _sums(items, 3), _sums(items, 2)
    return frozenset(at for at, (low, high, holds) in named.items()
                     if holds or sums[high] - sums[low] > WRAPS * sums[-1] and plain[low] <= BEFORE * sums[-1])


def _sums(items: list[tuple], least: int) -> list[int]:
    """Words ahead of each piece, and of the page, without those that are noise of degree ``least``."""
    sums = [0]
    for kind, _, value, noise, _ in items:
        sums.append(sums[-1] + (len(WORDS.findall(value)) if kind == "w" and noise < least else 0))
    return sums


def _walk(page: str, spared: frozenset[int], loose: frozenset[int]) -> tuple[list[tuple], dict[int, list], frozenset[int]]:
    """The pieces; the elements marked by names by position (first and last piece, whether an article or main element
    is known to be theirs, mark); and the unclosed noise elements that an article or main element was opened in. ``spared``
    elements are not marked, ``loose`` ones end where an article or main element opens."""
    items: list[tuple] = []
    stack: list[tuple[str, str | None, int]] = []
    marks = {"noise": 0, "named": 0, "weak": 0, "main": 0}
    weak: dict[int, list] = {}
    holding: dict[int, tuple[int, ...]] = {}    # noise elements an article opened in: elements of their name around them
    closed: set[int] = set()
    displaced: set[int] = set()                 # ended by the end tag of another element

    def pop(to: int) -> None:
        while len(stack) > to:
            _, mark, at = stack.pop()
            if mark:
                marks[mark] -= 1
            if mark in BY_NAME:
                weak[at][1] = len(items)

    def key() -> str:
        where = next((("noise" if m in BY_NAME else m) or t for t, m, _ in reversed(stack) if m or t in ("section", "div", "td", "li")), "")
        return f"{stack[-1][0] if stack else ''}|{where}"

    def add(kind: str, name: str, value) -> None:
        noise = 3 if marks["noise"] else 2 if marks["named"] else int(marks["weak"] > 0)
        items.append((kind, name, value, noise, marks["main"] > 0))

    def noisy_marks() -> bool:
        return any(marks[m] for m in NOISY)

    ends = embedded(page)
    for m in _tokens(page, ends) if ends else TOKEN.finditer(page):
        tag = m[3]
        if tag:
            tag = tag.lower()
            if m[2]:
                add("t", f"{tag}|{key().partition('|')[2]}", tag in BLOCKS)
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        closed.add(stack[i][2])
                        displaced.update(at for _, _, at in stack[i + 1:])
                        pop(i)
                        break
                continue
            if noisy_marks():
                if tag == "body":                       # an unclosed head, menu or the like ends here
                    while noisy_marks():
                        pop(len(stack) - 1)
                elif tag in ("article", "main"):
                    noisy = [i for i, (_, mark, _) in enumerate(stack) if mark in NOISY]
                    kept = max((i for i in noisy if stack[i][2] not in loose), default=-1)
                    ended = [i for i in noisy if i > kept]
                    if ended:
                        pop(ended[0])
                    for i in noisy:
                        if i < len(stack):
                            name, mark, at = stack[i]
                            holding[at] = tuple(other for t, _, other in stack[:i] if t == name)
                            if mark in BY_NAME and (tag == "main" or name in FORMS):
                                weak[at][2] = True
            if tag in CLOSES_P:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == "p":
                        pop(i)
                        break
                    if stack[i][0] in BLOCKS:
                        break
            if tag not in VOID and not m[4].endswith("/"):
                mark = section(tag, m[4], marks["main"] > 0)
                if mark in BY_NAME:
                    if m.start() in spared:
                        mark = None
                    else:
                        weak[m.start()] = [len(items), -1, False, mark]     # unclosed, it reaches the last piece
                stack.append((tag, mark, m.start()))
                if mark:
                    marks[mark] += 1
            add("t", f"{tag}|{key().partition('|')[2]}", " " if tag == "br" else tag in BLOCKS)
        elif m[0][0] != "<" or m[0] == "<":
            add("w", key(), m[0])
    # a missing end tag shows at an element of the same name around it, whose end tag was taken
    return items, weak, frozenset(at for at, around in holding.items() if at not in closed or displaced.intersection(around))


def count(page: str) -> Counter:
    """(kind, key, inside) -> words or tags of a labelled page; nothing if it names no article or several."""
    found: Counter = Counter()
    if len(re.findall(r"<article\b", page, re.I)) != 1:
        return found
    for kind, key, value, noise, main in pieces(page):
        n = len(WORDS.findall(value)) if kind == "w" else 1
        if n:
            found[kind, key, main and not noise] += n
    return found


def weights(counts: dict) -> dict[str, float]:
    """Share inside the article, by kind and key, with coarser keys behind it: 'w:p|main', 'w:|main', 'w:p|'."""
    sums: dict[str, list[int]] = {}
    for (kind, key, inside), n in counts.items():
        tag, _, where = key.partition("|")
        for k in (f"{kind}:{key}", f"{kind}:|{where}", f"{kind}:{tag}|*"):
            sums.setdefault(k, [0, 0])[bool(inside)] += n
    return {k: b / (a + b) for k, (a, b) in sums.items() if a + b >= LEAST_SEEN}


def share(learned: dict, kind: str, key: str) -> float:
    tag, _, where = key.partition("|")
    for k in (f"{kind}:{key}", f"{kind}:|{where}", f"{kind}:{tag}|*"):
        if k in learned and not (k.endswith("|") and where):
            return learned[k]
    return {"noise": 0.02, "main": 0.95}.get(where, 0.1 if tag in ("li", "a") else 0.6)


def extract(page: str, learned: dict, cache: dict) -> str:
    """Main text of a page: the best region, block by block."""
    best = run = 0.0
    low = start = 0
    high, items = -1, pieces(page)
    for i, (kind, key, value, noise, _) in enumerate(items):
        s = cache.get((kind, key))
        if s is None:
            p = share(learned, kind, key)
            s = cache[kind, key] = max(p, 0.02) if kind == "w" else -(TAG_COST + OUTSIDE_COST * (1 - p))
        # an advert or form in mid-article is left out anyway, so it must not part the article in two
        score = (-NOISE_COST if kind == "t" else 0.0) if noise else s * len(WORDS.findall(value)) if kind == "w" else s
        run += score
        if run <= 0:
            run, start = 0.0, i + 1
        elif run > best:
            best, low, high = run, start, i
    blocks, text = [], []
    for kind, _, value, noise, _ in items[low:high + 1]:
        if kind == "w":
            if not noise:
                text.append(value)
        elif value is True:
            blocks.append("".join(text))
            text = []
        elif value == " ":
            text.append(" ")
    blocks.append("".join(text))
    clean = (" ".join(entities.unescape(b).split()) for b in blocks)
    return "\n".join(b for b in clean if b)


def fit(pages: DataFrame) -> dict[str, float]:
    """Weights from at most ``SAMPLE`` labelled pages; counts are summed per task, then by key."""
    ship(pages.sparkSession)
    named = pages.where(F.lower("html").contains("<article"))
    smallest = [r.h for r in named.select(F.xxhash64("page_id", "url").alias("h")).orderBy("h").limit(SAMPLE).collect()]
    if not smallest:
        return {}
    sample = named.where(F.xxhash64("page_id", "url") <= smallest[-1]).select("html")

    def run(batches):
        for batch in batches:
            total: Counter = Counter()
            for x in batch.column(0):
                total.update(count(x.as_py()))
            rows = [(kind, key, inside, n) for (kind, key, inside), n in total.items()]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["kind", "name", "inside", "n"])

    summed = sample.mapInArrow(run, "kind string, name string, inside boolean, n bigint").groupBy("kind", "name", "inside").sum("n")
    return weights({(r[0], r[1], r[2]): r[3] for r in summed.collect()})      # elements times sections


def main_text(pages: DataFrame, learned: dict[str, float], out: str = "text") -> DataFrame:
    """``pages`` plus ``out``, the main text of column html."""
    if out in pages.columns:
        raise ValueError(f"column {out!r} exists")
    ship(pages.sparkSession)

    def run(batches):
        cache: dict = {}
        for batch in batches:
            texts = pa.array([extract(x.as_py() or "", learned, cache) for x in batch.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, out])

    return pages.mapInArrow(run, StructType([*pages.schema.fields, StructField(out, StringType())]))


def query(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text(pages, fit(pages)).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
