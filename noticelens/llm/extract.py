"""Main text of web pages by two passes over their blocks.

A block is the text between two block-level tags. The first pass decides what it can from
the block and where it stands: inside a menu, footer, form, advert and the like it is
bad, inside the article good; without an article, stop-word density, length and link
density decide. A long run of ambiguous blocks is good beside a good block, or if the page
has none. What stays ambiguous takes the label of its nearest decided neighbour in the second
pass; a heading looks ahead only.

Character references are decoded, white space inside a block becomes one space, blocks
are trimmed and joined in page order by an empty line; nothing else is dropped or cut.

Defined cases: null, empty and tagless pages (the latter are one block), unclosed and
stray tags, and comments and scripts without an end, which reach to the end of the page;
a page where nothing is decided is taken whole; of two neighbours equally near, a long
block takes the good label and a short one the bad; repeated rows are extracted alike;
other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelens.llm.common import strings

# Blocks shorter than SHORT are not judged by their words; from LONG on they need no neighbour.
SHORT, LONG = 70, 200
STOP_LOW, STOP_HIGH, LINKS = 0.25, 0.32, 0.33

# Frequent words of the languages of the corpus.
STOP_WORDS = frozenset(
    "a an and are as at be by for from has have he in is it its not of on or that the this to was "
    "were which will with you "
    "au aux avec ce dans de des du elle en est et il la le les mais ne ou par pas plus pour que qui "
    "se son sur un une "
    "aber auch auf aus bei das dem den der des die ein eine er es für ich im ist mit nicht sich sie "
    "und von war werden wie zu "
    "como con del el es esta la las lo los más no para pero por que se si sin su sus un una y".split()
)

# Elements by their meaning in HTML.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol "
    "optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset(
    "article aside body details dialog div dl fieldset figure footer form header main menu nav ol "
    "section table ul".split()
)
SKIPPED = frozenset(
    "audio button canvas head iframe math noscript object script select style svg template textarea "
    "title video".split()
)
BAD = frozenset("aside dialog footer form menu nav".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Words of class, id and role that tell what a container is for.
BAD_NAMES = frozenset(
    "ad ads adv advert advertisement advertising alert banner breadcrumb breadcrumbs comment comments "
    "commentlist complementary consent contentinfo cookie cookies copyright dialog discussion disqus "
    "footer gdpr login menu modal nav navbar navigation newsletter notice notification overlay pager "
    "pagination popup promo promoted recommended related replies reply respond rail search share "
    "sharing sidebar signup social sponsor sponsored subscribe teaser toolbar widget".split()
)
# Those of the bad names that hardly ever stand around a page's own text.
NEVER_NAMES = frozenset(
    "ad ads adv advert advertisement advertising comment comments commentlist consent cookie cookies "
    "copyright discussion disqus footer gdpr menu nav navbar navigation newsletter promo promoted rail "
    "recommended related replies reply respond sidebar signup sponsor sponsored subscribe teaser".split()
)
HEAD_NAMES = frozenset("header masthead".split())
# With one of these, a class tells of a state or layout of what is around.
MODIFIERS = frozenset("fixed has hide layout no not show sticky with without".split())
GOOD_NAMES = frozenset("article content entry main post story".split())

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)"""
    r"""((?:[^>"']++|"[^"]*+"|'[^']*+')*+|[^>]*+)(?:>|\Z)""",
    re.S,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Block:
    text: str
    links: float
    bad: bool
    region: int
    heading: bool
    listed: bool
    wrapper: int = 0
    inner: int = 0


@dataclass
class _Place:
    """An open container: its tag, and what holds for all inside it.

    ``wrapper`` numbers the container whose name alone makes this bad, 0 if there is none
    or something else does too; ``inner`` is the region gained inside that container.
    """

    tag: str
    bad: bool = False
    region: int = 0
    wrapper: int = 0
    inner: int = 0


@dataclass
class _Reader:
    """Cuts a page into blocks."""

    blocks: list[Block] = field(default_factory=list)
    places: list[_Place] = field(default_factory=lambda: [_Place("")])
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    in_link: bool = False
    tag: str = ""
    opened: int = 0

    def text(self, raw: str) -> None:
        text = html.unescape(raw) if "&" in raw else raw
        self.parts.append(text)
        if self.in_link:
            self.linked += len("".join(text.split()))

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                solid = len(text) - text.count(" ")
                place = self.places[-1]
                self.blocks.append(
                    Block(
                        text,
                        self.linked / solid,
                        place.bad,
                        place.region,
                        self.tag in HEADINGS,
                        self.tag == "li",
                        place.wrapper,
                        place.inner,
                    )
                )
        self.parts, self.linked = [], 0

    def open(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.parts.append(" ")
        elif tag == "a":
            self.in_link = True
        elif tag in BLOCKS:
            self.flush()
            self.tag, self.in_link = tag, False
            if tag in CONTAINERS:
                self.places.append(self._place(tag, attributes))

    def close(self, tag: str) -> None:
        if tag == "a":
            self.in_link = False
        elif tag in BLOCKS:
            self.flush()
            self.tag, self.in_link = "", False
            if tag in CONTAINERS:
                for n in range(len(self.places) - 1, 0, -1):
                    if self.places[n].tag == tag:
                        del self.places[n:]
                        break

    def _place(self, tag: str, attributes: str) -> _Place:
        above = self.places[-1]
        tokens, hidden = _names(attributes)
        names = set().union(*tokens)
        said = set().union(*(words for words in tokens if not words & MODIFIERS))
        named = tag != "body" and bool(said & BAD_NAMES)
        own = {"article": 3, "main": 2}.get(tag, 0)
        if not own and names & GOOD_NAMES and not said & BAD_NAMES:
            own = 2 if "main" in names or "article" in names else 1
        region = max(own, above.region)
        head = region < 2 and (tag == "header" or (bool(names & HEAD_NAMES) and tag != "body"))
        other = hidden or tag in BAD or head
        self.opened += 1
        wrapper, inner = above.wrapper, max(own, above.inner) if above.wrapper else 0
        if other or (above.bad and not above.wrapper):
            wrapper = inner = 0
        elif named:
            # A second bad name inside counts as a wrapper only if nothing good came between.
            number = -self.opened if said & NEVER_NAMES else self.opened
            wrapper, inner = (number, own if own >= 2 else 0) if not above.inner else (0, 0)
        return _Place(tag, above.bad or other or named, region, wrapper, inner)


def _names(attributes: str) -> tuple[list[set[str]], bool]:
    """Words of each token of class, id and role; whether the element is hidden."""
    names, hidden = [], False
    for name, value in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), value.strip("\"'")
        if name in ("class", "id", "role"):
            names.extend({word.lower() for word in _NAME.findall(token)} for token in value.split())
        elif name == "style":
            hidden |= re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None
        elif name == "hidden" or value.lower() == "true":
            hidden = True
    return names, hidden


def blocks_of(page: str) -> list[Block]:
    """The blocks of a page in page order."""
    reader, at = _Reader(), 0
    for_end: dict[str, re.Pattern] = {}
    while True:
        found = _TAG.search(page, at)
        if found is None:
            break
        if found.start() > at:
            reader.text(page[at : found.start()])
        at = found.end()
        tag = (found[2] or "").lower()
        if not tag:
            continue
        if found[1]:
            reader.close(tag)
        elif tag in SKIPPED:
            if not found[3].endswith("/"):
                pattern = for_end.setdefault(tag, re.compile(rf"</{tag}\s*(?:>|\Z)", re.I))
                end = pattern.search(page, at)
                if end or tag != "head":
                    at = end.end() if end else len(page)
        else:
            reader.open(tag, found[3])
    reader.text(page[at:])
    reader.flush()
    return reader.blocks


def stop_density(text: str) -> float:
    words = _WORD.findall(text.lower())
    return sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0


def unwrap(blocks: list[Block]) -> None:
    """Clears blocks whose container has a bad name but holds what the page is about.

    An article, main or content container inside it tells so on a page that has none outside
    of bad containers; else only more than half of the page's text outside of links, if there
    is no text beside it to be the page's own. Comments, cookie notices, teasers, adverts,
    sidebars and menus (wrappers below 0) are cleared for neither reason beside such text.
    """
    size = [len(b.text) if b.links <= LINKS else 0 for b in blocks]
    inside: dict[int, int] = {}
    for b, n in zip(blocks, size):
        if b.wrapper:
            inside[b.wrapper] = inside.get(b.wrapper, 0) + n
    if not inside:
        return
    elsewhere = max((b.region for b in blocks if not b.bad), default=0)
    alone = sum(n for b, n in zip(blocks, size) if not b.bad) < SHORT
    for b in blocks:
        if b.wrapper and (alone or b.wrapper > 0):
            by_size = alone and elsewhere < 2 and 2 * inside[b.wrapper] > sum(size)
            if b.inner > elsewhere or by_size:
                b.bad = False


def first_pass(block: Block, region: int) -> bool | None:
    """Good, bad or undecided. ``region`` is the least one that the page's text stands in."""
    if block.bad:
        return False
    if block.region >= 2:
        return not (block.listed and block.links > 0.8)
    if block.links > LINKS:
        return False
    density = stop_density(block.text) if len(block.text) >= SHORT else 0.0
    if density >= STOP_HIGH or (density >= STOP_LOW and len(block.text) >= LONG):
        return True
    return False if block.region < region else None


def home_region(blocks: list[Block]) -> int:
    """The region from which on blocks hold at least half of the text, 0 if none does.

    Outside of it only stop words make a block good; a teaser or a date decides nothing.
    """
    free = [b for b in blocks if not b.bad and (b.region >= 2 or b.links <= LINKS)]
    whole = sum(len(b.text) for b in free)
    for region in (2, 1):
        held = sum(len(b.text) for b in free if b.region >= region)
        if held and 2 * held >= whole:
            return region
    return 0


def settle_runs(blocks: list[Block], labels: list[bool | None]) -> list[bool | None]:
    """Labels with long runs of undecided blocks made good.

    Menus and links say nothing of the text beside them, and stop words only know some
    languages. So a run that is long enough together is good where it borders on a good
    block or the page has none; headings at its end stay with what follows them.
    """
    out, count, any_good = list(labels), len(blocks), True in labels
    start = 0
    while start < count:
        end = start
        while end < count and labels[end] is None:
            end += 1
        long_run = sum(len(b.text) for b in blocks[start:end]) >= SHORT
        beside = (start > 0 and labels[start - 1]) or (end < count and labels[end])
        if long_run and (beside or not any_good):
            last = end
            while end < count and not labels[end] and last > start and blocks[last - 1].heading:
                last -= 1
            out[start:last] = [True] * (last - start)
        start = end + 1
    return out


def second_pass(blocks: list[Block], labels: list[bool | None]) -> list[bool]:
    """Undecided blocks take the label of the nearest decided one."""
    count = len(blocks)
    before, after = [None] * count, [None] * count
    last = None
    for n in range(count):
        last = n if labels[n] is not None else last
        before[n] = last
    last = None
    for n in range(count - 1, -1, -1):
        last = n if labels[n] is not None else last
        after[n] = last
    out = []
    for n, label in enumerate(labels):
        if label is None:
            a, b = before[n], after[n]
            if a is None and b is None:
                label = True
            elif blocks[n].heading and b is not None:
                label = labels[b]
            elif a is None or b is None:
                label = labels[b if a is None else a]
            elif n - a != b - n:
                label = labels[a if n - a < b - n else b]
            elif len(blocks[n].text) >= SHORT:
                label = labels[a] or labels[b]
            else:
                label = labels[a] and labels[b]
        out.append(bool(label))
    return out


def main_text(page: str) -> str:
    """The text of the good blocks, joined by empty lines."""
    blocks = blocks_of(page)
    unwrap(blocks)
    region = home_region(blocks)
    labels = settle_runs(blocks, [first_pass(b, region) for b in blocks])
    labels = second_pass(blocks, labels)
    return "\n\n".join(b.text for b, good in zip(blocks, labels) if good)


def extract(
    pages: DataFrame, id_col: str = "page_id", html_col: str = "html", with_cols: tuple[str, ...] = ("url",)
) -> DataFrame:
    """(id, *with_cols, text, n_chars) of every page, from its whole source."""
    kept = [F.col(c).alias(f"c{n}") for n, c in enumerate((id_col, *with_cols))]
    rows = pages.select(F.col(html_col).alias("html"), *kept)
    names = [f"c{n}" for n in range(len(kept))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page) for page in strings(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=[*names, "text", "n_chars"],
            )

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[1:]]
    found = rows.mapInArrow(run, ", ".join([*fields, "text string", "n_chars long"]))
    return found.select(
        *[F.col(n).alias(c) for n, c in zip(names, (id_col, *with_cols))], "text", "n_chars"
    )
