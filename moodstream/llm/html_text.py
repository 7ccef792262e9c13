"""Main text of web pages by two-pass block rules.

A page is cut into blocks of text. The first pass decides a block by its place (menus, headers, footers, side
bars, notices, adverts, forms and reader comments are out), its link density, its length and its share of stop
words; short or unusual blocks stay open. The second pass gives open blocks the label of their nearest
decided neighbours.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodstream.llm.common import ship

#: Frequent function words of the languages in use.
STOP_WORDS = frozenset(
    "the of and to in a is that it for on with as was be by this are from at or an not have his he but they you which"
    " we their has been were will one all would there can more if so when who its had up out about into than no"
    " der die das und ist in den von zu mit sich auf für nicht ein eine als auch es an werden aus er hat dass sie nach wird bei"
    " einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis mehr durch man"
    " le la les de des du et est en un une que qui dans pour pas au sur par plus ne se avec ce il sont mais ou son aux"
    " on nous comme elle leur cette ses tout fait été ont"
    " el los las y es una del por con para al lo como más su sus o pero le ha me si sin sobre este ya entre cuando todo esta ser son dos también fue había".split()
)
_SKIPPED = frozenset("script style noscript template iframe svg object canvas select option button textarea head title audio video math".split())
_RAW = frozenset("script style textarea title noscript iframe template svg".split())
_BOXES = frozenset(
    "html body div section article main nav aside header footer form fieldset ul ol dl table tbody thead tfoot tr figure details dialog menu address blockquote".split()
)
_BLOCKS = _BOXES | frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre hr figcaption caption summary legend label center".split())
_OUT = frozenset("nav aside footer header form menu dialog fieldset".split())
_VOID = frozenset("br hr img input meta link area base col embed source track wbr param".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
_LIST_NAMES = r"related|recommend\w*|comments?|commentlist|disqus|respond|repl(?:y|ies)|discussion"
_PART_NAMES = (
    r"ads?|advert\w*|adsense|adbox|banner|sponsor\w*|promo\w*|nav|navi\w*|navbar|menu\w*|breadcrumbs?|header|masthead|footer|"
    r"side-?bar|aside|widgets?|share|sharing|social|cookies?|consent|gdpr|notice|notification|alert|pop-?up|overlay|modal|"
    r"newsletter|subscribe|subscription|sign-?up|login|form|reviews?|toolbar|pagination|pager"
)
#: A class or id counts as a whole or by its head, behind words that only say where the part stands.
_PLACED = r"(?:(?:site|page|main|global|top|bottom|primary|secondary|mobile)-)*"
_STATES = r"(?!.*-(?:with|has|have|no|not|without|layout|open|closed|fixed|sticky|enabled|disabled|active|visible|hidden|on|off|page|template)(?:-|$))"
_OUT_LIST = re.compile(rf"{_STATES}(?:(?:post|article|entry|blog|story)-)?{_PLACED}(?:{_LIST_NAMES})(?:-.*)?")
_TEASER = re.compile(r"(?:^|\s)teasers?(?:$|[\s_-])")
_OUT_PART = re.compile(rf"{_STATES}{_PLACED}(?:{_PART_NAMES})(?:-.*)?")
_NAME = re.compile(r"</?([a-zA-Z][a-zA-Z0-9:-]*)")
_MARK = re.compile("[>\"']")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[^\W\d_]+")

LONG = 200
SHORT = 70
MOST_LINKED = 0.5
STOP_LOW, STOP_HIGH = 0.15, 0.30


#: Why a box is out: its tag, role or state; its class or id; a class or id of reader comments or teasers.
PLACE, NAMED, LISTED = 1, 2, 3


@dataclass(eq=False)
class Box:
    name: str
    why: int
    article: bool
    parent: Box | None
    out: bool = False
    inside: bool = False
    #: The header of an article, whose headings alone belong to it.
    title: bool = False


@dataclass
class Block:
    text: str
    linked: int
    box: Box | None
    heading: bool
    out: bool = False
    inside: bool = False
    label: str = ""
    #: Share of stop words, once it is known.
    share: float | None = None


class _Tags:
    """The tags of a page in one forward pass, whatever is left open in it.

    A tag ends at the first ``>`` outside quotes. Where a scan for it came past a place outside quotes and failed, any
    other scan past that place fails too; these places are remembered, so no part of a page is scanned again and again.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")
        self.last_quote = {q: page.rfind(q) for q in "\"'"}
        self.failed: set[int] = set()

    def _end(self, at: int) -> int:
        """Place of the ``>`` that closes a tag whose attributes start at ``at``, or -1."""
        passed = []
        while at <= self.last and at not in self.failed:
            found = _MARK.search(self.page, at)
            if found[0] == ">":
                return found.start()
            passed.append(at)
            if found.start() >= self.last_quote[found[0]]:
                break
            at = self.page.find(found[0], found.end()) + 1
        passed.append(at)
        self.failed.update(passed)
        return -1

    def next(self, at: int) -> tuple[int, int, str, bool, str] | None:
        """Start, end, lower-case name (empty for comments and the like), whether it closes, and attributes."""
        page = self.page
        while (i := page.find("<", at)) >= 0:
            at = i + 1
            if page.startswith("<!--", i):
                j = page.find("-->", i + 4)
                return i, len(page) if j < 0 else j + 3, "", False, ""
            if page.startswith("<![CDATA[", i):
                j = page.find("]]>", i + 9)
                return i, len(page) if j < 0 else j + 3, "", False, ""
            if page.startswith(("<!", "<?"), i):
                if i < self.last:
                    return i, page.find(">", i) + 1, "", False, ""
                continue
            name = _NAME.match(page, i)
            if name and i < self.last and (end := self._end(name.end())) >= 0:
                return i, end + 1, name[1].lower(), page[i + 1] == "/", page[name.end() : end]
        return None

    def after_raw(self, name: str, at: int) -> int:
        """Place behind the closing tag of a raw element, or the page's end."""
        found = re.compile(rf"</{name}\b", re.I).search(self.page, at)
        end = self.page.find(">", found.end()) if found else -1
        return end + 1 if end >= 0 else len(self.page)


def _named(value: str) -> int:
    """NAMED or LISTED if a word of a class or id names a part that is out, else 0."""
    found = 0
    for token in value.lower().split():
        token = re.sub(r"[-_]+", "-", token).strip("-")
        if _OUT_LIST.fullmatch(token):
            return LISTED
        if _OUT_PART.fullmatch(token):
            found = NAMED
    return found


def _is_out(name: str, attributes: str) -> int:
    if name in _OUT:
        return PLACE
    found = 0
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        value = a or b or c
        key = key.lower()
        if key in ("class", "id"):
            found = max(found, _named(value))
        if key == "role" and value.lower() in _OUT_ROLES:
            return PLACE
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return PLACE
    return found


def _article_is_out(attributes: str) -> int:
    """LISTED if a class or id makes an article a reader comment or a teaser."""
    for key, a, b, c in _ATTRIBUTE.findall(attributes):
        if key.lower() in ("class", "id") and (_named(a or b or c) == LISTED or _TEASER.search((a or b or c).lower())):
            return LISTED
    return 0


def _settle(boxes: list[Box], blocks: list[Block]) -> None:
    """Decide which boxes are out, parents first, and what that makes of their blocks.

    A class or id never puts out a box that holds the main element, or the article: one with at least half of the
    good text that stands in no box that is out. Teasers in a side bar and reader comments stay out.
    """

    def decide() -> None:
        for box in boxes:
            above = box.parent
            own = box.why != 0
            box.out = own or above is not None and above.out
            box.inside = box.article and not box.out or above is not None and above.inside and not own
            box.title = box.title or above is not None and above.title
        for block in blocks:
            block.out = block.box is not None and (block.box.out or block.box.title and not block.heading)
            block.inside = block.box is not None and block.box.inside

    cleared: set[int] = set()

    def clear(above: Box | None) -> None:
        """Let no class or id put out a box or what holds it; each box is visited once."""
        while above is not None and id(above) not in cleared:
            cleared.add(id(above))
            above.why = above.why if above.why == PLACE else 0
            above = above.parent

    for box in boxes:
        if box.name == "main":
            clear(box.parent)
    decide()
    # Good text of each article that only a class or id above it puts out.
    held: dict[int, int] = {}
    articles: dict[int, Box] = {}
    outside = 0
    if any(box.article and box.out and not box.why for box in boxes):
        # The nearest article or marked box of each box, and whether only classes and ids are marked above it.
        nearest: dict[int, Box | None] = {}
        only_named: dict[int, bool] = {}
        for box in boxes:
            above = box.parent
            nearest[id(box)] = box if box.article or box.why else None if above is None else nearest[id(above)]
            only_named[id(box)] = above is None or only_named[id(above)] and above.why in (0, NAMED)
        for block in blocks:
            if not _reads_well(block):
                continue
            outside += 0 if block.out else len(block.text)
            box = nearest[id(block.box)] if block.box is not None else None
            if box is not None and box.article and not box.why and box.out:
                held[id(box)] = held.get(id(box), 0) + len(block.text)
                articles[id(box)] = box
        lifted = [articles[key].parent for key, size in held.items() if size >= outside and only_named[key]]
        cleared.clear()
        for above in lifted:
            clear(above)
        if lifted:
            decide()


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order with their place; markup may be unclosed or wrongly nested."""
    out: list[Block] = []
    parts: list[str] = []
    linked = 0
    boxes: list[Box] = []
    stack: list[Box] = []
    # How often each name is open, so that a closing tag without a partner costs nothing.
    open_names: Counter[str] = Counter()
    in_link = skip = 0
    heading = False
    tags = _Tags(page)

    def close() -> None:
        nonlocal linked
        text = " ".join("".join(parts).split())
        parts.clear()
        if text:
            out.append(Block(text, linked, stack[-1] if stack else None, heading))
        linked = 0

    def push(name: str, why: int, title: bool = False) -> None:
        boxes.append(Box(name, why, name in ("article", "main"), stack[-1] if stack else None, title=title))
        stack.append(boxes[-1])
        open_names[name] += 1

    def pop() -> str:
        name = stack.pop().name
        open_names[name] -= 1
        return name

    def why_out(name: str, attributes: str) -> int:
        if name == "article":
            return _article_is_out(attributes)
        return 0 if name in ("main", "body", "html") else _is_out(name, attributes)

    at = 0
    while at < len(page):
        tag = tags.next(at)
        stop = tag[0] if tag else len(page)
        if stop > at and not skip:
            text = html.unescape(page[at:stop])
            parts.append(text)
            if in_link:
                linked += len(" ".join(text.split()))
        if not tag:
            break
        _, at, name, closing, attributes = tag
        if not name:
            continue
        if name in _RAW and not closing:
            if not attributes.rstrip().endswith("/"):
                at = tags.after_raw(name, at)
            continue
        if name in _SKIPPED:
            skip = max(0, skip + (-1 if closing else 1)) if name not in ("head", "option") else skip
            if name == "head" or name == "option":
                close() if not skip else None
            continue
        if name == "a":
            in_link = 0 if closing else 1
        elif name == "br":
            parts.append(" ")
        elif name in _BLOCKS:
            close()
            heading = name in _HEADINGS and not closing
            if name in _BOXES and name not in _VOID:
                if closing:
                    if open_names[name]:
                        while pop() != name:
                            pass
                        in_link = 0
                elif not attributes.rstrip().endswith("/"):
                    if name == "header" and open_names["article"]:
                        push(name, _is_out("", attributes), title=True)
                    else:
                        push(name, why_out(name, attributes))
            elif not closing and (why := _is_out(name, attributes)):
                # A paragraph or list item that is itself marked: treat it as a box until the next block.
                push(name, why)
            if stack and stack[-1].name not in _BOXES and (closing and stack[-1].name == name or stack[-1].name != name):
                pop()
    close()
    _without_stop_words(out)
    _settle(boxes, out)
    return out


def _stop_share(block: Block) -> float:
    if block.share is None:
        words = _WORD.findall(block.text.lower())
        block.share = sum(w in STOP_WORDS for w in words) / len(words) if words else 0.0
    return block.share


def _reads_well(block: Block) -> bool:
    """Whether length, links and stop words alone make the block good."""
    size = len(block.text)
    if block.heading or size < SHORT or block.linked > MOST_LINKED * size:
        return False
    share = _stop_share(block)
    return share >= STOP_HIGH or share >= STOP_LOW and size >= LONG


def _without_stop_words(blocks: list[Block]) -> None:
    """Where no longer block has the stop words of any listed language, let length and links decide alone."""
    long = [b for b in blocks if not b.heading and len(b.text) >= SHORT and b.linked <= MOST_LINKED * len(b.text)]
    if long and all(_stop_share(b) < STOP_LOW for b in long):
        for block in long:
            block.share = STOP_HIGH


def _first_pass(block: Block) -> str:
    if block.out:
        return "bad"
    size = len(block.text)
    if block.linked > MOST_LINKED * size:
        return "bad"
    if block.heading or size < SHORT:
        return "open"
    share = _stop_share(block)
    if share >= STOP_HIGH or (share >= STOP_LOW and size >= LONG):
        return "good"
    if size >= LONG and share < STOP_LOW and not block.inside:
        return "bad"
    return "good" if share >= STOP_LOW else "open"


def _nearest(blocks: list[Block], chosen: list[int]) -> dict[int, tuple[int | None, int | None]]:
    """For each chosen block, the decided chosen blocks before and after it."""
    decided = [i for i in chosen if blocks[i].label != "open"]
    out: dict[int, tuple[int | None, int | None]] = {}
    before = None
    position = 0
    for i in chosen:
        while position < len(decided) and decided[position] < i:
            before = decided[position]
            position += 1
        out[i] = before, decided[position] if position < len(decided) else None
    return out


def main_text(page: str | None) -> str:
    """Blocks of the main text joined by line breaks; a null page is empty."""
    blocks = blocks_of(page or "")
    # An article counts where articles hold at least half of the good text; good blocks outside it stay in any case.
    good = [(b.inside, len(b.text)) for b in blocks if not b.out and _reads_well(b)]
    trusted = 2 * sum(n for inside, n in good if inside) >= sum(n for _, n in good)
    for block in blocks:
        block.inside = block.inside and not block.out and trusted
        block.label = _first_pass(block)
    # Open blocks of the article have their neighbours within it, others in the whole page.
    article = [i for i, b in enumerate(blocks) if b.inside]
    nearest = _nearest(blocks, list(range(len(blocks))))
    nearest.update(_nearest(blocks, article))
    kept = []
    for i, block in enumerate(blocks):
        label = block.label
        if label == "open":
            left, right = nearest[i]
            if left is None and right is None:
                label = "good" if block.inside else "bad"
            elif left is None or right is None:
                label = blocks[right if left is None else left].label
            elif blocks[left].label == blocks[right].label:
                label = blocks[left].label
            elif block.heading:
                label = blocks[right].label
            elif i - left == right - i:
                label = "good" if block.inside else "bad"
            else:
                label = blocks[left if i - left < right - i else right].label
        if label == "good":
            kept.append(block.text)
    return "\n".join(kept)


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            part = batch.slice(start, 200)
            texts = [main_text(page) for page in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["row", "text"])


def extract_text(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """Columns in ``keep``, ``text`` (empty where a page has none) and ``n_chars``, one row per page.

    Null pages are empty, repeated rows are repeated, and columns not in ``keep`` are ignored. Of the header of an
    article only headings stay. Pages in none of the listed languages are judged by length and links alone. The time
    for a page grows in proportion to its length, whatever tags or quotes are left open in it.
    """
    source = pages.select(F.struct(*[F.col(c) for c in keep]).alias("row"), F.col(html_col).alias("html"))
    out = source.mapInArrow(_extracted, f"row {source.schema['row'].dataType.simpleString()}, text string")
    return out.select(*[F.col("row").getField(c).alias(c) for c in keep], "text", F.length("text").cast("long").alias("n_chars"))


def op6(spark, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    ship(spark)
    return extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
