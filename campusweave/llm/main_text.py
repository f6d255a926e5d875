"""Main text of pages by two-pass block rules.

A page is cut into blocks at block-level tags. The first pass decides what it can: blocks inside navigation, headers, footers,
asides, forms, notices, adverts and comments are dropped; of the others, a block is good if it is long and holds many stop
words, bad if it is mostly links, or long without stop words. Short and middling blocks are ambiguous: the second
pass gives them the label of the nearest decided block of the same article, looking both ways.

An <article> or <main> is a section of its own: blocks outside it are not part of the text of a page that has one, its blocks
take their labels from each other, and ambiguous blocks without a decided one beside them stay. So a short
paragraph at the end of an article goes with the article and not with the footer after it.

Per page only the blocks and their counts are made in Python; pages share nothing, so there is no shuffle.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campusweave.llm.common import by_step

BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noframes ol optgroup option p pre section select summary table "
    "tbody td textarea tfoot th thead title tr ul".split()
)
VOID = frozenset("area base basefont bgsound br col embed frame hr img input keygen link meta param source track wbr".split())
NOISE = frozenset(
    "applet aside audio button canvas dialog embed footer form head header iframe input label legend math menu nav noframes noscript object "
    "option script select style svg template textarea title video".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SECTIONS = frozenset(["article", "main"])
#: Words of class, id and role that tell what is not the article.
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies disqus footer gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "notification outbrain paywall popup promo promoted promotion related recommended replies reply respond search share sharing sidebar "
    "signup skip social sponsor sponsored sponsors subscribe subscription taboola toolbar widget widgets".split()
)
#: Common function words of some languages; only how many of a block's words are among them counts.
STOP_WORDS = {
    "en": "a about all an and are as at be been but by can for from had has have he her his if in is it its more not of on one or our she so that the their there they this to was we were what when which who will with would you",
    "de": "als am an auch auf aus bei bin bis das dass dem den der des die durch ein eine einem einen einer er es für hat ich im in ist mit nach nicht noch oder sich sie sind so über um und von vor war was wie wir zu zum zur",
    "fr": "au aux avec ce cette ces dans de des du elle en est et il ils je la le les leur lui mais ne nous on ont ou par pas plus pour qui que sa se ses son sont sur un une vous",
    "es": "al como con cuando de del desde el ella en entre era es esta este fue ha hay la las le lo los más me muy no nos o para pero por que se ser si sin sobre son su sus también un una y ya",
    "it": "al alla anche che chi ci come con da dal de dei del della di e gli ha i il in la le lo ma mi ne nel nella non o per più quando questa questo se si sono su sua suo tra un una",
    "pt": "ao aos as com como da das de do dos e ela ele em entre era essa esta este foi há isso mais mas na nas no nos não o os ou para pela pelo por que se sem ser seu sua também um uma",
    "nl": "aan als bij dan dat de der die dit door een en er had heeft het hij hun ik in is je maar met naar niet nog of om onder ook op over te tot uit van voor was wat we werd wie wordt ze zijn zo",
}
#: Code points of a long block, and shares of stop words and of linked code points.
LONG, MANY, SOME, LINKED, ALL_LINKED = 70, 0.25, 0.08, 0.34, 0.9

_STOPS = frozenset(w for words in STOP_WORDS.values() for w in words.split())
_WORD = re.compile(r"[^\W\d_]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
_BROKEN = re.compile("<[A-Za-z/!?]")
_NAME = re.compile(r"[A-Za-z]+")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: A menu inside an article is dropped as noise is: it says nothing about the blocks beside it.
GOOD, UNSURE, BAD, MENU = 1, 0, -1, -2


@dataclass(slots=True)
class Block:
    tag: str
    section: int  # number of the innermost article or main, -1 outside
    text: str = ""
    linked: int = 0
    words: int = 0
    stops: int = 0
    label: int = UNSURE


@dataclass(slots=True)
class Open:
    tag: str
    noise: int  # 2: whatever is inside, 1: unless an article or main begins in it, 0: none
    section: int
    headings: bool = False  # an article's own header: its headings are not noise
    link: bool = False


@dataclass
class Blocks(HTMLParser):
    """A page's blocks in order, by the tags alone; text of noise is left out as it comes."""

    markup: str
    found: list[Block] = field(default_factory=list)

    def __post_init__(self):
        super().__init__(convert_charrefs=True)
        self._open = [Open("", 0, -1)]
        self._strings: list[str] = []
        self._links: list[str] = []
        self._sections = 0
        self.feed(self.markup)
        if _BROKEN.match(self.rawdata):
            self.rawdata = ""  # a tag or comment that the page's end cuts off is markup
        self.close()
        self._end_block()

    def _end_block(self):
        text = " ".join("".join(self._strings).split())
        if text:
            top = self._open[-1]
            tag = next((o.tag for o in reversed(self._open) if o.tag in BLOCK), "")
            words = _WORD.findall(text.lower())
            linked = len(" ".join("".join(self._links).split()))
            self.found.append(Block(tag, top.section, text, linked, len(words), sum(w in _STOPS for w in words)))
        self._strings.clear()
        self._links.clear()

    def _push(self, tag: str, attrs: list[tuple[str, str | None]]):
        top = self._open[-1]
        noise, section, headings = top.noise, top.section, top.headings
        if tag in SECTIONS:
            if noise == 1:
                noise, headings = 0, False
            section, self._sections = self._sections, self._sections + 1
        if tag in HEADINGS and headings:
            noise = 0
        elif noise < 2:
            noise = max(noise, self._noise(tag, dict(attrs)))
            if noise and not top.noise and section >= 0 and tag not in SECTIONS:
                headings = "header" in (tag, *_words(dict(attrs)))
        self._open.append(Open(tag, noise, section, headings, top.link or tag == "a"))

    def _noise(self, tag: str, attrs: dict) -> int:
        if tag in ("html", "body"):
            return 0
        if not attrs:
            return 0 if tag not in NOISE else 1 if tag == "form" else 2
        hidden = "hidden" in attrs or attrs.get("aria-hidden") == "true" or _HIDDEN.search(attrs.get("style") or "")
        if hidden or (tag in NOISE and tag != "form"):
            return 2
        named = NOISE_WORDS.intersection(_words(attrs)) - ({"header"} if tag in HEADINGS else set())
        return 2 if named and tag in SECTIONS else int(bool(named) or tag == "form")

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self._end_block()
            # a paragraph ends where a block begins, an item where the next one does
            ends = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}.get(tag, ())
            self._close_up_to(("p", *HEADINGS) if tag in HEADINGS else ("p",), BLOCK | NOISE)
            if ends:
                self._close_up_to(ends, {"ul", "ol", "dl", "table", "select", "menu"})
        if tag in VOID:
            if tag == "br":
                self._strings.append(" ")
            return
        if tag == "a":
            self._close_up_to(("a",), BLOCK)
        self._push(tag, attrs)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK:
            self.handle_endtag(tag)

    def _close_up_to(self, tags, fence):
        """Close the innermost open element of these tags, unless one of the fence lies inside it."""
        for at in range(len(self._open) - 1, 0, -1):
            if self._open[at].tag in tags:
                del self._open[at:]
                return
            if self._open[at].tag in fence:
                return

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self._end_block()
        for at in range(len(self._open) - 1, 0, -1):
            if self._open[at].tag == tag:
                del self._open[at:]
                return
            if tag not in BLOCK and self._open[at].tag in BLOCK:
                break  # an inline end tag does not close blocks
        if tag == "a":
            for element in self._open:
                element.link = False

    def handle_data(self, data):
        if self._open[-1].noise == 0:
            self._strings.append(data)
            if self._open[-1].link:
                self._links.append(data)

    def unknown_decl(self, data):
        if data.upper().startswith("CDATA["):
            self.handle_data(data[6:])


def _words(attrs: dict) -> list[str]:
    """Words of the names an element bears, whole and in their parts: side, bar and sidebar of sideBar."""
    named = " ".join(attrs.get(name) or "" for name in ("class", "id", "role"))
    return [w.lower() for w in (*_NAME.findall(named), *_PARTS.findall(named))]


def decided(blocks: list[Block]) -> None:
    """First pass: labels by length, stop words and links; what has none stays UNSURE."""
    sections = any(b.section >= 0 for b in blocks)
    for b in blocks:
        inside, chars = b.section >= 0, len(b.text)
        if sections and not inside:
            b.label = BAD
        elif b.tag == "li" and b.linked >= ALL_LINKED * chars:
            b.label = MENU if inside else BAD
        elif b.linked >= LINKED * chars:
            b.label = UNSURE if inside else BAD
        elif chars >= LONG and b.stops >= MANY * b.words:
            b.label = GOOD if b.words else UNSURE
        elif chars >= LONG and b.stops < SOME * b.words and not inside:
            b.label = BAD


def inherited(blocks: list[Block]) -> None:
    """Second pass: an unsure block takes the label of the nearest decided one of its section, good of two as near; without any it is good.

    A heading looks to what it heads, and back only if nothing decided follows.
    """
    for section in {b.section for b in blocks}:
        own = [b for b in blocks if b.section == section]
        gaps = []
        for run in (own, own[::-1]):
            near, gap, side = UNSURE, 0, []
            for b in run:
                near, gap = (b.label, 0) if b.label in (GOOD, BAD) else (near, gap + 1)
                side.append((gap, -near) if near != UNSURE else (len(own) + 1, -GOOD))
            gaps.append(side)
        for b, before, after in zip(own, gaps[0], gaps[1][::-1]):
            if b.label == UNSURE:
                ahead = b.tag in HEADINGS and after[0] <= len(own)
                b.label = -(after if ahead else min(before, after))[1]


def blocks_of(html: str | None) -> list[Block]:
    """A page's labelled blocks."""
    blocks = Blocks(html or "").found
    decided(blocks)
    inherited(blocks)
    return blocks


def _pages(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.coalesce(F.col("html"), F.lit("")).alias("text"))


def blocks(pages: DataFrame) -> DataFrame:
    """page_id, url, block_no, tag, section, n_chars, n_linked, n_words, n_stops, label (1 kept, below 0 dropped) and text of each block outside noise."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, at = [], []
        for i, html in enumerate(batch.column("text").to_pylist()):
            for number, b in enumerate(blocks_of(html)):
                at.append(i)
                rows.append((number, b.tag, b.section, len(b.text), b.linked, b.words, b.stops, b.label, b.text))
        kept = batch.select(["page_id", "url"]).take(pa.array(at, pa.int32()))
        made = zip(*rows) if rows else [[]] * 9
        types = [pa.int32(), pa.string(), *[pa.int32()] * 6, pa.string()]
        return pa.RecordBatch.from_arrays([*kept.columns, *[pa.array(list(c), t) for c, t in zip(made, types)]], names)

    names = ["page_id", "url", "block_no", "tag", "section", "n_chars", "n_linked", "n_words", "n_stops", "label", "text"]
    read = _pages(pages)
    kinds = dict(read.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, block_no int, tag string, section int, n_chars int, n_linked int, n_words int, n_stops int, label int, text string"
    return by_step(read, run, schema)


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of pages (page_id, url, html).

    A null or empty html has an empty text, and so has a page without main text. Each row stands alone, so repeated rows and
    null ids are no special case; other columns are left behind. A page is read whole, whatever its length. An empty table gives an empty result.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = ["\n".join(b.text for b in blocks_of(html) if b.label == GOOD) for html in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays([*batch.select(["page_id", "url"]).columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    read = _pages(pages)
    kinds = dict(read.dtypes)
    return by_step(read, run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


#: DuckDB SQL of what the given pages must yield: each has one <article> that holds the main text and nothing else.
ORACLE = r"""WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS h FROM pages),
 b AS (SELECT page_id, url, unnest(string_split_regex(h, '</?(p|h1)>')) AS x, generate_subscripts(string_split_regex(h, '</?(p|h1)>'), 1) AS i FROM a),
 c AS (SELECT page_id, url, i, trim(regexp_replace(replace(replace(replace(replace(regexp_replace(x, '<[^>]*>', ' ', 'g'), '&quot;', '"'), '&amp;', chr(1)), '&amp', chr(1)), chr(1), '&'), '\s+', ' ', 'g')) AS x FROM b),
 d AS (SELECT page_id, string_agg(x, chr(10) ORDER BY i) AS text FROM c WHERE x <> '' GROUP BY page_id)
 SELECT page_id, url, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars FROM pages LEFT JOIN d USING (page_id)"""
