"""Main text of a page by its blocks (E11, second way): text density and link
density instead of a pattern per element.

A page is split once, from front to back, into blocks of text between
block-level tags; each block has its number of words, how many of them stand
in links, and whether it lies in an element that holds no main text
(navigation, tables, adverts, ...).  The split is row-local and runs in Arrow
batches; which blocks are main text is then decided by Spark expressions over
the block and its two neighbours, with the thresholds of the published decision
tree over shallow text features (number of words, link density).

Defined results: a NULL, empty or textless page gives no blocks and a NULL
text.  An element that is closed by its parent's end or never leaves its
content visible, so an unclosed `<nav>` does not swallow the article; an
unclosed script or style hides the rest, an unclosed comment hides nothing.  A
tag ends at the next `>`, also inside quotes; a `<` after the last `>` is text.
Time and memory grow with the page's length, whatever is left unclosed."""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Elements that end a block.
BLOCK_TAGS = ("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
              "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol option p pre section select "
              "summary table tbody td tfoot th thead tr ul").split()
#: Elements without main text.
OUTSIDE_TAGS = "aside button dialog footer form head header nav select svg table template".split()
#: The same by a whole word of an element's class, id or role.
OUTSIDE_WORDS = ("ad ads advert advertisement banner breadcrumb breadcrumbs comment comments complementary contentinfo cookie "
                 "cookies menu navigation newsletter promo related search share sharing sidebar social").split()
#: Elements whose content is no markup, up to their end tag.
RAW_TAGS = "iframe noscript script style textarea title".split()
#: Elements without an end tag, or whose end tag is commonly left out.
OPEN_TAGS = ("area base br col dd dt embed hr img input li link meta option p param source tbody td tfoot th thead tr "
             "track wbr").split()

#: Thresholds over (words, share of words in links) of a block and its neighbours.
LINKED, LINKED_BEFORE = 1 / 3, 5 / 9
LONG, LONG_NEXT, NOT_TINY = 16, 15, 4
LONG_AFTER_LINKS, LONG_NEXT_AFTER_LINKS = 40, 17

#: Letters of scripts without spaces; two count as a word.
UNSPACED = r"[฀-๿぀-ヿ㐀-鿿]"

BLOCKS = T.ArrayType(T.StructType([T.StructField("text", T.StringType()), T.StructField("words", T.IntegerType()),
                                   T.StructField("link_words", T.IntegerType()), T.StructField("outside", T.BooleanType())]))
_TYPE = pa.list_(pa.struct([("text", pa.string()), ("words", pa.int32()), ("link_words", pa.int32()), ("outside", pa.bool_())]))
_MARK = re.compile(r"<!--|<(/?)([A-Za-z][A-Za-z0-9:-]*)|<[!?]")
_NAMED = re.compile(r"""(?i)\b(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""")
_RAW_END = {name: re.compile(rf"(?i)</{name}\s*>") for name in RAW_TAGS}
_UNSPACED = re.compile(UNSPACED)
_BLOCK, _OUTSIDE, _WORDS, _OPEN = set(BLOCK_TAGS), set(OUTSIDE_TAGS), set(OUTSIDE_WORDS), set(OPEN_TAGS)


def _is_outside(name: str, attributes: str) -> bool:
    return name in _OUTSIDE or any(w in _WORDS for m in _NAMED.finditer(attributes) for w in m[1].strip("\"'").lower().split())


class _Page:
    """The blocks of one page while it is read."""

    def __init__(self):
        self.pieces: list[list[str]] = [[]]  # of each block
        self.links = [0]
        self.pending: list[tuple[int, int]] = []  # (block, words) of the link that is open
        self.linked = False
        self.stack: list[tuple[str, int | None]] = []  # (element, its first block if it holds no main text)
        self.open: dict[str, int] = {}
        self.hidden: dict[int, int] = {}  # change of the number of hiding elements at a block

    def text(self, s: str) -> None:
        if s:
            self.pieces[-1].append(s)
            if self.linked:
                self.pending.append((len(self.pieces) - 1, len(s.split())))

    def end_block(self) -> None:
        if self.pieces[-1]:
            self.pieces.append([])
            self.links.append(0)

    def link(self, opens: bool) -> None:
        for block, words in self.pending:
            self.links[block] += words
        self.pending, self.linked = [], opens

    def start(self, name: str, attributes: str) -> None:
        outside = _is_outside(name, attributes)
        if outside or name in _BLOCK:
            self.end_block()
        if name == "br":
            self.text(" ")
        elif name == "a":
            self.link(True)
        if (outside or name not in _OPEN) and not attributes.endswith("/"):
            self.stack.append((name, len(self.pieces) - 1 if outside else None))
            self.open[name] = self.open.get(name, 0) + 1

    def end(self, name: str) -> None:
        if name == "a":
            self.link(False)
        if name in _BLOCK:
            self.end_block()
        first = None
        while self.open.get(name):
            last, first = self.stack.pop()
            self.open[last] -= 1
            if last == name:
                break
        if first is not None:
            self.end_block()
            now = len(self.pieces) - 1
            self.hidden[first] = self.hidden.get(first, 0) + 1
            self.hidden[now] = self.hidden.get(now, 0) - 1

    def blocks(self) -> list[dict]:
        out, hiding = [], 0
        for i, (pieces, linked) in enumerate(zip(self.pieces, self.links)):
            hiding += self.hidden.get(i, 0)
            text = " ".join(html.unescape("".join(pieces)).split())
            if text:
                words = max(text.count(" ") + 1, sum(1 for _ in _UNSPACED.finditer(text)) // 2)
                out.append({"text": text, "words": words, "link_words": min(linked, words), "outside": hiding > 0})
        return out


def split_blocks(page: str) -> list[dict]:
    """The blocks of a page in order: text, words, link_words, outside."""
    state, at, done, gt, unclosed = _Page(), 0, 0, -1, set()
    while m := _MARK.search(page, at):
        at = m.end()
        if m[0] == "<!--":
            end = -1 if "-->" in unclosed else page.find("-->", at)
            state.text(page[done:m.start()])
            if end < 0:
                unclosed.add("-->")
            done = at = at if end < 0 else end + 3
            continue
        if gt < at:
            gt = page.find(">", at)
        if gt < 0:  # no tag can end from here on
            break
        state.text(page[done:m.start()])
        name, attributes = (m[2] or "").lower(), page[at:gt]
        done = at = gt + 1
        if name in _RAW_END and not m[1]:
            close = None if name in unclosed else _RAW_END[name].search(page, at)
            if close:
                done = at = close.end()
            else:
                unclosed.add(name)
                done = at = len(page) if name in ("script", "style") else at
        elif name and m[1]:
            state.end(name)
        elif name:
            state.start(name, attributes)
    state.text(page[done:])
    return state.blocks()


@F.arrow_udf(BLOCKS)
def _split(pages: pa.Array) -> pa.Array:
    return pa.array([split_blocks(p.as_py()) if p.is_valid else [] for p in pages], _TYPE)


def _density(block: Column) -> Column:
    return F.coalesce(block["link_words"] / block["words"], F.lit(0.0))


def _is_content(before: Column, block: Column, after: Column) -> Column:
    words, words_before, words_after = (F.coalesce(b["words"], F.lit(0)) for b in (block, before, after))
    return (F.when(_density(block) > LINKED, False)
            .when(_density(before) > LINKED_BEFORE, (words > LONG_AFTER_LINKS) | (words_after > LONG_NEXT_AFTER_LINKS))
            .otherwise((words > LONG) | (words_after > LONG_NEXT) | (words_before > NOT_TINY)))


def page_blocks(pages: DataFrame, page: str = "html", out: str = "blocks") -> DataFrame:
    """`pages` and the blocks outside of no element, in order: text, words,
    link_words, content (whether the block is main text)."""
    x = pages.select("*", _split(F.col(page)).alias("__split"))
    x = x.select(*pages.columns, F.filter("__split", lambda b: ~b["outside"]).alias("__seen"))
    seen = F.col("__seen")
    judged = F.transform(seen, lambda b, i: F.struct(
        b["text"], b["words"], b["link_words"], _is_content(F.get(seen, i - 1), b, F.get(seen, i + 1)).alias("content")))
    return x.select(*pages.columns, judged.alias(out))


def _joined(blocks: Column, keep) -> Column:
    return F.nullif(F.array_join(F.transform(F.filter(blocks, keep), lambda b: b["text"]), "\n"), F.lit(""))


def with_block_text(pages: DataFrame, page: str = "html", out: str = "text", blocks: str = "blocks") -> DataFrame:
    """`pages` with its blocks and its main text: the content blocks, one a
    line; where no block is content, those that are not mainly links."""
    x = page_blocks(pages, page, blocks)
    b = F.col(blocks)
    return x.select("*", F.coalesce(_joined(b, lambda k: k["content"]), _joined(b, lambda k: _density(k) <= LINKED)).alias(out))
