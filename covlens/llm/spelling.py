"""Spelling variants by search schemes over an FM-index.

1. Words: maximal runs `[A-Za-z\\u00C0-\\u00FF]+` of the whole texts, A-Z lower-cased; where 199 divides the crc32 h of
   `<doc_id>:<run>` the run's code point h % length is left out.  Words of at least `SHORTEST` code points are counted
   per slice of texts, then by Spark with partial aggregation; those with `MIN_COUNT` occurrences are the vocabulary.
2. Two words one error apart (a code point inserted, deleted or replaced) agree on one half of either: the error lies in
   the second half or in the first.  The search scheme has one search for each case.  The first matches the first half
   exactly, left to right, and extends across the second, allowing one error; the other does the same from the right.
   A pattern is a pair of suffix ranks in an FM-index over the delimited words, and both ends are delimiters, so what is
   found is a whole word.  Extension to the left runs in the index of the text, extension to the right in that of the
   reversed text; a search turns once only, at the middle it starts from, so each keeps the interval of the direction
   that it extends in.
3. The vocabulary is dealt to tasks twice: by the first `EDGE` code points for the first search, by the last for the
   second, for these lie in the half that is matched exactly.  A cell beyond `CELL_WORDS` words is dealt on into
   parts, each indexed apart, and its queries visit every part, so no index exceeds about `CELL_WORDS` words and a
   frequent beginning is no single task.  A pair that both searches could find is counted by the first.
4. A word's form is its near word of largest count (ties: smallest), if that is `RATIO` times its own; forms are followed
   to the last by pointer doubling.  Counts grow by `RATIO` with each step, so a chain is short.

Defined results: null and empty texts hold no words; a null doc_id counts as an empty one in the crc32; repeated rows
count each; a word without near words has n_near 0 and no form; an empty table gives an empty table; columns other than
the two named are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covlens.llm.batches import bounded, slices
from covlens.llm.store import written
from covlens.llm.textops import Buffer

SHORTEST = 6
MIN_COUNT = 5
RATIO = 5
DROPPED = 199
EDGE = SHORTEST // 2  # code points of the shorter half of the shortest word
CELL_WORDS = 1 << 14
_LONG_RUN = 64


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


_CRC = _crc_table()


def run_crcs(b: np.ndarray, start: np.ndarray, length: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """crc32 of each run of bytes, continued from `seed`, the crc32 of what stands before it."""
    state = seed.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    order = np.argsort(-np.minimum(length, _LONG_RUN + 1), kind="stable")
    order = order[np.searchsorted(-length[order], -_LONG_RUN, "left"):] if len(order) else order
    for k in range(int(length[order[0]]) if len(order) else 0):
        order = order[:np.searchsorted(-length[order], -k, "left")]
        state[order] = _CRC[(state[order] ^ b[start[order] + k]) & 0xFF] ^ (state[order] >> np.uint32(8))
    out = state ^ np.uint32(0xFFFFFFFF)
    for i in np.flatnonzero(length > _LONG_RUN).tolist():
        out[i] = zlib.crc32(b[start[i]:start[i] + length[i]].tobytes(), int(seed[i]))
    return out


def slice_words(texts: pa.Array, ids: list[int | None], shortest: int = SHORTEST) -> tuple[list[str], list[int]]:
    """(words, occurrences) of some texts."""
    buffer = Buffer(texts)
    b = buffer.bytes
    lead = b == 0xC3
    inside = (b >= 97) & (b <= 122) | lead
    inside[1:] |= lead[:-1]
    edge = np.diff(inside.view(np.int8))
    start, end = np.flatnonzero(edge == 1) + 1, np.flatnonzero(edge == -1) + 1
    begun = np.cumsum((b & 0xC0) != 0x80, dtype=np.int32)  # code points up to each byte
    size = begun[end - 1] - begun[start - 1]
    long = size >= shortest
    start, end, size = start[long], end[long], size[long]
    if not len(start):
        return [], []
    row = np.searchsorted(buffer.row_start, start, side="right") - 1
    seed = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    crc = run_crcs(b, start, end - start, seed[row])
    changed = crc % DROPPED == 0
    same = ~changed
    # The unchanged runs end to end, as an Arrow column without a Python object per run.
    own = (end - start)[same]
    offset = np.concatenate([[0], np.cumsum(own)])
    data = b[np.repeat(start[same] - offset[:-1], own) + np.arange(offset[-1])]
    column = pa.StringArray.from_buffers(len(own), pa.py_buffer(offset.astype(np.int32)), pa.py_buffer(data))
    counts = column.value_counts()
    words, n = counts.field("values").to_pylist(), counts.field("counts").to_pylist()
    for s, e, h in zip(start[changed].tolist(), end[changed].tolist(), crc[changed].tolist()):
        run = b[s:e].tobytes().decode()
        at = h % len(run)
        if len(run) > shortest:
            words.append(run[:at] + run[at + 1:])
            n.append(1)
    return words, n


def vocabulary(docs: DataFrame, key: str = "doc_id", text: str = "text", shortest: int = SHORTEST,
               min_count: int = MIN_COUNT) -> DataFrame:
    """`word`, `n`: the words with their occurrences."""
    bounded(docs.sparkSession)
    rows = docs.select(docs[key].alias("_key"), docs[text].alias("_text")).where(F.col("_text").isNotNull())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                words, n = slice_words(part.column("_text"), part.column("_key").to_pylist(), shortest)
                yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], ["word", "n"])

    return rows.mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


class FMIndex:
    """FM-index over `words` (rows of code points, `at[i]:at[i + 1]`), each followed by a delimiter (code 0).  The
    delimiters rank by the words' order and come first, so rows 0 to len(words) are the empty pattern at a word's end."""

    def __init__(self, codes: np.ndarray, at: np.ndarray):
        n_words = len(at) - 1
        size = np.diff(at)
        self.n = n = len(codes) + n_words
        place = np.arange(len(codes)) + np.repeat(np.arange(n_words), size)
        text = np.zeros(n, np.int64)
        text[place] = codes
        ends = at[1:] + np.arange(n_words)
        word_of = np.repeat(np.arange(n_words), size + 1)
        # Suffixes up to their delimiter by prefix doubling; delimiters differ, so all are settled at the longest word.
        rank, h, head = np.where(text > 0, text + n_words, word_of), 0, np.zeros(1, bool)
        while not head.all():
            ahead = rank[np.minimum(np.arange(n) + h, n - 1)] if h else np.zeros(n, np.int64)
            order = np.argsort(rank * (int(rank.max()) + 1) + ahead, kind="stable")
            a, c = rank[order], ahead[order]
            head = np.ones(n, bool)
            head[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
            rank = np.empty(n, np.int64)
            rank[order] = np.cumsum(head) - 1
            h = max(1, 2 * h)
        self.word_at = word_of[order]  # the word of each suffix rank
        self.bwt = text[order - 1]  # the text is read as a ring: before its beginning stands a delimiter
        self.step = int(text.max(initial=0)) + 1
        # (symbol, rank) pairs in order: the rank of symbol c before row i is one binary search in them.
        by_symbol = np.argsort(self.bwt, kind="stable")
        self.pairs = self.bwt[by_symbol] * (n + 1) + by_symbol
        self.n_words = n_words

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the patterns with `symbol` in front."""
        base = symbol * (self.n + 1)
        return np.searchsorted(self.pairs, base + lo), np.searchsorted(self.pairs, base + hi)

    def letters(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern number, symbol) of every extension by a letter that occurs.  Patterns of one length overlap only
        where they are equal; each is read once, so this takes no more than the index's size."""
        first, own, back = np.unique(lo, return_index=True, return_inverse=True)
        size = hi[own] - first
        owner = np.repeat(np.arange(len(first)), size)
        pick = np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())
        both = np.unique(owner * self.step + self.bwt[pick])
        both = both[both % self.step > 0]
        begin = np.searchsorted(both, np.arange(len(first) + 1) * self.step)
        n = np.diff(begin)[back]
        at = np.repeat(begin[back] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(np.arange(len(lo)), n), both[at] % self.step

    def whole(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pattern number, word) where the pattern is a whole word: a delimiter stands before it."""
        a, b = self.extend(np.zeros(len(lo), np.int64), lo, hi)
        owner = np.repeat(np.arange(len(lo)), b - a)
        pick = np.repeat(a - (np.cumsum(b - a) - (b - a)), b - a) + np.arange((b - a).sum())
        return owner, self.word_at[self.pairs[pick] % (self.n + 1)]


def near(index: FMIndex, codes: np.ndarray, at: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(query, word of the index) for all words one error away from a query, the error beyond the query's `exact` last
    code points; the query itself where it is indexed and holds equal neighbours.  Queries are read from their ends, all
    of them a code point at a time."""
    size = np.diff(at)
    none = np.zeros(0, np.int64)
    q = np.arange(len(size))  # patterns without an error: query, ranks
    lo, hi = np.zeros(len(size), np.int64), np.full(len(size), index.n_words, np.int64)
    late = [(none, none, none)]  # patterns with the error behind them
    found = [(none, none)]
    for j in range(int(size.max(initial=-1)) + 1):
        alive = (hi > lo) & (j <= size[q])
        q, lo, hi = q[alive], lo[alive], hi[alive]
        here = np.where(j < size[q], codes[np.maximum(at[q] + size[q] - 1 - j, 0)], -1)
        open_ = j >= exact[q]
        then = []
        if open_.any():
            oq, oh, ol, oe = q[open_], here[open_], lo[open_], hi[open_]
            owner, symbol = index.letters(ol, oe)
            a, b = index.extend(symbol, ol[owner], oe[owner])
            late.append((oq[owner], a, b))  # a code point that the query lacks
            other = (symbol != oh[owner]) & (oh[owner] >= 0)
            then.append((oq[owner][other], a[other], b[other]))  # another code point
            some = oh >= 0
            then.append((oq[some], ol[some], oe[some]))  # a code point left out
        lq, ll, lh = (np.concatenate(x) for x in zip(*late))
        _, one = np.unique((lq * (index.n + 1) + ll) * (index.n + 1) + lh, return_index=True)
        lq, ll, lh = lq[one], ll[one], lh[one]
        done = size[lq] == j
        if done.any():
            owner, word = index.whole(ll[done], lh[done])
            found.append((lq[done][owner], word))
        lq, ll, lh = lq[~done], ll[~done], lh[~done]
        ll, lh = index.extend(codes[at[lq] + size[lq] - 1 - j], ll, lh)
        alive = lh > ll
        late = [(lq[alive], ll[alive], lh[alive]), *then]
        more = here >= 0
        q, (lo, hi) = q[more], index.extend(here[more], lo[more], hi[more])
    q, word = (np.concatenate(x) for x in zip(*found))
    pairs = np.unique(q * (index.n_words + 1) + word)
    return pairs // (index.n_words + 1), pairs % (index.n_words + 1)


def _codes(words: list[str], backwards: bool) -> tuple[np.ndarray, np.ndarray]:
    text = "".join(w[::-1] for w in words) if backwards else "".join(words)
    return (np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64),
            np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)]))


class _Cell:
    """One indexed part of a cell: its words come first, then the other queries."""

    def __init__(self, side: int):
        self.side, self.words, self.n, self.index = side, [], [], None

    def add(self, words: list[str], n: list[int]) -> None:
        self.words += words
        self.n += n

    def search(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.index is None:
            self.index = FMIndex(*_codes(self.words, self.side == 0))
        codes, at = _codes(queries, self.side == 0)
        size = np.diff(at)
        return near(self.index, codes, at, size // 2 if self.side == 0 else size - size // 2)

    def answers(self, queries: list[str]) -> Iterator[pa.RecordBatch]:
        """(word, near words, largest count among them, the smallest word that has it), a bounded number at a time."""
        for lo in range(0, len(queries), 4096):
            some = queries[lo:lo + 4096]
            best: dict[int, list] = {}
            for i, k in zip(*(x.tolist() for x in self.search(some))):
                w, v = some[i], self.words[k]
                half = len(w) // 2
                if w == v or self.side and w[:half] == v[:half]:
                    continue  # the other search finds it
                entry = best.setdefault(i, [0, 0, ""])
                entry[0] += 1
                if self.n[k] > entry[1] or self.n[k] == entry[1] and v < entry[2]:
                    entry[1:] = self.n[k], v
            if best:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([some[i] for i in best]), *(pa.array([e[f] for e in best.values()], t) for f, t in
                                                          enumerate((pa.int64(), pa.int64(), pa.string())))],
                    ["word", "n_near", "form_n", "form"])


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells come in sequence, each with its members first."""
    now, cell = None, None

    def close() -> Iterator[pa.RecordBatch]:
        if cell is not None and cell.index is None:
            yield from cell.answers(cell.words)

    for batch in batches:
        t = pa.Table.from_batches([batch])
        side, number, part = (t.column(c).to_numpy() for c in ("side", "cell", "part"))
        member = t.column("member").to_numpy()
        edge = np.ones(t.num_rows, bool)
        edge[1:] = (side[1:] != side[:-1]) | (number[1:] != number[:-1]) | (part[1:] != part[:-1]) | (member[1:] != member[:-1])
        at = np.append(np.flatnonzero(edge), t.num_rows).tolist()
        for s, e in zip(at[:-1], at[1:]):
            key = (int(side[s]), int(number[s]), int(part[s]))
            if key != now:
                yield from close()
                now, cell = key, _Cell(key[0])
            words = t.column("word").slice(s, e - s).to_pylist()
            if member[s]:
                cell.add(words, t.column("n").slice(s, e - s).to_pylist())
            else:
                if cell.index is None:
                    yield from cell.answers(cell.words)
                if cell.words:
                    yield from cell.answers(words)
    yield from close()


def near_words(words: DataFrame, cell_words: int = CELL_WORDS) -> DataFrame:
    """`word`, `n_near`, `form_n`, `form` (of the near word with the largest count) of the words that have near words."""
    cells = max(1, -(-words.count() // cell_words))
    edges = F.array(F.struct(F.lit(0).alias("side"), F.left("word", F.lit(EDGE)).alias("edge")),
                    F.struct(F.lit(1).alias("side"), F.right("word", F.lit(EDGE)).alias("edge")))
    dealt = words.select("word", "n", F.explode(edges).alias("e")).select(
        "word", "n", "e.side", F.pmod(F.xxhash64("e.edge"), F.lit(cells)).cast("int").alias("cell"))
    sizes = dealt.groupBy("side", "cell").agg(F.ceil(F.count("*") / (2 * cell_words)).cast("int").alias("parts"))
    spread = (dealt.join(sizes, ["side", "cell"])
              .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
              .withColumn("member", F.pmod(F.xxhash64("word"), F.col("parts")) == F.col("part")))
    # As many tasks as cells: the rows are few for the work in them.
    return (spread.repartition(4 * cells, "side", "cell", "part").sortWithinPartitions("side", "cell", "part", F.desc("member"))
            .select("side", "cell", "part", F.col("member").cast("int").alias("member"), "word", "n")
            .mapInArrow(_searched, "word string, n_near bigint, form_n bigint, form string")
            .groupBy("word").agg(F.sum("n_near").alias("n_near"),
                                 F.min(F.struct((-F.col("form_n")).alias("m"), "form")).alias("b"))
            .select("word", "n_near", (-F.col("b.m")).alias("form_n"), F.col("b.form").alias("form")))


def variants(docs: DataFrame, key: str = "doc_id", text: str = "text", ratio: int = RATIO,
             cell_words: int = CELL_WORDS) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    words = written(vocabulary(docs, key, text), "vocabulary")
    known = words.join(near_words(words, cell_words), "word", "left")
    fits = F.col("form_n") >= ratio * F.col("n")
    table = written(known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                                 F.when(fits, F.col("form")).alias("form"), F.when(fits, F.col("form_n")).alias("form_n")), "forms")
    # Pointer doubling over the words that have a form; a pointer to a word without one is final.
    up = table.where("form is not null").select("word", F.col("form").alias("to"))
    while True:
        step = up.select(F.col("word").alias("to"), F.col("to").alias("next"))
        further = written(up.join(step, "to", "left").select("word", F.coalesce("next", "to").alias("to"),
                                                            F.col("next").isNotNull().alias("moved")), "roots")
        up = further.select("word", "to")
        if further.where("moved").isEmpty():
            break
    return (table.join(up, "word", "left")
            .select("word", "form", F.coalesce("to", "word").alias("root"), "n", "n_near", "form_n"))
