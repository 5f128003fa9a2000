"""Quality rules with suffix-array repetition.

A text is a string over its words.  Its suffixes are sorted by prefix doubling and the longest common prefixes of
neighbours give, for each suffix, the deepest interval it lies in: the longest substring beginning there that occurs
elsewhere in the text too.  A suffix whose left neighbour in the text reaches further is not the start of a maximal
repeat; its span lies inside that of the neighbour, so the union of all spans is that of the maximal repeats.  A text
fails where the spans of repeats of at least `SHORTEST` words cover more than `MAX_COVERED` percent of its words, or
where one repeat is longer than `MAX_LONGEST` words (occurrences may overlap each other).

Each doubling sorts only the suffixes that are still tied, so a text without long repeats costs two or three sorts.
Words are compared, and suffixes ordered, by 64-bit hashes of words.  Texts are read in slices of `batches.SLICE_BYTES`,
each row's suffixes apart from the others'; time is n log^2 n in the words of a text, memory linear.  Nothing is
shuffled.

Defined results: null and empty texts, and texts of white space only, have no words and all counts 0, so they fail the
base rule of `MIN_WORDS`; rows are judged alone, so repeated rows get equal results and a null id is passed on; an empty
table gives an empty table; other input columns pass through, and those named like a new column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from covlens.llm.batches import bounded, slices
from covlens.llm.textops import Buffer, Words, mix, windows

SHORTEST = 5
MAX_COVERED = 40
MAX_LONGEST = 50
MIN_WORDS = 50
MAX_REPEAT_WORDS = 50
REPEAT_WINDOW = 3

NEW = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_covered", "longest_repeat",
       "base_failed", "kept")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_ROW = np.uint64(0x9FB21C651E98DF25)


def _keys(words: Words, row: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(first words of the windows of `width` words that lie within a row, a key per row and window)."""
    n = len(words.hash) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.flatnonzero(row[:n] == row[width - 1:])
    return at, mix(windows(words.hash, width)[at] + row[at].astype(np.uint64) * _ROW)


def _groups(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that sorts `key`, first place in that order of each element's group)."""
    order = np.argsort(key, kind="stable")
    own = key[order]
    head = np.ones(len(own), bool)
    np.not_equal(own[1:], own[:-1], out=head[1:])
    return order, np.maximum.accumulate(np.where(head, np.arange(len(own)), 0))


def _spread(at: np.ndarray, length: np.ndarray, n: int) -> np.ndarray:
    """Which of n places the spans [at, at + length) cover."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + length, -1)
    return np.cumsum(edge[:-1]) > 0


def repeated_words(words: Words, row: np.ndarray, width: int = REPEAT_WINDOW) -> np.ndarray:
    """Which words lie in a window of `width` words that the row holds twice or more."""
    at, key = _keys(words, row, width)
    order, first = _groups(key)
    size = np.bincount(first, minlength=len(first))
    again = at[order[size[first] > 1]]
    return _spread(again, np.full(len(again), width), len(row))


def suffix_array(words: Words, row: np.ndarray) -> np.ndarray:
    """The suffixes (first words) of all rows, row by row, in the order of their words' hashes."""
    n = len(row)
    last = words.row_first[row + 1]  # end of each word's row
    by_word = np.argsort(words.hash, kind="stable")
    order = by_word[np.argsort(row[by_word], kind="stable")]
    head = np.ones(n, bool)
    head[1:] = (words.hash[order[1:]] != words.hash[order[:-1]]) | (row[order[1:]] != row[order[:-1]])
    start = np.maximum.accumulate(np.where(head, np.arange(n), 0))
    rank = np.empty(n, np.int64)
    rank[order] = start
    array, h = order.copy(), 1
    size = np.bincount(start, minlength=n)
    tied = np.flatnonzero(size[start] > 1)  # places of the array that are not settled yet
    while len(tied):
        s = array[tied]
        ahead = s + h
        key = np.where(ahead < last[s], rank[np.minimum(ahead, n - 1)], -1)  # a suffix that ends comes first
        group = rank[s]
        o = np.lexsort((key, group))
        s, key = s[o], key[o]
        array[tied] = s  # groups keep their places, in their order
        head = np.ones(len(s), bool)
        head[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        first = np.maximum.accumulate(np.where(head, np.arange(len(s)), 0))
        rank[s] = tied[first]
        tied = tied[np.bincount(first, minlength=len(s))[first] > 1]
        h *= 2
    return array


def suffix_repeats(words: Words, row: np.ndarray, shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray]:
    """(first words, lengths) of the longest repeat of at least `shortest` words that begins at each word."""
    n = len(row)
    array = suffix_array(words, row)
    at, key = _keys(words, row, shortest)
    begins = np.zeros(n, np.uint64)
    begins[at] = key | np.uint64(1)
    # Neighbours that share `shortest` words and more, and which neighbour.
    joined = np.flatnonzero((begins[array[1:]] == begins[array[:-1]]) & (begins[array[1:]] != 0)) + 1
    before = np.full(n, -1, np.int64)
    before[array[joined]] = array[joined - 1]
    # Common prefixes in the order of the text: that of the next suffix is at most one word shorter.
    common = np.zeros(n, np.int64)
    ends = words.row_first[row + 1]
    held, previous = 0, -2
    for i in np.sort(array[joined]).tolist():
        j = int(before[i])
        held = max(shortest, held - 1) if i == previous + 1 else shortest
        held = _extend(words.hash, i, j, held, min(int(ends[i]) - i, int(ends[j]) - j))
        common[i], previous = held, i
    longest = common.copy()
    np.maximum.at(longest, before[array[joined]], common[array[joined]])
    some = np.flatnonzero(longest)
    return some, longest[some]


def _extend(h: np.ndarray, i: int, j: int, held: int, most: int) -> int:
    """Length of the common prefix of the suffixes i and j, `held` words of which are known to agree."""
    if held >= most or h[i + held] != h[j + held]:
        return held
    step = 16
    while held < most:
        end = min(held + step, most)
        differ = np.flatnonzero(h[i + held:i + end] != h[j + held:j + end])
        if len(differ):
            return held + int(differ[0])
        held, step = end, step * 2
    return held


def _dup_lines(text: bytes | None) -> int:
    seen, again = set(), 0
    for line in (text or b"").split(b"\n"):
        if line.strip(b" \t\n\x0b\x0c\r"):
            again += line in seen
            seen.add(line)
    return again


def measure(texts: pa.Array, shortest: int = SHORTEST) -> list[np.ndarray]:
    """The counts of `NEW`, n_words to longest_repeat, for each text."""
    buffer = Buffer(texts, lower=False)
    words = Words(buffer)
    per_row = np.diff(words.row_first)
    n_rows, n = len(per_row), len(words.hash)
    row = np.repeat(np.arange(n_rows), per_row)
    b = buffer.bytes

    def between_rows(mark: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mark, dtype=np.int64)])
        return total[buffer.row_start[1:] - 1] - total[buffer.row_start[:-1]]

    chars, symbols = between_rows(~_SPACE[b] & ((b & 0xC0) != 0x80)), between_rows(_SYMBOL[b])
    raw = texts.cast(pa.binary()).to_pylist()
    dup = np.array([_dup_lines(t) for t in raw], np.int64)
    again = np.bincount(row, repeated_words(words, row), n_rows) if n else np.zeros(n_rows)
    covered, longest = np.zeros(n_rows, np.int64), np.zeros(n_rows, np.int64)
    if n:
        at, length = suffix_repeats(words, row, shortest)
        if len(at):
            covered = np.bincount(row, _spread(at, length, n), n_rows).astype(np.int64)
            np.maximum.at(longest, row[at], length)
    return [per_row.astype(np.int64), chars, symbols, dup, again.astype(np.int64), covered, longest]


def judge(docs: DataFrame, text: str = "text", shortest: int = SHORTEST, max_covered: int = MAX_COVERED,
          max_longest: int = MAX_LONGEST) -> DataFrame:
    """`docs` with the counts, `base_failed` and `kept`."""
    bounded(docs.sparkSession)
    keep = [c for c in docs.columns if c not in NEW]
    plain = docs.select(*[docs[c] for c in keep])
    where = keep.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, batch.schema.names[where]):
                counts = measure(part.column(where), shortest)
                n, again, covered, longest = counts[0], counts[4], counts[5], counts[6]
                failed = (n < MIN_WORDS) | (100 * again > MAX_REPEAT_WORDS * n)
                kept = ~failed & (100 * covered <= max_covered * n) & (longest <= max_longest)
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(c) for c in counts), pa.array(failed), pa.array(kept)],
                                                 [*part.schema.names, *NEW])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema.fields)
    return plain.mapInArrow(run, schema + "".join(f", {c} bigint" for c in NEW[:7]) + ", base_failed boolean, kept boolean")
