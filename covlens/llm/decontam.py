"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over consecutive words: its hash reads the words at the mask's set positions and ignores the
others, so a passage of a benchmark item still meets a seed of the item where some of its words were replaced.  Every
window of every training text is hashed under every mask and joined with the benchmark's hashes; around each hit the
text and the item are compared word by word on the hit's diagonal, and the best stretch (matches +1, mismatches -1) is
an overlap if it holds enough matching words.  A text that holds an item several times has an overlap for each place;
of stretches of one item that share words of the text, the one with most matching words counts.

The masks together meet every passage of 15 words with up to 2 replaced words and 98.7 % of those with 3.  Words are
runs of letters and digits, A-Z lower-cased, so punctuation does not hide a passage.

The benchmark's side is dealt into blocks of at most `BLOCK_WORDS` words, whose sorted hashes are broadcast; the join
is a lookup where the texts lie.  A benchmark beyond one block takes one more pass over the texts per block, so no
broadcast grows with the data, and the texts are never shuffled.

Defined results: null and empty texts overlap with nothing; items with fewer than `SHORTEST` words are left out, items
shorter than the shortest mask are met only by an exact copy; repeated rows each get their rows; items with equal words
count as one, under the smallest item_id; an empty benchmark or an empty table gives no overlaps.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from covlens.llm.batches import bounded, slices
from covlens.llm.textops import Buffer, Words, mix

#: Set positions of each mask.
MASKS = ((0, 1, 3, 5, 6, 7), (0, 1, 3, 5, 6, 8), (0, 2, 3, 8, 9, 10), (0, 1, 2, 5, 8, 10))
SHORTEST = 5
ENOUGH = 10  # matching words of an overlap; of a shorter item, the share below of its words
SHARE = 0.8
IDENTITY = 0.7
BLOCK_WORDS = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _short_masks() -> list[tuple[int, ...]]:
    return [tuple(range(n)) for n in range(SHORTEST, 1 + max(MASKS[0]))]


def seed_hashes(words: np.ndarray, mask: tuple[int, ...], number: int) -> np.ndarray:
    """Hash of the mask at every position where it fits."""
    n = len(words) - mask[-1]
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, number + 1, np.uint64)
    for p in mask:
        out *= _BASE
        out += words[p:p + n]
    return mix(out)


class Seeds:
    """The benchmark's side of the join for one block of items (a list of word-hash arrays)."""

    def __init__(self, ids: list[int], items: list[np.ndarray]):
        self.ids, self.items = ids, items
        self.masks = [(m, i, None) for i, m in enumerate(MASKS)]
        self.masks += [(m, len(MASKS) + i, len(m)) for i, m in enumerate(_short_masks())
                       if any(len(x) == len(m) for x in items)]
        self.tables = []
        for mask, number, only in self.masks:
            found = [(seed_hashes(x, mask, number), k) for k, x in enumerate(items) if only is None or len(x) == only]
            h = np.concatenate([f for f, _ in found]) if found else np.zeros(0, np.uint64)
            item = np.concatenate([np.full(len(f), k) for f, k in found]) if found else np.zeros(0, int)
            offset = np.concatenate([np.arange(len(f)) for f, _ in found]) if found else np.zeros(0, int)
            order = np.argsort(h, kind="stable")
            near = np.zeros(1 << 20, bool)  # rules out most windows before the exact search
            near[(h >> np.uint64(44)).astype(np.int64)] = True
            self.tables.append((h[order], item[order].astype(np.int32), offset[order].astype(np.int32), near))

    def diagonals(self, words: Words) -> np.ndarray:
        """Distinct (row, item, word of the row at which the item would begin) of all hits."""
        out = []
        for (mask, number, _), (known, item, offset, near) in zip(self.masks, self.tables):
            h = seed_hashes(words.hash, mask, number)
            at = np.flatnonzero(near[(h >> np.uint64(44)).astype(np.int64)])
            first = np.searchsorted(known, h[at], "left")
            count = np.searchsorted(known, h[at], "right") - first
            row = np.searchsorted(words.row_first, at, "right") - 1
            inside = (count > 0) & (at + mask[-1] < words.row_first[row + 1])
            at, row, first, count = at[inside], row[inside], first[inside], count[inside]
            if not len(at):
                continue
            pick = np.repeat(first - (np.cumsum(count) - count), count) + np.arange(count.sum())
            out.append(np.stack([np.repeat(row, count), item[pick],
                                 np.repeat(at - words.row_first[row], count) - offset[pick]], 1))
        return np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 3), np.int64)

    def overlaps(self, texts: pa.Array) -> Iterator[tuple[int, int, int, int, int, int]]:
        """(row, item id, first and end word in the row, first word in the item, matching words) of each verified
        overlap: per row and item the ones with most matching words that share no word of the row."""
        words = Words(Buffer(texts), plain=True)
        found: dict[tuple[int, int], list[tuple]] = {}
        for row, k, begin in self.diagonals(words):
            item, low, high = self.items[k], words.row_first[row], words.row_first[row + 1]
            a, b = max(0, -begin), min(len(item), high - low - begin)
            same = words.hash[low + begin + a:low + begin + b] == item[a:b]
            total = np.concatenate([[0], np.cumsum(np.where(same, 1, -1))])
            gain = total - np.minimum.accumulate(total)
            end = int(gain.argmax())
            start = int(total[:end + 1].argmin())
            matching = int(same[start:end].sum())
            need = min(ENOUGH, int(np.ceil(SHARE * len(item))))
            if matching >= need and matching >= IDENTITY * (end - start):
                found.setdefault((int(row), int(k)), []).append(
                    (matching, -int(begin), int(begin + a + start), int(begin + a + end), int(a + start)))
        for (row, k), stretches in sorted(found.items()):
            for matching, start, end, inside in _apart(stretches):
                yield row, self.ids[k], start, end, inside, matching


def _apart(stretches: list[tuple[int, int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """(matching, start, end, first word in the item) of the best stretches that do not share words, by start."""
    taken: list[tuple[int, int, int, int]] = []
    for matching, _, start, end, inside in sorted(stretches, reverse=True):
        i = bisect.bisect(taken, start, key=lambda t: t[1])
        if (i == 0 or taken[i - 1][2] <= start) and (i == len(taken) or end <= taken[i][1]):
            taken.insert(i, (matching, start, end, inside))
    return taken


def blocks(benchmark: DataFrame, key: str = "item_id", text: str = "text",
           block_words: int = BLOCK_WORDS) -> Iterator[Seeds]:
    """The benchmark in blocks of bounded size, read through one partition at a time."""
    seen: dict[bytes, int] = {}
    ids, items, held = [], [], 0
    rows = (benchmark.where(benchmark[text].isNotNull() & benchmark[key].isNotNull())
            .select(benchmark[key].cast("bigint").alias("k"), benchmark[text].alias("t")).orderBy("k", "t"))
    for r in rows.toLocalIterator():
        words = Words(Buffer(pa.array([r["t"]])), plain=True).hash
        if len(words) < SHORTEST or words.tobytes() in seen:
            continue
        if held and held + len(words) > block_words:
            yield Seeds(ids, items)
            seen, ids, items, held = {}, [], [], 0
        seen[words.tobytes()] = r["k"]
        ids.append(r["k"])
        items.append(words)
        held += len(words)
    if items:
        yield Seeds(ids, items)


def find_overlaps(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per place at which a training row and a benchmark item overlap: key, item_id, doc_start and doc_end (word numbers, end
    exclusive), item_start, matched (words that agree)."""
    bounded(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, item_id bigint, doc_start bigint, doc_end bigint, item_start bigint, matched bigint"
    rows = docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
    out = None
    for seeds in blocks(benchmark, item_key, item_text, block_words):
        part = rows.mapInArrow(_overlap_rows(docs.sparkSession.sparkContext.broadcast(seeds), key), schema)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def _overlap_rows(shipped, key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                found = [*shipped.value.overlaps(part.column("_text"))]
                if found:
                    row, *rest = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("_key").take(pa.array(row)), *(pa.array(c, pa.int64()) for c in rest)],
                        [key, "item_id", "doc_start", "doc_end", "item_start", "matched"])
    return run


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_key: str = "item_id",
          item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of `docs`, with all their columns, that overlap with no item."""
    where = docs.columns.index(text)
    bounded(docs.sparkSession)

    def without(shipped):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, batch.schema.names[where]):
                    keep = np.ones(part.num_rows, bool)
                    keep[[f[0] for f in shipped.value.overlaps(part.column(where))]] = False
                    yield part.filter(pa.array(keep))
        return run

    out = docs
    for seeds in blocks(benchmark, item_key, item_text, block_words):
        out = out.mapInArrow(without(docs.sparkSession.sparkContext.broadcast(seeds)), docs.schema)
    return out
