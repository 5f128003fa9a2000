"""Line deduplication with a log-template tree.

Lines are parsed like log messages, by a tree of fixed depth: the first level is the line's token count, the next ones
its `LEAD` leading tokens, and a leaf holds the templates of the remaining tokens.  Variable fields generalise in two
ways: tokens that look variable (with a digit, an `@` or `://`) become `<*>` anywhere in the line; and in lines of at
least `LONG` tokens one of the `SEGMENTS` stretches of the remaining tokens may differ, so a line belongs to its exact
template and to one template per stretch left open.  Lines of fewer than `SHORTEST` tokens have only the template of their
literal tokens.  The tree's nodes are addressed by hashes of their paths, so the
tree is a table, not one task's memory, and the result does not depend on the order of the lines.

A template recurs if its lines stand in at least `min_docs` groups of near-copy texts; from `PASSAGE` literal words on,
where a template is no chance repeat, in `PASSAGE_DOCS`.  Words are tokens here, or half the characters where the tokens
average over `UNSPACED` characters (scripts without spaces).  Templates that too few different texts hold are out at
once; the groups are those of `minhash.near_duplicates` among the texts that hold one of the others.  So copies do not
make their own lines recurring, and every line of a recurring template is dropped in every text.

Every text is parsed once; what is kept of it are 16 bytes per line and template, counted with map-side partial
aggregation, so a line in a third of all documents is a single row per task.  Only texts that hold a recurring template
are read in Python again.  The hashes of the recurring templates and of those texts are broadcast while they are few
(`max_broadcast_bytes`, counted first); beyond that they are joined with the lines and the texts.  Likewise the groups
of two and more texts (16 bytes a text).

Defined results: null text stays null and has no lines; empty text has one empty line; lines without tokens are kept;
repeated rows are treated alike; an empty table gives an empty table; other columns pass through, whatever their names,
but input columns named like a new one are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from covlens.llm import minhash
from covlens.llm.batches import bounded, slices
from covlens.llm.store import written
from covlens.llm.textops import Buffer, Words, mix, powers

LEAD = 2
SEGMENTS = 3
LONG = 12
SHORTEST = 3
MIN_DOCS = 5
PASSAGE = 30
PASSAGE_DOCS = 2
UNSPACED = 16
MAX_BROADCAST_BYTES = 32 << 20
_STAR = np.uint64(0x2545F4914F6CDD1D)
_VARIABLE = np.zeros(256, bool)
_VARIABLE[list(b"0123456789@:")] = True  # a colon only before `//`


def _passage(tokens: np.ndarray, characters: np.ndarray) -> np.ndarray:
    """Whether a template of so many literal tokens and characters in them is long enough to be no chance repeat."""
    return np.where(characters > UNSPACED * tokens, np.maximum(characters // 2, tokens), tokens) >= PASSAGE


class Lines:
    """The non-blank lines of a buffer: row, line number in the row, token count, and template hashes (one column for
    the exact template and one per open stretch; 0 where there is none; odd ones are those of passages).  Without
    `passages` all of them are even: the template alone decides whether it is a passage's, so known ones are found
    without that."""

    def __init__(self, texts: pa.Array, passages: bool = True):
        buffer = Buffer(texts)
        b, words = buffer.bytes, Words(buffer)
        ends = np.flatnonzero(b == 10)  # the separators are line ends too
        line = np.searchsorted(ends, words.start)  # of each word
        first = np.flatnonzero(np.diff(line, prepend=-1))  # first word of each non-blank line
        self.tokens = np.diff(first, append=len(line))
        self.row = np.searchsorted(buffer.row_start, words.start[first], side="right") - 1
        line_of_row = np.searchsorted(ends, buffer.row_start[:-1])
        self.number = line[first] - line_of_row[self.row]
        self.lines_of_row = np.diff(np.append(line_of_row, len(ends)))
        # Only the few bytes that make a word variable are placed in their words.
        odd = np.flatnonzero(_VARIABLE[b])
        odd = odd[(b[odd] != 58) | (b[np.minimum(odd + 1, len(b) - 1)] == 47) & (b[np.minimum(odd + 2, len(b) - 1)] == 47)]
        masked = np.zeros(len(line), bool)
        masked[np.searchsorted(words.start, odd, side="right") - 1] = True
        masked &= np.repeat(self.tokens >= SHORTEST, self.tokens)
        h = np.where(masked, _STAR, words.hash)
        self.keys = np.zeros((len(first), 1 + SEGMENTS), np.uint64)
        if not len(first):
            return
        h = mix(h + powers(int(self.tokens.max()))[np.arange(len(line)) - np.repeat(first, self.tokens)])
        count, long = self.tokens.astype(np.uint64), self.tokens >= LONG
        # Where the stretches of each line begin and end; lines that are not long have none.
        rest = np.maximum(self.tokens - LEAD, 0)[:, None]
        edge = np.minimum(first[:, None] + LEAD - (-np.arange(SEGMENTS + 1) * rest // SEGMENTS), len(line))

        def sums(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Over each line, over each of its stretches."""
            upto = np.zeros(len(x) + 1, x.dtype)
            np.cumsum(x, out=upto[1:])
            return upto[first + self.tokens] - upto[first], np.diff(upto[edge], axis=1)

        total, part = sums(h)
        self.keys[:, 0] = mix(total + count * _STAR)
        for s in range(SEGMENTS):
            self.keys[:, 1 + s] = np.where(long, mix(total - part[:, s] + (count * np.uint64(8) + np.uint64(s + 1)) * _STAR), 0)
        self.keys &= ~np.uint64(1)
        if not passages:
            return
        # Characters are the bytes that continue none.
        continued = np.bincount(np.searchsorted(words.start, np.flatnonzero((b & 0xC0) == 0x80), side="right") - 1, minlength=len(line))
        literal, of_part = sums((~masked).astype(np.int64))
        characters, in_part = sums(np.where(masked, 0, words.end - words.start - continued))
        passage = np.zeros(self.keys.shape, np.uint64)
        passage[:, 0] = _passage(literal, characters)
        passage[:, 1:] = _passage(literal[:, None] - of_part, characters[:, None] - in_part)
        self.keys = np.where(self.keys, self.keys | passage, 0)


def _template_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(template hash, hash of the text or of its group), once per text."""
    for batch in batches:
        for part in slices(batch, "_text"):
            lines = Lines(part.column("_text"))
            some = np.flatnonzero(lines.keys)
            key, row = lines.keys.ravel()[some], lines.row[some // (1 + SEGMENTS)]
            order = np.argsort(key, kind="stable")  # a text's lines of one template stand in sequence then
            again = (np.diff(key[order], prepend=0) == 0) & (np.diff(row[order], prepend=-1) == 0)
            once = np.sort(order[~again])
            text = part.column("_fp").to_numpy(zero_copy_only=False)[row[once]]
            yield pa.RecordBatch.from_arrays([pa.array(key[once].view(np.int64)), pa.array(text)], ["key", "fp"])


NEW = ("n_lines", "n_recurring", "dropped")


def _texts(docs: DataFrame, text: str) -> DataFrame:
    return docs.where(docs[text].isNotNull()).select(docs[text].alias("_text"), F.xxhash64(docs[text]).alias("_fp"))


def _few(df: DataFrame, row_bytes: int, max_broadcast_bytes: int) -> DataFrame:
    return F.broadcast(df) if df.count() * row_bytes <= max_broadcast_bytes else df


def recurring_templates(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS,
                        max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """(`key`: hashes of the recurring templates, `_fp`: hashes of the texts that hold one of them)."""
    texts = _texts(docs, text)
    needed = F.when(F.col("key").bitwiseAND(1) == 1, min(min_docs, PASSAGE_DOCS)).otherwise(min_docs)

    def enough(rows: DataFrame, n: Column) -> DataFrame:
        return rows.groupBy("key").agg(n.alias("n")).where(F.col("n") >= needed).select("key")

    rows = written(texts.mapInArrow(_template_rows, "key bigint, fp bigint"), "templates")
    # A template has no more texts than rows, so only those with enough rows are counted by texts.
    often = written(enough(rows, F.count("*")), "often")
    some = written(rows.join(_few(often, 8, max_broadcast_bytes), "key", "left_semi").distinct(), "often-held")
    wanted = written(enough(some, F.count("*")), "candidates")
    held = written(some.join(_few(wanted, 8, max_broadcast_bytes), "key", "left_semi"), "held")
    some = written(held.select(F.col("fp").alias("_fp")).distinct(), "holders")
    if some.count() * 8 <= max_broadcast_bytes:
        copied = texts.join(F.broadcast(some), "_fp", "left_semi")
    else:  # read more than once below, so joined once
        copied = written(texts.join(some, "_fp", "left_semi"), "held-texts")
    found = minhash.near_duplicates(copied, "_fp", "_text")
    groups = written(found.where("doc_id <> component_id").select(F.col("doc_id").alias("fp"), F.col("component_id").alias("group"))
                     .distinct(), "groups")
    grouped = held.join(_few(groups, 16, max_broadcast_bytes), "fp", "left").select("key", F.coalesce("group", "fp").alias("group"))
    keys = written(enough(grouped, F.count_distinct("group")), "recurring")
    marked = held.join(_few(keys, 8, max_broadcast_bytes), "key", "left_semi").select(F.col("fp").alias("_fp")).distinct()
    return keys, written(marked, "marked")


def _among(x: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which elements of `x` the sorted array `known` holds: a binary search each, whatever the size of `known`."""
    if not len(known):
        return np.zeros(x.shape, bool)
    return known[np.minimum(np.searchsorted(known, x), len(known) - 1)] == x


def _rewrite(texts: pa.Array, lines: Lines, hit: np.ndarray) -> tuple[list, list, list, list]:
    """(text kept, lines, recurring lines, line numbers dropped) per row."""
    n = len(texts)
    kept, dropped = texts.to_pylist(), [[] for _ in range(n)]
    for r, k in zip(lines.row[hit].tolist(), lines.number[hit].tolist()):
        dropped[r].append(k)
    for r, gone in enumerate(dropped):
        if gone:
            gone_set = set(gone)
            kept[r] = "\n".join(x for k, x in enumerate(kept[r].split("\n")) if k not in gone_set)
    total = [0 if t is None else int(k) for t, k in zip(kept, lines.lines_of_row)]
    return kept, total, np.bincount(lines.row, hit, n).astype(np.int64).tolist(), dropped


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(template hash, hash of the text, line number)."""
    for batch in batches:
        for part in slices(batch, "_text"):
            lines = Lines(part.column("_text"))
            text_hash = part.column("_fp").to_numpy(zero_copy_only=False)[lines.row]
            some = lines.keys.ravel() != 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(lines.keys.ravel()[some].view(np.int64)), pa.array(np.repeat(text_hash, 1 + SEGMENTS)[some]),
                 pa.array(np.repeat(lines.number, 1 + SEGMENTS)[some].astype(np.int32))], ["key", "fp", "line"])


def drop_recurring(docs: DataFrame, text: str = "text", min_docs: int = MIN_DOCS,
                   max_broadcast_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """`docs` with `text` shortened, and new columns `n_lines`, `n_recurring` and `dropped` (line numbers from 0)."""
    names = [c for c in docs.columns if c not in NEW]
    where = names.index(text)
    bounded(docs.sparkSession)
    plain = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(names)])
    text = f"c{where}"
    keys, marked = recurring_templates(plain, text, min_docs, max_broadcast_bytes)
    schema = StructType([*plain.schema.fields, StructField("n_lines", LongType()), StructField("n_recurring", LongType()),
                         StructField("dropped", ArrayType(IntegerType()))])
    width = len(names)

    few_keys, few_marked = (df.count() * 8 <= max_broadcast_bytes for df in (keys, marked))
    if few_keys and not few_marked:  # the keys go to all texts, where they lie
        told = plain.select("*", F.lit(None).cast("bigint").alias("_fp"), F.lit(True).alias("_hit"))
    else:  # texts without a recurring template pass as they are
        told = plain.withColumn("_fp", F.xxhash64(text)).join(
            (F.broadcast(marked) if few_marked else marked).select("_fp", F.lit(True).alias("_hit")), "_fp", "left")
        told = told if few_marked else written(told, "told")
    lines_of = F.when(F.col(text).isNull(), 0).otherwise(F.size(F.split(text, "\n", -1)))
    same = told.where("_hit is null").select(
        *plain.columns, lines_of.cast("bigint").alias("n_lines"), F.lit(0).cast("bigint").alias("n_recurring"),
        F.array().cast("array<int>").alias("dropped"))
    hit_rows = told.where("_hit")

    def rebuild(part: pa.RecordBatch, lines: Lines, hit: np.ndarray) -> pa.RecordBatch:
        kept, total, recurring, dropped = _rewrite(part.column(where), lines, hit)
        cols = list(part.columns[:width])
        cols[where] = pa.array(kept, part.column(where).type)
        return pa.RecordBatch.from_arrays(
            [*cols, pa.array(total, pa.int64()), pa.array(recurring, pa.int64()), pa.array(dropped, pa.list_(pa.int32()))],
            [*part.schema.names[:width], *NEW])

    if few_keys:
        known = np.sort(keys.toArrow().column("key").to_numpy().view(np.uint64) & ~np.uint64(1))
        shipped = docs.sparkSession.sparkContext.broadcast(known)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, batch.schema.names[where]):
                    lines = Lines(part.column(where), passages=False)
                    yield rebuild(part, lines, _among(lines.keys, shipped.value).any(axis=1))

        changed = hit_rows.select(*plain.columns).mapInArrow(run, schema)
    else:
        def run_joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, batch.schema.names[where]):
                    lines = Lines(part.column(where))
                    hit = np.zeros(len(lines.row), bool)
                    first = np.searchsorted(lines.row, np.arange(part.num_rows + 1))
                    for r, own in enumerate(part.column(width).to_pylist()):
                        rows = slice(first[r], first[r + 1])
                        hit[rows] = np.isin(lines.number[rows], np.array(own or [], np.int64))
                    yield rebuild(part, lines, hit)

        # One text's lines are bounded by that text: copies of a text give the same line numbers.
        marks = (hit_rows.select(F.col(text).alias("_text"), "_fp").mapInArrow(_occurrences, "key bigint, fp bigint, line int")
                 .join(keys, "key", "left_semi").groupBy("fp").agg(F.collect_set("line").alias("_lines")))
        changed = (hit_rows.join(marks.withColumnRenamed("fp", "_fp"), "_fp", "left").select(*plain.columns, "_lines")
                   .mapInArrow(run_joined, schema))
    return same.unionByName(changed).toDF(*names, *NEW)
