"""Near-duplicate documents: MinHash with banding, signature verification, full-set confirmation, components.

1. Sketch (one pass over the texts): the distinct 5-word shingles of a text, their number, a 128-bit fingerprint of the
   set, and `MINIMA` minima of universal hash functions, 16 bits of each.
2. Texts with equal sets form a class, represented by its smallest doc_id; from here on a class is one node, so
   thousands of exact copies cost one row.
3. Each band of a class's signature is a bucket key.  Within a bucket no pairs are listed: members are paired with the
   bucket's smallest member and, in some bands, with a random one.  Two sets with a similarity of 0.75 share no bucket
   with a probability of (1 - 0.75^3)^28 = 2e-7.
4. Signature verification: pairs whose signatures agree in fewer than `AGREE` of the places (5 standard deviations
   below 0.75) are dropped.  The rest are confirmed on the full shingle sets, from the texts, and the links' components
   found by alternating large-star and small-star.
5. Where a bucket still holds more than one component, its other members may be linked although none is linked to the
   pair's partner of step 3.  The members outside the component of the bucket's smallest one (few, mostly) meet that
   component's members and each other, in pairs of blocks of at most about `BLOCK` texts.  A task counts the shingles
   that the texts of its two blocks share, for all pairs at once, and gives out links only; pairs are never listed.
   After this no link that shares a bucket is missed.

Defined results: null and empty texts, and texts of white space only, have no shingles and are linked with nothing;
texts of fewer than five words have the whole sequence as their only shingle; rows with the same doc_id are one
document, linked with all that any of its texts is linked with; a row with a null doc_id takes no part (component_id
null, kept true); very long texts are read whole, each as a slice of its own; an empty table gives an empty table;
`keep_one` passes all columns, whatever their names.  Ids must be integers (strings that are none raise an error).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covlens.llm.batches import bounded, slices
from covlens.llm.components import components
from covlens.llm.store import written
from covlens.llm.textops import Buffer, Words, mix, windows

SHINGLE = 5
BANDS, ROWS = 28, 3
MINIMA = 252  # the bands take the first BANDS * ROWS, verification all
RANDOM_BANDS = 4
PERCENT = 75
AGREE = 0.61
BLOCK = 256
#: Node ids are broadcast to pick the texts to confirm while there are at most this many (16 bytes each).
MAX_BROADCAST_NODES = 4_000_000
MAX_BROADCAST_HEADS = 500_000  # about 40 bytes each

_RNG = np.random.default_rng(75)
_A = _RNG.integers(0, 1 << 63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, MINIMA, dtype=np.uint64)
_CHUNK = 1 << 15
_COLUMNS = 1 << 14


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first): the distinct shingles of row i are hashes[first[i]:first[i + 1]], sorted."""
    words = Words(Buffer(texts))
    count = np.diff(words.row_first)
    runs = windows(words.hash, SHINGLE, seed=SHINGLE)
    out, first = [], np.zeros(len(count) + 1, np.int64)
    for i, n in enumerate(count.tolist()):
        at = words.row_first[i]
        if n >= SHINGLE:
            own = np.sort(runs[at:at + n - SHINGLE + 1])
            keep = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            own = own[keep]
        else:
            own = windows(words.hash[at:at + n], n, seed=n) if n else np.zeros(0, np.uint64)
        out.append(own)
        first[i + 1] = first[i] + len(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), first


def signatures(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """16 bits of each minimum, one line per set; sets must not be empty."""
    out = np.zeros((len(first) - 1, len(_A)), np.uint16)
    lo = 0
    while lo < len(first) - 1:  # rows whose shingles fit the processor's cache together
        hi = max(lo + 1, int(np.searchsorted(first, first[lo] + _CHUNK, "right")) - 1)
        part, starts = hashes[first[lo]:first[hi]], first[lo:hi] - first[lo]
        for k in range(len(_A)):
            out[lo:hi, k] = mix(np.minimum.reduceat(part * _A[k] + _B[k], starts)) >> np.uint64(48)
        lo = hi
    return out


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "_text"):
            hashes, first = shingle_sets(part.column("_text"))
            n = np.diff(first)
            some = np.flatnonzero(n)
            f1, f2, sig = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64), [None] * len(n)
            if len(some):
                f1[some] = np.add.reduceat(mix(hashes ^ np.uint64(0x5851F42D4C957F2D)), first[some])
                f2[some] = np.add.reduceat(mix(hashes ^ np.uint64(0x14057B7EF767814F)), first[some])
                for i, s in zip(some.tolist(), signatures(hashes, np.append(first[some], first[-1]))):
                    sig[i] = s.tobytes()
            yield pa.RecordBatch.from_arrays(
                [part.column("_key"), pa.array(n), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
                 pa.array(sig, pa.binary())], ["doc_id", "n_shingles", "f1", "f2", "sig"])


def _agree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Signature verification of listed pairs."""
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1)
                    for c in ("sig_a", "sig_b"))
            keep = (a == b).mean(axis=1) >= AGREE
            yield batch.select(["a", "b", "a1", "a2", "b1", "b2"]).filter(pa.array(keep))


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full shingle sets are similar enough.  A text that is not its class's (a repeated doc_id with
    several texts) is told by its fingerprint and left to the row that has the right one."""
    for batch in batches:
        for part in slices(batch, "text_b"):
            code = [part.column(c).dictionary_encode() for c in ("text_a", "text_b")]
            sets, marks = [], []
            for c in code:
                h, first = shingle_sets(c.dictionary)
                own = [h[first[i]:first[i + 1]] for i in range(len(first) - 1)]
                sets.append(own)
                marks.append([(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)),
                               int(mix(s ^ np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64).view(np.int64)))
                              for s in own])
            keep = np.zeros(part.num_rows, bool)
            ids = [c.indices.to_pylist() for c in code]
            want = [[*zip(part.column(f"{s}1").to_pylist(), part.column(f"{s}2").to_pylist())] for s in "ab"]
            for r, (i, j) in enumerate(zip(*ids)):
                if marks[0][i] == want[0][r] and marks[1][j] == want[1][r]:
                    x, y = sets[0][i], sets[1][j]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[r] = 100 * both >= PERCENT * (len(x) + len(y) - both)
            yield part.select(["a", "b"]).rename_columns(["u", "v"]).filter(pa.array(keep))


GROUP = ("main", "kind", "lo", "hi")


def shared_counts(hashes: np.ndarray, first: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many elements each set of `left` shares with each of `right`: products of 0/1 matrices over the elements that
    occur on both sides, `_COLUMNS` of them at a time."""
    def flat(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = first[rows + 1] - first[rows]
        at = np.repeat(first[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return hashes[at], np.repeat(np.arange(len(rows)), n)

    (h, i), (k, j) = flat(left), flat(right)
    both = np.intersect1d(h, k)
    out = np.zeros((len(left), len(right)), np.int64)
    for lo in range(0, len(both), _COLUMNS):
        some = both[lo:lo + _COLUMNS]
        parts = []
        for x, row, n in ((h, i, len(left)), (k, j, len(right))):
            at = np.minimum(np.searchsorted(some, x), len(some) - 1)
            hit = some[at] == x
            m = np.zeros((n, len(some)), np.float32)
            m[row[hit], at[hit]] = 1
            parts.append(m)
        out += (parts[0] @ parts[1].T).astype(np.int64)
    return out


def _block_links(t: pa.Table) -> set[tuple[int, int]]:
    """Links between the two sides of one group of rows: side 0 meets side 1, side 2 meets itself."""
    node, component, side = (t.column(c).to_numpy() for c in ("node", "component", "side"))
    hashes, first = shingle_sets(t.column("text").combine_chunks())
    size = np.diff(first)
    left, right = np.flatnonzero(side != 1), np.flatnonzero(side > 0)
    if not len(left) or not len(right):
        return set()
    both = shared_counts(hashes, first, left, right)
    linked = 100 * both >= PERCENT * (size[left][:, None] + size[right][None, :] - both)
    linked &= (both > 0) & (component[left][:, None] != component[right][None, :])
    return {(min(a, b), max(a, b)) for a, b in zip(node[left[linked.nonzero()[0]]].tolist(),
                                                   node[right[linked.nonzero()[1]]].tolist())}


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of each group; a group's rows stand in sequence, at most about 2 * BLOCK of them."""
    rest: pa.Table | None = None

    def links(t: pa.Table) -> Iterator[pa.RecordBatch]:
        edge = np.zeros(t.num_rows, bool)
        edge[0] = True
        for c in GROUP:
            x = t.column(c).to_numpy()
            edge[1:] |= x[1:] != x[:-1]
        at = np.append(np.flatnonzero(edge), t.num_rows)
        found = sorted(set().union(*(_block_links(t.slice(s, e - s)) for s, e in zip(at[:-1], at[1:]))))
        if found:
            a, b = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["u", "v"])

    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([rest, t]) if rest is not None else t
        same = np.ones(t.num_rows, bool)
        for c in GROUP:
            x = t.column(c).to_numpy()
            same &= x == x[-1]
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        rest = t.slice(cut)
        if cut:
            yield from links(t.slice(0, cut))
    if rest is not None and rest.num_rows:
        yield from links(rest)


class _Linker:
    """Confirms candidate pairs (a < b) of nodes on their signatures, then on their texts."""

    def __init__(self, classes: DataFrame, texts: DataFrame):
        self.classes, self.texts = classes, texts

    def texts_of(self, nodes: DataFrame) -> DataFrame:
        """node, text of the given nodes (distinct)."""
        few = nodes.count() <= MAX_BROADCAST_NODES
        return written(self.texts.join(F.broadcast(nodes) if few else nodes, "node", "left_semi"), "texts")

    def links(self, pairs: DataFrame) -> DataFrame:
        side = lambda s: self.classes.select(F.col("node").alias(s), F.col("f1").alias(f"{s}1"),
                                             F.col("f2").alias(f"{s}2"), F.col("sig").alias(f"sig_{s}"))
        known = written(pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(
            _agree, "a bigint, b bigint, a1 bigint, a2 bigint, b1 bigint, b2 bigint"), "pairs")
        texts = self.texts_of(known.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        text = lambda s: texts.select(F.col("node").alias(s), F.col("text").alias(f"text_{s}"))
        return (known.join(text("a"), "a").join(text("b"), "b")
                .select("a", "b", "a1", "a2", "b1", "b2", "text_a", "text_b").mapInArrow(_confirm, "u bigint, v bigint"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept (doc_id is it)."""
    bounded(docs.sparkSession)
    rows = docs.select(docs[key].cast("bigint").alias("_key"), docs[text].alias("_text"))
    sketch = written(rows.mapInArrow(
        _sketch, "doc_id bigint, n_shingles bigint, f1 bigint, f2 bigint, sig binary"), "sketch")
    part = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = written(part.groupBy("n_shingles", "f1", "f2")
                      .agg(F.min("doc_id").alias("node"), F.min("sig").alias("sig")), "classes")

    wide = 2 * ROWS
    keys = [F.xxhash64(F.lit(i), F.substring("sig", 1 + i * wide, wide)) for i in range(BANDS)]
    banded = classes.select("node", F.posexplode(F.array(*keys)).alias("band", "bucket"))
    # Written before the join: a bucket of many members is then split between tasks like any skewed join key.
    heads = written(banded.groupBy("band", "bucket")
             .agg(F.count("*").alias("size"), F.min("node").alias("rep"),
                  F.min(F.struct(F.xxhash64("node", "bucket").alias("h"), "node")).alias("r"))
             .where("size > 1").select("band", "bucket", "size", "rep", F.col("r.node").alias("other")), "heads")
    if heads.count() <= MAX_BROADCAST_HEADS:
        heads = F.broadcast(heads)
    members = written(banded.join(heads, ["band", "bucket"]), "members")
    partner = F.explode(F.array(F.struct("rep"), F.struct(
        F.when(F.col("band") < RANDOM_BANDS, F.col("other")).otherwise(F.col("rep")).alias("rep"))))
    pairs = (members.select("node", partner.alias("p"))
             .select(F.least("node", "p.rep").alias("a"), F.greatest("node", "p.rep").alias("b"))
             .where("a <> b").distinct())

    linker = _Linker(classes, rows.where("_key is not null").select(F.col("_key").alias("node"),
                                                                   F.col("_text").alias("text")))
    of_node = components(linker.links(pairs))

    # Buckets of three and more that still hold several components.
    placed = (members.where("size > 2").select("band", "bucket", "node")
              .join(of_node, "node", "left").withColumn("component", F.coalesce("component", "node")))
    mixed = written(placed.groupBy("band", "bucket")
             .agg(F.min(F.struct("node", "component")).alias("m"), F.min("component").alias("x"), F.max("component").alias("y"))
             .where("x <> y").select("band", "bucket", F.col("m.component").alias("main")), "mixed-buckets")
    if mixed.count() <= MAX_BROADCAST_HEADS:
        mixed = F.broadcast(mixed)
    # The same texts share many buckets; by the main component they meet once.
    tagged = written(placed.join(mixed, ["band", "bucket"]).select("main", "node", "component").distinct()
                     .withColumn("out", F.col("component") != F.col("main")), "mixed")
    sizes = tagged.groupBy("main").agg(F.ceil(F.count_if("out") / BLOCK).cast("int").alias("outs"),
                                       F.ceil(F.count_if(~F.col("out")) / BLOCK).cast("int").alias("mains"))
    spread = tagged.join(sizes, "main").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.when(F.col("out"), F.col("outs")).otherwise(F.col("mains"))).cast("int"))
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    kept = ("main", "node", "component")
    met = spread.where("out").select(
        *kept, each(F.col("mains")).alias("lo"), F.col("block").alias("hi"), F.lit(0).alias("side")).unionByName(
        spread.where(~F.col("out")).select(
            *kept, F.col("block").alias("lo"), each(F.col("outs")).alias("hi"), F.lit(1).alias("side"))).withColumn("kind", F.lit(0))
    own = spread.where("out").withColumn("other", each(F.col("outs"))).select(
        *kept, F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"),
        F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"),
        F.lit(1).alias("kind"))
    blocks = met.unionByName(own).join(linker.texts_of(tagged.select("node").distinct()), "node")
    more = (blocks.repartition(*GROUP).sortWithinPartitions(*GROUP, "node")
            .select(*GROUP, "side", "node", "component", "text").mapInArrow(_blocked, "u bigint, v bigint"))
    linked = components(of_node.select(F.col("node").alias("u"), F.col("component").alias("v")).unionByName(more))

    named = classes.select("n_shingles", "f1", "f2", "node")
    out = (sketch.select("doc_id", "n_shingles", "f1", "f2").join(named, ["n_shingles", "f1", "f2"], "left")
           .join(linked, "node", "left"))
    component = F.when(F.col("doc_id").isNull(), F.lit(None).cast("bigint")).when(
        F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "node"))
    return (out.select("doc_id", "n_shingles", component.alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, of each group's smallest doc_id; rows with a null key stay."""
    name = "gone"
    while name in docs.columns:
        name += "_"
    gone = written(near_duplicates(docs, key, text).where(~F.col("kept"))
                   .select(F.col("doc_id").alias(name)).distinct(), "gone")
    if gone.count() <= MAX_BROADCAST_NODES:
        gone = F.broadcast(gone)
    return docs.join(gone, docs[key].cast("bigint") == F.col(name), "left_anti")
