"""Merkle manifest of a dataset: a tree of digests per group, leaf places from bitmap ranks.

A row is a leaf: H, lower-case hex sha256, of its columns, each `-` if null, else its UTF-8 byte count, `:` and its
value.  Per group (`lang`), leaves ascend by id; while several nodes remain, every `FAN` consecutive ones become their H,
and the groups' subroots, ordered by group (null first, then bytewise), are reduced to the root alike.

Places come from ranks, no leaf is sorted.  Each group's ids make a bitmap, compressed to its words of 64 bits that hold
an id, merged from the tasks' partial words by a bitwise OR.  A popcount directory of three levels (words, stretches of
2^18 words, stretches of 2^20 of those) holds the number of rows before each; the rank of an id is the number before its
word and the popcount of the lower bits.  No window of the directory sees more than 2^20 rows, whatever the ids.
Rows that share an id are placed by their leaf behind it, equal ones in any order, from counts of the same kind; that
part reads only words where the row count differs from the popcount.

Nodes are then keyed by group and place: `SPAN` consecutive ones meet in one row as a slot array, and a task reduces it by
up to `STEPS` levels, so a tree of n leaves takes log_512(n) shuffles.  On the way back each row of slots gets the siblings
above it and passes them on, with its own, to its slots; the last step gives every leaf its proof.  No digest but the
root's path is ever held twice, and nothing passes the driver but two counts.

Defined results: null columns as stated, null ids come first in their group; repeated rows are leaves of their own, with
the places next to each other; empty and very long texts are hashed whole; an empty table gives an empty table; columns
not named are not read.  Ids must be integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covlens.llm.store import written

FAN = 8
STEPS = 3
SPAN = FAN ** STEPS
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 3
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_COPIES = 64
#: Groups' sizes are broadcast while there are at most this many.
MAX_BROADCAST_GROUPS = 100_000


def digest(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(columns: list[Column]) -> Column:
    """H of a row's columns."""
    text = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in text])
                  .cast("binary"), 256)


def leaves(docs: DataFrame, key: str, group: str, text: str, columns: tuple[str, ...]) -> DataFrame:
    """uid, tree (the group as a string that sorts null first), id, leaf, and the leaf of the tampered row or null."""
    own = {c: docs[c] for c in columns}
    lowered = {**own, text: F.translate(docs[text], UPPER, LOWER)}
    tampered = F.crc32(docs[key].cast("string").cast("binary")) % TAMPERED == 0
    tree = F.coalesce(F.concat(F.lit("="), docs[group].cast("string")), F.lit(""))
    return docs.select(tree.alias("tree"), docs[key].cast("bigint").alias("id"), leaf([*own.values()]).alias("leaf"),
                       F.when(tampered, leaf([*lowered.values()])).alias("changed"),
                       F.monotonically_increasing_id().alias("uid"))


def _before(n: str, parts: list[str], order: str) -> Column:
    """Sum of `n` over the earlier rows of a part."""
    w = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(n).over(w), F.lit(0))


def directory(rows: DataFrame) -> DataFrame:
    """tree, word, bits, n, before: the words of each tree's bitmap and the number of rows in earlier ones.  `rows`: tree,
    id (not null)."""
    words = written(rows.groupBy("tree", F.shiftright("id", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(id & 63 as int))")).alias("bits"), F.count("*").alias("n"))
        .withColumn("stretch", F.shiftright("word", 18)), "words")
    middle = words.groupBy("tree", "stretch").agg(F.sum("n").alias("n")).withColumn("top", F.shiftright("stretch", 20))
    top = middle.groupBy("tree", "top").agg(F.sum("n").alias("n"))
    top = top.select("tree", "top", _before("n", ["tree"], "top").alias("before_top"))
    middle = middle.join(top, ["tree", "top"]).select(
        "tree", "stretch", (F.col("before_top") + _before("n", ["tree", "top"], "stretch")).alias("before_stretch"))
    return words.join(middle, ["tree", "stretch"]).select(
        "tree", "word", "bits", "n", (F.col("before_stretch") + _before("n", ["tree", "stretch"], "word")).alias("before"))


def _copies(rows: DataFrame) -> DataFrame:
    """uid, idx of rows that may share an id.  `rows`: uid, tree, word, id, leaf, before (rows of the tree before the word);
    null words and ids come first.  Counts by id, by leaf prefix, by leaf and by share of equal rows are added up, so
    neither an id nor a row that a third of the table repeats is one task."""
    rows = written(rows.select("uid", "tree", "leaf", "before", F.coalesce(F.col("word").cast("string"), F.lit("")).alias("word"),
                               F.coalesce(F.col("id").cast("string"), F.lit("")).alias("name"), "id",
                               F.substring("leaf", 1, 4).alias("prefix"), F.pmod("uid", F.lit(_COPIES)).alias("share")), "copies")
    one = ["tree", "word", "name"]
    shares = rows.groupBy(*one, "id", "prefix", "leaf", "share").agg(F.count("*").alias("n"), F.min("before").alias("before"))
    by_leaf = shares.groupBy(*one, "id", "prefix", "leaf").agg(F.sum("n").alias("n"))
    by_prefix = by_leaf.groupBy(*one, "id", "prefix").agg(F.sum("n").alias("n"))
    by_id = by_prefix.groupBy(*one, "id").agg(F.sum("n").alias("n"))
    start = (shares.withColumn("a", _before("n", [*one, "leaf"], "share")).drop("n", "id")
             .join(by_leaf.select(*one, "leaf", _before("n", [*one, "prefix"], "leaf").alias("b")), [*one, "leaf"])
             .join(by_prefix.select(*one, "prefix", _before("n", one, "prefix").alias("c")), [*one, "prefix"])
             .join(by_id.select(*one, _before("n", ["tree", "word"], "id").alias("d")), one)
             .select(*one, "leaf", "share", (F.col("before") + F.col("a") + F.col("b") + F.col("c") + F.col("d")).alias("start")))
    each = Window.partitionBy(*one, "leaf", "share").orderBy("uid")
    return (rows.withColumn("k", F.row_number().over(each)).join(start, [*one, "leaf", "share"])
            .select("uid", (F.col("start") + F.col("k") - 1).alias("idx")))


def places(rows: DataFrame) -> DataFrame:
    """`rows` (uid, tree, id, leaf, ...) with n, the leaves of the tree, and idx, the row's place among them."""
    sizes = written(rows.groupBy("tree").agg(F.count("*").alias("n"), F.count_if(F.col("id").isNull()).alias("nulls")), "sizes")
    if sizes.count() <= MAX_BROADCAST_GROUPS:
        sizes = F.broadcast(sizes)
    known = (rows.withColumn("word", F.shiftright("id", 6)).join(directory(rows.where("id is not null")).withColumnRenamed("n", "rows"),
                                                                 ["tree", "word"], "left")
             .join(sizes, "tree"))
    plain = F.col("rows") == F.bit_count("bits")
    before = F.when(F.col("id").isNull(), 0).otherwise(F.col("before") + F.col("nulls"))
    lower = F.bit_count(F.expr("bits & ~shiftleft(-1L, cast(id & 63 as int))"))
    known = written(known.select(*rows.columns, "n", "word", before.alias("before"),
                                 F.when(plain, before + lower).alias("idx")), "ranked")
    rest = known.where("idx is null")
    if rest.isEmpty():
        return known.drop("word", "before")
    placed = _copies(rest).unionByName(known.where("idx is not null").select("uid", "idx"))
    return known.drop("idx", "word", "before").join(placed, "uid")


def height(n: int) -> int:
    """Levels that `n` nodes are reduced by until one remains."""
    k = 0
    while n > 1:
        n, k = -(-n // FAN), k + 1
    return k


def reduced(nodes: list[str], steps: int) -> list[list[str]]:
    """The slot array and the `steps` arrays above it."""
    out = [nodes]
    for _ in range(steps):
        below = out[-1]
        out.append([digest(*below[k:k + FAN]) for k in range(0, len(below), FAN)])
    return out


def siblings(levels: list[list[str]], i: int) -> list[str]:
    """What stands before and after the i-th slot and its ancestors in their runs, level by level, below the last."""
    out = []
    for level in levels[:-1]:
        first = i - i % FAN
        out += ["".join(level[first:i]), "".join(level[i + 1:first + FAN])]
        i //= FAN
    return out


def climb(node: str, path: list[str]) -> str:
    for before, after in zip(path[::2], path[1::2]):
        node = digest(before, node, after)
    return node


def _reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, slots = batch.column("n").to_pylist(), batch.column("slots").to_pylist()
        top = [reduced([s["node"] for s in row], min(STEPS, height(k)))[-1][0] for k, row in zip(n, slots)]
        yield pa.RecordBatch.from_arrays([batch.column("tree"), pa.array([-(-k // SPAN) for k in n], pa.int64()), batch.column("g"),
                                          pa.array(top, pa.string())], ["tree", "n", "idx", "node"])


def _down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each slot with the siblings on its way to the root."""
    for batch in batches:
        for row in batch.to_pylist():
            levels = reduced([s["node"] for s in row["slots"]], min(STEPS, height(row["n"])))
            k = len(row["slots"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["tree"]] * k), pa.array([row["g"] * SPAN + s["slot"] for s in row["slots"]], pa.int64()),
                 pa.array([siblings(levels, i) + row["path"] for i in range(k)], pa.list_(pa.string())),
                 pa.array([row["subroot"]] * k, pa.string()), pa.array([row["root"]] * k, pa.string())],
                ["tree", "idx", "path", "subroot", "root"])


_PROVED = "id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each leaf's siblings, and the root that they give with its present content."""
    for batch in batches:
        for row in batch.to_pylist():
            slots, out = row["slots"], []
            levels = reduced([s["node"] for s in slots], min(STEPS, height(row["n"])))
            for i, s in enumerate(slots):
                path = siblings(levels, i) + row["path"]
                folded = climb(s["changed"] or s["node"], path)
                out.append((s["id"], s["node"], row["subroot"], row["root"], digest(*path), folded, folded == row["root"]))
            kinds = [pa.int64(), *[pa.string()] * 5, pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                             [f.split()[0] for f in _PROVED.split(", ")])


def _slots(nodes: DataFrame, *also: str) -> DataFrame:
    """tree, n, g, slots: up to SPAN consecutive nodes per row, in order."""
    slot = F.struct((F.col("idx") % SPAN).alias("slot"), "node", *also)
    g = F.expr(f"idx div {SPAN}").alias("g")
    return written(nodes.groupBy("tree", "n", g).agg(F.array_sort(F.collect_list(slot)).alias("slots")), "slots")


def _up(nodes: DataFrame, most: int, *also: str) -> tuple[list[DataFrame], DataFrame]:
    """The slot rows of every round, and the last node of each tree.  `most`: leaves of the largest tree."""
    rounds = []
    while True:
        rounds.append(_slots(nodes, *(also if not rounds else ())))
        nodes = rounds[-1].select("tree", "n", "g", "slots").mapInArrow(_reduce, "tree string, n bigint, idx bigint, node string")
        most = -(-most // SPAN)
        if most <= 1:
            return rounds, nodes.select("tree", "node")


def _to_slots(rows: DataFrame, above: DataFrame) -> DataFrame:
    """Slot rows with what `above` (tree, idx, path, subroot, root) says of each."""
    return rows.join(above.withColumnRenamed("idx", "g"), ["tree", "g"])


_BELOW = "tree string, idx bigint, path array<string>, subroot string, root string"


def manifest(docs: DataFrame, key: str = "doc_id", group: str = "lang", text: str = "text",
             columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """Per row: key, leaf, subroot, root, proof_sha256, folded_root, verified."""
    rows = written(leaves(docs, key, group, text, columns), "leaves")
    placed = places(rows).select("tree", "n", "idx", F.col("leaf").alias("node"), "changed", "id")
    most = rows.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    rounds, subroots = _up(placed, most, "changed", "id")

    # The subroots are the leaves of a last tree; a group's place in it is counted by the beginning of its name.
    subroots = written(subroots, "subroots").withColumn("start", F.hex(F.substring(F.col("tree").cast("binary"), 1, 3)))
    begins = subroots.groupBy("start").agg(F.count("*").alias("n"))
    begins = begins.select("start", _before("n", [], "start").alias("before"))
    groups = subroots.count()
    order = Window.partitionBy("start").orderBy("tree")
    tops = written(subroots.join(begins, "start").select(
        "tree", "node", (F.col("before") + F.row_number().over(order) - 1).alias("idx")), "tops")
    last, root = _up(tops.select(F.lit("").alias("tree"), F.lit(groups).cast("bigint").alias("n"), "idx", "node"), groups)
    none = F.array().cast("array<string>")
    above = root.select("tree", F.lit(0).cast("bigint").alias("idx"), none.alias("path"), F.lit(None).cast("string").alias("subroot"),
                        F.col("node").alias("root"))
    for part in reversed(last):
        above = written(_to_slots(part, above).mapInArrow(_down, _BELOW), "above")
    above = above.drop("tree", "subroot").join(tops, "idx").select(
        "tree", F.lit(0).cast("bigint").alias("idx"), "path", F.col("node").alias("subroot"), "root")
    for part in reversed(rounds[1:]):
        above = written(_to_slots(part, above).mapInArrow(_down, _BELOW), "above")
    return _to_slots(rounds[0], above).mapInArrow(_prove, _PROVED).withColumnRenamed("id", key)
