"""Toxicity classifier: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A text is cut into windows of `WINDOW` words.  A window's units are the byte n-grams (`NGRAMS`) of its words with a
boundary mark at either end, hashed into `BUCKETS` embedding rows, so misspellings that were never seen still share
most of their units with the words they come from.  The units' embeddings are averaged, a linear softmax over
(clean, toxic) follows, and both are trained together by Adagrad.  Labels belong to whole texts, so training goes in
rounds: first every window of a toxic text counts as toxic; then only the windows that the model itself finds most
toxic in their text.  A text's score is that of its most toxic window, shifted so that 0.5 separates the training
texts best.

Training reads a bounded sample of labelled rows: in the order of a hash of the id, at most `per_class` texts of either
label, and of these, without those of more than `1 / LONGEST_SHARE` of `train_bytes`, as many as come to `train_bytes`
bytes.  The sample is cut before it is grouped, so training is one task with a bounded input; a lost executor repeats it
with the same result (fixed seed, rows sorted).  Scoring covers every whole text where it lies: the trained
model is one float per bucket (1 MB), broadcast, and nothing is shuffled.

Defined results: null texts and texts without a word character score 0.0; scores depend on the text alone, so repeated
rows score alike; without labelled rows of both kinds every score is 0.0; null labels, labels without a document and
null ids are not trained on; an id with several labels counts as toxic if any of them does.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from covlens.llm.batches import bounded, give_back, slices
from covlens.llm.store import written
from covlens.llm.textops import Buffer

WINDOW = 16
NGRAMS = (3, 4, 5)
BUCKETS = 1 << 18
DIM = 8
PER_CLASS = 2000
TRAIN_BYTES = 8 << 20
LONGEST_SHARE = 8  # a sampled text takes at most this part of the bytes

_WORD = np.zeros(256, bool)
_WORD[list(b"0123456789abcdefghijklmnopqrstuvwxyz@$*") + list(range(128, 256))] = True


class Units:
    """The hashed n-grams of a buffer and the windows that they fall into: for each n a bucket and a validity per byte
    position, and for each window its first position and its row."""

    def __init__(self, buffer: Buffer, window: int = WINDOW):
        word = _WORD[buffer.bytes]
        code = np.where(word, buffer.bytes, 0).astype(np.uint32)
        n = len(code)
        start = np.flatnonzero(np.diff(word.view(np.int8)) == 1) + 1  # of each word
        row = np.searchsorted(buffer.row_start, start, side="right") - 1
        first = np.searchsorted(row, np.arange(len(buffer.row_start) - 1))
        opens = (np.arange(len(start)) - first[row]) % window == 0 if len(start) else np.zeros(0, bool)
        self.window_at, self.window_row = start[opens] - 1, row[opens]
        self.grams = []
        inner, h = np.ones(n, bool), code.copy()
        for size in range(2, max(NGRAMS) + 1):
            m = n - size + 1
            if m <= 0:
                break
            h = h[:m] * np.uint32(0x01000193) + code[size - 1:]
            if size > 2:
                inner = inner[:m] & word[size - 2:size - 2 + m]
            if size in NGRAMS:  # no boundary inside, and something that is not a boundary
                bucket = ((h ^ np.uint32(size * 0x9E3779B1 & 0xFFFFFFFF)) * np.uint32(0x85EBCA6B)) >> np.uint32(14)
                self.grams.append((bucket.astype(np.int32), inner[:m] if size > 2 else inner[:m] & word[:m]))

    def sums(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per window: the sum of its units' values and their number."""
        if not len(self.window_at):
            return np.zeros(0), np.zeros(0)
        n = len(self.grams[0][0]) + NGRAMS[0] - 1
        value, count = np.zeros(n, np.float32), np.zeros(n, np.int8)
        for bucket, valid in self.grams:
            value[:len(bucket)] += np.where(valid, table[bucket], np.float32(0))
            count[:len(bucket)] += valid
        return (np.add.reduceat(value, self.window_at, dtype=np.float64),
                np.add.reduceat(count, self.window_at, dtype=np.int64))


def text_logits(texts: pa.Array, table: np.ndarray, bias: float) -> np.ndarray:
    """The logit of each text's most toxic window; -inf for texts without units."""
    units = Units(Buffer(texts))
    total, count = units.sums(table)
    out = np.full(len(texts), -np.inf)
    np.maximum.at(out, units.window_row, np.where(count > 0, total / np.maximum(count, 1) + bias, -np.inf))
    return out


def train(texts: list[bytes], toxic: np.ndarray, rounds: int = 6, rate: float = 0.5, seed: int = 7
          ) -> tuple[np.ndarray, float]:
    """(value per bucket, bias): embeddings times the difference of the softmax rows, with the calibrating shift."""
    rng = np.random.default_rng(seed)
    # (bucket, ...) pairs in window order, gathered from slices of the sample so that only the pairs are held at once.
    bucket, size, window_row = [], [], []
    parts = [(np.arange(i, min(i + 100, len(texts))), WINDOW) for i in range(0, len(texts), 100)]
    # Single words of some clean texts as windows of their own: a text that repeats one clean word is clean.
    parts += [(np.flatnonzero(toxic == 0)[i::len(texts) // 100 + 10], 1) for i in range(len(texts) // 400 + 1)]
    for rows, window in parts:
        units = Units(Buffer(pa.array([texts[i] for i in rows], pa.binary())), window)
        valid = np.concatenate([np.flatnonzero(ok) for _, ok in units.grams])
        own = np.concatenate([b[ok] for b, ok in units.grams])
        owner = np.searchsorted(units.window_at, valid, side="right") - 1
        bucket.append(own[np.argsort(owner, kind="stable")])
        size.append(np.bincount(owner, minlength=len(units.window_at)))
        window_row.append(rows[units.window_row])
    bucket, size, window_row = (np.concatenate(x) for x in (bucket, size, window_row))
    at = np.concatenate([[0], np.cumsum(size)])
    n = len(size)
    label = toxic[window_row].astype(np.int8)
    v = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    w = rng.normal(0, 0.1, (DIM, 2)).astype(np.float32)
    b = np.zeros(2, np.float32)
    seen_v, seen_w, seen_b = np.full((BUCKETS, DIM), 1e-6, np.float32), np.full((DIM, 2), 1e-6), np.full(2, 1e-6)

    def pick(ws: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(pair positions, first pair, pairs) of the windows `ws`."""
        k = size[ws]
        first = np.cumsum(k) - k
        return np.repeat(at[ws] - first, k) + np.arange(k.sum()), first, k

    used = np.flatnonzero(size > 0)
    for r in range(rounds):
        if r >= 2:  # of a toxic text's windows, those that look toxic beside the most toxic one
            value, total = (v @ (w[:, 1] - w[:, 0])).astype(np.float32), np.zeros(n)
            for ws in np.array_split(np.arange(n), max(1, n // 4096)):
                pairs, first, k = pick(ws)
                some = np.flatnonzero(k)
                total[ws[some]] = np.add.reduceat(value[bucket[pairs]], first[some], dtype=np.float64)
            logit = np.where(size > 0, total / np.maximum(size, 1) + float(b[1] - b[0]), -np.inf)
            best = np.full(len(toxic), -np.inf)
            np.maximum.at(best, window_row, logit)
            own = best[window_row]
            used = np.flatnonzero((size > 0) & ((label == 0) | (logit >= np.minimum(own, np.maximum(own / 2, 0)))))
        share = max(1e-3, float(label[used].mean()))
        for ws in np.array_split(rng.permutation(used), max(1, len(used) // 1024)):
            pairs, first, k = pick(ws)
            rows = bucket[pairs]
            x = np.add.reduceat(v[rows], first, axis=0) / k[:, None]
            z = x @ w + b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            y = label[ws]
            g = p.copy()
            g[np.arange(len(ws)), y] -= 1
            g *= np.where(y == 1, 0.5 / share, 0.5 / (1 - share))[:, None]  # both labels weigh the same
            gx = (g @ w.T) / k[:, None]
            gw, gb = x.T @ g, g.sum(0)
            touched, place = np.unique(rows, return_inverse=True)
            gv = np.stack([np.bincount(place, np.repeat(gx[:, d], k), len(touched)) for d in range(DIM)], 1)
            seen_v[touched] += gv * gv
            v[touched] -= (rate * gv / np.sqrt(seen_v[touched])).astype(np.float32)
            seen_w += gw * gw
            w -= (0.1 * rate * gw / np.sqrt(seen_w)).astype(np.float32)
            seen_b += gb * gb
            b -= (0.1 * rate * gb / np.sqrt(seen_b)).astype(np.float32)
    table, bias = (v @ (w[:, 1] - w[:, 0])).astype(np.float32), float(b[1] - b[0])
    logits = np.concatenate([text_logits(pa.array(texts[i:i + 500], pa.binary()), table, bias)
                             for i in range(0, len(texts), 500)])
    return table, bias - _threshold(logits, toxic)


def _threshold(logits: np.ndarray, toxic: np.ndarray) -> float:
    """The cut with the best mean of both labels' accuracies; the middle of the gap it lies in."""
    keep = np.isfinite(logits)
    logits, toxic = logits[keep], toxic[keep].astype(bool)
    if not toxic.any() or toxic.all():
        return 0.0
    order = np.argsort(logits)
    z, y = logits[order], toxic[order]
    below_toxic = np.concatenate([[0], np.cumsum(y)]) / y.sum()
    below_clean = np.concatenate([[0], np.cumsum(~y)]) / (~y).sum()
    cut = int(np.argmax(below_clean - below_toxic))
    return float((z[max(cut - 1, 0)] + z[min(cut, len(z) - 1)]) / 2)


def fit(docs: DataFrame, labels: DataFrame, train_on: Column, text: str = "text", key: str = "doc_id",
        label: str = "toxic", per_class: int = PER_CLASS, train_bytes: int = TRAIN_BYTES) -> tuple[bytes, float] | None:
    """Train on the labelled rows of `docs` for which `train_on` (over the labels' id) holds.  None without both
    labels."""
    known = (labels.where(train_on & labels[key].isNotNull() & labels[label].isNotNull())
             .groupBy(labels[key].alias("_key")).agg(F.max(labels[label].cast("int")).alias("_toxic")))
    ids = None
    for y in (0, 1):
        some = known.where(F.col("_toxic") == y).orderBy(F.xxhash64("_key"), "_key").limit(per_class)
        ids = some if ids is None else ids.unionByName(some)
    # At most 2 * per_class ids: small enough to broadcast at any size of the corpus.
    rows = (docs.select(docs[key].alias("_key"), docs[text].alias("_text"))
            .join(F.broadcast(ids), "_key").where(F.col("_text").isNotNull())
            .groupBy("_key").agg(F.min("_text").alias("_text"), F.max("_toxic").alias("_toxic")))
    rows = written(rows.withColumn("_bytes", F.octet_length("_text")), "labelled")
    # The running sum sees ids and lengths only, at most 2 * per_class of them.
    running = F.sum("_bytes").over(Window.partitionBy("_toxic").orderBy(F.xxhash64("_key"), "_key"))
    taken = (rows.where(F.col("_bytes") * LONGEST_SHARE <= train_bytes).select("_key", "_toxic", "_bytes")
             .withColumn("_sum", running).where(F.col("_sum") <= train_bytes).select("_key"))
    rows = rows.join(F.broadcast(taken), "_key", "left_semi").select("_key", "_text", "_toxic")

    def one(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("_key")
        texts = [t.encode() for t in part["_text"]]
        toxic = part["_toxic"].to_numpy()
        if len(set(toxic.tolist())) < 2:
            return pd.DataFrame({"weights": [], "bias": []})
        table, bias = train(texts, toxic)
        give_back()
        return pd.DataFrame({"weights": [table.tobytes()], "bias": [bias]})

    model = rows.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(one, "weights binary, bias double").collect()
    return (bytes(model[0]["weights"]), model[0]["bias"]) if model else None


def score(docs: DataFrame, model: tuple[bytes, float] | None, text: str = "text") -> DataFrame:
    """`docs` with `score` (0 to 1) and `predicted` (1 from 0.5 on), computed from the text alone.  Input columns of
    these names are replaced."""
    keep = [c for c in docs.columns if c not in ("score", "predicted")]
    plain = docs.select(*[docs[c] for c in keep])
    if model is None:
        return plain.select("*", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    bounded(docs.sparkSession)
    shipped = docs.sparkSession.sparkContext.broadcast(model[0])
    bias = model[1]
    where = keep.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(shipped.value, np.float32)
        for batch in batches:
            for part in slices(batch, batch.schema.names[where]):
                logits = text_logits(part.column(where), table, bias)
                s = 1 / (1 + np.exp(-np.clip(logits, -700, 700)))
                s[~np.isfinite(logits)] = 0.0
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                    [*part.schema.names, "score", "predicted"])

    schema = StructType([*plain.schema.fields, StructField("score", DoubleType()), StructField("predicted", IntegerType())])
    return plain.mapInArrow(run, schema)


def held_out(key: Column) -> Column:
    """Rows kept out of training: crc32 of the id as text, modulo 5, is 0.  A null id is not held out."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))
