"""Exact top-k by inner product over an impact-ordered, score-at-a-time index.

Vectors become integers, floor(256 * x) per component.  Candidates are dealt into blocks by hash, queries into blocks
of their own, and each pair of blocks is one task: blocks have a fixed size, so a task's memory does not grow with the
data.  A candidate block's index holds, per dimension, posting segments of the rows whose component falls into the same
quantised impact.  Small batches of queries walk all dimensions' segments in descending order of what they can contribute
and add each segment's guaranteed contribution to its rows.  At any point a row's score lies between its sum and its sum plus what
the open segments and the quantisation can still add; once few rows can reach the k-th best guaranteed sum, the walk
stops, which is a proof and not an estimate, and exactly these rows are rescored with the full integers.  A window
over (query, score, id) merges the blocks' k best.

Sums of the walk stay in 64 bits: where a pair of blocks holds components so large that they might not, the rows and
queries with such components are scored in full, in limbs of 21 bits, and the others walk.

Defined results: vectors that are null or empty, hold a null, NaN or infinite component, or a component whose
floor(256 * x) is no 64-bit integer take no part; a pair whose score is no 64-bit integer is not listed; shorter vectors count as padded with zeros; ties go to the
smaller id; rows that carry the query's own id are not its candidates; a repeated query id is asked once (its smallest
vector), a repeated candidate row is listed as often as it stands there; a null id takes no part; no rows, no result.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CANDIDATES, QUERIES = 8192, 2048
BATCH = 64
LEVEL_BITS = 5
CHECKS = (0.6, 0.8, 1.0)  # shares of the postings after which the walk looks for its proof
WALK = 1 << 58  # what dims * largest query component * largest row component stays under in a walk
LIMB = 21
_MASK = (1 << LIMB) - 1
_EXACT_DIMS = 512  # 512 products of two limbs are exact in a double


def quantised(vector: Column) -> Column:
    """array<bigint> of floor(256 * x), or null where the vector takes no part."""
    ints = F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double"))
                   | (x.cast("double") >= 2.0 ** 55) | (x.cast("double") < -2.0 ** 55))
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & ~bad, ints)


def _limbs(x: np.ndarray) -> list[np.ndarray]:
    return [(x & _MASK).astype(np.float64), (x >> LIMB & _MASK).astype(np.float64), (x >> 2 * LIMB).astype(np.float64)]


def full_scores(a: list[np.ndarray], b: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(scores, whether they are 64-bit integers) of all pairs of the rows of two matrices, given as limbs."""
    parts = np.zeros((5, len(a[0]), len(b[0])), np.int64)
    for lo in range(0, a[0].shape[1], _EXACT_DIMS):
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                parts[i + j] += (x[:, lo:lo + _EXACT_DIMS] @ y[:, lo:lo + _EXACT_DIMS].T).astype(np.int64)
    for s in range(4):
        parts[s + 1] += parts[s] >> LIMB
        parts[s] &= _MASK
    score = parts[0] | parts[1] << LIMB | parts[2] << 2 * LIMB
    below = (parts[3] == _MASK) & (parts[4] == -1)
    return np.where(below, score | np.iinfo(np.int64).min, score), below | (parts[3] == 0) & (parts[4] == 0)


def _largest(m: np.ndarray) -> np.ndarray:
    """Largest magnitude in each row (2^63 counts as 2^63 - 1)."""
    return np.maximum(m.max(1), ~m.min(1) + (m.min(1) > np.iinfo(np.int64).min))


class ImpactIndex:
    """Posting segments of one block: rows grouped by (dimension, quantised impact)."""

    def __init__(self, rows: np.ndarray):
        n, self.dims = rows.shape
        self.rows = rows
        parts, self.ids = [], []
        for d in range(self.dims):
            v = rows[:, d]
            low, high = int(v.min()), int(v.max())
            shift = max(0, (high - low).bit_length() - LEVEL_BITS)
            level = (v - low) >> shift
            order = np.argsort(level, kind="stable")
            cuts = np.flatnonzero(np.diff(level[order])) + 1
            for ids in np.split(order, cuts):
                own = v[ids]
                parts.append((d, own.min(), own.max()))
                self.ids.append(ids)
        self.dim, self.least, self.most = (np.array(x, np.int64) for x in zip(*parts))
        self.size = np.array([len(x) for x in self.ids])

    def top(self, qs: np.ndarray, k: int, own: list[np.ndarray], names: np.ndarray) -> list[tuple]:
        """For each query of a small batch: (row numbers, exact scores) of the k best rows outside `own[i]`, ties to
        the smaller name.  The batch shares one walk, in descending order of the largest contribution to any query;
        the bounds and the proof are each query's own."""
        n, w = len(self.rows), qs[:, self.dim].T  # (segments, queries)
        low = np.minimum(w * self.least[:, None], w * self.most[:, None])
        high = np.maximum(w * self.least[:, None], w * self.most[:, None])
        floor = np.full((self.dims, len(qs)), np.iinfo(np.int64).max)
        np.minimum.at(floor, self.dim, low)
        slack = np.zeros((self.dims, len(qs)), np.int64)
        np.maximum.at(slack, self.dim, high - low)
        gain, offer = low - floor[self.dim], high - floor[self.dim]
        order = np.argsort(-offer.max(1), kind="stable")
        kind = np.int32 if int(np.abs(offer).sum(0).max()) < 1 << 30 else np.int64
        gain = gain.astype(kind)
        sums = np.zeros((n, len(qs)), kind)
        posted, done = np.cumsum(self.size[order]), 0
        found: list[tuple | None] = [None] * len(qs)
        for share in CHECKS:
            stop = int(np.searchsorted(posted, share * posted[-1] - 0.5)) + 1
            for s in order[done:stop]:
                sums[self.ids[s]] += gain[s]
            done, left = stop, order[stop:]
            # What a row may still get from each dimension: its largest open segment or, where the row's segment is
            # done, the quantisation's slack.
            reach = slack.copy()
            np.maximum.at(reach, self.dim[left], offer[left])
            reach = reach.sum(0)
            for i in [i for i, x in enumerate(found) if x is None]:
                mine = np.ascontiguousarray(sums[:, i]).astype(np.int64)
                mine[own[i]] = -(1 << 60)
                possible = np.arange(n)
                if n > k:
                    bound = np.partition(mine, n - k)[n - k]
                    possible = np.flatnonzero(mine + int(reach[i]) >= bound)
                if share == 1 or len(possible) <= max(4 * k, n // 32):
                    if len(own[i]):
                        possible = np.setdiff1d(possible, own[i])
                    scores = self.rows[possible] @ qs[i]
                    best = np.lexsort((names[possible], -scores))[:k]
                    found[i] = (possible[best], scores[best])
            if all(x is not None for x in found):
                break
        return found


def _matrix(vectors: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def search(vectors: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding",
           candidates_per_block: int = CANDIDATES, queries_per_block: int = QUERIES) -> DataFrame:
    """query_id, rank (from 1), `key`, score: the k best rows of `vectors` for each row of `queries`."""
    usable = lambda df: (df.select(df[key].cast("bigint").alias("id"), quantised(df[vector]).alias("v"))
                         .where(F.col("v").isNotNull() & F.col("id").isNotNull()))
    rows = usable(vectors)
    asked = usable(queries).groupBy("id").agg(F.min("v").alias("v"))
    n_rows, n_asked = rows.count(), asked.count()
    cbs, qbs = max(1, math.ceil(n_rows / candidates_per_block)), max(1, math.ceil(n_asked / queries_per_block))
    block = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = asked.select(block(qbs).alias("qb"), every(cbs).alias("cb"), "id", "v")
    right = rows.select(every(qbs).alias("qb"), block(cbs).alias("cb"), "id", "v")

    def one(qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(qs) and len(cs):
            dims = max(max(map(len, qs["v"])), max(map(len, cs["v"])))
            names = cs["id"].to_numpy(np.int64)
            rows, wanted = _matrix(cs["v"], dims), _matrix(qs["v"], dims)
            asked_ids = qs["id"].to_numpy(np.int64)
            wide_row, wide_query = np.zeros(len(rows), bool), np.zeros(len(wanted), bool)
            large_row, large_query = _largest(rows), _largest(wanted)
            if dims * int(large_row.max()) * int(large_query.max()) >= WALK:
                limit = math.isqrt((WALK - 1) // dims)
                wide_row, wide_query = large_row > limit, large_query > limit

            def listed(q: int, found: np.ndarray, scores: np.ndarray) -> None:
                out.append(pd.DataFrame({"query_id": q, "id": found, "score": scores}))

            for some, others in ((~wide_query, wide_row), (wide_query, np.ones(len(rows), bool))):
                ids, limbs = names[others], _limbs(rows[others])
                at = np.flatnonzero(some) if len(ids) else []
                for i in range(0, len(at), BATCH):
                    scores, fits = full_scores(_limbs(wanted[at[i:i + BATCH]]), limbs)
                    for q, x, fit in zip(asked_ids[at[i:i + BATCH]], scores, fits):
                        able = np.flatnonzero(fit & (ids != q))
                        best = able[np.lexsort((ids[able], ~x[able]))[:k]]
                        listed(q, ids[best], x[best])
            if not wide_row.all() and not wide_query.all():
                names, wanted, asked_ids = names[~wide_row], wanted[~wide_query], asked_ids[~wide_query]
                index = ImpactIndex(rows[~wide_row])
                by_name = np.argsort(names, kind="stable")
                first, last = (np.searchsorted(names[by_name], asked_ids, side) for side in ("left", "right"))
                for i in range(0, len(wanted), BATCH):
                    own = [by_name[a:b] for a, b in zip(first[i:i + BATCH], last[i:i + BATCH])]
                    for q, (at, scores) in zip(asked_ids[i:], index.top(wanted[i:i + BATCH], k, own, names)):
                        listed(q, names[at], scores)
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "id": [], "score": []}).astype("int64")

    best = (left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb"))
            .applyInPandas(one, "query_id bigint, id bigint, score bigint"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return (best.select("*", rank.cast("int").alias("rank")).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(key), "score"))
