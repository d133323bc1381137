"""Exact top-k search by inner product: no-random-access aggregation over sorted lists.

Rows are dealt into stripes, and queries into batches; every batch meets every stripe, so the answer is exact. A task takes
its stripe block by block. Of a block, each component is one list, sorted by value. All queries of the batch read the lists in
step, each from the end that is best for it. What a row is sure of (its lower bound) is what was read of it plus the least that each
list not yet read for it holds; what it can reach at most (its upper bound) takes the last value read there instead. With lists
read to a depth, both bounds of all rows and queries are sums of products: the values, raised or cut to what is known of them, times the
queries. A query's bar is its k-th best lower bound, or its k-th best score in the blocks before if that is higher; a row
whose upper bound is below the bar cannot qualify. Reading goes deeper until the rows that still can are few, whose
scores are then resolved in integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a stripe and queries of a batch, which meet in one task; rows whose bounds are held at once.
STRIPE_ROWS, BATCH_QUERIES, BLOCK_ROWS = 16384, 1024, 2048
#: How deep the lists are read, as parts of a block; after the last, every value is known.
DEPTHS = (1 / 16, 1 / 4, 1)
#: As many vector lengths are sent to all executors at most; with more, the counts are joined by a shuffle.
MOST_LENGTHS = 1000
SCALE = 1024
LONGEST = np.iinfo(np.int64)


def quantised(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, x array<long>, copies): floor(scale * component) of the vectors that are whole and finite; rows alike in both are one, with their number.

    A component beyond 64 bits counts as the nearest number of 64 bits.
    """
    whole = F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return (
        vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("v"))
        .filter(F.col("id").isNotNull() & F.col("v").isNotNull() & F.coalesce(whole, F.lit(False)))
        .select("id", F.transform("v", lambda e: F.floor(F.lit(scale) * e.cast("double")).cast("long")).alias("x"))
        .groupBy("id", "x")
        .agg(F.count(F.lit(1)).alias("copies"))
    )


def margins(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """By query, how far a sum of products in 64-bit floats can be from the exact one, for any of the rows x."""
    most = np.abs(x).max(axis=0, initial=0)
    return (np.abs(q) @ most) * (2.0**-52 * 2 * (x.shape[1] + 4))


def candidates(q: np.ndarray, x: np.ndarray, own: np.ndarray, bar: np.ndarray, k: int, depths=DEPTHS) -> np.ndarray:
    """(query, row) pairs that hold at least the k best rows of each query, or those above its bar if fewer; own is each query's row in x, or -1.

    q and x are floats; bar is a score that the query has k rows at or above elsewhere.
    """
    n, d = x.shape
    asks = np.arange(len(q))
    slack = margins(q, x)
    up, down = np.maximum(q, 0).T, np.minimum(q, 0).T
    least, most = x.min(axis=0), x.max(axis=0)
    order = np.sort(x, axis=0)
    few = 4 * k
    live = np.ones((len(q), n), bool)
    mine = own >= 0
    live[asks[mine], own[mine]] = False
    for part in depths:
        depth = min(n, max(1, int(n * part)))
        if depth < n:
            top, bottom = order[n - depth], order[depth - 1]
            upper = np.maximum(x, top) @ up + np.minimum(x, bottom) @ down
            lower = np.where(x >= top, x, least) @ up + np.where(x <= bottom, x, most) @ down
        else:
            lower = upper = x @ q.T
        # Scores end where 64 bits do.
        lower, upper = (np.clip(v.T, -(2.0**63), 2.0**63) for v in (lower, upper))
        lower, upper = lower - slack[:, None], upper + slack[:, None]
        if n > k:
            here = np.partition(np.where(live, lower, -np.inf), n - k, axis=1)[:, n - k]
            bar = np.maximum(bar, here)
        live &= upper >= bar[:, None]
        if live.sum(axis=1).max(initial=0) <= few:
            break
    return np.argwhere(live)


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of the rows of q and x, pair by pair; a score beyond 64 bits is the nearest number of 64 bits."""
    if not len(q):
        return np.zeros(0, np.int64)
    size = (np.abs(q.astype(np.float64)) * np.abs(x.astype(np.float64))).sum(axis=1)
    out = (q * x).sum(axis=1)
    for i in np.flatnonzero(size >= 2.0**62).tolist():
        out[i] = max(LONGEST.min, min(LONGEST.max, sum(a * b for a, b in zip(q[i].tolist(), x[i].tolist(), strict=True))))
    return out


def _array(column, d: int) -> np.ndarray:
    """The vectors of a list column as rows."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), d)


OUT = "query_id long, query_key long, asked long, vec_id long, score long, copies long"


def _search(k: int, block_rows: int):
    names = [x.split()[0] for x in OUT.split(", ")]

    def run(rows: pa.Table, asks: pa.Table) -> pa.Table:
        if not len(rows) or not len(asks):
            return pa.table({c: pa.array([], pa.int64()) for c in names})
        rows = rows.sort_by([("id", "ascending"), ("key", "ascending")])
        d = len(asks.column("q_x")[0])
        whole, asked = _array(rows.column("x"), d), _array(asks.column("q_x"), d)
        ids, keys, copies = (rows.column(c).to_numpy() for c in ("id", "key", "copies"))
        q_id, q_key, q_copies = (asks.column(c).to_numpy() for c in ("q_id", "q_key", "q_copies"))
        q, x = asked.astype(np.float64), whole.astype(np.float64)
        bar = np.full(len(q), -np.inf)
        best = tuple(np.zeros(0, np.int64) for _ in range(4))
        place = {(i, j): n for n, (i, j) in enumerate(zip(ids.tolist(), keys.tolist(), strict=True))}
        # A query's own row, unless that has copies, which are rows like any other.
        own = np.array([place.get(p, -1) for p in zip(q_id.tolist(), q_key.tolist(), strict=True)], np.int64)
        single = np.where(q_copies == 1, own, -1)
        for a in range(0, len(x), block_rows):
            b = min(len(x), a + block_rows)
            here = np.where((single >= a) & (single < b), single - a, -1)
            at, row = candidates(q, x[a:b], here, bar, k).T
            row = row + a
            times = np.minimum(copies[row] - (row == own[at]), k)
            found = (at, ids[row], exact(asked[at], whole[row]), times)
            best = tuple(np.concatenate([u, v]) for u, v in zip(best, found, strict=True))
            o = np.lexsort((best[1], ~best[2], best[0]))
            best = tuple(u[o] for u in best)
            # Rows with copies fill several places.
            first = np.searchsorted(best[0], np.arange(len(q)))
            before = np.cumsum(best[3]) - best[3]
            before -= before[np.minimum(first, len(before) - 1)][best[0]] if len(before) else 0
            keep = (before < k) & (best[3] > 0)
            best, before = tuple(u[keep] for u in best), before[keep]
            full = before + best[3] >= k
            bar = np.full(len(q), -np.inf)
            score = best[2][full].astype(np.float64)
            bar[best[0][full]] = score - np.abs(score) * 2.0**-50
        at, vec, score, times = best
        return pa.table(dict(zip(names, (q_id[at], q_key[at], q_copies[at], vec, score, times), strict=True)))

    return run


def top_k(vectors: DataFrame, k: int = 10, every: int = 100, stripe_rows: int = STRIPE_ROWS, batch_queries: int = BATCH_QUERIES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row whose id is divisible by every.

    vectors: (vec_id, embedding); other columns are not read. Vectors that are null, empty of
    an id, or hold a null or non-finite component take no part. Only vectors of a query's own
    length are its candidates. Every row but the query's own is a candidate, be it alike in id and vector or not; of
    rows alike, each is a query with results of its own. Scores beyond 64 bits count as the nearest number of 64 bits, ties go to the smaller
    id. No rows: no result.
    """
    rows = quantised(vectors).withColumns({"key": F.xxhash64("x"), "dim": F.size("x")})
    count = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("id") % every == 0).alias("m"))
    count = count.select("dim", F.ceil(F.col("n") / stripe_rows).alias("stripes"), F.ceil(F.col("m") / batch_queries).alias("batches"))
    few = len(count.limit(MOST_LENGTHS + 1).collect()) <= MOST_LENGTHS
    rows = rows.join(F.broadcast(count) if few else count, "dim")
    spread = F.xxhash64("id", "key", F.lit(7))
    each = lambda n: F.explode(F.expr(f"sequence(0L, {n} - 1)"))
    data = rows.filter("batches > 0").select("id", "key", "copies", "x", "dim", F.pmod(spread, F.col("stripes")).alias("stripe"), each("batches").alias("batch"))
    asks = rows.filter(F.col("id") % every == 0).select("id", "key", "copies", "x", "dim", F.pmod(spread, F.col("batches")).alias("batch"), each("stripes").alias("stripe"))
    asks = asks.toDF("q_id", "q_key", "q_copies", "q_x", "q_dim", "q_batch", "q_stripe")
    found = data.groupBy("dim", "stripe", "batch").cogroup(asks.groupBy("q_dim", "q_stripe", "q_batch")).applyInArrow(_search(k, block_rows), OUT)
    # A row with copies stands as often as it can count.
    found = found.select("query_id", "query_key", "asked", "vec_id", "score", F.explode(F.expr("sequence(1L, copies)")).alias("copy"))
    best = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score", F.explode(F.expr("sequence(1L, asked)")).alias("copy")).drop("copy")
