"""Hard-negative mining with one candidate list for each cluster of anchors.

Anchors are gathered into clusters around unit centroids. With the angle ``t`` between a candidate and a centroid and
the widest angle ``w`` between the centroid and its members, no member's cosine with the candidate exceeds
``cos(max(0, t - w))``. A shard of candidates is therefore sorted once for each cluster, by the candidate's length
times that bound, and every member walks this one list in growing steps. A member ends its walk when the bound of all
that follows is below the score that it still needs: the ``k``-th best found, or the least score its query admits.
Bounds are widened by more than the rounding error, so the walk returns exactly what a full scan would.

The search runs twice over all rows. First, each anchor's positives: its best rows of the same label. Then, for each
anchor and positive, the best rows of another label whose score lies between ``low`` percent of the positive's score
and ``high`` percent. The walk of one shard returns at most ``k`` rows a query; Spark merges them by a ranked window.

Scale: candidates are read in shards of ``shard_rows`` rows. Anchors are the stated query set; blocks of at most about
``block`` of them, whole clusters where they fit, are broadcast one after another, each block against all rows, and
released. The centroids are fitted on at most ``fit_rows`` anchors (those with the least hashes of their ids); that
only changes how long walks are. Nothing that grows with the table is broadcast or gathered in one task.

Scores are inner products of the integers ``floor(scale * x)``. They are computed in doubles where the vectors'
lengths prove every sum below 2**53, else with Python integers; scores beyond 64 bits count as the nearest 64-bit number.

Edge cases: rows with a null label, a null vector, or any null or non-finite component take no part; a null id comes
last among equal scores and is no anchor; vectors of unlike lengths are filled up with zeros, an empty vector scores 0;
repeated rows are rows of their own (a copy of the anchor is one of its positives); a component that ``scale`` takes
beyond doubles counts as non-finite; an anchor without positives, or a positive without negatives in its range (so any
negative score, whose range is empty), gives no rows; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm.frames import stored

EXACT = float(2**53)
LONG = 2**63 - 1
SLACK = 1e-6  # of a cosine; doubles err by less than 1e-12 here
MEMBERS, STEP = 256, 2048  # anchors that walk together, most candidates of a step
HITS = "query long, score long, candidate long, vec_id long, anchor_id long, positive_id long, positive_score long"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _matrix(column: pa.Array, scale: float) -> np.ndarray:
    """Rows of floor(scale * x) as doubles, zero-padded to the longest."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    off = np.asarray(column.offsets)
    flat = np.floor(scale * np.asarray(column.values.cast(pa.float64())))
    size = np.diff(off)
    out = np.zeros((len(size), int(size.max(initial=0))))
    out[np.arange(out.shape[1])[None, :] < size[:, None]] = flat[off[0] : off[-1]]
    return out


def _wide(x: np.ndarray, dims: int) -> np.ndarray:
    return np.pad(x, ((0, 0), (0, dims - x.shape[1]))) if x.shape[1] < dims else x


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: doubles if every sum stays below 2**53, else Python integers."""
    with np.errstate(over="ignore", invalid="ignore"):
        if np.sqrt((a * a).sum(1).max(initial=0)) * np.sqrt((b * b).sum(1).max(initial=0)) < EXACT:
            return (a @ b.T).astype(np.int64)
    a, b = (np.array([int(x) for x in m.flat], dtype=object).reshape(m.shape) for m in (a, b))
    return np.clip(a.dot(b.T), -LONG, LONG).astype(np.int64)


def units(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(directions, lengths) of rows; the zero vector has no direction."""
    top = np.abs(x).max(1, initial=0)
    y = x / np.where(top > 0, top, 1)[:, None]  # squares of huge components would overflow
    n = np.sqrt((y * y).sum(1))
    return y / np.where(n > 0, n, 1)[:, None], n * top


def centroids(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means from evenly spaced starts; directions as rows."""
    u, _ = units(x)
    c = u[np.linspace(0, len(u) - 1, k).astype(int)]
    for _ in range(rounds):
        at = np.argmax(u @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, at, u)
        c = np.where((np.abs(sums).sum(1) > 0)[:, None], units(sums)[0], c)
    return c


class Anchors:
    """A block of anchors in clusters with their queries, and the search of one shard of candidates.

    ``queries`` holds arrays (anchor row, least score, greatest score, the positive's id and score); without it each
    anchor has one open query.
    """

    def __init__(self, rows: pa.Table, scale: float, queries=None):
        self.uid, self.label, self.vectors = _rows(rows, scale)
        self.vec_id, cluster = rows["vec_id"].combine_chunks(), rows["cluster"].to_numpy()
        uid, vectors = self.uid, self.vectors
        self.directions, self.lengths = units(vectors)
        if queries is None:
            n = len(uid)
            queries = np.arange(n), np.full(n, -LONG), np.full(n, LONG), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64())
        self.owner, self.low, self.high, self.positive, self.positive_score = queries
        order = np.argsort(cluster, kind="stable")
        self.clusters = np.split(order, np.flatnonzero(np.diff(cluster[order])) + 1) if len(order) else []
        by = np.argsort(self.owner, kind="stable")
        self.queries_of = by, np.searchsorted(self.owner[by], np.arange(len(uid) + 1))

    def search(self, uid: np.ndarray, rank: np.ndarray, label: np.ndarray, vectors: np.ndarray, k: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, candidate row, score) of the best ``k`` admitted candidates of each query; ``rank`` orders equal scores."""
        dims = max(vectors.shape[1], self.vectors.shape[1])
        mine, vectors, directions = _wide(self.vectors, dims), _wide(vectors, dims), _wide(self.directions, dims)
        d, n = units(vectors)
        out = []
        for members in self.clusters:
            middle = units(directions[members].sum(0, keepdims=True))[0][0]
            widest = np.arccos(np.clip((directions[members] @ middle).min() - SLACK, -1, 1))
            angle = np.arccos(np.clip(d @ middle + SLACK, -1, 1))
            bound = n * (np.cos(np.maximum(0, angle - widest)) + SLACK)
            walk = np.lexsort((rank, -bound))  # the cluster's list
            for a in range(0, len(members), MEMBERS):
                part = members[a : a + MEMBERS]
                by, at = self.queries_of
                mine_q = np.concatenate([by[at[i] : at[i + 1]] for i in part])
                if len(mine_q):
                    out.append(self._walk(mine_q, walk, bound[walk], mine, vectors, uid, rank, label, k, same))
        return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.empty(0, np.int64),) * 3

    def _walk(self, queries, walk, bound, mine, vectors, uid, rank, label, k, same):
        """Walk one list with some members' queries, in steps that double; each query ends when the bound proves it done."""
        low, high, owner = self.low[queries], self.high[queries], self.owner[queries]
        need = _below(low)
        active = np.arange(len(queries))
        q, c, s = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
        at, step = 0, 64
        while at < len(walk):
            with np.errstate(over="ignore", invalid="ignore"):
                most = bound[at] * self.lengths[owner[active]]
                active = active[~(most + np.abs(most) * 1e-9 < need[active])]
            if not len(active):
                break
            rows = walk[at : at + step]
            who, of = np.unique(owner[active], return_inverse=True)
            allowed = (self.label[who][:, None] == label[rows][None, :]) == same
            if same:
                allowed &= self.uid[who][:, None] != uid[rows][None, :]
            scores = dots(mine[who], vectors[rows])[of]
            hit = allowed[of] & (scores >= low[active][:, None]) & (scores <= high[active][:, None]) & (scores >= need[active][:, None])
            i, j = np.nonzero(hit)
            if len(i):
                q, c, s = np.r_[q, active[i]], np.r_[c, rows[j]], np.r_[s, scores[i, j]]
                order = np.lexsort((rank[c], -s, q))
                q, c, s = q[order], c[order], s[order]
                place = np.arange(len(q)) - np.searchsorted(q, q)
                q, c, s, place = (x[place < k] for x in (q, c, s, place))
                full = place == k - 1
                need[q[full]] = np.maximum(need[q[full]], _below(s[full]))
            at, step = at + len(rows), min(2 * step, STEP)
        return queries[q], c, s


def _below(scores: np.ndarray) -> np.ndarray:
    """A double that is at most each score, whatever the rounding."""
    x = scores.astype(float)
    return x - np.abs(x) * 1e-12 - 1


def _rows(table: pa.Table | pa.RecordBatch, scale: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return table["uid"].to_numpy(), table["label"].to_numpy(), _matrix(table["v"], scale)


def _searcher(anchors, k: int, same: bool, scale: float, shard_values: int):
    """Arrow function over candidate rows: the hits of each shard."""

    def shard(table: pa.Table) -> pa.RecordBatch:
        uid, label, vectors = _rows(table, scale)
        ids = table["vec_id"].combine_chunks()
        null = np.asarray(ids.is_null())
        rank = np.empty(len(uid), np.int64)
        rank[np.lexsort((uid, np.asarray(ids.fill_null(0)), null))] = np.arange(len(uid))
        block = anchors.value
        q, c, s = block.search(uid, rank, label, vectors, k, same)
        at = pa.array(q, pa.int64())
        columns = [q, s, uid[c], ids.take(pa.array(c, pa.int64())), block.vec_id.take(pa.array(block.owner[q], pa.int64())), block.positive.take(at), block.positive_score.take(at)]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=[f.split()[0] for f in HITS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, values = [], 0
        for b in batches:
            held.append(b)
            values += len(b["v"].values) + len(b)
            if values >= shard_values:
                yield shard(pa.Table.from_batches(held))
                held, values = [], 0
        if held:
            yield shard(pa.Table.from_batches(held))

    return run


def _best(rows: DataFrame, block: Anchors, k: int, same: bool, scale: float, shard_values: int, name: str) -> DataFrame:
    """(query, score, candidate, vec_id, rank): the shards' hits merged, written, and the broadcast released."""
    sent = rows.sparkSession.sparkContext.broadcast(block)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "candidate")
    hits = rows.mapInArrow(_searcher(sent, k, same, scale, shard_values), HITS)
    out = stored(hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), name)
    sent.destroy()
    return out


def usable(vectors: DataFrame, scale: float, shard_rows: int, vec_id: str, vector: str, label: Column | str) -> DataFrame:
    """(uid, vec_id, label, v) of the rows that take part, dealt to shards and written once."""
    label = F.col(label) if isinstance(label, str) else label
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x * scale) == float("inf")))
    rows = rows.where(F.col("label").isNotNull() & F.col("v").isNotNull() & ~F.coalesce(odd, F.lit(False)))
    n = rows.count()
    cores = rows.sparkSession.sparkContext.defaultParallelism
    shards = max(1, -(-n // shard_rows), min(cores, n >> 10))
    return stored(rows.repartition(shards).select(F.monotonically_increasing_id().alias("uid"), "*"), "hard-negatives-rows")


def clustered(anchors: DataFrame, size: int, fit_rows: int, scale: float) -> DataFrame:
    """The anchors with ``cluster``: the nearest of centroids, about ``size`` anchors each, at most 256 clusters."""
    n, dims = anchors.agg(F.count("*"), F.max(F.size("v"))).first()
    k = max(1, min(256, n // size))
    fit_rows = max(k, min(fit_rows, (1 << 20) // max(1, dims or 1)))
    sample = _matrix(anchors.orderBy(F.xxhash64("vec_id", "uid"), "uid").limit(fit_rows).select("v").toArrow()["v"], scale)
    c = centroids(sample, min(k, max(1, len(sample)))) if len(sample) else np.zeros((1, 1))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = units(_matrix(b["v"], scale))[0]
            m = max(d.shape[1], c.shape[1])
            yield b.append_column("cluster", pa.array(np.argmax(_wide(d, m) @ _wide(c, m).T, axis=1), pa.int64()))

    return anchors.mapInArrow(assign, "uid long, vec_id long, label long, v array<double>, cluster long")


def blocks(anchors: DataFrame, block: int) -> list[list[tuple[int, int, int]]]:
    """Blocks of about ``block`` anchors at most, as lists of (cluster, pieces of that cluster, piece)."""
    out, filled = [[]], 0
    for cluster, n in sorted(tuple(r) for r in anchors.groupBy("cluster").count().collect()):
        pieces = -(-n // block)
        for piece in range(pieces):
            if filled and filled + n // pieces > block:
                out, filled = [*out, []], 0
            out[-1].append((cluster, pieces, piece))
            filled += n // pieces
    return [x for x in out if x]


def mine(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: Column | str = "label",
    positives: int = 5,
    negatives: int = 5,
    low: int = 80,
    high: int = 100,
    scale: float = 256.0,
    cluster_size: int = 64,
    fit_rows: int = 8192,
    block: int = 8192,
    shard_rows: int = 16384,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor and positive.

    ``is_anchor`` is a condition on the column ``vec_id`` of the rows that take part.
    """
    rows = usable(vectors, scale, shard_rows, vec_id, vector, label)
    anchors = stored(clustered(rows.where(is_anchor & F.col("vec_id").isNotNull()), cluster_size, fit_rows, scale), "hard-negatives-anchors")
    shard_values = shard_rows * 64
    found = []
    for parts in blocks(anchors, block):
        inside = F.lit(False)
        for cluster, pieces, piece in parts:
            inside |= (F.col("cluster") == cluster) & (F.pmod(F.xxhash64("uid"), F.lit(pieces)) == piece)
        held = anchors.where(inside).orderBy("uid").toArrow()
        near = _best(rows, Anchors(held, scale), positives, True, scale, shard_values, "hard-negatives-positives")
        pairs = near.orderBy("query", "rank").toArrow().combine_chunks()  # ``positives`` for each anchor of the block at most
        scores = [int(x) for x in pairs["score"].to_pylist()]
        least, most = ([min(LONG, max(-LONG, x)) for x in xs] for xs in ([-(-low * x // 100) for x in scores], [high * x // 100 for x in scores]))
        queries = pairs["query"].to_numpy(), np.array(least, np.int64), np.array(most, np.int64), pairs["vec_id"].combine_chunks(), pairs["score"].combine_chunks()
        asked = Anchors(held, scale, queries)
        far = _best(rows, asked, negatives, False, scale, shard_values, "hard-negatives-negatives")
        found.append(far)
    if not found:
        return rows.sparkSession.createDataFrame([], RESULT)
    out = reduce(DataFrame.unionByName, found)
    return out.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
