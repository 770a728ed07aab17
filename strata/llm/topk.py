"""Exact top-k inner-product search with MaxScore over vector components."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import mapped, release, written

#: Bytes of components in a shard of the candidates, and in a block of queries, at eight bytes a component; rows of either.
SHARD_BYTES = 4 << 20
QUERY_BYTES = 2 << 20
BLOCK_ROWS = 8192
#: Bytes of query blocks, and results kept, that a task holds; groups of shards, each of which gives k rows a query.
LANE_BYTES = 4 << 20
LANE_RESULTS = 1 << 18
GROUPS = 32
#: Queries and rows whose scores are worked out at once.
QUERIES, ROWS = 512, 2048
#: Rows of a query looked into together for competitive ones.
SPAN = 256
#: Rows a result whose whole scores give a first threshold; rows on which the essential lists are tried before all are.
FIRST, TRIED = 64, 256
#: Non-essential components probed between two tests of what is still competitive.
PROBE = 8
#: Above one competitive row in so many, plain sums cost less than probing.
SPARSE = 16
#: Components of pairs of a row and a query multiplied at once.
PAIRED = 1 << 21


def quantised(vectors: DataFrame, id_col: str, vec_col: str, scale: int) -> DataFrame:
    """``(id, ints)``; rows whose vector is null or holds null or non-finite components are left out."""
    x = F.col("v")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & x.isNotNull()).where(~bad)
            .select("id", F.transform(x, lambda c: F.floor(F.lit(scale) * c)).alias("ints")))


def matrix(column: pa.ListArray) -> np.ndarray:
    """Rows of a list column as one matrix; shorter vectors are padded with zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = np.diff(column.offsets.to_numpy())
    width = int(sizes.max(initial=0))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def narrow(m: np.ndarray) -> np.ndarray:
    """The same numbers as the smallest integers that hold them all."""
    low, high = int(m.min(initial=0)), int(m.max(initial=0))
    fits = (t for t in (np.int8, np.int16, np.int32) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    return m.astype(next(fits, np.int64))


def reach(m: np.ndarray) -> int:
    return max(1, int(m.max(initial=0)), -int(m.min(initial=0)))


def packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of about ``size`` bytes: ids and component matrix as bytes. Made where the rows lie, without a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            names = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            m = matrix(batch.column(1))
            rows = max(1, min(BLOCK_ROWS, size // max(8, 8 * m.shape[1])))
            for at in range(0, len(names), rows):
                ids, data = names[at:at + rows].tobytes(), narrow(m[at:at + rows]).tobytes()
                yield pa.RecordBatch.from_pydict({"width": pa.array([m.shape[1]], pa.int32()),
                                                  "ids": pa.array([ids], pa.binary()), "data": pa.array([data], pa.binary())})

    return mapped(rows, run, "width int, ids binary, data binary")


def unpack(width: int, ids: bytes, data: bytes) -> tuple[np.ndarray, np.ndarray]:
    names = np.frombuffer(ids, np.int64)
    size = len(data) // max(1, len(names) * width) or 8
    return names, np.frombuffer(data, np.dtype(f"i{size}")).reshape(len(names), width)


def above(scores: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the scores that reach their row's least; looks only into spans whose highest does."""
    size = scores.shape[1]
    span = SPAN if size % SPAN == 0 else size
    spans, least = scores.reshape(-1, span), np.repeat(least, size // span)
    some = np.flatnonzero(spans.max(axis=1) >= least)
    hit = np.flatnonzero(spans[some] >= least[some, None])
    place = some[hit // span] * span + hit % span
    return place // size, place % size


class Shard:
    """Postings of a shard: for each component the values of all its rows, with score bounds; rows by id."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        self.high = rows.max(axis=0).astype(np.float64)
        self.low = rows.min(axis=0).astype(np.float64)
        self.reach = reach(rows)
        self.kept: dict[type, np.ndarray] = {}

    def lists(self, kind: type) -> np.ndarray:
        if kind not in self.kept:
            self.kept[kind] = np.ascontiguousarray(self.rows.T, dtype=kind)
        return self.kept[kind]

    def whole(self, queries: np.ndarray, rows: slice | np.ndarray) -> np.ndarray:
        """Scores of all these queries and rows, summed in floats where those hold every sum exactly."""
        width = queries.shape[1]
        kind = np.float64 if reach(queries) * self.reach * width < 1 << 53 else np.int64
        return (queries.astype(kind) @ np.ascontiguousarray(self.rows[rows, :width].T, dtype=kind)).astype(np.int64)

    def pairs(self, queries: np.ndarray, of: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Scores of pairs of a query and a row."""
        score, width = np.empty(len(of), np.int64), queries.shape[1]
        step = max(1, PAIRED // max(1, width))
        for at in range(0, len(of), step):
            some, its = queries[of[at:at + step]], self.rows[rows[at:at + step], :width]
            score[at:at + step] = np.einsum("ij,ij->i", some.astype(np.int64), its.astype(np.int64))
        return score

    def top(self, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the k best rows, smaller ids first among equals."""
        best = Best(np.array([own], np.int64), query[None, :], k)
        best.meet(self)
        return best.found, best.scores


class Best:
    """The k best rows of the shards met so far for each of some queries, smaller ids first among equals."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.queries, self.k = ids, queries, k
        self.of = self.found = self.scores = np.empty(0, np.int64)
        self.full = np.zeros(len(ids), bool)  # queries with k rows, whose worst has this score and id
        self.least, self.last = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)

    def meet(self, shard: Shard) -> None:
        """Takes in a shard's rows.

        Components play the terms: a component's list holds its value for
        each row, and its bound is how far its products spread in this shard.
        The threshold is the k-th best score so far, carried from shard to
        shard. Queries that no row of the shard can lift over theirs skip it.
        The components with the smallest bounds that together can't lift a row
        over the threshold are non-essential; the essential lists are summed
        for all rows, the others only for rows still competitive. These sums
        are floats of single precision where those hold the components, with
        their error added to the bounds; who stays is scored in integers.
        """
        width = min(self.queries.shape[1], shard.rows.shape[1])
        q = self.queries[:, :width]
        kind = np.float32 if max(reach(q), shard.reach) < 1 << 24 else np.float64
        first, known = self.first(shard, q)
        limit = np.where(self.full, self.least, first)
        high, low = q * shard.high[:width], q * shard.low[:width]
        most, least = np.maximum(high, low), np.minimum(high, low)
        error = np.maximum(np.abs(most), np.abs(least)).sum(axis=1) * (4 * (width + 8) * float(np.finfo(kind).eps))

        def cut() -> np.ndarray:
            score = np.where(self.full | known, limit.astype(np.float64), -np.inf)
            return score - error - np.abs(limit.astype(np.float64)) * 1e-15

        live = np.flatnonzero(most.sum(axis=1) >= cut())
        if not len(live):
            return
        weight, lists, most, least = q[live].astype(kind), shard.lists(kind)[:width], most[live], least[live]
        order = np.argsort(-(most - least).sum(axis=0), kind="stable")  # widest spread first

        def bar(at: int) -> np.ndarray:
            """Least sums of the first lists, rounded down, with which a row is competitive."""
            return np.nextafter((cut()[live] - most[:, order[at:]].sum(axis=1)).astype(kind), kind(-np.inf))

        # essential: as many lists as it takes until what the rest adds is below the threshold, for the median query
        some = slice(None, None, 1 + len(live) // 64)
        base = most[some].sum(axis=1)[:, None] - np.cumsum((most - least)[some][:, order], axis=1)  # a row at its lowest so far
        at = min(width, int(np.median((base >= cut()[live][some, None]).sum(axis=1))) + 1)
        if at * 4 < width * 3:
            essential = np.ascontiguousarray(lists[order[:at]])
            heavy = weight[:, order[:at]]
            if np.count_nonzero(heavy @ essential[:, :TRIED] >= bar(at)[:, None]) * SPARSE > len(live) * min(TRIED, lists.shape[1]):
                at = width
        else:  # nearly all: plain sums cost less than probing the rest
            at = width
        new: list[tuple[np.ndarray, ...]] = []
        for start in range(0, len(shard.ids), ROWS):
            rows = slice(start, start + ROWS)
            score, least_sum = weight @ lists[:, rows] if at == width else heavy @ essential[:, rows], bar(at)
            of, row = above(score, least_sum)
            if at < width:
                score = score[of, row]
                for probe in range(at, width, PROBE):
                    step = order[probe:probe + PROBE]
                    score = score + np.einsum("ij,ji->i", weight[:, step][of], lists[step][:, row + start])
                    keep = score >= bar(probe + PROBE)[of]
                    of, row, score = of[keep], row[keep], score[keep]
            of = live[of]
            if len(of) * SPARSE > len(live) * ROWS:
                score = shard.whole(q, rows)[of, row]
            else:
                score = shard.pairs(q, of, row + start)
            names = shard.ids[row + start]
            keep = ~(self.full | known)[of] | (score > limit[of]) | (
                score == limit[of]) & (~self.full[of] | (names < self.last[of]))
            keep &= names != self.ids[of]
            new.append((of[keep], names[keep], score[keep]))
            if sum(len(x) for x, _, _ in new) > len(live) * self.k or start + ROWS >= len(shard.ids):
                self.add(*map(np.concatenate, zip(*new)))
                new = []
            limit = np.where(self.full, self.least, first)

    def first(self, shard: Shard, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A first threshold for queries without k rows yet, and which have it: the k-th best of some rows' whole scores."""
        score, known = np.zeros(len(q), np.int64), np.zeros(len(q), bool)
        new, some = np.flatnonzero(~self.full), min(len(shard.ids), FIRST * self.k)
        if not len(new) or some < self.k:
            return score, known
        rows = np.arange(some) * len(shard.ids) // some
        none = np.iinfo(np.int64).min
        found = np.where(shard.ids[rows] == self.ids[new][:, None], none, shard.whole(q[new], rows))
        score[new] = np.partition(found, some - self.k, axis=1)[:, some - self.k]
        known[new] = score[new] != none
        return score, known

    def add(self, of: np.ndarray, names: np.ndarray, scores: np.ndarray) -> None:
        if not len(of):
            return
        hit = np.zeros(len(self.ids), bool)
        hit[of] = True
        mine = hit[self.of]
        new = [np.concatenate((a[mine], b)) for a, b in ((self.of, of), (self.found, names), (self.scores, scores))]
        order = np.lexsort((new[1], ~new[2], new[0]))
        of, names, scores = (x[order] for x in new)
        rank = np.arange(len(of)) - np.searchsorted(of, of)
        worst = rank == self.k - 1
        self.full[of[worst]], self.least[of[worst]], self.last[of[worst]] = True, scores[worst], names[worst]
        keep = rank < self.k
        self.of, self.found, self.scores = (np.concatenate((a[~mine], b[keep])) for a, b in (
            (self.of, of), (self.found, names), (self.scores, scores)))


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
           vec_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k highest integer inner products.

    Components become floor(scale * x). Candidates are all rows but the one
    with the query's id; ties go to the smaller id; fewer rows give fewer
    results. Candidates are packed into shards where they lie, queries into
    blocks. Every block meets every shard: tasks are pairs of a group of
    shards and a lane of blocks, which each task reads for itself, so no
    table is broadcast or repeated on disk and the driver holds no vectors.
    A task keeps k rows a query and carries its thresholds through its
    shards; at most GROUPS such results a query are merged by rank. Null ids,
    null vectors and vectors with null or non-finite components take no part;
    a shorter vector counts as padded with zeros (an empty one scores 0); a
    repeated row is a candidate as often as it occurs and one query; an empty
    table gives an empty result. Sums are exact while they fit a long.
    """
    shards = written(packed(quantised(vectors, id_col, vec_col, scale), SHARD_BYTES)
                     .withColumn("number", F.monotonically_increasing_id()), "topk-shards")
    asked = written(packed(quantised(queries, id_col, vec_col, scale).distinct().coalesce(GROUPS), QUERY_BYTES)
                    .toDF("q_width", "q_ids", "q_data").withColumn("q_number", F.monotonically_increasing_id()), "topk-queries")
    blocks, names, held = asked.agg(F.count("*"), F.sum(F.length("q_ids") / 8), F.sum(F.length("q_data"))).first()
    cores = vectors.sparkSession.sparkContext.defaultParallelism
    groups = max(1, min(GROUPS, shards.rdd.getNumPartitions()))
    lanes = max(1, math.ceil((names or 0) * k / LANE_RESULTS), math.ceil((held or 0) / LANE_BYTES),
                min(blocks, math.ceil(2 * cores / groups)))

    def run(batches: Iterator[pa.RecordBatch]):
        best: dict[int, list[Best]] = {}
        number = shard = None
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name, b=batch, r=row: b.column(name)[r].as_py()
                if get("number") != number:
                    release()  # what was freed between results that stay
                    number, shard = get("number"), Shard(*unpack(get("width"), get("ids"), get("data")))
                if get("q_number") not in best:
                    ids, rows = unpack(get("q_width"), get("q_ids"), get("q_data"))
                    best[get("q_number")] = [Best(ids[at:at + QUERIES], rows[at:at + QUERIES], k)
                                             for at in range(0, len(ids), QUERIES)]
                for some in best[get("q_number")]:
                    some.meet(shard)
        for some in chain.from_iterable(best.values()):
            yield pa.RecordBatch.from_pydict({"query_id": pa.array(some.ids[some.of]), "vec_id": pa.array(some.found),
                                              "score": pa.array(some.scores)})

    met = shards.coalesce(GROUPS).crossJoin(asked.repartition(lanes).hint("shuffle_replicate_nl"))
    found = mapped(met, run, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
