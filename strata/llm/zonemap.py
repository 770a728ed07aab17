"""Centroid clustering with Hilbert-ordered blocks and min/max boxes."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mapped, written
from .intvec import add_groups, distances, finite, integers, matrix, moved, slots

#: Bytes of components in a block.
BLOCK_BYTES = 64 << 10
#: Bits of a component in its Hilbert cell; the cells span the mean and SPREAD standard deviations on both sides.
BITS = 2
SPREAD = 2.0
BLOCK = "width int, ids array<bigint>, data binary, low binary, high binary, total binary"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of ``cells`` (below 2**bits) on the Hilbert curve, as octets whose order is the curve's.

    The axes are turned into the transposed Hilbert index for all rows at
    once: exchange and invert from the highest bit down, then Gray encode.
    """
    x = cells.T.astype(np.uint32)
    dims = len(x)
    for bit in range(bits - 1, 0, -1):
        top, rest = np.uint32(1 << bit), np.uint32((1 << bit) - 1)
        for axis in range(dims):
            inverts = (x[axis] & top) != 0
            swap = np.where(inverts, np.uint32(0), (x[0] ^ x[axis]) & rest)
            x[axis] ^= swap
            x[0] ^= np.where(inverts, rest, swap)
    for axis in range(1, dims):
        x[axis] ^= x[axis - 1]
    flip = np.zeros(x.shape[1], np.uint32)
    for bit in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> np.uint32(bit)) & 1, np.uint32((1 << bit) - 1), np.uint32(0))
    x ^= flip
    planes = np.concatenate([(x >> np.uint32(bit)) & 1 for bit in range(bits - 1, -1, -1)])
    return np.packbits(planes.T.astype(np.uint8), axis=1)


def blocks(rows: DataFrame, width: int) -> DataFrame:
    """``rows(id, ints)`` as blocks of neighbours on the Hilbert curve, each with its box and component sums.

    Rows are range-partitioned and sorted by their place on the curve and a
    hash of the id, so equal vectors, however many, are cut like any others.
    """
    spread = rows.select(F.posexplode("ints").alias("at", "x")).groupBy("at").agg(
        F.avg("x").alias("mean"), F.stddev_pop("x").alias("deviation"))
    shape = {r["at"]: (r["mean"], r["deviation"]) for r in spread.collect()}
    mean = np.array([shape.get(i, (0.0, 0.0))[0] for i in range(width)])
    step = np.array([2 * SPREAD * shape.get(i, (0.0, 0.0))[1] or 1.0 for i in range(width)])

    def places(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            share = (matrix(batch.column(1), width) - mean) / step + 0.5
            cells = np.clip(np.floor(share * (1 << BITS)), 0, (1 << BITS) - 1)
            keys = [k.tobytes() for k in hilbert(cells, BITS)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.binary())],
                                             ["id", "ints", "place"])

    def pack(batches: Iterator[pa.RecordBatch]):
        size = max(1, BLOCK_BYTES // (4 * max(1, width)))
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                m = matrix(part.column(1), width)
                yield pa.RecordBatch.from_pydict({
                    "width": pa.array([width], pa.int32()),
                    "ids": pa.array([part.column(0).to_pylist()], pa.list_(pa.int64())),
                    **{name: pa.array([made.tobytes()], pa.binary()) for name, made in {
                        "data": m.astype(np.int32), "low": m.min(axis=0), "high": m.max(axis=0),
                        "total": m.sum(axis=0)}.items()}})

    placed = mapped(rows, places, "id long, ints array<bigint>, place binary").withColumn("salt", F.xxhash64("id", "ints"))
    ordered = placed.repartitionByRange("place", "salt").sortWithinPartitions("place", "salt").select("id", "ints")
    return written(mapped(ordered, pack, BLOCK), "zonemap-blocks")


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to some vector in the box, ascending.

    A centroid whose least distance to the box exceeds another's greatest is
    nearest to none; equal ones stay, so ties are settled by exact distances.
    """
    gap = np.maximum(np.maximum(low - centroids, centroids - high), 0)
    far = np.maximum(np.abs(centroids - low), np.abs(centroids - high))
    return np.flatnonzero((gap * gap).sum(1) <= (far * far).sum(1).min())


def _blocks(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for n in range(batch.num_rows):
            read = lambda name, kind, b=batch, n=n: np.frombuffer(b.column(name)[n].as_py(), kind)
            yield batch.column("ids").slice(n, 1).flatten(), read


def _round(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round over the blocks."""
    def run(batches: Iterator[pa.RecordBatch]):
        k, width = centroids.shape
        totals = np.zeros((k, width + 1), np.int64)
        for ids, read in _blocks(batches):
            among = candidates(read("low", np.int64), read("high", np.int64), centroids)
            if len(among) == 1:  # the whole block goes to one centroid: its vectors need no look
                totals[among[0], :-1] += read("total", np.int64)
                totals[among[0], -1] += len(ids)
                continue
            rows = read("data", np.int32).reshape(len(ids), width).astype(np.int64)
            add_groups(totals, among[distances(rows, centroids[among]).argmin(axis=1)], rows)
        yield slots(totals)

    return moved(mapped(table, run, "slot long, total long"), centroids)


def _assigned(table: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(id, cluster, distance)`` of every vector."""
    def run(batches: Iterator[pa.RecordBatch]):
        for ids, read in _blocks(batches):
            among = candidates(read("low", np.int64), read("high", np.int64), centroids)
            rows = read("data", np.int32).reshape(len(ids), centroids.shape[1]).astype(np.int64)
            all_d = distances(rows, centroids[among])
            best = all_d.argmin(axis=1)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(among[best], pa.int32()), pa.array(all_d[np.arange(len(rows)), best], pa.int64())],
                ["id", "cluster", "distance"])

    return mapped(table, run, "id long, cluster int, distance long")


def clusters(vectors: DataFrame, k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, seed: int = 3,
             id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """``(id, cluster, distance)`` of every kept vector, and the final centroids.

    Kept are vectors of exactly ``width`` components, none null or non-finite;
    x becomes floor(scale * x). Centroids start as the k kept vectors whose
    ids have the smallest sha256 of ``<seed>:<id>`` in hexadecimal (repeated
    ids by their components; a null id never starts one; fewer vectors give
    fewer centroids). Each round assigns every vector to the nearest centroid
    (ties to the smaller number) and moves a centroid to the floor of its
    vectors' mean. Rounds end early once nothing moves, as further ones would
    change nothing. Every row counts and is returned once for each time it
    occurs, null ids too; an empty table gives an empty result. The blocks
    are written once; a round reads them and sends k x (width + 1) sums.
    """
    vec = F.col("v")
    rows = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
            .where((F.size(vec) == width) & finite(vec)).select("id", integers(vec, scale, width).alias("ints")))
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.where("id IS NOT NULL").orderBy(order, "ints").limit(k).collect()
    centroids = np.array([r.ints for r in first], np.int64).reshape(len(first), width)
    if not first:
        return rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")).where("false"), centroids
    table = blocks(rows, width)
    for _ in range(rounds):
        after = _round(table, centroids)
        if (after == centroids).all():
            break
        centroids = after
    return written(_assigned(table, centroids), "zonemap-assigned"), centroids


def digest(numbers: np.ndarray) -> str:
    """sha256 of the numbers in decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, numbers.reshape(-1).tolist())).encode()).hexdigest()


def report(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Every vector with its cluster's inertia, the whole inertia and its centroid's digest."""
    inertia = {r.cluster: int(r.total) for r in assigned.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    whole = sum(inertia.values())
    facts = assigned.sparkSession.createDataFrame(
        [(n, inertia.get(n, 0), whole, digest(c)) for n, c in enumerate(centroids)],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select(  # one row a centroid
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
