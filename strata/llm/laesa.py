"""Vector codes from trained codebooks, entries found with LAESA pivots."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checked, mapped, written
from .intvec import add_groups, distances, finite, integers, matrix, moved, slots

#: Fixed pivots of a part position.
PIVOTS = 4
#: Rows worked on at once.
ROWS = 2048


def pivots(entries: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """``count`` of the entries far from one another: the first, then always the one farthest from those taken."""
    taken = [0]
    nearest = distances(entries, entries[:1])[:, 0]
    while len(taken) < min(count, len(entries)) and nearest.max() > 0:
        taken.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, distances(entries, entries[taken[-1:]])[:, 0])
    return entries[taken]


def nearest(rows: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray,
            entry_pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's nearest entry (ties to the lower index), its squared distance, and how many distances were worked out.

    ``to_pivots`` holds the rows' distances to the pivots, ``entry_pivots``
    the entries'. By the triangle inequality an entry is at least as far as
    the greatest difference of the two; a row tries entries in the order of
    that bound and stops when the bound exceeds its best exact distance. The
    bound is lowered by far more than doubles can be wrong.
    """
    bound = np.zeros((len(rows), len(entries)))
    for p in range(to_pivots.shape[1]):
        np.maximum(bound, np.abs(to_pivots[:, p, None] - entry_pivots[None, :, p]), out=bound)
    bound = np.maximum(bound * (1 - 1e-9) - 1e-6, 0)
    bound *= bound
    order = np.argsort(bound, axis=1, kind="stable")
    best = np.full(len(rows), np.iinfo(np.int64).max)
    code = np.zeros(len(rows), np.int64)
    live, tried = np.arange(len(rows)), np.zeros(len(rows), np.int64)
    for turn in range(len(entries)):
        entry = order[live, turn]
        open_ = bound[live, entry] <= best[live]
        live, entry = live[open_], entry[open_]
        if not len(live):
            break
        tried[live] += 1
        gap = rows[live] - entries[entry]
        d = (gap * gap).sum(axis=1)
        better = (d < best[live]) | ((d == best[live]) & (entry < code[live]))
        best[live[better]], code[live[better]] = d[better], entry[better]
    return code, best, tried


def from_pivots(points: np.ndarray, fixed: np.ndarray) -> np.ndarray:
    return np.sqrt(distances(points, fixed).astype(np.float64))


def prepared(rows: DataFrame, fixed: list[np.ndarray], size: int) -> DataFrame:
    """``rows(id, label, ints)`` as octets, with every part's distances to its position's pivots, worked out this once."""
    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            cut = matrix(batch.column(2), len(fixed) * size)
            far = np.concatenate([from_pivots(cut[:, p * size:(p + 1) * size], f) for p, f in enumerate(fixed)], axis=1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(
                pa.array([line.tobytes() for line in made], pa.binary()) for made in (cut.astype(np.int32), far))],
                ["id", "label", "data", "far"])

    label = rows.schema["label"].dataType.simpleString()
    return written(mapped(rows, run, f"id long, label {label}, data binary, far binary"), "laesa-parts")


def octets(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def coded(batches: Iterator[pa.RecordBatch], books: np.ndarray, fixed: list[np.ndarray]):
    """Runs of prepared rows with, for each part position, its parts, codes and squared distances."""
    size = books.shape[2]
    near = [from_pivots(book, f) for book, f in zip(books, fixed)]
    ends = np.cumsum([0, *map(len, fixed)])
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            data, far = octets(part.column("data"), np.int32).astype(np.int64), octets(part.column("far"), np.float64)
            found = []
            for p, book in enumerate(books):
                rows = data[:, p * size:(p + 1) * size]
                found.append((rows, *nearest(rows, far[:, ends[p]:ends[p + 1]], book, near[p])))
            yield part, found


def learned(table: DataFrame, books: np.ndarray, fixed: list[np.ndarray], rounds: int) -> np.ndarray:
    """Codebooks after ``rounds`` rounds over the prepared rows; a round sends one sum for each component of an entry."""
    for _ in range(rounds):
        def run(batches: Iterator[pa.RecordBatch], books=books):
            parts, entries, size = books.shape
            totals = np.zeros((parts, entries, size + 1), np.int64)
            for _, found in coded(batches, books, fixed):
                for p, (rows, code, _, _) in enumerate(found):
                    add_groups(totals[p], code, rows)
            yield slots(totals)

        after = moved(mapped(table, run, "slot long, total long"), books)
        if (after == books).all():  # nothing moves any more
            break
        books = after
    return books


def compressed(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096,
               id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """``(id, label, code, error, tried)`` of every kept vector, and the codebooks (part, entry, component).

    Kept are vectors that are not null and hold no null or non-finite
    component; x becomes floor(scale * x). A vector is cut into ``parts`` equal
    parts; each position's codebook starts as those parts of the kept vectors
    with the ``entries`` smallest ids (repeated ids by their components; a
    null id never starts an entry; fewer vectors give fewer entries). A round
    gives every part to its nearest entry (ties to the lower index) and moves
    an entry to the floor of its parts' mean; unused ones stay. ``code`` has an
    index for each part, ``error`` the squared distances' sum, ``tried`` the
    exact distances worked out. The width is that of the vector with the
    smallest id, a multiple of ``parts``; a kept vector of another width can't
    be coded and is returned with null code, error and tried. Every row is
    returned once for each time it occurs; an empty table gives an empty
    result. Entries are at most ``entries`` x width numbers, all that tasks
    and driver exchange.
    """
    kept = (vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
                           F.col(vec_col).cast("array<double>").alias("v")).where(finite(F.col("v"))))
    first = kept.where("id IS NOT NULL").orderBy("id", "v").select("v").first()
    width = len(first.v) if first else 0
    if width % parts:
        raise ValueError(f"{width} components can't be cut into {parts} equal parts")
    size = width // parts
    other = kept.select("id", "label", F.lit(None).cast("array<int>").alias("code"),
                        F.lit(None).cast("long").alias("error"), F.lit(None).cast("int").alias("tried"))
    if not width:
        return other, np.empty((parts, 0, 0), np.int64)
    other = other.where(F.size(kept["v"]) != width)
    rows = kept.where(F.size("v") == width).select("id", "label", integers(F.col("v"), scale, width).alias("ints"))
    start = rows.where("id IS NOT NULL").orderBy("id", "ints").limit(entries).collect()
    books = np.array([r.ints for r in start], np.int64).reshape(len(start), parts, size).transpose(1, 0, 2).copy()
    fixed = [pivots(book) for book in books]
    table = prepared(rows, fixed, size)
    books = learned(table, books, fixed, rounds)

    def run(batches: Iterator[pa.RecordBatch]):
        for part, found in coded(batches, books, fixed):
            codes = np.stack([code for _, code, _, _ in found], axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                part.column("id"), part.column("label"),
                pa.ListArray.from_arrays(np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1], codes.reshape(-1)),
                pa.array(sum(d for _, _, d, _ in found), pa.int64()),
                pa.array(sum(t for _, _, _, t in found), pa.int32())], ["id", "label", "code", "error", "tried"])

    label = rows.schema["label"].dataType.simpleString()
    done = mapped(table, run, f"id long, label {label}, code array<int>, error long, tried int")
    return written(done.union(other), "laesa-codes"), books


def digest(books: np.ndarray) -> str:
    """sha256 of all entries' components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def report(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """Every vector's code in hexadecimal, its error, the error of its label (nulls together) and the codebooks' digest."""
    labels = written(codes.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error")),
                     "laesa-labels")
    other = checked(labels.withColumnRenamed("label", "other"))
    text = F.array_join(F.transform("code", lambda c: F.lpad(F.lower(F.hex(c.cast("long"))), 2, "0")), "")
    return codes.join(other, F.col("label").eqNullSafe(F.col("other"))).select(
        F.col("id").alias("vec_id"), text.alias("code"), "error", "label_error",
        F.lit(digest(books)).alias("codebooks_sha256"))
