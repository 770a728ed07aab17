"""SimHash near-duplicates through one-wildcard segment signatures."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import checked, components, mapped, slices, written

SEED = 42
#: Shingles whose bits are counted at once (64 bytes each while unpacked).
BLOCK = 65536


def fingerprint(text: str | None, shingle_words: int = 4) -> int:
    """64-bit majority fingerprint of a text's word shingles, repeats included.

    A-Z is lower-cased, words are runs without ASCII white space; a text of
    fewer words than a shingle has one shingle, a null text or one without
    words has fingerprint zero.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined, n = b" ".join(words), max(1, len(words) - shingle_words + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(shingle_words, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[at:at + BLOCK], stops[at:at + BLOCK])]
        octets = np.array(part, np.uint64).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = 4) -> DataFrame:
    """``(doc_id, fp)`` of every row, ``fp`` as a signed long."""
    def run(batches):
        for batch in slices(batches):
            marks = [fingerprint(t, shingle_words) for t in batch.column(1).to_pylist()]
            fp = pa.array(np.array(marks, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), fp], ["doc_id", "fp"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return mapped(picked, run, "doc_id long, fp long")


def signatures(max_bits: int) -> list[tuple[int, int, int, int]]:
    """``(segment, bit, offset, mask)`` of every one-wildcard segment variant.

    64 bits are cut into max_bits // 2 + 1 segments, so two fingerprints at
    most ``max_bits`` apart differ by at most one bit in some segment, and
    agree there once that bit is masked out.
    """
    count = max_bits // 2 + 1
    cuts = [64 * i // count for i in range(count + 1)]
    return [(s, bit, lo, ((1 << (hi - lo)) - 1) & ~(1 << bit))
            for s, (lo, hi) in enumerate(zip(cuts, cuts[1:])) for bit in range(hi - lo)]


def links(marks: DataFrame, max_bits: int) -> DataFrame:
    """Edges that connect exactly what pairs of ``marks(fp, n)`` within ``max_bits`` connect.

    Each distinct fingerprint is indexed under its variants. In a bucket every
    fingerprint is compared with the bucket's head (the one most documents
    have) and links to it when near; two that both link to the head are
    connected already, so only pairs with a member beyond the head's reach
    are compared further and, when near, emitted. A dense group of copies thus
    gives a star, not all its pairs, and no connection is lost. Pairs are
    verified inside the join, each in one bucket only: that of its first
    segment with at most one differing bit, under that bit's wildcard (the
    first wildcard if the segments agree).
    """
    forms = signatures(max_bits)
    variants = F.array(*[F.struct(
        F.lit(s).cast("byte").alias("seg"), F.lit(bit).cast("byte").alias("bit"),
        F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit(mask).cast("long")).alias("part")) for s, bit, lo, mask in forms])
    rows = marks.select("fp", "n", F.explode(variants).alias("v")).select("v.*", "fp", "n")
    order = Window.partitionBy("seg", "bit", "part").orderBy(F.desc("n"), "fp")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    shared = written(rows.withColumn("head", F.first("fp").over(whole)).withColumn("size", F.count("*").over(whole))
                     .where("size > 1").withColumn("near", F.expr(f"bit_count(fp ^ head) <= {max_bits}"))
                     .select("seg", "bit", "part", "fp", "head", "near"), "simhash-buckets")
    stars = shared.where("near AND fp <> head").select(F.col("fp").alias("a"), F.col("head").alias("b"))

    lows = {s: lo for s, _, lo, _ in forms}
    highs = {s: lo + bit + 1 for s, bit, lo, _ in forms}
    full = {s: ((1 << (highs[s] - lows[s])) - 1) << lows[s] for s in lows}
    signed = {s: m - (1 << 64) if m >> 63 else m for s, m in full.items()}
    differ = {s: f"bit_count((a ^ b) & {m}L)" for s, m in signed.items()}
    first = "CASE " + " ".join(f"WHEN {d} <= 1 THEN {s}" for s, d in differ.items()) + " END"
    within = "CASE seg " + " ".join(f"WHEN {s} THEN {d}" for s, d in differ.items()) + " END"
    left = shared.select("seg", "bit", "part", F.col("fp").alias("a"), F.col("near").alias("near_a"))
    far = shared.where("NOT near").select(F.col("seg").alias("f_seg"), F.col("bit").alias("f_bit"),
                                          F.col("part").alias("f_part"), F.col("fp").alias("b"))
    rest = left.join(far, F.expr(
        "seg = f_seg AND bit = f_bit AND part = f_part "
        f"AND bit_count(a ^ b) <= {max_bits} AND (near_a OR a < b) "
        f"AND seg = ({first}) AND (bit = 0 OR ({within}) = 1)"))
    return stars.union(rest.select("a", "b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row.

    Fingerprints link at ``max_bits`` or fewer differing bits; component_id is
    the smallest id reachable. Null, empty and blank texts have fingerprint
    zero and link like any other; a row with a null id is returned and linked,
    but never names a component (component_id is null only if every row of the
    component has a null id); repeated rows are each returned; an empty table
    gives an empty result.
    """
    marked = written(fingerprints(docs, id_col, text_col, shingle_words), "simhash-marks")
    marks = written(marked.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("least")), "simhash-fp")
    labels = components(links(marks, max_bits), "simhash-components").select(
        F.col("node").alias("fp"), "label")
    linked = marks.join(labels, "fp").select("fp", "label", "least")
    least = linked.groupBy("label").agg(F.min("least").alias("component_id"))
    joined = linked.join(least, "label").select("fp", "component_id")
    named = (marks.join(joined, "fp", "left")
             .select("fp", F.coalesce("component_id", "least").alias("component_id")))
    return marked.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle_words: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` with one document of each near-duplicate component: its smallest id.

    Rows with a null id can't be told apart and stay. Of rows that repeat one
    id, the one with the smallest (text, other columns) stays.
    """
    found = near_duplicates(docs, id_col, text_col, shingle_words, max_bits).where("doc_id IS NOT NULL")
    found = written(found.groupBy("doc_id").agg(F.min("component_id").alias("component_id"),
                                                F.count("*").alias("times")), "simhash-kept")
    gone = checked(found.where("component_id < doc_id").select(F.col("doc_id").alias("__gone")))
    left = docs.join(gone, docs[id_col] == F.col("__gone"), "left_anti")
    again = found.where("component_id = doc_id AND times > 1").select(F.col("doc_id").alias("__again"))
    if again.isEmpty():
        return left
    same = left[id_col] == F.col("__again")
    pick = Window.partitionBy(id_col).orderBy(text_col, F.to_json(F.struct(*docs.columns)))
    first = left.join(again, same, "left_semi").withColumn("__row", F.row_number().over(pick))
    return left.join(again, same, "left_anti").unionByName(first.where("__row = 1").drop("__row"))
