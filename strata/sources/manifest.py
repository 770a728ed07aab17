"""Landing operators over listings, manifests and file contents.

The landing process is expressed as DataFrame jobs: a listing is parsed on the
executors, the manifest is a table joined against it, digests are computed
JVM-side. Nothing is collected to the driver but the numbers of touched buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.files import DEFAULT_BASE_URL, LISTING_ENTRY_PATTERN, classify, strip_ws
from ..operators.dedup import deduplicate
from ..operators.joins import sized_broadcast
from ..session import scratch_path
from .buckets import BucketedTable, one_file_a_bucket


def parse_listing(df: DataFrame, html_col: str = "html", keep: Sequence[str] = (),
                  base_url: str = DEFAULT_BASE_URL) -> DataFrame:
    """Directory-listing text -> one row per file: url, filename, last_modified, size_bytes.

    Each listing row is parsed in its own task slot (``regexp_extract_all`` +
    ``explode``), so many or large listings spread across the cluster.
    """
    pat = LISTING_ENTRY_PATTERN
    m = F.explode(F.regexp_extract_all(F.col(html_col), F.lit(pat), 0)).alias("_m")
    hits = df.select(*keep, m)
    g = lambda i: F.regexp_extract(F.col("_m"), pat, i)
    return hits.select(
        *keep,
        F.concat(F.lit(base_url), g(3)).alias("url"),
        strip_ws(g(4)).alias("filename"),
        strip_ws(g(1)).alias("last_modified"),
        g(2).try_cast("bigint").alias("size_bytes"),
    )


def classify_files(entries: DataFrame, filename_col: str = "filename") -> DataFrame:
    """Adds ``category`` (current/backfill/series/enrichment, NULL = skip)."""
    return entries.withColumn("category", classify(F.col(filename_col)))


def entries_of_category(entries: DataFrame, category: str) -> DataFrame:
    """Entries routed to one category."""
    return classify_files(entries).where(F.col("category") == category)


def write_by_category(entries: DataFrame, path: str) -> None:
    """Persist routed entries with one folder per category (skip-listed
    entries, category NULL, are not written)."""
    (classify_files(entries).where(F.col("category").isNotNull())
     .write.mode("overwrite").partitionBy("category").parquet(path))


def manifest_pending(entries: DataFrame, manifest: DataFrame) -> DataFrame:
    """Entries not already recorded at the same last-modified (NULL matches NULL).

    A left-anti join on null-safe keys; the manifest is broadcast only when
    its estimated size allows, else both sides shuffle on url.
    """
    m = manifest.select(F.col("url").alias("_u"), F.col("last_modified").alias("_lm"))
    cond = (F.col("url").eqNullSafe(F.col("_u"))) & (F.col("last_modified").eqNullSafe(F.col("_lm")))
    return entries.join(sized_broadcast(m), cond, "left_anti")


# fixed value: how listings print a time
LISTED_AT = "M/d/yyyy h:mm a"


def latest_records(records: DataFrame) -> DataFrame:
    """One record per url, the latest point in time first, text only among equals."""
    return deduplicate(records.select("url", "last_modified"), ["url"],
                       order_by=[F.try_to_timestamp("last_modified", F.lit(LISTED_AT)).desc_nulls_last(),
                                 F.col("last_modified").desc_nulls_last()])


def manifest_upsert(manifest: DataFrame, records: DataFrame) -> DataFrame:
    """New (url, last_modified) records overwrite the stored ones per url.

    MERGE as anti-join + union: only the new records are de-duplicated (one
    per url, latest point in time first, text only among equals); the stored manifest is streamed through
    a left-anti join against them — with the usual small batch of records
    broadcast, the large manifest is never shuffled.
    """
    new = latest_records(records)
    kept = manifest.select("url", "last_modified").join(
        sized_broadcast(new.select(F.col("url").alias("_u"))), F.col("url") == F.col("_u"), "left_anti")
    return kept.unionByName(new)


MANIFEST_SCHEMA = "url string, last_modified string"


def kept_manifest(spark: SparkSession, root: str, buckets: int = 64) -> BucketedTable:
    """A manifest kept in buckets by url, for ``upsert_in_place``."""
    return BucketedTable(spark, root, ("url",), StructType.fromDDL(MANIFEST_SCHEMA), buckets)


def upsert_in_place(kept: BucketedTable, records: DataFrame, batch: int) -> bool:
    """``manifest_upsert`` of the buckets that ``records`` touch; files of the others stay as they are.

    False if the batch was applied before. A bucket's rows and its new records
    meet in one task, which also writes it.
    """
    if batch <= kept.last():
        return False
    path = scratch_path(kept.spark, "manifest-records")
    kept.with_bucket(latest_records(records)).write.parquet(path)
    new = kept.spark.read.parquet(path)
    touched = kept.touched(new)
    old = kept.read(touched).join(new.select(F.col("bucket").alias("_b"), F.col("url").alias("_u")),
                                  (F.col("bucket") == F.col("_b")) & F.col("url").eqNullSafe(F.col("_u")), "left_anti")
    return kept.replace(one_file_a_bucket(old.unionByName(new)), touched, batch)


def content_changed(content: DataFrame, previous: DataFrame, key: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Rows whose SHA-256 differs from the previously stored digest (or that
    have none): only those need to be written again. A text that became NULL differs
    from a stored digest; one that was and is NULL doesn't."""
    cur = content.select(key, F.sha2(F.col(text_col), 256).alias("digest"))
    prev = previous.select(F.col(key).alias("_k"), F.col("digest").alias("_prev"))
    j = cur.join(sized_broadcast(prev), cur[key] == prev["_k"], "left")
    return j.where(F.col("_k").isNull() | ~F.col("_prev").eqNullSafe(F.col("digest"))).select(key, "digest")


RECORDS_SCHEMA = "columns array<string>, data array<map<string,string>>"


def json_records_to_rows(payloads: DataFrame, id_col: str = "payload_id",
                         payload_col: str = "payload") -> DataFrame:
    """``{"columns": [...], "data": [{...}]}`` documents -> tab-separated lines.

    Output (payload_id, line_no, line): line 0 is the header in ``columns``
    order, then one line per record, values in the same order, NULL or a
    missing key written as the empty string. Numbers keep their JSON text.
    """
    doc = payloads.select(id_col, F.from_json(F.col(payload_col), RECORDS_SCHEMA).alias("_d"))
    header = doc.select(id_col, F.lit(0).alias("line_no"),
                        F.array_join(F.col("_d.columns"), "\t").alias("line"))
    recs = doc.select(id_col, F.col("_d.columns").alias("_c"),
                      F.posexplode(F.col("_d.data")).alias("_pos", "_r"))
    body = recs.select(
        id_col, (F.col("_pos") + 1).alias("line_no"),
        F.array_join(F.transform(F.col("_c"), lambda c: F.coalesce(F.try_element_at(F.col("_r"), c), F.lit(""))),
                     "\t").alias("line"))
    return header.unionByName(body)


def write_records_tsv(lines: DataFrame, path: str, id_col: str = "payload_id") -> None:
    """Write converted records as text: one folder per payload, lines in order.

    Each payload's lines go to one task (a payload is one document), sorted
    by ``line_no`` inside it; different payloads are written in parallel.
    """
    (lines.repartition(F.col(id_col)).sortWithinPartitions(id_col, "line_no")
          .select(id_col, "line").write.mode("overwrite").partitionBy(id_col).text(path))
