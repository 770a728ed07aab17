"""Bronze ingestion with Structured Streaming.

Landed delimited files are read by the streaming file source with an
explicit all-string schema; each run uses ``trigger(availableNow=True)``:
it processes every file not yet recorded in its checkpoint, then stops. A
second run over the same folder adds nothing; a new file adds only its rows.
Checkpoints and sinks live under the shared ``spark.checkpoint.dir``, so a
lost executor (or driver restart) resumes from the last committed batch.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from ..plans import specs
from ..plans.silver import raw_table
from ..plans.specs import TableSpec
from ..sources.tsv import READ_OPTIONS, string_schema, write_named_tsv, write_tsv


# A micro-batch never takes more files than this, so a large backfill commits
# progress batch by batch (a failure repeats one batch, not the whole load).
DEFAULT_MAX_FILES_PER_TRIGGER = 1000


def bronze_stream(spark: SparkSession, spec: TableSpec, landing: str,
                  max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
                  extra_folders: tuple[str, ...] = ()) -> DataFrame:
    """Streaming reader of one bronze table over ``landing/<folder>/``.

    ``extra_folders`` adds sibling landing folders to the same stream (e.g.
    ``("current",)`` next to ``backfill``), read through one path glob.
    """
    r = (spark.readStream.format("csv").options(**READ_OPTIONS)
         .schema(string_schema(spec.raw_columns)))
    if spec.file_name:
        r = r.option("pathGlobFilter", spec.file_name)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    folders = (spec.folder, *extra_folders)
    sub = folders[0] if len(folders) == 1 else "{" + ",".join(folders) + "}"
    return r.load(f"{landing.rstrip('/')}/{sub}/")


def start_available_now(stream: DataFrame, sink: str, checkpoint: str, name: str | None = None):
    """Start a run that processes everything available, commits and stops."""
    w = (stream.writeStream.format("parquet")
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True))
    if name:
        w = w.queryName(name)
    return w.start(sink)


def _wait(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def run_available_now(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Process everything available, commit, stop (idempotent per checkpoint)."""
    _wait(start_available_now(stream, sink, checkpoint))


def ingest(spark: SparkSession, spec: TableSpec, landing: str, bronze_root: str,
           max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER) -> DataFrame:
    """Run one availableNow pass for ``spec``; return a batch read of the table."""
    sink = f"{bronze_root}/{spec.bronze}"
    run_available_now(bronze_stream(spark, spec, landing, max_files_per_trigger),
                      sink, f"{bronze_root}/_checkpoints/{spec.bronze}")
    return spark.read.schema(string_schema(spec.raw_columns)).parquet(sink)


def ingest_all(spark: SparkSession, landing: str, bronze_root: str,
               tables: Iterable[TableSpec] = specs.ALL,
               max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER) -> dict[str, DataFrame]:
    """One availableNow pass for several bronze tables, running concurrently
    (each query schedules its own jobs; the cluster interleaves them)."""
    tables = list(tables)
    running = [start_available_now(bronze_stream(spark, s, landing, max_files_per_trigger),
                                   f"{bronze_root}/{s.bronze}", f"{bronze_root}/_checkpoints/{s.bronze}")
               for s in tables]
    for q in running:
        _wait(q)
    return {s.bronze: spark.read.schema(string_schema(s.raw_columns)).parquet(f"{bronze_root}/{s.bronze}")
            for s in tables}


def land(spark: SparkSession, raw: DataFrame, spec: TableSpec, landing: str) -> None:
    """Write a raw frame as landed text: big tables as parallel part files in
    their folder, named lookup files as one file each."""
    folder = f"{landing.rstrip('/')}/{spec.folder}"
    if spec.file_name:
        write_named_tsv(raw, folder, spec.file_name, f"{landing}/_staging/{spec.bronze}")
    else:
        write_tsv(raw, folder)


def land_all(spark: SparkSession, sf_dir: str, landing: str,
             tables: Iterable[TableSpec] = specs.ALL, parallel: int = 4) -> None:
    """Land several raw tables; the independent write jobs are submitted
    concurrently so small lookups do not queue behind the fact."""
    from concurrent.futures import ThreadPoolExecutor
    tables = list(tables)
    frames = [(s, raw_table(spark, sf_dir, s.name)) for s in tables]   # plans built on this thread
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        for f in [pool.submit(land, spark, df, s, landing) for s, df in frames]:
            f.result()
