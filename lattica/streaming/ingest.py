"""File-incremental ingest: a stream of JSON-lines files to flat tables and a log.

Every write is a batch, a partition of its own in each table, and gets a generation: a number above all
in the log. The log says for each source file and table in which batch its rows are; its entry comes last, so
a write that fails half-way leaves the old rows. Readers take, for each source file, the latest generation of each
table, whatever batch it lies in; a later write of a file replaces it, and an entry without a batch removes it. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.flatten import BROADCAST, ENTITIES, TOPIC_COLUMNS, WORKS, flatten, named_skipped, skipped, work_parents, written_work_tables
from ..operators.relational import completed, missing_tables, validated
from ..runtime import broadcast_below, dropped, path_exists, remove, subfolders, written
from ..schemas import LOG
from ..sources.scans import good_and_bad, marked_lines
from ..sources.sinks import stored

#: The log's rows: LOG, the batch that holds the file's rows of the table (null: removed), and the generation.
LOG_ROWS = LOG + ", at_batch string, generation bigint"
#: Bytes of files that a batch takes, or one file: what a batch's joins broadcast does not grow with the input.
BATCH_BYTES = 256 << 20
#: (topics, institutions), as the batch that is written finds them.
Dimensions = Callable[[SparkSession], tuple[DataFrame | None, DataFrame | None]]


def ingest(spark: SparkSession, entity: str, source: str, target: str, checkpoint: str, skip: dict[str, DataFrame] | None = None, files_per_trigger: int | None = None, own_id: str = "own_id", dimensions: Dimensions | None = None) -> StreamingQuery:
    """Flatten each file of source once, append to target/<table>, log to target/_log; ends when no new file is left.

    Every table of a batch goes to its own batch=<n> partition, written with overwrite, so a batch that is
    run again after a failure leaves the same rows. Lines that are not JSON go to target/_bad. dimensions is asked
    for topics and institutions in each batch, so works get the names that are current then. A batch takes BATCH_BYTES, or files_per_trigger files.
    """
    lines = spark.readStream.format("text").option("recursiveFileLookup", True)
    lines = lines.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else lines.option("maxBytesPerTrigger", BATCH_BYTES)
    rows = lines.load(source).select("value", F.col("_metadata.file_path").alias("source_file"))

    def write(batch: DataFrame, n: int) -> None:
        save_batch(batch, str(n), entity, target, skip, own_id=own_id, dimensions=dimensions)

    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def table_names(entity: str) -> list[str]:
    return [*WORKS, "works_authorships", "works_abstracts", "works_topics"] if entity == "works" else list(ENTITIES[entity].tables)


def save_batch(lines: DataFrame, batch: str, entity: str, target: str, skip: dict[str, DataFrame] | None = None, only: list[str] | None = None, own_id: str = "own_id", dimensions: Dimensions | None = None) -> None:
    """Write the tables, or only some, of lines (value, source_file) and log the rows of each by source file, 0 where it has none.
    A batch of the same name is written anew, in its place and generation. The lines are read and parsed once: every table reads the parsed rows."""
    spark = lines.sparkSession
    parsed = written(marked_lines(lines, entity, own_id), "parsed")
    scratch = [parsed]
    good, bad = good_and_bad(parsed)
    if entity == "works":
        of = skipped(skip, lambda df, name: scratch.append(written(df, name)) or scratch[-1])
        named = named_skipped(good, of)
        if named is not None:
            scratch.append(written(named, "named"))
            named = broadcast_below(scratch[-1], BROADCAST)
        attached = work_parents(good, of=of, named=named)
        topics, institutions = (None if x is None else broadcast_below(x, 200_000) for x in (dimensions(spark) if dimensions else (None, None)))
        tables = written_work_tables(work_parents(good, of=of), attached, of, spark.createDataFrame([], TOPIC_COLUMNS) if topics is None else topics, institutions)
    else:
        tables = flatten(entity, good, (skip or {}).get(entity))
    wanted = {name: stored(df) for name, df in tables.items() if only is None or name in only}

    def write(name: str) -> DataFrame:
        path = f"{target}/{name}/batch={batch}"
        wanted[name].write.mode("overwrite").parquet(path)
        return spark.read.schema(wanted[name].schema).parquet(path).select(F.lit(name).alias("table"), F.col("source_file").alias("path"))

    with ThreadPoolExecutor(4) as pool:  # several tables at a time: many are small
        there = reduce(DataFrame.unionByName, pool.map(write, wanted))
    if only is None:
        bad.write.mode("overwrite").json(f"{target}/_bad/batch={batch}")
    files = parsed.select(F.col("source_file").alias("path")).distinct().select("path", F.explode(F.array(*map(F.lit, wanted))).alias("table"))
    counts = there.groupBy("path", "table").agg(F.count("*").alias("records"))
    _log(files.join(counts, ["path", "table"], "left").select("path", "table", F.coalesce("records", F.lit(0)).alias("records"), F.lit(batch).alias("at_batch")), batch, target)
    for df in scratch:
        dropped(df)


def _log(rows: DataFrame, entry: str, target: str) -> None:
    """Add (path, table, records, at_batch) to the log, as one file, under the entry's name; an entry of the same name keeps its generation."""
    rows = written(rows, "entry")  # rows may come from the log
    spark, folder = rows.sparkSession, f"{target}/_log/batch={entry}"
    known = log_rows(spark, target).agg(F.max("generation")).first()[0]
    mine = log_rows(spark, target).where(F.col("_entry") == f"batch={entry}").agg(F.max("generation")).first()[0]
    generation = mine if mine is not None else (known if known is not None else -1) + 1
    out = rows.select(F.current_timestamp().alias("timestamp"), "path", "table", F.col("records").cast("bigint").alias("records"), F.col("at_batch").cast("string").alias("at_batch"), F.lit(generation).cast("bigint").alias("generation"))
    out.coalesce(1).write.mode("overwrite").parquet(folder)
    dropped(rows)


def log_rows(spark: SparkSession, target: str) -> DataFrame:
    """The whole log, with the folder of each row as _entry; empty where nothing was written yet."""
    path = f"{target}/_log"
    if not path_exists(spark, path):
        return spark.createDataFrame([], LOG_ROWS + ", _entry string")
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return spark.read.schema(LOG_ROWS).option("recursiveFileLookup", True).parquet(path).withColumn("_entry", F.url_decode(folder))


def current_files(spark: SparkSession, target: str) -> DataFrame:
    """(source_file, table, batch, generation, records): where the rows of each source file and table are now."""
    last = log_rows(spark, target).groupBy(F.col("path").alias("source_file"), "table").agg(F.max_by(F.struct("at_batch", "generation", "records"), "generation").alias("x"))
    return last.where("x.at_batch IS NOT NULL").select("source_file", "table", F.col("x.at_batch").alias("batch"), "x.generation", "x.records")


def batches_of(spark: SparkSession, target: str, table: str) -> DataFrame:
    """All rows of a table ever written, with their batch as a string, whatever the names look like."""
    path = f"{target}/{table}"
    found = spark.read.parquet(path).schema
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "batch" else f for f in found])
    return spark.read.schema(schema).parquet(path)


def file_rows(spark: SparkSession, target: str, table: str) -> DataFrame:
    """Rows of a table from the batch that is current for their source file."""
    now = current_files(spark, target).where(F.col("table") == table).select("source_file", "batch")
    return batches_of(spark, target, table).join(now, ["source_file", "batch"], "left_semi")


def _places(spark: SparkSession, entity: str, target: str) -> DataFrame:
    """(source_file, batch, place): the parent table's current files, in the order of their generations and names; one row for each file."""
    order = current_files(spark, target).where(F.col("table") == entity)
    return order.select("source_file", "batch", F.row_number().over(Window.orderBy("generation", "source_file")).alias("place"))


def repeated_keys(spark: SparkSession, entity: str, target: str, key: str) -> DataFrame:
    """(key, owner): entities that are in several current files, with the place of the file whose rows count."""
    parents = batches_of(spark, target, entity).select(key, "source_file", "batch").join(F.broadcast(_places(spark, entity, target)), ["source_file", "batch"])
    held = parents.groupBy(key).agg(F.max("place").alias("owner"), F.min("place").alias("first"))
    return written(held.where("owner > first").select(key, "owner"), "repeated")


def current_rows(spark: SparkSession, entity: str, target: str, table: str, key: str, repeated: DataFrame | None = None) -> DataFrame:
    """Rows of a table, each entity from one source file only: that whose parent rows are of the latest generation (of several, the last by name).

    Rows that were written with their parents need only lose what is in another file too: these entities, the repeated_keys() (taken
    once for several tables), are broadcast while they are few. Rows of other batches than their parents' are looked up there.
    """
    places = _places(spark, entity, target)
    now = current_files(spark, target).where(F.col("table") == table).select("source_file", "batch")
    repeated = broadcast_below(repeated_keys(spark, entity, target, key) if repeated is None else repeated, 2_000_000)
    rows = batches_of(spark, target, table)
    together = rows.join(F.broadcast(now.join(places, ["source_file", "batch"])), ["source_file", "batch"]).join(repeated, key, "left")
    together = together.where("owner IS NULL OR owner = place").select(*rows.columns)
    apart = now.join(places, ["source_file", "batch"], "left_anti")
    if apart.isEmpty():
        return together
    parents = batches_of(spark, target, entity).select(key, "source_file", "batch").join(F.broadcast(places), ["source_file", "batch"])
    owner = parents.join(repeated, key, "left").where("owner IS NULL OR owner = place").select(key, "source_file").distinct()
    return together.unionByName(rows.join(F.broadcast(apart), ["source_file", "batch"], "left_semi").join(owner, [key, "source_file"], "left_semi"))


def ingested_dimensions(topics: str | None, institutions: str | None) -> Dimensions:
    """Dimensions from the targets of their own ingests, as they are when a batch asks."""

    def read(spark: SparkSession) -> tuple[DataFrame | None, DataFrame | None]:
        return (
            current_rows(spark, "topics", topics, "topics", "topic_id") if topics else None,
            current_rows(spark, "institutions", institutions, "institutions", "institution_id") if institutions else None,
        )

    return read


def absent_tables(spark: SparkSession, entity: str, target: str) -> DataFrame:
    """(source_file, missing): tables that the log does not have for a source file of the parent table."""
    now = current_files(spark, target)
    return missing_tables(now.where(F.col("table") == entity).select("source_file"), now.select("source_file", "table"), table_names(entity))


def recompute_missing(spark: SparkSession, entity: str, target: str, batch: str, skip: dict[str, DataFrame] | None = None, own_id: str = "own_id", dimensions: Dimensions | None = None) -> list[str]:
    """Read again the source files for which tables are missing and write only these tables, as a batch of
    its own. Files that miss the same tables are read together. Returns the names of what was written."""
    sets = absent_tables(spark, entity, target).groupBy("missing").agg(F.collect_list("source_file").alias("files")).collect()  # names of files
    for i, row in enumerate(sets):
        save_batch(_lines(spark, row["files"]), f"{batch}-{i}", entity, target, skip, row["missing"], own_id, dimensions)
    return sorted({t for row in sets for t in row["missing"]})


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    return spark.read.text(files).select("value", F.col("_metadata.file_path").alias("source_file"))


def wrong_files(spark: SparkSession, entity: str, target: str, manifest: DataFrame, tolerance: int = 0) -> DataFrame:
    """(filename, expected, actual, difference) of the manifest's files (filename, records) that are in the parent table
    with other than so many rows, counted in the table itself, not taken from the log."""
    counts = file_rows(spark, target, entity).groupBy(F.col("source_file").alias("filename")).agg(F.count("*").alias("n"))
    there = current_files(spark, target).where(F.col("table") == entity).select(F.col("source_file").alias("filename"))
    return validated(manifest.join(there, "filename", "left_semi"), counts, tolerance)


def remove_files(files: DataFrame, batch: str, entity: str, target: str) -> None:
    """Take the rows of the source files (filename) out of all tables, by one entry in the log: readers see all of them or none."""
    gone = files.select(F.col("filename").alias("path")).distinct().select("path", F.explode(F.array(*map(F.lit, table_names(entity)))).alias("table"))
    _log(gone.select("path", "table", F.lit(0).alias("records"), F.lit(None).cast("string").alias("at_batch")), batch, target)


def replace_files(spark: SparkSession, files: list[str], batch: str, entity: str, target: str, skip: dict[str, DataFrame] | None = None, own_id: str = "own_id", dimensions: Dimensions | None = None) -> None:
    """Read source files again and put their rows in place of the old ones, in all tables at once: the log's entry comes last."""
    save_batch(_lines(spark, files), batch, entity, target, skip, None, own_id, dimensions)


def clean_up(spark: SparkSession, entity: str, target: str) -> list[str]:
    """Delete the batches of each table of which no source file's rows are current, after readers have ended. Returns what was deleted."""
    kept = {(r["table"], r["batch"]) for r in current_files(spark, target).select("table", "batch").distinct().collect()}  # names of batches
    old = [f"{target}/{name}/{folder}" for name in table_names(entity) for folder in subfolders(spark, f"{target}/{name}") if folder.startswith("batch=") and (name, folder.removeprefix("batch=")) not in kept]
    for path in old:
        remove(spark, path)
    return old


def pending(entries: DataFrame, log: DataFrame, n_tables: int, recompute: list[str] | None = None) -> DataFrame:
    """Manifest entries (filename, ...) that the log does not have complete."""
    done = completed(log, n_tables, recompute).withColumnRenamed("path", "filename")
    return entries.join(done, "filename", "left_anti")
