"""Writers of flat tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import STORED
from .scans import lookup_bucket


def write_csv(df: DataFrame, path: str, columns: list[str], strict: bool = False, mode: str = "overwrite") -> None:
    """Gzipped CSV with a header and these columns in order. Other columns are left out, or with strict an error."""
    extra = [c for c in df.columns if c not in columns]
    if strict and extra:
        raise ValueError(f"columns that the table does not have: {extra}")
    df.select(*columns).write.mode(mode).option("compression", "gzip").csv(path, header=True)


def stored(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Columns in order, missing ones as nulls, with the types that they have in Parquet."""
    names = columns or df.columns
    return df.select(*[(F.col(c).try_cast(STORED[c]) if c in STORED else F.col(c)).alias(c) if c in df.columns else F.lit(None).cast(STORED.get(c, "string")).alias(c) for c in names])


def write_parquet(df: DataFrame, path: str, columns: list[str] | None = None, distinct: bool = False, mode: str = "overwrite", rows_per_file: int | None = None) -> None:
    """Typed Parquet, zstd."""
    rows = stored(df, columns)
    writer = (rows.dropDuplicates() if distinct else rows).write.mode(mode).option("compression", "zstd")
    (writer.option("maxRecordsPerFile", rows_per_file) if rows_per_file else writer).parquet(path)


def write_tables(tables: dict[str, DataFrame], directory: str, mode: str = "overwrite") -> None:
    """One directory per table. Persist what they share first."""
    for name, df in tables.items():
        write_parquet(df, f"{directory}/{name}", mode=mode)


def append_new(df: DataFrame, path: str, done: DataFrame, source: str = "source_file") -> None:
    """Append the rows of source files that are not in done (path)."""
    write_parquet(df.join(done.select(F.col("path").alias("_p")), F.col(source) == F.col("_p"), "left_anti"), path, mode="append")


def replace_sources(df: DataFrame, path: str, source: str = "source_file") -> None:
    """Write partitions by source file; those that are there already are replaced, others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(source).parquet(path)


def merge_parts(df: DataFrame, path: str, files: int) -> None:
    df.coalesce(files).write.mode("overwrite").parquet(path)


def rewrite(df: DataFrame, path: str, casts: dict[str, str], rows_per_file: int = 5_000_000, row_group_bytes: int = 128 << 20) -> None:
    """Large table with other types, bounded files and row groups."""
    df.select(*[F.col(c).cast(casts[c]).alias(c) if c in casts else F.col(c) for c in df.columns]).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).option("parquet.block.size", row_group_bytes).parquet(path)


def sorted_table(df: DataFrame, path: str, key: str, files: int) -> None:
    """Ranges of the key in files sorted by it, for point lookups."""
    df.repartitionByRange(files, key).sortWithinPartitions(key).write.mode("overwrite").parquet(path)


def rewrite_by_report(df: DataFrame, path: str, report: DataFrame, blooms: list[str] | None = None, casts: dict[str, str] | None = None, rows_per_file: int = 5_000_000, row_group_bytes: int = 128 << 20) -> dict[str, str]:
    """rewrite() with each column encoded by a cardinality report (column, distinct, rows, ratio, categorise): dictionaries for
    columns to categorise, none for others, and bloom filters, sized by the estimate, for the columns of `blooms`. Returns the writer's options."""
    options: dict[str, str] = {"compression": "zstd", "maxRecordsPerFile": str(rows_per_file), "parquet.block.size": str(row_group_bytes)}
    for r in report.collect():  # one row for each column
        name = r["column"]
        options[f"parquet.enable.dictionary#{name}"] = str(bool(r["categorise"])).lower()
        if name in (blooms or []):
            options |= _bloom(name, r["distinct"] or r["rows"])
    kept = df.select(*[F.col(c).cast((casts or {})[c]).alias(c) if c in (casts or {}) else F.col(c) for c in df.columns])
    kept.write.mode("overwrite").options(**options).parquet(path)
    return options


def _bloom(name: str, values: int) -> dict[str, str]:
    """Options of a bloom filter for so many values in a row group."""
    return {f"parquet.bloom.filter.enabled#{name}": "true", f"parquet.bloom.filter.expected.ndv#{name}": str(max(1, values))}


def lookup_table(df: DataFrame, path: str, key: str, buckets: int, blooms: list[str] | None = None, values_per_file: int = 100_000) -> None:
    """Rows in folders by a hash of the key, for lookups by ids that no order brings together (scans.lookup()), with bloom filters
    of the key and of other columns for lookups of single values. values_per_file sizes the filters."""
    options = {k: v for c in (key, *(blooms or [])) for k, v in _bloom(c, values_per_file).items()}
    placed = df.withColumn("_bucket", lookup_bucket(F.col(key), buckets))
    placed.repartition(buckets, "_bucket").write.mode("overwrite").options(**options, **{f"parquet.enable.dictionary#{key}": "false"}).partitionBy("_bucket").parquet(path)
