"""Readers of snapshots, manifests and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import MANIFEST, nested_schema, with_own_id

#: Dimension tables that may be read by name.
SMALL_TABLES = ("institutions", "concepts", "topics", "sources", "publishers", "funders", "venues")


def read_entity(spark: SparkSession, entity: str, paths: list[str], partitions: int | None = None, max_files: int | None = None, own_id: str = "own_id") -> DataFrame:
    """JSON lines, gzipped or not, of at most max_files of the paths. A line that is not JSON gives a row of nulls,
    which the id filter drops. gz files are one task each: partitions spreads their rows for what follows.
    own_id: what the snapshot calls the field of ids that holds the entity's own URL."""
    df = with_own_id(spark.read.schema(nested_schema(entity, own_id)).json(paths[:max_files]), entity)
    return df.repartition(partitions) if partitions else df


def read_entity_tolerant(spark: SparkSession, entity: str, paths: str | list[str], own_id: str = "own_id") -> tuple[DataFrame, DataFrame]:
    """Good rows, with source_file, and bad lines as (source_file, line); blank lines are neither."""
    lines = spark.read.text(paths).where("trim(value) <> ''").select("value", F.col("_metadata.file_path").alias("source_file"))
    return parsed_lines(lines, entity, own_id)


def marked_lines(lines: DataFrame, entity: str, own_id: str = "own_id") -> DataFrame:
    """The records of all lines (value, source_file), null where a line is blank, with source_file and _line, the text of a line that is not JSON.
    The parsed record comes out of an explode, below which no filter on it goes: each line is parsed once."""
    schema = T.StructType([*nested_schema(entity, own_id).fields, T.StructField("_bad", T.StringType())])
    record = F.from_json(F.when(F.trim("value") != "", F.col("value")), schema, {"columnNameOfCorruptRecord": "_bad"})
    rows = lines.select("source_file", "value", F.explode(F.array(record)).alias("r"))
    return with_own_id(rows.select("r.*", "source_file", F.when(F.col("r._bad").isNotNull(), F.col("value")).alias("_line")).drop("_bad"), entity)


def parsed_lines(lines: DataFrame, entity: str, own_id: str = "own_id") -> tuple[DataFrame, DataFrame]:
    """The same for lines (value, source_file) from anywhere."""
    return good_and_bad(marked_lines(lines, entity, own_id))


def good_and_bad(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of marked_lines()."""
    return rows.where("_line IS NULL").drop("_line"), rows.where("_line IS NOT NULL").select("source_file", F.col("_line").alias("line"))


def read_manifest(spark: SparkSession, path: str, prefix: str, max_files: int | None = None) -> DataFrame:
    """(filename, records, total), smallest first, without empty files; at most max_files of them. prefix is taken off their URLs."""
    raw = spark.read.schema(MANIFEST).option("multiLine", True).json(path)
    rows = raw.select(F.col("meta.record_count").alias("total"), F.explode("entries").alias("e"))
    rows = rows.select(F.replace("e.url", F.lit(prefix), F.lit("")).alias("filename"), F.col("e.meta.record_count").alias("records"), "total").where("records > 0").orderBy("records", "filename")
    return rows.limit(max_files) if max_files else rows


def read_csvs(spark: SparkSession, paths: str | list[str], columns: dict[str, str] | None = None) -> DataFrame:
    """CSV files with a header as one table; columns: name to SQL expression, of which only the inputs are read."""
    df = spark.read.csv(paths, header=True)
    return df.selectExpr(*[f"{e} AS {n}" for n, e in columns.items()]) if columns else df


def read_table(spark: SparkSession, path: str | list[str], columns: list[str] | None = None) -> DataFrame:
    """Parquet file or directory of parts; only the named columns are read."""
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return df.select(*columns) if columns else df


def rows_in(df: DataFrame, col: str, values: DataFrame | list, pushed: int = 1000) -> DataFrame:
    """Rows whose column is among the values: a filter that the scan takes for a short list, a semi join otherwise."""
    if isinstance(values, list):
        if len(values) <= pushed:
            return df.where(F.col(col).isin(values))
        values = df.sparkSession.createDataFrame([(v,) for v in values], T.StructType([T.StructField("_v", df.schema[col].dataType)]))
    other = values.toDF("_v")
    return df.join(other, df[col] == other["_v"], "left_semi")


def lookup_bucket(key: Column, buckets: int) -> Column:
    """The bucket of a table written by lookup_table() in which a key lies."""
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def lookup(df: DataFrame, key: str, values: DataFrame | list, buckets: int) -> DataFrame:
    """Rows of a table written by lookup_table() whose key is among the values, however many: only the values' buckets are read,
    then a semi join (Spark broadcasts it by itself below its threshold). Null and repeated values count once or not at all."""
    kind = df.schema[key].dataType
    if isinstance(values, list):
        values = df.sparkSession.createDataFrame([(v,) for v in values], T.StructType([T.StructField("_v", kind)]))
    wanted = values.toDF("_v").select(F.col("_v").cast(kind).alias("_v")).where("_v IS NOT NULL").distinct()
    hit = [r["b"] for r in wanted.select(lookup_bucket(F.col("_v"), buckets).alias("b")).distinct().collect()]  # numbers of buckets
    return df.where(F.col("_bucket").isin(hit)).join(wanted, df[key] == wanted["_v"], "left_semi").drop("_bucket")


def row_of(df: DataFrame, key: str, value) -> DataFrame:
    """Point lookup; on a table written by sorted_table() row-group statistics leave few groups to read."""
    return df.where(F.col(key) == value)


def read_clean(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """Without stray index columns and repeated rows; with key, ordered by it."""
    df = spark.read.parquet(path).drop("index", "__null_dask_index__", "Unnamed: 0").dropDuplicates()
    return df.orderBy(key) if key else df


def read_small(spark: SparkSession, directory: str, name: str) -> DataFrame:
    if name not in SMALL_TABLES:
        raise ValueError(f"{name!r} is none of {SMALL_TABLES}")
    return spark.read.csv(f"{directory}/{name}.csv.gz", header=True)


def dimension(df: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """key and attributes, one row per key. Spark broadcasts it by itself below its threshold."""
    return df.select(key, *attributes).where(F.col(key).isNotNull()).dropDuplicates([key])


def peek(df: DataFrame, n: int = 5) -> tuple[DataFrame, DataFrame]:
    """One row (files, rows, columns, schema), and n rows of the first file."""
    of = F.col("_metadata.file_path")
    facts = df.select(of.alias("f")).agg(F.count_distinct("f").alias("files"), F.count("*").alias("rows"))
    first = df.select(F.min(of).alias("first"))
    rows = df.withColumn("_file", of).join(first, F.col("_file") == F.col("first"), "left_semi").drop("_file").limit(n)
    return facts.select("*", F.lit(len(df.columns)).alias("columns"), F.lit(df.schema.simpleString()).alias("schema")), rows


def named_types(spark: SparkSession, path: str, sample: int = 2000) -> T.StructType:
    """Types of a CSV file: inferred from a sample, then set by name. Ids and texts are strings, is_* boolean, whole numbers bigint."""
    head = [r[0] for r in spark.read.text(path).limit(sample + 1).collect()]  # a bounded sample; the header is the file's first line
    found = spark.read.csv(spark.sparkContext.parallelize(head, 1), header=True, inferSchema=True).schema
    return T.StructType([T.StructField(f.name, type_by_name(f)) for f in found])


def type_by_name(f: T.StructField) -> T.DataType:
    if f.name.startswith("is_") or "_is_" in f.name:
        return T.BooleanType()
    if "id" in f.name or isinstance(f.dataType, T.StringType):
        return T.StringType()
    return T.LongType() if isinstance(f.dataType, (T.IntegerType, T.LongType, T.ShortType)) else f.dataType
