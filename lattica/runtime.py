"""Session helpers: shared scratch tables that survive the loss of an executor."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset and Spark runs in this process
    (tests), one is made and set. A cluster without it is an error: its executors share no other folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="lattica-")
        spark.conf.set("spark.checkpoint.dir", folder)
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage ends there, and later
    joins see a plain scan whose exchanges AQE may split when a key is hot. The folder is the
    cluster's scratch space, so old tables go with it."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, path: str):
    """(file system, path) in Hadoop's terms."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    system, at = _place(spark, path)
    return system.exists(at)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder; none where it does not exist."""
    system, at = _place(spark, path)
    return sorted(x.getPath().getName() for x in system.listStatus(at) if x.isDirectory()) if system.exists(at) else []


def remove(spark: SparkSession, path: str) -> None:
    system, at = _place(spark, path)
    system.delete(at, True)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table made by written() that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove(df.sparkSession, folder)


def broadcast_below(df: DataFrame, max_rows: int, max_bytes: int = 128 << 20) -> DataFrame:
    """df with a broadcast hint if it has at most max_rows rows and max_bytes bytes of values;
    otherwise as it is, so that the join shuffles. df must be cheap to count, such as a written() table."""
    wide = [c for c, t in df.dtypes if t in ("string", "binary")]
    size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in wide), F.lit(16 * len(df.columns)))
    rows, held = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return F.broadcast(df) if rows <= max_rows and held <= max_bytes else df


def spread(df: DataFrame, rows: int, *cols, each: int = 500_000) -> DataFrame:
    """df, of about so many rows, dealt by the columns over as many tasks as leave each about `each` rows: partitions of a set number, which
    AQE does not put together by their bytes, so that what a task holds does not grow with the input."""
    return df.repartition(max(1, -(-rows // each)), *cols)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
