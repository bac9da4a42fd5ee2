"""Tables in the cluster's shared folder, to cut lineage where a result is used more than once."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below spark.checkpoint.dir.

    Where that setting is absent, a local master gets a temporary folder; any
    other raises, as its executors would not see one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="chronovox-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Bytes of an Arrow batch whose rows are long (boxes, their points): a task in Python holds two batches at a time.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches to BATCH_BYTES, unless the session already asks for fewer. The setting stays, as lazy plans read it when they run."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(\d+)([bkmgtp]?)b?", spark.conf.get(key).strip().lower()).groups()
    if int(number) << 10 * "bkmgtp".index(unit or "b") > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Cut lineage: write ``df`` as Parquet to the shared folder (with the writer's options) and read it back with the same schema."""
    path = shared_dir(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables of written() or bucketed() that nothing reads any more."""
    for table in tables:
        if hasattr(table, "table"):
            table.sparkSession.sql(f"DROP TABLE IF EXISTS {table.table}")
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.stored_at)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def bucketed(df: DataFrame, name: str, *columns: str) -> DataFrame:
    """Write ``df`` to the shared folder, dealt and sorted by ``columns``, so that joins on them leave it where it is."""
    spark, table = df.sparkSession, f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    path = shared_dir(spark, name)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, *columns).write.bucketBy(n, *columns).sortBy(*columns).option("path", path).saveAsTable(table)
    out = spark.table(table)
    out.stored_at, out.table = path, table
    return out
