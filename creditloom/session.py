"""Session helpers: a local builder, the shared scratch folder and materialisation."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# The JVM compiles no method above this many bytes of bytecode. A projection of a hundred feature
# columns fused into one method is larger and would be interpreted row by row; below the limit Spark
# splits it into small methods instead, which was measured 5 to 10 times faster.
COMPILED_METHOD_BYTES = "8000"
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
# Values of a wide table that one task should hold (128 MB of doubles), and those worth a task of their own.
TASK_CELLS, LEAST_CELLS = 2**24, 2**16


def tune(spark: SparkSession) -> SparkSession:
    """Let wide projections be compiled. A limit that the session already sets is left alone."""
    if spark.conf.get(_METHOD_LIMIT, None) is None:
        spark.conf.set(_METHOD_LIMIT, COMPILED_METHOD_BYTES)
    return spark


def local_session(cores: int | str = "*", app: str = "creditloom", **conf: str) -> SparkSession:
    """A local session for tests and the bench. On a cluster use the session that is given."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return tune(builder.getOrCreate())


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may run without it, because there every task sees the same disk; the
    folder made for it is stored in the session so that it is made once.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("creditloom.scratch", None)
    if folder is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):  # not local-cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="creditloom-")
        spark.conf.set("creditloom.scratch", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give Spark ML's tree learners a place for their periodic checkpoints."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark))


def materialize(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back.

    Cuts the lineage in front of iterative work. Unlike a cached table it survives lost executors,
    and unlike a checkpointed RDD it keeps column pruning and filter pushdown.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, width: int, label: str | None = None) -> DataFrame:
    """``df`` dealt over the cores, in parts of at most ``TASK_CELLS`` values of rows of ``width`` values.

    Spark cuts files by their bytes, and not inside a row group: a few MB that grow into a wide table are read, and all that
    follows computed, by one task. ``df`` should be cheap to read; where its tasks have about equal shares it
    comes back as it is. With a label the dealt rows are written as a table, otherwise they are shuffled whenever they are read.
    """
    sizes = df.groupBy(F.spark_partition_id()).count().agg(F.sum("count"), F.max("count")).first()
    rows, most = sizes[0] or 0, sizes[1] or 0
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(cores, -(-rows * width // LEAST_CELLS)))
    # In whole rounds: so many files of one size are read by the cores in equal shares.
    parts *= max(1, -(-rows * width // (parts * TASK_CELLS)))
    if 4 * most <= 5 * -(-rows // parts):
        return df
    return df.repartition(parts) if label is None else materialize(df.repartition(parts), label)
