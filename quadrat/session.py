"""Session settings and lineage control shared by every job."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings the operators are designed around.  Joins carry no broadcast
# hints: adaptive execution turns a shuffle join into a broadcast join only after
# it has measured the small side, and splits the partitions of a hot key.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",  # whole texts go to Python: rows alone do not bound a batch
}


def build_session(app: str = "quadrat", master: str | None = None, **conf: str) -> SparkSession:
    """Session for local runs, tests and the benchmark; on a cluster pass no master."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, "spark.sql.session.timeZone": "UTC", **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one named in ``spark.checkpoint.dir``.

    Unset in local mode, a folder beside the warehouse tables is taken; on a cluster an
    unset folder is an error.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if shared:
        return shared.rstrip("/")
    named = context._jsc.sc().getCheckpointDir()
    if named.isDefined():
        return named.get().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/steps"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fan_out(df: DataFrame) -> DataFrame:
    """Spread a compact input over all cores before costly per-row work.

    An input big enough to fill every core with file splits of its own is left alone.
    """
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(cores) if size < cores * split else df


def new_folder(spark: SparkSession, kind: str) -> str:
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written table.

    The result survives the loss of any executor, is computed once however often it is
    read, and its size is known to the planner.
    """
    path = new_folder(df.sparkSession, "step")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Steps of an iteration: written like :func:`cut_lineage`, and removed when they are no longer read."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.made: list[tuple[str, DataFrame]] = []

    def cut(self, df: DataFrame) -> DataFrame:
        path = new_folder(self.spark, "step")
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        self.made.append((path, back))
        return back

    def drop(self, keep: tuple[DataFrame, ...] = ()) -> None:
        """Remove all steps but those of ``keep``; nothing lazy may depend on them any more."""
        stay = [(path, df) for path, df in self.made if any(df is k for k in keep)]
        for path, df in self.made:
            if not any(df is k for k in keep):
                folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
        self.made = stay
