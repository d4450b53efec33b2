"""Session helpers: sane defaults for local runs, and where shared checkpoints live."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def get_session(app_name: str = "pitwise", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Build or reuse a session. Cluster settings win: nothing here is forced on an existing one."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = builder.config("spark.driver.memory", "8g")     # the one memory setting of local mode
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def has_shared_folder(spark: SparkSession) -> bool:
    """Point Spark at the shared checkpoint folder that the session names, if it names one."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return True
    shared = spark.conf.get(CHECKPOINT_KEY, None) or context.getConf().get(CHECKPOINT_KEY)
    if shared:
        context.setCheckpointDir(shared)
    return bool(shared)


def materialize(df: DataFrame) -> DataFrame:
    """Compute once for several readers.

    With a shared folder named by the session this is a reliable checkpoint: a lost executor costs a read of it. Without one (tests,
    small local runs) the frame is kept in memory and on the executors' disks, and lost parts are computed again.
    """
    if has_shared_folder(df.sparkSession):
        return df.checkpoint(eager=True)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def spread(df: DataFrame) -> DataFrame:
    """Give heavy per-row work a task per core when the input arrives in fewer pieces (one small file).

    Inputs with enough partitions, the normal case on a cluster, are returned as they are, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
