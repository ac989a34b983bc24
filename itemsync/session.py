"""Session set-up and the two settings the library reads from it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cores: str = "8", app: str = "itemsync") -> SparkSession:
    """A session for tests and benches on one machine.

    Call sites are not recorded for every column expression, as that takes most
    of the time in which a plan is built.
    """
    return prepare(
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the time zone the text forms of instants rely on; AQE does the rest.

    Bytes are decoded by every charset the JVM has, and undecodable ones are replaced,
    so that one bad attachment does not end a run.
    """
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    spark.conf.set("spark.sql.legacy.codingErrorAction", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by the cluster.

    Only where the session names none and runs on one machine (a test) is one made.
    """
    named = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getConf().get(CHECKPOINT_SETTING)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that driver and executors share")
    made = tempfile.mkdtemp(prefix="itemsync-")
    spark.conf.set(CHECKPOINT_SETTING, made)
    return made


def work_dir(spark: SparkSession) -> str:
    """Folder of this application's intermediate tables, within the shared folder."""
    return f"{shared_dir(spark)}/itemsync-{spark.sparkContext.applicationId}"


def sweep(spark: SparkSession) -> None:
    """Remove the intermediate tables, once the results that read them are stored elsewhere."""
    path = spark._jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back as a fresh plan."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of the work folder, so that its real size is known to the plans that read it."""
    folder = f"{work_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
