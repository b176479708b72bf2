"""Session settings for tests and benchmarks, and the shared work folder."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
#: Bytes of code up to which the JVM compiles a method.
COMPILED = 8000


def keep_methods_compiled(spark):
    """Have Spark split projections that would become one method too long for the JVM to compile.

    By default Spark fuses up to 65535 bytes into a method; beyond 8000 it is interpreted for every row, so wide
    projections cost several times as much. A lower limit of the session stays; results do not depend on it.
    """
    if int(spark.conf.get(METHOD_LIMIT, "65535")) > COMPILED:
        spark.conf.set(METHOD_LIMIT, str(COMPILED))


def local_session(cores="*", shuffle_partitions=8, app="tarmac"):
    """A single-machine session; on a cluster the submitter configures its own.

    Jobs and registered queries lower the method limit themselves, see `keep_methods_compiled`.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config(METHOD_LIMIT, str(COMPILED))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def work_folder(spark, purpose):
    """A fresh path for intermediate tables, below the folder the cluster shares.

    ``spark.checkpoint.dir`` names that folder. Only a local session may fall back to a folder
    of this machine, because there every task runs on it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="tarmac-")
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def forget(spark, path):
    """Delete an intermediate table that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark):
    """Inside, shuffle files go when the write or the count that made them has ended, not when the driver next collects
    garbage. For steps that store or collect every table once."""
    before = spark.conf.get(SHUFFLES_END, "false")
    spark.conf.set(SHUFFLES_END, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_END, before)
