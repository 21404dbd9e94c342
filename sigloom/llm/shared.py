"""What the operators of this subpackage share: tables, written intermediates, ids."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid

import pyarrow as pa
from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the input; Python workers find this package where the driver did, unless they have it installed."""
    bounded(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that Spark hands to a Python worker at once: texts of some kilobytes make a megabyte or two.
BATCH = 500
#: Python workers give large blocks of memory back to the system rather than keep them for themselves.
MEMORY = {"MALLOC_ARENA_MAX": "1", "MALLOC_MMAP_THRESHOLD_": str(1 << 25), "MALLOC_TRIM_THRESHOLD_": str(1 << 25), "ARROW_DEFAULT_MEMORY_POOL": "system"}


def bounded(spark: SparkSession) -> None:
    """Keep Arrow batches small and Python workers lean; set by every operator that hands texts to workers."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH)
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "")
    if ROOT not in paths.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [paths, ROOT]))
    for name, value in MEMORY.items():
        environment.setdefault(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session names it.

    Only where ``spark.checkpoint.dir`` is unset and all run on one machine (tests, a laptop) a temporary
    folder takes its place, for the rest of the session; on a cluster that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        found = "file://" + tempfile.mkdtemp(prefix="sigloom-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def released(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that nothing refers to any more, and give what the driver has freed back to the system.

    Compiling plans and collecting rows leave freed blocks in the C library's heaps, the JVM's and Python's, which
    would count as the driver's memory until the session ends.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    trimmed(spark)


def trimmed(spark: SparkSession) -> None:
    """Return freed blocks of the driver's native heaps; does nothing where the C library or the JVM has no such call."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    named = jvm.java.lang.Class.forName
    try:
        # by the interface's method: the server's own class is not open to reflection
        kinds, args = gateway.new_array(jvm.java.lang.Class, 4), gateway.new_array(jvm.java.lang.Object, 4)
        for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
            kinds[i] = named(kind)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        named("javax.management.MBeanServer").getMethod("invoke", kinds).invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:  # another JVM
        pass


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again.

    Cuts the lineage, so that a lost executor costs one task and not the plan
    above, and so that work used twice is done once.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/sigloom/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression="zstd")
    released(spark)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables that :func:`written` made, once nothing reads them any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.written_at)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
