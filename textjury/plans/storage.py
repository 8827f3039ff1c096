"""Where intermediate tables and models live."""

from __future__ import annotations

import json
import tempfile
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

SHARED_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session may go without: it gets a new temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get(SHARED_DIR, None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {SHARED_DIR} to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    return context.getCheckpointDir()


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to this application's shared folder and read back, for uses that would each compute it again."""
    path = f"{shared_dir(df.sparkSession)}/{df.sparkSession.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_run(spark: SparkSession) -> bool:
    """Delete what this application stored on the way: its own folder under the shared one, no other.

    Nothing that it returned may be read afterwards. Tells whether there was something.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file that must not exist yet; of several that try at once, one succeeds."""
    jvm = spark._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(place.getParent())
    try:
        if system.getScheme() == "file":  # Hadoop's own local create looks first and creates then
            nothing = spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0)
            local = system.makeQualified(place).toUri().getPath()
            jvm.java.nio.file.Files.createFile(jvm.java.io.File(local).toPath(), nothing)
        else:
            system.create(place, False).close()
    except Py4JJavaError as taken:
        if taken.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """JSON rows under ``path``, or None when nothing was written there yet."""
    try:
        return spark.read.schema(schema).option("recursiveFileLookup", "true").json(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def append_record(spark: SparkSession, path: str, record: dict[str, Any], schema: str) -> None:
    """Append one row. Its file appears when the write commits, whole or not at all.

    Each row has a folder of its own: writers that commit to one folder at once would share,
    and delete, their temporary files.
    """
    names = [field.split()[0] for field in schema.split(", ")]
    row = Row(*names)(*[record[name] for name in names])
    spark.createDataFrame([row], schema).coalesce(1).write.json(f"{path}/{uuid.uuid4().hex}")


def _listing(spark: SparkSession, paths: tuple[str, ...]) -> DataFrame:
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(list(paths))
        .select("path", "length", F.col("modificationTime").cast("double").alias("modified"))
    )


def source_state(spark: SparkSession, *paths: str) -> str:
    """A value that changes when files under ``paths`` are added, removed or rewritten.

    Looks at the file listing only; no content is read.
    """
    state = _listing(spark, paths).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.bit_xor(F.xxhash64("path", "length", "modified")).alias("hash"),
    ).first()
    return json.dumps(state.asDict(), sort_keys=True)
