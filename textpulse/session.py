"""Spark session settings and the shared work folder."""

from __future__ import annotations

import functools
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# UTC everywhere: local calendar columns are derived explicitly.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Call-site capture adds several JVM calls to every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_session(app_name: str = "textpulse", **conf: str) -> SparkSession:
    """Session with the settings the operators expect; ``conf`` adds or overrides."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Folder shared by all executors for staged tables and stream checkpoints.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where
    driver and executors share one disk, may fall back to a temporary folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return _local_folder()


_FOLDERS: set[str] = set()  # what this driver has put into the work folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of one's own in the work folder, until ``release``."""
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _FOLDERS.add(path)
    return path


def release(spark: SparkSession) -> None:
    """Deletes every folder that this driver has staged so far.

    Results that read staged tables are lazy, so their tables stay until the caller has used them and
    says so. A job's entry point calls this when it ends; a long session may after each result.
    """
    while _FOLDERS:
        delete(spark, _FOLDERS.pop())


def stage(df: DataFrame) -> DataFrame:
    """``df`` written once to the work folder and read back.

    For results that several branches of a job read: the work runs once, lineage ends at
    the files, and every reader prunes columns.
    """
    path = new_folder(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unstage(df: DataFrame) -> None:
    """Delete the files of a staged table that nothing reads any more."""
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        delete(df.sparkSession, folder)


def _path(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _path(spark, path)
    return fs.exists(hadoop)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of one's own; nothing happens if there is none."""
    hadoop, fs = _path(spark, path)
    fs.delete(hadoop, True)


def replace_folder(spark: SparkSession, fresh: str, path: str) -> None:
    """A folder takes another's place, which is kept aside until it has."""
    source, fs = _path(spark, fresh)
    target, _ = _path(spark, path)
    aside, _ = _path(spark, f"{path}.{uuid.uuid4().hex}")
    held = fs.exists(target)
    if held and not fs.rename(target, aside) or not fs.rename(source, target):
        raise OSError(f"cannot replace {path}")
    if held:
        fs.delete(aside, True)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no folder."""
    hadoop, fs = _path(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(hadoop)] if fs.exists(hadoop) else []


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    hadoop, fs = _path(spark, path)
    stream = fs.open(hadoop)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def exactly(path: str) -> str:
    """A path as a reader takes it, which would find patterns in it."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def packed(spark: SparkSession, path: str) -> bool:
    """Whether readers unpack a file of this name, so that none but a reader of whole files sees its bytes."""
    codecs = spark.sparkContext._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration())
    return codecs.getCodec(_path(spark, path)[0]) is not None


def read_bytes(spark: SparkSession, path: str, at: int, count: int) -> bytes:
    """At most ``count`` bytes of a file from a place on."""
    hadoop, fs = _path(spark, path)
    stream = fs.open(hadoop)
    try:
        stream.seek(at)
        return bytes(stream.readNBytes(count))
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is there whole or not at all; one that is there already is an error."""
    hadoop, fs = _path(spark, path)
    if fs.exists(hadoop):
        raise FileExistsError(path)
    attempt, _ = _path(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(attempt, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()
    if not fs.rename(attempt, hadoop):
        raise FileExistsError(path)


@functools.cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="textpulse-")


def utc(function):
    """``function(spark, ...)`` with the session in the time zone the operators require."""
    @functools.wraps(function)
    def run(spark: SparkSession, *args):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return function(spark, *args)

    return run
