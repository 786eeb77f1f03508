"""Sessions for tests and benchmarks, and the folder for written intermediates."""

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(name: str, cores: int = 8, **settings: str) -> SparkSession:
    """A local session for tests and benchmarks.  A cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false")
        # Call sites in error messages cost several calls to the JVM per expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Where the setting is missing, a local session gets a temporary folder; on a
    cluster that would be a different disk per machine, so it is an error there.
    """
    conf = spark.sparkContext.getConf()
    folder = spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="obsengine-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


# Paths handed out by this process, per application.
_handed_out: dict[str, list[str]] = {}


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; nothing is created or removed.

    What operators write there feeds their lazy results, so it stays until
    ``drop_scratch`` is called.
    """
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _handed_out.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete what operators of this application wrote to fresh folders; returns their number.

    Call it when their results have been used; results read later would fail.
    """
    paths = _handed_out.pop(spark.sparkContext.applicationId, [])
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    dropped = 0
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        dropped += target.getFileSystem(conf).delete(target, True)
    return dropped


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` usable, in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
