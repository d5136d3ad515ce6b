"""Session helpers: builder defaults, checkpoint directory, lineage cuts."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, app: str = "kestrel",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Session with AQE (coalesce + skew join) on, UTC clock, UI off.

    No master is hard-coded: ``master`` is only applied when given (tests,
    bench); on a cluster the launcher decides.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.ansi.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor (applies before JVM start)
        conf["spark.driver.memory"] = os.environ.get("KESTREL_DRIVER_MEMORY", "16g")
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster.

    Reads ``spark.checkpoint.dir`` (or an already set SparkContext dir).
    Only when none is set *and* the master is local (tests, bench) is a
    scratch folder created; on a cluster a missing setting is an error,
    because a machine-local folder does not survive executor loss.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        conf = tempfile.mkdtemp(prefix="kestrel-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(conf)
    return conf


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (never localCheckpoint): survives lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once below the shared folder and read back, column by column.

    For rows that a fit reads many times: a pass reads only the columns it needs, and the files
    are neither compressed nor dictionary-encoded, so the rows of a task are bounded by the size of its split."""
    import uuid

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.options(**{"compression": "none", "parquet.enable.dictionary": "false"}).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Remove the files of a ``stored`` frame that nothing reads any more."""
    at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
    at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``kestrel`` importable in Python workers (pandas UDFs pickle functions
    by module reference): zip the package once per application and add it with
    ``addPyFile``, which serves it to the executors from the driver, so the file
    system behind the checkpoint folder does not matter."""
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="kestrel-pkg-")
    target = os.path.join(os.path.realpath(folder), "kestrel.zip")
    with zipfile.ZipFile(target, "w") as z:
        for root, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg)))
    sc.addPyFile(target)
    _SHIPPED.add(app)
