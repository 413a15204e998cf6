"""Session construction and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "murmur",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings every job relies on.

    Cluster-sized settings (shuffle partitions, executor memory) come from the
    cluster's own configuration; ``shuffle_partitions`` is only for tests and
    local runs.  AQE stays on so partition counts adapt at run time.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # GBK training files (reference input contract) need the legacy charsets.
        "spark.sql.legacy.javaCharsets": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a single-process session (``local[...]``) that names none gets a fresh
    temporary folder; on any other master a machine-local folder would be
    invisible to the other machines, so a missing setting raises.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf:
        if not _single_process(sc.master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on master {sc.master}")
        conf = tempfile.mkdtemp(prefix="murmur-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def _single_process(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder, removed when
    the application ends."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = "/" + base[len("file:"):].lstrip("/")
    path = f"{base.rstrip('/')}/murmur-{name}-{uuid.uuid4().hex[:12]}"
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(hpath)               # deleteOnExit only takes paths that exist
    fs.deleteOnExit(hpath)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists in its (Hadoop) file system; other errors raise."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hpath)


def cut(df):
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage
    (reliable checkpoint: survives executor loss; never a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
