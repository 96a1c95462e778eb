"""Session construction and shared-storage helpers."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Defaults chosen for large inputs:
#  * AQE re-plans on runtime sizes: coalesces small shuffle partitions, splits
#    skewed join partitions, and turns a sort-merge join into a broadcast join
#    only once the *materialised* size of a side is known to be small.
#  * Static (estimate-based) broadcast is off: plan-time size estimates of
#    filtered or aggregated inputs can be wrong by orders of magnitude, and a
#    wrong broadcast collects a large table on the driver. Code in this package
#    broadcasts only one-row aggregates, fixed-size dimensions or sides whose
#    row count it has checked.
DEFAULT_CONF: dict[str, str] = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # remove checkpoint files once the DataFrame that wrote them is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "riskframe", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    No master is hard-coded: on a cluster the launcher supplies it.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only in local mode (tests, a laptop), when none
    is named, is a fresh folder created and registered, so later calls and
    ``DataFrame.checkpoint()`` agree on one place; on a cluster a missing
    setting is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if root:
        return root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if sc is None:
        if not root:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return root
    if not root:
        if not sc.master.startswith("local"):
            # a machine-local folder is not shared by the executors of a cluster
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="riskframe-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def materialize(df):
    """Compute ``df`` once and write it to the shared checkpoint folder
    (reliable ``checkpoint``, not a local one, so it survives executor loss).

    Used for small intermediate results read more than once, such as a
    per-group aggregate that is both the answer and the input of an overall
    figure: the large source is then scanned once instead of once per use.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stage_table(df, name: str, partition_by: list[str] | None = None, path: str | None = None, even: bool = False):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    return a reader of it: for inputs that an iterative job (imputer,
    scaler, tree fits) scans many times and that are costly to recompute,
    such as a join. Columnar, so later passes read only the columns they use.

    With ``even`` the rows are first dealt to one file a core, of equally many rows: a reader then has one equal
    partition a core. A join may leave a few more partitions than cores, and each pass of an iterative fit over them
    then takes two rounds of tasks, the second with most cores idle. The files fix the order of the rows, so a
    lost partition is read again as it was (a fit may match it with others row by row).

    The files stay as long as the application runs, since lazy results may still read
    them, and are removed when it ends (``remove_staged`` removes them earlier).
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    if even:
        df = df.repartition(spark.sparkContext.defaultParallelism)
    df.write.mode("overwrite").parquet(path, partitionBy=partition_by)
    _remove_at_end(spark, path)
    # an empty partitioned table leaves no file to read the schema from
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def wide_rows(spark: SparkSession) -> Iterator[None]:
    """Run the jobs of the block with expressions over many columns compiled in small methods.

    A stage's projections are compiled into one Java method, and the JVM interprets a method above 8,000 bytes of code
    without ever compiling it; with this limit Spark cuts such a projection into several methods. Plans that run after the
    block (lazy results) have the session's own setting.
    """
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, "8000")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def _folder(spark, path: str):
    """The Hadoop path and its file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _remove_at_end(spark, path: str) -> None:
    """Have the file system remove ``path`` when the driver ends."""
    p, fs = _folder(spark, path)
    fs.deleteOnExit(p)


def remove_staged(spark, path: str) -> bool:
    """Remove a staged folder whose readers are done. Only paths under the checkpoint folder are removed."""
    if not path.startswith(checkpoint_root(spark).rstrip("/") + "/"):
        raise ValueError(f"{path!r} is not under the checkpoint folder")
    p, fs = _folder(spark, path)
    return bool(fs.delete(p, True))


def release_shuffles(spark) -> None:
    """Have Spark's cleaner remove the shuffle files of finished jobs whose DataFrames are gone.

    The cleaner acts when the driver's JVM collects garbage, which on an idle driver may take long; between the
    steps of a job with large shuffles the files would add up.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def sizing_conf(input_bytes: int, total_cores: int,
                split_bytes: int = 256 * 1024 * 1024,
                shuffle_bytes_per_partition: int = 512 * 1024 * 1024,
                max_shuffle_partitions: int | None = None) -> dict[str, str]:
    """Partition settings sized to the input, for ``build_session(conf=...)``.

    * scan splits of ``split_bytes`` (one task reads at most that much);
    * an initial shuffle width giving at most ``shuffle_bytes_per_partition``
      of input per partition (and at least 3 tasks per core); AQE then
      coalesces small partitions to the advisory size after each stage;
    * skew handling: a partition 5x the median and above 1 GB is split.

    For 100 TB on 1000 executors x 8 cores this gives 256 MB splits and
    186,265 initial shuffle partitions of at most 512 MB, coalesced at run time.
    ``max_shuffle_partitions`` (off by default) trades larger partitions for fewer shuffle blocks.
    """
    shuffle = max(3 * total_cores, -(-input_bytes // shuffle_bytes_per_partition))
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(min(shuffle, max_shuffle_partitions or shuffle)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
    }
