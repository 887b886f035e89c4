"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import math
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# A table of at most this many short rows may be broadcast.  Every broadcast in
# the package is behind this bound or a bound in bytes; larger sides are shuffled.
BROADCAST_ROWS = 100_000
# A task that groups rows holds some 450 bytes for each, in several hash tables.
ROWS_PER_TASK = 250_000


def build_session(
    app_name: str = "tidepair",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    state_on_disk: bool = True,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session in UTC with adaptive execution.

    On a cluster leave ``master`` and ``shuffle_partitions`` to the deployment;
    adaptive execution coalesces small shuffle partitions and splits skewed
    join partitions.  ``state_on_disk`` keeps streaming state in RocksDB, whose
    size the heap does not bound.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if state_on_disk:
        builder = builder.config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application.

    Functions of the package are then pickled by name, so a closure stays small, and
    queries run from any folder.
    """
    context = spark.sparkContext
    if getattr(context, "_tidepair_shipped", False):
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tidepair-package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent))
    context.addPyFile(str(target))
    context._tidepair_shipped = True


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def partitions_for(spark: SparkSession, rows: int) -> int:
    """Partitions that grow with the rows, so that a task's groups do not."""
    return max(shuffle_partitions(spark), math.ceil(rows / ROWS_PER_TASK))


def tile_side(spark: SparkSession) -> int:
    """Blocks per side so that their square gives every core a few tiles."""
    return math.ceil(math.sqrt(4 * shuffle_partitions(spark)))


def scratch_root(spark: SparkSession) -> str:
    """This application's folder below the one the cluster names for checkpoints.

    The setting ``spark.checkpoint.dir`` (or a checkpoint folder set on the
    context) is used as it is.  Only a local session without either gets a
    temporary folder of its own; elsewhere a machine-local folder would not be
    seen by the other executors, so that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        root = tempfile.mkdtemp(prefix="tidepair-")
        spark.sparkContext.setCheckpointDir(root)
    return f"{root.rstrip('/')}/tidepair/{spark.sparkContext.applicationId}"


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder path in the application's folder."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one result feeds several jobs.  The table outlives a lost
    executor, cuts the lineage, and its row count comes from file footers.  It
    stays until :func:`discard` is called with it, or :func:`discard_all`.
    """
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._tidepair_path = path
    return table


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that nothing will read any more."""
    for table in tables:
        if path := getattr(table, "_tidepair_path", None):
            _delete(table.sparkSession, path)


def discard_all(spark: SparkSession) -> None:
    """Delete every folder that this application has written below the shared one."""
    _delete(spark, scratch_root(spark))
