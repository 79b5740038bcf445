"""Session helpers: a local session for tests and benches, and the shared
scratch folder every job writes intermediate tables to.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names;
we never pick a machine-local path there. Only when the setting is absent
(local tests) do we create one under the system temp folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "rangewise") -> SparkSession:
    """Session for tests / bench on one machine. Cluster jobs bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("RANGEWISE_DRIVER_MEM", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared scratch folder (``spark.checkpoint.dir``).

    Read from the session. Where it is unset, a local master (tests, benches)
    gets a private temp folder registered as the checkpoint dir; any other
    master is refused, because a folder of one machine is invisible to the
    others.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        master = sc.master or ""
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(
                f"spark.checkpoint.dir is not set and the master is {master!r}: "
                "name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="rangewise-ckpt-"))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared folder for one job's output."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def drop_scratch(spark: SparkSession, path: str) -> bool:
    """Delete one scratch path; True if it existed."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    gone = bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))
    _SCRATCH.remove(path)
    return gone


def clear_scratch(spark: SparkSession, keep: tuple[str, ...] = ()) -> int:
    """Delete the scratch paths this process made, but for ``keep``.

    Call it when the frames that read them have been consumed. Returns the
    number of paths that existed.
    """
    return sum(drop_scratch(spark, path) for path in [p for p in _SCRATCH if p not in keep])


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so Python
    functions of its modules can be imported there without any installation."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="rangewise-pkg-"), "rangewise_pkg.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(archive)
    _SHIPPED.add(sc.applicationId)


def cluster_settings(shuffle_bytes: int, executors: int, cores_per_executor: int,
                     target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Session settings for a cluster run, sized from the expected shuffle
    volume (for the refresh: about the fact's width x rows).

    * initial shuffle partitions: enough for ``target_partition_bytes`` each,
      at least two waves of tasks; AQE coalesces what turns out smaller;
    * splits of 256 MB for the Parquet / text scans;
    * AQE skew handling for joins and rebalances, with a skew threshold tied
      to the partition target.
    """
    slots = max(1, executors * cores_per_executor)
    partitions = max(2 * slots, -(-int(shuffle_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
