"""Session construction and shared-storage helpers.

The library never picks a machine-local folder when the cluster already
names a shared one: ``spark.checkpoint.dir`` is read from the session and
only filled in (with a fresh temp folder) when it is unset, which is the
local/test situation.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files go when the tables that use them are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "shelflens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    On a cluster ``master`` stays None and the launcher decides; locally
    ``local[N]`` with shuffle partitions sized to the cores.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def scale_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings sized to the input for cluster runs (pass as ``extra``).

    Shuffle partitions start at ~one per ``partition_bytes`` of input (never
    fewer than 2x the cores) so that no reducer needs more than a few hundred
    MB even before partial aggregation shrinks the data; AQE then coalesces
    small partitions to the same advisory size and splits skewed join
    partitions above it.
    """
    n = max(2 * total_cores, -(-input_bytes // partition_bytes))
    size = f"{partition_bytes >> 20}m"
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.files.maxPartitionBytes": size,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": size,
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16m",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": size,
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder, creating a local one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        # Local/test sessions only: one JVM, so a temp folder is "shared".
        configured = tempfile.mkdtemp(prefix="shelflens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_dir(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    base = base.rstrip("/")
    # The checkpoint dir already carries a per-application uuid suffix.
    # Spark's writers create the folder themselves, on whatever filesystem
    # the checkpoint location lives on.
    return f"{base}/{name}-{uuid.uuid4().hex}"


def written(df, name: str = "table"):
    """Write ``df`` as Parquet in the shared folder and read it back.  Cuts the
    lineage like ``pin``, but the result is a plain file scan whose size is that of its
    files: use it in loops, where a checkpoint would keep (and each join multiply) the
    optimizer's size estimate of the plan it came from."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pin(df):
    """Materialise ``df`` as a reliable checkpoint in the shared folder (cuts
    lineage; a lost executor re-reads blocks instead of replaying the plan)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
