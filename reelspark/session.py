"""Session defaults and the reliable checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(
    app: str = "reelspark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with the settings the operators rely on.

    On a cluster, leave ``shuffle_partitions`` unset: AQE coalesces from the
    configured start value, splits skewed join partitions and turns small join
    sides into broadcasts after measuring them.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in (extra or {}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point checkpoints at the folder the cluster names in spark.checkpoint.dir.

    Without that setting only a local master gets a scratch folder of its own;
    a cluster must name shared storage, otherwise a lost executor loses data.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="reelspark-checkpoint-")
    context.setCheckpointDir(named)
