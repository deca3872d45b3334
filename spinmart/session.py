"""Session settings the jobs are tuned for."""

from pyspark.sql import SparkSession

from spinmart.operators.staging import own_folder

# The rank pairing join may reuse the shuffle of its own window, one exchange per side in place of
# two. Heavy users do not make that uneven: ``pair_nth`` joins them apart, on the rank as well.
JOB_SETTINGS = {"spark.sql.requireAllClusterKeysForCoPartition": "false"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings of the jobs to a running session."""
    for key, value in JOB_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build_session(app: str, master: str | None = None, shuffle_partitions: int | None = None,
                  **extra: str) -> SparkSession:
    """New session for the jobs, adaptive execution on."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
        if master.startswith("local") and "cluster" not in master and "spark.checkpoint.dir" not in extra:
            extra = {**extra, "spark.checkpoint.dir": own_folder()}
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())
