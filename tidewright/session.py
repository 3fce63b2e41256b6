"""A session with the settings the jobs rely on."""

from pyspark.sql import SparkSession

# AQE picks broadcast joins from measured sizes, merges small shuffle partitions and splits skewed
# ones. forceOptimizeSkewedJoin lets it split a hot join key even where that costs one more exchange.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "static",
    # A shuffle task that is rerun after a lost executor and gives other rows than before makes its
    # readers rerun too, instead of mixing both outputs.
    "spark.sql.shuffle.orderIndependentChecksum.enabled": "true",
    "spark.sql.shuffle.orderIndependentChecksum.enableFullRetryOnMismatch": "true",
}


# Shuffle partitions of about this size sort and aggregate in memory on usual executors.
_PARTITION_BYTES = 256 * 1024 * 1024


def shuffle_partitions(shuffled_bytes: int, at_least: int = 200) -> int:
    """Initial number of shuffle partitions; AQE merges the ones that turn out small.

    The default of 200 would give partitions of half a terabyte when 100 TB are shuffled.
    """
    return max(at_least, -(-shuffled_bytes // _PARTITION_BYTES))


def build_session(app="tidewright", master=None, input_bytes: int | None = None, **extra) -> SparkSession:
    """A session for inputs of about `input_bytes`, which sets the number of shuffle partitions."""
    builder = SparkSession.builder.appName(app)
    if input_bytes is not None:
        extra = {"spark.sql.shuffle.partitions": str(shuffle_partitions(input_bytes)), **extra}
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
