"""Session settings for the jobs; the library itself never creates a session."""

from pyspark.sql import SparkSession

MEBIBYTE = 1 << 20
#: Initial shuffle partitions where the shuffled bytes are not stated; adaptive planning
#: merges them, and half a terabyte in so many is 256 MiB each.
UNSTATED_PARTITIONS = 2000


def shuffle_partitions(
    shuffled_bytes: int, target_bytes: int = 256 * MEBIBYTE, most: int | None = None
) -> int:
    """Initial shuffle partitions of about ``target_bytes``; adaptive planning merges small
    ones. ``most`` bounds them where the driver's shuffle bookkeeping must stay small; beyond
    it partitions grow and spill."""
    wanted = max(200, -(-shuffled_bytes // target_bytes))
    return wanted if most is None else min(wanted, most)


def build_session(
    app_name: str, shuffled_bytes: int | None = None, **conf: str
) -> SparkSession:
    """Session with adaptive planning on: it coalesces small shuffle partitions, splits hot
    ones in joins and writes, and turns joins into broadcasts by measured size. An item
    master or a count schedule fits the raised broadcast limit, which is compared with four
    times the compressed file size; a fact table does not."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", "64MB")
        .config("spark.sql.sources.fileCompressionFactor", "4.0")
    )
    partitions = (
        UNSTATED_PARTITIONS if shuffled_bytes is None else shuffle_partitions(shuffled_bytes)
    )
    builder = builder.config(
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions)
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
