"""Session settings to start from for a given amount of shuffled data."""

# What a shuffle partition and a scan split should hold.
SHUFFLE_BYTES = 1024**3
SPLIT_BYTES = 512 * 1024**2
# Map and reduce tasks multiply to blocks that driver and shuffle service keep track of.
MOST_PARTITIONS = 20_000


def session_settings(shuffle_bytes, cores):
    """Spark settings for a job whose largest shuffle moves `shuffle_bytes`, after pruning and partial sums, on `cores` cores.

    Adaptive execution merges partitions that turn out small and splits the skewed ones
    of a join; beyond MOST_PARTITIONS they get larger rather than more, and spill.
    """
    partitions = min(max(cores, -(-shuffle_bytes // SHUFFLE_BYTES)), max(cores, MOST_PARTITIONS))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(SPLIT_BYTES),
    }
