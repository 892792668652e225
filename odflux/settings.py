"""Session settings for a given amount of input."""

from __future__ import annotations

MIB = 1024 * 1024
SPLIT_BYTES = 128 * MIB
SHUFFLE_BYTES = 256 * MIB


def settings_for(
    input_bytes: int, cores: int, split_bytes: int = SPLIT_BYTES, shuffle_bytes: int = SHUFFLE_BYTES
) -> dict[str, str]:
    """Splits, shuffle partitions and file sizes.

    Splits have ``split_bytes`` each, and there is a shuffle partition for every
    ``shuffle_bytes`` of input. Adaptive execution merges what turns out small
    and splits skewed joins. Output folders are few, so their files are written
    side by side without a sort.
    """
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(SPLIT_BYTES),
        "spark.sql.shuffle.partitions": str(max(cores, -(-input_bytes // shuffle_bytes))),
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.maxConcurrentOutputFileWriters": "64",
        "spark.sql.session.timeZone": "UTC",
    }
