"""One text file for a result."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from windrow import hadoop

ONE = "one"
PARTS = "parts"


def write_single_text(
    df: DataFrame, path: str, value: str = "value", files: str = ONE
) -> list[str]:
    """Write all lines to the named file, replacing it; returns the files written.

    The lines are first written in parallel. With ``files="one"``, of any size,
    one task merges them into the named file. With ``files="parts"`` they stay
    as ``path-00000-of-00042`` and so on. Each form removes what an earlier
    write of either form has left.
    """
    if files not in (ONE, PARTS):
        raise ValueError(f"files must be {ONE} or {PARTS}, not {files}")
    spark = df.sparkSession
    base = path.rstrip("/")
    staging = f"{base}.staging-{uuid.uuid4().hex}"
    try:
        df.select(value).write.text(f"{staging}/parts")
        parts = hadoop.glob(spark, f"{staging}/parts/part-*")
        if files == ONE and len(parts) > 1:
            lines = spark.read.text(f"{staging}/parts", lineSep="\n")
            lines.coalesce(1).write.text(f"{staging}/one")
            parts = hadoop.glob(spark, f"{staging}/one/part-*")
        if files == ONE:
            targets = [base]
        else:
            targets = [f"{base}-{i:05d}-of-{len(parts):05d}" for i in range(len(parts))]
        hadoop.replace_all(spark, zip(parts, targets))
        folder, _, name = base.rpartition("/")
        digits = "[0-9]" * 5
        stale = hadoop.glob_below(spark, folder or ".", f"{hadoop.literal(name)}-{digits}-of-{digits}")
        current = {target.rpartition("/")[2] for target in targets}
        for old in [*stale, base]:
            if old.rpartition("/")[2] not in current:
                hadoop.delete(spark, old)
    finally:
        hadoop.delete(spark, staging)
    return targets
