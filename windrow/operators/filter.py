"""Row filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from windrow.functions.scalars import equals_ignore_case, field


def filter_flag(
    df: DataFrame, position: int = 11, flag: str = "1", cols: str = "cols"
) -> DataFrame:
    """Keep rows whose field equals the flag, ignoring case and without trimming.

    A row without that field fails the job.
    """
    return df.where(equals_ignore_case(field(cols, position), flag))


def drop_malformed(
    df: DataFrame, well_formed: Column, observation: Observation | None = None
) -> DataFrame:
    """Drop rows that are not well formed, counting them in ``observation`` as ``dropped``."""
    if observation is not None:
        df = df.observe(observation, F.count_if(~well_formed).alias("dropped"))
    return df.where(well_formed)
