"""Deterministic fixed-size samples without replacement."""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.operators.selection import locate_near

HASH_DIGITS = 15  # 60 bits of the digest, as a positive bigint
MARGIN = 6  # deviations around the expected cut


def hash_position(key: Column, seed: int) -> Column:
    """Pseudo-random place of a row in 0 .. 2^60 - 1, fixed by its key and the seed."""
    digest = F.md5(F.concat_ws("|", key, F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, HASH_DIGITS), 16, 10).cast("bigint")


def sample_rows(df: DataFrame, n: int, key: Column, seed: int = 42) -> DataFrame:
    """The n rows with the lowest hash positions: the same rows on every run and cluster size.

    The cut-off position is found by rank selection, then the sample is a plain filter. Nothing is
    sorted or gathered, whatever n is. ``key`` should tell rows apart; of rows that share the
    cut-off position, the first by all columns are taken, as many as the sample still needs. A smaller table comes back whole.
    """
    position = hash_position(key, seed)
    size = df.count()
    if size <= n:
        return df
    # positions are even over their range, so the cut lies near n / size of it
    whole = 16**HASH_DIGITS
    slack = (MARGIN * math.sqrt(n) + MARGIN) / size
    lo, hi = (min(max(int((n / size + side * slack) * whole), 0), whole - 1) for side in (-1, 1))
    cut = locate_near(df, position, n, lo, hi, (size, 0, whole - 1))
    below = df.filter(position < F.lit(cut.value))
    if cut.below == n:
        return below
    ties = df.filter(position == F.lit(cut.value)).orderBy(*df.columns)
    return below.unionAll(ties.limit(n - cut.below))
