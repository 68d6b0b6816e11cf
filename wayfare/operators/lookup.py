"""Left joins to lookup tables whose size is bounded before they are broadcast."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare import schema as S

def zone_keyed(lookup: DataFrame, *zone_columns: str) -> DataFrame:
    """Hint a broadcast of a lookup holding one row per zone, or per pair of zones.

    The filter on the zone domain bounds it at 265 or 70,225 rows whatever the data volume, so no
    count is needed. Zone ids outside the domain never survive cleaning.
    """
    if len(zone_columns) > 2:
        raise ValueError("at most two zone columns keep the lookup inside the broadcast bound")
    inside = [F.col(c).between(S.MIN_ZONE, S.MAX_ZONE) for c in zone_columns]
    for condition in inside:
        lookup = lookup.filter(condition)
    return F.broadcast(lookup)


def left_lookup(df: DataFrame, lookup: DataFrame, on: list[str], defaults: dict | None = None) -> DataFrame:
    """Left equi-join; unmatched rows take the given defaults."""
    joined = df.join(lookup, on, "left")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items()})
