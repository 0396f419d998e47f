"""Zone-free, engine-comparable presentation of result DataFrames.

Instants (``TIMESTAMP``) are shown as wall clock in the declared zone
(``TIMESTAMP_NTZ``), so a result reads the same under any session zone and
compares with another engine without zone conversion. Means are rounded to six
decimals after a 1e-9 nudge, which keeps exact ties from rounding apart when
two engines add the same numbers in a different order.
"""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from trafficwatch.config import TIMEZONE
from trafficwatch.functions.timeutil import local_time


def round_mean(c, places: int = 6):
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col + F.lit(1e-9), places)


def present(df: DataFrame, means: Iterable[str] = (), drop: Iterable[str] = (),
            tz: str = TIMEZONE) -> DataFrame:
    means, drop = set(means), set(drop)
    cols = []
    for field in df.schema.fields:
        name = field.name
        if name in drop:
            continue
        if isinstance(field.dataType, TimestampType):
            cols.append(local_time(F.col(name), tz).alias(name))
        elif name in means:
            cols.append(round_mean(name).alias(name))
        else:
            cols.append(F.col(name))
    return df.select(*cols)
