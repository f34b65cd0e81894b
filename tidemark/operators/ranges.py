"""Which of many sorted key ranges does a key fall in? A binary search as a column expression.

A range goes from its least key up to the next range's; keys below the first range fall in the first one.
The bounds are one literal array, so looking a key up costs the logarithm of the number of ranges and no
join, and the rows to look up are not shuffled for it.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column as SparkColumn
from pyspark.sql import functions as F


def range_number(key: SparkColumn, least: Sequence) -> SparkColumn:
    """Number, from 0, of the range that ``key`` falls in; ``least`` are the ranges' least keys, sorted."""
    if len(least) < 2:
        return F.lit(0)
    bounds = F.lit(np.array(least, np.int64)) if isinstance(least[0], int) else F.lit(list(least))
    steps = F.sequence(F.lit(1), F.lit(len(least).bit_length()))
    # Of the bounds, ``lo`` are known to be at most the key, and those from ``hi`` on to be greater.
    begin = F.struct(F.lit(0).alias("lo"), F.lit(len(least)).alias("hi"))

    def halve(s: SparkColumn, _: SparkColumn) -> SparkColumn:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        below = F.coalesce((s["lo"] < s["hi"]) & (F.get(bounds, mid) <= key), F.lit(False))
        return F.when(below, F.struct((mid + 1).alias("lo"), s["hi"].alias("hi"))).otherwise(
            F.struct(s["lo"].alias("lo"), F.least(s["hi"], mid).alias("hi")))

    return F.greatest(F.aggregate(steps, begin, halve, lambda s: s["lo"]) - 1, F.lit(0))
