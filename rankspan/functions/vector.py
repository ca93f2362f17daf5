"""Dense-vector Column helpers (array<double>)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def l2_norm(vec: Column) -> Column:
    return F.sqrt(F.aggregate(vec, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def l2_normalize(vec: Column) -> Column:
    """Unit-length copy of ``vec`` as array<double>; a zero vector stays zero."""
    # the norm is bound to a variable: inside the inner lambda it would be formed for every value
    unit = F.transform(F.array(l2_norm(vec)), lambda norm: F.transform(
        vec, lambda x: F.when(norm > 0, x.cast("double") / norm).otherwise(F.lit(0.0))))
    return F.get(unit, F.lit(0))
