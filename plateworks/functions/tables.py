"""Table functions for SQL.

``register(spark)`` makes ``growth_parameters`` known:

    select * from growth_parameters(table(readings) partition by (plate, well) order by hours)

The table argument needs columns ``hours`` and ``od``; its other columns, the keys, come back with the
fit of the rows that have them. A partition may hold several keys, which are fitted together (faster than a
partition each), as long as all rows of a key are in it: ``partition by pmod(hash(plate, well), 100)``.
"""

from __future__ import annotations

import sys

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

from ..operators.plates import TOGETHER, fit_many


class GrowthParameters:
    """One row a key: its columns, the number of readings, and the logistic fit (``fit_many``).

    Readings without hours or density are not counted; null keys are keys.
    """

    def __init__(self):
        self.curves = {}

    @staticmethod
    def analyze(readings: AnalyzeArgument) -> AnalyzeResult:
        if not readings.isTable:
            raise ValueError("growth_parameters takes a table")
        kinds = {f.name: f.dataType for f in readings.dataType.fields}
        for name in ("hours", "od"):
            if name not in kinds:
                raise ValueError(f"the table has no column {name}")
        keys = [f for f in readings.dataType.fields if f.name not in ("hours", "od")]
        fit = [StructField("n_readings", LongType()), StructField("fit_ok", BooleanType()), *(StructField(n, DoubleType()) for n in ("top", "rate", "middle", "start", "reach", "generation_time"))]
        return AnalyzeResult(StructType([*keys, *fit]))

    def eval(self, readings: Row):
        found = readings.asDict()
        hours, od = found.pop("hours"), found.pop("od")
        curve = self.curves.setdefault(tuple(found.values()), [])
        if hours is not None and od is not None:
            curve.append((float(hours), float(od)))

    def terminate(self):
        keys = list(self.curves)
        for low in range(0, len(keys), TOGETHER):
            some = [sorted(self.curves[k]) for k in keys[low : low + TOGETHER]]
            fits = fit_many([[h for h, _ in c] for c in some], [[o for _, o in c] for c in some])
            for key, curve, fit in zip(keys[low:], some, fits):
                yield (*key, len(curve), *fit)


def register(spark: SparkSession) -> None:
    """Make the table functions known to SQL; their code goes to the executors with them."""
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.udtf.register("growth_parameters", udtf(GrowthParameters))
