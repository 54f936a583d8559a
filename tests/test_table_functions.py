"""The table function gives the rows of the grouped fit, and refuses other tables."""

import math

import pytest

from plateworks.functions import tables
from plateworks.plans import catalog, extended

DATA = "/root/testdata/sf0.001"


def test_sql_call_equals_grouped_fit(spark):
    tables.register(spark)
    rows = [(p, f"A{w}", h / 2, (0.1 + p) / (1 + math.exp(-(1 + w) * (h / 2 - 5)))) for p in (0, 1) for w in (1, 2) for h in range(30)]
    rows += [(None, "B1", 1.0, None), (1, "C1", None, 0.5), (0, "D1", 1.0, 0.01)]
    spark.createDataFrame(rows, "plate int, well string, hours double, od double").createOrReplaceTempView("t_readings")
    got = {(r.plate, r.well): r for r in spark.sql("select * from growth_parameters(table(t_readings) partition by (plate, well) order by hours)").collect()}
    assert len(got) == 7 and got[None, "B1"].n_readings == 0 and not got[1, "C1"].fit_ok
    for w in (1, 2):
        fit = got[1, f"A{w}"]
        assert fit.fit_ok and fit.n_readings == 30 and math.isclose(fit.top, 1.1, rel_tol=1e-4) and math.isclose(fit.rate, 1 + w, rel_tol=1e-3) and math.isclose(fit.middle, 5, rel_tol=1e-3)
    with pytest.raises(Exception, match="no column od"):
        spark.sql("select * from growth_parameters(table(select 1 as hours))").collect()


def test_query_equals_grouped_fit_on_whole_table(spark):
    want = {r.curve_id: tuple(r)[1:] for r in catalog.growth_fits(spark, DATA).collect()}
    got = {f"{r.event_type}_{r.user_id}": tuple(r)[3:] for r in extended.growth_by_sql(spark, DATA).collect()}
    assert got.keys() == want.keys() and len(got) > 50
    for key, fit in want.items():
        assert got[key][0] == fit[0] and got[key][1:] == pytest.approx(fit[1:], rel=1e-9)


def test_curves_fitted_together_are_as_alone_and_in_one_partition(spark):
    from plateworks.operators import plates

    times = [[h / 2 for h in range(n)] for n in (30, 12, 30, 3, 12)]
    values = [[(0.3 + k) / (1 + math.exp(-(1 + k / 4) * (t - 3))) for t in ts] for k, ts in enumerate(times)]
    assert plates.fit_many(times, values) == [plates.fit_logistic(t, y) for t, y in zip(times, values)]
    rows = [(k, t, y) for k, (ts, ys) in enumerate(zip(times, values)) for t, y in zip(ts, ys)]
    spark.createDataFrame(rows, "well int, hours double, od double").createOrReplaceTempView("t_wells")
    tables.register(spark)
    got = {r.well: tuple(r)[2:] for r in spark.sql("select * from growth_parameters(table(t_wells) partition by pmod(hash(well), 2) order by hours)").collect()}
    assert len(got) == 5 and all(got[k] == fit for k, fit in enumerate(plates.fit_many(times, values)))
