"""Beyond the broadcast threshold: with broadcasts disabled the equi-join plans
fall back to shuffled sort-merge joins (never a nested loop) and the results
stay identical to the oracle."""

import pytest

import __spark_entry__ as E
from trackscene.plans import registry
from trackscene.plans.check import compare, duck_con

from .conftest import SF_SMALL

NAMES = ["closest_fixes", "predict_positions", "open_sea", "water_area", "extract_patches", "stratified_folds"]


@pytest.fixture()
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield spark
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.mark.parametrize("name", NAMES)
def test_shuffled_plans_match_oracle(no_broadcast, name):
    spark = no_broadcast
    df = E.queries()[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
    if name in ("closest_fixes", "open_sea", "extract_patches"):
        assert "SortMergeJoin" in plan
    r = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL, duck_con(SF_SMALL))
    assert r["status"] == "ok", r


def test_salted_joins_equal_unsalted(no_broadcast):
    from trackscene.operators import match, spatial
    from trackscene.plans import fixtures as fx
    spark = no_broadcast
    a, s = fx.ais(spark, SF_SMALL), fx.scenes(spark, SF_SMALL)
    m1 = match.match_window(a, s, fx.HALF_WINDOW_MIN).select("id", "api_id", "diff_us")
    m4 = match.match_window(a, s, fx.HALF_WINDOW_MIN, salt=4).select("id", "api_id", "diff_us")
    assert m1.exceptAll(m4).count() == 0 and m4.exceptAll(m1).count() == 0
    pts = a.select("id", "lon", "lat")
    w = fx.water_polygons(spark, SF_SMALL)
    o1 = spatial.points_in_polygons(pts, w).select("id")
    o4 = spatial.points_in_polygons(pts, w, salt=4, id_col="id").select("id")
    assert o1.exceptAll(o4).count() == 0 and o4.exceptAll(o1).count() == 0 and o1.count() > 0


registry.load_all()


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_no_join_without_an_equality(spark, name):
    """No registered query plans a nested-loop or Cartesian join."""
    plan = registry.QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
