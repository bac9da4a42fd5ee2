"""Order statistics without a sort, against sorted values; sums of variance by several keys."""

import math
import random

import pytest
from pyspark.sql import functions as F

from chronovox.operators import aggregates, frames, qc


def values_of(seed):
    rng = random.Random(seed)
    pool = [0.0, 1.0, -1.0, 1e-300, 1e300, -1e300, math.inf, -math.inf]
    return [rng.choice(pool) if rng.random() < 0.2 else rng.choice([rng.gauss(0, 1), rng.lognormvariate(0, 30), float(rng.randint(0, 3))]) for _ in range(rng.randint(1, 400))]


@pytest.mark.parametrize("share", [0.0, 0.37, 0.9, 0.999])
def test_against_sorted_values(spark, monkeypatch, share):
    monkeypatch.setattr(frames, "CELLS", 16)
    data = {k: values_of(k) for k in range(12)}
    frame = spark.createDataFrame([(k, v) for k, vs in data.items() for v in vs], "k int, value double")
    found = {r["k"]: r["bound"] for r in frames.map_value_at(frame, share, "k").collect()}
    held = lambda v: max(-1.7976931348623157e308, min(1.7976931348623157e308, v))
    assert found == {k: held(sorted(v)[int(len(v) * share)]) for k, v in data.items()}


def test_nulls_nan_and_empty_tables(spark):
    frame = spark.createDataFrame([("a", 1.0), ("a", None), ("a", float("nan")), ("b", None), ("c", 2.0)], "k string, value double")
    got = lambda share: {r["k"]: r["bound"] for r in frames.map_value_at(frame, share, "k").collect()}
    assert got(0.0) == {"a": 1.0, "b": None, "c": 2.0} and got(0.5) == {"a": None, "b": None, "c": 2.0}
    assert frames.map_value_at(frame.limit(0), 0.5, "k").count() == 0


def test_no_task_sorts_a_map(spark):
    maps = spark.range(5000).select(F.lit("m").alias("name"), F.col("id").alias("voxel_id"), F.sin(F.col("id").cast("double")).alias("value"))
    top = frames.top_percent(maps, 10, "name")
    assert "Window" not in top._jdf.queryExecution().executedPlan().toString()
    strongest = sorted((abs(math.sin(i)) for i in range(5000)))[int(0.9 * 5000)]
    assert {r["voxel_id"] for r in top.where("top").collect()} == {i for i in range(5000) if abs(math.sin(i)) >= strongest}


def test_variance_by_several_keys_reads_once(spark):
    fits = spark.createDataFrame([(v, t, float(v + t * t), float((v * t) % 3)) for v in range(4) for t in range(5)], "voxel_id long, t int, value double, residual double")
    both = aggregates.variance_explained_by(fits, [], ["voxel_id"], ["t"])
    found = {(r["voxel_id"], r["t"]): r["ve"] for r in both.collect()}
    for keys in ([], ["voxel_id"], ["t"]):
        for r in aggregates.variance_explained(fits, *keys).collect():
            assert found[r["voxel_id"] if "voxel_id" in keys else None, r["t"] if "t" in keys else None] == pytest.approx(r["ve"])
    assert both._jdf.queryExecution().executedPlan().toString().count("Scan ExistingRDD") <= 2  # of an adaptive plan, the first and the last form


def test_densities_in_blocks_are_those_of_all_rows(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(rng.gauss(0, 1), rng.gauss(0, 2)) for _ in range(300)] + [(None, 1.0)]
    frame = spark.createDataFrame(rows, "a double, b double")
    plain = [v for v, _ in rows if v is not None]
    n, mean = len(plain), sum(plain) / len(plain)
    h = math.sqrt(sum((v - mean) ** 2 for v in plain) / (n - 1)) * n ** (-1 / 5)
    monkeypatch.setattr(qc, "BLOCK", 70)
    for r in qc.density(frame, "a", 9).collect():
        assert r["density"] == pytest.approx(sum(math.exp(-0.5 * ((r["x"] - v) / h) ** 2) for v in plain) / (n * h * math.sqrt(2 * math.pi)))
    small = {(r["i"], r["j"]): r["density"] for r in qc.density_2d(frame, "a", "b", 8).collect()}
    monkeypatch.setattr(qc, "BLOCK", 100_000)
    assert {(r["i"], r["j"]): r["density"] for r in qc.density_2d(frame, "a", "b", 8).collect()} == pytest.approx(small)


def test_strongest_values_are_those_that_gave_the_bound(spark):
    """A plan that is read twice may add doubles in another order; here its values are even drawn anew."""
    drawn = F.udf(lambda i: random.random(), "double").asNondeterministic()
    maps = spark.range(2000).select(F.lit("m").alias("name"), F.col("id").alias("voxel_id"), drawn("id").alias("value"))
    found = [r for r in frames.top_percent(maps, 10, "name").collect() if r["top"]]
    assert len(found) == 200 and min(r["value"] for r in found) == found[0]["threshold"]


def test_quality_thresholds_read_line_items_once_for_maps(spark):
    from chronovox import plans

    for name in ("Q5_thresholds", "Q5_amplitude_loop"):
        plan = plans.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("lineitem.parquet") <= 1  # motion, which is another aggregate
