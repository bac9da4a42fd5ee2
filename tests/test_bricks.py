"""Bricks with halos against whole volumes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from chronovox.kernels import spatial
from chronovox.operators import bricks, regress, volumes
from chronovox.sources.shared import BATCH_BYTES, small_batches

RNG = np.random.default_rng(11)
SHAPE = (9, 7, 11)


def rows_of(volume, **keys):
    return [(*keys.values(), *map(int, i), float(v)) for i, v in np.ndenumerate(volume)]


def frame(spark, *volumes_):
    rows = [r for t, v in enumerate(volumes_) for r in rows_of(v, scan_id="s", t=t)]
    return spark.createDataFrame(rows, "scan_id string, t int, x int, y int, z int, value double")


def volume_of(df, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        out[r["x"], r["y"], r["z"]] = r["value"]
    return out


def whole(v, points, kind):
    if kind == "bspline":
        for axis, n in enumerate(v.shape):
            v = np.moveaxis(np.tensordot(np.linalg.inv(spatial.spline_matrix(n)), v, (1, axis)), 0, axis)
    return spatial.interpolated(v, points, kind, v.shape, np.zeros(3, int))


@pytest.mark.parametrize("kind", sorted(spatial.INTERPOLATORS))
def test_a_matrix_on_bricks_equals_the_whole_volume(spark, kind):
    v, target = RNG.normal(size=SHAPE), (8, 9, 5)
    turn = spatial.rigid(np.array([0.7, -0.4, 1.2, 0.1, -0.2, 0.3]))
    turn[:3, :3] *= 1.1
    at = (turn[:3, :3] @ np.indices(target).reshape(3, -1) + turn[:3, 3:]).T
    for side in (4, 16):
        found = volume_of(volumes.resampled_volumes(frame(spark, v), SHAPE, target, turn, kind, side=side), target)
        assert np.allclose(found.ravel(), whole(v, at, kind), atol=1e-10)


def test_a_field_that_is_a_matrix_and_one_in_a_chain(spark):
    v = RNG.normal(size=SHAPE)
    turn = spatial.rigid(np.array([0.3, 0.2, -0.4, 0.05, 0.02, -0.1]))
    grid = np.indices(SHAPE).reshape(3, -1)
    steps = (turn[:3, :3] @ grid + turn[:3, 3:] - grid).T
    moves = spark.createDataFrame([(*map(int, g), *map(float, s)) for g, s in zip(grid.T, steps)], "x int, y int, z int, dx double, dy double, dz double")
    by_field = volume_of(volumes.resampled_volumes(frame(spark, v), SHAPE, SHAPE, [(moves, False)], "bspline", side=4), SHAPE)
    by_matrix = volume_of(volumes.resampled_volumes(frame(spark, v), SHAPE, SHAPE, turn, "bspline", side=4), SHAPE)
    assert np.allclose(by_field, by_matrix, atol=1e-10)
    # a field of whole steps between two matrices, one inverted
    ones = moves.select("x", "y", "z", F.lit(1.0).alias("dx"), F.lit(0.0).alias("dy"), F.lit(-1.0).alias("dz"))
    half = np.eye(4)
    half[:3, 3] = (0.5, 0, 0)
    chained = volume_of(volumes.resampled_volumes(frame(spark, v), SHAPE, SHAPE, [(half, True), (ones, False), (half, False)], "linear", side=4), SHAPE)
    want = np.zeros(SHAPE)
    want[:-1, :, 1:] = v[1:, :, :-1]  # at the far side in x, half of the field lies outside
    assert np.allclose(chained[:-1], want[:-1], atol=1e-12)
    with pytest.raises(ValueError, match="inverse"):
        volumes.moved(bricks.grid_points(frame(spark, v), SHAPE), [(moves, True)])


def test_fields_from_vector_images(spark):
    rows = [("f", t, 1, 2, 3, float(10 * t + 4)) for t in range(3)]
    got = volumes.field(spark.createDataFrame(rows, "scan_id string, t int, x int, y int, z int, value double"), (2.0, 1.0, 4.0)).collect()
    assert [tuple(r) for r in got] == [(1, 2, 3, 2.0, 14.0, 6.0)]


def test_smoothing_by_bricks(spark):
    v, fwhm, spacing = RNG.normal(size=SHAPE), 2.2, (1.0, 1.0, 2.0)
    mask = RNG.random(SHAPE) < 0.8
    rows = frame(spark, v, 2 * v).withColumn("voxel_id", (F.col("x") * 77 + F.col("y") * 11 + F.col("z")).cast("long"))
    grid = rows.where("t = 0").select("voxel_id", (F.col("x") - 3).alias("x"), "y", "z").where(F.col("voxel_id").isin(np.flatnonzero(mask.ravel()).tolist()))
    want = spatial.smooth(v, mask, fwhm, spacing)
    found = regress.smoothed(rows.select("scan_id", "t", "voxel_id", "value"), grid, fwhm, spacing).collect()
    assert len(found) == 2 * mask.sum()
    assert all(abs(r["value"] - (1 + r["t"]) * want.ravel()[r["voxel_id"]]) < 1e-10 for r in found)
    own = rows.join(grid.select("voxel_id"), "voxel_id").drop("voxel_id")
    small = bricks.smoothed(own, SHAPE, fwhm, spacing, side=3)
    assert np.allclose(np.nan_to_num(volume_of(small.where("t = 0"), SHAPE)), want, atol=1e-10)


def test_no_group_is_larger_than_a_box_and_empty_tables(spark):
    held = bricks.boxes(frame(spark, RNG.normal(size=SHAPE)), SHAPE, 2, 4)
    assert {len(r["box"]) for r in held.collect()} == {8**3} and held.count() == 3 * 2 * 3
    empty = frame(spark, np.zeros(SHAPE)).limit(0)
    assert volumes.resampled_volumes(empty, SHAPE, SHAPE, np.eye(4)).count() == 0
    assert bricks.smoothed(empty, SHAPE, 2.0, (1.0, 1.0, 1.0)).count() == 0


def test_frames_realigned_by_their_own_motion(spark):
    v = RNG.normal(size=SHAPE)
    motion = np.array([[0.4, 0.1, -0.3, 0.02, 0.05, -0.04], [0.0, 0.0, 0.0, 0.0, 0.0, 0.0]])
    moves = spark.createDataFrame([("s", t, *map(float, m)) for t, m in enumerate(motion)], "scan_id string, t int, mov1 double, mov2 double, mov3 double, rot1 double, rot2 double, rot3 double")
    found = volumes.realigned(frame(spark, v, v), SHAPE, moves, "linear", side=5)
    for t, m in enumerate(motion):
        turn = spatial.rigid(m)
        at = (turn[:3, :3] @ np.indices(SHAPE).reshape(3, -1) + turn[:3, 3:]).T
        assert np.allclose(volume_of(found.where(f"t = {t}"), SHAPE).ravel(), whole(v, at, "linear"), atol=1e-12)


def test_batches_of_long_rows_are_small(spark):
    long = spark.range(400, numPartitions=1).select("id", F.expr("transform(sequence(0, 5831), i -> named_struct('place', i, 'value', double(i)))").alias("cells"))
    seen = bricks.dense(long, 5832, "box", then=lambda rows: np.full_like(rows, len(rows))).agg(F.max(F.col("box")[0])).first()[0]
    assert seen * 5832 * 12 < 1.1 * BATCH_BYTES


def test_a_smaller_batch_that_the_session_asks_for_stays(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        for asked, kept in (("1m", "1m"), ("4096", "4096"), ("64mb", str(BATCH_BYTES)), ("67108864b", str(BATCH_BYTES))):
            spark.conf.set(key, asked)
            small_batches(spark)
            assert spark.conf.get(key) == kept
    finally:
        spark.conf.set(key, before)
