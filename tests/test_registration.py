"""Linear registration of images of two contrasts, and a template of moved copies."""

import numpy as np
import pytest

from chronovox.kernels import spatial
from chronovox.operators import bricks, registration, volumes

SHAPE = (26, 24, 22)


def image(matrix, contrast=lambda v: v):
    """A smooth image on background, moved: at ``matrix`` of a point it has what the plain one has there."""
    rng = np.random.default_rng(3)
    at, wide = rng.uniform(7, 15, (25, 3)) + [2, 1, 0], rng.uniform(2.0, 3.0, 25)
    back = np.linalg.inv(matrix)
    q = (back[:3, :3] @ np.indices(SHAPE).reshape(3, -1) + back[:3, 3:]).T
    return contrast(sum(np.sign(k - 9.5) * np.exp(-((q - a) ** 2).sum(axis=1) / (2 * w * w)) for k, (a, w) in enumerate(zip(at, wide, strict=True)))).reshape(SHAPE)


def frame(spark, **images):
    rows = [(scan, *map(int, i), float(v)) for scan, image_ in images.items() for i, v in np.ndenumerate(image_)]
    return spark.createDataFrame(rows, "scan_id string, x int, y int, z int, value double")


def planted(p):
    return registration.about_origin(registration.matrix_about_centre(np.array(p)), SHAPE)


def away(found, want):
    """Mean distance in voxels, over the inner half of the grid."""
    g = np.stack(np.meshgrid(*(np.arange(n // 4, n - n // 4) for n in SHAPE), indexing="ij")).reshape(3, -1)
    d = np.array(found).reshape(4, 4) - want
    return np.sqrt(((d[:3, :3] @ g + d[:3, 3:]) ** 2).sum(axis=0)).mean()


AFFINE = planted([1.2, -0.8, 0.5, 0.06, -0.04, 0.08, 0.06, -0.05, 0.03, 0.04, -0.03, 0.02])
RIGID = planted([-1.5, 0.7, 0.4, 0.0, 0.07, -0.05])


def test_histograms_of_bricks_add_up_to_that_of_the_volume():
    rng = np.random.default_rng(1)
    fixed, moving = rng.normal(size=SHAPE), rng.normal(size=SHAPE)
    m, ends = registration.matrix_about_centre(np.array([0.4, 0.1, -0.3, 0.02, 0, 0.01])), np.array([fixed.min(), fixed.max(), moving.min(), moving.max()])
    whole = registration.joint(moving, fixed, np.zeros(3, int), 0, SHAPE, m[None], ends)[0]
    assert whole.sum() == pytest.approx(fixed.size)
    parts = 0
    for corner in np.ndindex(2, 2, 2):
        at = np.array(corner) * 13
        box, core = np.zeros((23,) * 3), np.full((13,) * 3, np.nan)
        for i in np.ndindex(23, 23, 23):
            if all(0 <= v < n for v, n in zip(at + i - 5, SHAPE, strict=True)):
                box[i] = moving[tuple(at + i - 5)]
        own = fixed[tuple(slice(a, a + 13) for a in at)]
        core[tuple(map(slice, own.shape))] = own
        parts = parts + registration.joint(box, core, at, 5, SHAPE, m[None], ends)[0]
    assert np.allclose(parts, whole)


def test_information_of_known_tables():
    assert registration.information(np.diag([1.0, 2.0, 1.0])) == pytest.approx(2.0)
    assert registration.information(np.outer([1.0, 2.0], [3.0, 1.0, 2.0])) == pytest.approx(1.0)
    assert registration.information(np.zeros((2, 2))) == 0.0


@pytest.mark.parametrize("method", ["Rigid", "Affine"])
def test_a_planted_transform_across_two_contrasts(spark, method):
    want = RIGID if method == "Rigid" else AFFINE
    fixed, moving = image(np.eye(4)), image(want, lambda v: np.exp(-0.4 * v))
    (row,) = registration.registered(frame(spark, s=moving), frame(spark, s=fixed), SHAPE, method).collect()
    assert away(row["matrix"], want) < 0.25 < away(np.eye(4), want)
    # it goes into a chain as it is
    chain = volumes.chain([(np.array(row["matrix"]).reshape(4, 4), False)])
    back = bricks.resampled(frame(spark, s=moving), SHAPE, volumes.moved(bricks.grid_points(frame(spark, s=moving), SHAPE), [(chain, False)]), "linear")
    out = np.zeros(SHAPE)
    for r in back.collect():
        out[r["x"], r["y"], r["z"]] = r["value"]
    inner = tuple(slice(n // 4, n - n // 4) for n in SHAPE)
    same = lambda a: np.corrcoef(a[inner].ravel(), fixed[inner].ravel())[0, 1]
    assert same(out) < -0.95 and same(out) < same(moving) - 0.03


def test_methods_and_empty_tables(spark):
    one = frame(spark, s=image(np.eye(4)))
    (row,) = registration.registered(one, one, SHAPE, "no_reg").collect()
    assert row["matrix"] == np.eye(4).ravel().tolist() and row["settled"]
    with pytest.raises(ValueError, match="method"):
        registration.registered(one, one, SHAPE, "SyN")
    assert registration.registered(one.limit(0), one.limit(0), SHAPE, "Rigid", levels=(0.0,)).count() == 0


def test_a_template_of_moved_copies(spark):
    moves = [planted([a, b, 0.0, 0.0, 0.0, c]) for a, b, c in ((1.0, 0.5, 0.05), (-1.0, -0.5, -0.05))]
    images = frame(spark, **{f"s{k}": image(m) for k, m in enumerate(moves)})
    found, matrices = registration.template(images, SHAPE, "Rigid", rounds=2, levels=(2.0, 0.0))
    out = np.zeros(SHAPE)
    for r in found.collect():
        out[r["x"], r["y"], r["z"]] = r["value"]
    plain, first = image(np.eye(4)), (image(moves[0]) + image(moves[1])) / 2
    inner = tuple(slice(n // 4, n - n // 4) for n in SHAPE)
    far = lambda a: np.sqrt(((a - plain)[inner] ** 2).mean()) / plain[inner].std()
    assert far(out) < 0.05 < far(first)
    assert all(away(r["matrix"], moves[int(r["scan_id"][1])]) < 0.2 for r in matrices.collect())


def test_only_frames_asked_for_are_made(spark):
    from chronovox.plans import space_queries

    _, shown = space_queries.moved_frames(spark, "/root/testdata/sf0.001", (1,))
    assert [tuple(r) for r in shown.groupBy("scan_id", "t").count().collect()] == [("v0", 1, 32000)]


def test_joint_histograms_are_those_of_plain_interpolation():
    rng, halo, shape = np.random.default_rng(1), 2, (20, 17, 9)
    box, corner = rng.normal(size=(20, 20, 20)), np.array([0, 0, 0])
    core, m = np.full((16, 16, 16), np.nan), registration.matrix_about_centre(np.array([0.4, -0.3, 0.2, 0.02, 0.01, -0.02]))
    core[2:14, 2:14, 1:7] = 0.5
    got = registration.joint(box, core, corner, halo, shape, m[None], np.array([0.0, 1.0, -4.0, 4.0]))[0]
    centre = (np.array(shape) - 1) / 2
    q = (np.stack(np.nonzero(np.isfinite(core)), axis=1) - centre) @ m[:3, :3].T + m[:3, 3] + centre
    q = np.clip(q, 0, np.array(shape) - 1)
    v = spatial.interpolated(box, q, "linear", shape, corner - halo)
    place = np.clip((v + 4) / 8, 0, 1) * 31
    want = np.bincount(place.astype(int), 1 - place % 1, 33)[:32] + np.bincount(place.astype(int) + 1, place % 1, 33)[:32]
    assert np.allclose(got[16], want) and got.sum() == pytest.approx(len(q))


def test_a_fixed_volume_for_all_scans_is_not_repeated(spark):
    still = image(np.eye(4))
    moving = frame(spark, a=image(RIGID), b=image(np.eye(4)))
    found = [{r["scan_id"]: r["matrix"] for r in registration.registered(moving, fixed, SHAPE, "Rigid", levels=(3.0,), rounds=2).collect()} for fixed in (frame(spark, a=still, b=still), frame(spark, a=still).drop("scan_id"))]
    assert set(found[0]) == set(found[1]) == {"a", "b"} and all(np.allclose(found[0][k], found[1][k], atol=1e-6) for k in "ab")


def test_one_volume_at_the_motions_of_several_frames(spark):
    still = frame(spark, a=image(np.eye(4)))
    motions = spark.createDataFrame([("a", t, 0.3 * t, 0.0, 0.1, 0.0, 0.02 * t, 0.0) for t in range(3)], "scan_id string, t int, mov1 double, mov2 double, mov3 double, rot1 double, rot2 double, rot3 double")
    copies = still.crossJoin(spark.range(3).selectExpr("int(id) AS t"))
    one, many = ({(r["t"], r["x"], r["y"], r["z"]): r["value"] for r in volumes.realigned(v, SHAPE, motions).collect()} for v in (still, copies))
    assert len(one) == 3 * np.prod(SHAPE) and one == many
