"""Masks, grids, resampling and motion in space."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..kernels import spatial, spectral
from ..sources.shared import written
from . import aggregates, bricks, frames, joins, series


def edge_mask(grid: DataFrame) -> DataFrame:
    """Voxels of a mask (voxel_id, x, y, z) next to one outside it.

    A voxel with a coordinate of 0 is never an edge, nor does what lies past
    the far side of the box (``shape``: one beyond the greatest coordinates)
    count as outside.
    """
    top = grid.agg(*[F.max(c).alias(f"m{c}") for c in "xyz"])
    near = joins.neighbours(grid).groupBy("voxel_id").agg(F.count("*").alias("n"))
    span = lambda c: F.when(F.col(c) == F.col(f"m{c}"), 2).otherwise(3)
    full = span("x") * span("y") * span("z") - 1
    both = grid.join(F.broadcast(top)).join(near, "voxel_id", "left")  # top is one row
    inner = (F.col("x") > 0) & (F.col("y") > 0) & (F.col("z") > 0)
    return both.where(inner & (F.coalesce("n", F.lit(0)) < full)).select("voxel_id")


def eroded(grid: DataFrame) -> DataFrame:
    """Voxels all of whose 26 neighbours are in the mask."""
    return joins.neighbours(grid).groupBy("voxel_id").agg(F.count("*").alias("n")).where("n = 26").select("voxel_id")


def tissue_masks(atlas: DataFrame, mapping: DataFrame, grid: DataFrame) -> DataFrame:
    """mask_name, voxel_id: voxels of each tissue by a table label -> tissue, and the same eroded by one voxel (name_eroded).

    Erosion counts neighbours of the same tissue in one pass over all tissues.
    """
    own = atlas.join(mapping, "label").select("tissue", "voxel_id").distinct().join(grid, "voxel_id")
    near = joins.neighbours(own.select("voxel_id", "x", "y", "z"))
    tissue = own.select("voxel_id", "tissue")
    inner = near.join(tissue, "voxel_id").join(tissue.select(F.col("voxel_id").alias("neighbour_id"), F.col("tissue").alias("__t")), "neighbour_id")
    inner = inner.where("tissue = __t").groupBy("tissue", "voxel_id").agg(F.count("*").alias("n")).where("n = 26")
    return tissue.select(F.col("tissue").alias("mask_name"), "voxel_id").union(inner.select(F.concat("tissue", F.lit("_eroded")), "voxel_id"))


def on_grid(grid: DataFrame, values: DataFrame) -> DataFrame:
    """A masked vector on the whole grid, 0 outside."""
    return grid.join(values.select("voxel_id", "value"), "voxel_id", "left").select("voxel_id", "x", "y", "z", F.coalesce("value", F.lit(0.0)).alias("value"))


def transform(point: tuple[Column, Column, Column], matrix: list[list[float]]) -> tuple[Column, ...]:
    return tuple(sum((F.lit(float(r[k])) * point[k] for k in range(3)), F.lit(float(r[3]))) for r in matrix[:3])


def chain(transforms: list[tuple[list[list[float]], bool]]) -> np.ndarray:
    """One matrix for a list of (matrix, inverse) applied last to first, so that a scan is interpolated once."""
    out = np.eye(4)
    for matrix, inverse in transforms:
        m = np.array(matrix, float)
        out = out @ (np.linalg.inv(m) if inverse else m)
    return out


def inverse_chain(transforms: list[tuple[list[list[float]], bool]]) -> list[tuple[list[list[float]], bool]]:
    return [(m, not inverse) for m, inverse in reversed(transforms)]


def between_spaces(to_anat: list, anat_to_template: list, template_to_common: list) -> dict[str, list]:
    """Chains from native BOLD space to the other three and back."""
    there = {"native_to_anat": to_anat, "native_to_template": anat_to_template + to_anat, "native_to_common": template_to_common + anat_to_template + to_anat}
    return there | {"_to_".join(reversed(k.split("_to_"))): inverse_chain(v) for k, v in there.items()}


def resampled(values: DataFrame, target: DataFrame, matrix: list[list[float]] | np.ndarray, clip: bool = False) -> DataFrame:
    """Linear interpolation of ``values`` (keys..., x, y, z, value) at the target grid's points, moved by the matrix into source coordinates.

    Each target point reads its eight corners by an equi-join on integer
    coordinates; corners outside count as 0.
    """
    keys = [c for c in values.columns if c not in ("x", "y", "z", "value", "voxel_id")]
    p = transform((F.col("x").cast("double"), F.col("y").cast("double"), F.col("z").cast("double")), [list(r) for r in np.array(matrix)])
    moved = target.select("voxel_id", *[c.alias(n) for c, n in zip(p, ("px", "py", "pz"))])
    corner = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("c")) for a in (0, 1) for b in (0, 1) for c in (0, 1)])).alias("k")
    base = moved.select("*", corner)
    weight = F.lit(1.0)
    for axis, part in (("px", "k.a"), ("py", "k.b"), ("pz", "k.c")):
        rest = F.col(axis) - F.floor(axis)
        weight = weight * F.when(F.col(part) == 1, rest).otherwise(1 - rest)
    at = [(F.floor(axis) + F.col(part)).cast("int").alias(n) for axis, part, n in (("px", "k.a", "x"), ("py", "k.b", "y"), ("pz", "k.c", "z"))]
    out = base.select("voxel_id", *at, weight.alias("w")).where("w > 0").join(values, ["x", "y", "z"]).groupBy(*keys, "voxel_id").agg(F.sum(F.col("w") * F.col("value")).alias("value"))
    return out.withColumn("value", F.greatest("value", F.lit(0.0))) if clip else out


def field(rows: DataFrame, spacing: tuple[float, float, float] = (1.0, 1.0, 1.0)) -> DataFrame:
    """A displacement field (x, y, z, dx, dy, dz in voxels) from a vector image read as a scan whose frames are the three components, in units of ``spacing``."""
    part = [(F.max(F.when(F.col("t") == k, F.col("value"))) / s).alias(f"d{c}") for k, (c, s) in enumerate(zip("xyz", spacing, strict=True))]
    return rows.groupBy("x", "y", "z").agg(*part)


def displaced(points: DataFrame, moves: DataFrame) -> DataFrame:
    """Points (keys..., x, y, z, px, py, pz) moved by a displacement field, interpolated linearly; outside of the field nothing moves.

    Each point meets the field at its eight corners by an equi-join.
    """
    keys = [c for c in points.columns if c not in ("px", "py", "pz")]
    corners = F.explode(F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(k, "abc")]) for k in np.ndindex(2, 2, 2)])).alias("k")
    at = [(F.floor(f"p{c}") + F.col(f"k.{a}")).cast("int").alias(f"c{c}") for c, a in zip("xyz", "abc")]
    weight = F.lit(1.0)
    for c, a in zip("xyz", "abc"):
        rest = F.col(f"p{c}") - F.floor(f"p{c}")
        weight = weight * F.when(F.col(f"k.{a}") == 1, rest).otherwise(1 - rest)
    spread = points.select("*", corners).select(*points.columns, *at, weight.alias("w"))
    known = moves.select(*[F.col(c).alias(f"c{c}") for c in "xyz"], "dx", "dy", "dz")
    met = spread.join(known, ["cx", "cy", "cz"], "left")
    shift = lambda c: F.sum(F.col("w") * F.coalesce(f"d{c}", F.lit(0.0)))
    return met.groupBy(*keys).agg(*[(F.max(f"p{c}") + shift(c)).alias(f"p{c}") for c in "xyz"])


def moved(points: DataFrame, transforms: list[tuple[list[list[float]] | np.ndarray | DataFrame, bool]]) -> DataFrame:
    """Points (keys..., x, y, z, px, py, pz) taken through a list of (matrix or displacement field, inverse), last to first.

    Neighbouring matrices become one.  A field has no inverse here: where one
    is needed it is a field of its own, as registration tools write it.
    """
    waiting: list = []

    def settle(points):
        if not waiting:
            return points
        p = transform(tuple(F.col(f"p{c}") for c in "xyz"), chain(waiting[::-1]).tolist())
        waiting.clear()
        return points.withColumns({f"p{c}": v for c, v in zip("xyz", p)})

    for step, inverse in reversed(transforms):
        if isinstance(step, DataFrame):
            if inverse:
                raise ValueError("a displacement field can't be inverted; give the inverse field")
            points = displaced(settle(points), step)
        else:
            waiting.append((step, inverse))
    return settle(points)


def resampled_volumes(values: DataFrame, source: tuple[int, int, int], target: tuple[int, int, int], transforms, kind: str = "bspline", clip: bool = False, side: int = bricks.SIDE) -> DataFrame:
    """``values`` (keys..., x, y, z, value) of a whole grid on another grid, whose indices the transforms take to those of the source.

    transforms: a matrix, or a list of (matrix or displacement field, inverse)
    applied last to first; values are interpolated once.  kind: linear, bspline
    (cubic), or the windowed sincs lanczos and cosine of three voxels' reach.
    No group is larger than a brick with its halo, or a line for splines;
    voxels without a row count as 0.  clip sets negative values to 0.
    """
    if kind not in spatial.INTERPOLATORS:
        raise ValueError(f"unknown interpolator: {kind}")
    steps = transforms if isinstance(transforms, list) and transforms and isinstance(transforms[0], tuple) else [(transforms, False)]
    return bricks.resampled(values, source, moved(bricks.grid_points(values, target), steps), kind, clip, side)


def realigned(values: DataFrame, shape: tuple[int, int, int], motion: DataFrame, kind: str = "bspline", side: int = bricks.SIDE) -> DataFrame:
    """Frames (scan_id, t, x, y, z, value) at the places to which their motion parameters take the grid's points; without t, each scan's one volume at those of every frame."""
    m = [F.col(c) for c in ("mov1", "mov2", "mov3")]
    (sa, ca), (sb, cb), (sc, cc) = ((F.sin(f"rot{k}"), F.cos(f"rot{k}")) for k in (1, 2, 3))
    x, y, z = (F.col(f"p{c}") for c in "xyz")
    u, v = cc * x - sc * y, sc * x + cc * y  # about z, then y, then x
    u, w = cb * u + sb * z, -sb * u + cb * z
    v, w = ca * v - sa * w, sa * v + ca * w
    at = F.explode(F.sequence(F.lit(0), F.lit(int(np.prod(shape)) - 1))).alias("i")
    nx, ny, nz = shape
    grid = [F.floor(F.col("i") / (ny * nz)), F.floor(F.col("i") / nz) % ny, F.col("i") % nz]
    points = motion.select("*", at).select("*", *[g.cast("int").alias(c) for g, c in zip(grid, "xyz")], *[g.cast("double").alias(f"p{c}") for g, c in zip(grid, "xyz")])
    points = points.select("scan_id", "t", "x", "y", "z", *[(p + q).alias(n) for p, q, n in zip(m, (u, v, w), ("px", "py", "pz"))])
    return bricks.resampled(values, shape, points, kind, side=side)


def respaced(shape: tuple[int, int, int], old: tuple[float, ...], new: tuple[float, ...]) -> tuple[tuple[int, ...], np.ndarray]:
    """Size of the grid at a new spacing (whole voxels only), and the matrix from its indices to the old ones."""
    return tuple(int(n * o / w) for n, o, w in zip(shape, old, new)), np.diag([*(w / o for o, w in zip(old, new)), 1.0])


def nearest_labels(labels: DataFrame, target: DataFrame, matrix: list[list[float]] | np.ndarray) -> DataFrame:
    """Each target point's label at the nearest source voxel, 0 outside."""
    p = transform((F.col("x").cast("double"), F.col("y").cast("double"), F.col("z").cast("double")), [list(r) for r in np.array(matrix)])
    moved = target.select("voxel_id", *[F.floor(c + 0.5).cast("int").alias(n) for c, n in zip(p, "xyz")])
    return moved.join(labels.select("x", "y", "z", "label"), ["x", "y", "z"], "left").select("voxel_id", F.coalesce("label", F.lit(0)).alias("label"))


def framewise_displacement(motion: DataFrame, points: list[tuple[float, float, float]]) -> DataFrame:
    """Mean way of the points from each frame to the next; 0 at the last. A group is one scan's motion table."""
    p = np.array(points, float)

    def one(pdf):
        pdf = pdf.sort_values("t")
        m = pdf[["mov1", "mov2", "mov3", "rot1", "rot2", "rot3"]].to_numpy(float)
        return pdf[["scan_id", "t"]].assign(fd=spatial.displacement(p, m))

    return series.per_scan(motion, one, "scan_id string, t int, fd double")


def reference_volume(bold: DataFrame, frames_total: int, realign: Callable[[DataFrame, DataFrame], DataFrame], rounds: int = 2, most: int = 50) -> DataFrame:
    """scan_id, voxel_id, reference: the trimean over frames, after ``rounds`` rounds of realignment to the reference so far.

    ``realign`` takes at most ``most`` frames, evenly spread, and a reference,
    and gives the frames moved towards it; estimating the motion is up to it.
    """
    some = frames.uniform_subset(bold, frames_total, most)
    reference = aggregates.reference_map(some)
    for _ in range(rounds):
        reference = written(aggregates.reference_map(realign(some, reference)), "reference")
    return reference


def acquisition(slices: int, pattern: str) -> list[float]:
    """When each slice is taken, in frames from the frame's start.

    Patterns: seq+z and seq-z go up and down; alt+z takes every second slice
    upwards from the first and then those between, alt+z2 from the second;
    alt-z and alt-z2 the same downwards from the last.
    """
    starts = {"seq+z": None, "seq-z": None, "alt+z": 0, "alt-z": 0, "alt+z2": 1, "alt-z2": 1}
    if pattern not in starts:
        raise ValueError(f"unknown slice pattern: {pattern}")
    first = starts[pattern]
    order = list(range(slices)) if first is None else [*range(first, slices, 2), *range(1 - first, slices, 2)]
    times = [0.0] * slices
    for place, k in enumerate(order):
        times[slices - 1 - k if "-" in pattern else k] = place / slices
    return times


def slice_timed(bold: DataFrame, grid: DataFrame, slices: int, axis: str = "z", pattern: str = "alt-z", method: str = "Fourier", at: float | None = None) -> DataFrame:
    """Values as if all slices along ``axis`` were taken at ``at`` (in frames; by default the mean of their times).

    Fourier turns the phases of each voxel's series, besides its straight
    line; linear interpolates between frames.  A group is one voxel's frames.
    """
    times = acquisition(slices, pattern)
    at = sum(times) / slices if at is None else at
    late = F.element_at(F.array(*[F.lit(at - t) for t in times]), F.col(axis) + 1).alias("late")  # how far the wanted time lies after the slice's own
    own = bold.join(grid.select("voxel_id", late), "voxel_id")
    if method == "linear":
        from .frames import by_time

        w = by_time("scan_id", "voxel_id")
        before, after = F.lag("value").over(w), F.lead("value").over(w)
        forward = F.col("value") + F.col("late") * (F.coalesce(after, F.col("value")) - F.col("value"))
        back = F.col("value") + F.col("late") * (F.col("value") - F.coalesce(before, F.col("value")))
        return own.withColumn("new", F.when(F.col("late") >= 0, forward).otherwise(back)).select("scan_id", "t", "voxel_id", F.col("new").alias("value"))
    if method != "Fourier":
        raise ValueError(f"unknown interpolation in time: {method}")
    rows = series.to_series(own.select("scan_id", "t", "voxel_id", "value")).join(grid.select("voxel_id", late), "voxel_id")
    return series.to_bold(series.by_rows(rows.select("scan_id", "voxel_id", "t", "v", "late"), lambda v, late: spectral.phase_shifted(v, late), "late"))


def despiked(data: DataFrame, waves: int | None = None) -> DataFrame:
    """Series (scan_id, voxel_id, t, v) without spikes; waves: turns of the slow curve, a thirtieth of the frames by default."""
    return series.by_rows(data.select("scan_id", "voxel_id", "t", "v"), lambda v: spectral.despiked(v.T, waves).T)


def autobox(values: DataFrame, pad: int = 1, least: float = 0.0) -> DataFrame:
    """Each scan (scan_id, x, y, z, value and more columns) cut to the box of its voxels over ``least``, ``pad`` voxels wider; coordinates count from the box's corner."""
    ends = values.where(F.col("value") > least).groupBy("scan_id").agg(*[f(c).alias(f"{n}{c}") for c in "xyz" for n, f in (("low", F.min), ("high", F.max))])
    inside = values.join(ends, "scan_id").where(" AND ".join(f"{c} BETWEEN low{c} - {pad} AND high{c} + {pad}" for c in "xyz"))
    return inside.withColumns({c: (F.col(c) - F.greatest(F.col(f"low{c}") - pad, F.lit(0))).cast("int") for c in "xyz"}).drop(*[f"{n}{c}" for c in "xyz" for n in ("low", "high")])


def reoriented(grid: DataFrame, direction: list[list[float]], shape: tuple[int, int, int]) -> DataFrame:
    """Voxel coordinates in right-anterior-superior order: axes by the greatest cosine, backward axes flipped."""
    axes, signs = spatial.reorder(np.array(direction))
    new = []
    for a, s in zip(axes, signs):
        c = F.col("xyz"[a])
        new.append(c if s > 0 else F.lit(shape[a] - 1) - c)
    return grid.select("voxel_id", *[c.cast("int").alias(n) for c, n in zip(new, "xyz")])


def overlapping(origin_a, origin_b, direction_a, direction_b) -> None:
    """Raises if the origins differ while the directions agree.

    Only that combination raises: the rule as it stands elsewhere reads "not
    (same origin) and same direction".
    """
    if not tuple(origin_a) == tuple(origin_b) and tuple(direction_a) == tuple(direction_b):
        raise ValueError("images do not overlap: their origins differ")


def motion_r2(data: DataFrame, motion_design: DataFrame) -> DataFrame:
    """Per voxel, the share of variance that centred motion parameters explain."""
    from ..kernels import linear

    def fit(y, x):
        x = np.array(x, float).T
        x, y = x - x.mean(axis=0), y - y.mean(axis=0)
        rest = y - x @ linear.solve(x, y)
        with np.errstate(invalid="ignore", divide="ignore"):
            return np.nan_to_num(1 - rest.var(axis=0) / y.var(axis=0), nan=0.0, neginf=0.0, posinf=0.0)

    return series.per_voxel(data.join(motion_design.select("scan_id", "x"), "scan_id"), fit, "r2 double", "x").select("scan_id", "voxel_id", "r2")
