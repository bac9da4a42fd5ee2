"""Joins between scans, names, masks and neighbours, and set operations on masks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exactly_one(left: DataFrame, right: DataFrame, keys: list[str], key_id: str) -> DataFrame:
    """Join on null-safe keys; adds ``matches``, which must be 1 (see check_one)."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    on = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys]
    joined = left.join(renamed, on, "left").drop(*[f"__r_{k}" for k in keys])
    value = [c for c in right.columns if c not in keys]
    return joined.groupBy(*left.columns).agg(F.count(value[0]).alias("matches"), *[F.first(c).alias(c) for c in value])


def check_one(joined: DataFrame, name: str) -> DataFrame:
    """Raises as soon as a row without exactly one match is evaluated."""
    message = F.concat(F.lit("not exactly one match: "), F.col(name).cast("string"))
    return joined.withColumn("matches", F.when(F.col("matches") == 1, F.col("matches")).otherwise(F.raise_error(message).cast("long")))


def first_by_entities(scans: DataFrame, files: DataFrame) -> DataFrame:
    """Each scan's first file (subject, session, path) of its subject; session counts only if the scan has one."""
    f = files.select(F.col("subject").alias("__s"), F.col("session").alias("__e"), "path")
    on = (F.col("subject") == F.col("__s")) & (F.col("session").isNull() | (F.col("session") == F.col("__e")))
    first = Window.partitionBy("scan_id").orderBy(F.asc_nulls_last("path"))
    return scans.join(f, on, "left").withColumn("__i", F.row_number().over(first)).where("__i = 1").drop("__i", "__s", "__e")


#: Bytes of a list of names that are sent to every task; a longer list is joined by a sort.
SENT_NAMES = 32 << 20


def _met(scans: DataFrame, names: DataFrame) -> DataFrame:
    """``names`` beside each scan_id that holds the name, once for every place of it.

    A scan gives its parts that are as long as some name, row by row in the
    task that reads it, and they look the names up there: the short list goes
    to the scans, not their parts (some dozens a scan) to the names.
    """
    names = names.where(F.col("name").isNotNull())
    n = F.length("name")
    size = names.agg(F.array_sort(F.collect_set(n)).alias("lengths"), F.coalesce(F.sum(F.octet_length("name") + 64), F.lit(0)).alias("bytes")).first()
    lengths = F.array(*map(F.lit, size["lengths"])) if size["lengths"] else F.array().cast("array<int>")  # a handful of numbers
    cut = scans.select("scan_id", F.explode(lengths).alias("n")).where(F.length("scan_id") >= F.col("n"))
    cut = cut.select("scan_id", "n", F.explode(F.sequence(F.lit(1), F.length("scan_id") - F.col("n") + 1)).alias("i"))
    parts = cut.select("scan_id", F.substring("scan_id", F.col("i"), F.col("n")).alias("name"))
    return parts.join(names.hint("broadcast" if size["bytes"] <= SENT_NAMES else "merge"), "name")


def name_contains(scans: DataFrame, names: DataFrame, unique: bool = False) -> DataFrame:
    """Each scan's first name that it contains; unique: names in several scans raise.

    Parts of the scan's own text are joined with the names as equal strings,
    not all pairs.
    """
    place = "ord" if "ord" in names.columns else "name"
    whole = F.struct(*names.columns)
    first = _met(scans, names).groupBy("scan_id").agg(F.min_by(whole, F.struct(place, "name")).alias("own"))
    rest = [c for c in names.columns if c != "name"]
    if not unique:
        return first.select("own.name", "scan_id", *[f"own.{c}" for c in rest])
    held = first.groupBy(F.col("own.name").alias("name")).agg(F.count("*").alias("n"), F.min("scan_id").alias("scan_id"), F.min_by("own", "scan_id").alias("own"))
    message = F.concat(F.lit("several scans hold "), F.col("name"))
    return held.select(F.when(F.col("n") == 1, F.col("name")).otherwise(F.raise_error(message)).alias("name"), "scan_id", *[f"own.{c}" for c in rest])


def include(scans: DataFrame, names: DataFrame) -> DataFrame:
    """Scans named in the list, in its order, repeats kept; ``matched`` is false where a name is in no scan."""
    first = _met(scans, names.select("name").distinct()).groupBy("name").agg(F.min("scan_id").alias("scan_id"))
    return names.join(first, "name", "left").select("ord", "name", "scan_id", F.col("scan_id").isNotNull().alias("matched"))


def exclude(scans: DataFrame, names: DataFrame) -> DataFrame:
    """Scans that contain none of the names."""
    return scans.join(_met(scans, names.select("name").distinct()).select("scan_id").distinct(), "scan_id", "left_anti")


def for_each_seed(scans: DataFrame, seed_names: list[str]) -> DataFrame:
    """One row per scan and seed; seeds are an option, so a literal list."""
    return scans.withColumn("seed_name", F.explode(F.array(*map(F.lit, seed_names))))


def runs_of_sessions(sessions: DataFrame, runs: DataFrame) -> DataFrame:
    return sessions.join(runs, ["subject", "session"], "left")


def zipped(a: DataFrame, b: DataFrame, order: str) -> DataFrame:
    """Rows of two lists with the same place."""
    return a.join(b, order)


def traces_with_motion(traces: DataFrame, frame_mask: DataFrame, motion: DataFrame) -> DataFrame:
    return traces.join(frame_mask, ["scan_id", "t"]).where("keep").join(motion, ["scan_id", "t"])


def neighbours(grid: DataFrame) -> DataFrame:
    """voxel_id and neighbour_id of voxels next to each other in any direction."""
    steps = [(a, b, c) for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1) if (a, b, c) != (0, 0, 0)]
    step = F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(c).alias("c")) for a, b, c in steps])).alias("s")
    moved = grid.select("voxel_id", "x", "y", "z", step).select("voxel_id", (F.col("x") + F.col("s.a")).alias("x"), (F.col("y") + F.col("s.b")).alias("y"), (F.col("z") + F.col("s.c")).alias("z"))
    return moved.join(grid.select(F.col("voxel_id").alias("neighbour_id"), "x", "y", "z"), ["x", "y", "z"]).select("voxel_id", "neighbour_id")


def mask_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("voxel_id").union(b.select("voxel_id")).distinct()


def mask_intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("voxel_id").intersect(b.select("voxel_id"))


def mask_complement(grid: DataFrame, mask: DataFrame) -> DataFrame:
    return grid.select("voxel_id").join(mask.select("voxel_id"), "voxel_id", "left_anti")


def all_frame_masks(a: DataFrame, b: DataFrame) -> DataFrame:
    """Frames that both masks keep."""
    return a.join(b.withColumnRenamed("keep", "__keep"), ["scan_id", "t"]).select("scan_id", "t", (F.col("keep") & F.col("__keep")).alias("keep"))


def stacked(*regressors: DataFrame) -> DataFrame:
    """Regressors in long form (scan_id, name, t, value), one after another."""
    out = regressors[0]
    for more in regressors[1:]:
        out = out.unionByName(more)
    return out
