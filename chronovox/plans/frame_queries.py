"""Sources, sinks, filters, joins, windows, limits and set operations."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import options
from ..operators import aggregates, connect, frames, joins
from ..sources import images, manifest, synthetic, tables
from . import views
from .registry import corr, query
from .views import atlas, bold, cubes, emb, grid, label_mask, line, motion, table, tissues, traces, work_dir

# sources and sinks


CUBE = (5, 5, 5)


def cube_images(spark, d):
    """Writes the cubes of vectors as images and gives their folder."""
    folder = work_dir(spark, "images")
    images.write(cubes(spark, d), folder, (1.0, 1.0, 1.0, 0.5), CUBE)
    return folder


FULL = ("whole", "SELECT * FROM (SELECT DISTINCT scan_id FROM cubes), (SELECT unnest(range(5))::INT AS x), (SELECT unnest(range(5))::INT AS y), (SELECT unnest(range(5))::INT AS z)")


@query("S1_image_scan", "scan_id t x y z", "value", """
    SELECT scan_id, t, x, y, z, coalesce(value, 0.0)::FLOAT::DOUBLE AS value FROM whole CROSS JOIN (SELECT DISTINCT t FROM cubes) LEFT JOIN cubes USING (scan_id, t, x, y, z)""", (FULL,))
def s1(spark, d):
    return images.read(spark, cube_images(spark, d))


@query("S2_header_scan", "scan_id nx ny nz frames kind", "tr", "SELECT scan_id, 5 AS nx, 5 AS ny, 5 AS nz, (max(t) + 1)::INT AS frames, 'f4' AS kind, 0.5::DOUBLE AS tr FROM cubes GROUP BY scan_id")
def s2(spark, d):
    h = images.headers(spark, cube_images(spark, d))
    return h.select(images.scan_of("path").alias("scan_id"), *[F.col("shape")[i].alias(n) for i, n in enumerate(("nx", "ny", "nz", "frames"))], "kind", "tr")


@query("S3_csv_scan", "scan_id t", "mov1 rot3", "SELECT scan_id, t, mov1, rot3 FROM motion")
def s3(spark, d):
    folder = work_dir(spark, "motion-csv")
    tables.write_csv(motion(spark, d), folder)
    return tables.read_csv(spark, folder, "scan_id string, t int, mov1 double, mov2 double, mov3 double, rot1 double, rot2 double, rot3 double")


@query("S4_name_list", "name", "", "SELECT DISTINCT p_brand AS name FROM part")
def s4(spark, d):
    folder = work_dir(spark, "names")
    table(spark, d, "part").select("p_brand").distinct().write.text(folder)
    return tables.read_names(spark, folder)


@query("S5_filter_config", "scan_id", "", "SELECT scan_id FROM manifest WHERE session IN ('1', '2')")
def s5(spark, d):
    folder = work_dir(spark, "options")
    tables.write_options(spark, {"func": {"session": ["1", "2"]}}, folder)
    return manifest.filtered(views.manifest(spark, d), tables.read_options(spark, folder)["func"])


@query("S6_discovery", "scan_id subject session run suffix", "", "SELECT scan_id, subject, session, run, 'bold' AS suffix FROM manifest")
def s6(spark, d):
    return manifest.from_paths(views.manifest(spark, d).select("path"))


@query("S7_point_lookup", "path", "", "SELECT concat('data/sub-', subject, '/func/', scan_id, '.nii.gz') AS path FROM manifest WHERE run = '0'")
def s7(spark, d):
    return spark.createDataFrame([(manifest.lookup(views.manifest(spark, d), {"run": "0"}),)], "path string")


@query("S8_tree_scan", "scan_id files", "", "SELECT scan_id, 1::BIGINT AS files FROM cubes GROUP BY scan_id")
def s8(spark, d):
    found = images.find(spark, cube_images(spark, d)).where(F.col("path").contains("part-"))
    return found.groupBy(images.scan_of("path").alias("scan_id")).agg(F.count("*").alias("files"))


@query("S9_stage_reload", "scan_id t voxel_id", "value", "SELECT scan_id, t, voxel_id, value FROM line")
def s9(spark, d):
    folder = work_dir(spark, "stage")
    tables.write_stage(line(spark, d), folder)
    return tables.read_stage(spark, folder, line(spark, d).schema)


@query("S10_stage_by_target", "target n", "", "SELECT 'mask' AS target, count(*) AS n FROM tissues UNION ALL SELECT 'atlas', count(*) FROM atlas")
def s10(spark, d):
    folder = work_dir(spark, "targets")
    both = tissues(spark, d).select(F.lit("mask").alias("target"), "voxel_id").union(atlas(spark, d).select(F.lit("atlas"), "voxel_id"))
    tables.write_stage(both, folder, "target")
    return tables.read_stage(spark, folder, "voxel_id long, target string").groupBy("target").agg(F.count("*").alias("n"))


@query("S11_one_output", "scan_id label t", "value", "SELECT 'emb' AS scan_id, label, t, avg(value) AS value FROM emb GROUP BY ALL")
def s11(spark, d):
    """Of a stage's outputs, one target is read; the others' folders are not."""
    folder = work_dir(spark, "stage-targets")
    rows = lambda df, target: df.select(F.lit(target).alias("target"), "scan_id", "label", "t", "value")
    both = rows(aggregates.roi_traces(bold(spark, d), atlas(spark, d)), "traces").union(rows(motion(spark, d).select("scan_id", F.lit(0).alias("label"), "t", F.col("mov1").alias("value")), "motion"))
    tables.write_stage(both, folder, "target")
    return tables.read_stage(spark, folder, "scan_id string, label int, t int, value double, target string").where("target = 'traces'")


@query("S12_matrix_text", "row col", "value", "SELECT (dense_rank() OVER (ORDER BY label) - 1)::INT AS row, t AS col, avg(value) AS value FROM emb GROUP BY label, t")
def s12(spark, d):
    folder = work_dir(spark, "matrix")
    m = emb(spark, d).groupBy("label", "t").agg(F.avg("value").alias("v"))
    rows = m.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("t", "v"))).alias("r")).orderBy("label").coalesce(1)
    rows.select(F.concat_ws("  ", F.transform("r.v", lambda x: x.cast("string")))).write.text(folder)
    return tables.read_matrix(spark, folder)


@query("S13_synthetic_scans", "scan_id t voxel_id", "value")
def s13(spark, d):
    return synthetic.scans(spark, 3)


#: Where K1 puts its image: spacing, origin and direction (second axis first and backward).
PLACED = (2.0, 3.0, 4.0, 1.0), (-5.0, 7.5, 11.0), ((0, -1, 0), (1, 0, 0), (0, 0, 1))


@query("K1_recover_grid", "scan_id x y z", "value sx sy sz ox oy oz d01 d10", """
    SELECT scan_id, x, y, z, coalesce(value, 0.0)::FLOAT::DOUBLE AS value, 2::DOUBLE AS sx, 3::DOUBLE AS sy, 4::DOUBLE AS sz, -5::DOUBLE AS ox, 7.5::DOUBLE AS oy, 11::DOUBLE AS oz, -1::DOUBLE AS d01, 1::DOUBLE AS d10
    FROM whole LEFT JOIN (SELECT scan_id, x, y, z, avg(value) AS value FROM cubes WHERE label = 1 GROUP BY ALL) USING (scan_id, x, y, z) WHERE scan_id IN (SELECT scan_id FROM cubes WHERE label = 1)""", (FULL,))
def k1(spark, d):
    """Each scan's masked map on its whole grid, written with its place in space, and read back."""
    folder = work_dir(spark, "maps")
    own = cubes(spark, d).where("label = 1").groupBy("scan_id", "x", "y", "z").agg(F.avg("value").alias("value"))
    images.write(own.withColumn("t", F.lit(0)), folder, PLACED[0], CUBE, images.affine_of(*PLACED))
    at = images.headers(spark, folder).select(images.scan_of("path").alias("scan_id"), "spacing", "origin", "direction")
    parts = {**{f"s{c}": F.col("spacing")[i] for i, c in enumerate("xyz")}, **{f"o{c}": F.col("origin")[i] for i, c in enumerate("xyz")}, "d01": F.col("direction")[0][1], "d10": F.col("direction")[1][0]}
    return images.read(spark, folder).join(at, "scan_id").withColumns(parts)


@query("K2_csv_sink", "scan_id t", "value", "SELECT scan_id, t, avg(value) AS value FROM line GROUP BY ALL", digits=4)
def k2(spark, d):
    folder = work_dir(spark, "traces-csv")
    tables.write_csv(aggregates.global_signal(line(spark, d)), folder)
    return tables.read_csv(spark, folder, "scan_id string, t int, value double")


@query("K3_frame_mask_csv", "scan_id kept", "", """
    SELECT scan_id, count(*) FILTER (WHERE keep) AS kept FROM (SELECT scan_id, NOT bool_or(fd >= 52) OVER (PARTITION BY scan_id ORDER BY t ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS keep FROM traces) GROUP BY ALL""")
def k3(spark, d):
    folder = work_dir(spark, "frame-masks")
    tables.write_frame_mask(frames.censor_fd(traces(spark, d), 52.0), folder)
    back = spark.read.schema("`False = Masked Frames` boolean, scan_id string").csv(folder, header=True)
    return back.groupBy("scan_id").agg(F.count_if("False = Masked Frames").alias("kept"))


@query("K4_named_outputs", "output rows", "", "SELECT 'atlas' AS output, count(*) AS rows FROM atlas UNION ALL SELECT 'masks', count(*) FROM tissues UNION ALL SELECT 'traces', count(*) FROM traces")
def k4(spark, d):
    folder, outputs = work_dir(spark, "outputs"), {"masks": tissues(spark, d), "atlas": atlas(spark, d), "traces": traces(spark, d)}
    tables.write_outputs(outputs, folder)
    counts = [tables.read_stage(spark, f"{folder}/{name}", df.schema).agg(F.lit(name).alias("output"), F.count("*").alias("rows")) for name, df in outputs.items()]
    return functools.reduce(DataFrame.union, counts)


@query("K5_options", "value", "", """SELECT '{"fd_threshold": 0.05, "order": 1}' AS value""")
def k5(spark, d):
    folder = work_dir(spark, "options")
    tables.write_options(spark, {"order": 1, "fd_threshold": 0.05}, folder)
    return spark.read.text(folder)


def by_part(spark, d, schema: str, row) -> DataFrame:
    """A row of small helpers' results for each part: row(key, size) gives the columns after the key."""

    def run(batches):
        import pandas as pd

        for batch in batches:
            yield pd.DataFrame([(k, *row(k, n)) for k, n in zip(batch["p_partkey"], batch["p_size"], strict=True)], columns=[c.split()[0] for c in ("p_partkey long, " + schema).split(", ")])

    return table(spark, d, "part").select("p_partkey", "p_size").mapInPandas(run, "p_partkey long, " + schema)


@query("K6_boilerplate", "p_partkey text", "", """
    SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'Means were removed.' WHEN 1 THEN 'Linear trends were removed.' ELSE 'Polynomial trends of order 2 were removed.' END
        || CASE WHEN p_size % 2 = 0 THEN ' Values were scaled (global_variance).' ELSE '' END || CASE WHEN p_size > 25 THEN ' Images were smoothed with a Gaussian of ' || p_size || ' mm full width at half maximum.' ELSE '' END AS text FROM part""")
def k6(spark, d):
    """Options that follow a part's size."""
    chosen = lambda n: {"order": n % 3, "scaling": None if n % 2 else "global_variance", "fwhm": int(n) if n > 25 else None}
    return by_part(spark, d, "text string", lambda k, n: (tables.boilerplate(chosen(n)),))


# projections and filters


@query("P1_voxel_mask", "voxel_id t", "value", "SELECT voxel_id, t, value FROM emb WHERE voxel_id IN (SELECT voxel_id FROM tissues)")
def p1(spark, d):
    return frames.in_mask(bold(spark, d), tissues(spark, d))


@query("P2_interval", "voxel_id t", "value", "SELECT voxel_id, t, value FROM emb WHERE t >= 10 AND t < 64")
def p2(spark, d):
    return frames.in_interval(bold(spark, d), "10-end", 64)


@query("P3_censored_interval", "scan_id t", "fd", """
    SELECT scan_id, t, fd FROM (SELECT *, NOT bool_or(fd >= 52) OVER (PARTITION BY scan_id ORDER BY t ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS keep FROM traces) WHERE keep AND t >= 20 AND t < 100""")
def p3(spark, d):
    return frames.in_interval(frames.censor_fd(traces(spark, d), 52.0).where("keep"), "20-100", 120)


@query("P4_frame_mask", "scan_id t voxel_id", "value", "SELECT scan_id, t, voxel_id, value FROM line JOIN motion USING (scan_id, t) WHERE mov1 < 25.5")
def p4(spark, d):
    return frames.kept_frames(line(spark, d), motion(spark, d).select("scan_id", "t", (F.col("mov1") < 25.5).alias("keep")))


NAMES = ["sub-1_", "sub-12_", "sub-1_", "nothing"]


def named(spark, names=NAMES):
    return spark.createDataFrame(list(enumerate(names)), "ord int, name string")


NAME_SQL = ("names", "SELECT unnest([0, 1, 2, 3]) AS ord, unnest(['sub-1_', 'sub-12_', 'sub-1_', 'nothing']) AS name")


@query("P5_inclusion", "ord name scan_id matched", "", """
    SELECT ord::INT AS ord, name, min(scan_id) AS scan_id, count(scan_id) > 0 AS matched FROM names LEFT JOIN manifest ON contains(scan_id, name) GROUP BY ord, name""", (NAME_SQL,))
def p5(spark, d):
    return joins.include(views.manifest(spark, d), named(spark))


@query("P6_exclusion", "scan_id", "", "SELECT scan_id FROM manifest WHERE NOT EXISTS (SELECT 1 FROM names WHERE contains(scan_id, name))", (NAME_SQL,))
def p6(spark, d):
    return joins.exclude(views.manifest(spark, d), named(spark))


@query("P7_status_filter", "scan_id", "", "SELECT concat('order-', o_orderkey) AS scan_id FROM orders WHERE o_orderstatus <> 'F'")
def p7(spark, d):
    return table(spark, d, "orders").select(F.concat(F.lit("order-"), "o_orderkey").alias("scan_id"), F.when(F.col("o_orderstatus") == "F", "failed").otherwise("ok").alias("status")).where("status = 'ok'")


@query("P8_registered_scans", "scan_id", "", "SELECT scan_id FROM (SELECT scan_id, median(CASE WHEN scan_id = 'AF' THEN 0.0 ELSE value END) AS m FROM line GROUP BY ALL) WHERE m <> 0")
def p8(spark, d):
    return frames.registered_scans(line(spark, d).withColumn("value", F.when(F.col("scan_id") == "AF", 0.0).otherwise(F.col("value"))))


@query("P9_nonzero_voxels", "voxel_id", "", "SELECT voxel_id FROM (SELECT scan_id, voxel_id, stddev_pop(CASE WHEN voxel_id % 7 = 0 AND scan_id = 'NF' THEN 5 ELSE value END) AS s FROM line GROUP BY ALL) GROUP BY voxel_id HAVING bool_and(s <> 0)")
def p9(spark, d):
    return frames.nonzero_voxels(line(spark, d).withColumn("value", F.when((F.col("voxel_id") % 7 == 0) & (F.col("scan_id") == "NF"), 5.0).otherwise(F.col("value"))))


@query("P10_clip", "voxel_id t", "value", "SELECT voxel_id, t, greatest(value, 0) AS value FROM emb")
def p10(spark, d):
    return bold(spark, d).withColumn("value", frames.clip_negatives(F.col("value")))


@query("P11_log_scale", "voxel_id t", "value", "SELECT voxel_id, t, CASE WHEN value * 8 > -1 THEN greatest(log10(value * 8 + 1), 0) ELSE 0 END AS value FROM emb")
def p11(spark, d):
    return bold(spark, d).withColumn("value", frames.log_scaled(F.col("value") * 8))


@query("P12_uniform_frames", "voxel_id t", "value", "SELECT voxel_id, t, value FROM emb WHERE t IN (SELECT floor(i * 63 / 49.0)::INT FROM range(50) x(i))")
def p12(spark, d):
    return frames.uniform_subset(bold(spark, d), 64)


@query("P13_dummies", "scan_id n", "", """
    SELECT scan_id, coalesce(min(t) FILTER (WHERE NOT coalesce(abs(0.6745 * (fd - m) / nullif(mad, 0)) > 3.5, false)), count(*))::INT AS n
    FROM early JOIN (SELECT scan_id, m, median(abs(fd - m)) AS mad FROM early JOIN (SELECT scan_id, median(fd) AS m FROM early GROUP BY ALL) USING (scan_id) GROUP BY ALL) USING (scan_id) GROUP BY scan_id""",
    (("early", "SELECT scan_id, t, CASE WHEN t < 3 THEN fd + 1000 ELSE fd END AS fd FROM traces WHERE t < 50"),))
def p13(spark, d):
    return frames.count_dummies(traces(spark, d).select("scan_id", "t", F.when(F.col("t") < 3, F.col("fd") + 1000).otherwise(F.col("fd")).alias("value")))


@query("P14_binary_mask", "voxel_id", "value", "SELECT voxel_id, label::DOUBLE AS value FROM atlas WHERE label NOT IN (0, 1)")
def p14(spark, d):
    return frames.non_binary(atlas(spark, d).select("voxel_id", F.col("label").cast("double").alias("value")))


@query("P15_P16_P17_option_checks", "p_partkey overlap spacing interval", "", """
    SELECT p_partkey, NOT (p_size % 2 = 1 AND p_size % 3 = 0) AS overlap, p_size % 3 <> 0 AS spacing, p_size % 5 <> 0 AS interval FROM part""")
def p15(spark, d):
    """Which checks pass for origins, directions, a spacing and an interval that follow a part's size."""
    from ..operators import volumes

    def passes(check, *given):
        try:
            check(*given)
            return True
        except ValueError:
            return False

    def row(k, n):
        n = int(n)
        yield passes(volumes.overlapping, (n % 2, 0, 0), (0, 0, 0), (1, 0), (1, 0) if n % 3 == 0 else (0, 1))
        yield passes(options.parse_spacing, f"{n}x0.2" + "x0.3" * (n % 3 > 0))
        yield passes(options.parse_interval, "all" if n % 5 == 0 else f"{n % 4}-end", 10)

    return by_part(spark, d, "overlap boolean, spacing boolean, interval boolean", row)


@query("P18_least_frames", "scan_id", "", """
    SELECT scan_id FROM (SELECT scan_id, NOT bool_or(fd >= 50.5) OVER (PARTITION BY scan_id ORDER BY t ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS keep FROM traces) GROUP BY scan_id HAVING count(*) FILTER (WHERE keep) >= 12""")
def p18(spark, d):
    return frames.scans_with_enough_frames(frames.censor_fd(traces(spark, d), 50.5), 12)


@query("P19_edge_trim", "scan_id t keep", "", "SELECT scan_id, t, t BETWEEN 8 AND 111 AS keep FROM traces")
def p19(spark, d):
    return frames.trim_edges(traces(spark, d).withColumn("keep", F.lit(True)), 120, 12.0, 1.5)


@query("P20_top_percent", "scan_id voxel_id top", "", """
    SELECT scan_id, voxel_id, abs(value) >= bound AS top FROM maps JOIN (
        SELECT scan_id, abs(value) AS bound FROM (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY abs(value)) AS r, count(*) OVER (PARTITION BY scan_id) AS n FROM maps) WHERE r = floor(0.9 * n) + 1) USING (scan_id)""",
    (("maps", "SELECT scan_id, voxel_id, avg(value) AS value FROM line GROUP BY ALL"),))
def p20(spark, d):
    return frames.top_percent(line(spark, d).groupBy("scan_id", "voxel_id").agg(F.avg("value").alias("value")), 10, "scan_id")


@query("P21_reorient", "voxel_id x y z", "", "SELECT voxel_id, 9 - y AS x, x AS y, z AS z FROM grid")
def p21(spark, d):
    from ..operators import volumes

    return volumes.reoriented(grid(spark, d), [[0.1, -0.99, 0], [0.99, 0.1, 0], [0, 0, 1]], (10, 10, 20))


# joins


@query("J1_masked_matrix", "scan_id t voxel_id", "value", "SELECT scan_id, t, voxel_id, value FROM line WHERE voxel_id IN (SELECT voxel_id FROM tissues)")
def j1(spark, d):
    return frames.in_mask(line(spark, d), tissues(spark, d))


HALVES = ("halves", "SELECT 'emb' || voxel_id % 2 AS scan_id, t, voxel_id, label, value FROM emb")


def halves(spark, d):
    """Two scans of every other voxel."""
    return bold(spark, d).withColumn("scan_id", F.concat(F.lit("emb"), (F.col("voxel_id") % 2).cast("string")))


@query("J2_matrix_by_label", "scan_id label t", "value", "SELECT scan_id, label, t, avg(value) AS value FROM halves GROUP BY ALL", (HALVES,))
def j2(spark, d):
    return aggregates.roi_traces(halves(spark, d), atlas(spark, d))


@query("J3_matrix_by_priors", "scan_id comp t", "value", "SELECT scan_id, label AS comp, t, sum(value * (1 + voxel_id % 7)) AS value FROM halves GROUP BY ALL", (HALVES,))
def j3(spark, d):
    weights = atlas(spark, d).select(F.col("label").alias("comp"), "voxel_id", (1 + F.col("voxel_id") % 7).cast("double").alias("weight"))
    return aggregates.weighted_sums(halves(spark, d), weights)


@query("J4_label_pairs", "scan_id roi_i roi_j", "r", f"""
    WITH roi AS (SELECT scan_id, label, t, avg(value) AS value FROM line JOIN atlas USING (voxel_id) GROUP BY ALL)
    SELECT scan_id, a.label::VARCHAR AS roi_i, b.label::VARCHAR AS roi_j, {corr('a.value', 'b.value')} AS r FROM roi a JOIN roi b USING (scan_id, t) GROUP BY ALL""", digits=5)
def j4(spark, d):
    return connect.roi_matrix(line(spark, d), atlas(spark, d))


@query("J5_seed_voxels", "scan_id seed_name voxel_id", "r", f"""
    SELECT scan_id, seed_name, voxel_id, coalesce({corr('value', 's')}, 0) AS r FROM line JOIN (SELECT scan_id, 'seed' || label AS seed_name, t, avg(value) AS s FROM line JOIN atlas USING (voxel_id) WHERE label < 3 GROUP BY ALL) USING (scan_id, t) GROUP BY ALL""", digits=5)
def j5(spark, d):
    seeds = atlas(spark, d).where("label < 3").select(F.concat(F.lit("seed"), "label").alias("seed_name"), "voxel_id")
    return connect.seed_maps(line(spark, d), seeds)


@query("J6_outputs_of_scans", "scan_id n_customer", "", "SELECT scan_id, o_custkey AS n_customer FROM manifest JOIN orders ON run = o_orderkey::VARCHAR")
def j6(spark, d):
    o = table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("run"), F.col("o_custkey").alias("n_customer"))
    return views.manifest(spark, d).join(o, "run")


@query("J7_exactly_one", "scan_id matches", "", "SELECT scan_id, 1::BIGINT AS matches FROM manifest")
def j7(spark, d):
    m = views.manifest(spark, d)
    left = m.select("scan_id", "subject", F.when(F.col("session") != "3", F.col("run")).alias("run"), F.col("run").alias("key"))
    right = left.select("subject", "run", "key", F.col("scan_id").alias("found"))
    return joins.check_one(joins.exactly_one(left, right, ["subject", "run", "key"], "scan_id"), "scan_id")


@query("J8_transform_of_scan", "scan_id path", "", """
    SELECT m.scan_id, min(f.path) AS path FROM (SELECT scan_id, subject, nullif(session, '2') AS session FROM manifest) m
    LEFT JOIN files f ON m.subject = f.subject AND (m.session IS NULL OR m.session = f.session) GROUP BY ALL""",
    (("files", "SELECT DISTINCT subject, session, concat('xfm/sub-', subject, '_ses-', session, '.mat') AS path FROM manifest WHERE session <> '5'"),))
def j8(spark, d):
    m = views.manifest(spark, d)
    files = m.where("session <> '5'").select("subject", "session", F.concat(F.lit("xfm/sub-"), "subject", F.lit("_ses-"), "session", F.lit(".mat")).alias("path")).distinct()
    return joins.first_by_entities(m.select("scan_id", "subject", F.nullif("session", F.lit("2")).alias("session")), files)


@query("J9_name_containment", "scan_id name", "", "SELECT scan_id, arg_min(name, ord) AS name FROM manifest JOIN names ON contains(scan_id, name) GROUP BY scan_id", (NAME_SQL,))
def j9(spark, d):
    return joins.name_contains(views.manifest(spark, d).select("scan_id"), named(spark))


@query("J10_unique_containment", "scan_id name", "", "SELECT scan_id, concat('run-', run, '_') AS name FROM manifest WHERE run IN ('1', '2')")
def j10(spark, d):
    return joins.name_contains(views.manifest(spark, d).select("scan_id"), named(spark, ["run-1_", "run-2_"]), unique=True)


@query("J11_scan_seed", "scan_id seed_name", "", "SELECT scan_id, unnest(['left', 'right']) AS seed_name FROM manifest")
def j11(spark, d):
    return joins.for_each_seed(views.manifest(spark, d), ["left", "right"])


@query("J12_session_runs", "subject session n_runs", "", "SELECT subject, session, count(*) AS n_runs FROM manifest GROUP BY ALL")
def j12(spark, d):
    m = views.manifest(spark, d)
    sessions = m.select("subject", "session").distinct()
    return joins.runs_of_sessions(sessions, m.select("subject", "session", "run")).groupBy("subject", "session").agg(F.count("run").alias("n_runs"))


@query("J13_synchronized", "i c_name s_name", "", "SELECT c_custkey AS i, c_name, s_name FROM customer JOIN supplier ON c_custkey = s_suppkey")
def j13(spark, d):
    return joins.zipped(table(spark, d, "customer").select(F.col("c_custkey").alias("i"), "c_name"), table(spark, d, "supplier").select(F.col("s_suppkey").alias("i"), "s_name"), "i")


@query("J14_traces_motion", "scan_id t", "fd mov2", """
    SELECT scan_id, t, mov1 AS fd, mov2 FROM motion WHERE mov1 < 25.5""")
def j14(spark, d):
    m = motion(spark, d)
    return joins.traces_with_motion(m.select("scan_id", "t", F.col("mov1").alias("fd")), m.select("scan_id", "t", (F.col("mov1") < 25.5).alias("keep")), m.select("scan_id", "t", "mov2"))


@query("J15_neighbours", "voxel_id neighbour_id", "", "SELECT a.voxel_id, b.voxel_id AS neighbour_id FROM grid a JOIN grid b ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 AND abs(a.z - b.z) <= 1 AND a.voxel_id <> b.voxel_id")
def j15(spark, d):
    return joins.neighbours(grid(spark, d))


# windows, limits and sets


@query("W1_fd_censoring", "scan_id t keep", "", "SELECT scan_id, t, NOT bool_or(fd >= 52) OVER (PARTITION BY scan_id ORDER BY t ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS keep FROM traces")
def w1(spark, d):
    return frames.censor_fd(traces(spark, d), 52.0)


@query("W2_derivative", "scan_id t", "d", "SELECT scan_id, t, coalesce(mov1 - lag(mov1) OVER (PARTITION BY scan_id ORDER BY t), 0) AS d FROM motion")
def w2(spark, d):
    return motion(spark, d).select("scan_id", "t", frames.derivative("mov1", "scan_id").alias("d"))


@query("W3_dvars_across_gaps", "t", "dvars", "SELECT t, sqrt(avg(d * d)) AS dvars FROM (SELECT t, value - lag(value) OVER (PARTITION BY voxel_id ORDER BY t) AS d FROM emb WHERE t % 5 <> 0) GROUP BY t")
def w3(spark, d):
    return aggregates.dvars(bold(spark, d).where("t % 5 <> 0"))


@query("W4_shift", "scan_id t", "back ahead", "SELECT scan_id, t, lag(mov1, 1, 0) OVER w AS back, lead(mov1, 1, 0) OVER w AS ahead FROM motion WINDOW w AS (PARTITION BY scan_id ORDER BY t)")
def w4(spark, d):
    return motion(spark, d).select("scan_id", "t", frames.shifted("mov1", 1, "scan_id").alias("back"), frames.shifted("mov1", -1, "scan_id").alias("ahead"))


@query("W7_convergence", "key i", "", """
    SELECT scan_id AS key, min(t)::INT AS i FROM (SELECT *, count(*) OVER w AS n, max(abs(fd - 50)) OVER w AS worst FROM traces WINDOW w AS (PARTITION BY scan_id ORDER BY t ROWS BETWEEN 1 FOLLOWING AND 5 FOLLOWING))
    WHERE fd >= 49 AND n = 5 AND worst <= 9 GROUP BY scan_id""")
def w7(spark, d):
    return frames.convergence(traces(spark, d).select(F.col("scan_id").alias("key"), F.col("t").alias("i"), F.col("fd").alias("corr"), F.abs(F.col("fd") - 50).alias("diff")), 5, 49.0, 9.0)


@query("W8_ordinal_rank", "t voxel_id rank", "", "SELECT t, voxel_id, row_number() OVER (PARTITION BY t ORDER BY value, voxel_id)::INT AS rank FROM emb")
def w8(spark, d):
    from pyspark.sql import Window

    return bold(spark, d).select("t", "voxel_id", F.row_number().over(Window.partitionBy("t").orderBy("value", "voxel_id")).alias("rank"))


@query("W9_figure_pages", "page n", "", "SELECT (t // 50)::INT AS page, count(*) AS n FROM traces GROUP BY ALL")
def w9(spark, d):
    return traces(spark, d).groupBy(frames.page(F.col("t"), 50).alias("page")).agg(F.count("*").alias("n"))


@query("O1_percentile_bound", "t", "bound", "SELECT t, value AS bound FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY value) AS r, count(*) OVER (PARTITION BY t) AS n FROM emb) WHERE r = floor(n * 0.95) + 1")
def o1(spark, d):
    return frames.map_value_at(bold(spark, d), 0.95, "t")


@query("O2_strongest_voxels", "scan_id voxel_id", "value", """
    SELECT scan_id, voxel_id, value FROM (SELECT *, row_number() OVER (PARTITION BY scan_id ORDER BY abs(value)) AS r, count(*) OVER (PARTITION BY scan_id) AS n FROM (SELECT scan_id, voxel_id, avg(value) AS value FROM line GROUP BY ALL))
    QUALIFY abs(value) >= max(CASE WHEN r = floor(0.9 * n) + 1 THEN abs(value) END) OVER (PARTITION BY scan_id)""", digits=4)
def o2(spark, d):
    means = line(spark, d).groupBy("scan_id", "voxel_id").agg(F.avg("value").alias("value"))
    return frames.top_percent(means, 10, "scan_id").where("top")


@query("O4_matched_frames", "scan_id kept", "", "SELECT scan_id, least(count(*), 60) AS kept FROM traces GROUP BY scan_id")
def o4(spark, d):
    return frames.matched_frames(traces(spark, d).withColumn("keep", F.lit(True)), 60).groupBy("scan_id").agg(F.count_if("keep").alias("kept"))


@query("O5_first_match", "subject scan_id", "", "SELECT subject, min(scan_id) AS scan_id FROM manifest GROUP BY subject")
def o5(spark, d):
    return views.manifest(spark, d).groupBy("subject").agg(F.min("scan_id").alias("scan_id"))


@query("E1_mask_union", "voxel_id", "", "SELECT voxel_id FROM atlas WHERE label IN (1, 2)")
def e1(spark, d):
    return joins.mask_union(label_mask(spark, d, 1), label_mask(spark, d, 2))


@query("E2_mask_intersection", "voxel_id", "", "SELECT voxel_id FROM atlas WHERE label = 2")
def e2(spark, d):
    return joins.mask_intersection(label_mask(spark, d, 1, 2), label_mask(spark, d, 2, 3))


@query("E3_frame_mask_and", "scan_id t keep", "", "SELECT scan_id, t, mov1 < 25.6 AND mov2 < 0.0505 AS keep FROM motion")
def e3(spark, d):
    m = motion(spark, d)
    return joins.all_frame_masks(m.select("scan_id", "t", (F.col("mov1") < 25.6).alias("keep")), m.select("scan_id", "t", (F.col("mov2") < 0.0505).alias("keep")))


@query("E4_complement", "voxel_id", "", "SELECT voxel_id FROM atlas WHERE label NOT IN (1, 2)")
def e4(spark, d):
    return joins.mask_complement(grid(spark, d), label_mask(spark, d, 1, 2))


@query("E5_stacked_regressors", "scan_id name t", "value", "SELECT scan_id, 'a' AS name, t, mov1 AS value FROM motion UNION ALL SELECT scan_id, 'b', t, mov2 FROM motion")
def e5(spark, d):
    m = motion(spark, d)
    return joins.stacked(m.select("scan_id", F.lit("a").alias("name"), "t", F.col("mov1").alias("value")), m.select("scan_id", F.lit("b").alias("name"), "t", F.col("mov2").alias("value")))


@query("E6_outlier_union", "scan_id t either", "", "SELECT scan_id, t, mov1 > 26 OR mov2 > 0.051 AS either FROM motion")
def e6(spark, d):
    return motion(spark, d).select("scan_id", "t", ((F.col("mov1") > 26) | (F.col("mov2") > 0.051)).alias("either"))
