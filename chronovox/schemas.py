"""Table schemas. Nothing is inferred."""

BOLD = "scan_id string, t int, voxel_id long, value double"
#: The same data, one row per voxel: frames ascending.
SERIES = "scan_id string, voxel_id long, t array<int>, v array<double>"
MASK = "mask_name string, voxel_id long"
ATLAS = "voxel_id long, label int"
GRID = "voxel_id long, x int, y int, z int"
MOTION = "scan_id string, t int, mov1 double, mov2 double, mov3 double, rot1 double, rot2 double, rot3 double"
TRACES = "scan_id string, t int, fd double, dvars double, mse double"
FRAME_MASK = "scan_id string, t int, keep boolean"
PRIORS = "comp int, voxel_id long, weight double"
SEEDS = "seed_name string, voxel_id long"
MANIFEST = "scan_id string, subject string, session string, run string, suffix string, path string"
