import numpy as np

from tessella.plans import pipelines
from tessella.sources import scenes


def test_brightfield_run(spark):
    rows, polygons = [], []
    for i in (1, 2):
        image, truth = scenes.stained_scene(positive=6 * (i - 1), seed=7)
        rows.append((i, 128, 128, *(np.ascontiguousarray(image[..., c]).astype("<f4").tobytes() for c in range(3))))
        polygons += [(i, "left", "include", "custom", j, x, y) for j, (x, y) in enumerate([(1.0, 1.0), (64.5, 1.0), (64.5, 128.0), (1.0, 128.0)])]
    images = spark.createDataFrame(rows, "image_id long, h int, w int, r binary, g binary, b binary")
    manifest = spark.createDataFrame([(1, "u1", "control", 0.5), (2, "u1", "treated", None)], "image_id long, biological_unit_id string, condition string, pixel_size_um double")
    vertices = spark.createDataFrame(polygons, "image_id long, roi_id string, action string, compartment string, vertex_order int, x double, y double")
    run = pipelines.brightfield(images, manifest, vertices)
    regions = {(r.image_id, r.roi_id): r for r in run.regions.collect()}
    assert set(regions) == {(i, r) for i in (1, 2) for r in ("GLOBAL", "left")}
    n = int(scenes.stained_scene()[1].max())
    whole = regions[2, "GLOBAL"]
    assert 0 < regions[2, "left"].n_cells < whole.n_cells <= n
    assert whole.positive_cell_fraction > 0.3 and regions[1, "GLOBAL"].positive_cell_fraction < 0.1
    assert whole.tissue_positive_area_px > 5 * (regions[1, "GLOBAL"].tissue_positive_area_px + 1)
    flags = {r.image_id: r.qc_flags for r in run.quality.collect()}
    assert "MISSING_PIXEL_SIZE_CALIBRATION" in flags[2] and "MISSING" not in flags[1]


def test_exclusions_come_first_and_sizes_may_differ(spark):
    rows = []
    for i, size in ((1, 128), (2, 96)):
        image = scenes.stained_scene(positive=6, seed=7)[0][:size]
        rows.append((i, size, 128, *(np.ascontiguousarray(image[..., c]).astype("<f4").tobytes() for c in range(3))))
    images = spark.createDataFrame(rows, "image_id long, h int, w int, r binary, g binary, b binary")
    manifest = spark.createDataFrame([(1, "u1", "control", 0.5), (2, "u1", "treated", 0.5)], "image_id long, biological_unit_id string, condition string, pixel_size_um double")
    corners = [(1.0, 1.0), (65.0, 1.0), (65.0, 129.0), (1.0, 129.0)]
    polygons = [(1, "out", "exclude", "custom", j, x, min(y, 128.0)) for j, (x, y) in enumerate(corners)] + [(2, "in", "include", "custom", j, x, min(y, 96.0)) for j, (x, y) in enumerate(corners)]
    vertices = spark.createDataFrame(polygons, "image_id long, roi_id string, action string, compartment string, vertex_order int, x double, y double")
    run = pipelines.brightfield(images, manifest, vertices)
    masks = {r.image_id: np.frombuffer(r.tissue, dtype=np.uint8).reshape(r.h, r.w) for r in run.labels.collect()}
    cells = {r.image_id: np.frombuffer(r.cell, dtype="<i4").reshape(r.h, r.w) for r in run.labels.collect()}
    # columns 1 to 64 of rows 1 to 127 are out, as counted from 1
    assert not masks[1][:127, :64].any() and not cells[1][:127, :64].any() and masks[1][:, 64:].any()
    assert masks[2].shape == (96, 128) and masks[2][:, :64].any()
    assert {(r.image_id, r.roi_id) for r in run.regions.collect()} == {(1, "GLOBAL"), (2, "GLOBAL"), (2, "in")}


def test_fluorescence_run(spark):
    rows = []
    for i, (nuclear, cytoplasm) in enumerate([(0.15, 0.85), (0.85, 0.2)]):
        s = scenes.fluorescence_scene(nuclear=nuclear, cytoplasm=cytoplasm)
        rows.append((i, 256, 256, *(s[n].astype("<f4").tobytes() for n in ("nuclear", "target", "reference"))))
    planes = spark.createDataFrame(rows, "image_id long, h int, w int, nuclear binary, target binary, reference binary")
    manifest = spark.createDataFrame([(0, "u1", "control", "m"), (1, "u1", "treated", "m")], "image_id long, biological_unit_id string, condition string, marker string")
    run = pipelines.fluorescence(planes, manifest)
    units = {(r.condition, r.compartment): r for r in run.units.collect()}
    assert units["treated", "nucleus"].mean_intensity > units["control", "nucleus"].mean_intensity
    assert units["control", "cytoplasm"].mean_intensity > units["treated", "cytoplasm"].mean_intensity
    assert not {"optical_density", "h_score", "dab_od"} & set(run.compartments.columns)
    assert run.cells.count() == 50


def test_features_in_one_pass_equal_pixel_rows(spark):
    from pyspark.sql import functions as F

    from tessella.operators import measure, segment

    rows = [(f"F{i}", 128, 128, scenes.fluorescence_scene(size=128, cells=8, seed=i)["nuclear"].astype("<f4").tobytes()) for i in range(3)] + [("dark", 8, 8, np.zeros((8, 8), "<f4").tobytes())]
    planes = spark.createDataFrame(rows, "image_id string, h int, w int, nuclear binary")
    o = segment.FluorescenceOptions(min_area=30)
    labels = segment.label_pixels(segment.segment_fluorescent(planes, o)).withColumn("v", F.lit(1.0))
    want = {(r.image_id, r.nuc_label): r for r in measure.moments(labels, ["image_id"], "nuc_label", "v").collect()}
    got = {(r.image_id, r.nuc_label): r for r in segment.nucleus_features(planes, o).collect()}
    assert set(got) == set(want) and len(got) > 9
    for key, r in got.items():
        assert r.area == want[key].area and np.allclose([r.cx, r.cy, r.eccentricity], [want[key].cx, want[key].cy, want[key].eccentricity], atol=1e-6)


def test_image_without_kept_nuclei_is_no_error(spark):
    from tessella.operators import segment

    one = np.zeros((32, 32), "<f4")
    one[10:13, 10:13] = 1
    labels = segment.segment_fluorescent(spark.createDataFrame([("a", 32, 32, one.tobytes())], "image_id string, h int, w int, nuclear binary"), segment.FluorescenceOptions(min_area=500)).head()
    assert (labels.status, labels.n_cells, labels.error) == ("OK", 0, None)
