import csv
import glob
import gzip

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella import run as command
from tessella.functions import kernels
from tessella.operators import geometry, measure, quantify, run_masks
from tessella.plans import pipelines, runs
from tessella.sources import images as im, manifest as mf, scenes

HEAD = "image_id,patient_id,condition,field,source_file,pixel_size_um,marker\n"
CONFIG = "parameter,value\nnucleus_min_area_px,20\nnucleus_blur_sigma_px,1.5\ncell_expansion_radius_px,6\nborder_margin_px,1\nminimum_cells_for_qc,3\nnucleus_min_circularity,0\nlocal_background_inner_radius_px,10\nlocal_background_outer_radius_px,14\nlocal_background_min_pixels,10\n"


def written(path, sep=","):
    return [r for p in sorted(glob.glob(f"{path}/*.csv.gz")) for r in csv.DictReader(gzip.open(p, "rt"), delimiter=sep)]


@pytest.fixture(scope="module")
def study(tmp_path_factory):
    """Two units in two conditions, one annotated image, one broken and one missing file."""
    folder = tmp_path_factory.mktemp("study")
    (folder / "img").mkdir()
    lines = []
    for u in (1, 2):
        for condition, positive in (("ctrl", 0), ("drug", 6)):
            name = f"S0{u}_{condition}"
            (folder / "img" / f"{name}.png").write_bytes(im.write_png(scenes.stained_scene(positive=positive, seed=u + 5)[0]))
            lines.append(f"{name},P{u},{condition},1,img/{name}.png,,dab\n")
    (folder / "img" / "bad.png").write_bytes(b"\x89PNG broken")
    lines += ["B1,P3,ctrl,1,img/bad.png,0.5,dab\n", "B2,P3,drug,1,img/none.png,,dab\n"]
    (folder / "m.csv").write_text(HEAD + "".join(lines))
    (folder / "c.csv").write_text(CONFIG)
    box = lambda i, r, action, part, x0, x1: "".join(f"{i},{r},{j},{x},{y},{action},{part},anna\n" for j, (x, y) in enumerate([(x0, 1), (x1, 1), (x1, 128), (x0, 128)]))
    (folder / "r.csv").write_text("image_id,roi_id,vertex_order,x,y,action,compartment,reviewer\n" + box("S01_drug", "T", " Include", "Tumor", 1, 70) + box("S01_drug", "S", "include", "stroma", 60, 100) + box("S01_drug", "X", "exclude", "artifact", 126, 128) + box("S02_drug", "X", "exclude", "artifact", 1, 30))
    return folder


@pytest.fixture(scope="module")
def output(spark, study):
    out = f"{study}/out"
    assert command.main([f"--manifest={study}/m.csv", f"--roi={study}/r.csv", f"--config={study}/c.csv", f"--out={out}"]) == 1
    return out


def test_command_writes_all_tables(output):
    data = f"{output}/source_data"
    region = {(r["image_id"], r["roi_id"]): r for r in written(f"{data}/region_summary")}
    assert set(region) == {(f"S0{u}_{c}", "GLOBAL") for u in (1, 2) for c in ("ctrl", "drug")} | {("S01_drug", "T"), ("S01_drug", "S")}
    assert {r["compartment"] for r in region.values()} == {"global", "tumor", "stroma"}
    for u in (1, 2):
        assert float(region[f"S0{u}_drug", "GLOBAL"]["h_score"]) > float(region[f"S0{u}_ctrl", "GLOBAL"]["h_score"]) + 50
    cells = written(f"{data}/cell_measurements")
    assert len(cells) > 30 and {"nuclear_intensity_class", "whole_cell_dab_q90_od", "local_background_od", "biological_unit_id"} <= set(cells[0])
    assert [r["biological_unit_id"] for r in cells] == sorted(r["biological_unit_id"] for r in cells)
    member = written(f"{data}/cell_region_membership")
    assert sum(r["roi_id"] == "GLOBAL" for r in member) == len(cells) and 0 < sum(r["roi_id"] == "T" for r in member) < len(cells)
    units = {(r["biological_unit_id"], r["condition"]): r for r in written(f"{data}/biological_unit_summary") if r["compartment"] == "global"}
    assert len(units) == 4
    long = written(f"{data}/primary_domain_summary_long")
    assert {r["measurement_domain"] for r in long} == {"global", "nucleus", "cytoplasm", "extracellular"} and len(long) == 4 * len(written(f"{data}/biological_unit_summary"))
    effects = {r["metric"]: r for r in written(f"{data}/paired_effects") if r["compartment"] == "global"}
    assert effects["h_score"]["n_paired_units"] == "2" and effects["h_score"]["reference_condition"] == "ctrl" and effects["h_score"]["exact_signflip_p_mean_difference"] == "0.5" and len(effects) >= 10
    assert {(r["roi_id"], r["action"]) for r in written(f"{data}/roi_registry") if r["image_id"] == "S01_drug"} == {("GLOBAL", "include"), ("T", "include"), ("S", "include"), ("X", "exclude")}
    assert [(r["roi_id_1"], r["roi_id_2"], r["same_compartment"]) for r in written(f"{data}/roi_overlap_audit")] == [("S", "T", "false")]
    quality = {r["image_id"]: r for r in written(f"{data}/image_qc")}
    assert quality["S01_drug"]["qc_flags"] == "OVERLAPPING_INCLUDE_ROIS;MISSING_PIXEL_SIZE_CALIBRATION" and quality["S02_drug"]["qc_flags"] == "MISSING_PIXEL_SIZE_CALIBRATION"
    assert all(float(r["focus_score"]) > 0 for r in quality.values())
    errors = {r["image_id"]: r["error"] for r in written(f"{output}/work/image_errors")}
    assert set(errors) == {"B1", "B2"} and errors["B2"].startswith("FileNotFoundError")
    assert len(written(f"{data}/manual_qc_template")) == 4 and len(written(f"{data}/metric_dictionary")) == 4 and len(written(f"{output}/config/image_manifest_used")) == 6
    assert {r["parameter"]: r["value"] for r in written(f"{output}/config/analysis_parameters_used")}["nucleus_min_area_px"] == "20.0"


def test_one_pass_equals_pixel_rows(spark, study, output):
    """The tables of the run are those that pixel rows give by Spark's aggregates."""
    o = mf.read_options(spark, f"{study}/c.csv", mf.StainRunOptions())
    tagged = spark.read.schema(quantify.TAGGED).parquet(f"{output}/work/tagged")
    image = im.rgb_image((study / "img" / "S02_drug.png").read_bytes())
    polygon = kernels.polygon_mask(128, 128, np.array([1.0, 30, 30, 1]), np.array([1.0, 1, 128, 128]))
    from tessella.operators import segment

    e = o.effective(None)
    stain, dab, total = segment.unmixed(image, ~polygon)
    s = segment.StainOptions(blur=e["nucleus_blur"], min_area=20, max_area=5000, min_circularity=0, max_eccentricity=0.98, min_mean=0.035, margin=1, reach=6)
    tissue = segment.stain_tissue(total, ~polygon, s)
    nuclei = segment.stain_nuclei(stain, tissue, s)
    cells = segment.stain_cells(total, nuclei, tissue, ~polygon, s)
    y, x = np.mgrid[:128, :128]
    rows = zip(x.ravel().tolist(), y.ravel().tolist(), dab.ravel().tolist(), nuclei.ravel().tolist(), cells.ravel().tolist(), tissue.ravel().tolist(), strict=True)
    p = spark.createDataFrame([("S02_drug", *r) for r in rows], "image_id string, x int, y int, v double, nuc_label int, cell_label int, tissue boolean").cache()
    want = measure.four_domains(p, ["image_id"], "v", 0.08).head()
    got = quantify.rows_of(tagged, "region").where("image_id = 'S02_drug'").head()
    for d in quantify.AREA_DOMAINS:
        for a, b in (("area_px",) * 2, ("positive_area_px",) * 2, ("mean_od", "mean_dab_od"), ("integrated_od", "integrated_dab_od"), ("positive_mean_od", "positive_mean_dab_od")):
            expected = want[f"{d}_{a}"]
            assert got[f"{d}_{b}"] == pytest.approx(0.0 if expected is None and b == "positive_area_px" else expected)
    mine = {r.cell_id: r for r in quantify.rows_of(tagged, "cell").where("image_id = 'S02_drug'").collect()}
    centres = spark.createDataFrame([("S02_drug", i, r.cx, r.cy) for i, r in mine.items()], "image_id string, cell_id int, cx double, cy double")
    field = measure.field_background(p, ["image_id"], "v")
    back = measure.annulus_background(centres, p, field, "v", 10, 14, 10)
    local = p.where("nuc_label = 0 and cell_label > 0").join(back.withColumnRenamed("cell_id", "cell_label"), ["image_id", "cell_label"])
    stats = {r.cell_label: r for r in measure.domain_stats(local, ["image_id", "cell_label", "local_background"], "v", "local_background", 0.08).collect()}
    assert len(stats) == len(mine) > 5
    for i, r in stats.items():
        assert mine[i].local_background_od == pytest.approx(r.local_background)
        for a, b in (("n_px", "area_px"), ("mean_od", "dab_mean_od"), ("median_od", "dab_median_od"), ("q90_od", "dab_q90_od"), ("positive_fraction", "dab_positive_area_fraction"), ("positive_mean_od", "dab_positive_mean_od"), ("raw_mean_od", "dab_raw_mean_od")):
            assert mine[i][f"cytoplasm_{b}"] == pytest.approx(r[a])
    p.unpersist()


def test_run_that_cannot_be_made(spark, study, tmp_path):
    (tmp_path / "m.csv").write_text(HEAD + "a,P1,x,1,none.png,,dab\n")
    assert command.main([f"--manifest={tmp_path}/m.csv", f"--out={tmp_path}/o"]) == 2
    assert {r["image_id"] for r in written(f"{tmp_path}/o/work/image_errors", "\t")} == {"a"}
    assert command.main([f"--manifest={study}/m.csv", f"--out={tmp_path}/o", "--condition-order=ctrl,other"]) == 2
    (tmp_path / "r.csv").write_text("image_id,roi_id,vertex_order,x,y\na,r,1,1,1\na,r,2,NaN,5\na,r,3,5,5\n")
    with pytest.raises(ValueError, match="finite"):
        mf.roi_vertices(spark, f"{tmp_path}/r.csv")


def test_comparison_order(spark):
    m = spark.createDataFrame([("b",), ("a",), ("b",)], "condition string").coalesce(1)
    assert runs.comparison(m, None) == ("b", "a") and runs.comparison(m, " a , b") == ("a", "b")
    assert runs.comparison(m.where("condition = 'a'"), None) is None
    for bad in ("a", "a,b,c", "a,", "a,z", "a,a"):
        with pytest.raises(ValueError):
            runs.comparison(m, bad)


def test_scaled_lengths():
    e = mf.StainRunOptions().effective(0.5)
    assert e == {"scale_mode": "physical_um", "nucleus_blur": 1.6, "nucleus_min_area": 80.0, "nucleus_max_area": 1600.0, "border_margin": 2, "cell_reach": 12, "background_inner": 14, "background_outer": 24}
    assert mf.StainRunOptions().effective(float("nan"))["scale_mode"] == mf.StainRunOptions().effective(0)["scale_mode"] == "pixel_fallback"
    with pytest.raises(ValueError, match="increase"):
        mf.StainRunOptions().overlay({"dab_threshold_weak": "0.01"})


# masks as runs


def masks_of(runs_, size):
    out = np.zeros((size, size), dtype=bool)
    for r in runs_.collect():
        assert not out[r.y, r.x_from : r.x_to + 1].any()
        out[r.y, r.x_from : r.x_to + 1] = True
    return out


def test_combined_runs_like_pixels(spark):
    rng = np.random.default_rng(4)
    a, b = (rng.random((20, 20)) < 0.6 for _ in range(2))

    def as_runs(mask):
        edges = np.diff(np.pad(mask, ((0, 0), (1, 1))).astype(int), axis=1)
        (y, x0), (_, x1) = np.nonzero(edges == 1), np.nonzero(edges == -1)
        rows = [(1, int(r), int(s), int(t) - 1) for r, s, t in zip(y, x0, x1, strict=True)]
        # pieces that overlap and touch are one mask as well
        return spark.createDataFrame(rows + rows[::2] + [(i, r, s, s) for i, r, s, t in rows], "image_id int, y int, x_from int, x_to int")

    for how, want in (("union", a | b), ("intersection", a & b), ("difference", a & ~b)):
        got = run_masks.combined(as_runs(a), as_runs(b), how)
        assert (masks_of(got, 20) == want).all()
        assert got.count() == (np.diff(np.pad(want, ((0, 0), (1, 1))).astype(int), axis=1) == 1).sum()  # as few as there can be
    with pytest.raises(ValueError):
        run_masks.combined(as_runs(a), as_runs(b), "xor")


def test_zero_outside_and_audit(spark):
    sizes = spark.createDataFrame([(1, 10, 10), (2, 10, 10), (3, 10, 10)], "image_id int, width int, height int")
    square = [(1.0, 1.0), (6.0, 1.0), (6.0, 6.0), (1.0, 6.0)]
    rows = [(1, "a", "include", j, x, y) for j, (x, y) in enumerate(square)] + [(1, "b", "exclude", j, x, y) for j, (x, y) in enumerate([(1.0, 1.0), (3.0, 1.0), (3.0, 11.0), (1.0, 11.0)])] + [(2, "c", "exclude", j, x, y) for j, (x, y) in enumerate(square)]
    vertices = spark.createDataFrame(rows, "image_id int, roi_id string, action string, vertex_order int, x double, y double")
    kept = run_masks.analysis_runs(vertices, sizes)
    audit = {r.image_id: r for r in run_masks.roi_audit(vertices, sizes).collect()}
    assert (audit[1].included_roi_ids, audit[1].excluded_roi_ids, audit[1].included_pixel_count, audit[1].excluded_pixel_count) == ("a", "b", 15, 20)
    assert (audit[2].included_roi_ids, audit[2].included_pixel_count, audit[2].roi_mask_status) == ("NONE", 75, "REVIEWED_ROI_APPLIED")
    assert (audit[3].roi_mask_status, audit[3].included_fraction) == ("NO_REVIEWED_ROI", 1.0)
    inside = {i: np.zeros((10, 10), bool) for i in (1, 2)}
    for r in geometry.pixels_in_polygons(vertices, 10, 10).collect():
        if r.roi_id == "a":
            inside[1][r.y, r.x] = True
        if r.roi_id == "c":
            inside[2][r.y, r.x] = True
    planes = spark.createDataFrame([(i, 10, 10, np.ones((10, 10), "<f4").tobytes()) for i in (1, 2, 3)], "image_id int, h int, w int, data binary")
    out = {r.image_id: np.frombuffer(r.data, "<f4").reshape(10, 10) for r in run_masks.zero_outside(planes, kept, "data").collect()}
    inside[1][:, :2] = False
    assert (out[1] == inside[1]).all() and (out[2] == ~inside[2]).all() and (out[3] == 1).all()


def test_text_ids_and_include_only_overlaps(spark):
    image = scenes.stained_scene(positive=6, seed=7)[0]
    rows = [("S01", 128, 128, *(np.ascontiguousarray(image[..., c]).astype("<f4").tobytes() for c in range(3)))]
    images = spark.createDataFrame(rows, "image_id string, h int, w int, r binary, g binary, b binary")
    manifest = spark.createDataFrame([("S01", "u1", "control", 0.5)], "image_id string, biological_unit_id string, condition string, pixel_size_um double")
    corners = [(1.0, 1.0), (65.0, 1.0), (65.0, 128.0), (1.0, 128.0)]
    vertices = spark.createDataFrame([("S01", r, a, "custom", j, x, y) for r, a in (("in", "include"), ("out", "exclude")) for j, (x, y) in enumerate(corners)], "image_id string, roi_id string, action string, compartment string, vertex_order int, x double, y double")
    run = pipelines.brightfield(images, manifest, vertices)
    assert {r.image_id for r in run.cells.collect()} == {"S01"}
    assert "OVERLAPPING" not in run.quality.select(F.col("qc_flags")).head()[0]


# fluorescence


@pytest.fixture(scope="module")
def channels(tmp_path_factory):
    folder = tmp_path_factory.mktemp("channels")
    lines = ["image_id,biological_unit_id,condition,modality,marker,channel_name,channel_index,channel_role,file_path,pixel_size_um\n"]
    for u, (condition, nuclear, cytoplasm) in enumerate([("ctrl", 0.15, 0.85), ("drug", 0.85, 0.2)] * 2):
        s = scenes.fluorescence_scene(nuclear=nuclear, cytoplasm=cytoplasm, seed=40 + u)
        spots = np.clip(scenes.puncta_scene(256, seed=u)[0], 0, 1)
        (folder / f"i{u}.tif").write_bytes(im.write_tiff([s["nuclear"], s["target"], spots, s["reference"]], description="ImageJ=1.53\nimages=4\nchannels=4\nslices=1\n"))
        for i, (name, role, marker) in enumerate([("DAPI", "nucleus", "DNA"), ("GFP", "Target", "p65"), ("RFP", "target", "gH2AX"), ("Cy5", "cytoplasm_reference", "actin")]):
            lines.append(f"F{u},U{u // 2},{condition},IF,{marker},{name},{i + 1},{role},i{u}.tif,0.5\n")
    (folder / "m.csv").write_text("".join(lines))
    (folder / "c.csv").write_text("parameter,value\nbg_method,none\nnuc_min_area,30\nnuc_max_area,4000\n")
    (folder / "r.csv").write_text("image_id,roi_id,vertex_order,x,y,action\n" + "".join(f"F0,in,{j},{x},{y},include\nF1,out,{j},{x},{y},exclude\n" for j, (x, y) in enumerate([(1, 1), (128, 1), (128, 256), (1, 256)])))
    return folder


def test_fluorescence_manifest_to_tables(channels):
    out = f"{channels}/out"
    assert command.main([f"--manifest={channels}/m.csv", f"--roi={channels}/r.csv", f"--config={channels}/c.csv", f"--out={out}"]) == 0
    data = f"{out}/source_data"
    units = {(r["biological_unit_id"], r["condition"], r["marker"], r["compartment"]): r for r in written(f"{data}/biological_unit_summary")}
    for u in ("U0", "U1"):
        assert float(units[u, "drug", "p65", "nucleus"]["mean_intensity"]) > float(units[u, "ctrl", "p65", "nucleus"]["mean_intensity"]) + 0.3
        assert float(units[u, "ctrl", "p65", "cytoplasm"]["mean_intensity"]) > float(units[u, "drug", "p65", "cytoplasm"]["mean_intensity"]) + 0.3
    assert {k[3] for k in units} == set(quantify.COMPARTMENTS)
    quality = {r["image_id"]: r for r in written(f"{data}/image_qc")}
    assert int(quality["F2"]["n_cells"]) > int(quality["F0"]["n_cells"]) > 5 and quality["F0"]["qc_flags"].startswith("REVIEWED_ROI_APPLIED")
    audit = {r["image_id"]: r for r in written(f"{data}/roi_exclusion_summary")}
    assert (audit["F0"]["included_roi_ids"], audit["F0"]["included_pixel_count"], audit["F1"]["excluded_roi_ids"], audit["F2"]["roi_mask_status"]) == ("in", str(127 * 255), "out", "NO_REVIEWED_ROI")
    assert int(audit["F1"]["included_pixel_count"]) == 256 * 256 - 127 * 255
    cells = written(f"{data}/cell_summary")
    assert len(cells) == 2 * sum(int(r["n_cells"]) for r in quality.values()) and {r["marker"] for r in cells} == {"p65", "gH2AX"}
    assert {r["marker"] for r in written(f"{data}/puncta_summary")} == {"gH2AX"}
    coloc = written(f"{data}/colocalization_summary")
    assert len(coloc) == 4 and {(r["marker_a"], r["marker_b"]) for r in coloc} == {("p65", "gH2AX")}
    assert [r["run_status"] for r in written(f"{data}/run_status")] == ["PASS"]
    effects = {(r["marker"], r["compartment"], r["metric"]): r for r in written(f"{data}/paired_effects")}
    assert effects["p65", "nucleus", "mean_intensity"]["n_higher_in_comparison"] == "2"
    assert len(written(f"{data}/channel_metadata")) == 16 and len(written(f"{data}/channel_summary")) == 8


def test_fluorescence_run_equals_pixel_rows(spark, channels):
    """Compartments and cells of the run are those that pixel rows give by Spark's aggregates."""
    tagged = spark.read.schema(quantify.tagged_schema(quantify.CHANNEL_KINDS)).parquet(f"{channels}/out/work/tagged")
    from tessella.operators import pixels as px, segment

    planes, depth = im.channel_planes((channels / "i2.tif").read_bytes(), 4)
    assert depth == 1
    o = segment.FluorescenceOptions(min_area=30, max_area=4000)
    nuclei = segment.fluorescence_nuclei(planes[0], o)
    cells = segment.fluorescence_cells(planes[0], nuclei, o, planes[3])
    tissue = segment.tissue_proxy(planes[0], planes[3], o.tissue_share)
    y, x = np.mgrid[:256, :256]
    table = {"x": x, "y": y, "v": planes[1], "w": planes[2], "nuc_label": nuclei, "cell_label": cells, "tissue": tissue}
    import pandas as pd

    p = spark.createDataFrame(pd.DataFrame({n: a.ravel() for n, a in table.items()})).withColumn("image_id", F.lit("F2")).cache()
    nuclear, cell = F.col("nuc_label") > 0, F.col("cell_label") > 0
    masks = {"global": F.col("tissue"), "nucleus": nuclear, "cytoplasm": cell & ~nuclear, "extracellular": F.col("tissue") & ~cell}
    cut = px.otsu(p, ["image_id"], "v").head().threshold
    want = {r.compartment: r for r in measure.compartment_stats(p, ["image_id"], "v", masks, cut, 0.5).collect()}
    got = {r.compartment: r for r in quantify.rows_of(tagged, "compartment").where("image_id = 'F2' and marker = 'p65'").collect()}
    for name, r in got.items():
        assert r.threshold_value == pytest.approx(cut) and r.pixel_count == want[name].pixel_count and r.positive_pixel_count == want[name].positive_count
        for a, b in (("area_um2",) * 2, ("mean_intensity",) * 2, ("median_intensity",) * 2, ("integrated_intensity",) * 2, ("max_intensity",) * 2, ("intensity_sd", "sd_intensity")):
            assert r[a] == pytest.approx(want[name][b])
    ours = {r.cell_id: r for r in quantify.rows_of(tagged, "cell").where("image_id = 'F2' and marker = 'p65'").collect()}
    theirs = {r.cell_id: r for r in measure.single_cells(p, ["image_id"], "v", cut).collect()}
    assert set(ours) == set(theirs)
    for i, r in ours.items():
        assert r.nuclear_mean_intensity == pytest.approx(theirs[i].nuclear_mean) and r.cytoplasmic_median_intensity == pytest.approx(theirs[i].cytoplasm_median) and r.nuclear_to_cytoplasmic_ratio == pytest.approx(theirs[i].nc_ratio) and r.is_positive_cell == theirs[i].is_positive_cell
    coloc = quantify.rows_of(tagged, "coloc").where("image_id = 'F2'").head()
    both = measure.pearson(p.where("tissue"), ["image_id"], "v", "w").head()
    shares = measure.manders(p.where("tissue"), ["image_id"], "v", "w", coloc.threshold_a, coloc.threshold_b).head()
    assert coloc.pixel_count == both.n_pairs and coloc.pearson_r == pytest.approx(both.pearson_r) and coloc.manders_m1 == pytest.approx(shares.manders_m1) and coloc.manders_m2 == pytest.approx(shares.manders_m2)
    p.unpersist()


def test_quality_blocks_a_fluorescence_run(channels, tmp_path):
    lines = (channels / "m.csv").read_text().splitlines()
    dark = [np.zeros((40, 40))] * 2
    (tmp_path / "dark.tif").write_bytes(im.write_tiff(dark))
    (tmp_path / "m.csv").write_text("\n".join([lines[0], "D,U,ctrl,IF,DNA,DAPI,1,nucleus,dark.tif,", "D,U,ctrl,IF,p65,GFP,2,target,dark.tif,"]) + "\n")
    assert command.main([f"--manifest={tmp_path}/m.csv", f"--out={tmp_path}/out"]) == 3
    row = written(f"{tmp_path}/out/source_data/image_qc")[0]
    assert row["qc_status"] == "FAIL_REVIEW_REQUIRED" and {"NO_CELLS", "NO_TISSUE", "NO_SIGNAL", "EMPTY_CHANNEL"} <= set(row["qc_flags"].split(";"))
    empty = [r for r in written(f"{tmp_path}/out/source_data/compartment_summary") if r["compartment"] == "nucleus"]
    assert empty[0]["pixel_count"] == "0" and empty[0]["positive_area_fraction"] == "" and [r["run_status"] for r in written(f"{tmp_path}/out/source_data/run_status")] == ["BLOCKED_QC"]


def test_channels_of_stacks():
    planes = [np.full((4, 5), v / 10) for v in (1, 2, 3, 4, 5, 6)]
    stack = im.write_tiff(planes, description="ImageJ=1.5\nchannels=2\nslices=3\n")
    for mode, want in (("max_projection", (0.5, 0.6)), ("mean", (0.3, 0.4)), ("sum_projection", (0.9, 1.2)), ("middle_slice", (0.3, 0.4))):
        got, depth = im.channel_planes(stack, 2, mode)
        assert depth == 3 and np.allclose(got[:, 0, 0], want, atol=1e-4)
    for wrong in (3, 4):
        with pytest.raises(ValueError):
            im.channel_planes(stack, wrong)
    with pytest.raises(ValueError, match="pixels"):
        im.channel_planes(stack, 2, most_pixels=10)
