import csv
import glob
import gzip

from tessella import validate
from tessella.operators import inputs


def codes(df):
    return sorted((r.level, r.id, r.issue) for r in df.collect())


def test_clean_manifest_passes(spark):
    m = spark.createDataFrame([("1", "u", "a", "f", "x.tif", "0.5")], "image_id string, animal_id string, condition string, field string, source_file string, pixel_size_um string")
    assert codes(inputs.validate(m)) == [("PASS", "ALL", "INPUT_VALIDATION_PASS")]


def test_missing_columns_end_the_checks(spark):
    m = spark.createDataFrame([("1", None)], "image_id string, modality string")
    assert codes(inputs.validate(m)) == [("ERROR", "ALL", "MISSING_REQUIRED_COLUMN")] * 4


def test_annotations_without_provenance_columns(spark):
    m = spark.createDataFrame([("1", "u", "a", "f", "x.tif")], "image_id string, biological_unit_id string, condition string, field_id string, file_path string")
    roi = spark.createDataFrame([("1", "r", i, str(x), "1", c) for i, (x, c) in enumerate([(1, "tumor"), (5, "tumor"), ("Inf", None)])], "image_id string, roi_id string, vertex_order int, x string, y string, compartment string")
    got = codes(inputs.validate(m, roi))
    assert got == [
        ("ERROR", "1/r", "INCONSISTENT_ROI_METADATA"),
        ("ERROR", "ALL", "NAMED_COMPARTMENT_WITHOUT_REVIEWER"),
        ("ERROR", "ALL", "NAMED_COMPARTMENT_WITHOUT_SOURCE"),
        ("ERROR", "ALL", "NON_NUMERIC_ROI_COORDINATE"),
        ("WARNING", "ALL", "PIXEL_SIZE_COLUMN_MISSING"),
    ]


def test_command_writes_issues_and_fails_on_errors(spark, tmp_path):
    (tmp_path / "slides").mkdir()
    (tmp_path / "slides" / "a.tif").write_bytes(b"")
    (tmp_path / "m.csv").write_text("image_id,patient_id,condition,field,source_file,pixel_size_um\n1,u,a,f,slides/a.tif,0.5\n2,u,a,f,slides/b.tif,0.5\n3,u,a,f,gone/c.tif,0\n")
    out = tmp_path / "issues"
    assert validate.main([f"--manifest={tmp_path}/m.csv", f"--out={out}"]) == 2
    rows = [r for p in sorted(glob.glob(f"{out}/*.csv.gz")) for r in csv.DictReader(gzip.open(p, "rt"), delimiter="\t")]
    assert [(r["id"], r["issue"]) for r in rows] == [("2", "SOURCE_FILE_NOT_FOUND"), ("3", "SOURCE_FILE_NOT_FOUND"), ("3", "MISSING_PIXEL_SIZE")]
    (tmp_path / "ok.csv").write_text("image_id,patient_id,condition,field,source_file,pixel_size_um\n1,u,a,f,slides/a.tif,0.5\n")
    assert validate.main([f"--manifest={tmp_path}/ok.csv", f"--out={tmp_path}/none"]) == 0
