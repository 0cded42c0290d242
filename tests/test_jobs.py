import logging
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from tests import oracle

from jobs import queries, review_intake, study_tables
from jobs.common import settings_of
from tessella.operators import joins

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_job_equals_its_sql(spark, name):
    assert oracle.differences(spark, oracle.connect(SF), queries.QUERIES[name], queries.SQL[name], SF) == ""


def rows_of(df):
    return sorted(map(str, df.collect()))


# study tables


def copies(spark, folder):
    for name in ("lineitem", "orders"):
        spark.read.parquet(f"{SF}/{name}.parquet").write.parquet(f"{folder}/{name}")
    return f"{folder}/lineitem", f"{folder}/orders"


def test_a_batch_replaces_its_partitions_only(spark, tmp_path, caplog):
    cells, images = copies(spark, tmp_path)
    settings = settings_of(spark, None, study_tables.SHIPPED)
    out = f"{tmp_path}/out"
    with caplog.at_level(logging.INFO, logger="tessella.jobs"):
        study_tables.run(spark, cells, images, out, settings)
    assert "read 6000 cells" in caplog.text.replace(",", "") and "wrote" in caplog.text
    whole = rows_of(study_tables.whole_output(spark, out))
    before = {p.name: sorted(f.name for f in p.iterdir()) for p in (tmp_path / "out" / "units").iterdir() if p.is_dir()}
    batch = sorted(before)[0].split("=")[1]
    study_tables.run(spark, cells, images, out, settings, batch)
    after = {p.name: sorted(f.name for f in p.iterdir()) for p in (tmp_path / "out" / "units").iterdir() if p.is_dir()}
    assert rows_of(study_tables.whole_output(spark, out)) == whole
    assert {k for k in before if before[k] != after[k]} == {f"batch_id={batch}"} and len(before) > 3


def test_study_settings_and_checks(spark, tmp_path):
    cells = spark.createDataFrame([("a", 1.0, 0.1), ("a", 2.0, 0.7), (None, 1.0, 0.5), ("x", 1.0, None)], "l_orderkey string, l_quantity double, l_discount double")
    images = spark.createDataFrame([("a", 1, "F", "2020-01-01"), ("b", 1, "O", "2020-01-02"), ("p", 1, "P", "2020-01-02")], "o_orderkey string, o_custkey long, o_orderstatus string, o_orderdate string")
    cells.write.parquet(f"{tmp_path}/c")
    images.write.parquet(f"{tmp_path}/i")
    (tmp_path / "own.csv").write_text("parameter,value\ncells.mean_od,l_discount\nminimum_cells,3\n")
    settings = settings_of(spark, str(tmp_path / "own.csv"), study_tables.SHIPPED)
    study_tables.run(spark, f"{tmp_path}/c", f"{tmp_path}/i", f"{tmp_path}/o", settings)
    got = {r.image_id: (r.n_cells, r.h_score, r.qc_flags) for r in spark.read.parquet(f"{tmp_path}/o/images").collect()}
    assert got == {"a": (2, 150.0, "LOW_CELL_COUNT"), "b": (0, None, "NO_CELLS")}
    images.unionByName(images).write.parquet(f"{tmp_path}/twice")
    with pytest.raises(ValueError, match="more than once"):
        study_tables.run(spark, f"{tmp_path}/c", f"{tmp_path}/twice", f"{tmp_path}/o", settings)
    (tmp_path / "bad.csv").write_text("parameter,value\nminimun_cells,3\n")
    with pytest.raises(ValueError, match="minimun_cells"):
        settings_of(spark, str(tmp_path / "bad.csv"), study_tables.SHIPPED)


# review intake


def test_only_new_files_are_taken(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    settings = settings_of(spark, None, review_intake.SHIPPED)
    source, out, checkpoint = f"{tmp_path}/reports", f"{tmp_path}/out", f"{tmp_path}/checkpoint"
    docs.where("doc_id < 120").write.parquet(source)
    assert review_intake.run(spark, source, out, checkpoint, settings) == docs.where("doc_id < 120").count()
    first = rows_of(review_intake.read_register(spark, out))
    docs.where("doc_id >= 120").write.mode("append").parquet(source)
    assert review_intake.run(spark, source, out, checkpoint, settings) == docs.where("doc_id >= 120").count()
    grown = rows_of(review_intake.read_register(spark, out))
    assert len(grown) == docs.count() > len(first)
    assert review_intake.run(spark, source, out, checkpoint, settings) == 0 and rows_of(review_intake.read_register(spark, out)) == grown
    docs.write.parquet(f"{tmp_path}/all")
    review_intake.run(spark, f"{tmp_path}/all", f"{tmp_path}/out2", f"{tmp_path}/checkpoint2", settings)
    assert rows_of(review_intake.read_register(spark, f"{tmp_path}/out2")) == grown


def test_a_stopped_run_is_mended(spark, tmp_path, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 50")
    settings = settings_of(spark, None, review_intake.SHIPPED)
    docs.write.parquet(f"{tmp_path}/reports")
    args = (spark, f"{tmp_path}/reports", f"{tmp_path}/out", f"{tmp_path}/checkpoint", settings)
    with monkeypatch.context() as m:
        m.setattr(review_intake, "register", lambda rows: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            review_intake.run(*args)
    assert review_intake.run(*args) == 0
    assert review_intake.read_register(spark, f"{tmp_path}/out").count() == docs.count()


def test_flags_of_reports(spark, tmp_path):
    rows = [(1, "One two three four five.", "s1"), (2, "one  TWO three\tfour five. ", "1"), (3, None, None), (4, " \n", "s1"), (5, "too short", "s1"), (6, "a b c d\n\nx\nx\nx\n x ", "s1"), (7, "the tissue is Folded here twice", "s1"), (None, "one two three four five.", "s1")]
    spark.createDataFrame([(i, t, "en", s) for i, t, s in rows], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/reports")
    review_intake.run(spark, f"{tmp_path}/reports", f"{tmp_path}/out", f"{tmp_path}/c", settings_of(spark, None, review_intake.SHIPPED))
    got = {r.report_id: (r.source, r.n_copies, r.first_report_id, r.qc_flags, r.qc_status) for r in review_intake.read_register(spark, f"{tmp_path}/out").collect()}
    assert got == {
        1: ("s1", 3, 1, "PASS", "PASS"), 2: ("1", 3, 1, "COPIED_REPORT", "FAIL_REVIEW_REQUIRED"), 3: (None, 1, 3, "EMPTY_REPORT", "FAIL_REVIEW_REQUIRED"), 4: ("s1", 1, 4, "EMPTY_REPORT", "FAIL_REVIEW_REQUIRED"),
        5: ("s1", 1, 5, "SHORT_REPORT", "REVIEW"), 6: ("s1", 1, 6, "REPEATED_LINES", "REVIEW"), 7: ("s1", 1, 7, "ARTIFACT_REPORTED", "REVIEW"), None: ("s1", 3, 1, "COPIED_REPORT", "FAIL_REVIEW_REQUIRED"),
    }
    by_source = {r.source: (r.n_reports, r.n_pass, r.n_review, r.n_fail_review_required) for r in spark.read.parquet(f"{tmp_path}/out/summary").collect()}
    assert by_source == {"s1": (6, 1, 3, 2), "1": (1, 0, 0, 1), None: (1, 0, 0, 1)}


def test_hot_copies_are_spread(spark, monkeypatch):
    monkeypatch.setattr(joins, "HOT_ROWS", 5)
    left = spark.createDataFrame([(k if k != 9 else None, i) for i, k in enumerate([1] * 50 + [2, 3, 9, 9] * 3)], "k long, v long")
    right = spark.createDataFrame([(1, "one"), (2, "two"), (7, "seven")], "k long, name string")
    for how in ("left", "inner"):
        assert rows_of(joins.spread_join(left, right, "k", how).select("k", "v", "name")) == rows_of(left.join(right, "k", how).select("k", "v", "name"))
    assert joins.hot_keys(left, "k").count() == 1 and joins.hot_keys(left.where(F.lit(False)), "k").count() == 0


def test_command_line(tmp_path):
    command = [sys.executable, "-m", "jobs.study_tables", f"--cells={SF}/lineitem.parquet", f"--images={SF}/orders.parquet", f"--out={tmp_path}/out"]
    done = subprocess.run(command, capture_output=True, text=True, timeout=300, cwd=__file__.rsplit("/tests/", 1)[0])
    assert done.returncode == 0 and "wrote" in done.stderr and (tmp_path / "out" / "effects" / "_SUCCESS").exists()
