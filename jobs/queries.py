"""The jobs as queries: each runs twice over the whole tables into one new folder; its SQL gives the output from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs import review_intake, study_tables
from jobs.common import settings_of
from tessella.sources.scratch import fresh_folder


def job1_study_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three study tables of cells (``lineitem``) and images (``orders``), as one."""
    out, settings = fresh_folder(spark, "job1"), settings_of(spark, None, study_tables.SHIPPED)
    for _ in range(2):
        study_tables.run(spark, f"{sf_dir}/lineitem.parquet", f"{sf_dir}/orders.parquet", out, settings)
    return study_tables.whole_output(spark, out).withColumn("value", F.round("value", 6))


def job2_review_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The register of all ``documents`` as reports."""
    out, settings = fresh_folder(spark, "job2"), settings_of(spark, None, review_intake.SHIPPED)
    for _ in range(2):
        review_intake.run(spark, f"{sf_dir}/documents.parquet", f"{out}/tables", f"{out}/checkpoint", settings)
    return review_intake.read_register(spark, f"{out}/tables")


JOB1_SQL = """WITH i AS (SELECT CAST(o_orderkey AS VARCHAR) AS image_id, CAST(o_custkey % 40 AS VARCHAR) AS unit, o_orderstatus AS condition, CAST(year(o_orderdate) AS VARCHAR) AS batch_id FROM orders WHERE o_orderstatus <> 'P'),
c AS (SELECT CAST(l_orderkey AS VARCHAR) AS image_id, l_quantity AS area, l_discount * 10 AS od FROM lineitem),
s AS (SELECT image_id, count(*) AS n_cells, sum(area) AS cell_area_px, avg(CASE WHEN od >= 0.2 THEN 1.0 ELSE 0.0 END) AS positive_cell_fraction, 100 * avg(CASE WHEN od < 0.2 THEN 0 WHEN od < 0.4 THEN 1 WHEN od < 0.6 THEN 2 ELSE 3 END) AS h_score, avg(od) AS mean_cell_od FROM c GROUP BY 1),
im AS (SELECT i.*, coalesce(n_cells, 0) AS n_cells, coalesce(cell_area_px, 0) AS cell_area_px, positive_cell_fraction, h_score, mean_cell_od, CASE WHEN n_cells IS NULL THEN 'NO_CELLS' WHEN n_cells < 2 THEN 'LOW_CELL_COUNT' ELSE 'PASS' END AS qc_flags FROM i LEFT JOIN s USING (image_id)),
un AS (SELECT batch_id, unit, condition, count(*) AS n_images, sum(n_cells) AS n_cells, sum(cell_area_px) AS cell_area_px, sum(positive_cell_fraction * n_cells) / sum(n_cells) AS positive_cell_fraction, sum(h_score * n_cells) / sum(n_cells) AS h_score, sum(mean_cell_od * n_cells) / sum(n_cells) AS mean_cell_od FROM im WHERE n_cells > 0 GROUP BY 1, 2, 3),
df AS (SELECT a.batch_id, m.metric, CASE m.metric WHEN 'h_score' THEN b.h_score - a.h_score WHEN 'mean_cell_od' THEN b.mean_cell_od - a.mean_cell_od ELSE b.positive_cell_fraction - a.positive_cell_fraction END AS d FROM un a JOIN un b ON a.batch_id = b.batch_id AND a.unit = b.unit AND a.condition = 'F' AND b.condition = 'O', (VALUES ('positive_cell_fraction'), ('h_score'), ('mean_cell_od')) m(metric)),
ef AS (SELECT batch_id, metric, count(*) AS n_paired_units, count(*) FILTER (d > 0) AS n_higher_in_comparison, avg(d) AS mean_paired_difference, quantile_cont(d, 0.5) AS median_paired_difference, CASE WHEN count(*) < 2 THEN 'NOT_EVALUABLE_N_LT_2' ELSE 'DESCRIPTIVE_EXACT_SIGNFLIP' END AS status FROM df GROUP BY 1, 2),
al AS (SELECT 'image' AS level, batch_id, condition, image_id AS subject, unnest([{'m': 'n_cells', 'v': n_cells::DOUBLE}, {'m': 'cell_area_px', 'v': cell_area_px::DOUBLE}, {'m': 'positive_cell_fraction', 'v': positive_cell_fraction::DOUBLE}, {'m': 'h_score', 'v': h_score::DOUBLE}, {'m': 'mean_cell_od', 'v': mean_cell_od::DOUBLE}]) AS e, qc_flags AS status FROM im
UNION ALL SELECT 'unit', batch_id, condition, unit, unnest([{'m': 'n_images', 'v': n_images::DOUBLE}, {'m': 'n_cells', 'v': n_cells::DOUBLE}, {'m': 'cell_area_px', 'v': cell_area_px::DOUBLE}, {'m': 'positive_cell_fraction', 'v': positive_cell_fraction::DOUBLE}, {'m': 'h_score', 'v': h_score::DOUBLE}, {'m': 'mean_cell_od', 'v': mean_cell_od::DOUBLE}]), 'PASS' FROM un
UNION ALL SELECT 'effect', batch_id, 'O-F', metric, unnest([{'m': 'n_paired_units', 'v': n_paired_units::DOUBLE}, {'m': 'n_higher_in_comparison', 'v': n_higher_in_comparison::DOUBLE}, {'m': 'mean_paired_difference', 'v': mean_paired_difference::DOUBLE}, {'m': 'median_paired_difference', 'v': median_paired_difference::DOUBLE}]), status FROM ef)
SELECT level, batch_id, condition, subject, e.m AS metric, round(e.v, 6) AS value, status FROM al"""

JOB2_SQL = r"""WITH t AS (SELECT doc_id AS report_id, source, lang, coalesce(text, '') AS text FROM documents),
p AS (SELECT report_id, source, lang, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n_words, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS lines, translate(trim(regexp_replace(text, '[\x20\x09-\x0D]+', ' ', 'g')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS plain FROM t),
c AS (SELECT *, CASE WHEN plain <> '' THEN md5(plain) END AS digest, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_repeated_lines FROM p),
k AS (SELECT *, CASE WHEN digest IS NULL THEN 1 ELSE count(*) OVER (PARTITION BY digest) END AS n_copies, CASE WHEN digest IS NULL THEN report_id ELSE min(report_id) OVER (PARTITION BY digest) END AS first_report_id FROM c),
f AS (SELECT *, list_filter([CASE WHEN n_words = 0 THEN 'EMPTY_REPORT' END, CASE WHEN n_words BETWEEN 1 AND 4 THEN 'SHORT_REPORT' END, CASE WHEN n_words > 5000 THEN 'LONG_REPORT' END, CASE WHEN n_lines >= 4 AND n_repeated_lines >= 0.5 * n_lines THEN 'REPEATED_LINES' END, CASE WHEN regexp_matches(plain, '\b(artifact|blur|bubble|fold|saturat)') THEN 'ARTIFACT_REPORTED' END, CASE WHEN report_id <> first_report_id THEN 'COPIED_REPORT' END], lambda x: x IS NOT NULL) AS flags FROM k)
SELECT report_id, source, lang, n_words, n_lines, n_repeated_lines, digest, n_copies, first_report_id, CASE WHEN len(flags) = 0 THEN 'PASS' ELSE array_to_string(flags, ';') END AS qc_flags,
CASE WHEN list_contains(flags, 'EMPTY_REPORT') OR list_contains(flags, 'COPIED_REPORT') THEN 'FAIL_REVIEW_REQUIRED' WHEN len(flags) > 0 THEN 'REVIEW' ELSE 'PASS' END AS qc_status FROM f"""

QUERIES = {"job1_study_tables": job1_study_tables, "job2_review_intake": job2_review_intake}
SQL = {"job1_study_tables": JOB1_SQL, "job2_review_intake": JOB2_SQL}
