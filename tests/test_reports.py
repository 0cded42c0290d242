import xml.dom.minidom

import numpy as np
import pandas as pd
import pytest

from tessella.operators import geometry, reports, run_masks, statistics as st


def test_svg_is_well_formed(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3)] + [("b<", 5.0)], "condition string, value double")
    svg = reports.bar_svg(st.bar_table(df, ["condition"], "value"), "H & D", 10.0)
    doc = xml.dom.minidom.parseString(svg)
    assert len(doc.getElementsByTagName("rect")) == 2


def test_write_table(spark, tmp_path):
    df = spark.createDataFrame([(2, "x"), (1, None)], "a int, b string")
    for kind, sep in (("csv", ","), ("tsv", "\t")):
        reports.write_table(df, str(tmp_path / kind), kind, ["a"])
        assert spark.read.csv(str(tmp_path / kind), header=True, sep=sep).count() == 2
    reports.write_table(df, str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2
    with pytest.raises(ValueError):
        reports.write_table(df, str(tmp_path / "q"), "xlsx")


def test_exclusion_square(spark):
    v = spark.createDataFrame([(1, "e", i, float(x), float(y)) for i, (x, y) in enumerate([(3.5, 3.5), (5.5, 3.5), (5.5, 5.5), (3.5, 5.5)])], "image_id int, roi_id string, vertex_order int, x double, y double")
    inside = {(r.x, r.y) for r in geometry.pixels_in_polygons(v, 8, 8).collect()}
    assert inside == {(3, 3), (3, 4), (4, 3), (4, 4)}  # vertices count pixels from 1, planes from 0


def test_bar_table_needs_two_values_for_bounds(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("b", 3.0), ("b", float("nan"))], "condition string, value double")
    rows = {r.condition: r for r in st.bar_table(df, ["condition"], "value", "mean", "sd").collect()}
    assert rows["a"].lower is None and rows["a"].n_units == 1 and rows["b"].n_units == 2 and rows["b"].summary_value == 2
    with pytest.raises(ValueError):
        st.bar_table(df, ["condition"], "value", "mode")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def outlines_by_hand(spark):
    rows = [("i1", "a", "include", 1, 2.0, 2.0), ("i1", "a", "include", 2, 9.0, 2.0), ("i1", "a", "include", 3, 9.0, 8.0), ("i1", "a", "include", 4, 2.0, 8.0)]
    rows += [("i1", "b", "exclude", 1, 4.0, 4.0), ("i1", "b", "exclude", 2, 30.0, 4.0), ("i1", "b", "exclude", 3, 30.0, 6.0), ("i1", "b", "exclude", 4, 4.0, 6.0), ("i2", "c", "exclude", 1, -3.0, 1.0), ("i2", "c", "exclude", 2, 3.0, 1.0), ("i2", "c", "exclude", 3, 3.0, 40.0)]
    return spark.createDataFrame(rows, "image_id string, roi_id string, action string, vertex_order int, x double, y double")


def test_outlines_shuffle_edges_and_no_runs(spark):
    v = outlines_by_hand(spark)
    sizes = spark.createDataFrame([("i1", 10, 10), ("i2", 10, 10), ("i3", 4, 2)], "image_id string, width int, height int")
    for df in (geometry.polygon_runs(v, 10, 10), geometry.run_overlaps(v, 10, 10), run_masks.analysis_runs(v, sizes), run_masks.roi_audit(v, sizes)):
        plan = plan_of(df)
        last = plan.index("MapInPandas")
        assert "Exchange" not in plan[:last] and "Exchange" in plan[last:]


def test_outlines_match_their_pixels(spark, monkeypatch):
    v = outlines_by_hand(spark)
    sizes = spark.createDataFrame([("i1", 10, 10), ("i2", 10, 10), ("i3", 4, 2)], "image_id string, width int, height int")
    inside = geometry.pixels_in_polygons(v, 10, 10)
    assert sorted(geometry.run_overlaps(v, 10, 10).collect()) == sorted(geometry.roi_overlaps(inside).collect())
    actions = v.select("image_id", "roi_id", "action").distinct()
    size = {"i1": (10, 10), "i2": (10, 10), "i3": (4, 2)}
    grid = spark.createDataFrame([(i, x, y) for i, (w, h) in size.items() for x in range(w) for y in range(h)], "image_id string, x int, y int")
    # include ROIs here select pixels, so images limited by a row are those limited by a pixel
    want = {(r.image_id, r.x, r.y) for r in geometry.analysis_mask(grid, inside, actions).where("analysis").collect()}
    got = [(r.image_id, x, r.y) for r in run_masks.analysis_runs(v, sizes).collect() for x in range(r.x_from, r.x_to + 1)]
    assert len(got) == len(set(got)) and set(got) == want
    audit = {r.image_id: r for r in run_masks.roi_audit(v, sizes).collect()}
    assert all(audit[i].included_pixel_count == sum(p[0] == i for p in want) for i in size)
    assert audit["i3"].roi_mask_status == "NO_REVIEWED_ROI" and audit["i1"].excluded_roi_ids == "b" and audit["i2"].included_roi_ids == "NONE"


def test_outline_runs_in_parts_are_the_same(monkeypatch):
    g = np.random.default_rng(5)
    edges = pd.DataFrame({"x1": g.uniform(-5, 45, 60), "y1": g.integers(-3, 45, 60).astype(float), "width": 40, "height": 38})
    roi = np.repeat(np.arange(6), 10)
    for c in "xy":
        edges[f"{c}2"] = np.concatenate([np.roll(edges[f"{c}1"][roi == r], -1) for r in range(6)])
    whole = geometry.outline_runs(edges, roi)
    mask = np.zeros((6, 38, 40), dtype=int)
    for r, e in zip(roi, edges.itertuples(), strict=True):
        for y in range(1, 39):
            if (e.y1 > y) != (e.y2 > y):
                mask[r, y - 1] ^= np.arange(1, 41) < (e.x1 - e.x2) * (y - e.y2) / (e.y1 - e.y2 + geometry.EDGE_EPSILON) + e.x2
    drawn = np.zeros_like(mask)
    for r, y, a, b in zip(*whole, strict=True):
        assert not drawn[r, y, a : b + 1].any()
        drawn[r, y, a : b + 1] = 1
    assert whole[0].size and (mask == drawn).all()
    monkeypatch.setattr(geometry, "CROSSINGS", 7)
    assert all((a == b).all() for a, b in zip(whole, geometry.outline_runs(edges, roi), strict=True))


def test_groups_stay_whole_over_batches():
    rows = pd.DataFrame({"image_id": [1, 1, 2, 2, 2, 2, 3], "roi_id": ["a", "b", None, None, "c", "c", "c"]})
    for cut in range(1, 8):
        parts = list(geometry.whole_groups((rows.iloc[i : i + cut] for i in range(0, 7, cut)), ["image_id"]))
        assert pd.concat(parts).image_id.tolist() == rows.image_id.tolist()
        assert sum(p.image_id.nunique() for p in parts) == 3
