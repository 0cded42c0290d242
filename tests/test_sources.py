import numpy as np
import pytest

from tessella.functions import parse_bool
from tessella.operators import pixels as px, segment, statistics as st
from tessella.sources import images, manifest, scenes


def put(path, b):
    path.write_bytes(b)
    return str(path)


@pytest.mark.parametrize("bits", [8, 16])
@pytest.mark.parametrize("deflate", [False, True])
def test_tiff_round_trip(bits, deflate):
    planes = [np.random.default_rng(i).random((13, 9)) for i in range(3)]
    b = images.write_tiff(planes, bits, "ImageJ=1.0\nchannels=3\nslices=1\n", deflate)
    pages = images.tiff_directories(b)
    assert len(pages) == 3 and images.imagej_description(pages[0]["description"])["channels"] == "3"
    for p, want in zip(pages, planes, strict=True):
        assert np.abs(images.tiff_page(b, p)[..., 0] - want).max() <= 0.5001 / (2**bits - 1)


def test_png_round_trip():
    a = np.random.default_rng(1).random((11, 7, 3))
    assert np.abs(images.png_image(images.write_png(a)) - a).max() <= 0.5001 / 255


def test_stack_shape():
    assert images.stack_shape("ImageJ=1\nchannels=2\nslices=5\n", 10, 2) == (2, 5)
    assert images.stack_shape(None, 6, 3) == (3, 2)
    for text, pages, channels in (("ImageJ=1\nchannels=2\nframes=3\n", 6, 2), ("ImageJ=1\nchannels=2\n", 10, 3), (None, 7, 2)):
        with pytest.raises(ValueError):
            images.stack_shape(text, pages, channels)


def test_read_pages_keeps_errors_as_rows(spark, tmp_path):
    stack = [np.full((4, 5), (i + 1) / 10) for i in range(4)]
    put(tmp_path / "a.tif", images.write_tiff(stack, 16))
    put(tmp_path / "b.png", images.write_png(np.zeros((2, 3, 3))))
    put(tmp_path / "c.tif", b"nothing")
    pages = images.read_pages(spark, str(tmp_path)).cache()
    rows = {(r.path.rsplit("/", 1)[1], r.page): r for r in pages.collect()}
    assert set(rows) == {("a.tif", 1), ("a.tif", 2), ("a.tif", 3), ("a.tif", 4), ("b.png", 1), ("c.tif", 0)}
    assert "not a TIFF" in rows["c.tif", 0].error and rows["b.png", 1].samples == 3
    path = rows["a.tif", 1].path
    planes = images.stack_planes(pages, spark.createDataFrame([(path, 2)], "path string, n_channels int"))
    got = {(r.channel_index, r.z): np.frombuffer(r.data, "<f4")[0] for r in planes.collect()}
    assert {key: round(float(v), 2) for key, v in got.items()} == {(1, 1): 0.1, (2, 1): 0.2, (1, 2): 0.3, (2, 2): 0.4}
    assert images.split_samples(pages).count() == 1
    pages.unpersist()


STAIN = "image_id,sample_id,condition,image_field,file_path,analysis_status,pixel_size_um\na,u1,control,1,a.png,include,0.5\nb,u1,treated,1,b.png,,\nc,u2,control,1,c.png,exclude,0.5\n"


def test_stain_manifest(spark, tmp_path):
    path = put(tmp_path / "m.csv", STAIN.encode())
    rows = {r.image_id: r for r in manifest.stain_manifest(spark, path).collect()}
    assert set(rows) == {"a", "b"} and rows["b"].pixel_size_um is None and rows["a"].pixel_size_um == 0.5 and rows["b"].batch_id == "batch_1"
    with pytest.raises(ValueError, match="more than once"):
        manifest.stain_manifest(spark, put(tmp_path / "d.csv", (STAIN + "a,u1,x,1,d.png,include,\n").encode()))
    with pytest.raises(ValueError, match="missing columns"):
        manifest.stain_manifest(spark, put(tmp_path / "e.csv", b"sample_id,group\na,b\n"))
    with pytest.raises(ValueError, match="whole-slide"):
        manifest.stain_manifest(spark, put(tmp_path / "f.csv", STAIN.replace("a.png", "a.svs").encode()))


def test_channel_manifest(spark, tmp_path):
    head = "image_id,biological_unit_id,condition,modality,marker,channel_name,channel_index,channel_role,file_path\n"
    good = head + "a,u,c,if,m,dapi,1,nucleus,a.tif\na,u,c,if,m,x,2,Target,a.tif\n"
    assert manifest.channel_manifest(spark, put(tmp_path / "g.csv", good.encode())).count() == 2
    for bad, what in ((good.replace(",2,", ",3,"), "1..N"), (good.replace("Target", "other"), "missing"), (good.replace("nucleus", "core"), "unknown")):
        with pytest.raises(ValueError, match=what):
            manifest.channel_manifest(spark, put(tmp_path / "h.csv", bad.encode()))


def test_options(spark, tmp_path):
    o = manifest.read_options(spark, put(tmp_path / "o.csv", b"parameter,value\nz_mode,sum\nminimum_cells_for_qc,3\nlocal_background,no\ndab_thresholds,0.1;0.2;0.5\nunknown,1\npositive_threshold,\n"))
    assert (o.z_mode, o.minimum_cells_for_qc, o.local_background, o.dab_thresholds, o.positive_threshold) == ("sum", 3, False, (0.1, 0.2, 0.5), 0.2)
    for rows in ({"z_mode": "best"}, {"dab_thresholds": "0.3;0.2"}, {"local_background": "maybe"}):
        with pytest.raises(ValueError):
            manifest.Options().overlay(rows)


def test_paths():
    assert all(map(manifest.absolute, ("/a", "~/a", "C:\\a", "\\\\host\\a", "s3a://b/a"))) and not manifest.absolute("a/b")
    assert manifest.resolve("x.png", "/data") == "/data/x.png"


def test_parse_bool(spark):
    df = spark.createDataFrame([("Yes",), (" f ",), (None,)], "w string")
    assert [r[0] for r in df.select(parse_bool("w")).collect()] == [True, False, None]
    with pytest.raises(Exception, match="not a boolean"):
        spark.createDataFrame([("maybe",)], "w string").select(parse_bool("w")).collect()


@pytest.mark.parametrize(("values", "want"), [([1.0, 2.0], 0.5), ([0.0, 0.0, 0.0], 1.0), ([1.0] * 5, 2 / 32), ([3.0], None), ([1.0] * 21, None), ([1.0, -2.0, 0.5, None], None)])
def test_exact_signflip(spark, values, want):
    got = spark.createDataFrame([(values,)], "d array<double>").select(st.exact_signflip("d")).head()[0]
    if want is None and len([v for v in values if v is not None]) == 3:
        v = np.array([1.0, -2.0, 0.5])
        signs = np.array(np.meshgrid(*[[-1, 1]] * 3)).reshape(3, -1)
        want = float(np.mean(np.abs((signs * v[:, None]).mean(0)) >= abs(v.mean()) - 1e-8))
    assert (got is None or got != got) if want is None else got == pytest.approx(want)


def test_segmentation_end_to_end(spark):
    s = scenes.fluorescence_scene()
    row = lambda i, p: (i, 256, 256, p["nuclear"].astype("<f4").tobytes(), p["reference"].astype("<f4").tobytes())
    planes = spark.createDataFrame([row(1, s), (2, 5, 5, b"bad", None)], "image_id long, h int, w int, nuclear binary, reference binary")
    labels = segment.segment_fluorescent(planes).cache()
    rows = {r.image_id: r for r in labels.collect()}
    assert rows[1].n_cells == 25 and rows[1].status == "OK" and rows[2].status == "ERROR"
    assert segment.label_pixels(labels).where("nuc_label > 0").select("nuc_label").distinct().count() == 25
    labels.unpersist()


def test_colocalisation_bounds(spark):
    from tessella.operators import measure

    for exclusive, check in ((False, lambda r: r.pearson_r > 0.85), (True, lambda r: r.pearson_r < 0.15)):
        a, b = scenes.coloc_scene(exclusive=exclusive)
        a, b = a[:128:2, :128:2].ravel().tolist(), b[:128:2, :128:2].ravel().tolist()
        df = spark.createDataFrame([(1, x, y) for x, y in zip(a, b, strict=True)], "image_id int, a double, b double")
        r = measure.pearson(df, ["image_id"], "a", "b").head()
        m = measure.manders(df, ["image_id"], "a", "b", 0.4, 0.4).head()
        assert check(r) and ((m.manders_m1 > 0.8 and m.manders_m2 > 0.8) if not exclusive else (m.manders_m1 < 0.25 and m.manders_m2 < 0.25))


def test_pearson_without_spread_is_null(spark):
    from tessella.operators import measure

    df = spark.createDataFrame([(1, 0.5, float(i)) for i in range(40)], "image_id int, a double, b double")
    assert measure.pearson(df, ["image_id"], "a", "b").head().pearson_r is None


def test_threshold_methods(spark):
    rows = [(1, v) for v in (0.1, 0.1, 0.12, 0.9, 0.95)] + [(2, None)]
    df = spark.createDataFrame(rows, "image_id int, v double")
    for method in ("otsu", "percentile", "background", "triangle"):
        got = {r.image_id: r.threshold for r in px.positivity_threshold(df, ["image_id"], "v", method).collect()}
        assert got[2] is None and 0.1 <= got[1] <= 0.95
    with pytest.raises(ValueError):
        px.positivity_threshold(df, ["image_id"], "v", "other")


def test_stack_that_does_not_divide_gives_an_error_row(spark):
    rows = [("a", p, 1, 1, 8, 1, None, bytes(4), None) for p in (1, 2, 3, 4)] + [("b", p, 1, 1, 8, 1, None, bytes(4), None) for p in (1, 2, 3)] + [("c", 0, 0, 0, 0, 0, None, None, "ValueError: no image")]
    pages = spark.createDataFrame(rows, images.PAGES)
    channels = spark.createDataFrame([("a", 2), ("b", 2), ("c", 2)], "path string, n_channels int")
    got = sorted((r.path, r.error, r.data is None) for r in images.stack_planes(pages, channels).collect())
    assert [g[0] for g in got] == ["a"] * 4 + ["b", "c"] and all(g[1] is None and not g[2] for g in got[:4])
    assert "3 pages" in got[4][1] and got[4][2] and got[5][1:] == ("ValueError: no image", True)


def test_files_of_archives(spark, tmp_path):
    stack = images.write_tiff([np.full((2, 3), 0.5)] * 2, 16)
    packed = list(images.zipped_files([("a.tif", stack), ("a.tif", stack), ("b.png", images.write_png(np.zeros((2, 3, 3)))), ("c.tif", b"nothing")]))
    assert len(packed) == 1
    put(tmp_path / "part.txt", packed[0] + b"\n")  # as Spark's text writer leaves it
    put(tmp_path / "broken.zip", packed[0][:40])
    put(tmp_path / "alone.tif", stack)
    found = {r.path.removeprefix(f"file:{tmp_path}/"): r.content for r in images.image_files(spark, str(tmp_path)).collect()}
    assert set(found) == {"part.txt/0-a.tif", "part.txt/1-a.tif", "part.txt/2-b.png", "part.txt/3-c.tif", "broken.zip", "alone.tif"} and found["part.txt/1-a.tif"] == stack
    pages = {(r.path.removeprefix(f"file:{tmp_path}/"), r.page): r.error for r in images.read_pages(spark, str(tmp_path)).collect()}
    assert {k for k, error in pages.items() if error is None} == {(f, p) for f in ("part.txt/0-a.tif", "part.txt/1-a.tif", "alone.tif") for p in (1, 2)} | {("part.txt/2-b.png", 1)}
    assert {k for k, error in pages.items() if error} == {("part.txt/3-c.tif", 0), ("broken.zip", 0)}


def test_a_file_of_an_archive_that_is_damaged_is_empty():
    b = bytearray(images.zipped([("a", b"first"), ("b", b"second")]))
    b[b.index(b"first")] ^= 1
    assert list(images.members("z", bytes(b))) == [("z/a", b""), ("z/b", b"second")]


def test_manifest_of_files_in_archives(spark, tmp_path):
    from tessella.plans import runs

    put(tmp_path / "tiles.zip", images.zipped([("a.png", b"A"), ("in/b.png", b"B"), ("c.png", b"C")]))
    put(tmp_path / "d.png", b"D")
    manifest = spark.createDataFrame([(1, "tiles.zip/a.png"), (2, "tiles.zip/lost.png"), (3, "d.png"), (4, "tiles.zip/c.png")], "image_id int, source_file string")
    for rows, base, want in ((manifest, f"{tmp_path}", {1: b"A", 2: None, 3: b"D", 4: b"C"}), (manifest.where("image_id <> 3"), f"file://{tmp_path}", {1: b"A", 2: None, 4: b"C"})):
        assert {r.image_id: r.content for r in runs.files_of(spark, rows, base).collect()} == want


def test_sources_write_few_files(spark, tmp_path):
    """A file of its own for each embedding took seconds by the number of embeddings; ids may be missing or occur twice."""
    from tessella.plans import source_queries as sq

    n = len(list(spark.read.format("binaryFile").load(sq.files(spark, "/root/testdata/sf0.001", lambda p, i: images.write_png(p), "few")).select("path").collect()))
    assert 0 < n <= spark.sparkContext.defaultParallelism
    plane = [0.25] * 64
    spark.createDataFrame([(7, plane), (7, plane), (None, plane)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    for query, rows in (("source_tiff_stack", 64), ("source_channel_planes", 32), ("source_external_mask", 64)):
        got = [r.image_id for r in getattr(sq, query)(spark, str(tmp_path)).collect()]
        assert (got.count(7), got.count(None)) == (2 * rows, rows)
