import hashlib
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella import benchmark as command
from tessella.functions import kernels
from tessella.operators import benchmark as bm, geometry, provenance, segment
from tessella.plans import runs
from tessella.sources import images as im, scenes

# benchmark


def plain_match(p, t, threshold):
    pairs = []
    for j in range(1, t.max() + 1):
        for i in range(1, p.max() + 1):
            both, either = ((p == i) & (t == j)).sum(), ((p == i) | (t == j)).sum()
            if both and both / either >= threshold:
                pairs.append((-both / either, len(pairs), i, j))
    used_p, used_t, out = set(), set(), []
    for iou, _, i, j in sorted(pairs):
        if i not in used_p and j not in used_t:
            used_p.add(i)
            used_t.add(j)
            out.append(-iou)
    return out


@pytest.mark.parametrize("threshold", [0.05, 0.3, 0.5])
def test_matching_like_plain_loops(threshold):
    rng = np.random.default_rng(5)
    for _ in range(20):
        p, t = (kernels.components(kernels.gaussian(rng.random((24, 24)), 1.0) > 0.5) for _ in range(2))
        assert bm.matched(p, t, threshold).tolist() == pytest.approx(plain_match(p, t, threshold))


def test_label_scores():
    truth = np.zeros((10, 10), int)
    truth[:4, :4], truth[6:, 6:] = 1, 2
    half = np.where(truth == 1, 1, 0)
    assert bm.label_scores(half, truth) == {"n_truth": 2, "n_predicted": 1, "tp": 1, "mean_matched_iou": 1.0, "dice": 32 / 48, "iou": 0.5}
    none = np.zeros((10, 10), int)
    assert bm.label_scores(none, none) == {"n_truth": 0, "n_predicted": 0, "tp": 0, "mean_matched_iou": None, "dice": 0.0, "iou": 0.0}
    with pytest.raises(ValueError):
        bm.label_scores(none, none[:5])


def plain_instances(code):
    values, count = np.unique(code, return_counts=True)
    out, n = np.zeros(code.shape, int), 0
    for v in values:
        if v != values[np.argmax(count)]:
            found = kernels.components(code == v)
            out = np.where(found > 0, found + n, out)
            n += found.max()
    return out


def test_instances_like_a_pass_for_each_colour():
    rng = np.random.default_rng(1)
    for size, colours in ((1, 2), (9, 2), (20, 3), (40, 12)):
        for _ in range(10):
            code = rng.integers(0, colours, (size, size + 3)) * 65537
            assert (segment.decode_instances(code) == plain_instances(code)).all()


def colour_mask(labels):
    """Instances in colours that repeat: 1 and 7 share one, and don't touch."""
    out = np.zeros((*labels.shape, 3))
    for i in range(1, labels.max() + 1):
        out[labels == i] = [(40 + 30 * (i % 6)) / 255, (i % 6 * 20) / 255, 0.2]
    return out


def test_benchmark_command(tmp_path):
    for name in ("img", "mask"):
        (tmp_path / name).mkdir()
    for i in range(4):
        s = scenes.fluorescence_scene(size=128, cells=7, seed=i)
        truth = s["truth"] if i < 3 else np.zeros((128, 128), int)
        (tmp_path / "img" / f"n{i}.tif").write_bytes(im.write_tiff([s["nuclear"]]))
        (tmp_path / "mask" / f"n{i}.png").write_bytes(im.write_png(colour_mask(truth)))
    (tmp_path / "img" / "lonely.tif").write_bytes(im.write_tiff([s["nuclear"]]))
    (tmp_path / "split.txt").write_text("n0.png\nn1.tif\n\nn3.x\n")
    base = [f"--images={tmp_path}/img", f"--masks={tmp_path}/mask"]
    assert command.main([*base, f"--out={tmp_path}/some", f"--split={tmp_path}/split.txt"]) == 0
    assert command.main([*base, f"--out={tmp_path}/all"]) == 1


def test_benchmark_scores(spark, tmp_path):
    rows = []
    for i in range(3):
        s = scenes.fluorescence_scene(size=128, cells=7, seed=i)
        rows.append((f"n{i}", im.write_tiff([s["nuclear"]]), im.write_png(colour_mask(s["truth"]))))
    rows += [("empty", rows[0][1], im.write_png(np.zeros((128, 128, 3)))), ("lost", rows[0][1], None), ("small", rows[0][1], im.write_png(np.zeros((5, 5))))]
    got = {r.image_id: r for r in bm.benchmark(spark.createDataFrame(rows, "image_id string, image binary, mask binary")).collect()}
    for i in range(3):
        assert got[f"n{i}"].tp == got[f"n{i}"].n_truth == got[f"n{i}"].n_predicted > 3 and got[f"n{i}"].f1 == 1.0 and got[f"n{i}"].dice > 0.9
    assert got["empty"].dice == 0 and got["empty"].recall is None and got["empty"].precision == 0 and got["lost"].error and got["small"].error
    m = bm.means(spark.createDataFrame(list(got.values()), bm.benchmark(spark.createDataFrame(rows[:1], "image_id string, image binary, mask binary")).schema)).head()
    assert m.n_images == 4 and m.mean_f1 == 1.0 and m.mean_dice == pytest.approx(sum(got[f"n{i}"].dice for i in range(3)) / 4)


# nearest pair


def test_smallest_gap_however_far(spark):
    rng = np.random.default_rng(2)
    rows = [(1, i, float(x), float(y), float(r)) for i, (x, y, r) in enumerate(zip(rng.uniform(0, 1e5, 300), rng.uniform(0, 1e5, 300), rng.uniform(1, 60, 300), strict=True))]
    rows += [(2, 0, 5.0, 5.0, 1.0), (2, 1, 9e6, 4e6, 2.0), (3, 0, 1.0, 1.0, 1.0), (4, 0, 7.0, 7.0, 2.0), (4, 1, 7.0, 7.0, 3.0), (5, 0, 0.0, 0.0, 900.0), (5, 1, 1000.0, 0.0, 1.0), (5, 2, 1002.0, 0.0, 0.1)]
    got = {r.image_id: r for r in geometry.smallest_gap(spark.createDataFrame(rows, "image_id int, nucleus_id int, cx double, cy double, radius double")).collect()}
    for image in (1, 2, 4, 5):
        mine = [r for r in rows if r[0] == image]
        want = min(np.hypot(a[2] - b[2], a[3] - b[3]) - a[4] - b[4] for i, a in enumerate(mine) for b in mine[:i])
        assert got[image].smallest_gap == pytest.approx(want) and got[image].n_nuclei == len(mine)
    assert got[3].smallest_gap is None and got[3].n_nuclei == 1


def plain_gap(mine):
    """The smallest gap of all pairs of (x, y, radius) by SQL's rules: nulls don't count, NaN is the greatest."""
    known, gaps = [m for m in mine if None not in m], []
    with np.errstate(all="ignore"):
        for i, a in enumerate(known):
            gaps += [float(np.sqrt((np.float64(a[0]) - b[0]) ** 2 + (np.float64(a[1]) - b[1]) ** 2) - a[2] - b[2]) for b in known[:i]]
    return min(gaps, key=lambda g: (np.isnan(g), g), default=None)


def test_smallest_gap_of_odd_nuclei(spark):
    nan, inf = float("nan"), float("inf")
    images = [
        [(0.0, 0.0, 1.0), (None, 5.0, 1.0), (10.0, 10.0, 1.0)],
        [(0.0, 0.0, 1.0), (5.0, 5.0, None), (10.0, 10.0, 1.0)],
        [(0.0, 0.0, 1.0), (5.0, None, 2.0), (6.0, 6.0, nan), (nan, 4.0, 1.0), (10.0, 10.0, 1.0)],
        [(0.0, 0.0, 1.0), (nan, 5.0, 1.0)],
        [(0.0, 0.0, 1.0), (None, 5.0, 1.0)],
        [(nan, nan, nan), (None, None, None)],
        [(0.0, 0.0, 1.0), (inf, 3.0, 1.0), (4.0, -inf, 1.0)],
        [(0.0, 0.0, 1.0), (inf, 3.0, 1.0), (30.0, 40.0, 1.0), (5.0, 5.0, inf)],
        [(7.0, 7.0, float(r)) for r in range(40)] + [(7.0, 8.0, 0.5), (60.0, 7.0, 0.0)],
        [(float(x), float(y), 0.0) for x in range(12) for y in range(12)],
        [(0.0, 0.0, 5.0), (0.0, -0.0, 7.0), (-0.0, 0.0, 6.0), (3.0, 0.0, 0.0)],
        [(1e9 + 0.25 * i * i, -1e9 - i, 0.01) for i in range(30)],
        [(float(3 * (i % 20)), float(3 * (i // 20)), 500.0 if i == 7 else 0.5 + i % 5 / 10) for i in range(400)],
        [(float(3 * (i % 20)), float(3 * (i // 20)), 500.0 if i in (7, 301) else 0.5 + i % 5 / 10) for i in range(400)],
        [(float(3 * (i % 20)), float(3 * (i // 20)), 0.5 + i % 5 / 10) for i in range(400)] + [(900.0, 900.0, 500.0)],
    ]
    rng = np.random.default_rng(5)
    for n in range(2, 120):
        span, most = (float(rng.choice(v)) for v in ([1, 30, 1000], [0.1, 3, 40]))
        xyr = np.column_stack([rng.uniform(-span, span, (n, 2)), rng.exponential(most, n)])
        images.append([tuple(map(float, row)) for row in (np.round(xyr) if n % 3 == 0 else xyr)])
    rows = [(i, j, *n) for i, image in enumerate(images) for j, n in enumerate(image)] + [(None, 0, 0.0, 0.0, 1.0), (None, 1, 9.0, 0.0, 1.0)]
    nuclei = spark.createDataFrame(rows, "image_id int, nucleus_id int, cx double, cy double, radius double")
    got = {r.image_id: r for r in geometry.smallest_gap(nuclei, 3).collect()}
    assert len(got) == len(images) + 1 and got[None].n_nuclei == 2 and got[None].smallest_gap is None
    for i, image in enumerate(images):
        want = plain_gap(image)
        assert got[i].n_nuclei == len(image) and (got[i].smallest_gap is None if want is None else got[i].smallest_gap == pytest.approx(want, nan_ok=True)), i


# formats


def lzw(data):
    """A plain encoder: codes grow one early, the table is cleared when full."""
    out, held, bits = bytearray(), 0, 0

    def put(code, width):
        nonlocal held, bits
        held, bits = (held << width) | code, bits + width
        while bits >= 8:
            bits -= 8
            out.append(held >> bits & 255)

    table, width, text = {bytes([i]): i for i in range(256)}, 9, b""
    put(256, 9)
    size = 258
    for c in data:
        c = bytes([c])
        if text + c in table:
            text += c
            continue
        put(table[text], width)
        table[text + c] = size
        size += 1
        width = 12 if size > 2047 else 11 if size > 1023 else 10 if size > 511 else 9
        if size > 4093:
            put(256, width)
            table, size, width = {bytes([i]): i for i in range(256)}, 258, 9
        text = c
    if text:
        put(table[text], width)
        size += 1
        width = 12 if size > 2047 else 11 if size > 1023 else 10 if size > 511 else 9
    put(257, width)
    put(0, 7)
    return bytes(out)


@pytest.mark.parametrize("data", [b"", b"a", b"aaaaaaaaaaaa", bytes(range(256)) * 40, np.random.default_rng(1).integers(0, 256, 30000).astype(np.uint8).tobytes(), np.random.default_rng(2).integers(0, 3, 60000).astype(np.uint8).tobytes()])
def test_lzw_round_trip(data):
    assert im.unpack_lzw(lzw(data)) == data


def test_lzw_tiff_with_predictor():
    plane = np.round(np.linspace(0, 1, 40 * 30).reshape(30, 40) * 65535).astype("<u2")
    body = lzw(np.diff(plane.astype(np.int64), axis=1, prepend=0).astype("<u2").tobytes())
    fields = [(256, 4, 1, 40), (257, 4, 1, 30), (258, 3, 1, 16), (259, 3, 1, 5), (273, 4, 1, 8), (277, 3, 1, 1), (278, 4, 1, 30), (279, 4, 1, len(body)), (317, 3, 1, 2), (339, 3, 1, 1)]
    file = b"II*\0" + struct.pack("<I", 8 + len(body)) + body + struct.pack("<H", len(fields)) + b"".join(struct.pack("<HHII", *f) for f in fields) + b"\0\0\0\0"
    assert np.allclose(im.tiff_page(file, im.tiff_directories(file)[0])[..., 0] * 65535, plane)


def test_description_outside_the_tags():
    planes = [np.full((4, 5), v / 10) for v in (1, 2, 3, 4, 5, 6)]
    plain = im.write_tiff(planes)
    told = plain + b"..ImageJ=1.53\nchannels=3\nslices=2\n\0after"
    assert im.scanned_description(told) == "ImageJ=1.53\nchannels=3\nslices=2\n" and im.scanned_description(plain) is None
    assert im.channel_planes(told, 3)[1] == 2
    with pytest.raises(ValueError, match="not 2 channels|channels"):
        im.channel_planes(told, 2)
    assert im.scanned_description(b"x" * im.SCANNED + b"ImageJ=1\0") is None


def test_jpeg_through_the_image_source(spark, tmp_path):
    scene = scenes.stained_scene(positive=6, seed=7)[0]
    jvm = spark._jvm
    out = jvm.java.io.File(str(tmp_path / "a.JPG"))
    read = jvm.javax.imageio.ImageIO.read(jvm.java.io.ByteArrayInputStream(im.write_png(scene)))
    assert jvm.javax.imageio.ImageIO.write(read, "jpg", out)
    (tmp_path / "b.jpeg").write_bytes(b"\xff\xd8 broken")
    m = spark.createDataFrame([("a", "a.JPG"), ("b", "b.jpeg"), ("c", "c.jpg")], "image_id string, source_file string")
    got = {r.image_id: r.content for r in runs.files_of(spark, m, str(tmp_path)).collect()}
    decoded = im.rgb_image(bytes(got["a"]))
    assert decoded.shape == scene.shape and np.abs(decoded - scene).mean() < 0.02 and np.abs(decoded - scene)[..., 0].max() < 0.6
    assert got["b"] is None and got["c"] is None
    with pytest.raises(ValueError, match="pixels"):
        im.rgb_image(bytes(got["a"]), 100)


# provenance


def test_digests_and_comparison(spark, tmp_path):
    (tmp_path / "d" / "sub").mkdir(parents=True)
    files = {"a.txt": b"one\r\ntwo\n\r\n\xff\r", "sub/b.bin": b"\r\n\x00", "sub/c.py": b"", "new.md": b"x"}
    for name, content in files.items():
        (tmp_path / "d" / name).write_bytes(content)
    found = provenance.file_digests(spark, str(tmp_path / "d"))
    got = {r.path: r.digest for r in found.collect()}
    want = {n: hashlib.sha256(c.replace(b"\r\n", b"\n") if not n.endswith("bin") else c).hexdigest() for n, c in files.items()}
    assert {n: d for n, d in got.items() if n != "sub/c.py"} == {n: d for n, d in want.items() if n != "sub/c.py"}
    (tmp_path / "list").write_text(f"{want['a.txt'].upper()}  a.txt\n{'0' * 64} *sub/b.bin\n{'1' * 64}  gone.txt\nnot a line\n")
    status = {r.path: r.status for r in provenance.compare(provenance.listed_digests(spark, str(tmp_path / "list")), found.where(F.col("path") != "sub/c.py")).collect()}
    assert status == {"a.txt": "OK", "sub/b.bin": "CHANGED", "gone.txt": "MISSING", "new.md": "UNLISTED"}
