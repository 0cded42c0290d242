"""Image sources: TIFF pages (also ImageJ stacks) and PNG from ``binaryFile`` rows.

Decoding needs no image library. A file that cannot be read gives a row with its
error. Many small files may lie in ZIP archives; Spark then lists and opens the
archives alone.
"""

from __future__ import annotations

import io
import re
import struct
import zipfile
import zlib
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of each TIFF field type (fixed values).
TYPE_BYTES = {1: 1, 2: 1, 3: 2, 4: 4, 5: 8, 6: 1, 7: 1, 8: 2, 9: 4, 10: 8, 11: 4, 12: 8}
#: TIFF tags that are read (fixed values).
TAGS = {256: "width", 257: "height", 258: "bits", 259: "compression", 262: "photometric", 270: "description", 273: "offsets", 277: "samples", 278: "rows_per_strip", 279: "counts", 317: "predictor", 339: "sample_format"}
MOST_PAGES = 10_000
PAGES = "path string, page int, h int, w int, bits int, samples int, description string, data binary, error string"
#: The first bytes of a ZIP archive (fixed value).
ZIP_MARK = b"PK\3\4"
#: Files of an archive that ``zipped_files`` makes, and rows that a task passes on together.
FRAME_ROWS = 1000
#: Bytes of either, if no single one has more.
FRAME_BYTES = 1 << 20


def in_frames(rows: Iterable[tuple], names: Sequence[str], heavy: str) -> Iterator[pd.DataFrame]:
    """Frames of ``FRAME_ROWS`` rows at most that end where column ``heavy`` reaches ``FRAME_BYTES``."""
    held, size, at = [], 0, names.index(heavy)
    for row in rows:
        held.append(row)
        size += len(row[at] or b"")
        if size >= FRAME_BYTES or len(held) >= FRAME_ROWS:
            yield pd.DataFrame(held, columns=names)
            held, size = [], 0
    if held:
        yield pd.DataFrame(held, columns=names)


def zipped(files: Iterable[tuple[str, bytes]]) -> bytes:
    """A ZIP archive of (name, content), stored as they are."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        for name, content in files:
            archive.writestr(zipfile.ZipInfo(name), content)
    return out.getvalue()


def zipped_files(files: Iterable[tuple[str, bytes]]) -> Iterator[bytes]:
    """Archives of the files in their order; a number before a name keeps equal names apart."""
    for frame in in_frames(files, ["name", "content"], "content"):
        yield zipped((f"{n}-{name}", content) for n, (name, content) in enumerate(frame.itertuples(index=False)))


def members(path: str, content: bytes) -> Iterator[tuple[str, bytes]]:
    """A file, or the files in a ZIP archive, whose paths begin with the archive's.

    A broken archive comes as a file; one of its files that can't be read is empty.
    """
    if content[:4] == ZIP_MARK:
        try:
            archive = zipfile.ZipFile(io.BytesIO(content))
        except zipfile.BadZipFile:
            yield path, content
            return
        for info in archive.infolist():
            if not info.is_dir():
                try:
                    body = archive.read(info)
                except Exception:  # one bad file must not end the run
                    body = b""
                yield f"{path}/{info.filename}", body
    else:
        yield path, content


def image_files(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """(path, content) of files, and of the files in ZIP archives."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = (m for f in frames for path, content in zip(f["path"], f["content"], strict=True) for m in members(path, content))
        return in_frames(found, ["path", "content"], "content")

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(run, "path string, content binary")


def tiff_directories(b: bytes) -> list[dict]:
    """The image directories of a classic TIFF file, in order."""
    if b[:4] not in (b"II*\0", b"MM\0*"):
        raise ValueError("not a TIFF file")
    end = "<" if b[:2] == b"II" else ">"
    at, out, seen = struct.unpack_from(end + "I", b, 4)[0], [], set()
    while at and len(out) < MOST_PAGES:
        if at in seen or at + 2 > len(b):
            raise ValueError("broken chain of directories")
        seen.add(at)
        n = struct.unpack_from(end + "H", b, at)[0]
        page = {"order": end}
        for i in range(n):
            tag, kind, count = struct.unpack_from(end + "HHI", b, at + 2 + 12 * i)
            if tag not in TAGS or kind not in TYPE_BYTES:
                continue
            size = TYPE_BYTES[kind] * count
            place = at + 10 + 12 * i if size <= 4 else struct.unpack_from(end + "I", b, at + 10 + 12 * i)[0]
            raw = b[place : place + size]
            if kind == 2:
                page[TAGS[tag]] = raw.rstrip(b"\0").decode("latin-1")
            elif kind in (1, 3, 4):
                page[TAGS[tag]] = list(struct.unpack(end + {1: "B", 3: "H", 4: "I"}[kind] * count, raw))
        out.append(page)
        at = struct.unpack_from(end + "I", b, at + 2 + 12 * n)[0]
    return out


def unpack_bits(b: bytes) -> bytes:
    out, i = bytearray(), 0
    while i < len(b):
        n = b[i]
        if n < 128:
            out += b[i + 1 : i + 2 + n]
            i += n + 2
        elif n > 128:
            out += b[i + 1 : i + 2] * (257 - n)
            i += 2
        else:
            i += 1
    return bytes(out)


def unpack_lzw(b: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, high bits first; 256 clears the table, 257 ends. The width grows one code early."""
    out, at, held, bits = bytearray(), 0, 0, 0
    single = [bytes([i]) for i in range(256)] + [b"", b""]
    table, width, last = list(single), 9, b""
    while True:
        while bits < width:
            if at >= len(b):
                return bytes(out)  # no end code
            held, at, bits = (held << 8) | b[at], at + 1, bits + 8
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == 257:
            return bytes(out)
        if code == 256:
            table, width, last = list(single), 9, b""
            continue
        if code < len(table):
            entry = table[code]
        elif code == len(table) and last:
            entry = last + last[:1]
        else:
            raise ValueError("broken LZW data")
        if last:
            table.append(last + entry[:1])
        out += entry
        last = entry
        width = 12 if len(table) >= 2047 else 11 if len(table) >= 1023 else 10 if len(table) >= 511 else 9


def tiff_page(b: bytes, page: dict) -> np.ndarray:
    """Samples [row, column, sample] of 0 to 1 for whole numbers, as they are for floats."""
    one = lambda k, d: page.get(k, [d])[0]
    h, w, n, bits, form, how = one("height", 0), one("width", 0), one("samples", 1), one("bits", 1), one("sample_format", 1), one("compression", 1)
    if (bits, form) not in ((8, 1), (16, 1), (32, 1), (32, 3), (64, 3)):
        raise ValueError(f"samples of {bits} bits, format {form} are not read")
    strips = [b[o : o + c] for o, c in zip(page["offsets"], page["counts"], strict=True)]
    if how == 32773:
        strips = [unpack_bits(s) for s in strips]
    elif how == 5:
        strips = [unpack_lzw(s) for s in strips]
    elif how in (8, 32946):
        strips = [zlib.decompress(s) for s in strips]
    elif how != 1:
        raise ValueError(f"TIFF compression {how} is not read")
    kind = np.dtype(f"{page['order']}{'f' if form == 3 else 'u'}{bits // 8}")
    data = np.frombuffer(b"".join(strips), dtype=kind, count=h * w * n).reshape(h, w, n)
    if one("predictor", 1) == 2:
        data = np.cumsum(data.astype(np.uint64), axis=1) % (1 << bits)
    return data.astype(float) / ((1 << bits) - 1) if form == 1 else data.astype(float)


def imagej_description(text: str | None) -> dict[str, str]:
    """The key=value lines of an ImageJ description."""
    if not text or not text.startswith("ImageJ="):
        return {}
    return dict(line.split("=", 1) for line in text.splitlines() if "=" in line)


#: Bytes at the start of a file in which an ImageJ description is looked for.
SCANNED = 1 << 20


def scanned_description(content: bytes) -> str | None:
    """The ImageJ description that stands in the first bytes of a file outside its tags, up to a zero byte."""
    at = content.find(b"ImageJ=", 0, SCANNED)
    if at < 0:
        return None
    end = content.find(b"\0", at, SCANNED)
    return content[at : end if end >= 0 else SCANNED].decode("latin-1")


def stack_shape(description: str | None, pages: int, channels: int) -> tuple[int, int]:
    """(channels, planes) of a stack; raises if it disagrees with its pages, the manifest, or has several times."""
    d = imagej_description(description)
    c, z, t = int(d.get("channels", channels)), int(d.get("slices", 0)), int(d.get("frames", 1))
    if t != 1:
        raise ValueError(f"{t} time points: time series are not read")
    z = z or pages // max(c, 1)
    if c != channels or c * z != pages:
        raise ValueError(f"{pages} pages are not {c} channels of {z} planes for a manifest with {channels} channels")
    return c, z


def png_image(b: bytes) -> np.ndarray:
    """Samples [row, column, sample] of 0 to 1; greyscale, RGB and palette, 8 or 16 bits, not interlaced."""
    if b[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG file")
    at, data, palette = 8, [], None
    while at + 12 <= len(b):
        size, kind = struct.unpack_from(">I4s", b, at)
        body = b[at + 8 : at + 8 + size]
        if kind == b"IEND":
            break  # what follows isn't the image's
        if kind == b"IHDR":
            w, h, bits, colour, _, _, interlace = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            palette = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            data.append(body)
        at += size + 12
    if bits not in (8, 16) or interlace or colour not in (0, 2, 3, 4, 6):
        raise ValueError("this kind of PNG is not read")
    n = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    step = n * bits // 8
    rows = np.frombuffer(zlib.decompress(b"".join(data)), np.uint8).reshape(h, w * step + 1)
    out, above = np.zeros((h, w * step), np.uint8), np.zeros(w * step, np.int64)
    for y in range(h):
        how, line = rows[y, 0], rows[y, 1:].astype(np.int64)
        if how == 1:
            line = np.cumsum(line.reshape(w, step), axis=0).ravel()
        elif how == 2:
            line = line + above
        elif how in (3, 4):
            for i in range(len(line)):
                left, up, corner = (line[i - step] if i >= step else 0), above[i], (above[i - step] if i >= step else 0)
                if how == 3:
                    guess = (left + up) // 2
                else:
                    p = left + up - corner
                    guess = min((left, up, corner), key=lambda v: abs(p - v))
                line[i] = (line[i] + guess) & 255
        above = line & 255
        out[y] = above
    if bits == 16:
        return out.view(">u2").reshape(h, w, n).astype(float) / 65535
    return palette[out.reshape(h, w)].astype(float) / 255 if colour == 3 else out.reshape(h, w, n).astype(float) / 255


#: Marks the content that ``jpeg_content`` makes (fixed value).
RAW_MARK = b"BGR8"


def jpeg_content(image: str = "image") -> Column:
    """Bytes of a row of Spark's ``image`` source: a mark, height, width and samples (big-endian), then its samples; null if it couldn't be read."""
    sizes = [F.unhex(F.lpad(F.hex(f"{image}.{c}"), 8, "0")) for c in ("height", "width", "nChannels")]
    return F.when(F.col(f"{image}.height") > 0, F.concat(F.lit(RAW_MARK), *sizes, F.col(f"{image}.data")))


def first_image(content: bytes, most_pixels: float = 80_000_000) -> np.ndarray:
    """Samples [row, column, sample] of 0 to 1 of a file's first image. The size is checked before pixels are read."""
    if content[:4] == RAW_MARK:
        h, w, n = struct.unpack(">III", content[4:16])
        read = lambda: np.frombuffer(content, np.uint8, offset=16).reshape(h, w, n)[..., ::-1].astype(float) / 255
    elif content[:4] == b"\x89PNG":
        w, h = struct.unpack(">II", content[16:24])
        read = lambda: png_image(content)
    else:
        page = tiff_directories(content)[0]
        w, h = page.get("width", [0])[0], page.get("height", [0])[0]
        read = lambda: tiff_page(content, page)
    if w * h > most_pixels:
        raise ValueError(f"the image has {w * h} pixels, over {most_pixels:.0f}")
    return read()


def rgb_image(content: bytes, most_pixels: float = 80_000_000) -> np.ndarray:
    """Red, green and blue of a file's first image; a grey one has them alike."""
    a = first_image(content, most_pixels)
    return np.repeat(a[..., :1], 3, axis=2) if a.shape[2] < 3 else a[..., :3]


def projected(planes: np.ndarray, mode: str) -> np.ndarray:
    """One plane of several [z, row, column]: max, mean, sum or the middle one."""
    how = mode.split("_")[0]
    if how == "middle":
        return planes[(len(planes) + 1) // 2 - 1]
    return {"max": planes.max, "mean": planes.mean, "sum": planes.sum}[how](axis=0)


def channel_planes(content: bytes, channels: int, z_mode: str = "max", most_pixels: float = 80_000_000) -> tuple[np.ndarray, int]:
    """The channels [channel, row, column] of a file, z planes projected, and the number of z planes.

    A single page holds the channels as samples; a stack runs through the channels
    first, as its ImageJ description (if it has one) and the manifest must agree on.
    """
    if content[:4] == b"\x89PNG":
        w, h = struct.unpack(">II", content[16:24])
        pages = [{"width": [w], "height": [h]}]
        read = lambda _: png_image(content)
    else:
        pages = tiff_directories(content)
        read = lambda d: tiff_page(content, d)
    sizes = {(d.get("height", [0])[0], d.get("width", [0])[0]) for d in pages}
    if len(sizes) != 1:
        raise ValueError(f"pages of {len(sizes)} sizes")
    ((h, w),) = sizes
    if h * w > most_pixels:
        raise ValueError(f"the image has {h * w} pixels, over {most_pixels:.0f}")
    if len(pages) == 1:
        a = read(pages[0])
        if a.shape[2] < channels:
            raise ValueError(f"{a.shape[2]} samples for {channels} channels")
        return np.moveaxis(a[..., :channels], 2, 0), 1
    told = pages[0].get("description")
    c, z = stack_shape(told if imagej_description(told) else scanned_description(content) or told, len(pages), channels)
    out = []
    for i in range(c):  # one channel's planes at a time
        out.append(projected(np.stack([read(pages[j * c + i])[..., 0] for j in range(z)]), z_mode))
    return np.stack(out), z


def pages_of(path: str, content: bytes, most_pixels: int) -> Iterator[tuple]:
    """Rows of ``PAGES`` of one file."""
    try:
        if content[:4] == b"\x89PNG":
            size = struct.unpack(">II", content[16:24])
            pages = [({"width": [size[0]], "height": [size[1]]}, lambda: png_image(content))]
        else:
            pages = [(d, lambda d=d: tiff_page(content, d)) for d in tiff_directories(content)]
        for i, (d, read) in enumerate(pages):
            if d.get("height", [0])[0] * d.get("width", [0])[0] > most_pixels:
                raise ValueError("the image has too many pixels")
            a = read()
            yield path, i + 1, a.shape[0], a.shape[1], d.get("bits", [8])[0], a.shape[2], d.get("description"), a.astype("<f4").tobytes(), None
    except Exception as e:  # one bad file must not end the run
        yield path, 0, 0, 0, 0, 0, None, None, f"{type(e).__name__}: {e}"


def read_pages(spark: SparkSession, paths: list[str] | str, most_pixels: int = 80_000_000) -> DataFrame:
    """A row for each page of each file, also of those in ZIP archives: size, description, float32 data (row by row, samples last), or an error."""
    names = [c.split()[0] for c in PAGES.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = (m for f in frames for path, content in zip(f["path"], f["content"], strict=True) for m in members(path, content))
        return in_frames((page for m in found for page in pages_of(*m, most_pixels)), names, "data")

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(run, PAGES)


def split_samples(pages: DataFrame) -> DataFrame:
    """Planes r, g, b of pages with three samples or more."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for r in frame.itertuples(index=False):
                a = np.frombuffer(r.data, "<f4").reshape(r.h, r.w, r.samples)
                yield pd.DataFrame([{"path": r.path, "h": r.h, "w": r.w, **{c: np.ascontiguousarray(a[..., i]).tobytes() for i, c in enumerate("rgb")}}])

    return pages.where("error is null and samples >= 3").mapInPandas(run, "path string, h int, w int, r binary, g binary, b binary")


def stack_planes(pages: DataFrame, channels: DataFrame) -> DataFrame:
    """(path, channel_index, z, h, w, data, error) of stacks; ``channels``: path, n_channels of the manifest.

    A stack whose pages don't divide by its channels gives one row with an error
    and without data, and so does a file with pages that couldn't be read.
    """
    from tessella.operators.pixels import page_to_plane

    counted = pages.groupBy("path").agg(F.count(F.when(F.col("error").isNull(), 1)).alias("n_pages"), F.max("error").alias("failed")).join(channels, "path")
    apart = F.concat(F.col("n_pages").cast("string"), F.lit(" pages don't divide by "), F.coalesce(F.col("n_channels").cast("string"), F.lit("no")), F.lit(" channels"))
    counted = counted.withColumn("stack_error", F.coalesce("failed", F.when(F.coalesce(F.col("n_pages") % F.nullif("n_channels", F.lit(0)) != 0, F.lit(True)), apart)))
    whole = pages.join(counted.where("stack_error is null"), "path").select("path", *page_to_plane("page", "n_channels"), "h", "w", "data", F.lit(None).cast("string").alias("error"))
    broken = counted.where("stack_error is not null").select("path", F.col("stack_error").alias("error"))
    return whole.unionByName(broken, allowMissingColumns=True)


def write_tiff(planes: list[np.ndarray], bits: int = 16, description: str = "", deflate: bool = False) -> bytes:
    """A little-endian TIFF file of greyscale pages (values of 0 to 1)."""
    out, link = bytearray(b"II*\0\0\0\0\0"), 4
    for i, p in enumerate(planes):
        data = np.round(np.clip(p, 0, 1) * ((1 << bits) - 1)).astype(f"<u{bits // 8}").tobytes()
        data = zlib.compress(data) if deflate else data
        place = len(out)
        out += data
        text = (description.encode("latin-1") + b"\0") if description and i == 0 else b""
        where = len(out)
        out += text + b"\0" * (len(out + text) % 2)
        fields = [(256, 4, 1, p.shape[1]), (257, 4, 1, p.shape[0]), (258, 3, 1, bits), (259, 3, 1, 8 if deflate else 1), (262, 3, 1, 1)]
        if text:
            fields.append((270, 2, len(text), where if len(text) > 4 else int.from_bytes(text.ljust(4, b"\0"), "little")))
        fields += [(273, 4, 1, place), (277, 3, 1, 1), (278, 4, 1, p.shape[0]), (279, 4, 1, len(data)), (339, 3, 1, 1)]
        struct.pack_into("<I", out, link, len(out))
        out += struct.pack("<H", len(fields)) + b"".join(struct.pack("<HHII", *f) for f in fields)
        link = len(out)
        out += b"\0\0\0\0"
    return bytes(out)


def write_png(image: np.ndarray) -> bytes:
    """An 8-bit PNG of [row, column] or [row, column, 3] values of 0 to 1."""
    a = np.round(np.clip(image, 0, 1) * 255).astype(np.uint8)
    a = a[..., None] if a.ndim == 2 else a
    rows = b"".join(b"\0" + r.tobytes() for r in a)

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    head = struct.pack(">IIBBBBB", a.shape[1], a.shape[0], 8, 2 if a.shape[2] == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def is_slide(path: str) -> bool:
    from tessella.operators.validation import SLIDE_PATTERN

    return re.search(SLIDE_PATTERN.removeprefix("(?i)"), path, re.I) is not None
