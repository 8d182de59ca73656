"""PNG files to pixel rows.

Spark lists and reads the files; the decoder is a small per-file helper for 8-bit images
without interlacing, which restores images of one shape together and emits runs of one colour.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

SIGNATURE = b"\x89PNG\r\n\x1a\n"
CHANNELS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
RUN_SCHEMA = "path string, row int, first int, last int, b smallint, g smallint, r smallint"
RUN_FIELDS = [field.split()[0] for field in RUN_SCHEMA.split(", ")]
UNREADABLE = (zlib.error, struct.error, ValueError, IndexError)
TOGETHER = 1 << 20  # pixels of the images restored together; one larger image is restored alone
BATCH = 1 << 16  # runs handed over at a time, and pixels they are sought in


def _chunks(data: bytes) -> Iterator[tuple[bytes, bytes]]:
    at = len(SIGNATURE)
    while at + 8 <= len(data):
        size, kind = struct.unpack(">I4s", data[at:at + 8])
        yield kind, data[at + 8:at + 8 + size]
        at += 12 + size


def _by_lines(kinds: np.ndarray, body: np.ndarray) -> np.ndarray:
    """Undo filters 0 (none), 1 (left) and 2 (above), a line at a time."""
    lines, above = np.empty(body.shape, np.uint8), np.zeros(body.shape[1:], np.uint8)
    for y, kind in enumerate(kinds.tolist()):
        above = lines[y] = body[y] if kind == 0 else body[y] + above if kind == 2 else np.cumsum(body[y], axis=0, dtype=np.uint8)
    return lines


def _all_by_diagonals(kinds: np.ndarray, bodies: np.ndarray) -> np.ndarray:
    """Undo any filters of images of one shape (kinds: image, line; bodies: image, line, column, sample), all at once.

    They go along anti-diagonals: a pixel needs those left, above and between, which lie on the two
    diagonals before. These are held by line, with a line of zeros above; what they do not reach is still zero.
    """
    count, height, width, step = bodies.shape
    given = np.ascontiguousarray(bodies.transpose(1, 2, 0, 3)).reshape(height * width, count * step)
    done = np.empty_like(given)
    by_left, by_above, by_both, by_nearest = (np.repeat(-(kinds.T == k).astype(np.int16), step, axis=1) for k in (1, 2, 3, 4))
    now, last, before = np.zeros((3, height + 1, count * step), np.int16)
    for d in range(height + width - 1):
        top, bottom = max(0, d - width + 1), min(height, d + 1)
        rows, places = slice(top, bottom), slice(top * width + d - top, (bottom - 1) * width + d - bottom + 2, max(1, width - 1))
        left, above, corner = last[top + 1 : bottom + 1], last[rows], before[rows]
        over, aside = above - corner, left - corner
        near_left, near_above, near_corner = np.abs(over), np.abs(aside), np.abs(over + aside)
        nearest = np.where(near_left <= np.minimum(near_above, near_corner), left, np.where(near_above <= near_corner, above, corner))
        guess = (by_left[rows] & left) | (by_above[rows] & above) | (by_both[rows] & ((left + above) >> 1)) | (by_nearest[rows] & nearest)
        guess += given[places]
        guess &= 255
        now[top + 1 : bottom + 1] = done[places] = guess
        now, last, before = before, now, last
    return done.reshape(height, width, count, step).transpose(2, 0, 1, 3)


def _by_diagonals(kinds: np.ndarray, body: np.ndarray) -> np.ndarray:
    return _all_by_diagonals(kinds[None], body[None])[0]


def _unpack(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Line filters, filtered samples and palette of a file."""
    if not data.startswith(SIGNATURE):
        raise ValueError("no PNG signature")
    header, palette, body = None, None, []
    for kind, content in _chunks(data):
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", content)
        elif kind == b"PLTE":
            palette = np.frombuffer(content, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            body.append(content)
    if header is None:
        raise ValueError("no header")
    width, height, depth, colour, _, _, interlace = header
    if depth != 8:
        raise ValueError(f"{depth} bits per sample")
    if interlace:
        raise ValueError("interlaced")
    if colour not in CHANNELS:
        raise ValueError(f"colour type {colour}")
    step = CHANNELS[colour]
    raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8).reshape(height, width * step + 1)
    kinds, lines = raw[:, 0], raw[:, 1:].reshape(height, width, step)
    if (kinds > 4).any():
        raise ValueError("unknown line filter")
    if colour == 3 and palette is None:
        raise ValueError("no palette")
    return kinds, lines, palette if colour == 3 else None


def _painted(samples: np.ndarray, palette: np.ndarray | None) -> np.ndarray:
    """Blue, green, red of restored samples."""
    if palette is not None:
        samples = palette[samples[:, :, 0]]
    elif samples.shape[2] < 3:
        samples = np.repeat(samples[:, :, :1], 3, axis=2)
    return np.ascontiguousarray(samples[:, :, 2::-1])


def _decode(data: bytes) -> np.ndarray:
    kinds, lines, palette = _unpack(data)
    return _painted(_by_diagonals(kinds, lines) if (kinds > 2).any() else _by_lines(kinds, lines), palette)


def read_png(data: bytes) -> tuple[np.ndarray | None, str | None]:
    """Pixels (height × width × 3 in blue, green, red order; transparency is dropped), or why there are none."""
    try:
        return _decode(data), None
    except UNREADABLE as error:
        return None, f"image unreadable: {error}"


def decode_png(data: bytes) -> np.ndarray | None:
    return read_png(data)[0]


def _restored(files: list[tuple]) -> Iterator[tuple[str, np.ndarray, np.ndarray | None]]:
    """(path, samples, palette) of unpacked files; those of one shape whose filters need it are restored together."""
    alike: dict[tuple, list[tuple]] = {}
    for path, kinds, lines, palette in files:
        if (kinds > 2).any():
            alike.setdefault(lines.shape, []).append((path, kinds, lines, palette))
        else:
            yield path, _by_lines(kinds, lines), palette
    for group in alike.values():
        paths, kinds, lines, palettes = zip(*group)
        yield from zip(paths, _all_by_diagonals(np.stack(kinds), np.stack(lines)), palettes)


def decode_many(files: Iterable[tuple[str, bytes]], pixels: int = TOGETHER) -> Iterator[tuple[str, np.ndarray]]:
    """(path, pixels) of the readable files, unpacked until they have `pixels` pixels and then restored together."""
    def done(held: list[tuple]) -> Iterator[tuple[str, np.ndarray]]:
        for path, samples, palette in _restored(held):
            try:
                yield path, _painted(samples, palette)
            except UNREADABLE:  # a colour beyond the palette
                continue

    held, size = [], 0
    for path, content in files:
        try:
            unpacked = _unpack(content)
        except UNREADABLE:
            continue
        held.append((path, *unpacked))
        size += unpacked[1].shape[0] * unpacked[1].shape[1]
        if size >= pixels:
            yield from done(held)
            held, size = [], 0
    yield from done(held)


def _runs(pixels: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, first, last, b, g, r) of the runs of one colour, a band of lines at a time."""
    height, width, _ = pixels.shape
    for top in range(0, height if width else 0, rows := max(1, BATCH // max(1, width))):
        band = pixels[top : top + rows].astype(np.int32)
        paint = (band[:, :, 0] | band[:, :, 1] << 8 | band[:, :, 2] << 16).ravel()
        fresh = np.ones(len(paint), bool)
        np.not_equal(paint[1:], paint[:-1], out=fresh[1:])
        fresh[::width] = True
        starts = np.flatnonzero(fresh)
        row, first = np.divmod(starts, width)
        paint = paint[starts]
        last = first + np.diff(starts, append=len(fresh)) - 1
        yield (*((x.astype(np.int32)) for x in (row + top, first, last)), *((paint >> k & 255).astype(np.int16) for k in (0, 8, 16)))


def _run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def files():
        for batch in batches:
            for path, content in zip(*batch.columns):
                yield path.as_py(), content.as_py() or b""

    def table(paths: list[str | None], sizes: list[int], columns: list[tuple]) -> pa.RecordBatch:
        names = pa.array(paths, pa.string()).take(pa.array(np.repeat(np.arange(len(paths)), sizes)))
        return pa.RecordBatch.from_arrays([names, *(pa.array(np.concatenate(c)) for c in zip(*columns))], RUN_FIELDS)

    paths, sizes, columns = [], [], []
    for path, pixels in decode_many(files()):
        for runs in _runs(pixels):
            paths.append(path)
            sizes.append(len(runs[0]))
            columns.append(runs)
            if sum(sizes) >= BATCH:
                yield table(paths, sizes, columns)
                paths, sizes, columns = [], [], []
    if paths:
        yield table(paths, sizes, columns)


def image_runs(files: DataFrame) -> DataFrame:
    """Runs of one colour in the lines of PNG contents (path, content): path, row, first, last, b, g, r."""
    return files.select("path", "content").mapInArrow(_run_batches, RUN_SCHEMA)


def image_pixels(files: DataFrame) -> DataFrame:
    """Pixel rows of PNG contents (path, content); `image_rejects` has the files that give none.

    Python hands over runs, which Spark unfolds: one row at most per pixel leaves a worker.
    """
    return image_runs(files).select("path", "row", F.explode(F.sequence("first", "last")).alias("col"), "b", "g", "r")


def _rejects(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for files in batches:
        reasons = [read_png(bytes(content))[1] for content in files["content"]]
        yield pd.DataFrame({"path": files["path"], "reason": reasons})[[r is not None for r in reasons]]


def image_rejects(files: DataFrame) -> DataFrame:
    """(path, reason) of the contents that cannot be read, for the ledger to log as errors."""
    return files.select("path", "content").mapInPandas(_rejects, "path string, reason string")


def image_files(spark: SparkSession, folder: str, pattern: str = "*.png") -> DataFrame:
    """(path, content) of the files below a folder. A file is one value of one task: 2 GB at most."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)


def read_images(spark: SparkSession, folder: str, pattern: str = "*.png") -> DataFrame:
    return image_pixels(image_files(spark, folder, pattern))
