"""Pictures: header sniffing, folders with caption sidecars, pixel measures and perceptual hashes."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

EXTENSIONS = ("jpg", "jpeg", "png", "webp", "bmp")
#: JPEG markers whose segment holds the frame's size (all start-of-frame kinds).
_FRAME_MARKERS = set(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}


def dimensions(head: bytes | None) -> tuple[int, int] | None:
    """(width, height) from the first bytes of a PNG, GIF, WebP or JPEG file; None if they don't tell."""
    if head is None or len(head) < 16:
        return None
    try:
        if head[:8] == b"\x89PNG\r\n\x1a\n" and head[12:16] == b"IHDR":
            return struct.unpack(">II", head[16:24])
        if head[:6] in (b"GIF87a", b"GIF89a"):
            return struct.unpack("<HH", head[6:10])
        if head[:4] == b"RIFF" and head[8:12] == b"WEBP":
            kind = head[12:16]
            if kind == b"VP8X":
                return 1 + int.from_bytes(head[24:27], "little"), 1 + int.from_bytes(head[27:30], "little")
            if kind == b"VP8L" and head[20] == 0x2F:
                packed = int.from_bytes(head[21:25], "little")
                return 1 + (packed & 0x3FFF), 1 + (packed >> 14 & 0x3FFF)
            if kind == b"VP8 " and head[23:26] == b"\x9d\x01\x2a":
                w, h = struct.unpack("<HH", head[26:30])
                return w & 0x3FFF, h & 0x3FFF
            return None
        if head[:2] == b"\xff\xd8":
            return _jpeg(head)
    except (struct.error, IndexError):
        return None
    return None


def _jpeg(head: bytes) -> tuple[int, int] | None:
    at = 2
    while at + 9 <= len(head):
        if head[at] != 0xFF:
            at += 1
            continue
        marker = head[at + 1]
        if marker == 0xFF:
            at += 1
        elif marker in _FRAME_MARKERS:
            h, w = struct.unpack(">HH", head[at + 5 : at + 9])
            return w, h
        elif marker == 0x01 or 0xD0 <= marker <= 0xD9:
            at += 2
        else:
            at += 2 + struct.unpack(">H", head[at + 2 : at + 4])[0]
    return None


#: The tag that holds a picture's orientation, and how each of its values lies: (turned a quarter, mirrored, upside down).
ORIENTATION_TAG = 0x0112
ORIENTATIONS = {1: (False, False, False), 2: (False, True, False), 3: (False, True, True), 4: (False, False, True), 5: (True, False, False), 6: (True, False, True), 7: (True, True, True), 8: (True, True, False)}


def orientation(head: bytes | None) -> int:
    """The orientation, 1 to 8, in a JPEG's metadata; 1 where there is none or it can't be read."""
    if head is None or head[:2] != b"\xff\xd8":
        return 1
    at = 2
    try:
        while head[at] == 0xFF and head[at + 1] not in (0xD9, 0xDA):
            size = struct.unpack(">H", head[at + 2 : at + 4])[0]
            if head[at + 1] == 0xE1 and head[at + 4 : at + 10] == b"Exif\0\0":
                tiff = head[at + 10 : at + 2 + size]
                order = {b"II": "<", b"MM": ">"}[tiff[:2]]
                start = struct.unpack(order + "I", tiff[4:8])[0]
                for k in range(struct.unpack(order + "H", tiff[start : start + 2])[0]):
                    tag, kind, _, value = struct.unpack(order + "HHIH", tiff[start + 2 + 12 * k : start + 12 + 12 * k])
                    if tag == ORIENTATION_TAG and kind == 3 and value in ORIENTATIONS:
                        return value
                return 1
            at += 2 + size
    except (struct.error, IndexError, KeyError):
        return 1
    return 1


def upright(pixels: np.ndarray, how: int) -> np.ndarray:
    """Pixels (rows first) as the orientation means them to be seen."""
    turned, mirrored, upside_down = ORIENTATIONS[how]
    # A quarter turn is an exchange of rows and columns, then the flips that the value names apply to the stored picture.
    out = pixels[::-1] if upside_down else pixels
    out = out[:, ::-1] if mirrored else out
    return out.swapaxes(0, 1) if turned else out


def _upright_batch(heads: pd.Series) -> pd.DataFrame:
    found = []
    for h in heads:
        size = dimensions(bytes(h)) if h is not None else None
        found.append((size[::-1] if ORIENTATIONS[orientation(bytes(h))][0] else size) if size else (None, None))
    return pd.DataFrame({"width": pd.array([f[0] for f in found], "Int32"), "height": pd.array([f[1] for f in found], "Int32")})


def sniff_upright(content: Column, head_bytes: int = 65_536) -> Column:
    """struct(width, height) as the picture is meant to be seen: exchanged where its orientation turns it a quarter."""
    return pandas_udf(_upright_batch, "width int, height int")(F.substring(content, 1, head_bytes))


def _dimensions_batch(heads: pd.Series) -> pd.DataFrame:
    found = [dimensions(bytes(h)) if h is not None else None for h in heads]
    return pd.DataFrame({"width": pd.array([f[0] if f else None for f in found], "Int32"), "height": pd.array([f[1] if f else None for f in found], "Int32")})


def sniff(content: Column, head_bytes: int = 32_768) -> Column:
    """struct(width, height) from the first ``head_bytes`` of file contents; nulls where unknown."""
    return pandas_udf(_dimensions_batch, "width int, height int")(F.substring(content, 1, head_bytes))


def scan_folder(spark: SparkSession, path: str) -> DataFrame:
    """(path, stem, modified, bytes, content) of the pictures below a folder; content is read only if used."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.{jpg,jpeg,png,webp,bmp,JPG,JPEG,PNG,WEBP,BMP}").load(path)
    return files.select("path", F.regexp_replace("path", r"\.[^./]+$", "").alias("stem"), F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"), "content")


def sidecars(spark: SparkSession, path: str, suffix: str = "txt") -> DataFrame:
    """(stem, caption) of the text files below a folder, whole files."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", f"*.{suffix}").text(path, wholetext=True)
    named = files.select(F.col("value").alias("caption"), F.col("_metadata.file_path").alias("p"))
    return named.select(F.regexp_replace("p", r"\.[^./]+$", "").alias("stem"), "caption")


def pair_sidecars(pictures: DataFrame, captions: DataFrame) -> DataFrame:
    """Pictures with the caption of the same stem, null without one."""
    same = F.regexp_replace("stem", "^[a-z]+:/+", "/")
    left = pictures.withColumn("__k", same)
    right = captions.select(same.alias("__k"), "caption").dropDuplicates(["__k"])
    return left.join(right, "__k", "left").drop("__k")


def luma(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Grey values of decoded pixels in blue, green, red order."""
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels).astype(np.float64)
    if channels == 1:
        return a[:, :, 0]
    return np.floor((299 * a[:, :, 2] + 587 * a[:, :, 1] + 114 * a[:, :, 0]) / 1000 + 0.5)


def laplacian_variance(grey: np.ndarray) -> float:
    """Population variance of the four-neighbour Laplacian, 2 decimals; 0 below 3 pixels an edge."""
    if min(grey.shape) < 3:
        return 0.0
    around = grey[:-2, 1:-1] + grey[2:, 1:-1] + grey[1:-1, :-2] + grey[1:-1, 2:]
    return round(float(np.var(around - 4 * grey[1:-1, 1:-1])), 2)


#: Corner share of height and width, brightness, share of bright pixels and spread that tell a watermark.
CORNER_HEIGHT, CORNER_WIDTH, BRIGHT, BRIGHT_SHARE, SPREAD = 0.08, 0.18, 240, 0.35, 45


def corner_mark(grey: np.ndarray) -> str | None:
    """The first corner whose pixels are bright and of high contrast, as a watermark is; None without one."""
    h, w = grey.shape
    if w < 100 or h < 100:
        return None
    ch, cw = int(h * CORNER_HEIGHT), int(w * CORNER_WIDTH)
    for i, c in enumerate((grey[:ch, :cw], grey[:ch, w - cw :], grey[h - ch :, :cw], grey[h - ch :, w - cw :])):
        if (c > BRIGHT).mean() > BRIGHT_SHARE and c.std() > SPREAD:
            return f"high_contrast_corner_{i}"
    return None


def _cosine_basis(n: int, k: int) -> np.ndarray:
    return np.cos(np.pi * np.outer(np.arange(k), 2 * np.arange(n) + 1) / (2 * n))


def perceptual_hash(grey: np.ndarray, side: int = 32, low: int = 8) -> str:
    """64 bits in hex: which of the lowest 8 by 8 cosine coefficients of a 32 by 32 reduction pass their median."""
    h, w = grey.shape
    rows = np.add.reduceat(grey, np.minimum((np.arange(side) * h) // side, h - 1), axis=0)
    cells = np.add.reduceat(rows, np.minimum((np.arange(side) * w) // side, w - 1), axis=1)
    ones = np.add.reduceat(np.add.reduceat(np.ones_like(grey), np.minimum((np.arange(side) * h) // side, h - 1), axis=0), np.minimum((np.arange(side) * w) // side, w - 1), axis=1)
    basis = _cosine_basis(side, low)
    c = basis @ (cells / ones) @ basis.T
    bits = (c > np.median(c)).ravel()
    return f"{int(''.join('1' if b else '0' for b in bits), 2):016x}"


def measure(images: DataFrame) -> DataFrame:
    """(origin, width, height, laplacian_variance, watermark, phash) of rows of the image source; narrow, by batches."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            out = []
            for r in part.itertuples(index=False):
                g = luma(bytes(r.data), r.height, r.width, r.nChannels)
                out.append((r.origin, r.width, r.height, laplacian_variance(g), corner_mark(g), perceptual_hash(g)))
            yield pd.DataFrame(out, columns=["origin", "width", "height", "laplacian_variance", "watermark", "phash"])

    return images.select("image.*").mapInPandas(run, "origin string, width int, height int, laplacian_variance double, watermark string, phash string")
