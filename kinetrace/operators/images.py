"""Image bytes and arrays: headers, masks, geometric and photometric transforms in numpy.

Encoded images stay opaque bytes in a table of their own; only headers are parsed here. Transforms
work on arrays (height, width, 3) of uint8; a random one is fixed by a seed, so all views of a step
that share a seed get the same one.
"""

from __future__ import annotations

import io
import struct
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType


def jpeg_shape(data: bytes | None) -> tuple[int, int, int] | None:
    """(height, width, channels) from a JPEG's frame header, or None if it has none."""
    if not data or data[:2] != b"\xff\xd8":
        return None
    at = 2
    while at + 4 <= len(data):
        if data[at] != 0xFF:
            return None
        mark = data[at + 1]
        if mark == 0xFF:
            at += 1
            continue
        if mark == 0xD9 or mark == 0xDA:
            return None
        size = struct.unpack(">H", data[at + 2 : at + 4])[0]
        if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
            if at + 10 > len(data):
                return None
            h, w, c = struct.unpack(">HHB", data[at + 5 : at + 10])
            return h, w, c
        at += 2 + size
    return None


def png_shape(data: bytes | None) -> tuple[int, int, int] | None:
    if not data or data[:8] != b"\x89PNG\r\n\x1a\n" or len(data) < 26:
        return None
    w, h, _, kind = struct.unpack(">IIBB", data[16:26])
    return h, w, {0: 1, 2: 3, 3: 3, 4: 2, 6: 4}.get(kind, 0)


@F.pandas_udf(StructType([StructField(n, IntegerType()) for n in ("height", "width", "channels")]))
def image_shape(data: pd.Series) -> pd.DataFrame:
    """Shape of encoded images by their headers; nulls where they can't be read."""
    rows = [jpeg_shape(x) or png_shape(x) or (None, None, None) for x in data]
    return pd.DataFrame(rows, columns=["height", "width", "channels"]).astype("Int32")


def with_shapes(images: DataFrame, data: str = "image") -> DataFrame:
    return images.withColumn("shape", image_shape(data)).withColumn("decoded", F.col("shape.height").isNotNull())


def letterbox(image: np.ndarray, height: int, width: int, fill: int = 0) -> np.ndarray:
    """The whole image at the largest size that fits, centred on a filled canvas."""
    h, w = image.shape[:2]
    s = min(height / h, width / w)
    small = resized(image, max(1, round(h * s)), max(1, round(w * s)))
    out = np.full((height, width, *image.shape[2:]), fill, image.dtype)
    a, b = (height - small.shape[0]) // 2, (width - small.shape[1]) // 2
    out[a : a + small.shape[0], b : b + small.shape[1]] = small
    return out


def resized(image: np.ndarray, height: int, width: int) -> np.ndarray:
    """Bilinear, pixel centres aligned."""
    h, w = image.shape[:2]
    y = np.clip((np.arange(height) + 0.5) * h / height - 0.5, 0, h - 1)
    x = np.clip((np.arange(width) + 0.5) * w / width - 0.5, 0, w - 1)
    y0, x0 = np.floor(y).astype(int), np.floor(x).astype(int)
    y1, x1 = np.minimum(y0 + 1, h - 1), np.minimum(x0 + 1, w - 1)
    extra = (1,) * (image.ndim - 2)
    fy, fx = (y - y0).reshape(-1, 1, *extra), (x - x0).reshape(1, -1, *extra)
    p = image.astype(float)
    top = p[y0][:, x0] * (1 - fx) + p[y0][:, x1] * fx
    low = p[y1][:, x0] * (1 - fx) + p[y1][:, x1] * fx
    out = top * (1 - fy) + low * fy
    return np.rint(out).astype(image.dtype) if image.dtype.kind in "ui" else out.astype(image.dtype)


def cropped(image: np.ndarray, share: float, seed: int | None = None) -> np.ndarray:
    """A share of both sides: the centre, or a place fixed by the seed."""
    h, w = image.shape[:2]
    ch, cw = max(1, int(h * share)), max(1, int(w * share))
    if seed is None:
        a, b = (h - ch) // 2, (w - cw) // 2
    else:
        rng = np.random.default_rng(seed)
        a, b = int(rng.integers(0, h - ch + 1)), int(rng.integers(0, w - cw + 1))
    return image[a : a + ch, b : b + cw]


def even(image: np.ndarray) -> np.ndarray:
    """Without the last row or column where their number is odd, as encoders ask."""
    h, w = image.shape[:2]
    return image[: h - h % 2, : w - w % 2]


def jittered(image: np.ndarray, seed: int, brightness: float = 0.0, contrast: float = 0.0, saturation: float = 0.0) -> np.ndarray:
    """Brightness, contrast and saturation, each by a factor in [1 - x, 1 + x] that the seed fixes."""
    rng = np.random.default_rng(seed)
    b, c, s = (1 + rng.uniform(-x, x) for x in (brightness, contrast, saturation))
    out = image.astype(float) * b
    out = (out - out.mean()) * c + out.mean()
    grey = (out @ np.array([0.299, 0.587, 0.114]))[..., None]
    out = (out - grey) * s + grey
    return np.clip(np.rint(out), 0, 255).astype(np.uint8)


#: Transforms by name, each a function of an array (height, width, channels), a seed and options.
TRANSFORMS = {
    "letterbox": lambda image, seed, **o: letterbox(image, **o),
    "resize": lambda image, seed, **o: resized(image, **o),
    "centre_crop": lambda image, seed, **o: cropped(image, **o),
    "random_crop": lambda image, seed, **o: cropped(image, seed=seed, **o),
    "jitter": lambda image, seed, **o: jittered(image, seed, **o),
    "even": lambda image, seed: even(image),
}


def transformed(images: DataFrame, steps: Sequence[tuple[str, Mapping]], values: str = "values", shape: str = "shape", seed: str = "seed") -> DataFrame:
    """Images (flat values, their shape, a seed) after a chain of TRANSFORMS. Random steps depend on the
    row's seed alone, so views of one step that share it are transformed alike."""
    unknown = [name for name, _ in steps if name not in TRANSFORMS]
    if unknown:
        raise ValueError(f"unknown transforms {unknown}: {', '.join(sorted(TRANSFORMS))}")
    names = images.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            flat, shapes = [], []
            for v, s, k in zip(pdf[values], pdf[shape], pdf[seed]):
                image = np.clip(np.rint(np.asarray(v, float)), 0, 255).astype(np.uint8).reshape(tuple(s))
                for name, options in steps:
                    image = TRANSFORMS[name](image, int(k), **options)
                flat.append(image.astype(float).ravel().tolist())
                shapes.append(list(image.shape))
            yield pdf.assign(**{values: flat, shape: shapes})[names]

    return images.mapInPandas(run, images.schema)


def read_arrays(spark: SparkSession, path: str, glob: str = "*.np[yz]") -> DataFrame:
    """(path, row, shape, values): arrays of .npy and single-array .npz files, two dimensions read as one
    frame. Pickled arrays are refused."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for name, raw in zip(pdf["path"], pdf["content"]):
                got = np.load(io.BytesIO(raw), allow_pickle=False)
                if not isinstance(got, np.ndarray):
                    keys = list(got)
                    got = got[keys[0] if len(keys) == 1 else "arr_0"]
                got = got[None] if got.ndim == 2 else got
                yield pd.DataFrame({"path": name, "row": range(len(got)), "shape": [list(got.shape[1:])] * len(got), "values": [x.ravel().astype(float).tolist() for x in got]})

    return files.select("path", "content").mapInPandas(run, "path string, row long, shape array<int>, values array<double>")


def gathered(arrays: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of arrays by (path, row)."""
    return wanted.join(arrays, ["path", "row"])


def frame_index(seconds: Column, fps: float, n: Column, tolerance: float = 0.01) -> Column:
    """The frame nearest to a time; null where it is off by more than the tolerance in frames, or beyond
    the video."""
    exact = seconds * fps
    near = F.rint(exact)
    return F.when((F.abs(exact - near) <= tolerance) & (near >= 0) & (near < n), near.cast("long"))
