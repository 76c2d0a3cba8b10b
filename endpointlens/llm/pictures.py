"""Pictures derived from a table of vectors, for the media operator: the given tables hold none.

Every vector is drawn as a texture of noise at four sizes with some rectangles, all from its components' bytes. Every
tenth row is drawn as a copy instead: the picture of the row before it, edited by one of five kinds in turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .media import pieces_of

SIDE = 128
KINDS = ("crop", "turn", "resize", "light", "all")


def seeded(data: bytes) -> np.random.Generator:
    return np.random.default_rng(int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little"))


def _stretch(n: int) -> np.ndarray:
    """SIDE x n weights of linear interpolation between n points."""
    at = np.linspace(0, n - 1, SIDE)
    return np.clip(1 - np.abs(at[:, None] - np.arange(n)[None, :]), 0, 1).astype(np.float32)


SIZES = {n: _stretch(n) for n in (4, 9, 18, 36)}


def draw(vector: list | None) -> np.ndarray:
    rng = seeded(np.asarray([0.0 if v is None else v for v in vector or []], "<f4").tobytes())
    picture = sum(60 / (1 + k / 2) * (w @ rng.standard_normal((n, n), np.float32) @ w.T) for k, (n, w) in enumerate(SIZES.items()))
    for y, x, h, w, grey in rng.integers((0, 0, 6, 6, -80), (SIDE - 8, SIDE - 8, 40, 40, 80), (8, 5)):
        picture[y : y + h, x : x + w] += grey
    return np.clip(picture + 128, 0, 255)


def warped(picture: np.ndarray, height: int, width: int, scale: float, turn: float, y0: float, x0: float) -> np.ndarray:
    """height x width pixels around (y0, x0), turned and scaled, bilinear."""
    y, x = np.mgrid[:height, :width] - np.array([height - 1, width - 1])[:, None, None] / 2
    c, s = np.cos(turn) / scale, np.sin(turn) / scale
    at, left = np.clip(y0 + c * y - s * x, 0, picture.shape[0] - 1.001), np.clip(x0 + s * y + c * x, 0, picture.shape[1] - 1.001)
    i, j = at.astype(int), left.astype(int)
    a, b = at - i, left - j
    return (picture[i, j] * (1 - b) + picture[i, j + 1] * b) * (1 - a) + (picture[i + 1, j] * (1 - b) + picture[i + 1, j + 1] * b) * a


def edited(picture: np.ndarray, key: int, kind: str) -> np.ndarray:
    """crop: 65 to 95 % of either side; turn: up to 40 degrees; resize: to 0.7 to 1.4; light: brightness, contrast, noise; all: some of each."""
    rng = seeded(f"{kind}{key}".encode())
    keep, turn, scale, light = (kind in (k, "all") for k in KINDS[:4])
    mild = 0.4 if kind == "all" else 1.0
    angle = rng.uniform(-0.7, 0.7) * mild * turn
    inside = 1 / (abs(np.cos(angle)) + abs(np.sin(angle)))  # the share of a side that a turned square keeps
    h, w = SIDE * inside * (rng.uniform(1 - 0.35 * mild, 0.95, 2) if keep else np.ones(2))
    y0, x0 = (rng.uniform(a / inside / 2, SIDE - a / inside / 2) if keep else SIDE / 2 for a in (h, w))
    factor = 1.4 ** (rng.uniform(-1, 1) * mild) if scale else 1.0
    out = warped(picture, int(h * factor), int(w * factor), factor, angle, y0 - 0.5, x0 - 0.5)
    return out * rng.uniform(0.75, 1.0) + rng.uniform(0, 40) + rng.normal(0, 3, out.shape) if light else out


def pgm(picture: np.ndarray) -> bytes:
    grey = np.clip(np.rint(picture), 0, 255).astype(np.uint8)
    return b"P5 %d %d 255\n" % (grey.shape[1], grey.shape[0]) + grey.tobytes()


def kind_of(media_id: int) -> str:
    return KINDS[media_id // 10 % len(KINDS)]


def render(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(media_id, source_id, image): source_id is the row that a copy was made from, else the row itself."""
    own = vectors.select(F.col(vec_id).alias("media_id"), F.col(embedding).alias("v"))
    before = own.where("media_id % 10 = 6").select((F.col("media_id") + 1).alias("media_id"), F.col("v").alias("u"))
    both = own.join(before, "media_id", "left").select("media_id", (F.col("u").isNotNull() & (F.col("media_id") % 10 == 7)).alias("copy"), F.coalesce("u", "v").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces_of(batches):
            ids, copies = b.column(0).to_pylist(), b.column(1).to_pylist()
            images = [pgm(edited(draw(v), i, kind_of(i)) if c else draw(v)) for i, c, v in zip(ids, copies, b.column(2).to_pylist())]
            sources = [i - 1 if c else i for i, c in zip(ids, copies)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sources, pa.int64()), pa.array(images, pa.binary())], names=["media_id", "source_id", "image"])

    return both.mapInArrow(run, "media_id long, source_id long, image binary")
