"""Pixels of image structs ``height, width, nChannels, mode, data`` (rows of BGR bytes), one Arrow pass
per partition (G1-G13, U2, U3, X30). Each image is handled on its own; nothing is gathered."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annoframe.operators.transforms import Op

IMAGE = "struct<height:int,width:int,nChannels:int,mode:int,data:binary>"
PixelFn = Callable[[np.ndarray, dict], np.ndarray]


def to_array(image) -> np.ndarray:
    return np.frombuffer(image["data"], np.uint8).reshape(image["height"], image["width"], image["nChannels"])


def to_struct(a: np.ndarray) -> dict:
    h, w, c = a.shape
    return {"height": h, "width": w, "nChannels": c, "mode": 16 if c == 3 else 0, "data": np.ascontiguousarray(a).tobytes()}


def luma(a: np.ndarray) -> np.ndarray:
    """Whole-number grey value of BGR pixels (ITU-R 601 weights in 16-bit fixed point)."""
    b, g, r = (a[..., i].astype(np.int64) for i in range(3))
    return ((r * 19595 + g * 38470 + b * 7471 + 0x8000) >> 16).astype(np.uint8)


def blend(base: np.ndarray, a: np.ndarray, factor: float) -> np.ndarray:
    """``base`` at 0, the image at 1, beyond it past 1; cut to whole bytes."""
    mixed = base.astype(np.float32) + np.float32(factor) * (a.astype(np.float32) - base.astype(np.float32))
    return np.clip(mixed, 0, 255).astype(np.uint8)


def sample(a: np.ndarray, step: dict, fill: tuple[int, int, int] = (0, 0, 0)) -> np.ndarray:
    """The image under an affine step: every output pixel takes the source pixel it comes from."""
    w, h = int(step["w"]), int(step["h"])
    m = np.array([[step["a"], step["b"]], [step["d"], step["e"]]])
    inv = np.linalg.inv(m)
    ys, xs = np.mgrid[0:h, 0:w]
    rel = np.stack([xs + 0.5 - step["c"], ys + 0.5 - step["f"]], -1) @ inv.T
    sx, sy = np.floor(rel[..., 0] + 1e-9).astype(int), np.floor(rel[..., 1] + 1e-9).astype(int)
    good = (sx >= 0) & (sy >= 0) & (sx < a.shape[1]) & (sy < a.shape[0])
    out = np.empty((h, w, a.shape[2]), np.uint8)
    out[:] = np.array(fill[::-1] if a.shape[2] == 3 else fill[:1], np.uint8)
    out[good] = a[sy[good], sx[good]]
    return out


def _taps(size: int, wanted: int) -> np.ndarray:
    """Bilinear weights (wanted x size) in 22-bit fixed point; shrinking widens the triangle so that every pixel counts."""
    scale = size / wanted
    reach = max(scale, 1.0)
    centre = (np.arange(wanted) + 0.5)[:, None] * scale
    k = np.arange(size)[None, :]
    inside = (k >= np.trunc(np.maximum(centre - reach + 0.5, 0))) & (k < np.trunc(centre + reach + 0.5))
    weights = np.where(inside, np.maximum(0, 1 - np.abs((k - centre + 0.5) / reach)), 0)
    return np.floor(weights / weights.sum(1, keepdims=True) * (1 << 22) + 0.5).astype(np.int64)


def resized(a: np.ndarray, width: int, height: int) -> np.ndarray:
    """Separable bilinear resampling, rounded to whole bytes after each axis; an axis of the right size is left alone."""
    out = a.astype(np.int64)
    if width != a.shape[1]:
        out = np.clip((np.einsum("ok,hkc->hoc", _taps(a.shape[1], width), out) + (1 << 21)) >> 22, 0, 255)
    if height != a.shape[0]:
        out = np.clip((np.einsum("ok,kwc->owc", _taps(a.shape[0], height), out) + (1 << 21)) >> 22, 0, 255)
    return out.astype(np.uint8)


#: The counter-based generator: a prime modulus, multipliers of the counters, and the rounds of mixing (fixed values).
PRIME, STEPS, TURN, SHIFT, ROUNDS = 2_147_483_647, (1_103, 69_069, 1_013, 577, 40_692), 48_271, 13, 3


class Counter:
    """Uniform numbers that depend only on (seed, image, variant, op) and a place, so any engine can draw any of them."""

    def __init__(self, seed: int, image: int, variant: int, op: int) -> None:
        self.start = sum(m * v for m, v in zip(STEPS, (seed, image, variant, op))) % PRIME

    def uniform(self, at: np.ndarray | int) -> np.ndarray:
        z = (self.start + np.asarray(at, np.int64) * STEPS[4]) % PRIME
        for _ in range(ROUNDS):
            z = (z * TURN + 11) % PRIME
            z = z ^ (z >> SHIFT)
        return (z + 0.5) / 2.0**31

    def normal(self, n: int) -> np.ndarray:
        """Box and Muller's transform of the places 2 i and 2 i + 1."""
        at = np.arange(n) * 2
        return np.sqrt(-2 * np.log(self.uniform(at))) * np.cos(2 * np.pi * self.uniform(at + 1))


def _hue(a: np.ndarray, degrees: float) -> np.ndarray:
    """Hue turned on the 256-step circle, value and saturation kept."""
    rgb = a[..., ::-1].astype(float) / 255
    top, low = rgb.max(-1), rgb.min(-1)
    span = top - low
    safe = np.where(span == 0, 1, span)
    r, g, b = rgb[..., 0], rgb[..., 1], rgb[..., 2]
    hue = np.select([top == r, top == g], [(g - b) / safe, 2 + (b - r) / safe], 4 + (r - g) / safe) / 6
    hue = np.where(span == 0, 0, hue % 1)
    hue = (np.floor(hue * 255) + round(degrees / 360 * 256) % 256) % 256 / 255
    sat = np.where(top == 0, 0, span / np.where(top == 0, 1, top))
    k = (np.array([5, 3, 1]) + hue[..., None] * 6) % 6
    out = top[..., None] * (1 - sat[..., None] * np.clip(np.minimum(k, 4 - k), 0, 1))
    return np.round(out[..., ::-1] * 255).astype(np.uint8)


def _blur(a: np.ndarray, radius: float) -> np.ndarray:
    if radius <= 0:
        return a.copy()
    reach = max(1, int(np.ceil(3 * radius)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / radius) ** 2)
    kernel /= kernel.sum()
    out = a.astype(float)
    for axis in (0, 1):
        pad = [(0, 0)] * 3
        pad[axis] = (reach, reach)
        wide = np.pad(out, pad, mode="edge")
        n = out.shape[axis]
        out = sum(k * np.take(wide, range(i, i + n), axis) for i, k in enumerate(kernel))
    return np.clip(np.round(out), 0, 255).astype(np.uint8)


def apply_op(a: np.ndarray, op: Op, step: dict, rng: Counter) -> np.ndarray:
    """One op on one image; ``step`` holds the drawn amount and the affine numbers."""
    amount = step["amount"]
    if op.name == "resize":
        return resized(a, int(step["w"]), int(step["h"]))
    if op.name in ("flip", "vflip", "rotate90", "rotate", "crop", "shear"):
        return sample(a, step)
    if op.name == "brightness":
        return blend(np.zeros_like(a), a, amount)
    if op.name == "contrast":
        return blend(np.full_like(a, int(luma(a).mean() + 0.5)), a, amount)
    if op.name == "saturation":
        return blend(np.repeat(luma(a)[..., None], 3, -1), a, amount)
    if op.name == "grayscale":
        return np.repeat(luma(a)[..., None], 3, -1)
    if op.name == "hue_shift":
        return _hue(a, amount)
    if op.name == "blur":
        return _blur(a, amount)
    if op.name == "noise":
        noise = np.round(rng.normal(a.shape[0] * a.shape[1]) * (max(0.0, amount) * 96.0)).reshape(*a.shape[:2], 1)
        return np.clip(a + noise, 0, 255).astype(np.uint8)
    if op.name == "cutout":
        out = a.copy()
        h, w = a.shape[:2]
        for i in range(max(0, op.extra["count"])):
            drawn, across, down = rng.uniform(np.arange(3) + 3 * i).tolist()
            share = min(1.0, max(0.0, op.low + drawn * (op.high - op.low)))
            cw, ch = max(1, round(w * share)), max(1, round(h * share))
            left, top = int(across * (max(0, w - cw) + 1)), int(down * (max(0, h - ch) + 1))
            out[top : top + ch + 1, left : left + cw + 1] = 128
        return out
    raise ValueError(f"unknown pixel op {op.name!r}")


def augment_pixels(variants: DataFrame, ops: Sequence[Op], seed: int) -> DataFrame:
    """``image_id, variant, image`` for planned variants carrying an ``image`` struct.

    Random patterns are counted out from (seed, image, variant, op), so a retried task gives the same bytes.
    """
    steps = [f"_step{i}" for i in range(len(ops))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            images = []
            for row in pdf.to_dict("records"):
                a = to_array(row["image"])
                for i, op in enumerate(ops):
                    step = row[steps[i]]
                    if row["variant"] > 0 and step["on"]:
                        a = apply_op(a, op, step, Counter(seed, int(row["image_id"]), int(row["variant"]), i))
                images.append(to_struct(a))
            yield pd.DataFrame({"image_id": pdf["image_id"], "variant": pdf["variant"], "image": images})

    return variants.select("image_id", "variant", "image", *steps).mapInPandas(
        run, f"image_id bigint, variant int, image {IMAGE}"
    )


def tile_pixels(tiles: DataFrame) -> DataFrame:
    """The pixels of tile rows that carry their source ``image``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            cut = [
                to_struct(to_array(im)[int(y0) : int(y1), int(x0) : int(x1)])
                for im, x0, y0, x1, y1 in zip(pdf["image"], pdf["x0"], pdf["y0"], pdf["x1"], pdf["y1"])
            ]
            yield pdf[["image_id", "row", "col"]].assign(image=cut)

    return tiles.select("image_id", "row", "col", "image", "x0", "y0", "x1", "y1").mapInPandas(
        run, f"image_id bigint, row int, col int, image {IMAGE}"
    )


def map_images(images: DataFrame, fn: PixelFn) -> DataFrame:
    """A user's own image transform ``fn(array, row) -> array`` on every image row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            made = [to_struct(fn(to_array(row["image"]), row)) for row in pdf.to_dict("records")]
            yield pdf.assign(image=made)

    return images.mapInPandas(run, images.schema)


def pixel_rows(images: DataFrame, *keys: str) -> DataFrame:
    """One row per byte position: for comparing images as tables."""
    size = F.col("image.height") * F.col("image.width") * F.col("image.nChannels")
    at = F.explode(F.sequence(F.lit(0), size - 1)).alias("at")
    rows = images.select(*keys, "image", at)
    value = F.conv(F.hex(F.substr(F.col("image.data"), F.col("at") + 1, F.lit(1))), 16, 10).cast("int")
    return rows.select(*keys, "at", value.alias("value"))
