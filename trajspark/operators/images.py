"""Raw pixel columns: crop, resize and user transforms (D10, P14, X6). Pixels are flat channel-first arrays."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajspark.dataset import EpisodicDataset
from trajspark.functions.columns import c


def crop(pixels: Column, shape: tuple[int, int, int], top: Column | int, left: Column | int, height: int, width: int) -> Column:
    """Rows ``top …`` and columns ``left …`` of a channels x height x width image."""
    _, h, w = shape
    top, left = (F.lit(v) if isinstance(v, int) else v for v in (top, left))

    def inside(_: Column, i: Column) -> Column:
        y, x = F.floor(i / w) % h, i % w
        return (y >= top) & (y < top + height) & (x >= left) & (x < left + width)

    return F.filter(pixels, inside)


def crop_images(ds: EpisodicDataset, boxes: Mapping[str, tuple[int, int, int, int]]) -> EpisodicDataset:
    """Crop cameras to ``(top, left, height, width)`` and update their shape."""
    features, changed = dict(ds.features), {}
    for key, (top, left, height, width) in boxes.items():
        shape = tuple(features[key]["shape"])
        if top < 0 or left < 0 or top + height > shape[1] or left + width > shape[2]:
            raise ValueError(f"crop {boxes[key]} leaves the image {shape}")
        changed[key] = crop(c(key), shape, top, left, height, width)
        features[key] = {**features[key], "shape": [shape[0], height, width]}
    return ds.with_(frames=ds.frames.withColumns(changed), info={**ds.info, "features": features})


def area_resize(pixels: Column, shape: tuple[int, int, int], factor: int) -> Column:
    """Mean of ``factor x factor`` squares; sides must be multiples of ``factor``."""
    ch, h, w = shape
    if h % factor or w % factor:
        raise ValueError("sides must be multiples of the factor")
    oh, ow = h // factor, w // factor
    offsets = F.array(*[F.lit(dy * w + dx) for dy in range(factor) for dx in range(factor)])

    def mean(o: Column) -> Column:
        base = F.floor(o / (oh * ow)) * (h * w) + (F.floor(o / ow) % oh) * (factor * w) + (o % ow) * factor
        total = F.aggregate(offsets, F.lit(0.0), lambda s, d: s + F.get(pixels, (base + d).cast("int")))
        return total / (factor * factor)

    return F.transform(F.sequence(F.lit(0), F.lit(ch * oh * ow - 1)), mean)


def shift(pixels: Column, shape: tuple[int, int, int], pad: int, shift_y: Column, shift_x: Column) -> Column:
    """Edge-padded image read at an offset of ``0 … 2 * pad``."""
    _, h, w = shape

    def source(i: Column) -> Column:
        plane = F.floor(i / (h * w))
        y = F.greatest(F.lit(0), F.least(F.lit(h - 1), F.floor(i / w) % h + shift_y - pad))
        x = F.greatest(F.lit(0), F.least(F.lit(w - 1), i % w + shift_x - pad))
        return F.get(pixels, (plane * (h * w) + y * w + x).cast("int"))

    return F.transform(F.sequence(F.lit(0), F.size(pixels) - 1), source)


def image_hook(frames: DataFrame, keys: list[str], fn: Callable, kind: T.DataType) -> DataFrame:
    """Apply a user function ``Series -> Series`` to camera columns, in Arrow batches."""

    def batch(values: pd.Series) -> pd.Series:
        return fn(values)

    udf = F.pandas_udf(batch, kind)
    return frames.withColumns({k: udf(c(k)) for k in keys})
