"""Model steps as injected batch functions; no weights come with this package.

A scorer takes a list of inputs and gives one list of floats each; it runs on executors through Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import fixed, tags

Scorer = Callable[[list], list[list[float]]]


def scored(rows: DataFrame, scorer: Scorer, column: str, batch: int = 32) -> DataFrame:
    """(id, scores) of rows; inputs that are null or make the scorer fail alone get null scores."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, batch):
                part = b.slice(i, batch)
                values, out = part.column(1).to_pylist(), []
                try:
                    found = iter(scorer([v for v in values if v is not None]))
                    out = [None if v is None else next(found) for v in values]
                except Exception:  # noqa: BLE001  one bad input must not lose its batch
                    for v in values:
                        try:
                            out.append(None if v is None else scorer([v])[0])
                        except Exception:  # noqa: BLE001
                            out.append(None)
                yield pa.record_batch([part.column(0), pa.array(out, pa.list_(pa.float32()))], ["id", "scores"])

    return rows.select("id", column).mapInArrow(run, "id long, scores array<float>")


def tags_over(scores: Column, names: list[str], categories: list[int], threshold: float = 0.35, ratings: bool = False, characters: bool = True) -> Column:
    """Names whose score passes the threshold; ratings (9) and characters (4) by choice. JVM side."""
    table = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(c).alias("category")) for n, c in zip(names, categories, strict=True)])
    left_out = [c for c, keep in ((9, ratings), (4, characters)) if not keep]
    passed = F.filter(F.arrays_zip(scores.alias("score"), table.alias("tag")), lambda x: (x["score"] > threshold) & ~x["tag"]["category"].isin(left_out or [-1]))
    return F.transform(passed, lambda x: x["tag"]["name"])


def ranked_tags(scores: Column, names: list[str]) -> Column:
    """Structs (score, name), best first."""
    return F.reverse(F.array_sort(F.arrays_zip(scores.alias("score"), F.array(*[F.lit(n) for n in names]).alias("name"))))


def best_label(scores: Column, names: tuple[str, ...] = tuple(fixed.LABEL_NUMBER)) -> Column:
    """Name of the highest score, the first of equals; null without scores."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.array_position(scores, F.array_max(scores)).cast("int"))


def upsampled(posts: DataFrame, scores: DataFrame, names: list[str], categories: list[int], threshold: float = 0.35) -> DataFrame:
    """(id, upsampled_tags): tags over the threshold that agree with the post's prompt."""
    rows = posts.join(scores, "id")
    new = F.transform(tags_over(F.col("scores"), names, categories, threshold), tags.readable_tag)
    prompt = tags.prompt_of(F.col("tag_string"))
    taken = F.array_join(tags.combined(prompt, new), ", ")
    return rows.select("id", tags.validated(taken, prompt, F.col("tag_string_general")).alias("upsampled_tags"))


def phash(images: DataFrame) -> DataFrame:
    """(id, hash) of decoded images (id, image struct of Spark's image source): 64 bits of a low-frequency cosine transform."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = np.arange(32)
        cosine = np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / 64)
        for b in batches:
            out = []
            for row in b.to_pylist():
                w, h, c, raw = row["width"], row["height"], row["nChannels"], row["data"]
                grey = np.frombuffer(raw, np.uint8).reshape(h, w, c)[:, :, : min(c, 3)].mean(2)
                sums = np.pad(np.cumsum(np.cumsum(grey, 0), 1), ((1, 0), (1, 0)))
                (y0, y1), (x0, x1) = ((e[:-1], np.maximum(e[1:], e[:-1] + 1)) for e in (np.linspace(0, n, 33).astype(int) for n in (h, w)))
                small = (sums[np.ix_(y1, x1)] - sums[np.ix_(y0, x1)] - sums[np.ix_(y1, x0)] + sums[np.ix_(y0, x0)]) / ((y1 - y0)[:, None] * (x1 - x0)[None, :])
                low = (cosine @ small @ cosine.T)[:8, :8].ravel()
                low[0] = 0
                out.append(int(np.packbits(low > low.mean()).view(">i8")[0]))
            yield pa.record_batch([b.column(b.schema.get_field_index("id")), pa.array(out, pa.int64())], ["id", "hash"])

    return images.select("id", "image.width", "image.height", "image.nChannels", "image.data").mapInArrow(run, "id long, hash long")


def face_crop(width: Column, height: Column, box: Column, pad: float = 0.2, top: float = 0.4, least: int = 256, side: int = 256) -> Column:
    """Crop (x0, y0, x1, y1, close_up) around a face box, or null.

    A face over 0.6 of the image takes the whole image as it is. Else the box is padded inside the image; its sides must
    be `least` long, and scaled so that the shorter one is `least`, both must be `side`: only square crops pass.
    """
    w, h = box["x1"] - box["x0"], box["y1"] - box["y0"]
    pad_x, pad_y, pad_top = F.floor(w * pad), F.floor(h * pad), F.floor(h * top)
    x0, y0 = F.greatest(F.lit(0), box["x0"] - pad_x), F.greatest(F.lit(0), box["y0"] - pad_top)
    x1, y1 = F.least(width, box["x1"] + pad_x), F.least(height, box["y1"] + pad_y)
    made = lambda *v, close: F.struct(*[x.cast("int").alias(n) for x, n in zip(v, ("x0", "y0", "x1", "y1"), strict=True)], F.lit(close).alias("close_up"))
    wide, high = x1 - x0, y1 - y0
    longer = F.floor(F.greatest(wide, high) * (F.lit(float(least)) / F.least(wide, high)))
    square = (F.least(wide, high) >= least) & (longer == side) & F.lit(least == side)
    return F.when(w * h > width * height * 0.6, made(F.lit(0), F.lit(0), width, height, close=True)).when(square, made(x0, y0, x1, y1, close=False))


def resize_weights(size: int, to: int):
    """Matrix of a triangle filter from `size` samples to `to`, widened where it shrinks."""
    import numpy as np

    scale = size / to
    reach = max(scale, 1.0)
    off = np.abs(np.arange(size)[None, :] + 0.5 - (np.arange(to)[:, None] + 0.5) * scale) / reach
    w = np.maximum(0.0, 1.0 - off)
    return w / w.sum(1, keepdims=True)


def padded_pixels(images: DataFrame, height: int, width: int, color: tuple[int, int, int] = (255, 255, 255)) -> DataFrame:
    """(id, pixels) of decoded images (id, image struct of Spark's image source): scaled to fit, centred on a plain ground
    of an RGB colour; 3 x height x width floats from 0 to 255, channels blue, green, red. Transparent parts show the ground."""
    import numpy as np

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                w, h, c = row["width"], row["height"], row["nChannels"]
                image = np.frombuffer(row["data"], np.uint8).reshape(h, w, c).astype(float)
                ratio = min(width / w, height / h)
                new_w, new_h = max(1, int(w * ratio)), max(1, int(h * ratio))
                small = np.rint(np.einsum("yh,hwc,xw->yxc", resize_weights(h, new_h), image, resize_weights(w, new_w), optimize=True))
                out = np.empty((height, width, 3))
                out[:] = color[::-1]
                x, y = (width - new_w) // 2, (height - new_h) // 2
                part = small[:, :, :3] if c >= 3 else np.repeat(small[:, :, :1], 3, 2)
                alpha = small[:, :, 3:] / 255 if c == 4 else 1.0
                out[y : y + new_h, x : x + new_w] = np.rint(part * alpha + out[y : y + new_h, x : x + new_w] * (1 - alpha))
                yield pa.record_batch([pa.array([row["id"]], pa.int64()), pa.array([out.transpose(2, 0, 1).ravel().astype(np.float32)], pa.list_(pa.float32()))], ["id", "pixels"])

    return images.select("id", "image.width", "image.height", "image.nChannels", "image.data").mapInArrow(run, "id long, pixels array<float>")
