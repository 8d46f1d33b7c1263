"""Video operators: motion between frames, statistics of saliency maps, and the feature table made of both."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions import arrays as A
from cadenza.functions import images
from cadenza.operators import sequence as S

FRAMES_AT_ONCE = 64
MAP_STATS = ["mean_saliency", "max_saliency", "std_saliency", "saliency_entropy", "attention_center_x", "attention_center_y", "attention_concentration", "top10_saliency_mass"]
SMOOTHED = ["motion_intensity", "motion_variance", "mean_saliency", "max_saliency", "std_saliency", "attention_concentration", "top10_saliency_mass"]
ORDER = (
    "time_sec frame_idx motion_intensity motion_intensity_smooth motion_variance motion_change_rate mean_saliency mean_saliency_smooth max_saliency std_saliency saliency_entropy "
    "saliency_change_rate attention_center_x attention_center_y attention_concentration attention_shift_rate top10_saliency_mass is_high_motion is_high_saliency is_focused_attention"
).split()


def map_stats(maps: DataFrame, column: str, width: int, height: int) -> DataFrame:
    """The eight statistics of a row-major map of width * height values."""
    m = F.col(column)
    x, y = A.centre(m, width, height)
    out = maps.withColumns({"mean_saliency": A.mean(m), "max_saliency": F.array_max(m), "std_saliency": A.std_pop(m), "saliency_entropy": A.entropy(m), "attention_center_x": x, "attention_center_y": y, "top10_saliency_mass": A.top_mass(m)})
    return out.withColumn("attention_concentration", A.concentration(m, width, height, F.col("attention_center_x"), F.col("attention_center_y")))


def _absolute(now: np.ndarray | None, before: np.ndarray | None) -> tuple[np.ndarray, np.ndarray] | None:
    """Mean and population deviation of the rows' absolute differences over 255."""
    if now is None or before is None or now.shape != before.shape or not now.shape[1]:
        return None
    diff = np.abs(now - before)
    return diff.mean(1) / 255.0, diff.std(1) / 255.0


def runs(frames: DataFrame, key: list[str], n: str, gray: str) -> DataFrame:
    """The frames without their pixels, with motion within runs: consecutive frames that lie after each other in a task.

    The pixels go along as ``_first`` where a frame has no frame before it in its task, and as ``_last`` where none may follow in its batch.
    """
    kind = frames.schema[gray].dataType
    rest = [c for c in frames.columns if c != gray]
    schema = T.StructType([frames.schema[c] for c in rest] + [T.StructField(c, T.DoubleType()) for c in ("motion_intensity", "motion_variance")] + [T.StructField(c, kind) for c in ("_first", "_last")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the place and pixels of the last frame of the batch before
        for batch in batches:
            if not len(batch):
                continue
            pixels = batch.column(batch.schema.get_field_index(gray))
            numbers = batch.column(batch.schema.get_field_index(n)).to_pylist()
            place = list(zip(*(batch.column(batch.schema.get_field_index(k)).to_pylist() for k in key), numbers, strict=True))
            follows = lambda a, b: b[-1] is not None and a[-1] is not None and b == (*a[:-1], a[-1] + 1)
            after = np.array([held is not None and follows(held[0], place[0]), *(follows(a, b) for a, b in zip(place[:-1], place[1:], strict=True))])
            mean, spread = np.zeros(len(batch)), np.zeros(len(batch))
            for at in range(0, len(batch), FRAMES_AT_ONCE):
                rows = np.arange(max(1, at), min(len(batch), at + FRAMES_AT_ONCE))
                rows = rows[after[rows]]
                got = _absolute(images.matrix(pixels, rows), images.matrix(pixels, rows - 1))
                if got is not None:
                    mean[rows], spread[rows] = got
                    continue
                for k in rows.tolist():  # frames that are null or of different sizes
                    one = _absolute(images.matrix(pixels, np.array([k])), images.matrix(pixels, np.array([k - 1])))
                    if one is not None:
                        mean[k], spread[k] = one[0][0], one[1][0]
            if after[0]:
                one = _absolute(images.matrix(pixels, np.array([0])), images.matrix(held[1], np.array([0])))
                if one is not None:
                    mean[0], spread[0] = one[0][0], one[1][0]
            known = pa.array(after)
            last = pa.array(np.append(~after[1:], True))
            none = pa.nulls(len(batch), pixels.type)
            columns = [batch.column(batch.schema.get_field_index(c)) for c in rest]
            columns += [pc.if_else(known, pa.array(v), pa.scalar(None, pa.float64())) for v in (mean, spread)]
            yield pa.RecordBatch.from_arrays([*columns, pc.if_else(known, none, pixels), pc.if_else(last, pixels, none)], names=schema.names)
            held = place[-1], pixels.slice(len(batch) - 1, 1)

    return frames.select(*rest, gray).mapInArrow(run, schema)


def motion(frames: DataFrame, key: list[str], n: str, gray: str) -> DataFrame:
    """The frames without their pixels, with motion_intensity and motion_variance: mean and population deviation of the absolute
    difference to the frame before, over 255; 0 for the first, and next to a frame that is null or of another size.

    Differences are taken where the frames lie. Only a frame at the edge of a task's run (or batch) is shuffled with its pixels, to the
    row after it; ``n`` is unique in a key. Pixels are bytes or arrays of numbers.
    """
    out = S.windowed(runs(frames, key, n, gray), key, n, 1, 0, {"_before": lambda w: F.lag("_last").over(w)})

    @F.pandas_udf("array<double>")
    def at_edge(now: pd.Series, before: pd.Series) -> pd.Series:
        def one(a, b):
            if a is None or b is None:
                return None
            a, b = (np.frombuffer(x, np.uint8).astype(float) if isinstance(x, bytes) else np.asarray(x, float) for x in (a, b))
            got = _absolute(a.reshape(1, -1), b.reshape(1, -1)) if len(a) == len(b) and not np.isnan(a).any() and not np.isnan(b).any() else None
            return None if got is None else [got[0][0], got[1][0]]

        return pd.Series([one(a, b) for a, b in zip(now, before, strict=True)], index=now.index, dtype=object)

    out = out.withColumn("_edge", at_edge("_first", F.when(F.col("_first").isNotNull(), F.col("_before"))))
    parts = [(c, F.coalesce(F.col(c), F.get("_edge", F.lit(k)), F.lit(0.0))) for k, c in enumerate(("motion_intensity", "motion_variance"))]
    return out.withColumns(dict(parts)).drop("_first", "_last", "_before", "_edge")


def with_saliency(frames: DataFrame, stats: DataFrame, on: list[str]) -> DataFrame:
    """Frames with the statistics of their maps; 0 where a frame has none."""
    return frames.join(stats.select(*on, *MAP_STATS), on, "left").fillna(0.0, MAP_STATS)


def features(frames: DataFrame, key: list[str], fps: float, window_sec: float = 0.5) -> DataFrame:
    """The feature table: smoothed columns, change rates and flags, in column order, rounded to six decimals."""
    if fps <= 0:
        raise ValueError("fps must be over 0")
    out = frames.withColumn("time_sec", F.col("frame_idx") / F.lit(float(fps)))
    # All that looks at other rows in one window over blocks with the widest edges.
    width = max(1, int(fps * window_sec))
    back, ahead = width // 2, (width - 1) // 2
    looks = {f"{c}_smooth": (lambda w, c=c: F.avg(c).over(w.rowsBetween(-back, ahead))) for c in SMOOTHED if c in out.columns}
    moved = {"motion_change_rate": "motion_intensity", "saliency_change_rate": "mean_saliency", "_dx": "attention_center_x", "_dy": "attention_center_y"}
    looks |= {new: (lambda w, c=c: S.difference(c, w)) for new, c in moved.items()}
    out = S.windowed(out, key, "frame_idx", max(1, back), ahead, looks)
    out = out.withColumn("attention_shift_rate", F.sqrt(F.col("_dx") * F.col("_dx") + F.col("_dy") * F.col("_dy"))).drop("_dx", "_dy")
    out = S.over_quantile(out, key, {"is_high_motion": "motion_intensity_smooth", "is_high_saliency": "mean_saliency_smooth", "is_focused_attention": "attention_concentration"})
    rest = [f"{c}_smooth" for c in SMOOTHED if f"{c}_smooth" not in ORDER]
    kinds = dict(out.dtypes)
    return out.select(*key, *(A.round6(F.col(c)).alias(c) if kinds[c] == "double" else F.col(c) for c in [*ORDER, *rest]))


def summary(table: DataFrame, key: list[str]) -> DataFrame:
    """Frames, means, flagged frames with their shares, and the range of concentration."""
    flag = lambda c: F.col(c).cast("int")
    return table.groupBy(*key).agg(
        F.count("*").alias("frames"), F.avg("motion_intensity").alias("mean_motion"), F.avg("mean_saliency").alias("mean_saliency"),
        F.sum(flag("is_high_motion")).alias("high_motion"), (F.avg(flag("is_high_motion")) * 100).alias("high_motion_pct"),
        F.sum(flag("is_high_saliency")).alias("high_saliency"), (F.avg(flag("is_high_saliency")) * 100).alias("high_saliency_pct"),
        F.min("attention_concentration").alias("min_concentration"), F.max("attention_concentration").alias("max_concentration"),
    )
