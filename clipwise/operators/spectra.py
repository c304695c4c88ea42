"""Spectra of clips as tables of frames: Spark cuts, deals and averages frames, and a batch of them goes through one transform.

``clips`` has a key and ``samples``, an array of numbers. A frame is a row, so a long clip is many small rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, DoubleType

from clipwise.functions.edits import dtw
from clipwise.functions.signal import RATE, mel_filters

FLOOR = 1e-10


def framed(clips: DataFrame, size: int, hop: int, *, key: str = "clip", samples: str = "samples", center: bool = True) -> DataFrame:
    """key, frame (from 0) and y, ``size`` samples every ``hop``; with ``center`` half a window of silence is put at both ends.

    A clip shorter than a window is filled with silence, so every clip has a frame; a null one has none.
    """
    quiet = lambda n: F.array_repeat(F.lit(0.0), n)
    values = F.transform(samples, lambda x: x.cast("double"))
    padded = F.concat(quiet(size // 2), values, quiet(size // 2)) if center else values
    long = F.concat(F.col("p"), F.array_repeat(F.lit(0.0), F.greatest(F.lit(size) - F.size("p"), F.lit(0))))
    starts = F.sequence(F.lit(0), F.floor((F.size("p") - size) / hop).cast("int"))
    cut = clips.select(key, padded.alias("p")).select(key, long.alias("p")).where("p is not null")
    return cut.select(key, F.posexplode(F.transform(starts, lambda i: F.slice("p", i * hop + 1, F.lit(size)))).alias("frame", "y"))


def _rowwise(f: Callable[[np.ndarray], np.ndarray], width: int, rows: int = 2048) -> Callable[[Column], Column]:
    """``f`` over batches of equally long arrays as a matrix, some rows of it at a time."""

    def run(y: pa.Array) -> pa.Array:
        m = y.flatten().to_numpy(zero_copy_only=False).reshape(len(y), width)
        out = [f(m[a : a + rows]) for a in range(0, len(m), rows)] or [f(m)]
        whole = np.concatenate(out)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1) * whole.shape[1], pa.int32()), pa.array(whole.ravel()))

    run.__annotations__ = {"y": pa.Array, "return": pa.Array}
    return arrow_udf(run, ArrayType(DoubleType()))


def power(frames: DataFrame, size: int) -> DataFrame:
    """Frames with ``power`` of frequencies 0 to size / 2 under a Hann window, in place of ``y``."""
    window = np.hanning(size)
    return frames.withColumn("power", _rowwise(lambda m: np.abs(np.fft.rfft(m * window, axis=1)) ** 2, size)("y")).drop("y")


def _below_top(frames: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """An array of powers in dB below the largest of its clip, which is found first."""
    top = frames.groupBy(*keys).agg(F.greatest(F.max(F.array_max(column)), F.lit(FLOOR)).alias("_top"))
    met = frames.join(top, keys)
    return met.withColumn(column, F.transform(column, lambda x: 10 * F.log10(F.greatest(x, F.lit(FLOOR)) / F.col("_top")))).drop("_top")


def spectrogram(clips: DataFrame, size: int = 1024, hop: int = 256, top: float = 8000.0, rate: int = RATE, key: str = "clip") -> DataFrame:
    """key, frame and ``power`` in dB below the clip's largest, up to ``top`` Hz. 80 samples every 16 up to 5 kHz show formants."""
    bins = int(top * size / rate) + 1
    found = power(framed(clips, size, hop, key=key), size).withColumn("power", F.slice("power", 1, bins))
    return _below_top(found, "power", [key])


def mel(clips: DataFrame, n: int = 64, size: int = 1024, hop: int = 256, rate: int = RATE, key: str = "clip") -> DataFrame:
    """key, frame and ``mel``, ``n`` bands in dB below the clip's largest."""
    filters = mel_filters(n, size, rate).T
    bands = power(framed(clips, size, hop, key=key), size).withColumn("mel", _rowwise(lambda m: m @ filters, size // 2 + 1)("power")).drop("power")
    return _below_top(bands, "mel", [key])


def cepstra(clips: DataFrame, n: int = 25, mels: int = 64, size: int = 1024, hop: int = 256, rate: int = RATE, key: str = "clip") -> DataFrame:
    """key, frame and ``c``, cepstral coefficients 1 to n - 1 of the bands, which are cut at -80 dB."""
    angles = np.arange(1, n)[:, None] * (2 * np.arange(mels) + 1)[None] * (np.pi / (2 * mels))
    basis = (np.cos(angles) * np.sqrt(2 / mels)).T
    return mel(clips, mels, size, hop, rate, key).withColumn("c", _rowwise(lambda m: np.maximum(m, -80) @ basis, mels)("mel")).drop("mel")


def _ordered(frames: DataFrame, column: str, key: str) -> DataFrame:
    """A clip's frames as one array in order; a clip lasts seconds."""
    return frames.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("frame", column))).alias("f")).select(key, F.transform("f", lambda x: x[column]).alias("rows"))


@arrow_udf(DoubleType())
def _warped(a: pa.Array, b: pa.Array) -> pa.Array:
    out = []
    for x, y in zip(a, b, strict=True):
        if not x.is_valid or not y.is_valid:
            out.append(None)
            continue
        x, y = np.array(x.as_py()), np.array(y.as_py())
        out.append(float(10 / math.log(10) * math.sqrt(2) * np.mean([np.linalg.norm(x[i] - y[j]) for i, j in dtw(x, y)])))
    return pa.array(out, pa.float64())


def cepstral_distance(pairs: DataFrame, clips: DataFrame, **options) -> DataFrame:
    """Pairs (a, b, keys of clips) with ``mcd``: the mean distance of cepstra along the warping path, in the usual scale; null if a clip is missing."""
    rows = _ordered(cepstra(clips, key="clip", **options), "c", "clip")
    one = rows.select(F.col("clip").alias("a"), F.col("rows").alias("_x"))
    two = rows.select(F.col("clip").alias("b"), F.col("rows").alias("_y"))
    return pairs.join(one, "a", "left").join(two, "b", "left").withColumn("mcd", _warped("_x", "_y")).select(*pairs.columns, "mcd")


@arrow_udf(DoubleType())
def _pitch(a: pa.Array, b: pa.Array) -> pa.Array:
    out = []
    for x, y in zip(a, b, strict=True):
        x, y = (np.array([v for v in (s.as_py() or []) if v is not None and v > 0 and math.isfinite(v)]) for s in (x, y))
        enough = min(len(x), len(y)) >= 5
        out.append(float(np.sqrt(np.mean([(12 * math.log2(x[i] / y[j])) ** 2 for i, j in dtw(x[:, None], y[:, None])]))) if enough else None)
    return pa.array(out, pa.float64())


def pitch_distance(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Pairs with arrays of pitches and ``f0_rmse``: semitones between voiced frames along the warping path; null under five of them on a side."""
    return pairs.withColumn("f0_rmse", _pitch(a, b))


def pooled(clips: DataFrame, groups: DataFrame, size: int = 1024, hop: int = 256, key: str = "clip", group: str = "voice") -> DataFrame:
    """group, bin and ``level``: each clip's mean power in dB, averaged over a group's clips, 0 at the group's peak.

    Frames are averaged by clip and bin, with partial sums in every task.
    """
    bins = power(framed(clips, size, hop, key=key), size).select(key, F.posexplode("power").alias("bin", "p"))
    by_clip = bins.groupBy(key, "bin").agg((10 * F.log10(F.greatest(F.avg("p"), F.lit(1e-12)))).alias("db"))
    mean = by_clip.join(groups.select(key, group), key).groupBy(group, "bin").agg(F.avg("db").alias("level"))
    return mean.withColumn("level", F.col("level") - F.max("level").over(Window.partitionBy(group)))


def cut(samples: Column, start: Column, end: Column, rate: int = RATE) -> Column:
    """The samples between two times, untrimmed."""
    first, last = F.greatest(F.floor(start * rate), F.lit(0)), F.greatest(F.floor(end * rate), F.lit(0))
    return F.slice(samples, (first + 1).cast("int"), F.greatest(last - first, F.lit(0)).cast("int"))


def without_silence(samples: Column, rate: int = RATE, threshold: float = -40.0, keep: float = 0.1) -> Column:
    """Samples without what lies more than ``keep`` seconds before the first, or after the last, above the peak's share; a clip without sound stays."""
    bound = F.array_max(F.transform(samples, F.abs)) * 10 ** (threshold / 20)
    loud = F.transform(samples, lambda x: F.abs(x) > bound)
    first, back = F.array_position(loud, F.lit(True)), F.array_position(F.reverse(loud), F.lit(True))
    pad = int(keep * rate)
    low = F.greatest(first - 1 - pad, F.lit(0))
    high = F.least(F.size(samples) - back + 1 + pad, F.size(samples))
    return F.when(first > 0, F.slice(samples, (low + 1).cast("int"), (high - low).cast("int"))).otherwise(samples)


def joined(parts: DataFrame, *order: str, key: str = "clip", samples: str = "samples", gap: float = 0.45, rate: int = RATE) -> DataFrame:
    """key and ``samples``: a key's parts in order, with a pause after each, the last included. A key is what one file holds."""
    listed = parts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, F.col(samples).alias("_part")))).alias("_parts"))
    pause = F.array_repeat(F.lit(0.0), int(gap * rate))
    return listed.select(key, F.flatten(F.transform("_parts", lambda p: F.concat(F.transform(p["_part"], lambda x: x.cast("double")), pause))).alias(samples))


def vowel_space(frames: DataFrame, regions: DataFrame, group: str = "voice") -> DataFrame:
    """group, vowel, n and the medians f1 and f2 of the frames whose formants lie in a vowel's region.

    ``regions`` has vowel, f1_low, f1_high, f2_low and f2_high (bounds included): a few rows, which are broadcast. Regions may
    overlap, and a frame then counts in each; nulls lie in none.
    """
    inside = F.col("f1").between(F.col("f1_low"), F.col("f1_high")) & F.col("f2").between(F.col("f2_low"), F.col("f2_high"))
    met = frames.select(group, "f1", "f2").join(F.broadcast(regions), inside)
    return met.groupBy(group, "vowel").agg(F.count("*").alias("n"), F.median("f1").alias("f1"), F.median("f2").alias("f2"))
