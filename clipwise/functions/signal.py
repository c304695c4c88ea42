"""Signal features of waveforms in NumPy, for use in Arrow batches; one clip fits in memory, and none is shuffled."""

from __future__ import annotations

import io
import math
import wave
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, FloatType

from .edits import dtw

RATE = 16_000
FEATURES = "rms double, peak double, lead double, trail double, duration double"


def pcm(raw: bytes, width: int, floating: bool = False) -> np.ndarray:
    """Samples between -1 and 1 of little-endian PCM: 8 (unsigned), 16, 24 or 32 bits, or floats of 32 or 64."""
    if floating:
        return np.frombuffer(raw, {4: "<f4", 8: "<f8"}[width]).astype(np.float32)
    if width == 1:
        return (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
    if width == 3:
        wide = np.zeros((len(raw) // 3, 4), np.uint8)
        wide[:, 1:] = np.frombuffer(raw, np.uint8).reshape(-1, 3)  # the upper bytes of a 32-bit sample
        return wide.view("<i4").ravel().astype(np.float32) / float(1 << 31)
    return np.frombuffer(raw, {2: "<i2", 4: "<i4"}[width]).astype(np.float32) / float(1 << (8 * width - 1))


def decode(data: bytes, rate: int = RATE) -> np.ndarray:
    """Mono float samples of a PCM WAV file at ``rate``: channels are averaged, other rates resampled."""
    with wave.open(io.BytesIO(data)) as w:
        width, channels, own, raw = w.getsampwidth(), w.getnchannels(), w.getframerate(), w.readframes(w.getnframes())
    return resample(pcm(raw, width).reshape(-1, channels).mean(axis=1, dtype=np.float32), own, rate)


def decode_range(data: bytes, start: float, end: float, rate: int = RATE) -> np.ndarray:
    """The samples between two times of a PCM WAV file in memory; only that part is decoded. ``audio.read_ranges`` reads files."""
    with wave.open(io.BytesIO(data)) as w:
        own, channels = w.getframerate(), w.getnchannels()
        first, last = max(0, int(start * own)), min(w.getnframes(), int(end * own))
        w.setpos(min(first, w.getnframes()))
        y = pcm(w.readframes(max(0, last - first)), w.getsampwidth())
    return resample(y.reshape(-1, channels).mean(axis=1, dtype=np.float32), own, rate)


def resample(y: np.ndarray, own: int, rate: int, *, lobes: int = 16, block: int = 1 << 15) -> np.ndarray:
    """Band-limited resampling: a sinc of ``lobes`` lobes a side under a Hann window, cut off at the lower of both rates.

    Frequencies that the new rate can't hold are filtered out, not folded back. Works in blocks of outputs.
    """
    if own == rate or not len(y):
        return y
    g = math.gcd(own, rate)
    n = max(1, round(len(y) * (rate // g) / (own // g)))
    cutoff = min(1.0, rate / own)
    reach = math.ceil(lobes / cutoff)
    padded = np.pad(y.astype(np.float64), reach)
    around = np.arange(-reach, reach + 1)
    out = np.empty(n, np.float32)
    for a in range(0, n, block):
        at = np.arange(a, min(n, a + block)) * (own / rate)
        near = np.floor(at).astype(int)
        x = (around[None, :] - (at - near)[:, None]) * cutoff
        weights = np.sinc(x) * np.where(np.abs(x) < lobes, 0.5 + 0.5 * np.cos(np.pi * x / lobes), 0.0)
        weights /= weights.sum(axis=1, keepdims=True)
        taken = np.minimum(near[:, None] + reach + around[None, :], len(padded) - 1)
        out[a : a + block] = (padded[taken] * weights).sum(axis=1)
    return out


def encode(y: np.ndarray, rate: int = RATE) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1), w.setsampwidth(2), w.setframerate(rate)
        w.writeframes((np.clip(y, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def frames(y: np.ndarray, size: int, hop: int, center: bool = True) -> np.ndarray:
    y = np.pad(y, size // 2) if center else y
    if len(y) < size:
        y = np.pad(y, (0, size - len(y)))
    return np.lib.stride_tricks.sliding_window_view(y, size)[::hop]


def rms_db(y: np.ndarray, size: int = 1024, hop: int = 256, floor: float = 80.0) -> np.ndarray:
    """Frame energy in dB below the loudest frame."""
    e = np.sqrt((frames(y, size, hop) ** 2).mean(axis=1))
    top = max(float(e.max(initial=0)), 1e-10)
    return np.maximum(20 * np.log10(np.maximum(e, 1e-10) / top), -floor)


def edges(y: np.ndarray, rate: int = RATE, threshold: float = -40.0, hop: int = 256) -> tuple[float, float] | None:
    """Silence before the first and after the last frame above the threshold; None if there is no sound."""
    if not len(y) or not np.abs(y).max():
        return None
    loud = np.flatnonzero(rms_db(y, hop=hop) > threshold)
    return (loud[0] * hop / rate, max(0.0, len(y) / rate - loud[-1] * hop / rate)) if len(loud) else None


def trim_tail(y: np.ndarray, rate: int = RATE, threshold: float = -40.0, keep: float = 0.5) -> np.ndarray:
    """Cuts what follows the last sample above the peak's share, but for ``keep`` seconds."""
    peak = np.abs(y).max(initial=0)
    loud = np.flatnonzero(np.abs(y) > peak * 10 ** (threshold / 20))
    return y[: loud[-1] + 1 + int(keep * rate)] if len(loud) else y


def trim_ends(y: np.ndarray, rate: int = RATE, threshold: float = -40.0, keep: float = 0.1) -> np.ndarray:
    """Cuts silence from both ends but for ``keep`` seconds; a clip without sound stays as it is."""
    peak = np.abs(y).max(initial=0)
    loud = np.flatnonzero(np.abs(y) > peak * 10 ** (threshold / 20))
    pad = int(keep * rate)
    return y[max(0, loud[0] - pad) : loud[-1] + 1 + pad] if len(loud) else y


def cut(y: np.ndarray, start: float, end: float, rate: int = RATE) -> np.ndarray:
    """The samples between two times, untrimmed."""
    return y[max(0, int(start * rate)) : max(0, int(end * rate))]


def normalise(y: np.ndarray, to: float = 0.95) -> np.ndarray:
    peak = np.abs(y).max(initial=0)
    return y if peak <= 1e-6 else y * (to / peak)


def join(parts: list[np.ndarray], gap: float = 0.45, rate: int = RATE) -> np.ndarray:
    """Parts with a pause after each, the last included."""
    silence = np.zeros(int(gap * rate), np.float32)
    return np.concatenate([x for p in parts for x in (p, silence)]) if parts else silence[:0]


def spectrum_db(y: np.ndarray, size: int = 1024, hop: int = 256, top: float = 8000.0, rate: int = RATE) -> np.ndarray:
    """Magnitudes in dB below the largest, frequency by time, up to ``top`` Hz."""
    s = np.abs(np.fft.rfft(frames(y, size, hop) * np.hanning(size), axis=1)).T
    s = s[: int(top * size / rate) + 1]
    return 20 * np.log10(np.maximum(s, 1e-10) / max(float(s.max(initial=0)), 1e-10))


def wideband(y: np.ndarray, rate: int = RATE) -> np.ndarray:
    """Spectrogram of 5 ms windows, up to 5 kHz: formants."""
    return spectrum_db(y, int(0.005 * rate), int(0.001 * rate), 5000.0, rate)


def narrowband(y: np.ndarray, rate: int = RATE) -> np.ndarray:
    """Spectrogram of 64 ms windows, up to 8 kHz: harmonics."""
    return spectrum_db(y, 1024, 256, 8000.0, rate)


def pooled_spectrum(clips: list[np.ndarray], grid: np.ndarray, size: int = 1024, rate: int = RATE) -> np.ndarray:
    """Mean spectrum in dB of several clips on a grid of frequencies: over frames, then over clips, then 0 at its peak."""
    f = np.fft.rfftfreq(size, 1 / rate)
    means = []
    for y in clips:
        s = np.abs(np.fft.rfft(frames(y, size, size // 4) * np.hanning(size), axis=1)) ** 2
        means.append(np.interp(grid, f, 10 * np.log10(np.maximum(s.mean(axis=0), 1e-12))))
    pooled = np.mean(means, axis=0)
    return pooled - pooled.max()


def mel_filters(n: int, size: int, rate: int = RATE) -> np.ndarray:
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    points = 700 * (10 ** (np.linspace(0, mel(rate / 2), n + 2) / 2595) - 1)
    f = np.fft.rfftfreq(size, 1 / rate)
    up = (f - points[:-2, None]) / np.diff(points)[:-1, None]
    down = (points[2:, None] - f) / np.diff(points)[1:, None]
    return np.maximum(0, np.minimum(up, down))


def mel_db(y: np.ndarray, n: int = 64, size: int = 1024, hop: int = 256, rate: int = RATE) -> np.ndarray:
    power = np.abs(np.fft.rfft(frames(y, size, hop) * np.hanning(size), axis=1)) ** 2
    m = mel_filters(n, size, rate) @ power.T
    return 10 * np.log10(np.maximum(m, 1e-10) / max(float(m.max(initial=0)), 1e-10))


def mfcc(y: np.ndarray, n: int = 25, mels: int = 64) -> np.ndarray:
    """Cepstral coefficients 1 to n-1, a row for each frame."""
    m = np.maximum(mel_db(y, mels), -80)
    k = np.arange(n)[:, None] * (2 * np.arange(mels) + 1)[None] * (np.pi / (2 * mels))
    basis = np.cos(k) * np.sqrt(2 / mels)
    return (basis @ m)[1:].T


def mcd(a: np.ndarray, b: np.ndarray) -> float:
    """Mean distance of cepstra along the warping path, in the usual scale; comparable only with itself."""
    x, y = mfcc(a), mfcc(b)
    d = [np.linalg.norm(x[i] - y[j]) for i, j in dtw(x, y)]
    return float(10 / math.log(10) * math.sqrt(2) * np.mean(d))


def f0_rmse(a: np.ndarray, b: np.ndarray) -> float | None:
    """Root mean square of semitone differences of voiced frames, aligned; None under five voiced frames on a side."""
    a, b = a[np.isfinite(a)], b[np.isfinite(b)]
    if min(len(a), len(b)) < 5:
        return None
    d = [12 * math.log2(a[i] / b[j]) for i, j in dtw(a[:, None], b[:, None])]
    return float(np.sqrt(np.mean(np.square(d))))


def spectrum_distance(a: np.ndarray, b: np.ndarray) -> float:
    """One less Pearson's correlation of two mean spectra."""
    return float(1 - np.corrcoef(a, b)[0, 1])


def quantised(m: np.ndarray) -> np.ndarray:
    return (np.clip(m, 0, 1) * 255).astype(np.uint8)


@pandas_udf(ArrayType(FloatType()))
def wav_samples(data: pd.Series) -> pd.Series:
    return data.map(lambda b: None if b is None else decode(b))


@pandas_udf(BinaryType())
def wav_bytes(samples: pd.Series) -> pd.Series:
    """A 16-bit WAV file of each row's samples."""
    return samples.map(lambda y: None if y is None else encode(np.asarray(y, np.float32)))


@pandas_udf(DoubleType())
def wav_duration(data: pd.Series) -> pd.Series:
    """Seconds, from the header alone."""

    def one(b: bytes | None) -> float | None:
        if b is None:
            return None
        with wave.open(io.BytesIO(b)) as w:
            return w.getnframes() / w.getframerate()

    return data.map(one)


def clip_features(clips: DataFrame, samples: str = "samples") -> DataFrame:
    """Adds rms, peak, lead, trail (null without sound) and duration to rows with an array of samples."""
    keep = [c for c in clips.columns if c != samples]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in clips.select(*keep).schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for x in batch.column(batch.schema.get_field_index(samples)):
                y = np.asarray(x.values.to_numpy(zero_copy_only=False) if x.is_valid else [], np.float64)
                e = edges(y) or (None, None)
                rows.append((float(np.sqrt((y**2).mean())) if len(y) else None, float(np.abs(y).max(initial=0)), *e, len(y) / RATE))
            cols = [batch.column(batch.schema.get_field_index(c)) for c in keep]
            new = [pa.array(c, pa.float64()) for c in (zip(*rows, strict=True) if rows else [[]] * 5)]
            yield pa.record_batch([*cols, *new], [*keep, "rms", "peak", "lead", "trail", "duration"])

    return clips.mapInArrow(run, f"{schema}, {FEATURES}" if keep else FEATURES)
