"""Spectra over frames as rows against plain NumPy over whole clips."""

import math

import numpy as np
import pytest
from clipwise.functions import signal
from clipwise.operators import spectra
from pyspark.sql import functions as F

RATE = signal.RATE


@pytest.fixture(scope="module")
def sounds():
    rnd = np.random.default_rng(2)
    t = np.arange(4000) / RATE
    return {
        1: 0.5 * np.sin(2 * np.pi * 440 * t) + 0.01 * rnd.standard_normal(4000),
        2: np.concatenate([np.zeros(1500), 0.8 * np.sin(2 * np.pi * 900 * t[:2500]), np.zeros(300)]),
        3: 0.1 * rnd.standard_normal(50),
        4: np.zeros(1200),
        5: np.zeros(0),
    }


@pytest.fixture(scope="module")
def clips(spark, sounds):
    rows = [(k, [float(x) for x in y]) for k, y in sounds.items()] + [(6, None)]
    return spark.createDataFrame(rows, "clip int, samples array<double>").repartition(3).cache()


def by_clip(df, column):
    out = {}
    for r in df.orderBy("clip", "frame").collect():
        out.setdefault(r.clip, []).append(r[column])
    return {k: np.array(v) for k, v in out.items()}


def test_spectrograms(clips, sounds):
    got = by_clip(spectra.spectrogram(clips, 256, 64, top=4000.0), "power")
    assert set(got) == {1, 2, 3, 4, 5}
    for k in (1, 2, 3):
        want = signal.spectrum_db(sounds[k], 256, 64, 4000.0).T
        assert got[k].shape == want.shape and np.allclose(np.maximum(got[k], -90), np.maximum(want, -90), atol=1e-6)
    assert np.all(got[4] == 0) or np.all(got[4] <= 0)
    wide = by_clip(spectra.spectrogram(clips, 80, 16, top=5000.0), "power")
    assert wide[1].shape == signal.wideband(sounds[1]).T.shape


def test_bands_and_cepstra(clips, sounds):
    bands = by_clip(spectra.mel(clips, 20, 256, 64), "mel")
    c = by_clip(spectra.cepstra(clips, 12, 64), "c")
    for k in (1, 2, 3):
        assert np.allclose(np.maximum(bands[k], -80), np.maximum(signal.mel_db(sounds[k], 20, 256, 64).T, -80), atol=1e-6)
        assert np.allclose(c[k], signal.mfcc(sounds[k], 12), atol=1e-6)


def test_distances(spark, clips, sounds):
    pairs = spark.createDataFrame([(1, 2), (1, 1), (2, 3), (1, 99)], "a int, b int")
    got = {(r.a, r.b): r.mcd for r in spectra.cepstral_distance(pairs, clips).collect()}
    assert got[1, 1] == 0 and got[1, 99] is None
    for a, b in ((1, 2), (2, 3)):
        assert got[a, b] == pytest.approx(signal.mcd(sounds[a], sounds[b]))
    tracks = spark.createDataFrame([(1, [100.0, None, 110.0, 120.0, 130.0, 140.0], [200.0, 220.0, 240.0, 260.0, 280.0]), (2, [1.0] * 4, [1.0] * 9), (3, None, [1.0] * 9)], "k int, a array<double>, b array<double>")
    f0 = {r.k: r.f0_rmse for r in spectra.pitch_distance(tracks).collect()}
    assert f0[1] == pytest.approx(12) and f0[2] is None and f0[3] is None
    x, y = np.array([100.0, 130.0, 150.0, 170.0, 190.0]), np.array([90.0, 100.0, 140.0, 160.0, 200.0, 210.0])
    one = spark.createDataFrame([(x.tolist(), y.tolist())], "a array<double>, b array<double>")
    assert spectra.pitch_distance(one).first().f0_rmse == pytest.approx(signal.f0_rmse(x, y))


def test_pooled_spectra(spark, clips, sounds):
    groups = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "clip int, voice string")
    got = {}
    for r in spectra.pooled(clips, groups).orderBy("bin").collect():
        got.setdefault(r.voice, []).append(r.level)
    grid = np.fft.rfftfreq(1024, 1 / RATE)
    assert np.allclose(got["x"], signal.pooled_spectrum([sounds[1], sounds[2]], grid), atol=1e-6)
    assert np.allclose(got["y"], signal.pooled_spectrum([sounds[3]], grid), atol=1e-6)


def test_cuts_and_joins(spark, clips, sounds):
    rows = clips.select("clip", spectra.without_silence(F.col("samples")).alias("t"), spectra.cut(F.col("samples"), F.lit(0.05), F.lit(0.1)).alias("c"), spectra.cut(F.col("samples"), F.lit(-1.0), F.lit(-0.5)).alias("n")).collect()
    for r in rows:
        if r.clip == 6:
            assert r.t is None and r.c is None
            continue
        y = sounds[r.clip]
        assert np.allclose(r.t, signal.trim_ends(y)) and np.allclose(r.c, signal.cut(y, 0.05, 0.1)) and r.n == []
    parts = spark.createDataFrame([(1, 2, [3.0]), (1, 1, [1.0, 2.0]), (2, 1, [])], "clip int, at int, samples array<double>")
    files = {r.clip: r.samples for r in spectra.joined(parts, "at", gap=2 / RATE).collect()}
    assert files == {1: [1.0, 2.0, 0.0, 0.0, 3.0, 0.0, 0.0], 2: [0.0, 0.0]}


def test_vowel_spaces(spark):
    frames = spark.createDataFrame([("a", 300.0, 2000.0), ("a", 320.0, 2100.0), ("a", 310.0, 900.0), ("b", None, 2000.0), ("b", 700.0, 1200.0)], "voice string, f1 double, f2 double")
    regions = spark.createDataFrame([("i", 200.0, 400.0, 1900.0, 2600.0), ("u", 200.0, 400.0, 600.0, 1000.0), ("a", 600.0, 900.0, 1000.0, 1500.0)], "vowel string, f1_low double, f1_high double, f2_low double, f2_high double")
    got = {(r.voice, r.vowel): (r.n, r.f1, r.f2) for r in spectra.vowel_space(frames, regions).collect()}
    assert got == {("a", "i"): (2, 310.0, 2050.0), ("a", "u"): (1, 310.0, 900.0), ("b", "a"): (1, 700.0, 1200.0)}
    assert math.isfinite(got["a", "i"][1])
