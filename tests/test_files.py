"""Range reads of WAV files, and the sink of one file a row."""

import struct
import wave

import numpy as np
import pytest
from clipwise.functions import signal
from clipwise.sources import audio, files
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual, In, LessThan


def write_wav(path, frames, width, channels=1, rate=8000):
    """``frames`` are whole numbers of the width, one list of channels each."""
    with wave.open(str(path), "wb") as w:
        w.setnchannels(channels), w.setsampwidth(width), w.setframerate(rate)
        w.writeframes(b"".join((v + 128).to_bytes(1, "little") if width == 1 else int(v).to_bytes(width, "little", signed=True) for f in frames for v in f))


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("wavs")
    rnd = np.random.default_rng(1)
    for width in (1, 2, 3, 4):
        top = 1 << (8 * width - 1)
        write_wav(d / f"w{width}.wav", rnd.integers(-top, top, (1000, 2)).tolist(), width, channels=2)
    data = rnd.standard_normal(500).astype("<f4")
    form = struct.pack("<HHIIHH", 3, 1, 8000, 32000, 4, 32)
    junk = b"LIST" + struct.pack("<I", 5) + b"abcde\0"
    body = b"WAVEfmt " + struct.pack("<I", 16) + form + junk + b"data" + struct.pack("<I", data.nbytes) + data.tobytes()
    (d / "float.wav").write_bytes(b"RIFF" + struct.pack("<I", len(body)) + body)
    write_wav(d / "none.wav", [], 2)
    (d / "notes.txt").write_text("no audio")
    return d


def whole(path):
    with open(path, "rb") as f:
        h = audio.header(f, path.stat().st_size)
        return audio.read_frames(f, h, 0, h.frames), h


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_every_width_equals_plain_integers(folder, width):
    with wave.open(str(folder / f"w{width}.wav")) as w:
        raw = w.readframes(1000)
    top = 1 << (8 * width - 1)
    plain = [(raw[i] - 128 if width == 1 else int.from_bytes(raw[i : i + width], "little", signed=True)) / top for i in range(0, len(raw), width)]
    y, h = whole(folder / f"w{width}.wav")
    assert (h.rate, h.channels, h.frames) == (8000, 2, 1000)
    assert np.allclose(y, np.array(plain).reshape(-1, 2).mean(axis=1), atol=1e-7)
    assert np.allclose(signal.decode((folder / f"w{width}.wav").read_bytes(), 8000), y, atol=1e-7)
    assert np.allclose(signal.decode_range((folder / f"w{width}.wav").read_bytes(), 0.01, 0.02, 8000), y[80:160], atol=1e-7)


@pytest.mark.parametrize("split", [100, 1 << 20])
def test_blocks_are_the_whole_file_once(spark, folder, split):
    rows = audio.wav_blocks(spark, str(folder), block_frames=37, split_bytes=split).collect()
    for name in ("w1", "w2", "w3", "w4", "float"):
        y, _ = whole(folder / f"{name}.wav")
        own = sorted((r.first, r.samples) for r in rows if r.file == f"{name}.wav")
        assert np.allclose(np.concatenate([s for _, s in own]), y) and [a for a, _ in own] == list(range(0, len(y), 37))
    assert {r.file for r in rows} == {"w1.wav", "w2.wav", "w3.wav", "w4.wav", "float.wav"}


def test_a_filter_decides_which_bytes_are_read(spark, folder):
    blocks = audio.wav_blocks(spark, str(folder), block_frames=10)
    part = blocks.where("file = 'w3.wav' and start >= 0.02 and start < 0.03")
    rows = part.orderBy("first").collect()
    assert [r.first for r in rows] == list(range(160, 240, 10)) and sum(r.bytes for r in rows) == 80 * 2 * 3
    y, _ = whole(folder / "w3.wav")
    assert np.allclose(np.concatenate([r.samples for r in rows]), y[160:240])
    assert blocks.where("file in ('w1.wav', 'w2.wav') and start > 0.12").agg(F.sum("bytes")).first()[0] == (1000 - 970) * 2 * (1 + 2)
    assert blocks.where("file = 'w1.wav' and file = 'w2.wav'").count() == 0


def test_pushed_filters_reach_the_reader(folder):
    reader = audio.WavReader({"path": str(folder), "blockframes": "10"})
    kept = list(reader.pushFilters([EqualTo(("file",), "w2.wav"), In(("file",), ("w2.wav", "w1.wav")), GreaterThanOrEqual(("start",), 0.05), LessThan(("start",), 0.06)]))
    assert len(kept) == 2
    parts = reader.partitions()
    assert [p[1] for part in parts for p in part.pieces] == ["w2.wav"]
    read, real = [], audio.read_frames
    try:
        audio.read_frames = lambda f, h, a, b: read.append((a, b)) or real(f, h, a, b)
        assert sum(b.num_rows for part in parts for b in reader.read(part)) == len(read)
    finally:
        audio.read_frames = real
    assert read == [(a, a + 10) for a in range(400, 481, 10)]


def test_ranges_on_request(spark, folder):
    asked = [(1, "w2.wav", 0.01, 0.02), (2, "w2.wav", 0.1, 9.0), (3, "w4.wav", 0.0, 0.0), (4, None, 0.0, 1.0), (5, "w1.wav", -1.0, 0.001), (6, "float.wav", 0.05, 0.0501)]
    df = spark.createDataFrame([(i, None if n is None else str(folder / n), a, b, "x") for i, n, a, b in asked], "id int, path string, start double, end double, rate string")
    got = {r.id: r for r in audio.read_ranges(df).collect()}
    y, _ = whole(folder / "w2.wav")
    assert np.allclose(got[1].samples, y[80:160]) and got[1].bytes == 80 * 4 and got[1].rate == 8000
    assert np.allclose(got[2].samples, y[800:]) and got[2].bytes == 200 * 4
    assert got[3].samples == [] and got[4].samples is None and len(got[6].samples) == 0
    assert len(got[5].samples) == -8000 + int(1.001 * 8000)


def test_what_isnt_pcm_raises(tmp_path):
    for content in (b"RIFF\0\0\0\0WAVE", b"no wave file at all", b"RIFF\0\0\0\0WAVEfmt " + struct.pack("<IHHIIHH", 16, 85, 1, 8000, 1, 1, 8)):
        (tmp_path / "x.wav").write_bytes(content)
        with open(tmp_path / "x.wav", "rb") as f, pytest.raises((ValueError, struct.error)):
            audio.header(f, len(content))


def test_resampling_keeps_low_tones_and_drops_high_ones():
    t = np.arange(48_000) / 48_000
    low, high = np.sin(2 * np.pi * 1000 * t), np.sin(2 * np.pi * 11_000 * t)
    down = signal.resample((low + high).astype(np.float32), 48_000, 16_000)
    want = np.sin(2 * np.pi * 1000 * np.arange(16_000) / 16_000)
    assert len(down) == 16_000 and np.abs(down - want)[200:-200].max() < 0.01
    up = signal.resample(down, 16_000, 48_000)
    assert len(up) == 48_000 and np.abs(up - low)[600:-600].max() < 0.01


def listing(folder):
    return {f.name: f.read_bytes() for f in folder.iterdir()}


def rows(spark, names):
    return spark.createDataFrame([(n, n.encode() if n else None) for n in names], "name string, content binary").repartition(3)


def test_a_rerun_leaves_exactly_the_new_files(spark, tmp_path):
    out = tmp_path / "clips"
    files.write_files(rows(spark, ["a", "b", "ü c"]), str(out))
    assert listing(out) == {n: n.encode() for n in ("a", "b", "ü c")}
    files.write_files(rows(spark, ["b", "d"]), str(out))
    assert listing(out) == {n: n.encode() for n in ("b", "d")}
    files.write_files(rows(spark, ["e"]), str(out), mode="append")
    assert set(listing(out)) == {"b", "d", "e"}
    files.write_files(rows(spark, ["z"]).where("false"), str(out))
    assert listing(out) == {} and [f.name for f in tmp_path.iterdir()] == ["clips"]


@pytest.mark.parametrize("bad", [["a", "x/y"], ["a", None], ["a", "a"], ["a", "_temporary"]])
def test_a_failed_job_leaves_the_old_files(spark, tmp_path, bad):
    out = tmp_path / "clips"
    files.write_files(rows(spark, ["old"]), str(out))
    with pytest.raises(Exception, match="named|name can't"):
        files.write_files(rows(spark, bad), str(out))
    assert listing(out) == {"old": b"old"} and [f.name for f in tmp_path.iterdir()] == ["clips"]


def test_a_failed_attempt_isnt_taken(tmp_path, monkeypatch):
    """The first attempt breaks off after a file, the second one ends."""
    import pyarrow as pa

    class Task:
        attempt = 0

        def partitionId(self):
            return 0

        def attemptNumber(self):
            return self.attempt

    task = Task()
    monkeypatch.setattr(files, "TaskContext", type("T", (), {"get": staticmethod(lambda: task)}))
    writer = files.FileWriter({"path": str(tmp_path / "clips")}, overwrite=True)
    batch = pa.record_batch([["a"], pa.array([b"1"])], ["name", "content"])

    def broken():
        yield batch
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        writer.write(broken())
    task.attempt = 1
    writer.commit([writer.write(iter([pa.record_batch([["b"], pa.array([b"2"])], ["name", "content"])])), None])
    assert listing(tmp_path / "clips") == {"b": b"2"} and [f.name for f in tmp_path.iterdir()] == ["clips"]


def test_copies_under_other_names(spark, tmp_path):
    files.write_files(rows(spark, ["a", "b"]), str(tmp_path / "clips"))
    found = spark.read.format("binaryFile").load(str(tmp_path / "clips")).select("path")
    named = found.withColumn("name", F.concat(F.substring(F.md5(F.element_at(F.split("path", "/"), -1)), 1, 8), F.lit(".wav")))
    files.copy_files(named, str(tmp_path / "clips"), str(tmp_path / "blind"))
    assert sorted(listing(tmp_path / "blind").values()) == [b"a", b"b"] and all(len(n) == 12 for n in listing(tmp_path / "blind"))


def test_names_of_all_files(spark, tmp_path):
    (tmp_path / "a" / "deep").mkdir(parents=True)
    for name, content in (("x.wav", b""), ("a/y.wav", b"12"), ("a/deep/z.txt", b"3")):
        (tmp_path / name).write_bytes(content)
    assert sorted((r.name, r.bytes) for r in files.file_names(spark, str(tmp_path)).collect()) == [("x.wav", 0), ("y.wav", 2), ("z.txt", 1)]
    assert [r.name for r in files.file_names(spark, f"{tmp_path}/*.txt").collect()] == ["z.txt"]
