"""Data sources over parts of files against whole-file readers, and the ordered sink."""

import io
import struct
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators.audio import frame_length
from cadenza.operators import saliency
from cadenza.operators import media as containers
from cadenza.sources import media, ordered, samples, sinks, streams
from cadenza.sources.ordered import write_ordered


def wav_file(path, x, rate, width=2):
    with wave.open(str(path), "wb") as w:
        w.setnchannels(x.shape[1])
        w.setsampwidth(width)
        w.setframerate(rate)
        if width == 1:
            raw = (x + 128).astype(np.uint8).tobytes()
        elif width == 3:
            raw = x.astype("<i4").ravel().view(np.uint8).reshape(-1, 4)[:, :3].tobytes()
        else:
            raw = x.astype(f"<i{width}").tobytes()
        w.writeframes(raw)


def rows_of(df):
    return sorted((r.path.split("/")[-1], r.channel, r.block_start, r.sample_rate, r.bits, tuple(r.samples)) for r in df.collect())


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_wav_parts_equal_whole_files(spark, tmp_path, width):
    rng = np.random.default_rng(width)
    half = 2 ** (8 * width - 1)
    wav_file(tmp_path / "long.wav", rng.integers(-half, half, (70_000, 2)), 1000, width)  # blocks of 10,000 samples
    wav_file(tmp_path / "short.wav", rng.integers(-half, half, (30, 1)), 1000, width)
    wav_file(tmp_path / "none.wav", np.zeros((0, 1)), 1000, width)
    for scale in ("full", "bit_depth"):
        got = samples.audio_source(spark, str(tmp_path), scale, split_bytes=50_000)
        assert got.rdd.getNumPartitions() > 2
        assert rows_of(got) == rows_of(media.audio_blocks(media.files(spark, str(tmp_path), "*.wav"), scale=scale))


def test_filters_reach_the_source(spark, tmp_path):
    wav_file(tmp_path / "a.wav", np.arange(140_000).reshape(-1, 2) % 1000, 1000)
    wav_file(tmp_path / "b.wav", np.zeros((10, 1)), 1000)
    df = samples.audio_source(spark, str(tmp_path), split_bytes=1 << 16)
    some = df.where((F.col("block_start") >= 20_000) & (F.col("block_start") < 40_000) & (F.col("channel") == 1))
    assert sorted((r.channel, r.block_start) for r in some.collect()) == [(1, 20_000), (1, 30_000)]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Filter" not in plan.replace("RuntimeFilters", "")
    assert df.where(F.col("path") == f"{tmp_path}/b.wav").count() == 1
    assert df.where(F.col("channel").isin(1, 5) & (F.col("sample_rate") > 5)).count() == 7
    places = samples.audio_source(spark, str(tmp_path), samples=False)
    assert places.where("samples is null").count() == 15


def test_wide_and_odd_headers(tmp_path):
    data = np.arange(6, dtype="<i2").tobytes()
    fmt = struct.pack("<HHIIHH", 0xFFFE, 1, 8000, 16000, 2, 16) + struct.pack("<HHI", 22, 16, 0) + struct.pack("<H", 1) + b"\0" * 14
    odd = b"RF64" + b"\xff" * 4 + b"WAVE" + b"ds64" + struct.pack("<IQQQI", 28, 0, len(data), 6, 0) + b"JUNK" + struct.pack("<I", 3) + b"abc\0" + b"fmt " + struct.pack("<I", len(fmt)) + fmt + b"data" + b"\xff" * 4 + data + b"LIST"

    class File(io.BytesIO):
        def size(self):
            return len(self.getbuffer())

    w = samples.Wav(File(odd), "bit_depth")
    assert (w.length, w.rate, w.bits) == (6, 8000, 16) and (w.part(2, 5).ravel() * 32768).tolist() == [2, 3, 4]
    cut = samples.Wav(File(odd.replace(b"RF64", b"RIFF").replace(b"ds64", b"junk")), "full")
    assert cut.length == 8  # a stream of unknown length: to the end of the file
    for bad in (b"", b"RIFF....WAVE", odd[:20] + b"x", odd.replace(struct.pack("<H", 1) + b"\0" * 14, struct.pack("<H", 3) + b"\0" * 14)):
        with pytest.raises((ValueError, struct.error)):
            samples.Wav(File(bad), "full")


def test_bad_files_are_named(spark, tmp_path):
    (tmp_path / "x.wav").write_bytes(b"nothing")
    with pytest.raises(Exception, match="x.wav: no WAV file"):
        samples.audio_source(spark, str(tmp_path)).collect()
    (tmp_path / "empty").mkdir()
    assert samples.audio_source(spark, f"{tmp_path}/empty").collect() == []


def test_npy_parts_equal_whole_files(spark, tmp_path):
    rng = np.random.default_rng(5)
    size = frame_length(2000) * 400
    np.save(tmp_path / "mono.npy", rng.normal(size=3 * size + 7).astype("float32"))
    np.save(tmp_path / "rows.npy", rng.normal(size=(3, 2 * size + 1)))
    np.save(tmp_path / "columns.npy", np.asfortranarray(rng.normal(size=(2, size + 5))))
    np.save(tmp_path / "ints.npy", rng.integers(-9, 9, 50))
    got = rows_of(samples.npy_source(spark, str(tmp_path), 2000, split_bytes=100_000))
    want = rows_of(media.npy_blocks(media.files(spark, str(tmp_path), "*.npy"), 2000))
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert all(np.allclose(g[5], w[5], rtol=1e-6, atol=1e-7) for g, w in zip(got, want, strict=True))


def test_three_gigabytes_in_many_tasks(spark, tmp_path):
    """A file larger than a row may be: only the blocks that are asked for are read."""
    rate, n = 48_000, 1_500_000_123
    size = frame_length(rate) * 400
    with open(tmp_path / "huge.wav", "wb") as f:
        f.write(b"RIFF" + struct.pack("<I", 2 * n + 36) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, rate, 2 * rate, 2, 16) + b"data" + struct.pack("<I", 2 * n))
        f.truncate(44 + 2 * n)
        for block in (0, 1000, n // size):
            f.seek(44 + 2 * block * size)
            f.write(np.full(100, block % 30_000 + 1, "<i2").tobytes())
    df = samples.audio_source(spark, str(tmp_path), "bit_depth", split_bytes=256 << 20)
    assert df.rdd.getNumPartitions() == 12
    places = samples.audio_source(spark, str(tmp_path), samples=False).agg(F.count("*"), F.max("block_start")).first()
    assert tuple(places) == (-(-n // size), n // size * size)
    few = df.where(F.col("block_start").isin(0, 1000 * size, n // size * size, 7 * size))
    got = {r.block_start // size: (r.n, r.s * 32768) for r in few.select("block_start", F.size("samples").alias("n"), F.aggregate("samples", F.lit(0.0), lambda a, x: a + x).alias("s")).collect()}
    assert got == {0: (size, 100.0), 7: (size, 0.0), 1000: (size, 100_100.0), n // size: (n % size, 100.0 * (n // size % 30_000 + 1))}


# --- sinks -------------------------------------------------------------------------------------------------------

CHUNKS = "chunk_index long, start_sec double, end_sec double, predicted_emotion string, emotion_probs array<double>"
# Rows as the public table has them.
EMOTIONS = """chunk_index,start_sec,end_sec,predicted_emotion,emotion_probs
0,0.0,5.0,sad,"[0.29419443011283875, 0.04134177416563034, 0.010769793763756752, 0.6536939740180969]"
1,5.0,10.0,neutral,"[0.7422272562980652, 0.029776480048894882, 0.19770225882530212, 0.030294019728899002]"
2,10.0,15.0,sad,"[0.08491019159555435, 0.011385003104805946, 0.002437582239508629, 0.9012671709060669]"
"""


def test_emotions_are_written_as_they_were_read(spark, tmp_path):
    text = EMOTIONS + '3,15.0,273.941375,happy,"[0.0002505405282136053, 0.9997494594717864, 1e-05, 0.0]"\n'
    (tmp_path / "in.csv").write_text(text)
    rows = media.emotion_csv(spark, str(tmp_path / "in.csv")).repartition(3)
    sinks.write_emotions(rows, str(tmp_path / "out.csv"))
    assert (tmp_path / "out.csv").read_bytes() == text.encode()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sinks.write_emotions(rows, str(tmp_path / "out"), parts=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = sorted((tmp_path / "out").iterdir())
    assert [p.name for p in parts] == [f"part-{k:05d}.csv" for k in range(len(parts))] and len(parts) > 1
    assert EMOTIONS.splitlines()[0] + "\n" + "".join(p.read_text().split("\n", 1)[1] for p in parts) == text
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_")]


def test_words_and_gaze_as_text(spark, tmp_path):
    words = spark.createDataFrame([(1, 12.4, "d'or"), (0, 0.2, "a, b"), (2, 0.00005, 'say "é"')], "n long, time_sec double, word string")
    sinks.write_words(words, str(tmp_path / "w"))
    assert (tmp_path / "w").read_bytes().decode() == 'time_sec,word\r\n0.2000,"a, b"\r\n12.4000,d\'or\r\n0.0001,"say ""é"""\r\n'
    names = [*saliency.ORDER, *(f"{c}_smooth" for c in saliency.SMOOTHED if f"{c}_smooth" not in saliency.ORDER)]
    value = lambda c: c == "is_high_motion" if c.startswith("is_") else 3 if c == "frame_idx" else 2e-05 if c == "mean_saliency" else 0.5
    kind = lambda c: "boolean" if c.startswith("is_") else "long" if c == "frame_idx" else "double"
    gaze = spark.createDataFrame([tuple(map(value, names))], ", ".join(f"{c} {kind(c)}" for c in names))
    sinks.write_gaze(gaze.select(*sorted(names)), str(tmp_path / "g"))
    head, line = (tmp_path / "g").read_text().splitlines()
    assert head.split(",") == names and len(names) == 25
    cells = dict(zip(names, line.split(","), strict=True))
    assert (cells["mean_saliency"], cells["frame_idx"], cells["is_high_motion"], cells["is_high_saliency"], cells["time_sec"]) == ("2e-05", "3", "True", "False", "0.5")


def test_levels_and_pitch_as_text(spark, tmp_path):
    rows = spark.createDataFrame([(0, 0.0, 100.126, 1.0, 2.0, 0.1234567, 0.5), (1, 0.0, 1.0, 1.0, 2.0, 0.0, 0.25), (0, 0.025, 2.675, 0.125, 2.0, 0.0, 0.25)], "channel int, time_sec double, " + ", ".join(f"{c} double" for c in sinks.SPECTRAL))
    sinks.write_channels(rows, [0, 1], sinks.SPECTRAL, str(tmp_path / "s"))
    lines = (tmp_path / "s").read_text().splitlines()
    assert lines[0] == "time_sec," + ",".join(f"chan{k}_{c}" for k in (1, 2) for c in sinks.SPECTRAL)
    assert lines[1:] == ["0.0000,100.13,1.00,2.00,0.123457,0.500000,1.00,1.00,2.00,0.000000,0.250000", "0.0250,2.67,0.12,2.00,0.000000,0.250000,,,,,"]
    pitch = spark.createDataFrame([(0, 0, 0.0, 100.0), (0, 1, 5.02, None), (0, 2, 5.0, 99.999), (1, 0, 0.0, 50.004)], "channel int, idx long, time_sec double, pitch_hz double")
    sinks.write_pitch(pitch, [0, 1], str(tmp_path / "p"))
    assert (tmp_path / "p").read_text() == "time_sec,chan1_pitch_hz,chan2_pitch_hz\n0.0000,100.00,50.00\n5.0200,,no data\n5.0000,100.00,no data\n"


def test_a_failed_job_leaves_what_was_there(spark, tmp_path):
    rows = spark.range(100).repartition(4)
    write_ordered(rows, str(tmp_path / "t"), ["id"])
    whole = (tmp_path / "t").read_text()
    assert whole == "id\n" + "".join(f"{k}\n" for k in range(100))
    bad = rows.withColumn("id", F.when(F.col("id") == 77, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        write_ordered(bad, str(tmp_path / "t"), ["id"])
    assert (tmp_path / "t").read_text() == whole and [p.name for p in tmp_path.iterdir()] == ["t"]
    write_ordered(rows.where("id < 0"), str(tmp_path / "t"), ["id"])
    assert (tmp_path / "t").read_text() == "id\n"


def test_retried_tasks_leave_no_rows_twice(tmp_path):
    """Two attempts of one task, of which the first fails midway and the third is a copy that isn't committed."""
    w = ordered._Writer({"path": str(tmp_path / "t")}, ["a", "b"])

    def broken():
        yield (1, "x")
        raise RuntimeError("lost executor")

    with pytest.raises(RuntimeError):
        w.write(broken())
    first, copy = w.write(iter([(1, "x"), (2, None)])), w.write(iter([(1, "x"), (2, None)]))
    later = w.write(iter([(3, "y\n")]))
    later.task = 1
    assert first.name != copy.name
    w.commit([later, None, first])
    assert (tmp_path / "t").read_text() == 'a,b\n1,x\n2,\n3,"y\n"\n' and [p.name for p in tmp_path.iterdir()] == ["t"]


# --- headers -----------------------------------------------------------------------------------------------------


def box(kind, *parts, wide=False):
    body = b"".join(parts)
    return struct.pack(">I4sQ", 1, kind, 16 + len(body)) + body if wide else struct.pack(">I4s", 8 + len(body), kind) + body


def track(handler, codec, scale, length, rate=0, channels=0, version=0):
    times = struct.pack(">QQIQ", 0, 0, scale, length) if version else struct.pack(">IIII", 0, 0, scale, length)
    entry = struct.pack(">I4s6xH", 36, codec, 1) + struct.pack(">HHI", 0, 0, 0) + struct.pack(">HHII", channels, 16, 0, rate << 16)
    tables = box(b"stbl", box(b"stsd", struct.pack(">II", 0, 1), entry), box(b"stsz", bytes(200_000)))
    return box(b"trak", box(b"tkhd", bytes(84)), box(b"mdia", box(b"mdhd", bytes([version, 0, 0, 0]), times), box(b"hdlr", bytes(8), handler, bytes(13)), box(b"minf", box(b"smhd", bytes(8)), tables)))


def mp4(before=0, *tracks, after=b"", wide=False):
    """(bytes before the samples, bytes after them)."""
    head = box(b"ftyp", b"isom" + bytes(12))
    return head + struct.pack(">I4sQ", 1, b"mdat", 16 + before), box(b"moov", box(b"mvhd", bytes(4), struct.pack(">IIII", 0, 0, 600, 0), bytes(80)), *tracks, after, wide=wide)


def write_long(path, head, gap, tail):
    with open(path, "wb") as f:
        f.write(head)
        f.seek(len(head) + gap)
        f.write(tail)


def test_streams_of_headers(spark, tmp_path):
    gap = 6_000_000_000  # sparse
    write_long(tmp_path / "film.mp4", *(lambda h, t: (h, gap, t))(*mp4(gap, track(b"vide", b"avc1", 15, 150), track(b"soun", b"mp4a", 48000, 48000 * 3600, 48000, 2), track(b"soun", b"mp4a", 22050, 22050 * 12 + 20000, 22050, 1, version=1), track(b"text", b"tx3g", 1000, 5000), wide=True)))
    fragments = mp4(0, track(b"soun", b"Opus", 48000, 0, 48000, 2), after=box(b"mvex", box(b"mehd", bytes(4), struct.pack(">I", 600 * 90))))
    (tmp_path / "live.mp4").write_bytes(fragments[0] + fragments[1] + box(b"moof", bytes(100)))
    wav_file(tmp_path / "a.wav", np.zeros((24_000, 2)), 16_000, 3)
    samples_36 = 22_050 * 7
    (tmp_path / "b.flac").write_bytes(b"fLaC" + bytes([0x80, 0, 0, 34]) + bytes(10) + ((22_050 << 44) | (1 << 41) | (15 << 36) | samples_36).to_bytes(8, "big") + bytes(16) + bytes(1000))
    (tmp_path / "c.mp4").write_bytes(mp4(0, track(b"vide", b"avc1", 15, 150))[0] + mp4(0, track(b"vide", b"avc1", 15, 150))[1])
    (tmp_path / "cut.mp4").write_bytes(fragments[0] + fragments[1][:500])
    (tmp_path / "note.txt").write_text("nothing of the kind")
    (tmp_path / "void.wav").write_bytes(b"")
    found = streams.media_streams(spark, str(tmp_path))
    rows = {(r.path.split("/")[-1], r.stream_index): r for r in found.collect()}
    about = {k: (r.kind, r.codec, r.sample_rate, r.channels, r.duration) for k, r in rows.items() if r.problem is None}
    assert about == {
        ("film.mp4", 0): ("video", "avc1", None, None, 10.0),
        ("film.mp4", 1): ("audio", "mp4a", 48000, 2, 3600.0),
        ("film.mp4", 2): ("audio", "mp4a", 22050, 1, 12 + 20000 / 22050),
        ("film.mp4", 3): ("other", "tx3g", None, None, 5.0),
        ("live.mp4", 0): ("audio", "Opus", 48000, 2, 90.0),
        ("a.wav", 0): ("audio", "pcm_s24le", 16000, 2, 1.5),
        ("b.flac", 0): ("audio", "flac", 22050, 2, 7.0),
        ("c.mp4", 0): ("video", "avc1", None, None, 10.0),
    }
    assert {k[0] for k, r in rows.items() if r.problem is not None} == {"cut.mp4", "note.txt", "void.wav"}
    assert max(r.bytes_read for r in rows.values()) < 2048
    counts = {r.path.split("/")[-1]: r.streams for r in streams.audio_counts(found).collect()}
    assert counts == {"film.mp4": 2, "live.mp4": 1, "a.wav": 1, "b.flac": 1, "c.mp4": 0, "cut.mp4": 0, "note.txt": 0, "void.wav": 0}
    sizes = {(r.path.split("/")[-1], r.stream_index): (r.duration_sec, r.total_mb) for r in containers.size_estimates(containers.probed(streams.audio_streams(found))).collect()}
    assert sizes == {("film.mp4", 0): (3600, 289), ("film.mp4", 1): (12, 0), ("live.mp4", 0): (90, 5), ("a.wav", 0): (1, 0), ("b.flac", 0): (7, 0)}
    names = {r.output for r in containers.audio_manifest(streams.audio_streams(found), "out").collect()}
    assert "out/film_stream1_emotion.flac" in names and len(names) == 25
