"""Known answers on small inputs, against numpy and pandas."""

import io
import wave

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.functions import arrays as A
from cadenza.functions import text as X
from cadenza.operators import audio, media, models, pitch, plotting, resampling, saliency, timeline, transcript
from cadenza.operators import sequence as S
from cadenza.sources import media as sources
from cadenza.sources import sinks
from cadenza.streaming.frames import stream_levels


def frame_row(spark, x):
    return spark.createDataFrame([([float(v) for v in x],)], "v array<double>")


@pytest.mark.parametrize("rate, frame, fft", [(16000, 400, 512), (22050, 551, 1024), (44100, 1102, 2048), (48000, 1200, 2048)])
def test_frame_sizes(rate, frame, fft):
    assert audio.frame_length(rate) == frame
    assert A.next_power_of_two(frame) == fft


def test_rate_without_frames_is_refused():
    with pytest.raises(ValueError):
        audio.frame_length(39)


def test_spectrum_of_a_tone(spark):
    rate, n = 16000, 512
    x = np.sin(2 * np.pi * 2000 * np.arange(n) / rate)
    got = audio.spectral_features(frame_row(spark, x), "v", rate, n).first()
    w = x * (0.54 - 0.46 * np.cos(2 * np.pi * np.arange(n) / (n - 1)))
    m, f = np.abs(np.fft.fft(w))[: n // 2], np.arange(n // 2) * rate / n
    c = (f * m).sum() / m.sum()
    assert got.spectral_centroid == pytest.approx(c)
    assert got.spectral_rolloff == pytest.approx(f[np.argmax(np.cumsum(m**2) >= 0.85 * (m**2).sum())])
    assert got.spectral_bandwidth == pytest.approx(np.sqrt((m * (f - c) ** 2).sum() / m.sum()))
    assert got.spectral_flatness == pytest.approx(np.exp(np.log(m).mean()) / m.mean(), rel=1e-6)
    assert got.zero_crossing_rate == pytest.approx(((x[1:] >= 0) != (x[:-1] >= 0)).mean())


def test_silence_is_all_zero(spark):
    got = audio.spectral_features(frame_row(spark, np.zeros(64)), "v", 16000, 64).drop("v").first()
    assert set(got) == {0.0}


def test_one_sample_has_no_crossing(spark):
    assert frame_row(spark, [3.0]).select(A.zero_crossing_rate(F.col("v"))).first()[0] == 0.0


def test_map_without_mass(spark):
    row = saliency.map_stats(frame_row(spark, np.zeros(12)), "v", 4, 3).first()
    assert (row.attention_center_x, row.attention_center_y, row.attention_concentration, row.top10_saliency_mass) == (0.5, 0.5, 0.0, 0.0)


def test_snap_is_half_even(spark):
    df = spark.createDataFrame([(t,) for t in (0.1, 0.3, 0.5, 0.7, 0.9, 1.1, 1.3)], "t double")
    assert [round(r[0], 6) for r in df.select(X.snap(F.col("t"))).collect()] == [0.0, 0.2, 0.4, 0.6, 0.8, 1.2, 1.2]


def test_runs_of_words(spark):
    rows = [(0.1, " hi "), (0.2, "hi"), (0.3, ""), (0.35, "hi"), (0.5, "you"), (0.9, "hi"), (0.5, "two")]
    segs = [{"words": [{"start": t, "word": w} for t, w in rows]}, {"words": None}]
    df = spark.createDataFrame([("a", segs)], f"path string, segments {transcript.SEGMENTS}")
    out = transcript.export_words(transcript.words_of(df, ["path"]), ["path"]).orderBy("n").collect()
    assert [(round(r.time_sec, 4), r.word) for r in out] == [(0.0, "hi"), (0.4, "you"), (0.4, "two"), (0.8, "hi")]


@pytest.mark.parametrize("window", [1, 2, 3, 4, 7, 8])
def test_smoothing_over_block_edges(spark, window):
    import pandas as pd

    x = np.random.default_rng(1).normal(size=97)
    df = spark.createDataFrame([("k", i, float(v)) for i, v in enumerate(x)], "k string, n long, x double")
    back, ahead = window // 2, (window - 1) // 2
    if window > 1:
        out = S.windowed(df, ["k"], "n", back, ahead, {"x_smooth": lambda w: F.avg("x").over(w.rowsBetween(-back, ahead))}, block=10)
    else:
        out = S.smooth(df, ["k"], "n", ["x", "absent"], 1)
    got = [r.x_smooth for r in out.orderBy("n").collect()]
    assert np.allclose(got, pd.Series(x).rolling(window, center=True, min_periods=1).mean())


@pytest.mark.parametrize("q", [0.0, 0.1, 0.5, 0.75, 1.0])
def test_quantile_with_ties(spark, q):
    rng = np.random.default_rng(2)
    x = np.r_[rng.normal(size=200), np.zeros(150), [5.0]]
    df = spark.createDataFrame([("a", float(v)) for v in x] + [("b", 1.0)], "k string, x double")
    got = {r.k: r.q for r in S.quantile(df, ["k"], "x", q).collect()}
    assert got["a"] == pytest.approx(np.quantile(x, q)) and got["b"] == 1.0


def test_size_estimates_and_durations(spark):
    df = media.probed(spark.createDataFrame([("a", 0, t) for t in ("60", "600", "3600", "12.9", "N/A", "")], "path string, stream_index int, duration string"))
    got = [tuple(r) for r in media.size_estimates(df).select("duration_sec", "whisper_mb", "pcm_mb", "flac_mb", "total_mb").collect()]
    assert got == [(60, 1, 2, 0, 1), (600, 18, 25, 10, 48), (3600, 109, 151, 60, 289), (12, 0, 0, 0, 0), (0, 0, 0, 0, 0), (0, 0, 0, 0, 0)]


def test_manifest_runs_only_when_confirmed(spark):
    m = media.audio_manifest(spark.createDataFrame([("/v/a.b.mp4", 1)], "path string, stream_index int"), "out/")
    assert {r.output for r in m.collect()} == {f"out/a.b_stream1_{v}.{e}" for v, e, *_ in media.AUDIO_VARIANTS}
    assert {r.status for r in media.run_manifest(m, lambda r: 7).collect()} == {None}
    assert {r.status for r in media.run_manifest(m, lambda r: 7, confirm=True).collect()} == {7}


def wav(x, rate, channels=2):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes(np.asarray(x, "<i2").tobytes())
    return out.getvalue()


def test_wav_to_levels_and_csv(spark, tmp_path):
    rate, n = 16000, 1000
    x = np.random.default_rng(3).integers(-3000, 3000, (n, 2))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.wav").write_bytes(wav(x, rate))
    blocks = sources.audio_blocks(sources.files(spark, str(tmp_path / "in"), "*.wav"), scale="bit_depth")
    rows = stream_levels(blocks, 400, rate)
    got = {(r.channel, r.frame_idx): r.rms for r in rows.collect()}
    assert len(got) == 6
    for (c, k), v in got.items():
        assert v == pytest.approx(np.sqrt((((x[k * 400 : k * 400 + 400, c]) / 32768) ** 2).mean()))
    sinks.write_channels(rows, [0, 1], sinks.LEVELS, str(tmp_path / "out"))
    lines = (tmp_path / "out").read_text().splitlines()
    assert lines[0] == "time_sec,chan1_rms,chan1_energy,chan2_rms,chan2_energy"
    assert lines[1].startswith("0.0000,") and len(lines) == 4


def test_npy_round_trip(spark, tmp_path):
    x = np.random.default_rng(4).normal(size=(2, 500)).astype("float32")
    np.save(tmp_path / "a.npy", x)
    blocks = sources.npy_blocks(sources.files(spark, str(tmp_path), "*.npy"))
    out = sinks.npy_bytes(blocks, ["path"], "block_start", "samples").first().npy
    assert np.allclose(np.load(io.BytesIO(bytes(out))), x.mean(axis=0), atol=1e-6)


def test_pitch_of_tones():
    rate = 16000
    for f in (110.0, 220.0, 440.0):
        t, p = pitch.pyin(np.sin(2 * np.pi * f * np.arange(rate // 2) / rate), rate)
        mid = p[len(p) // 4 : -len(p) // 4]
        assert np.isfinite(mid).mean() > 0.9
        assert abs(12 * np.log2(np.nanmedian(mid) / f)) < 0.2
    assert np.isnan(pitch.pyin(np.zeros(4000), rate)[1]).all()


def test_pitch_table_texts(spark):
    rows = spark.createDataFrame([(0, 0, 0.0, 100.0), (0, 1, 0.1, None), (1, 0, 0.0, 50.004)], "channel int, idx long, time_sec double, pitch_hz double")
    got = [tuple(r) for r in sinks.pitch_table(rows, [0, 1]).orderBy("idx").collect()]
    assert got == [(0, "0.0000", "100.00", "50.00"), (1, "0.1000", "", "no data")]
    clean = sources.clean_pitch(sinks.pitch_table(rows, [0, 1])).orderBy("idx").collect()
    assert [r.chan2_pitch_hz for r in clean] == [50.0, None]


def test_emotions_pad_and_label(spark):
    df = spark.createDataFrame([(0, [1.0, -1.0]), (1, [])], "chunk_index int, samples array<double>")
    stand_in = lambda: lambda batch: [np.array([x.mean(), x.std(), np.abs(x).max(initial=0), -x.mean()]) for x in batch]
    rows = models.emotions(df, "samples", stand_in).collect()
    assert len(rows) == 1 and rows[0].predicted_emotion == "excited"
    assert sum(rows[0].emotion_probs) == pytest.approx(1)


def test_maps_of_a_model_sum_to_one(spark):
    maps = models.saliency_maps(frame_row(spark, [0.0, 16.0, 32.0]), "v", lambda: lambda batch: [x / 16 for x in batch]).first()
    assert sum(maps.saliency) == pytest.approx(1) and maps.saliency == sorted(maps.saliency)


def test_normalise_and_mono(spark):
    x = np.sin(np.arange(1000) / 7) * 0.01
    df = spark.createDataFrame([("a", float(v)) for v in x] + [("b", 0.0)], "path string, v double")
    out = audio.normalise(df, ["path"], "v").toPandas()
    assert np.sqrt((out[out.path == "a"].normalised ** 2).mean()) == pytest.approx(0.1)
    assert out[out.path == "b"].normalised.tolist() == [0.0]
    assert frame_row(spark, [1]).select(F.element_at(audio.mono_of(F.array(F.array(F.lit(1.0)), F.array(F.lit(2.0)))), 1)).first()[0] == 1.5


def test_nulls_lose_no_row(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", None, 2.0), (None, 1, 3.0), (None, 2, 5.0)], "k string, t long, x double")
    got = {(r.k, r.t): r.n for r in S.ordinal(df, ["k"], ["t"], F.floor(F.col("t") / 10)).collect()}
    assert got == {("a", None): 0, ("a", 1): 1, (None, 1): 0, (None, 2): 1}
    rows = S.change(df, ["k"], "t", {"d": "x"}).collect()
    assert sorted((r.x, r.d) for r in rows) == [(1.0, 0.0), (2.0, 0.0), (3.0, 0.0), (5.0, 2.0)]
    assert audio.overlapped(df, "t", 2, 1).where("x = 2.0").select("chunk_idx").collect() == [(None,)]
    assert audio.normalise(df, ["k"], "x").count() == 4
    assert {r.k: r.q for r in S.quantile(df, ["k"], "x", 0.5).collect()} == {"a": 1.5, None: 4.0}
    assert {(r.k, r.x): r.f for r in S.over_quantile(df, ["k"], {"f": "x"}, 0.5).collect()} == {("a", 1.0): False, ("a", 2.0): True, (None, 3.0): False, (None, 5.0): True}


def test_change_of_nan_is_zero(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate([1.0, float("nan"), 2.0, 5.0, None])], "k string, n long, x double")
    assert [r.d for r in S.change(df, ["k"], "n", {"d": "x"}).orderBy("n").collect()] == [0.0, 0.0, 0.0, 3.0, 0.0]


def test_quantile_with_an_outlier(spark):
    x = np.r_[np.random.default_rng(6).normal(size=5000), 1e12]
    df = spark.createDataFrame([("a", float(v)) for v in x], "k string, x double")
    for q in (0.25, 0.75, 0.9):
        assert S.quantile(df, ["k"], "x", q).first().q == pytest.approx(np.quantile(x, q))


def test_video_frames_and_manifest(spark):
    content = spark.createDataFrame([("a.mp4", bytearray(b"x"))], "path string, content binary")
    decode = lambda data: (np.full((4, 6, 3), 10 * k) for k in range(70))
    rows = sources.video_frames(content, decode, 3, 2).orderBy("frame_idx").collect()
    assert len(rows) == 70 and bytes(rows[5].pixels) == bytes([50] * 6) and (rows[5].h, rows[5].w) == (2, 3)
    m = media.video_manifest(spark.createDataFrame([("/v/a.b.mp4",)], "path string"), "out/").first()
    assert m.output == "out/a.b_vision.mp4" and m.arguments == media.VISION


def test_resizing_is_bilinear(spark):
    from cadenza.functions import images

    x = np.arange(12.0).reshape(1, 3, 4)
    assert np.allclose(images.resize(x, 3, 4), x) and np.allclose(images.resize(x, 6, 4)[0, :, 0], [0, 1, 3, 5, 7, 8])
    assert np.allclose(images.resize(x, 3, 2)[0, 0], [0.5, 2.5]) and images.resize(x, 1, 1)[0, 0, 0] == pytest.approx(5.5)
    colour = np.stack([x[0], 2 * x[0]], -1)[None]
    assert np.allclose(images.resize(colour, 2, 3)[..., 1], 2 * images.resize(x, 2, 3))
    df = spark.createDataFrame([([0.0, 1.0, 2.0, 3.0],), ([1.0],), (None,)], "v array<double>")
    assert [r[0] for r in df.select(images.resized(F.col("v"), (2, 2), (1, 1))).collect()] == [[1.5], None, None]


@pytest.mark.parametrize("kind", ["binary", "array<double>"])
def test_motion_over_runs_and_edges(spark, kind):
    rng = np.random.default_rng(8)
    x = rng.integers(0, 256, (50, 30)).astype(np.uint8)
    x[7:9] = x[6]
    value = (lambda v: bytearray(v.tobytes())) if kind == "binary" else (lambda v: [float(c) for c in v])
    rows = [(f, k if f == "a" else 3 * k, value(x[k])) for f in ("a", "b", None) for k in range(50)]
    odd = [("c", 0, value(x[0])), ("c", 1, None), ("c", 2, value(x[2])), ("c", 3, value(x[3][:5])), ("c", None, value(x[4]))]
    want = {}
    for f in ("a", "b", None):
        for k in range(50):
            d = np.abs(x[k].astype(float) - x[k - 1]) / 255 if k else np.zeros(1)
            want[f, k if f == "a" else 3 * k] = (d.mean(), d.std())
    want |= {("c", k): (0.0, 0.0) for k in (0, 1, 2, 3, None)}
    df = spark.createDataFrame(rows + odd, f"f string, n long, pixels {kind}")
    for parts in (df, df.repartition(3), df.orderBy("f", "n")):
        got = {(r.f, r.n): (r.motion_intensity, r.motion_variance) for r in saliency.motion(parts, ["f"], "n", "pixels").collect()}
        assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in want)
    long = spark.range(0, 20_000, 1, 4).select(F.lit("a").alias("f"), F.col("id").alias("n"), F.array(F.col("id").cast("double")).alias("pixels"))
    moved = saliency.runs(long, ["f"], "n", "pixels").where("_first is not null or _last is not null").count()
    assert moved <= 12  # under 1 in 1,000 frames travel with their pixels
    assert saliency.motion(long, ["f"], "n", "pixels").where("abs(motion_intensity - 1 / 255) > 1e-12").count() == 1


def test_frames_without_a_map_have_zeros(spark):
    frames = spark.createDataFrame([("a", k, 0.1 * k, 0.0) for k in range(4)], "path string, frame_idx long, motion_intensity double, motion_variance double")
    stats = spark.createDataFrame([("a", 1, *[0.5] * 8)], "path string, frame_idx long, " + ", ".join(f"{c} double" for c in saliency.MAP_STATS))
    rows = saliency.with_saliency(frames, stats, ["path", "frame_idx"]).orderBy("frame_idx").collect()
    assert [tuple(r[c] for c in saliency.MAP_STATS) for r in rows] == [(0.0,) * 8, (0.5,) * 8, (0.0,) * 8, (0.0,) * 8]
    table = saliency.features(saliency.with_saliency(frames, stats, ["path", "frame_idx"]), ["path"], 15.0).orderBy("frame_idx").collect()
    assert [r.max_saliency for r in table] == [0.0, 0.5, 0.0, 0.0] and [r.saliency_change_rate for r in table] == [0.0, 0.5, -0.5, 0.0]


def test_feature_csv_and_transcripts(spark, tmp_path):
    (tmp_path / "a.csv").write_text('time_sec,x\n0.5,"a ""b"", c"\n')
    assert sources.feature_csv(spark, str(tmp_path / "a.csv")).collect() == [(0.5, 'a "b", c')]
    (tmp_path / "t.json").write_text('{"segments": [{"words": [{"start": 0.5, "word": " a "}]}, {"text": "no words"}]}')
    rows = transcript.words_of(sources.transcript_json(spark, str(tmp_path / "t.json")), ["path"]).collect()
    assert [(r.start, r.word) for r in rows] == [(0.5, "a")]


def test_totals_guards_and_longest(spark):
    df = media.probed(spark.createDataFrame([("a", "3600"), ("a", "600"), ("b", "60")], "path string, duration string"))
    assert {r.path: (r.streams, r.total_mb) for r in media.size_totals(df).collect()} == {"a": (2, 337), "b": (1, 1)}
    counts = media.stream_counts(spark.createDataFrame([("a",), ("c",), (None,)], "path string"), df.groupBy("path").count().withColumnRenamed("count", "streams")).where("path is not null")
    assert media.some_streams(counts.where("path = 'a'")).collect() == [("a", 2)]
    with pytest.raises(Exception, match="no audio stream in c"):
        media.some_streams(counts).collect()
    assert audio.longest(df, ["path"]).first().max_len == 2 and audio.longest(df.where("false"), ["path"]).first().max_len == 0


def test_summary_of_features(spark):
    row = spark.createDataFrame([("a", 1.0, 2.0, True, False, 0.25), ("a", 3.0, 4.0, False, False, 0.75)], "k string, motion_intensity double, mean_saliency double, is_high_motion boolean, is_high_saliency boolean, attention_concentration double")
    assert saliency.summary(row, ["k"]).first()[1:] == (2, 2.0, 3.0, 1, 50.0, 0, 0.0, 0.25, 0.75)


@pytest.mark.parametrize("rates", [(8000, 16000), (16000, 8000), (44100, 16000), (16000, 22050), (3, 2), (5, 5)])
def test_resampling_of_a_tone_and_of_any_blocks(spark, rates):
    was, new = rates
    n = 3000
    x = np.sin(2 * np.pi * 0.05 * min(1, new / was) * np.arange(n))
    got = {}
    for size in (n, 700, 64, 7, 1) if rates == (16000, 8000) else (n, 257):
        rows = [("a", at, [float(v) for v in x[at : at + size]]) for at in range(0, n, size)] + [(None, 0, [1.0, 2.0]), ("c", 0, []), ("d", 0, None), ("d", None, [1.0])]
        df = spark.createDataFrame(rows, "k string, at long, v array<double>").repartition(4)
        out = resampling.resample(df, ["k"], "at", "v", was, new).orderBy("k", "n").toPandas()
        assert set(out.k.map(str)) == {"a", "None"} and (out.k.isna()).sum() == -(-2 * new // was)
        mine = out[out.k == "a"]
        assert mine.n.tolist() == list(range(-(-n * new // was)))
        got[size] = mine.value.to_numpy()
        assert np.allclose(got[size], got[n], atol=1e-12)
    t = np.arange(len(got[n])) * was / new
    inside = (t > 100) & (t < n - 100)
    assert np.abs(got[n] - np.sin(2 * np.pi * 0.05 * min(1, new / was) * t))[inside].max() < 2e-3


def test_blocks_of_samples(spark):
    df = spark.createDataFrame([("a", k, float(k)) for k in range(25)], "k string, n long, v double").repartition(3)
    rows = resampling.blocks_of(df, ["k"], "n", "v", 10).orderBy("block_start").collect()
    assert [(r.block_start, r.samples) for r in rows] == [(s, [float(v) for v in range(s, min(25, s + 10))]) for s in (0, 10, 20)]
    with pytest.raises(ValueError):
        resampling.filter_bank(0, 8000)


def test_chunks_on_one_timeline(spark):
    nan = float("nan")
    chunks = [("a", 0, 0, [0.0, 0.5, 1.0, 1.5], [1.0, nan, 3.0]), ("a", 1, 10, [0.0, 0.5, 1.0], [4.0, 5.0, 6.0]), ("a", 2, 20, [], []), ("a", 3, 30, [0.0], [None]), (None, 0, 0, [0.25], [9.0])]
    df = spark.createDataFrame(chunks, "k string, chunk_idx long, start long, t array<double>, v array<double>")
    rows = lambda own: sorted([(str(r.k), r.idx, r.chunk_idx, r.time_sec, r.value) for r in timeline.on_timeline(df, ["k"], F.col("t"), F.col("v"), 10, own).collect()], key=lambda r: r[:3])
    assert rows(None) == [("None", 0, 0, 0.25, 9.0), ("a", 0, 0, 0.0, 1.0), ("a", 1, 0, 0.5, None), ("a", 2, 0, 1.0, 3.0), ("a", 3, 1, 1.0, 4.0), ("a", 4, 1, 1.5, 5.0), ("a", 5, 1, 2.0, 6.0), ("a", 6, 3, 3.0, None)]
    assert [r[1:] for r in rows(10)] == [(0, 0, 0.25, 9.0), (0, 0, 0.0, 1.0), (1, 0, 0.5, None), (2, 1, 1.0, 4.0), (3, 1, 1.5, 5.0), (4, 3, 3.0, None)]


def test_pitch_of_chunks_steps_back_at_edges(spark):
    rate = 8000
    x = np.sin(2 * np.pi * 200 * np.arange(int(5.5 * rate)) / rate)
    rows = [("a", int(k), float(v)) for k, v in enumerate(x)]
    chunks = timeline.chunks_of(spark.createDataFrame(rows, "path string, n long, v double"), ["path"], "n", "v", 5 * rate, audio.frame_length(rate))
    both = [pitch.pitch_of_chunks(chunks, ["path"], "samples", rate, own).orderBy("idx").toPandas() for own in (False, True)]
    assert both[0].idx.tolist() == list(range(len(both[0]))) and (np.diff(both[0].time_sec) < 0).sum() == 1 and (np.diff(both[1].time_sec) > 0).all()
    assert len(both[0]) > len(both[1]) and abs(both[1].pitch_hz.median() - 200) < 2


def test_plot_points_are_few_and_span_the_series(spark):
    rng = np.random.default_rng(4)
    x, y = np.arange(10_000.0), rng.normal(size=10_000)
    nan = float("nan")
    rows = [("a", a, b) for a, b in zip(x.tolist(), y.tolist(), strict=True)] + [("a", None, 1e9), ("a", nan, 1e9), ("a", 1.0, nan), ("b", 5.0, 1.0), ("b", 5.0, 2.0), ("b", 5.0, 1.0)]
    got = plotting.plot_points(spark.createDataFrame(rows, "k string, x double, y double"), ["k"], "x", "y", 50).toPandas()
    a = got[got.k == "a"]
    assert len(a) <= 200 and a.pixel.nunique() == 50 and a.groupby("pixel").size().max() <= 4
    for p, part in a.groupby("pixel"):
        own = np.flatnonzero(np.minimum(49, np.floor(x / x[-1] * 50)) == p)
        assert {part.y.min(), part.y.max()} == {y[own].min(), y[own].max()} and (part.x.min(), part.x.max()) == (own[0], own[-1])
    assert sorted(got[got.k == "b"][["x", "y"]].values.tolist()) == [[5.0, 1.0], [5.0, 2.0]]
    with pytest.raises(ValueError):
        plotting.plot_points(spark.range(1).toDF("x"), [], "x", "x", 0)


def test_channels_are_found(spark):
    rows = [("p", t, c, float(10 * t + c), None if c == 2 else 1.0) for t in range(10) for c in (7, 2, 30) if (t + c) % 4] + [("q", 3, 2, 5.0, 6.0), ("q", 3, 2, 4.0, 7.0), ("q", None, 2, 4.0, 7.0)]
    df = spark.createDataFrame(rows, "path string, t int, channel int, a double, b double")
    out = audio.wide_found(df, ["path"], "t", "channel", ["a", "b"], block=4)
    assert out.columns == ["path", "t", *(f"chan{k}_{m}" for k in (1, 2, 3) for m in "ab")]
    got = {(r.path, r.t): tuple(r)[2:] for r in out.collect()}
    assert got["q", 3] == (5.0, 7.0, None, None, None, None) and len(got) == 11
    for t in range(10):
        want = tuple(v for c in (2, 7, 30) for v in ((float(10 * t + c), None if c == 2 else 1.0) if (t + c) % 4 else (None, None)))
        assert got["p", t] == want
    with pytest.raises(ValueError, match="more than 2"):
        audio.wide_found(df, ["path"], "t", "channel", ["a"], most=2)
    with pytest.raises(ValueError, match="without a name"):
        audio.wide_found(df.withColumn("channel", F.when(F.col("channel") > 2, F.col("channel"))), ["path"], "t", "channel", ["a"])
