"""The registered queries: one Spark plan each over the given tables, and the SQL that must agree with it.

Stand-ins: a channel is an ``event_type`` of ``events`` in order of (ts, event_id), its sample ``value``; a frame
of 64 samples or a map of 8 * 8 is a vector of ``embeddings``; a transcript is a conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions import arrays as A
from cadenza.functions import images
from cadenza.functions import text as X
from cadenza.operators import audio, media, models, plotting, resampling, saliency, timeline, transcript
from cadenza.operators import sequence as S
from cadenza.operators.selection import quantiles
from cadenza.sources import sinks

RATE, FRAME, CHUNK, HALO = 16000, 100, 80, 10
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_type, n (ordinal in its channel), ts, event_id, value."""
    rows = read(spark, sf_dir, "events").select("event_type", "ts", "event_id", "value")
    return S.ordinal(rows, ["event_type"], ["ts", "event_id"], F.to_date("ts"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select("vec_id", A.doubles(F.col("embedding")).alias("v"))


def r(c: Column | str, places: int = 6) -> Column:
    """Rounded as the oracle rounds: the double times 10**places, halves away from 0, not the number's decimal digits; 0 has no sign."""
    scale = F.lit(10.0**places)
    return F.round((F.col(c) if isinstance(c, str) else c) * scale, 0) / scale + F.lit(0.0)


def big(c: Column) -> Column:
    return c.cast("bigint")


_S = "s AS (SELECT event_type, ts, event_id, value, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS n FROM events)"
_V = "e AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)"
#: Softmax of each vector, then one row a value.
_MAP = f"""{_V}, x AS (SELECT vec_id, v, list_max(v) AS m FROM e), y AS (SELECT vec_id, list_transform(v, lambda a: exp(a - m)) AS z FROM x),
p AS (SELECT vec_id, list_transform(z, lambda a: a / list_sum(z)) AS p FROM y),
u AS (SELECT vec_id, unnest(p) AS p, unnest(range(0, 64)) AS i FROM p)"""


# --- frames and chunks -------------------------------------------------------------------------------------


@query(f"WITH {_S} SELECT event_type, n // 100 AS frame_idx, count(*) AS n_samples, round(sqrt(sum(value * value) / count(*)), 6) AS rms, round(sum(value * value), 6) AS energy FROM s GROUP BY ALL")
def q_frame_rms_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = audio.frame_levels(samples(spark, sf_dir), ["event_type"], "n", "value", FRAME, RATE)
    return out.select("event_type", "frame_idx", "n_samples", r("rms").alias("rms"), r("energy").alias("energy"))


@query(f"WITH {_S} SELECT DISTINCT event_type, n // 100 AS frame_idx, round((n // 100) * 100 / 16000.0::DOUBLE, 6) AS time_sec FROM s")
def q_frame_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = audio.frame_levels(samples(spark, sf_dir), ["event_type"], "n", "value", FRAME, RATE)
    return out.select("event_type", "frame_idx", r("time_sec").alias("time_sec"))


@query("WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1), k AS (SELECT event_type, n, unnest(range(0, (n - 1) // 50 + 1)) AS chunk_index FROM c) SELECT event_type, chunk_index, chunk_index * 5.0::DOUBLE AS start_sec, least((chunk_index + 1) * 5.0::DOUBLE, n / 10.0::DOUBLE) AS end_sec FROM k")
def q_chunk_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = read(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("size"))
    return audio.chunk_bounds(sizes, "size", 10).select("event_type", "chunk_index", "start_sec", "end_sec")


@query(f"WITH {_S}, m AS (SELECT event_type, max(n) AS top FROM s GROUP BY 1), c AS (SELECT event_type, unnest(range(0, top // 80 + 1)) AS chunk_idx FROM m) SELECT s.event_type, chunk_idx, count(*) AS n_samples, round(sum(value), 6) AS total FROM c JOIN s ON s.event_type = c.event_type AND n >= chunk_idx * 80 AND n < chunk_idx * 80 + 90 GROUP BY ALL")
def q_overlap_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = audio.overlapped(samples(spark, sf_dir), "n", CHUNK, HALO)
    return out.groupBy("event_type", "chunk_idx").agg(F.count("*").alias("n_samples"), r(F.sum("value")).alias("total"))


@query(f"WITH {_V} SELECT vec_id, len(list_concat(v, list_transform(range(0, 36), lambda i: 0.0::DOUBLE)))::BIGINT AS size, round(list_sum(v), 6) AS total FROM e")
def q_pad_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = vectors(spark, sf_dir).withColumn("p", A.pad(F.col("v"), 100))
    return padded.select("vec_id", big(F.size("p")).alias("size"), r(A.fold(F.col("p"))).alias("total"))


@query("WITH " + _V + ", f AS (SELECT vec_id, unnest(range(0, 64, 25)) AS a, v FROM e) SELECT vec_id, a // 25 AS frame_idx, len(list_slice(v, a + 1, a + 25))::BIGINT AS n, round(list_sum(list_transform(list_slice(v, a + 1, a + 25), lambda x: x * x)), 6) AS energy FROM f")
def q_block_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = vectors(spark, sf_dir).withColumn("block_start", F.lit(0))
    frames = audio.frames_of(blocks, "v", 25)
    return frames.select("vec_id", "frame_idx", big(F.size("frame")).alias("n"), r(A.fold(F.col("frame"), lambda x: x * x)).alias("energy"))


@query(f"WITH {_V}, f AS (SELECT vec_id, v, unnest(range(0, 17)) AS k FROM e) SELECT vec_id, k AS frame, round(list_sum(list_transform(range(0, 16), lambda i: CASE WHEN k * 4 + i >= 8 AND k * 4 + i < 72 THEN pow(v[k * 4 + i - 7], 2) ELSE 0 END)), 6) AS energy FROM f")
def q_centred_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The energy of frames of 16 around every fourth value, zeros beyond the ends."""
    frames = vectors(spark, sf_dir).select("vec_id", F.posexplode(A.centred_frames(F.col("v"), 16, 4)).alias("frame", "x"))
    return frames.select("vec_id", big(F.col("frame")).alias("frame"), r(A.fold(F.col("x"), lambda x: x * x)).alias("energy"))


@query(f"WITH {_S} SELECT event_type, format('{{:.4f}}', (n // 100) * 100 / 16000.0::DOUBLE) AS time_sec, format('{{:.6f}}', round(sqrt(sum(value * value) / count(*)), 6)) AS rms, format('{{:.2f}}', round(sum(value * value), 2)) AS energy FROM s GROUP BY event_type, n // 100")
def q_level_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The levels of frames as text with fixed decimals."""
    out = audio.frame_levels(samples(spark, sf_dir), ["event_type"], "n", "value", FRAME, RATE)
    return out.select("event_type", X.fixed(4)(F.col("time_sec")).alias("time_sec"), X.fixed(6)(r("rms")).alias("rms"), X.fixed(2)(r("energy", 2)).alias("energy"))


HOP, QUIET = 10, 40.0


def _timeline_sql(mode: str, keep: str) -> str:
    """SQL: each hop of each chunk with its mean, quiet ones null; a time more than there are means."""
    return f"""SELECT '{mode}' AS mode, event_type, chunk_idx, row_number() OVER (PARTITION BY event_type ORDER BY chunk_idx, k) - 1 AS idx, round(k * {HOP} / {RATE}.0::DOUBLE + chunk_idx * {CHUNK} / {RATE}.0::DOUBLE, 6) AS time_sec, round(CASE WHEN mean >= {QUIET} THEN mean END, 6) AS value FROM h WHERE {keep}"""


@query(f"""WITH {_S}, m AS (SELECT event_type, max(n) AS top FROM s GROUP BY 1), c AS (SELECT event_type, unnest(range(0, top // {CHUNK} + 1)) AS chunk_idx FROM m),
h AS (SELECT s.event_type, chunk_idx, (n - chunk_idx * {CHUNK}) // {HOP} AS k, avg(value) AS mean FROM c JOIN s ON s.event_type = c.event_type AND n >= chunk_idx * {CHUNK} AND n < chunk_idx * {CHUNK} + {CHUNK + HALO} GROUP BY ALL)
{_timeline_sql("all", "true")} UNION ALL {_timeline_sql("owned", f"k * {HOP} < {CHUNK}")}""")
def q_chunk_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean of each hop of overlapping chunks, with the halo's hops twice and with each left to its own chunk."""
    chunks = timeline.chunks_of(samples(spark, sf_dir), ["event_type"], "n", "value", CHUNK, HALO)
    hops = F.sequence(F.lit(0), F.floor((F.size("samples") - 1) / HOP).cast("int"))
    mean = lambda k: A.let(F.slice("samples", k * HOP + 1, F.lit(HOP)), A.mean)
    values = F.transform(hops, lambda k: A.let(mean(k), lambda m: F.when(m >= QUIET, m).otherwise(float("nan"))))
    times = F.transform(F.sequence(F.lit(0), F.size(hops)), lambda k: k * HOP / F.lit(float(RATE)))
    modes = {"all": None, "owned": CHUNK}
    both = [timeline.on_timeline(chunks, ["event_type"], times, values, RATE, own).withColumn("mode", F.lit(mode)) for mode, own in modes.items()]
    return both[0].unionByName(both[1]).select("mode", "event_type", "chunk_idx", "idx", r("time_sec").alias("time_sec"), r("value").alias("value"))


#: Three samples become two: a sinc of band 2/3 that ends 12 samples away.
_RESAMPLE = f"""WITH {_S}, c AS (SELECT event_type, count(*) AS size FROM events GROUP BY 1), o AS (SELECT event_type, unnest(range(0, (size * 2 + 2) // 3)) AS m FROM c),
u AS (SELECT p, k, p / 2.0::DOUBLE - (k - 11) AS u FROM range(0, 2) a(p), range(0, 24) b(k)),
g AS (SELECT p, k, CASE WHEN abs(u) >= 12 THEN 0 WHEN u = 0 THEN 1 ELSE sin(pi() * u * 2 / 3.0::DOUBLE) / (pi() * u * 2 / 3.0::DOUBLE) * (0.5::DOUBLE + 0.5::DOUBLE * cos(pi() * u / 12)) END AS g FROM u),
t AS (SELECT p, k, g / sum(g) OVER (PARTITION BY p) AS g FROM g)
SELECT o.event_type, m AS n, round(sum(g * value), 6) + 0.0::DOUBLE AS value FROM o JOIN t ON p = m * 3 % 2 JOIN s ON s.event_type = o.event_type AND s.n = m * 3 // 2 - 11 + k GROUP BY ALL"""


@query(_RESAMPLE)
def q_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples of each channel at two thirds of their rate, by blocks."""
    blocks = resampling.blocks_of(samples(spark, sf_dir), ["event_type"], "n", "value", 20 * FRAME)
    return resampling.resample(blocks, ["event_type"], "block_start", "samples", 24_000, 16_000).select("event_type", "n", r("value").alias("value"))


PIXELS = 40


@query(f"""WITH p AS (SELECT event_type, event_id::DOUBLE AS x, value AS y FROM events WHERE value IS NOT NULL), e AS (SELECT event_type, min(x) AS a, max(x) AS b FROM p GROUP BY 1),
c AS (SELECT p.event_type, x, y, CASE WHEN b > a THEN least({PIXELS - 1}, floor((x - a) / (b - a) * {PIXELS})::INT) ELSE 0 END AS pixel FROM p JOIN e USING (event_type)),
k AS (SELECT *, row_number() OVER (w ORDER BY x, y) AS k1, row_number() OVER (w ORDER BY x DESC, y DESC) AS k2, row_number() OVER (w ORDER BY y, x) AS k3, row_number() OVER (w ORDER BY y DESC, x DESC) AS k4 FROM c WINDOW w AS (PARTITION BY event_type, pixel))
SELECT DISTINCT event_type, pixel, x, y FROM k WHERE 1 IN (k1, k2, k3, k4)""")
def q_plot_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points that draw each channel's values over their numbers, four at most a column of pixels."""
    rows = read(spark, sf_dir, "events").select("event_type", "event_id", "value")
    return plotting.plot_points(rows, ["event_type"], "event_id", "value", PIXELS)


# --- sequences -----------------------------------------------------------------------------------------------


@query(f"WITH {_S} SELECT event_type, n, round(avg(value) OVER (PARTITION BY event_type ORDER BY n ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING), 6) AS value_smooth FROM s")
def q_smooth_center(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.smooth(samples(spark, sf_dir), ["event_type"], "n", ["value"], 7).select("event_type", "n", r("value_smooth").alias("value_smooth"))


@query(f"WITH {_S} SELECT event_type, n, round(avg(value) OVER (PARTITION BY event_type ORDER BY n ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING), 6) AS value_smooth FROM s")
def q_smooth_even(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.smooth(samples(spark, sf_dir), ["event_type"], "n", ["value"], 4).select("event_type", "n", r("value_smooth").alias("value_smooth"))


@query(f"WITH {_S} SELECT event_type, n, round(coalesce(value - lag(value) OVER (PARTITION BY event_type ORDER BY n), 0), 6) AS change FROM s")
def q_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.change(samples(spark, sf_dir), ["event_type"], "n", {"change": "value"}).select("event_type", "n", r("change").alias("change"))


@query(f"WITH {_S}, d AS (SELECT event_type, n, coalesce(value - lag(value) OVER w, 0) AS dx, coalesce((event_id % 100)::DOUBLE - lag((event_id % 100)::DOUBLE) OVER w, 0) AS dy FROM s WINDOW w AS (PARTITION BY event_type ORDER BY n)) SELECT event_type, n, round(sqrt(dx * dx + dy * dy), 6) AS shift FROM d")
def q_shift_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = samples(spark, sf_dir).withColumn("y", (F.col("event_id") % 100).cast("double"))
    return S.shift_rate(rows, ["event_type"], "n", "value", "y", "shift").select("event_type", "n", r("shift").alias("shift"))


_FLAGS = f"{_S}, w AS (SELECT *, avg(value) OVER (PARTITION BY event_type ORDER BY n ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS sm FROM s), f AS (SELECT *, sm > quantile_cont(sm, 0.75) OVER (PARTITION BY event_type) AS is_high FROM w)"


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = S.smooth(samples(spark, sf_dir), ["event_type"], "n", ["value"], 7)
    return S.over_quantile(out, ["event_type"], {"is_high": "value_smooth"})


@query(f"WITH {_FLAGS} SELECT event_type, n, is_high FROM f")
def q_quantile_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flagged(spark, sf_dir).select("event_type", "n", "is_high")


@query(f"WITH {_FLAGS} SELECT event_type, count(*) AS samples, round(avg(value), 6) AS mean, count(*) FILTER (is_high)::BIGINT AS high, round(avg(is_high::INT) * 100, 6) AS high_pct, min(value) AS lowest, max(value) AS highest FROM f GROUP BY 1")
def q_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("is_high").cast("int")
    return _flagged(spark, sf_dir).groupBy("event_type").agg(F.count("*").alias("samples"), r(F.avg("value")).alias("mean"), F.sum(flag).alias("high"), r(F.avg(flag) * 100).alias("high_pct"), F.min("value").alias("lowest"), F.max("value").alias("highest"))


@query("SELECT event_type, round(quantile_cont(value, 0.75), 6) AS q75, round(quantile_cont(value, 0.1), 6) AS q10 FROM events GROUP BY 1")
def q_quantile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "events")
    return quantiles(rows, ["event_type"], "value", {"q75": 0.75, "q10": 0.1}).select("event_type", r("q75").alias("q75"), r("q10").alias("q10"))


@query("SELECT event_type, round(stddev_pop(value), 6) AS deviation FROM events GROUP BY 1")
def q_std_pop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").groupBy("event_type").agg(r(F.stddev_pop("value")).alias("deviation"))


@query("SELECT event_id, round(round_even(value / 0.2::DOUBLE, 0) * 0.2::DOUBLE, 6) AS snapped FROM events")
def q_snap_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", r(X.snap(F.col("value"))).alias("snapped"))


@query("SELECT event_id, round_even(value / 7, 6) AS rounded FROM events")
def q_round6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").select("event_id", A.round6(F.col("value") / 7).alias("rounded"))


@query("SELECT * FROM events ORDER BY ts, event_id LIMIT 5")
def q_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events").orderBy("ts", "event_id").limit(5)


# --- channels ------------------------------------------------------------------------------------------------

def _wide_sql() -> str:
    """The channels' names are in the SQL only; the query finds them."""
    names = ["click", "error", "purchase", "signup", "view"]
    cells = ", ".join(f"round(sum(value) FILTER (event_type = '{c}'), 6) AS chan{k + 1}_total" for k, c in enumerate(names))
    return f"WITH {_S} SELECT n // 100 AS frame_idx, {cells} FROM s GROUP BY 1"


@query(_wide_sql())
def q_pivot_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = samples(spark, sf_dir).groupBy("event_type", F.floor(F.col("n") / FRAME).cast("long").alias("frame_idx")).agg(r(F.sum("value")).alias("total"))
    return audio.wide_found(frames, [], "frame_idx", "event_type", ["total"])


def _pitch_sql() -> str:
    """Empty where the channel is unvoiced, "no data" past its end."""
    names = ["click", "error", "purchase", "signup", "view"]
    cells = ", ".join(f"CASE WHEN count(*) FILTER (event_type = '{c}') = 0 THEN 'no data' ELSE coalesce(max(format('{{:.2f}}', value)) FILTER (event_type = '{c}' AND value >= {QUIET}), '') END AS chan{k + 1}_pitch_hz" for k, c in enumerate(names))
    return f"WITH {_S} SELECT n AS idx, format('{{:.4f}}', n / {RATE}.0::DOUBLE) AS time_sec, {cells} FROM s GROUP BY n"


@query(_pitch_sql())
def q_pitch_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The channels' values side by side as a pitch table has them; low ones count as unvoiced."""
    rows = samples(spark, sf_dir).select(F.col("event_type").alias("channel"), F.col("n").alias("idx"), (F.col("n") / F.lit(float(RATE))).alias("time_sec"), F.when(F.col("value") >= QUIET, F.col("value")).alias("pitch_hz"))
    return sinks.pitch_table(rows, audio.found_channels(read(spark, sf_dir, "events"), "event_type"))


@query("SELECT event_type, bool_or(abs(value) > 50) AS has_audio FROM events GROUP BY 1")
def q_silent_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.audible(read(spark, sf_dir, "events"), ["event_type"], "value", 50.0)


@query("WITH l AS (SELECT event_type, sqrt(avg(value * value)) AS level FROM events GROUP BY 1) SELECT event_id, round(greatest(-1, least(1, value * CASE WHEN level > 1e-8 THEN 0.1::DOUBLE / level ELSE 1 END)), 6) AS normalised FROM events JOIN l USING (event_type)")
def q_gain_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.normalise(read(spark, sf_dir, "events"), ["event_type"], "value").select("event_id", r("normalised").alias("normalised"))


@query("SELECT max(n) AS max_len FROM (SELECT count(*) AS n FROM events GROUP BY event_type)")
def q_longest_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.longest(read(spark, sf_dir, "events"), ["event_type"])


@query("SELECT event_type, count(*) AS length, min(value) AS min, max(value) AS max, round(avg(value), 6) AS mean FROM events GROUP BY 1")
def q_signal_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.signal_stats(read(spark, sf_dir, "events"), ["event_type"], "value").withColumn("mean", r("mean"))


@query(f"WITH {_V}, c AS (SELECT vec_id, [v[2 * i + 1] for i in range(0, 32)] AS a, [v[2 * i + 2] for i in range(0, 32)] AS b FROM e) SELECT vec_id, list_transform(range(1, 33), lambda i: round((a[i] + b[i]) / 2, 6) + 0.0::DOUBLE) AS mono FROM c")
def q_mono_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("v")
    mix = A.mono(A.channel_of(v, 2, 0), A.channel_of(v, 2, 1))
    return vectors(spark, sf_dir).select("vec_id", F.transform(mix, lambda x: r(x)).alias("mono"))


@query(f"WITH {_V} SELECT vec_id, round(list_sum(list_transform(v, lambda x: (x * 1000)::BIGINT / 2147483647.0::DOUBLE)), 9) + 0.0::DOUBLE AS full_scale, round(list_sum(list_transform(v, lambda x: (x * 1000)::BIGINT / 32768.0::DOUBLE)), 6) + 0.0::DOUBLE AS bit_depth FROM e")
def q_scales(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.transform("v", lambda x: F.bround(x * 1000, 0).cast("bigint"))
    return vectors(spark, sf_dir).select("vec_id", r(A.fold(A.full_scale(whole)), 9).alias("full_scale"), r(A.fold(A.bit_depth_scale(whole, F.lit(16))), 6).alias("bit_depth"))


# --- spectra -------------------------------------------------------------------------------------------------


@query(f"WITH {_V} SELECT vec_id, round(list_sum(list_transform(range(2, 65), lambda i: ((v[i] >= 0) != (v[i - 1] >= 0))::INT)) / 63.0::DOUBLE, 6) AS zero_crossing_rate FROM e")
def q_zero_crossing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).select("vec_id", r(A.zero_crossing_rate(F.col("v"))).alias("zero_crossing_rate"))


_SPECTRUM = f"""WITH {_V}, w AS (SELECT vec_id, list_transform(range(1, 65), lambda i: v[i] * (0.54::DOUBLE - 0.46::DOUBLE * cos(2 * pi() * (i - 1) / 63.0::DOUBLE))) AS x FROM e),
k AS (SELECT vec_id, x, unnest(range(0, 32)) AS k FROM w),
m AS (SELECT vec_id, k, sqrt(pow(list_sum(list_transform(range(1, 65), lambda i: x[i] * cos(2 * pi() * k * (i - 1) / 64.0::DOUBLE))), 2) + pow(list_sum(list_transform(range(1, 65), lambda i: x[i] * sin(2 * pi() * k * (i - 1) / 64.0::DOUBLE))), 2)) AS m FROM k),
f AS (SELECT vec_id, k, m, k * 16000 / 64.0::DOUBLE AS freq, sum(m * m) OVER (PARTITION BY vec_id ORDER BY k) AS run, sum(m * m) OVER (PARTITION BY vec_id) AS total FROM m),
c AS (SELECT vec_id, sum(freq * m) / sum(m) AS centroid, exp(sum(CASE WHEN m > 0 THEN ln(m) END) / count(*)) / avg(m) AS flatness, min(freq) FILTER (run >= 0.85::DOUBLE * total) AS rolloff FROM f GROUP BY 1)
SELECT vec_id, round(any_value(centroid), 2) AS spectral_centroid, round(any_value(rolloff), 2) AS spectral_rolloff, round(sqrt(sum(pow(freq - centroid, 2) * m) / sum(m)), 2) AS spectral_bandwidth, round(any_value(flatness), 6) AS spectral_flatness FROM f JOIN c USING (vec_id) GROUP BY vec_id"""


@query(_SPECTRUM)
def q_spectral_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = audio.spectral_features(vectors(spark, sf_dir), "v", RATE, A.next_power_of_two(64))
    return out.select("vec_id", *(r(c, 2).alias(c) for c in ("spectral_centroid", "spectral_rolloff", "spectral_bandwidth")), r("spectral_flatness").alias("spectral_flatness"))


# --- maps and classes ------------------------------------------------------------------------------------------


def _maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).select("vec_id", A.softmax(F.col("v")).alias("p"))


@query(f"WITH {_MAP} SELECT vec_id, list_transform(p, lambda a: round(a, 9)) AS p FROM p")
def q_softmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _maps(spark, sf_dir).select("vec_id", F.transform("p", lambda a: r(a, 9)).alias("p"))


@query(f"WITH {_V}, f AS (SELECT vec_id, [list_sum(list_slice(v, i, i + 15)) FOR i IN [1, 17, 33, 49]] AS v FROM e) SELECT vec_id, (list_position(v, list_max(v)) - 1)::BIGINT AS class, ['neutral', 'happy', 'excited', 'sad', 'angry'][list_position(v, list_max(v))] AS label FROM f")
def q_argmax_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    four = F.array(*(A.fold(F.slice("v", k, 16)) for k in (1, 17, 33, 49)))
    return vectors(spark, sf_dir).select("vec_id", four.alias("v")).select("vec_id", big(A.argmax(F.col("v"))).alias("class"), A.label_of(F.col("v"), models.EMOTIONS).alias("label"))


@query(f"WITH {_MAP}, t AS (SELECT vec_id, sum(p + 1e-10) AS t FROM u GROUP BY 1) SELECT vec_id, round(-sum((p + 1e-10) / t * log2((p + 1e-10) / t)), 6) AS saliency_entropy FROM u JOIN t USING (vec_id) GROUP BY 1")
def q_entropy_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _maps(spark, sf_dir).select("vec_id", r(A.entropy(F.col("p"))).alias("saliency_entropy"))


_CENTRE = "SELECT vec_id, sum(p * (i % 8)) / sum(p) / 8 AS cx, sum(p * (i // 8)) / sum(p) / 8 AS cy FROM u GROUP BY 1"


@query(f"WITH {_MAP}, c AS ({_CENTRE}) SELECT vec_id, round(cx, 6) AS attention_center_x, round(cy, 6) AS attention_center_y FROM c")
def q_center_of_mass(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = A.centre(F.col("p"), 8, 8)
    return _maps(spark, sf_dir).select("vec_id", r(x).alias("attention_center_x"), r(y).alias("attention_center_y"))


@query(f"WITH {_MAP}, c AS ({_CENTRE}) SELECT vec_id, round(1 - sum(p * sqrt(pow(i // 8 - cy * 8, 2) + pow(i % 8 - cx * 8, 2))) / sum(p) / (sqrt(128) / 2), 6) AS attention_concentration FROM u JOIN c USING (vec_id) GROUP BY 1")
def q_concentration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return saliency.map_stats(_maps(spark, sf_dir), "p", 8, 8).select("vec_id", r("attention_concentration").alias("attention_concentration"))


@query(f"WITH {_MAP}, q AS (SELECT vec_id, quantile_cont(p, 0.9) AS q FROM u GROUP BY 1) SELECT vec_id, round(sum(p) FILTER (p >= q) / sum(p), 6) AS top10_saliency_mass FROM u JOIN q USING (vec_id) GROUP BY 1")
def q_top10_mass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _maps(spark, sf_dir).select("vec_id", r(A.top_mass(F.col("p"))).alias("top10_saliency_mass"))


@query(f"WITH {_MAP} SELECT vec_id, round(avg(p), 9) AS mean_saliency, round(max(p), 6) AS max_saliency, round(stddev_pop(p), 6) AS std_saliency FROM u GROUP BY 1")
def q_map_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("p")
    return _maps(spark, sf_dir).select("vec_id", r(A.mean(p), 9).alias("mean_saliency"), r(F.array_max(p)).alias("max_saliency"), r(A.std_pop(p)).alias("std_saliency"))


_MOTION = f"{_V}, b AS (SELECT vec_id, v, lag(v) OVER (ORDER BY vec_id) AS w FROM e), d AS (SELECT vec_id, CASE WHEN w IS NOT NULL THEN list_transform(range(1, 65), lambda i: abs(v[i] - w[i])) END AS d FROM b)"


def _frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors as frames of one file, by vec_id."""
    return read(spark, sf_dir, "embeddings").select(F.lit("all").alias("path"), "vec_id", "embedding")


@query(f"WITH {_MOTION}, u AS (SELECT vec_id, unnest(d) AS x FROM d WHERE d IS NOT NULL), a AS (SELECT vec_id, avg(x) / 255 AS i, stddev_pop(x) / 255 AS s FROM u GROUP BY 1) SELECT d.vec_id, round(coalesce(i, 0), 9) AS motion_intensity, round(coalesce(s, 0), 9) AS motion_variance FROM d LEFT JOIN a USING (vec_id)")
def q_motion(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = saliency.motion(_frames(spark, sf_dir), ["path"], "vec_id", "embedding")
    return out.select("vec_id", r("motion_intensity", 9).alias("motion_intensity"), r("motion_variance", 9).alias("motion_variance"))


@query(f"WITH {_MAP}, s AS (SELECT vec_id, avg(p) AS mean, max(p) AS top, stddev_pop(p) AS spread FROM u GROUP BY 1) SELECT vec_id, CASE WHEN top > 0.025 THEN round(mean, 9) ELSE 0 END AS mean_saliency, CASE WHEN top > 0.025 THEN round(top, 6) ELSE 0 END AS max_saliency, CASE WHEN top > 0.025 THEN round(spread, 6) ELSE 0 END AS std_saliency FROM s")
def q_frames_without_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames with the statistics of their maps, zeros where none stands out."""
    stats = saliency.map_stats(_maps(spark, sf_dir), "p", 8, 8).where(F.col("max_saliency") > 0.025)
    out = saliency.with_saliency(_frames(spark, sf_dir).drop("embedding"), stats, ["vec_id"])
    return out.select("vec_id", r("mean_saliency", 9).alias("mean_saliency"), r("max_saliency").alias("max_saliency"), r("std_saliency").alias("std_saliency"))


def _resize_sql(size: int, out: int, k: str) -> str:
    """SQL: the place (half-pixel centres, edges repeated) of output place ``k``."""
    return f"greatest(0.0::DOUBLE, least({size - 1}.0::DOUBLE, ({k} + 0.5::DOUBLE) * {size} / {out}.0::DOUBLE - 0.5::DOUBLE))"


@query(f"""WITH {_V}, o AS (SELECT vec_id, v, i, {_resize_sql(8, 5, "i // 3")} AS y, {_resize_sql(8, 3, "i % 3")} AS x FROM (SELECT vec_id, v, unnest(range(0, 15)) AS i FROM e)),
p AS (SELECT *, floor(y)::INT AS y0, least(floor(y)::INT + 1, 7) AS y1, floor(x)::INT AS x0, least(floor(x)::INT + 1, 7) AS x1 FROM o)
SELECT vec_id, i AS place, round((v[y0 * 8 + x0 + 1] * (1 - (y - y0)) + v[y1 * 8 + x0 + 1] * (y - y0)) * (1 - (x - x0)) + (v[y0 * 8 + x1 + 1] * (1 - (y - y0)) + v[y1 * 8 + x1 + 1] * (y - y0)) * (x - x0), 6) + 0.0::DOUBLE AS value FROM p""")
def q_resize(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maps of 8 by 8 at 5 rows of 3."""
    small = vectors(spark, sf_dir).select("vec_id", F.posexplode(images.resized(F.col("v"), (8, 8), (5, 3))).alias("place", "value"))
    return small.select("vec_id", big(F.col("place")).alias("place"), r("value").alias("value"))


_FEATURES = f"""WITH {_MAP}, c AS ({_CENTRE}),
k AS (SELECT vec_id, avg(p) AS mean_saliency, 1 - sum(p * sqrt(pow(i // 8 - cy * 8, 2) + pow(i % 8 - cx * 8, 2))) / sum(p) / (sqrt(128) / 2) AS focus, any_value(cx) AS cx, any_value(cy) AS cy FROM u JOIN c USING (vec_id) GROUP BY 1),
b AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS frame_idx, v, lag(v) OVER (ORDER BY vec_id) AS w FROM e),
m AS (SELECT vec_id, frame_idx, coalesce(list_sum(list_transform(range(1, 65), lambda i: abs(v[i] - w[i]))) / 64 / 255, 0) AS motion FROM b),
f AS (
  SELECT frame_idx, motion, focus, avg(motion) OVER s AS motion_smooth, avg(mean_saliency) OVER s AS saliency_smooth, coalesce(motion - lag(motion) OVER o, 0) AS motion_change,
    coalesce(sqrt(pow(cx - lag(cx) OVER o, 2) + pow(cy - lag(cy) OVER o, 2)), 0) AS shift
  FROM m JOIN k USING (vec_id) WINDOW o AS (ORDER BY frame_idx), s AS (ORDER BY frame_idx ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)
)
SELECT frame_idx, round(frame_idx / 15::DOUBLE, 6) AS time_sec, round(motion, 6) AS motion_intensity, round(motion_smooth, 6) AS motion_intensity_smooth, round(motion_change, 6) + 0.0::DOUBLE AS motion_change_rate,
  round(saliency_smooth, 6) AS mean_saliency_smooth, round(shift, 6) AS attention_shift_rate, motion_smooth > quantile_cont(motion_smooth, 0.75) OVER () AS is_high_motion, focus > quantile_cont(focus, 0.75) OVER () AS is_focused_attention FROM f"""


def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 25 columns of frames whose map is the softmax of their own values."""
    frames = _frames(spark, sf_dir)
    stats = saliency.map_stats(frames.select("path", "vec_id", A.softmax(A.doubles(F.col("embedding"))).alias("p")), "p", 8, 8)
    moving = saliency.with_saliency(saliency.motion(frames, ["path"], "vec_id", "embedding"), stats, ["path", "vec_id"])
    numbered = S.ordinal(moving, ["path"], ["vec_id"], F.floor(F.col("vec_id") / 10_000), "frame_idx")
    return saliency.features(numbered, ["path"], 15.0)


@query(_FEATURES)
def q_feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = "time_sec motion_intensity motion_intensity_smooth motion_change_rate mean_saliency_smooth attention_shift_rate".split()
    return feature_table(spark, sf_dir).select("frame_idx", *(r(c).alias(c) for c in columns), "is_high_motion", "is_focused_attention")


# --- transcripts -------------------------------------------------------------------------------------------------


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as transcripts: a turn is a segment, a word starts 10 s a turn and 0.13 s a word in."""
    rows = read(spark, sf_dir, "conversations")
    words = F.transform(F.split("text", " "), lambda w, i: F.struct((F.col("turn") * F.lit(10.0) + i * F.lit(0.13)).alias("start"), w.alias("word")))
    return rows.select("conv_id", "turn", F.array(F.struct(words.alias("words"))).alias("segments"))


_WORDS = "w AS (SELECT conv_id, turn, unnest(string_split(text, ' ')) AS raw, unnest(range(0, len(string_split(text, ' ')))) AS pos FROM conversations), k AS (SELECT conv_id, turn, pos, turn * 10.0::DOUBLE + pos * 0.13::DOUBLE AS start, regexp_replace(raw, '^\\s+|\\s+$', '', 'g') AS word FROM w), o AS (SELECT * FROM k WHERE word <> ''), d AS (SELECT *, lag(word) OVER (PARTITION BY conv_id ORDER BY start, turn, pos) AS last FROM o)"


def _exported(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = transcript.words_of(_segments(spark, sf_dir), ["conv_id", "turn"]).withColumn("seq", F.struct("turn", "seq"))
    return transcript.export_words(words, ["conv_id"])


@query(f"WITH {_WORDS} SELECT conv_id, word, count(*) AS n FROM d WHERE last IS NULL OR last <> word GROUP BY 1, 2")
def q_words_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exported(spark, sf_dir).groupBy("conv_id", "word").agg(F.count("*").alias("n"))


@query(f"WITH {_WORDS} SELECT conv_id, word, round(round_even(start / 0.2::DOUBLE, 0) * 0.2::DOUBLE, 4) AS time_sec FROM d WHERE last IS NULL OR last <> word")
def q_word_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _exported(spark, sf_dir).select("conv_id", "word", r("time_sec", 4).alias("time_sec"))


@query("WITH w AS (SELECT conv_id, unnest(string_split(text, ' ')) AS raw FROM conversations WHERE role = 'user') SELECT conv_id, count(*) AS words, count(*) FILTER (regexp_replace(raw, '^\\s+|\\s+$', '', 'g') = '') AS blank FROM w GROUP BY 1")
def q_segments_without_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of each conversation, where only a user's turns have any."""
    rows = read(spark, sf_dir, "conversations")
    words = F.transform(F.split("text", " "), lambda w, i: F.struct(i.cast("double").alias("start"), w.alias("word")))
    segments = rows.select("conv_id", "turn", F.array(F.struct(F.when(F.col("role") == "user", words).alias("words"))).alias("segments"))
    return transcript.words_of(segments, ["conv_id"]).groupBy("conv_id").agg(F.count("*").alias("words"), F.count_if(F.col("word") == "").alias("blank"))


# --- media ---------------------------------------------------------------------------------------------------------


def _streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as media files of one stream; the balance is the duration's text."""
    rows = read(spark, sf_dir, "supplier")
    return media.probed(rows.select(F.concat(F.lit("/media/"), "s_name", F.lit(".mp4")).alias("path"), F.lit(0).alias("stream_index"), F.abs(F.col("s_acctbal")).cast("string").alias("duration")))


@query("WITH d AS (SELECT '/media/' || s_name || '.mp4' AS path, trunc(abs(s_acctbal))::BIGINT AS d FROM supplier), m AS (SELECT path, d, d * 32000 // 1048576 AS whisper_mb, d * 44100 // 1048576 AS pcm_mb FROM d) SELECT path, whisper_mb, pcm_mb, pcm_mb * 40 // 100 AS flac_mb, whisper_mb + 3 * (pcm_mb * 40 // 100) AS total_mb FROM m")
def q_size_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.size_estimates(_streams(spark, sf_dir)).select("path", "whisper_mb", "pcm_mb", "flac_mb", "total_mb")


@query("SELECT '/media/' || s_nationkey || '.mp4' AS path, count(*) AS streams, sum(d * 32000 // 1048576 + 3 * (d * 44100 // 1048576 * 40 // 100))::BIGINT AS total_mb FROM (SELECT s_nationkey, trunc(abs(s_acctbal))::BIGINT AS d FROM supplier) GROUP BY 1")
def q_size_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nation as a file, its suppliers as the streams."""
    rows = read(spark, sf_dir, "supplier").select(F.concat(F.lit("/media/"), F.col("s_nationkey").cast("string"), F.lit(".mp4")).alias("path"), F.abs(F.col("s_acctbal")).cast("string").alias("duration"))
    return media.size_totals(media.probed(rows))


@query("WITH v(variant, ext, rate, filter, codec) AS (VALUES ('whisper', 'wav', 16000, 'afftdn=nr=20', 'pcm_s16le'), ('volume', 'flac', 22050, NULL, 'flac'), ('analysis', 'flac', 22050, 'afftdn=nr=20,loudnorm', 'flac'), ('events', 'flac', 22050, 'loudnorm', 'flac'), ('emotion', 'flac', 16000, 'volume=0.5', 'flac')) SELECT variant, rate::BIGINT AS sample_rate, filter, codec, 'temp/' || s_name || '_stream0_' || variant || '.' || ext AS output FROM supplier, v")
def q_variant_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.audio_manifest(_streams(spark, sf_dir), "temp").select("variant", big(F.col("sample_rate")).alias("sample_rate"), "filter", "codec", "output")


@query("SELECT 'temp/' || s_name || '_vision.mp4' AS output, '-an -vf fps=15,scale=224:224 -c:v libx264 -preset fast -crf 16' AS arguments FROM supplier")
def q_vision_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.video_manifest(_streams(spark, sf_dir), "temp").select("output", F.array_join("arguments", " ").alias("arguments"))


@query("SELECT 'temp/' || s_name || '_vision.mp4' AS output, NULL::INTEGER AS status FROM supplier")
def q_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What would be run: without a confirmation no tool is called."""
    return media.run_manifest(media.video_manifest(_streams(spark, sf_dir), "temp"), lambda row: 1).select("output", "status")


@query("SELECT '/media/' || c_name || '.mp4' AS path, count(s_name) AS streams FROM customer LEFT JOIN supplier ON c_nationkey = s_nationkey GROUP BY 1")
def q_stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = read(spark, sf_dir, "customer").select(F.concat(F.lit("/media/"), "c_name", F.lit(".mp4")).alias("path"), F.col("c_nationkey").alias("nation"))
    counts = read(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.count("*").alias("streams"))
    return media.stream_counts(paths, counts, "nation")


@query("SELECT d.doc_id, d.source, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE d.doc_id IS NOT NULL AND d.source IS NOT NULL AND l.toxic IS NOT NULL")
def q_dropna(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "documents").select("doc_id", "source").join(read(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    return rows.na.drop("any")
