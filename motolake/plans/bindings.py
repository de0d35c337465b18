"""Queries over the driver's tables, each an application of generic operators, and their SQL.

A user's events are a session: (ts, event_id) is its order, value its signal, event_type its labels.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from motolake.functions import geometry as geo
from motolake.functions import strings
from motolake.operators import asof, consent, dataset_qc, eis, fusion, intervals, language, logs, package, phases, privacy, qa, retarget, stats, sync, tasks, validate
from motolake.operators import primitives as prim
from motolake.operators import windows as win
from motolake.operators.certify import mistakes, quality
from motolake.operators.certify import speed as speed_bins
from motolake.settings import TASK_SIGNATURES, Settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
U, I = ["user_id"], ["i"]


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """user_id, i (place in the session), t (seconds) and the columns asked for."""
    ev = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", *columns)
    place = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1
    return ev.withColumn("i", place).withColumn("t", F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)


def lineitem(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *columns)


EV = "ev AS (SELECT *, epoch_us(ts) / 1e6 AS t, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INT) AS i FROM events)"
RUNS = "chg AS (SELECT *, CASE WHEN lag({x}) OVER w IS DISTINCT FROM {x} OR i = 0 THEN 1 ELSE 0 END AS c FROM {src} WINDOW w AS (PARTITION BY user_id ORDER BY i)), rid AS (SELECT *, CAST(sum(c) OVER (PARTITION BY user_id ORDER BY i) AS BIGINT) AS run FROM chg), runs AS (SELECT user_id, run, any_value({x}) AS x, count(*) AS n, min(i) AS lo, max(i) AS hi, min(t) AS t0, max(t) AS t1 FROM rid GROUP BY user_id, run)"


# ---------------------------------------------------------------- governance
STATUS = "CASE event_type WHEN 'click' THEN 'granted' WHEN 'view' THEN 'granted' WHEN 'signup' THEN 'pending' WHEN 'purchase' THEN 'revoked' ELSE 'denied' END"
RANK = "CASE {s} WHEN 'denied' THEN 0 WHEN 'revoked' THEN 1 WHEN 'pending' THEN 2 ELSE 3 END"


@query("SELECT d.doc_id, d.lang, l.quality FROM documents d JOIN labels l USING (doc_id) WHERE l.toxic = 0 AND l.quality >= 1")
def deliverable_inner(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    found = consent.deliverable(
        docs.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("capture_id"), F.col("lang").alias("task_id")),
        docs.select(F.col("doc_id").alias("id")),
        labels.select(F.col("doc_id").alias("capture_id"), F.when(F.col("toxic") == 0, "granted").otherwise("denied").alias("status")),
        labels.select(F.col("doc_id").alias("episode_id"), F.lit("passed").alias("pii_status"), "quality"),
        min_quality=1,
    )
    return found.join(labels.select(F.col("doc_id").alias("id"), "quality"), "id").select(F.col("id").alias("doc_id"), F.col("task_id").alias("lang"), "quality")


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'no consent record' WHEN l.toxic = 1 THEN 'consent is denied' WHEN l.quality = 0 THEN 'pii is failed' END AS reason FROM documents d LEFT JOIN labels l USING (doc_id)")
def delivery_block_reason(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    status = F.when(F.col("toxic") == 0, "granted").when(F.col("toxic") == 1, "denied")
    pii = F.when(F.col("quality") == 1, "passed").when(F.col("quality") == 0, "failed")
    return docs.select("doc_id", consent.block_reason(status, pii).alias("reason"))


def observations(spark, sf_dir):
    status = F.when(F.col("event_type").isin("click", "view"), "granted").when(F.col("event_type") == "signup", "pending").when(F.col("event_type") == "purchase", "revoked").otherwise("denied")
    return events(spark, sf_dir, "event_type").withColumn("status", status)


@query(f"WITH o AS (SELECT user_id, {STATUS} AS status FROM events) SELECT user_id, CASE min({RANK.format(s='status')}) WHEN 0 THEN 'denied' WHEN 1 THEN 'revoked' WHEN 2 THEN 'pending' ELSE 'granted' END AS status, count(DISTINCT status) > 1 AS conflicted, count(*) AS observations FROM o GROUP BY user_id")
def consent_reconcile(spark, sf_dir):
    return consent.reconcile(observations(spark, sf_dir), "user_id", "status").select("user_id", "status", "conflicted", "observations")


@query(
    f"""WITH o AS (SELECT user_id, event_id, {STATUS} AS status FROM events),
g AS (SELECT user_id, min({RANK.format(s="status")}) AS r, count(DISTINCT status) AS k FROM o GROUP BY user_id)
SELECT user_id, 'duplicate_conflict' AS event_type, status, CAST(event_id AS VARCHAR) AS source FROM o WHERE user_id IN (SELECT user_id FROM g WHERE k > 1)
UNION ALL SELECT user_id, CASE WHEN k > 1 THEN 'reconciled' ELSE 'recorded' END, CASE r WHEN 0 THEN 'denied' WHEN 1 THEN 'revoked' WHEN 2 THEN 'pending' ELSE 'granted' END, NULL FROM g"""
)
def consent_event_log(spark, sf_dir):
    return consent.event_log(observations(spark, sf_dir), "user_id", "status", "event_id")


@query("SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS place FROM conversations")
def consent_history(spark, sf_dir):
    rows = consent.history(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), "conv_id", "turn", "role")
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).cast("long"))


@query(
    f"""WITH {EV}, o AS (SELECT user_id, i, {STATUS} AS status FROM ev),
s AS (SELECT *, min(CASE WHEN status IN ('denied', 'revoked') THEN {RANK.format(s="status")} END) OVER (PARTITION BY user_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS stop FROM o)
SELECT user_id, i, CASE stop WHEN 0 THEN 'denied' WHEN 1 THEN 'revoked' ELSE status END AS effective, coalesce({RANK.format(s="status")} > stop, false) AS refused FROM s"""
)
def sticky_status(spark, sf_dir):
    return consent.sticky(observations(spark, sf_dir), "user_id", I, "status").select("user_id", "i", "effective", F.coalesce("refused", F.lit(False)).alias("refused"))


# ---------------------------------------------------------------- windows
@query(
    f"""WITH {EV}, p AS (SELECT user_id, i, value, event_type <> 'error' AS seen, lag(event_type <> 'error') OVER w AS before, lag(value) OVER w AS last, t - lag(t) OVER w AS dt FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY i))
SELECT user_id, i, CASE WHEN seen AND before AND dt <> 0 THEN (value - last) / dt ELSE 0 END AS vx FROM p"""
)
def lag_velocity(spark, sf_dir):
    ev = events(spark, sf_dir, "value", "event_type").withColumn("hands_detected", F.col("event_type") != "error").withColumn("y", F.lit(0.0))
    ev = ev.withColumn("dt", F.nullif(F.col("t") - F.lag("t").over(win.over(U, I)), F.lit(0.0)))
    return prim.wrist_velocity(ev, U, "i", "value", "y", "dt").select("user_id", "i", "vx")


@query(f"WITH {EV}, d AS (SELECT user_id, i, t - lag(t) OVER (PARTITION BY user_id ORDER BY i) AS dt FROM ev), m AS (SELECT user_id, avg(dt) FILTER (dt > 0) AS mean FROM d GROUP BY user_id) SELECT user_id, i, round(CASE WHEN dt > 0 THEN 1 / dt ELSE coalesce(1 / mean, 30) END, 9) AS fps FROM d JOIN m USING (user_id)")
def frame_fps(spark, sf_dir):
    return prim.frame_rate(events(spark, sf_dir), U, "i", "t").select("user_id", "i", F.round("fps", 9).alias("fps"))


@query(f"WITH {EV} SELECT user_id, i, round(avg(value) OVER w, 6) AS mean, max(value) OVER w AS top, count(*) FILTER (value > 50) OVER w >= least(2, count(*) OVER w) AS fires FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)")
def centred_window(spark, sf_dir):
    w = win.rows(U, I, -2, 2)
    fires = F.count_if(F.col("value") > 50).over(w) >= F.least(F.lit(2), F.count(F.lit(1)).over(w))
    return events(spark, sf_dir, "value").select("user_id", "i", F.round(F.avg("value").over(w), 6).alias("mean"), F.max("value").over(w).alias("top"), fires.alias("fires"))


@query(f"WITH {EV} SELECT user_id, i, count(*) OVER w AS n, count(*) FILTER (value > 40) OVER w AS fast, count(*) OVER w >= 5 AND count(*) FILTER (value > 40) OVER w >= 6 AS sustained FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)")
def trailing_window(spark, sf_dir):
    w = win.rows(U, I, -9, 0)
    n, fast = F.count(F.lit(1)).over(w), F.count_if(F.col("value") > 40).over(w)
    return events(spark, sf_dir, "value").select("user_id", "i", n.alias("n"), fast.alias("fast"), ((n >= 5) & (fast >= 6)).alias("sustained"))


PEAK = "pk AS (SELECT user_id, i, value, list(value) OVER w AS v FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)), onset AS (SELECT *, len(v) >= 3 AND list_max(v) > 80 AND list_position(v, list_max(v)) < len(v) AND v[-1] < list_max(v) AS on_ FROM pk)"


def onsets(spark, sf_dir):
    return events(spark, sf_dir, "value").withColumn("onset", prim.peak_then_drop(F.collect_list("value").over(win.rows(U, I, -2, 2)), 80.0))


@query(f"WITH {EV}, {PEAK} SELECT user_id, i, on_ AS onset FROM onset")
def peak_in_window(spark, sf_dir):
    return onsets(spark, sf_dir).select("user_id", "i", "onset")


@query(f"WITH {EV}, {PEAK} SELECT user_id, i, coalesce(bool_or(on_) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), false) AND list_avg(v) < 60 AS release FROM onset")
def lookback_release(spark, sf_dir):
    recent = F.coalesce(F.max("onset").over(win.rows(U, I, -10, -1)), F.lit(False))
    return onsets(spark, sf_dir).select("user_id", "i", (recent & (F.avg("value").over(win.rows(U, I, -2, 2)) < 60)).alias("release"))


@query(
    f"""WITH {EV}, s AS (SELECT user_id, i, CASE WHEN event_type <> 'error' THEN value > 35 END AS touch FROM ev),
b AS (SELECT *, coalesce(last_value(touch IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS before FROM s)
SELECT user_id, i, coalesce(touch AND NOT before, false) AS onset, coalesce(NOT touch AND before, false) AS release FROM b"""
)
def edge_detect(spark, sf_dir):
    ev = events(spark, sf_dir, "value", "event_type").withColumn("touch", F.when(F.col("event_type") != "error", F.col("value") > 35))
    return win.edges(ev, U, I, "touch").select("user_id", "i", "onset", "release")


HYST = "h AS (SELECT *, coalesce(last_value(CASE WHEN value >= 60 THEN true WHEN value < 20 THEN false END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS on_ FROM ev)"


def gated(spark, sf_dir):
    return win.hysteresis(events(spark, sf_dir, "value", "event_type"), U, I, "value", 60.0, 20.0)


@query(f"WITH {EV}, {HYST} SELECT user_id, i, on_ AS \"on\" FROM h")
def hysteresis(spark, sf_dir):
    return gated(spark, sf_dir).select("user_id", "i", "on")


@query(f"WITH {EV}, {HYST}, {RUNS.format(x='on_', src='h')} SELECT rid.user_id, i, on_ AND n >= 3 AS kept FROM rid JOIN runs USING (user_id, run)")
def min_duration(spark, sf_dir):
    return win.min_duration(gated(spark, sf_dir), U, I, "on", 3, "kept").select("user_id", "i", "kept")


LEVEL = "lv AS (SELECT *, CASE WHEN value < 20 THEN 'low' WHEN value < 60 THEN 'mid' ELSE 'high' END AS level FROM ev)"


def levelled(spark, sf_dir):
    return events(spark, sf_dir, "value", "event_type").withColumn("level", F.when(F.col("value") < 20, "low").when(F.col("value") < 60, "mid").otherwise("high"))


@query(
    f"""WITH {EV}, {LEVEL}, {RUNS.format(x="level", src="lv")},
k AS (SELECT *, CASE WHEN n >= 3 OR run = min(run) OVER p OR run = max(run) OVER p THEN x END AS keep FROM runs WINDOW p AS (PARTITION BY user_id)),
f AS (SELECT user_id, run, last_value(keep IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS state FROM k)
SELECT rid.user_id, i, state FROM rid JOIN f USING (user_id, run)"""
)
def dwell(spark, sf_dir):
    return win.dwell(levelled(spark, sf_dir), U, I, "level", 3, "state").select("user_id", "i", "state")


@query(
    f"""WITH {EV}, {LEVEL}, {RUNS.format(x="level", src="lv")},
k AS (SELECT user_id, run, coalesce(last_value(CASE WHEN n >= 3 THEN x END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), nth_value(x, 2) OVER (PARTITION BY user_id ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), 'idle') AS label FROM runs)
SELECT rid.user_id, i, label FROM rid JOIN k USING (user_id, run)"""
)
def short_segment_fill(spark, sf_dir):
    return win.fill_short_runs(levelled(spark, sf_dir), U, I, "level", 3, "label").select("user_id", "i", "label")


@query()
def gap_fill(spark, sf_dir):
    return win.fill_gaps(win.runs(levelled(spark, sf_dir), U, I, "level"), U, "level", 3)


@query(f"WITH {EV}, {LEVEL}, {RUNS.format(x='level', src='lv')} SELECT user_id, x AS phase, lo AS start_frame, hi AS end_frame, n AS duration_frames FROM runs")
def phase_runs(spark, sf_dir):
    return win.segments(levelled(spark, sf_dir), U, "i", "level", "t").select("user_id", "phase", "start_frame", "end_frame", "duration_frames")


DAY = Settings(episode_gap_s=86_400.0, episode_min_s=3_600.0)
IDLE = "lv AS (SELECT *, CASE WHEN value < 30 THEN 'idle' ELSE 'grasp' END AS level FROM ev)"
EPISODES = f"""{EV}, {IDLE}, {RUNS.format(x="level", src="lv")},
g AS (SELECT *, x = 'idle' AND t1 - t0 > 86400 AS gap FROM (SELECT * REPLACE (round(t0, 4) AS t0, round(t1, 4) AS t1) FROM runs)),
n AS (SELECT *, sum(CASE WHEN gap THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY run) AS cut FROM g),
e AS (SELECT user_id, cut, min(lo) AS start_frame, max(hi) AS end_frame, min(t0) AS start_sec, max(t1) AS end_sec, count(*) AS segments FROM n WHERE NOT gap GROUP BY user_id, cut),
kept AS (SELECT user_id, start_frame, end_frame, start_sec, end_sec, segments FROM e WHERE end_sec - start_sec >= 3600),
eps AS (SELECT * FROM kept UNION ALL SELECT user_id, min(lo), max(hi), min(t0), max(t1), count(*) FROM g WHERE user_id NOT IN (SELECT user_id FROM kept) GROUP BY user_id),
episodes AS (SELECT *, format('{{}}_ep{{:02d}}', CAST(user_id AS VARCHAR), CAST(row_number() OVER (PARTITION BY user_id ORDER BY start_frame) - 1 AS INT)) AS episode_id FROM eps)"""


def idle_segments(spark, sf_dir):
    ev = events(spark, sf_dir, "value").withColumn("level", F.when(F.col("value") < 30, "idle").otherwise("grasp"))
    return ev, win.segments(ev, U, "i", "level", "t")


def user_episodes(spark, sf_dir):
    ev, segs = idle_segments(spark, sf_dir)
    return ev, segs, phases.episodes(segs, U, "user_id", DAY)


@query(f"WITH {EPISODES} SELECT user_id, episode_id, start_frame, end_frame, segments FROM episodes")
def episodes(spark, sf_dir):
    return user_episodes(spark, sf_dir)[2].select("user_id", "episode_id", "start_frame", "end_frame", "segments")


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN (l_quantity > 40 OR l_tax > 0.06) AND (l_discount < 0.03 OR l_returnflag = 'N') THEN 'active_manipulation' WHEN l_returnflag = 'R' THEN 'release'
WHEN (l_discount < 0.03 OR l_returnflag = 'N') AND l_linestatus <> 'O' THEN 'grasp' WHEN l_quantity < 10 AND NOT (l_discount < 0.03 OR l_returnflag = 'N') AND l_linestatus <> 'O' THEN 'reach'
WHEN l_extendedprice > 30000 AND NOT (l_discount < 0.03 OR l_returnflag = 'N') THEN 'reposition' ELSE 'idle' END AS phase FROM lineitem"""
)
def phase_rules(spark, sf_dir):
    flags = {"wrist_pronate": F.col("l_quantity") > 40, "wrist_supinate": F.lit(False), "wrist_flex": F.col("l_tax") > 0.06, "power_grasp": F.col("l_discount") < 0.03, "lateral_pinch": F.col("l_returnflag") == "N", "contact_release": F.col("l_returnflag") == "R", "contact_onset": F.col("l_linestatus") == "O", "reach_onset": F.col("l_quantity") < 10, "transport": F.col("l_extendedprice") > 30000}
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", phases.phase(flags.get).alias("phase"))


# ---------------------------------------------------------------- time axes
# signups and purchases are looked up among the other events of their user
PROBES = "pr AS (SELECT user_id, i, t FROM ev WHERE event_type IN ('signup', 'purchase')), sa AS (SELECT user_id, t AS st, value FROM ev WHERE event_type NOT IN ('signup', 'purchase')), nb AS (SELECT p.user_id, p.i, p.t, b.st AS bt, b.value AS bv, a.st AS at_, a.value AS av FROM pr p ASOF LEFT JOIN sa b ON p.user_id = b.user_id AND p.t >= b.st ASOF LEFT JOIN sa a ON p.user_id = a.user_id AND p.t <= a.st)"


def probes(spark, sf_dir):
    ev, looked_up = events(spark, sf_dir, "value", "event_type"), F.col("event_type").isin("signup", "purchase")
    return ev.filter(looked_up).select("user_id", "i", "t"), ev.filter(~looked_up).select("user_id", F.col("t").alias("st"), "value")


@query(f"WITH {EV}, {PROBES} SELECT user_id, i, CASE WHEN bt IS NULL THEN at_ WHEN at_ IS NULL THEN bt WHEN at_ - t <= t - bt THEN at_ ELSE bt END AS nearest FROM nb")
def asof_nearest(spark, sf_dir):
    p, s = probes(spark, sf_dir)
    return asof.nearest(p, s, U, "t", "st").select("user_id", "i", "nearest")


@query(f"WITH {EV}, {PROBES} SELECT user_id, i, round(CASE WHEN bt IS NULL THEN av WHEN at_ IS NULL THEN bv WHEN at_ = bt THEN av ELSE bv + (av - bv) * (t - bt) / (at_ - bt) END, 6) AS value FROM nb")
def asof_interp(spark, sf_dir):
    p, s = probes(spark, sf_dir)
    return asof.interpolate(p, s, U, "t", "st", ["value"]).select("user_id", "i", F.round("value", 6).alias("value"))


SYNC = f"""{EV}, {PROBES}, md AS (SELECT user_id, median(dt) AS m FROM (SELECT user_id, (st - lag(st) OVER (PARTITION BY user_id ORDER BY st)) * 1000 AS dt FROM sa) WHERE dt IS NOT NULL GROUP BY user_id),
sy AS (SELECT user_id, i, least(abs(t - bt), abs(at_ - t)) * 1000 AS drift, bt IS NULL OR at_ IS NULL AS outside, coalesce(NOT (bt IS NULL OR at_ IS NULL) AND m > 0 AND (at_ - bt) * 1000 > 3 * m AND least(abs(t - bt), abs(at_ - t)) * 1000 > 0.25 * m, false) AS over_ FROM nb LEFT JOIN md USING (user_id))"""


def synced(spark, sf_dir):
    p, s = probes(spark, sf_dir)
    return sync.synchronise(p, s.withColumnRenamed("st", "t"), U, "t", ["value"])


@query(f"WITH {SYNC} SELECT user_id, i, round(drift, 3) AS drift_ms, outside AS outside_range, over_ AS over_dropout FROM sy")
def dropout_flags(spark, sf_dir):
    return synced(spark, sf_dir).select("user_id", "i", F.round("drift_ms", 3).alias("drift_ms"), "outside_range", "over_dropout")


@query(f"WITH {SYNC} SELECT user_id, round(max(drift), 3) AS max_drift_ms, round(coalesce(max(drift) FILTER (NOT over_ AND NOT outside), max(drift)), 3) AS max_drift_clean_ms, round(coalesce(avg(drift) FILTER (NOT over_ AND NOT outside), avg(drift)), 3) AS mean_drift_clean_ms, count(*) FILTER (over_) AS interpolated_frames FROM sy GROUP BY user_id")
def drift_stats(spark, sf_dir):
    out = sync.drift_stats(synced(spark, sf_dir), U)
    return out.select("user_id", *(F.round(c, 3).alias(c) for c in ("max_drift_ms", "max_drift_clean_ms", "mean_drift_clean_ms")), "interpolated_frames")


@query(
    f"""WITH {EV}, k AS (SELECT user_id, i, CASE WHEN event_type <> 'error' THEN value END AS v FROM ev),
f AS (SELECT user_id, i, max(CASE WHEN v IS NOT NULL THEN i END) OVER b AS bi, last_value(v IGNORE NULLS) OVER b AS bv, min(CASE WHEN v IS NOT NULL THEN i END) OVER a AS ai, first_value(v IGNORE NULLS) OVER a AS av FROM k
WINDOW b AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT user_id, i, round(CASE WHEN bi IS NULL THEN av WHEN ai IS NULL THEN bv WHEN ai = bi THEN av ELSE bv + (av - bv) * (i - bi) / (ai - bi) END, 6) AS filled FROM f"""
)
def fill_missing(spark, sf_dir):
    ev = events(spark, sf_dir, "value", "event_type").withColumn("v", F.when(F.col("event_type") != "error", F.col("value")))
    return asof.fill_missing(ev, U, "i", "v", "filled").select("user_id", "i", F.round("filled", 6).alias("filled"))


@query(
    f"""WITH {EV}, d AS (SELECT user_id, (t - lag(t) OVER (PARTITION BY user_id ORDER BY i)) * 1000 AS dt FROM ev), m AS (SELECT user_id, median(dt) AS md, stddev_pop(dt) AS sd, max(dt) AS mx FROM d WHERE dt IS NOT NULL GROUP BY user_id)
SELECT user_id, round(any_value(md), 3) AS median_ms, round(any_value(sd) / 1000, 3) AS std_s, count(*) FILTER (md > 0 AND dt > 1.5 * md) AS dropped FROM d JOIN m USING (user_id) WHERE dt IS NOT NULL GROUP BY user_id"""
)
def fps_consistency(spark, sf_dir):
    out = qa.fps_consistency(events(spark, sf_dir), U, "t")
    return out.select("user_id", F.round("median_ms", 3).alias("median_ms"), F.round(F.col("std_ms") / 1000, 3).alias("std_s"), "dropped")


# ---------------------------------------------------------------- scores
CLIP = "least(greatest({x}, 0), 1)"


@query(f"SELECT l_orderkey, l_linenumber, round(({CLIP.format(x='l_extendedprice / 200')} * 0.30 + {CLIP.format(x='l_quantity / 2')} * 0.20 + {CLIP.format(x='1 - l_quantity / 20')} * 0.20 + {CLIP.format(x='1 - l_discount * 100 / 10')} * 0.30) * 100, 6) AS qa_score, l_tax < 0.05 AND l_discount < 0.05 AS overall_passed FROM lineitem")
def qa_composite(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").withColumn("drift", F.col("l_discount") * 100).withColumn("a", F.col("l_tax") < 0.05).withColumn("b", F.col("l_discount") < 0.05)
    return qa.composite(li, "l_extendedprice", "l_quantity", "l_quantity", "drift", ["a", "b"]).select("l_orderkey", "l_linenumber", F.round("qa_score", 6).alias("qa_score"), "overall_passed")


PRIMITIVE = "CASE CAST(l_partkey % 6 AS INT) WHEN 0 THEN 'power_grasp' WHEN 1 THEN 'transport' WHEN 2 THEN 'reach_onset' WHEN 3 THEN 'contact_onset' WHEN 4 THEN 'wrist_pronate' ELSE 'finger_extend' END"
SIGNATURES = ", ".join(f"('{t}', '{p}', {n})" for t, s in TASK_SIGNATURES.items() for p, n in s.items())


@query(
    f"""WITH c AS (SELECT l_suppkey, {PRIMITIVE} AS primitive, count(*) AS n FROM lineitem GROUP BY ALL), g(task, primitive, required) AS (VALUES {SIGNATURES}),
s AS (SELECT k.l_suppkey, g.task, round(avg(least(coalesce(c.n, 0) / g.required, 1.0)), 4) AS score FROM (SELECT DISTINCT l_suppkey FROM c) k CROSS JOIN g LEFT JOIN c ON c.l_suppkey = k.l_suppkey AND c.primitive = g.primitive GROUP BY ALL),
m AS (SELECT *, max(score) OVER (PARTITION BY l_suppkey) AS top FROM s),
n AS (SELECT l_suppkey, any_value(top) AS top, count(*) FILTER (top - score <= 0.05 + 1e-12) AS near, arg_max(task, score) AS task FROM m GROUP BY l_suppkey)
SELECT l_suppkey, CASE WHEN top >= 0.5 AND near = 1 THEN task ELSE 'unknown' END AS L1_task, top AS confidence, NOT (top >= 0.5 AND near = 1) AS needs_human_review FROM n"""
)
def task_score(spark, sf_dir):
    name = F.element_at(F.array(*map(F.lit, ("power_grasp", "transport", "reach_onset", "contact_onset", "wrist_pronate", "finger_extend"))), (F.col("l_partkey") % 6).cast("int") + 1)
    counts = table(spark, sf_dir, "lineitem").groupBy("l_suppkey", name.alias("primitive")).agg(F.count(F.lit(1)).alias("n"))
    return tasks.classify(counts, ["l_suppkey"])


@query(f"WITH {EV} SELECT user_id, arg_max(x, (n, -f)) AS dominant FROM (SELECT user_id, event_type AS x, count(*) AS n, min(i) AS f FROM ev GROUP BY ALL) GROUP BY user_id")
def mode_first_seen(spark, sf_dir):
    return stats.first_on_ties(events(spark, sf_dir, "event_type"), U, "event_type", "i", "dominant")


@query(
    f"""WITH {EV}, c AS (SELECT user_id, i FROM ev WHERE event_type = 'click'), g AS (SELECT user_id, i AS gi FROM ev WHERE event_type = 'purchase'),
n AS (SELECT c.user_id, c.i, b.gi AS b, a.gi AS a FROM c ASOF LEFT JOIN g b ON c.user_id = b.user_id AND c.i >= b.gi ASOF LEFT JOIN g a ON c.user_id = a.user_id AND c.i <= a.gi),
o AS (SELECT user_id, (CASE WHEN b IS NULL THEN a WHEN a IS NULL THEN b WHEN a - i <= i - b THEN a ELSE b END - i) * 40.0 AS d FROM n),
r AS (SELECT user_id, count(*) AS events, count(*) FILTER (NOT (d > -50 AND d < 200)) AS inversions FROM o GROUP BY user_id)
SELECT u.user_id, coalesce(events, 0) AS events, coalesce(inversions, 0) AS inversions, coalesce(inversions / events, 0) < 0.3 AS passed FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN r USING (user_id)"""
)
def causal_inversions(spark, sf_dir):
    ev = events(spark, sf_dir, "event_type").withColumn("contact", F.col("event_type") == "click").withColumn("grasp", F.col("event_type") == "purchase")
    return validate.causal_order(ev, U, "i", "contact", "grasp", 40.0).select("user_id", "events", "inversions", "passed")


@query("WITH x(task, phase, least) AS (VALUES ('1-URGENT', 'F', 0.3), ('2-HIGH', 'O', 0.5), ('2-HIGH', 'P', 0.01)), n AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1) SELECT x.task AS o_orderpriority, x.phase, round(count(o_orderkey) / any_value(n.n), 9) AS proportion, count(o_orderkey) / any_value(n.n) >= any_value(x.least) AS met FROM x JOIN n ON n.o_orderpriority = x.task LEFT JOIN orders o ON o.o_orderpriority = x.task AND o.o_orderstatus = x.phase GROUP BY x.task, x.phase")
def phase_proportion(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderstatus")
    expected = {"1-URGENT": {"F": 0.3}, "2-HIGH": {"O": 0.5, "P": 0.01}}
    keys = orders.select("o_orderpriority").distinct().withColumn("L1_task", F.col("o_orderpriority"))
    found = validate.phase_proportions(orders, ["o_orderpriority"], "o_orderstatus", keys, expected)
    return found.select("o_orderpriority", "phase", F.round("proportion", 9).alias("proportion"), "met")


@query(
    """WITH c AS (SELECT c_custkey, c_acctbal, count(o_orderkey) AS n, count(o_orderkey) FILTER (o_orderstatus = 'F') AS f FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL),
r AS (SELECT c_custkey, greatest(1 - (n % 7) / 5, 0) * 0.3 + least(greatest(c_acctbal, 0) / 50 / 200, 1) * 0.2 + f / greatest(n, 1) * 0.2 + 0.5 * 0.15 + (CASE WHEN n % 2 = 0 THEN 1.0 ELSE greatest(1 - f / greatest(n, 1), 0) END) * 0.15 AS raw FROM c)
SELECT c_custkey, round(raw, 6) AS eis_raw, CASE WHEN raw * 100 >= 85 THEN 3 WHEN raw * 100 >= 70 THEN 2 ELSE 0 END AS tier FROM r"""
)
def eis_score(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal").join(orders, "c_custkey", "left").fillna(0, ["n", "f"])
    share = F.col("f") / F.greatest("n", F.lit(1))
    parts = eis.components(F.col("n") % 7, F.greatest("c_acctbal", F.lit(0.0)) / 50, share, F.lit(0.5), F.col("n") % 2 == 0, F.col("f"), F.col("n"))
    scored = eis.score(c, parts)
    size = F.when(F.col("eis_raw") * 100 >= 85, 3).when(F.col("eis_raw") * 100 >= 70, 2).otherwise(0)
    return scored.select("c_custkey", F.round("eis_raw", 6).alias("eis_raw"), size.alias("tier"))


@query("SELECT l_orderkey, round((0.123456789 * sum(l_quantity) + sum(l_discount * l_quantity)) / (2 * sum(l_quantity)), 4) AS label_confidence FROM lineitem GROUP BY l_orderkey")
def label_confidence(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    segs = li.select("l_orderkey", F.lit(0).alias("start_frame"), (F.col("l_quantity") - 1).cast("int").alias("end_frame"), F.col("l_discount").alias("mean_confidence"))
    eps = li.select("l_orderkey").distinct().withColumn("c", F.lit(0.123456789))
    return eis.label_confidence(eps, segs, ["l_orderkey"], "c").select("l_orderkey", "label_confidence")


@query(
    """WITH d AS (SELECT d.doc_id, least(n_chars / 10000, 1) AS a, l.quality AS b, 1 - l.toxic AS c FROM documents d LEFT JOIN labels l USING (doc_id)),
s AS (SELECT doc_id, (0.35 * a + coalesce(0.15 * b, 0) + coalesce(0.30 * c, 0)) / (0.35 + CASE WHEN b IS NULL THEN 0 ELSE 0.15 END + CASE WHEN c IS NULL THEN 0 ELSE 0.30 END) AS s FROM d)
SELECT doc_id, CAST(least(greatest(round_even(round(1 + 4 * s, 9), 0), 1), 5) AS INT) AS quality FROM s"""
)
def renorm_quality(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    d = d.select("doc_id", F.least(F.col("n_chars") / 10000, F.lit(1.0)).alias("perception_confidence"), F.col("quality").cast("double").alias("sync_integrity"), (1 - F.col("toxic")).cast("double").alias("calibration_completeness"))
    d = d.withColumn("contact_consistency", F.lit(None).cast("double")).withColumn("ik_convergence_rate", F.lit(None).cast("double"))
    return d.select("doc_id", quality().alias("quality"))


@query(f"WITH {EV}, w AS (SELECT user_id, CAST(floor((t - min(t) OVER (PARTITION BY user_id)) / 86400) AS BIGINT) AS win, value FROM ev) SELECT user_id, win AS \"window\", round(avg(value), 6) AS mean FROM w GROUP BY ALL HAVING avg(value) < 20")
def tumbling_mistakes(spark, sf_dir):
    s = Settings(mistake_window_s=86_400.0, mistake_floor=20.0)
    return mistakes(events(spark, sf_dir, "value"), U, "t", "value", s).select("user_id", "window", F.round("mean", 6).alias("mean"))


@query(f"WITH {EV} SELECT user_id, CASE WHEN count(t) < 2 THEN NULL WHEN max(t) - min(t) < 2400000 THEN 1 WHEN max(t) - min(t) > 2550000 THEN 3 ELSE 2 END AS speed FROM ev GROUP BY user_id")
def speed_bin(spark, sf_dir):
    return speed_bins(events(spark, sf_dir), U, "t", Settings(speed_fast_s=2_400_000.0, speed_slow_s=2_550_000.0))


# ---------------------------------------------------------------- arbitration and joins
@query(
    """WITH c AS (SELECT l_partkey, l_orderkey, l_linenumber, l_discount, CASE l_returnflag WHEN 'A' THEN 'measured_human' WHEN 'R' THEN 'vision_fallback' ELSE 'vision_primary' END AS provenance, CASE l_returnflag WHEN 'A' THEN 4 WHEN 'R' THEN 1 ELSE 2 END AS trust FROM lineitem)
SELECT l_partkey, l_orderkey, l_linenumber, provenance FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY trust DESC, l_discount DESC, l_orderkey, l_linenumber) AS p FROM c) WHERE p = 1"""
)
def arbitrate(spark, sf_dir):
    li = lineitem(spark, sf_dir, "l_partkey", "l_discount", "l_returnflag")
    li = li.withColumn("provenance", F.when(F.col("l_returnflag") == "A", "measured_human").when(F.col("l_returnflag") == "R", "vision_fallback").otherwise("vision_primary"))
    li = li.withColumn("ordinal", F.col("l_orderkey") * 100 + F.col("l_linenumber"))
    return fusion.arbitrate(li, ["l_partkey"], confidence="l_discount").select("l_partkey", "l_orderkey", "l_linenumber", "provenance")


@query("SELECT l_orderkey, l_linenumber, 0.7 * CAST(l_quantity > 25 AS INT) + 0.3 * CAST(l_discount > 0.05 AS INT) >= 0.5 AS vote, (l_quantity > 25) <> (l_discount > 0.05) AND abs(0.7 * CAST(l_quantity > 25 AS INT) + 0.3 * CAST(l_discount > 0.05 AS INT) - 0.5) < 0.3 AS disagreement FROM lineitem")
def fusion_vote(spark, sf_dir):
    li = lineitem(spark, sf_dir, "l_quantity", "l_discount")
    for p in prim.PRIMITIVES:
        one = p == "wrist_pronate"
        li = li.withColumn(f"v_{p}", (F.col("l_quantity") > 25) if one else F.lit(False)).withColumn(f"w_{p}", (F.col("l_discount") > 0.05) if one else F.lit(False))
    return prim.vote(li).select("l_orderkey", "l_linenumber", F.col("f_wrist_pronate").alias("vote"), "disagreement")


@query(f"WITH {EPISODES} SELECT ev.user_id, ev.i, e.episode_id FROM ev JOIN episodes e ON ev.user_id = e.user_id AND ev.i BETWEEN e.start_frame AND e.end_frame")
def interval_containment(spark, sf_dir):
    ev, _, eps = user_episodes(spark, sf_dir)
    return intervals.contained(ev.select("user_id", "i"), eps, U, "i", "start_frame", "end_frame", ["episode_id"])


@query(f"WITH {EPISODES} SELECT e.user_id, e.episode_id, r.run AS run, r.x AS phase FROM runs r JOIN episodes e ON r.user_id = e.user_id AND r.lo <= e.end_frame AND r.hi >= e.start_frame")
def interval_overlap(spark, sf_dir):
    _, segs, eps = user_episodes(spark, sf_dir)
    segs = segs.select("user_id", "run", "phase", F.col("start_frame").alias("s"), F.col("end_frame").alias("e"))
    return intervals.overlapping(eps.select("user_id", "episode_id", "start_frame", "end_frame"), segs, U, "start_frame", "end_frame", "s", "e").select("user_id", "episode_id", "run", "phase")


@query("SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)")
def anti_undeclared(spark, sf_dir):
    used = lineitem(spark, sf_dir, "l_partkey", "l_quantity").filter("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return table(spark, sf_dir, "part").select("p_partkey").join(used, "p_partkey", "left_anti")


@query("SELECT s_suppkey, CASE WHEN count(l_orderkey) = 0 THEN 'missing' ELSE 'ambiguous' END AS problem, count(l_orderkey) AS n FROM supplier LEFT JOIN lineitem ON l_suppkey = s_suppkey AND l_quantity = 50 AND l_discount > 0.08 GROUP BY s_suppkey HAVING count(l_orderkey) <> 1")
def missing_ambiguous(spark, sf_dir):
    big = lineitem(spark, sf_dir, "l_suppkey", "l_quantity", "l_discount").filter("l_quantity = 50 and l_discount > 0.08").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count(F.lit(1)).alias("n"))
    counts = table(spark, sf_dir, "supplier").select("s_suppkey").join(big, "s_suppkey", "left").fillna(0, ["n"])
    return counts.filter("n <> 1").select("s_suppkey", F.when(F.col("n") == 0, "missing").otherwise("ambiguous").alias("problem"), "n")


# ---------------------------------------------------------------- batch checks
@query("WITH o AS (SELECT doc_id, coalesce(lang, 'unknown') AS g, row_number() OVER (PARTITION BY coalesce(lang, 'unknown') ORDER BY doc_id) AS p, count(*) OVER (PARTITION BY coalesce(lang, 'unknown')) AS n FROM documents) SELECT doc_id, CASE WHEN p <= round_even(CAST(0.8 AS DOUBLE) * n, 0) THEN 'train' WHEN p <= round_even((CAST(0.8 AS DOUBLE) + CAST(0.1 AS DOUBLE)) * n, 0) THEN 'val' ELSE 'test' END AS split FROM o")
def stratified_split(spark, sf_dir):
    return dataset_qc.stratified_split(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id", "lang").select("doc_id", "split")


@query("SELECT max(n) / min(n) AS ratio, count(*) AS classes FROM (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang)")
def task_imbalance(spark, sf_dir):
    return stats.imbalance(table(spark, sf_dir, "documents"), "lang")


@query("SELECT array_to_string(list_sort(list(DISTINCT lang)), ',') AS classes, count(DISTINCT source) AS n_workers FROM documents")
def diversity(spark, sf_dir):
    return dataset_qc.diversity(table(spark, sf_dir, "documents"), "lang", "source").select(F.array_join("classes", ",").alias("classes"), "n_workers")


@query("WITH x AS (SELECT unnest(range(64)) AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) SELECT CAST(dim AS INT) AS dim, round(quantile_cont(x, 0.01), 6) AS p01, round(quantile_cont(x, 0.5), 6) AS p50, round(quantile_cont(x, 0.99), 6) AS p99, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std FROM x GROUP BY dim")
def norm_stats(spark, sf_dir):
    out = stats.field_stats(table(spark, sf_dir, "embeddings"), [], "embedding")
    return out.select("dim", *(F.round(c, 6).alias(c) for c in ("p01", "p50", "p99", "mean", "std")))


@query("WITH p AS (SELECT quantile_cont(l_extendedprice, 0.01) AS lo, quantile_cont(l_extendedprice, 0.99) AS hi FROM lineitem) SELECT l_orderkey, l_linenumber, round(least(greatest(2 * (l_extendedprice - lo) / (hi - lo) - 1, -1), 1), 6) AS x FROM lineitem, p")
def normalize_p01_p99(spark, sf_dir):
    li = lineitem(spark, sf_dir, "l_extendedprice")
    p = li.agg(F.percentile("l_extendedprice", F.array(F.lit(0.01), F.lit(0.99))).alias("p"))
    return stats.beside(li, p).select("l_orderkey", "l_linenumber", F.round(stats.normalised(F.col("l_extendedprice"), F.col("p")[0], F.col("p")[1]), 6).alias("x"))


# a bit for each of the 32 sums of a component and the one 32 places on
SIGNS = "sg AS (SELECT vec_id, list_reduce(list_transform(range(1, 33), lambda k: CAST(CASE WHEN embedding[k] + embedding[k + 32] > 0 THEN 1 ELSE 0 END AS BIGINT)), lambda a, b: a * 2 + b) AS h FROM embeddings)"


def signs(spark, sf_dir, *columns):
    sums = F.zip_with(F.slice("embedding", 1, 32), F.slice("embedding", 33, 32), lambda x, y: x + y)
    return table(spark, sf_dir, "embeddings").select("vec_id", *columns, strings.bits_to_long(F.transform(sums, lambda x: x > 0)).alias("h"))


@query(f"WITH {SIGNS} SELECT a.vec_id AS a, b.vec_id AS b, CAST(bit_count(xor(a.h, b.h)) AS INT) AS distance FROM sg a JOIN sg b ON a.vec_id < b.vec_id AND bit_count(xor(a.h, b.h)) <= 5")
def hamming_pairs(spark, sf_dir):
    return dataset_qc.pairs_within(signs(spark, sf_dir), "vec_id", "h", 5, 32)


@query()
def dedup_greedy(spark, sf_dir):
    out = dataset_qc.greedy_duplicates_of_all(signs(spark, sf_dir, "label"), "vec_id", "h", Settings(duplicate_similarity=0.8, hash_bits=32))
    return out.select("label", "vec_id", "duplicate_of", "similarity")


@query("SELECT sha256(text) AS content_hash, count(*) AS items, min(doc_id) AS first_item FROM documents WHERE text IS NOT NULL GROUP BY 1")
def exact_dedup(spark, sf_dir):
    return dataset_qc.content_groups(table(spark, sf_dir, "documents"), "doc_id", "text")


@query("WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings) SELECT a.vec_id, arg_max(b.vec_id, (round(list_cosine_similarity(a.v, b.v), 12), -b.vec_id)) AS nearest, round(max(list_cosine_similarity(a.v, b.v)), 6) AS similarity FROM e a JOIN e b ON a.vec_id <> b.vec_id GROUP BY a.vec_id")
def vector_nn(spark, sf_dir):
    return dataset_qc.nearest_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding").withColumn("similarity", F.round("similarity", 6))


@query("SELECT doc_id, CAST('0x' || sha256(CAST(doc_id AS VARCHAR))[1:8] AS BIGINT) / 4294967295.0 < 0.2 AS checked FROM documents")
def hash_sample(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", strings.spot_check(F.col("doc_id").cast("string"), 0.2).alias("checked"))


@query("WITH n AS (SELECT lang, count(*) AS n FROM documents GROUP BY lang), s AS (SELECT lang, n, unnest(range(20)) AS k FROM n) SELECT DISTINCT lang, CAST(round_even(k * (n - 1) / 19, 0) AS BIGINT) AS idx FROM s WHERE n > 20 UNION SELECT lang, unnest(range(n)) FROM n WHERE n <= 20")
def linspace_sample(spark, sf_dir):
    n = table(spark, sf_dir, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    return n.select("lang", F.explode(strings.even_indices(F.col("n"), F.lit(20))).alias("idx"))


@query("SELECT l_returnflag, count(*) FILTER (l_discount * 10 < 0.3) AS \"ignore\", count(*) FILTER (l_discount * 10 >= 0.3 AND l_discount * 10 < 0.7) AS blur_and_flag, count(*) FILTER (l_discount * 10 >= 0.7) AS blur FROM lineitem GROUP BY l_returnflag")
def text_tiers(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", (F.col("l_discount") * 10).alias("c"))
    return privacy.tier_counts(li, ["l_returnflag"], "c")


@query(f"WITH {EV}, l AS (SELECT user_id, i, max(CASE WHEN event_type = 'purchase' THEN i END) OVER (PARTITION BY user_id ORDER BY i) AS last FROM ev) SELECT user_id, i, coalesce(i - last <= 4, false) AS active FROM l")
def ttl_regions(spark, sf_dir):
    ev = events(spark, sf_dir, "event_type").withColumn("seen", F.col("event_type") == "purchase")
    return privacy.active_regions(ev, U, "i", "seen", Settings(ocr_grace=4, ocr_interval=5)).select("user_id", "i", "active")


# ---------------------------------------------------------------- text
@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN 'Idle period with no active manipulation. Duration: ' || printf('%.1f', p_size / 2) || 's.' ELSE 'Perform ' || p_type || ' task using ' || CASE WHEN p_size % 2 = 0 THEN 'left' ELSE 'right' END || ' hand with power grasp. Duration: ' || printf('%.1f', p_size / 2) || 's.' END AS instruction FROM part")
def template_fill(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("L1_task", F.when(F.col("p_size") % 3 == 0, "idle").otherwise(F.col("p_type"))).withColumn("duration_sec", F.col("p_size") / 2)
    p = p.withColumn("dominant_hand", F.when(F.col("p_size") % 2 == 0, "left").otherwise("right")).withColumn("grasp_type", F.lit("power grasp"))
    p = p.withColumn("object_class", F.lit("the object")).withColumn("target_location", F.lit("the target location")).withColumn("outcome", F.lit("attempted"))
    return language.ground(p).select("p_partkey", "instruction")


@query(
    """WITH b AS (SELECT p_partkey, regexp_replace(trim('Move the ' || p_name || '. '), '\\.+$', '') AS b FROM part), l AS (SELECT p_partkey, b, lower(b[1:1]) || b[2:] AS l FROM b),
s AS (SELECT *, replace(replace(replace(replace(replace(replace(l, 'sort', 'organize'), 'staple', 'fasten'), 'pick up', 'grab'), 'place', 'put'), 'move', 'transport'), 'workbench', 'work surface') AS s FROM l)
SELECT p_partkey, b || '.' || '|' || upper(s[1:1]) || lower(s[2:]) || '.' || '|' || 'Please ' || l || '.' AS variants FROM s"""
)
def paraphrases(spark, sf_dir):
    task = F.concat(F.lit("Move the "), F.col("p_name"), F.lit(". "))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(strings.paraphrases(task, 3), "|").alias("variants"))


@query("WITH n AS (SELECT p_partkey, replace(replace(lower(trim(p_type)), ' ', '_'), '-', '_') AS g, CASE WHEN p_size % 4 = 0 THEN 'unknown' WHEN p_size % 2 = 0 THEN replace(lower(p_type), ' ', '_') ELSE 'box_seal' END AS l FROM part) SELECT p_partkey, g <> '' AND g <> l AND l <> 'unknown' AS disagree FROM n")
def task_disagree(spark, sf_dir):
    label = F.when(F.col("p_size") % 4 == 0, "unknown").when(F.col("p_size") % 2 == 0, F.upper("p_type")).otherwise("Box-Seal")
    return table(spark, sf_dir, "part").select("p_partkey", strings.disagree(F.col("p_type"), label).alias("disagree"))


@query("WITH p AS (SELECT page_id, string_split(regexp_extract(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/(.*)$', 1), '/')[-1] AS f FROM pages) SELECT page_id, CASE WHEN f = '' THEN 'download' ELSE f END AS filename FROM p")
def url_filename(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", strings.url_filename(F.col("url")).alias("filename"))


LOG = "lg AS (SELECT user_id, i, '[' || event_type || '] ' || CASE WHEN value < 10 THEN 'FAILED' ELSE 'done' END || ' (' || CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) || 's)' AS line FROM ev)"


@query(f"WITH {EV}, {LOG}, p AS (SELECT user_id, i, regexp_extract(line, '^\\[(\\w+)\\] (\\w+) \\((\\d+)s\\)$', 1) AS stage, regexp_extract(line, '^\\[(\\w+)\\] (\\w+) \\((\\d+)s\\)$', 2) AS status, CAST(regexp_extract(line, '^\\[(\\w+)\\] (\\w+) \\((\\d+)s\\)$', 3) AS BIGINT) AS s FROM lg) SELECT user_id, stage, CAST(sum(s) AS BIGINT) AS seconds, arg_max(status, i) AS status FROM p GROUP BY user_id, stage")
def log_parse(spark, sf_dir):
    line = F.concat(F.lit("["), F.col("event_type"), F.lit("] "), F.when(F.col("value") < 10, "FAILED").otherwise("done"), F.lit(" ("), F.floor("value").cast("string"), F.lit("s)"))
    return logs.stage_status(events(spark, sf_dir, "value", "event_type").withColumn("line", line), U, "i", "line")


@query("SELECT event_id, coalesce(CAST(json_extract_string(props, '$.timestamp_ns') AS DOUBLE), CAST(json_extract_string(props, '$.k') AS DOUBLE) * 1000) AS ns FROM events")
def json_alias_scan(spark, sf_dir):
    record = F.from_json("props", "map<string,string>")
    return table(spark, sf_dir, "events").select("event_id", F.coalesce(record["timestamp_ns"].try_cast("double"), record["k"].try_cast("double") * 1000).alias("ns"))


# ---------------------------------------------------------------- arrays and statistics
@query("WITH b AS (SELECT l_orderkey, l_linenumber, l_quantity AS x1, l_discount * 100 AS y1, l_quantity + 10 AS x2, l_discount * 100 + 5 AS y2 FROM lineitem), o AS (SELECT *, greatest(least(x2, 30) - greatest(x1, 10), 0) * greatest(least(y2, 8) - greatest(y1, 2), 0) AS w FROM b) SELECT l_orderkey, l_linenumber, round(CASE WHEN (x2 - x1) * (y2 - y1) + 120 - w > 0 THEN w / ((x2 - x1) * (y2 - y1) + 120 - w) ELSE 0 END, 9) AS iou FROM o")
def box_iou(spark, sf_dir):
    q, d = F.col("l_quantity"), F.col("l_discount") * 100
    return lineitem(spark, sf_dir, "l_quantity", "l_discount").select("l_orderkey", "l_linenumber", F.round(geo.iou(F.array(q, d, q + 10, d + 5), geo.vector(10, 2, 30, 8)), 9).alias("iou"))


@query(
    f"""WITH {EV}, b AS (SELECT *, value > 35 AS on_ FROM ev), {RUNS.format(x="on_", src="b")},
a AS (SELECT user_id, string_agg(CAST(n AS VARCHAR), ',' ORDER BY run) AS r, CAST(sum(n) AS BIGINT) AS total, arg_min(x, run) AS first_ FROM runs GROUP BY user_id)
SELECT user_id, total || 'x1:' || CASE WHEN first_ THEN '0,' ELSE '' END || r AS rle FROM a"""
)
def rle_encode(spark, sf_dir):
    ev = events(spark, sf_dir, "value").withColumn("on", F.col("value") > 35)
    bits = ev.groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "on"))), lambda x: x["on"]).alias("bits"))
    return bits.select("user_id", geo.encode_rle(F.col("bits"), F.size("bits"), F.lit(1)).alias("rle"))


@query("WITH w AS (SELECT l_suppkey, l_extendedprice AS v, sum(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice) AS s, sum(l_quantity) OVER (PARTITION BY l_suppkey) AS a FROM lineitem) SELECT l_suppkey, min(v) AS median FROM w WHERE s >= a / 2 GROUP BY l_suppkey")
def weighted_median(spark, sf_dir):
    return stats.weighted_median(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_extendedprice", "l_quantity", "median")


@query("WITH d AS (SELECT label, list_max(list_transform(list_zip(embedding, lag(embedding) OVER (PARTITION BY label ORDER BY vec_id)), lambda z: abs(z[1] - z[2]))) > 0.45 AS j FROM embeddings) SELECT label, count(*) FILTER (j) AS teleports FROM d GROUP BY label")
def teleports(spark, sf_dir):
    return retarget.teleports(table(spark, sf_dir, "embeddings"), ["label"], "vec_id", "embedding", 0.45)


@query("SELECT l_suppkey, round(regr_slope(l_extendedprice, l_quantity), 6) AS scale, round(regr_intercept(l_extendedprice, l_quantity), 4) AS shift, CAST(regr_count(l_extendedprice, l_quantity) AS BIGINT) AS n FROM lineitem GROUP BY l_suppkey")
def affine_fit(spark, sf_dir):
    return stats.affine_fit(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_extendedprice", "l_quantity").select("l_suppkey", F.round("scale", 6).alias("scale"), F.round("shift", 4).alias("shift"), "n")


# ---------------------------------------------------------------- packaging
@query("SELECT o.o_orderkey, coalesce(o.o_orderpriority, 'unknown') AS L1_task, l.l_linenumber, l.l_returnflag AS phase FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey WHERE l.l_linenumber >= 2")
def package_nested(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    eps = orders.select("o_orderkey", F.col("o_orderkey").alias("episode_id"), F.lit(2).alias("start_frame"), F.lit(99).alias("end_frame"))
    on = F.col("o_orderkey").alias("episode_id")
    labels = orders.select("o_orderkey", on, F.col("o_orderpriority").alias("L1_task"), F.lit(1.0).alias("confidence"))
    marks = orders.select("o_orderkey", on, F.lit(80).alias("eis"), F.array().cast("array<string>").alias("flags"))
    li = lineitem(spark, sf_dir, "l_returnflag").withColumnRenamed("l_orderkey", "o_orderkey")
    segs = li.select("o_orderkey", F.col("l_returnflag").alias("phase"), F.col("l_linenumber").alias("start_frame"), F.col("l_linenumber").alias("end_frame"), F.lit(0.5).alias("mean_confidence"))
    frames = li.select("o_orderkey", F.col("l_linenumber").alias("frame"), F.array("l_returnflag").alias("active_primitives"))
    nested = package.nested_labels(eps, labels, segs, frames, marks, ["o_orderkey"], "frame")
    return nested.select("o_orderkey", "L1_task", F.explode("L2_phases").alias("p")).select("o_orderkey", "L1_task", F.col("p.start_frame").alias("l_linenumber"), F.col("p.phase").alias("phase"))


@query("SELECT count(*) AS episode_count, CAST(sum(n_chars) AS BIGINT) AS total_frames, count(DISTINCT lang) AS scene_count, count(*) FILTER (l.doc_id IS NULL) AS unknown_demonstrator, round(avg(l.quality), 9) AS mean_quality FROM documents d LEFT JOIN labels l USING (doc_id)")
def manifest(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    d = d.select(F.col("lang").alias("scene_id"), F.col("toxic").alias("demonstrator_id"), F.col("lang").alias("task"), F.lit(None).cast("string").alias("tier"), "quality", F.lit(None).cast("double").alias("effective_hours"), F.col("n_chars").alias("n_frames"))
    return package.manifest(d).select("episode_count", "total_frames", "scene_count", "unknown_demonstrator", F.round("mean_quality", 9).alias("mean_quality"))


@query("SELECT conv_id, turn, turn = min(turn) OVER w AS is_first, turn = max(turn) OVER w AS is_last FROM conversations WINDOW w AS (PARTITION BY conv_id)")
def step_flags(spark, sf_dir):
    return package.steps(table(spark, sf_dir, "conversations").select("conv_id", "turn"), ["conv_id"], "turn").select("conv_id", "turn", "is_first", "is_last")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 5")
def topk_worst(spark, sf_dir):
    return sync.worst(lineitem(spark, sf_dir, "l_extendedprice"), "l_extendedprice", ["l_orderkey", "l_linenumber"])


@query(f"WITH {EPISODES}, s AS (SELECT e.user_id, e.episode_id, count(*) AS frames, round(avg(ev.value), 6) AS mean_value, count(*) FILTER (ev.value >= 30) AS active FROM episodes e JOIN ev ON ev.user_id = e.user_id AND ev.i BETWEEN e.start_frame AND e.end_frame GROUP BY ALL) SELECT *, round(100 * active / frames, 6) AS score FROM s")
def episode_scores(spark, sf_dir):
    return flagship(spark, sf_dir)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Episodes of every session with their frames, mean signal, active frames and score."""
    ev, _, eps = user_episodes(spark, sf_dir)
    inside = intervals.contained(ev.select("user_id", "i", "value"), eps, U, "i", "start_frame", "end_frame", ["episode_id"])
    out = inside.groupBy("user_id", "episode_id").agg(F.count(F.lit(1)).alias("frames"), F.round(F.avg("value"), 6).alias("mean_value"), F.count_if(F.col("value") >= 30).alias("active"))
    return out.withColumn("score", F.round(100 * F.col("active") / F.col("frames"), 6))



from motolake.plans import scalar_bindings  # noqa: E402, F401  (registers further queries)
