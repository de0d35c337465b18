"""Queries that apply scalar functions and small operators to the driver's tables, and their SQL.

An embedding's 64 numbers stand for points, boxes, rotations and masks.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from motolake.functions import confidence as conf
from motolake.functions import geometry as geo
from motolake.functions import strings
from motolake.operators import alignment, canonical, certify, consent, package, privacy, qa, retarget, stats, sync
from motolake.operators import windows as win
from motolake.plans.bindings import EV, LEVEL, ORACLE_SQL, RUNS, SIGNS, U, dedup_greedy, events, lineitem, query, table
from motolake.settings import DEFAULT

E = "e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"


def numbers(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("e"))


def n(i: int):
    """The i-th number, from 1."""
    return F.get("e", i - 1)


def part(i: int, length: int):
    return F.slice("e", i, length)


def unit(i: int):
    return geo.normalise(part(i, 4))


def rounded(**columns):
    return [F.round(c, 6).alias(k) for k, c in columns.items()]


def q_sql(name: str, i: int) -> str:
    """Columns of a unit quaternion made of four numbers."""
    size = "sqrt(" + " + ".join(f"e[{k}] * e[{k}]" for k in range(i, i + 4)) + ")"
    return ", ".join(f"e[{i + k}] / {size} AS {name}{c}" for k, c in enumerate("wxyz"))


def m_sql(q: str) -> list[str]:
    """The nine numbers of a quaternion's matrix."""
    w, x, y, z = (f"{q}{c}" for c in "wxyz")
    return [f"(1 - 2 * ({y} * {y} + {z} * {z}))", f"(2 * ({x} * {y} - {w} * {z}))", f"(2 * ({x} * {z} + {w} * {y}))", f"(2 * ({x} * {y} + {w} * {z}))", f"(1 - 2 * ({x} * {x} + {z} * {z}))", f"(2 * ({y} * {z} - {w} * {x}))", f"(2 * ({x} * {z} - {w} * {y}))", f"(2 * ({y} * {z} + {w} * {x}))", f"(1 - 2 * ({x} * {x} + {y} * {y}))"]


def rotate_sql(q: str, v: list[str], back: bool = False) -> list[str]:
    m = m_sql(q)
    return ["(" + " + ".join(f"{m[3 * k + r] if back else m[3 * r + k]} * ({v[k]})" for k in range(3)) + ")" for r in range(3)]


# ---------------------------------------------------------------- geometry
@query(f"WITH {E}, d AS (SELECT vec_id, (e[1] - e[4]) * (e[7] - e[4]) + (e[2] - e[5]) * (e[8] - e[5]) + (e[3] - e[6]) * (e[9] - e[6]) AS d, list_distance(e[1:3], e[4:6]) * list_distance(e[7:9], e[4:6]) AS s FROM e) SELECT vec_id, round(CASE WHEN s = 0 THEN pi() ELSE acos(greatest(-1, least(1, d / s))) END, 6) AS angle FROM d")
def joint_angles(spark, sf_dir):
    return numbers(spark, sf_dir).select("vec_id", *rounded(angle=geo.joint_angle(part(1, 3), part(4, 3), part(7, 3))))


@query("SELECT l_orderkey, l_linenumber, round(x - 2 * pi() * floor((x + pi()) / (2 * pi())), 6) AS angle FROM (SELECT *, (l_extendedprice - 30000) / 1000 AS x FROM lineitem)")
def wrapped_angles(spark, sf_dir):
    return lineitem(spark, sf_dir, "l_extendedprice").select("l_orderkey", "l_linenumber", *rounded(angle=geo.wrap_angle((F.col("l_extendedprice") - 30000) / 1000)))


@query(f"WITH {E} SELECT vec_id, round(list_distance(e[1:3], e[4:6]), 6) AS distance, round((e[2] + e[5]) / 2, 6) AS middle, round((e[1] + e[3] + e[5]) / 3, 6) AS mean_x, round((e[2] + e[4] + e[6]) / 3, 6) AS mean_y FROM e")
def point_measures(spark, sf_dir):
    centre = geo.mean_point(F.array(part(1, 2), part(3, 2), part(5, 2)))
    return numbers(spark, sf_dir).select("vec_id", *rounded(distance=geo.distance(part(1, 3), part(4, 3)), middle=F.get(geo.midpoint(part(1, 3), part(4, 3)), 1), mean_x=centre[0], mean_y=centre[1]))


PICK = "CAST(greatest(0, least(round_even({v} * 8, 0), 7)) AS INT)"
FOCAL = "(640 / (2 * tan(radians(41.0))))"


@query(
    f"""WITH {E}, s AS (SELECT vec_id, (vec_id % 11) / 10 AS x, (vec_id % 7) / 6 AS y, e FROM e), d AS (SELECT vec_id, x, y, e[{PICK.format(v='y')} * 8 + {PICK.format(v='x')} + 1] AS d FROM s),
p AS (SELECT vec_id, x, y, CASE WHEN d > 0 THEN d END AS d FROM d) SELECT vec_id, round(d, 6) AS depth, round((x * 640 - 320) * d / {FOCAL}, 5) AS px, round((y * 480 - 240) * d / {FOCAL}, 5) AS py FROM p"""
)
def depth_samples(spark, sf_dir):
    rows = numbers(spark, sf_dir).withColumn("map", F.transform(F.sequence(F.lit(0), F.lit(7)), lambda r: F.slice("e", r * 8 + 1, 8)))
    x, y = F.col("vec_id") % 11 / 10, F.col("vec_id") % 7 / 6
    w, h = F.lit(640), F.lit(480)
    rows = rows.withColumn("d", geo.sample_depth(F.col("map"), x, y))
    at = geo.lift(x, y, F.col("d"), geo.pinhole(w, h), w, h)
    return rows.select("vec_id", F.round("d", 6).alias("depth"), F.round(at[0], 5).alias("px"), F.round(at[1], 5).alias("py"))


@query(f"WITH {E}, p AS (SELECT vec_id, e[1] AS x, e[2] AS y, e[3] + 0.1 AS z FROM e) SELECT vec_id, CASE WHEN z > 1e-6 THEN round(({FOCAL} * x / z + 320) * 0.5, 3) END AS u, CASE WHEN z > 1e-6 THEN round(({FOCAL} * y / z + 240) * 2, 3) END AS v FROM p")
def projected_points(spark, sf_dir):
    k = geo.pinhole(F.lit(640), F.lit(480))
    pixels = geo.project(F.array(F.array(n(1), n(2), n(3) + 0.1)), k, F.lit(0.5), F.lit(2.0))
    return numbers(spark, sf_dir).select("vec_id", F.round(pixels[0][0], 3).alias("u"), F.round(pixels[0][1], 3).alias("v"))


@query(
    f"""WITH {E}, q AS (SELECT vec_id, {q_sql("q", 1)} FROM e), s AS (SELECT *, CASE greatest(abs(qw), abs(qx), abs(qy), abs(qz)) WHEN abs(qw) THEN sign(qw) WHEN abs(qx) THEN sign(qx) WHEN abs(qy) THEN sign(qy) ELSE sign(qz) END AS s FROM q)
SELECT vec_id, {", ".join(f"round({m}, 6) AS m{i}" for i, m in enumerate(m_sql("q")))}, {", ".join(f"round(s * q{c}, 6) AS back_{c}" for c in "wxyz")} FROM s"""
)
def quaternion_matrices(spark, sf_dir):
    rows = numbers(spark, sf_dir).withColumn("m", geo.quaternion_to_matrix(unit(1)))
    rows = rows.withColumn("q", geo.matrix_to_quaternion(F.col("m")))
    return rows.select("vec_id", *rounded(**{f"m{i}": F.get("m", i) for i in range(9)}, **{f"back_{c}": F.get("q", i) for i, c in enumerate("wxyz")}))


TURNED = rotate_sql("q", ["e[5]", "e[6]", "e[7]"])


@query(f"WITH {E}, q AS (SELECT vec_id, e, {q_sql('q', 1)} FROM e) SELECT vec_id, {', '.join(f'round({x}, 6) AS {c}' for x, c in zip(TURNED, 'xyz', strict=True))} FROM q")
def rotated_vectors(spark, sf_dir):
    turned = numbers(spark, sf_dir).select("vec_id", geo.rotate(unit(1), part(5, 3)).alias("v"))
    return turned.select("vec_id", *rounded(**{c: F.get("v", i) for i, c in enumerate("xyz")}))


SEEN = rotate_sql("a", ["e[8] - e[1]", "e[9] - e[2]", "e[10] - e[3]"], back=True)
TURN = ["aw * bw + ax * bx + ay * by_ + az * bz", "aw * bx - ax * bw - ay * bz + az * by_", "aw * by_ + ax * bz - ay * bw - az * bx", "aw * bz - ax * by_ + ay * bx - az * bw"]


@query(f"WITH {E}, q AS (SELECT vec_id, e, {q_sql('a', 4)}, {q_sql('b', 11).replace('AS by', 'AS by_')} FROM e) SELECT vec_id, {', '.join(f'round({x}, 6) AS {c}' for x, c in zip(SEEN, 'xyz', strict=True))}, {', '.join(f'round({x}, 6) AS q{c}' for x, c in zip(TURN, 'wxyz', strict=True))} FROM q")
def relative_poses(spark, sf_dir):
    rows = numbers(spark, sf_dir).select("vec_id", geo.relative(geo.pose(part(1, 3), unit(4)), geo.pose(part(8, 3), unit(11))).alias("p"))
    place, turn = F.col("p.position_m"), F.col("p.quaternion_wxyz")
    return rows.select("vec_id", *rounded(**{c: F.get(place, i) for i, c in enumerate("xyz")}, **{f"q{c}": F.get(turn, i) for i, c in enumerate("wxyz")}))


LATER = rotate_sql("f", ["e[15]", "e[16]", "e[17]"])
NOW = rotate_sql("a", [f"{LATER[i]} + e[{8 + i}] - e[{1 + i}]" for i in range(3)], back=True)


@query(f"WITH {E}, q AS (SELECT vec_id, e, {q_sql('a', 4)}, {q_sql('f', 11)} FROM e) SELECT vec_id, vec_id % 5 = 0 AS contaminated, {', '.join(f'CASE WHEN vec_id % 5 <> 0 THEN round({x}, 6) END AS {c}' for x, c in zip(NOW, 'xyz', strict=True))} FROM q")
def reprojected_poses(spark, sf_dir):
    now = F.when(F.col("vec_id") % 5 != 0, geo.pose(part(1, 3), unit(4)))
    rows = numbers(spark, sf_dir).withColumn("now", now)
    moved = geo.reproject(geo.pose(part(15, 3), unit(18)), F.col("now"), geo.pose(part(8, 3), unit(11)))
    rows = rows.select("vec_id", geo.ego_contaminated(F.col("now")).alias("contaminated"), moved["position_m"].alias("p"))
    return rows.select("vec_id", "contaminated", *rounded(**{c: F.get("p", i) for i, c in enumerate("xyz")}))


@query(f"WITH {E}, a AS (SELECT vec_id, e, sqrt(e[1] * e[1] + e[2] * e[2] + e[3] * e[3]) AS a FROM e) SELECT vec_id, round(cos(a / 2), 6) AS w, round(e[1] * sin(a / 2) / a, 6) AS x, round(e[2], 6) AS back FROM a")
def axis_angles(spark, sf_dir):
    rows = numbers(spark, sf_dir).withColumn("q", geo.axis_angle_to_quaternion(part(1, 3)))
    back = geo.matrix_to_axis_angle(geo.quaternion_to_matrix(F.col("q")))
    return rows.select("vec_id", *rounded(w=F.get("q", 0), x=F.get("q", 1), back=F.get(back, 1)))


SIX = f"""{E}, x AS (SELECT vec_id, e, sqrt(e[1] * e[1] + e[2] * e[2] + e[3] * e[3]) AS s FROM e), u AS (SELECT vec_id, e, e[1] / s AS a, e[2] / s AS b, e[3] / s AS c FROM x),
o AS (SELECT *, a * e[4] + b * e[5] + c * e[6] AS d FROM u), p AS (SELECT vec_id, a, b, c, e[4] - d * a AS p, e[5] - d * b AS q, e[6] - d * c AS r FROM o), y AS (SELECT vec_id, a, b, c, p / sqrt(p * p + q * q + r * r) AS p, q / sqrt(p * p + q * q + r * r) AS q, r / sqrt(p * p + q * q + r * r) AS r FROM p)"""


@query(f"WITH {SIX} SELECT vec_id, round(a, 6) AS m0, round(p, 6) AS m1, round(b * r - c * q, 6) AS m2, round(b, 6) AS m3, round(q, 6) AS m4, round(c * p - a * r, 6) AS m5 FROM y")
def six_number_rotations(spark, sf_dir):
    rows = numbers(spark, sf_dir).select("vec_id", geo.rot6d_to_matrix(part(1, 6)).alias("m"))
    return rows.select("vec_id", *rounded(**{f"m{i}": F.get("m", i) for i in range(6)}))


def curl_sql(a: int) -> str:
    p = [f"e[{3 * k + 1}:{3 * k + 3}]" for k in range(a, a + 4)]
    path = " + ".join(f"list_distance({x}, {y})" for x, y in zip(p, p[1:], strict=False))
    return f"greatest(0, 1 - list_distance({p[0]}, {p[3]}) / ({path}))"


@query(f"WITH {E}, c AS (SELECT vec_id, {', '.join(f'{curl_sql(a)} AS {f}' for a, f in ((5, 'index_'), (9, 'middle'), (13, 'ring'), (17, 'pinky')))} FROM e) SELECT vec_id, round(index_, 6) AS index_, round(pinky, 6) AS pinky, round((index_ + middle + ring + pinky) / 4, 6) AS grasp FROM c")
def finger_curls(spark, sf_dir):
    rows = numbers(spark, sf_dir).withColumn("points", F.transform(F.sequence(F.lit(0), F.lit(20)), lambda k: F.slice("e", 3 * k + 1, 3)))
    curl = geo.finger_curl(F.col("points"))
    return rows.select("vec_id", *rounded(index_=curl["index"], pinky=curl["pinky"], grasp=geo.grasp_signal(F.col("points"))))


@query(
    f"""WITH {E}, m AS (SELECT vec_id, list_transform(e[1:32], lambda x: x > 0) AS a, list_transform(e[33:64], lambda x: x > 0) AS b FROM e),
c AS (SELECT vec_id, len(list_filter(range(1, 33), lambda i: a[i] AND b[i])) AS both_, len(list_filter(range(1, 33), lambda i: a[i] OR b[i])) AS any_, list_filter(range(0, 32), lambda i: a[i + 1]) AS on_ FROM m)
SELECT vec_id, round(CASE WHEN any_ = 0 THEN 1 ELSE both_ / any_ END, 6) AS iou, len(on_) AS pixels, round(list_min(list_transform(on_, lambda i: i // 4)) / 8, 6) AS x1, round(list_max(list_transform(on_, lambda i: i % 4)) / 4, 6) AS y2, round(list_avg(list_transform(on_, lambda i: i // 4)) / 8, 6) AS cx FROM c"""
)
def masks(spark, sf_dir):
    rows = numbers(spark, sf_dir).select("vec_id", F.transform(part(1, 32), lambda x: x > 0).alias("a"), F.transform(part(33, 32), lambda x: x > 0).alias("b"))
    back = geo.decode_rle(geo.encode_rle(F.col("a"), F.lit(4), F.lit(8)))
    rows = rows.withColumn("back", back).withColumn("box", geo.mask_box(F.col("back"), F.lit(8), F.lit(4)))
    pixels = F.size(F.filter("back", lambda x: x)).cast("long")
    return rows.select("vec_id", pixels.alias("pixels"), *rounded(iou=geo.mask_iou(F.col("a"), F.col("b")), x1=F.col("box.bbox")[0], y2=F.col("box.bbox")[3], cx=F.col("box.centroid")[0]))


@query(f"WITH {E}, d AS (SELECT vec_id, [sqrt(pow(e[1] - e[3], 2) + pow(e[2] - e[4], 2)), sqrt(pow(e[1] - e[5], 2) + pow(e[2] - e[6], 2)), sqrt(pow(e[1] - e[7], 2) + pow(e[2] - e[8], 2))] AS d FROM e) SELECT vec_id, round(list_min(d), 6) AS distance, ['cup', 'box', 'pen'][list_position(d, list_min(d))] AS label FROM d")
def nearest_objects(spark, sf_dir):
    objects = F.array(*(F.struct(F.lit(name).alias("label"), part(i, 2).alias("centroid_norm")) for name, i in (("cup", 3), ("box", 5), ("pen", 7))))
    found = numbers(spark, sf_dir).select("vec_id", geo.nearest_object(part(1, 2), objects).alias("f"))
    return found.select("vec_id", F.round("f.distance", 6).alias("distance"), F.col("f.object.label").alias("label"))


BOX = "[e[1], e[2], e[1] + 0.3, e[2] + 0.3]"
MEET = "(greatest(least(e[1], e[3]) + 0.3 - greatest(e[1], e[3]), 0) * greatest(least(e[2], e[4]) + 0.3 - greatest(e[2], e[4]), 0))"


@query(f"WITH {E} SELECT vec_id, vec_id % 3 <> 0 AND {MEET} / (0.18 - {MEET}) >= 0.05 AS near, CAST(greatest(0, least(trunc(e[1] * 100), 20)) AS INT) AS x1, CAST(greatest(0, least(trunc((e[2] + 0.3) * 100), 10)) AS INT) AS y2 FROM e")
def near_objects(spark, sf_dir):
    def box(i):
        return F.array(n(i), n(i + 1), n(i) + 0.3, n(i + 1) + 0.3)

    objects = F.array(F.struct(F.when(F.col("vec_id") % 3 == 0, "Left Hand").otherwise("cup").alias("label"), box(3).alias("bbox")))
    clamped = geo.clamp_box(F.transform(box(1), lambda x: x * 100), F.lit(20), F.lit(10))
    return numbers(spark, sf_dir).select("vec_id", geo.near_object(box(1), objects).alias("near"), clamped[0].alias("x1"), clamped[3].alias("y2"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_tax = 0 THEN 128 ELSE CAST(trunc(128 + 127 * least(l_discount * 11, 1)) AS INT) END AS red, CASE WHEN l_tax = 0 THEN 128 ELSE CAST(trunc(128 * (1 - least(l_discount * 11, 1))) AS INT) END AS green FROM lineitem")
def contact_colours(spark, sf_dir):
    colour = geo.contact_colour(F.when(F.col("l_tax") != 0, F.col("l_discount") * 11))
    return lineitem(spark, sf_dir, "l_tax", "l_discount").select("l_orderkey", "l_linenumber", colour[0].alias("red"), colour[1].alias("green"))


@query(f"WITH {E}, c AS (SELECT vec_id, (e[1] - 0.1) + (e[3] - 0.3) * 0.5 AS a, 2 * (e[2] - 0.2) AS b FROM e) SELECT vec_id, round(a, 6) AS a, round(b, 6) AS b, round(0.1 + a, 6) AS x, round(0.2 + 2 * b, 6) AS y, round(0.3 + a * 0.5, 6) AS z FROM c")
def pca_coordinates(spark, sf_dir):
    basis, mean = [[1.0, 0.0, 0.5], [0.0, 2.0, 0.0]], [0.1, 0.2, 0.3]
    rows = numbers(spark, sf_dir).withColumn("c", geo.pca_project(part(1, 3), basis, mean))
    back = geo.pca_restore(F.col("c"), basis, mean)
    return rows.select("vec_id", *rounded(a=F.get("c", 0), b=F.get("c", 1), x=back[0], y=back[1], z=back[2]))


@query(f"WITH {E}, s AS (SELECT vec_id, [e[1:3], e[4:6], e[7:9]] AS p, vec_id % 4 = 0 AS gone FROM e) SELECT vec_id, CASE WHEN gone THEN 1 ELSE 3 END AS strips, CASE WHEN NOT gone THEN round(p[1][1], 6) END AS x FROM s")
def skeleton_strips(spark, sf_dir):
    nan = F.array(F.lit(float("nan")), F.lit(0.0), F.lit(0.0))
    gone = F.col("vec_id") % 4 == 0
    points = F.array(F.when(gone, nan).otherwise(part(1, 3)), part(4, 3), part(7, 3))
    rows = numbers(spark, sf_dir).select("vec_id", gone.alias("gone"), geo.strips(points, [(0, 1), (1, 2), (2, 0)]).alias("s"))
    return rows.select("vec_id", F.size("s").alias("strips"), F.when(~F.col("gone"), F.round(F.get(F.get(F.get("s", 0), 0), 0), 6)).alias("x"))


# ---------------------------------------------------------------- text, time, cost
@query("SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 1 WHEN 1 THEN 60 WHEN 2 THEN 3600 WHEN 3 THEN 86400 ELSE -1 END * CASE WHEN c_custkey % 5 = 4 THEN 1 ELSE c_custkey % 100 END AS seconds FROM customer")
def expiry_seconds(spark, sf_dir):
    unit_ = F.element_at(F.array(*map(F.lit, ("s", "m", "h", "d", " weeks"))), (F.col("c_custkey") % 5 + 1).cast("int"))
    seconds = strings.expires_seconds(F.concat((F.col("c_custkey") % 100).cast("string"), unit_))
    return table(spark, sf_dir, "customer").select("c_custkey", F.coalesce(seconds, F.lit(-1)).alias("seconds"))


@query("SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(p_name || ' é/#' || p_type || '.csv', '[^\\x20-\\x7e]', '', 'g'), '[^A-Za-z0-9._-]', '_', 'g'), '_{2,}', '_', 'g') AS name, array_to_string(list_filter(string_split('a//../' || p_type || '/./b/', '/'), lambda x: x NOT IN ('', '.', '..')), '/') AS prefix FROM part")
def safe_names(spark, sf_dir):
    name = strings.safe_filename(F.concat("p_name", F.lit(" é/#"), "p_type", F.lit(".csv")))
    prefix = strings.safe_prefix(F.concat(F.lit("a//../"), "p_type", F.lit("/./b/")))
    return table(spark, sf_dir, "part").select("p_partkey", name.alias("name"), prefix.alias("prefix"))


@query("SELECT event_id, CASE WHEN user_id % 3 = 0 THEN -1 ELSE epoch_ms(date_trunc('second', CAST(ts AS TIMESTAMP))) END AS ms, CAST(floor((epoch(TIMESTAMP '2030-01-01') - epoch(date_trunc('second', CAST(ts AS TIMESTAMP)))) / 86400) AS BIGINT) AS age FROM events")
def times_and_ages(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    text = F.when(F.col("user_id") % 3 == 0, "no time").otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
    return ev.select("event_id", F.coalesce(strings.epoch_ms(text), F.lit(-1)).alias("ms"), strings.age_days(F.lit("2030-01-01").cast("timestamp"), F.col("ts")).cast("long").alias("age"))


@query("SELECT p_partkey, '{\"a\":\"' || p_size || '\",\"b\":\"' || p_brand || '\"}' AS json, 'canonical/ep' || p_partkey || '/v' || p_size AS prefix FROM part")
def json_and_prefix(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    pairs = F.create_map(F.lit("b"), F.col("p_brand"), F.lit("a"), F.col("p_size").cast("string"))
    return p.select("p_partkey", strings.sorted_json(pairs).alias("json"), strings.canonical_prefix(F.concat(F.lit("ep"), F.col("p_partkey").cast("string")), F.col("p_size")).alias("prefix"))


@query("SELECT l_orderkey, l_linenumber, round(l_quantity * 1000 / 1e6 * 3 + l_partkey / 1e6 * 15, 6) AS usd, round(l_quantity * (4 * 0.002 + 0.01) + l_linenumber * 0.01, 4) AS annotation FROM lineitem")
def model_costs(spark, sf_dir):
    usd = strings.cost_usd(F.col("l_quantity") * 1000, F.col("l_partkey"), 3.0, 15.0)
    per = strings.annotation_cost(F.col("l_quantity"), 4, F.col("l_linenumber"), 0.002, 0.01)
    return lineitem(spark, sf_dir, "l_quantity", "l_partkey").select("l_orderkey", "l_linenumber", usd.alias("usd"), per.alias("annotation"))


@query("SELECT p_partkey, array_to_string(list_sort(list_distinct(list_filter(string_split_regex(lower('Put this ' || p_name || ' into ' || p_type), '[^a-z0-9]+'), lambda w: len(w) > 3 AND w NOT IN ('with', 'from', 'into', 'onto', 'then', 'that', 'this')))), ' ') AS words FROM part")
def prompt_words(spark, sf_dir):
    words = strings.prompts(F.concat(F.lit("Put this "), "p_name", F.lit(" into "), "p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(F.array_sort(words), " ").alias("words"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'https://drive.google.com/uc?export=download&id=Ab-' || c_custkey ELSE 'https://host.example/f/' || c_custkey END AS url FROM customer")
def share_links(spark, sf_dir):
    key = F.col("c_custkey").cast("string")
    url = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("https://drive.google.com/file/d/Ab-"), key, F.lit("/view"))).otherwise(F.concat(F.lit("https://host.example/f/"), key))
    return table(spark, sf_dir, "customer").select("c_custkey", strings.drive_download(url).alias("url"))


# ---------------------------------------------------------------- confidence, clocks, statistics
@query("SELECT l_orderkey, l_linenumber, round(least(abs(l_quantity - 25) / 25, 1), 6) AS margin, round(least(abs(l_discount - l_tax) / CASE WHEN l_tax <= 1e-9 THEN 1 ELSE l_tax END, 1), 6) AS own, CASE WHEN l_returnflag = 'R' THEN 0.5 ELSE CASE WHEN l_linestatus = 'O' THEN 0.5 ELSE l_discount END END AS landmark, round(least(abs(l_linenumber - 3) / 2, 1) * least(l_tax / 0.3, 1) * 0.5, 6) AS vote FROM lineitem")
def decision_margins(spark, sf_dir):
    li = lineitem(spark, sf_dir, "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    mark = conf.landmark(F.col("l_returnflag") != "R", F.when(F.col("l_linestatus") != "O", F.col("l_discount")))
    vote = conf.finger_vote(F.col("l_linenumber"), F.col("l_tax"), F.lit(0.5))
    return li.select("l_orderkey", "l_linenumber", mark.alias("landmark"), *rounded(margin=conf.margin(F.col("l_quantity"), 25.0), own=conf.margin(F.col("l_discount"), F.col("l_tax")), vote=vote))


S = DEFAULT


@query(f"WITH {EV}, w AS (SELECT user_id, i, count(value) OVER w AS n, max(abs(value)) OVER w AS peak, stddev_pop(value) OVER w AS sd FROM ev WINDOW w AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING)) SELECT user_id, i, round(CASE WHEN n < 2 OR peak <= 1e-9 THEN {S.snr_floor} ELSE least(greatest(peak / (sd + 1e-9) / {S.snr_reference}, {S.snr_floor}), 1) END, 5) AS snr FROM w")
def signal_to_noise(spark, sf_dir):
    return events(spark, sf_dir, "value").select("user_id", "i", F.round(conf.signal_to_noise(F.col("value"), win.rows(U, ["i"], -2, 2)), 5).alias("snr"))


@query("WITH p AS (SELECT quantile_cont(l_extendedprice, 0.01) AS lo, quantile_cont(l_extendedprice, 0.99) AS hi FROM lineitem) SELECT l_orderkey, l_linenumber, round(least(greatest(l_extendedprice, lo), hi), 4) AS x FROM lineitem, p")
def denormalised(spark, sf_dir):
    li = lineitem(spark, sf_dir, "l_extendedprice")
    p = li.agg(F.percentile("l_extendedprice", F.array(F.lit(0.01), F.lit(0.99))).alias("p"))
    low, high = F.col("p")[0], F.col("p")[1]
    back = stats.denormalised(stats.normalised(F.col("l_extendedprice"), low, high), low, high)
    return stats.beside(li, p).select("l_orderkey", "l_linenumber", F.round(back, 4).alias("x"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN 'unknown' WHEN abs(l_quantity - 25) <= 0.05 * 25 THEN 'true' ELSE 'false' END AS aligned, CASE WHEN l_linestatus <> 'O' AND abs(l_quantity - 25) <= 0.05 * 25 THEN 'stage2_anchor' ELSE 'stage1_volume' END AS tier, abs(l_quantity - 30) <= 0.05 * 30 AS fps_fits FROM lineitem")
def camera_tiers(spark, sf_dir):
    li = lineitem(spark, sf_dir, "l_quantity", "l_linestatus")
    tier = alignment.tier(F.when(F.col("l_linestatus") != "O", F.col("l_quantity")), F.lit(25.0))
    return li.select("l_orderkey", "l_linenumber", F.coalesce(tier["aligned"].cast("string"), F.lit("unknown")).alias("aligned"), tier["tier"].alias("tier"), alignment.fps_claim(F.col("l_quantity"), F.lit(30.0)).alias("fps_fits"))


@query(f"SELECT l_orderkey, l_linenumber, CASE WHEN t >= {S.epoch_floor_ms} THEN 'epoch' WHEN t BETWEEN 0 AND {S.uptime_ceiling_ms} THEN 'uptime' ELSE 'ambiguous' END AS domain, round(greatest(least(l_quantity, 30) - greatest(l_quantity - 10, 25), 0), 6) AS common FROM (SELECT *, pow(10, l_linenumber * 2) * l_quantity AS t FROM lineitem)")
def clock_domains(spark, sf_dir):
    li = lineitem(spark, sf_dir, "l_quantity")
    t = F.pow(F.lit(10.0), F.col("l_linenumber") * 2) * F.col("l_quantity")
    common = sync.overlap(F.col("l_quantity") - 10, F.col("l_quantity"), F.lit(25.0), F.lit(30.0))
    return li.select("l_orderkey", "l_linenumber", sync.clock_domain(t).alias("domain"), F.round(common, 6).alias("common"))


@query("WITH a AS (SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 1700000000000 + c_custkey WHEN 2 THEN 1700000100000 ELSE 1700000000000 END AS created, CASE WHEN c_custkey % 4 = 3 THEN 5000 ELSE 1700000000000 END AS t0 FROM customer), k AS (SELECT *, CASE WHEN created IS NULL THEN NULL WHEN t0 = 5000 THEN 'clock domains differ' WHEN created >= t0 + 60000 THEN 'no common range' END AS anchor_error FROM a) SELECT c_custkey, coalesce(created, t0) AS recording_start_ms, CASE WHEN created IS NULL THEN 'stream_start' ELSE 'creation_time' END AS anchor_source, created IS NOT NULL AND anchor_error IS NULL AS anchor_validated, anchor_error FROM k")
def video_anchors(spark, sf_dir):
    k, base = F.col("c_custkey") % 4, F.lit(1_700_000_000_000)
    c = table(spark, sf_dir, "customer").select("c_custkey").withColumn("created", F.when(k == 1, base + F.col("c_custkey")).when(k == 2, base + 100_000).when(k == 3, base))
    c = c.withColumn("t0", F.when(k == 3, F.lit(5000).cast("long")).otherwise(base)).withColumn("t1", F.col("t0") + 60_000).withColumn("duration", F.lit(10.0)).withColumn("now", base * 2)
    return sync.anchor(c, "created", "t0", "t1", "duration", "now").select("c_custkey", "recording_start_ms", "anchor_source", "anchor_validated", "anchor_error")


@query(f"WITH {EV}, d AS (SELECT user_id, (t - lag(t) OVER (PARTITION BY user_id ORDER BY t)) * 1000 AS dt FROM ev), m AS (SELECT user_id, median(dt) AS md, max(dt) AS mx FROM d WHERE dt IS NOT NULL GROUP BY user_id) SELECT user_id, round(any_value(md), 3) AS median_dt_ms, round(any_value(mx), 3) AS max_gap_ms, count(*) AS intervals FROM d JOIN m USING (user_id) WHERE dt IS NOT NULL GROUP BY user_id")
def stream_statistics(spark, sf_dir):
    out = sync.stream_stats(events(spark, sf_dir), U, "t")
    return out.select("user_id", F.round("median_dt_ms", 3).alias("median_dt_ms"), F.round("max_gap_ms", 3).alias("max_gap_ms"), "intervals")


@query("SELECT l_suppkey, round(sum(l_extendedprice), 2) AS total, round(avg(l_extendedprice), 4) AS mean, round(sum(l_extendedprice) / (sum(l_quantity) / 3600), 2) AS per_hour FROM lineitem GROUP BY l_suppkey")
def cost_rollups(spark, sf_dir):
    out = stats.cost_rollup(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_extendedprice", "l_quantity")
    return out.select("l_suppkey", F.round("total", 2).alias("total"), F.round("mean", 4).alias("mean"), F.round("per_hour", 2).alias("per_hour"))


# ---------------------------------------------------------------- trajectories
@query("WITH p AS (SELECT l_suppkey, quantile_cont(l_discount, 0.05) AS a, quantile_cont(l_discount, 0.95) AS b FROM lineitem GROUP BY l_suppkey), s AS (SELECT l_suppkey, CASE WHEN b - a > 1e-6 THEN a ELSE 0.03 END AS closed, CASE WHEN b - a > 1e-6 THEN b ELSE 0.3 END AS open_ FROM p) SELECT l_orderkey, l_linenumber, round(least(greatest((open_ - l_discount) / (open_ - closed), 0), 1), 6) AS grasp FROM lineitem JOIN s USING (l_suppkey)")
def grasp_scales(spark, sf_dir):
    li = lineitem(spark, sf_dir, "l_suppkey", "l_discount")
    scaled = li.join(canonical.grasp_scale(li, ["l_suppkey"], "l_discount"), "l_suppkey")
    return scaled.select("l_orderkey", "l_linenumber", F.round(canonical.grasp(F.col("l_discount"), F.col("closed"), F.col("open")), 6).alias("grasp"))


@query(f"WITH {EV}, d AS (SELECT user_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY i) AS d FROM ev) SELECT user_id, round(stddev_pop(d) * 1000, 3) AS jitter_mm FROM d GROUP BY user_id")
def wrist_jitters(spark, sf_dir):
    return canonical.wrist_jitter(events(spark, sf_dir, "value"), U, "i", "value").select("user_id", F.round("jitter_mm", 3).alias("jitter_mm"))


@query(f"WITH RECURSIVE {EV}, f AS (SELECT user_id, i, value AS x FROM ev WHERE i = 0 UNION ALL SELECT ev.user_id, ev.i, greatest(f.x - 5, least(f.x + 5, ev.value)) FROM f JOIN ev ON ev.user_id = f.user_id AND ev.i = f.i + 1) SELECT user_id, i, round(x, 6) AS clipped FROM f")
def clipped_velocity(spark, sf_dir):
    return retarget.clip_velocity(events(spark, sf_dir, "value"), U, "i", "value", 5.0).select("user_id", "i", F.round("clipped", 6).alias("clipped"))


@query("WITH c AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_linenumber % 3, l_quantity DESC, l_discount, l_tax DESC, l_extendedprice DESC, l_suppkey, l_orderkey * 10 + l_linenumber) AS p FROM lineitem) SELECT l_partkey, l_orderkey, l_linenumber FROM c WHERE p = 1")
def best_candidates(spark, sf_dir):
    li = lineitem(spark, sf_dir, "l_partkey", "l_quantity", "l_discount", "l_tax", "l_extendedprice", "l_suppkey")
    named = li.select("l_partkey", "l_orderkey", "l_linenumber", (F.col("l_linenumber") % 3).alias("collisions"), F.col("l_quantity").alias("convergence"), F.col("l_discount").alias("smoothness"), F.col("l_tax").alias("manipulability"), F.col("l_extendedprice").alias("margin"), F.col("l_suppkey").alias("residual"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("candidate"))
    return retarget.best_candidate(named, ["l_partkey"]).select("l_partkey", "l_orderkey", "l_linenumber")


@query("SELECT l_suppkey, round(sqrt(var_pop(l_quantity) + var_pop(l_discount)), 6) AS spread FROM lineitem GROUP BY l_suppkey")
def candidate_spreads(spark, sf_dir):
    return retarget.candidate_spread(table(spark, sf_dir, "lineitem"), ["l_suppkey"], ["l_quantity", "l_discount"]).select("l_suppkey", F.round("spread", 6).alias("spread"))


@query(
    """WITH a AS (SELECT DISTINCT l_suppkey, l_partkey AS f FROM lineitem WHERE l_returnflag = 'A'), b AS (SELECT DISTINCT l_suppkey, l_partkey AS f FROM lineitem WHERE l_quantity > 20),
x AS (SELECT coalesce(a.l_suppkey, b.l_suppkey) AS l_suppkey, count(a.f) AS na, count(b.f) AS nb, count(*) FILTER (a.f IS NOT NULL AND b.f IS NOT NULL) AS n FROM a FULL JOIN b ON a.l_suppkey = b.l_suppkey AND a.f = b.f GROUP BY 1)
SELECT l_suppkey, round(n / greatest(na, nb, 1), 6) AS overlap FROM x"""
)
def frame_overlaps(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_returnflag", "l_quantity")
    out = retarget.overlap_ratio(li.filter("l_returnflag = 'A'"), li.filter("l_quantity > 20"), ["l_suppkey"], "l_partkey")
    return out.select("l_suppkey", F.round("overlap", 6).alias("overlap"))


@query("WITH m AS (SELECT l_suppkey, (min(l_discount) + max(l_discount)) / 2 AS mid, count(DISTINCT l_quantity > 20) AS k FROM lineitem GROUP BY 1) SELECT l_suppkey, round(CASE WHEN any_value(k) < 2 THEN 1 ELSE avg(CAST((l_discount < mid) = (l_quantity > 20) AS INT)) END, 6) AS agreement FROM lineitem JOIN m USING (l_suppkey) GROUP BY l_suppkey")
def grasp_agreements(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_discount", (F.col("l_quantity") > 20).alias("grasped"))
    return retarget.grasp_agreement(li, ["l_suppkey"], "l_discount", "grasped").select("l_suppkey", F.round("agreement", 6).alias("agreement"))


@query("SELECT l_suppkey, count(*) FILTER (l_quantity < 5 OR l_quantity > 45 OR l_discount < 0 OR l_discount > 0.09) AS limit_frames, count(*) FILTER (l_tax > 0.07) AS collision_frames FROM lineitem GROUP BY l_suppkey")
def joint_violations(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_suppkey", F.array("l_quantity", "l_discount").alias("q"), geo.vector(5, 0).alias("low"), geo.vector(45, 0.09).alias("high"), (F.col("l_tax") > 0.07).alias("collides"))
    return retarget.violations(li, ["l_suppkey"], "q", "low", "high", "collides")


@query("WITH s AS (SELECT l_suppkey, count(*) FILTER (l_tax > 0.07) AS hits, count(*) AS n, max(l_linenumber) AS m FROM lineitem GROUP BY 1) SELECT l_suppkey, CASE WHEN l_suppkey % 7 = 0 THEN 'unknown' WHEN (hits % 4 = 0) AND (hits <= 2) AND NOT (hits / n < 0.1) THEN 'true' ELSE 'false' END AS eligible FROM s")
def retarget_eligible(spark, sf_dir):
    s = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_tax") > 0.07).alias("hits"), F.count("*").alias("n"))
    known = F.col("l_suppkey") % 7 != 0
    m = s.select("l_suppkey", F.when(known, F.col("hits") % 4).alias("limit_frames"), F.when(F.col("hits") > 2, 1).otherwise(0).alias("collision_frames"), F.lit(0).alias("teleports"), F.when(known, F.col("hits") / F.col("n")).alias("ik_convergence"))
    return retarget.eligible(m, 0.1).select("l_suppkey", F.coalesce(F.col("eligible").cast("string"), F.lit("unknown")).alias("eligible"))


@query("WITH s AS (SELECT l_suppkey, min(l_discount) * 10 AS a, count(*) % 3 AS t FROM lineitem GROUP BY 1) SELECT l_suppkey, array_to_string(list_filter([CASE WHEN a < 0.5 THEN 'few common frames' END, CASE WHEN t > 0 THEN 'the arm jumps' END, CASE WHEN a < 0.1 THEN 'grasps disagree' END], lambda x: x IS NOT NULL), '; ') AS reasons, NOT (a < 0.5 OR t > 0) AS ok FROM s")
def reconciled(spark, sf_dir):
    s = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg((F.min("l_discount") * 10).alias("overlap"), (F.count("*") % 3).alias("arm_teleports"))
    m = s.withColumn("finger_teleports", F.lit(0)).withColumn("agreement", F.col("overlap"))
    return retarget.reconcile(m, 0.5, 0.1).select("l_suppkey", F.array_join("reasons", "; ").alias("reasons"), "ok")


# ---------------------------------------------------------------- runs and sets
@query(f"WITH {EV}, {LEVEL}, k AS (SELECT user_id, level, lag(level) OVER w AS a, lead(level) OVER w AS b FROM lv WINDOW w AS (PARTITION BY user_id ORDER BY i)) SELECT user_id, CAST(count(*) FILTER (level <> a AND level <> b) AS BIGINT) AS flickers FROM k GROUP BY user_id")
def flickers(spark, sf_dir):
    ev = events(spark, sf_dir, "value").withColumn("level", F.when(F.col("value") < 20, "low").when(F.col("value") < 60, "mid").otherwise("high"))
    return win.flicker_count(ev, U, ["i"], "level")


@query(
    f"""WITH {EV}, {LEVEL}, {RUNS.format(x="level", src="lv")}, s AS (SELECT user_id, x AS phase, lo AS start_frame, hi AS end_frame FROM runs WHERE x <> 'low'),
c AS (SELECT *, CASE WHEN coalesce(lag(phase) OVER w <> phase OR start_frame - lag(end_frame) OVER w > 3, true) THEN 1 ELSE 0 END AS new FROM s WINDOW w AS (PARTITION BY user_id ORDER BY start_frame)),
p AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY start_frame) AS part FROM c) SELECT user_id, any_value(phase) AS phase, min(start_frame) AS start_frame, max(end_frame) AS end_frame FROM p GROUP BY user_id, part"""
)
def merged_segments(spark, sf_dir):
    ev = events(spark, sf_dir, "value").withColumn("level", F.when(F.col("value") < 20, "low").when(F.col("value") < 60, "mid").otherwise("high"))
    segs = win.segments(ev, U, "i", "level", "t").filter("phase <> 'low'").select("user_id", "phase", "start_frame", "end_frame")
    return win.gap_merge(segs, U, "phase", "start_frame", "end_frame", 3).select("user_id", "phase", "start_frame", "end_frame")


@query("SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'A' INTERSECT SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 30")
def common_suppliers(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return li.filter("l_returnflag = 'A'").select("l_suppkey").intersect(li.filter("l_returnflag = 'R' and l_quantity > 30").select("l_suppkey"))


@query("SELECT o_custkey, array_to_string(list_sort(list_filter(list_distinct(list(o_orderpriority)), lambda x: x NOT IN ('1-URGENT', '5-LOW'))), ',') AS others, CAST(count(DISTINCT o_orderpriority) AS INT) AS kinds FROM orders GROUP BY o_custkey")
def other_priorities(spark, sf_dir):
    seen = F.collect_set("o_orderpriority")
    out = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(seen.alias("s"))
    return out.select("o_custkey", F.array_join(F.array_sort(F.array_except("s", F.array(F.lit("1-URGENT"), F.lit("5-LOW")))), ",").alias("others"), F.size("s").alias("kinds"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_discount * 10 < 0.3 THEN 'ignore' WHEN l_discount * 10 < 0.7 THEN 'blur_and_flag' ELSE 'blur' END AS tier FROM lineitem")
def privacy_tiers(spark, sf_dir):
    return lineitem(spark, sf_dir, "l_discount").select("l_orderkey", "l_linenumber", privacy.tier(F.col("l_discount") * 10).alias("tier"))


# ---------------------------------------------------------------- certificates, gates, joins
@query("SELECT l_orderkey, l_linenumber, round(CASE WHEN l_linestatus = 'O' THEN -1 ELSE greatest(1 - l_quantity / (1000 / CASE WHEN l_returnflag = 'N' THEN 30.0 ELSE l_linenumber * 10.0 END), 0) END, 6) AS integrity FROM lineitem")
def sync_integrities(spark, sf_dir):
    drift, fps = F.when(F.col("l_linestatus") != "O", F.col("l_quantity")), F.when(F.col("l_returnflag") != "N", F.col("l_linenumber") * 10.0)
    found = certify.sync_integrity(drift, fps)
    return lineitem(spark, sf_dir, "l_quantity", "l_linestatus", "l_returnflag").select("l_orderkey", "l_linenumber", F.round(F.coalesce(found, F.lit(-1.0)), 6).alias("integrity"))


@query("SELECT l_suppkey, round(0.3 * (0.5 + 0.5 * avg(CASE WHEN l_returnflag = 'A' THEN 0 ELSE 1 END)), 6) AS calibration, round(avg((l_discount + l_tax) / 2), 6) AS perception, round(coalesce(avg(CASE WHEN l_linenumber % 2 = 0 THEN CAST((l_tax > 0.05) = (l_quantity > 25) AS INT) END), -1), 6) AS contact FROM lineitem GROUP BY l_suppkey")
def certificate_components(spark, sf_dir):
    li = lineitem(spark, sf_dir, "l_suppkey", "l_returnflag", "l_discount", "l_tax", "l_quantity")
    li = li.withColumn("pose", F.when(F.col("l_returnflag") != "A", F.lit(1))).withColumn("map", F.create_map(F.lit("a"), "l_discount", F.lit("b"), "l_tax"))
    li = li.withColumn("contact", F.create_map(F.lit("hand"), F.create_map(F.lit("tip"), F.col("l_tax") * 10))).withColumn("grasped", F.col("l_quantity") > 25)
    li = li.withColumn("rig", F.when(F.col("l_linenumber") % 2 == 0, "glove").otherwise("bare"))
    rigs = spark.createDataFrame([("glove", "contact"), ("bare", "pose")], "rig string, channel string")
    a = certify.calibration_completeness(li, ["l_suppkey"], "pose")
    b = certify.perception_confidence(li, ["l_suppkey"], "map")
    c = certify.contact_consistency(li, ["l_suppkey"], "contact", "grasped", "rig", rigs)
    out = a.join(b, "l_suppkey").join(c, "l_suppkey")
    return out.select("l_suppkey", *rounded(calibration=F.col("calibration_completeness"), perception=F.col("perception_confidence"), contact=F.coalesce("contact_consistency", F.lit(-1.0))))


@query("SELECT p_partkey FROM part WHERE p_size % 3 <> 1")
def tier_one(spark, sf_dir):
    rows = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 3 == 1, "stage2_anchor").when(F.col("p_size") % 3 == 2, "stage1_volume").alias("tier"))
    return package.tier_filter(rows, "stage1").select("p_partkey")


@query("SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN 'consent is denied' WHEN l.quality = 0 THEN 'pii is failed' ELSE 'no consent record' END AS reason FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.doc_id IS NULL OR l.toxic = 1 OR l.quality = 0")
def delivery_refusals(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    consent_, pii = F.when(F.col("toxic") == 0, "granted").when(F.col("toxic") == 1, "denied"), F.when(F.col("quality") == 1, "passed").when(F.col("quality") == 0, "failed")
    rows = docs.select("doc_id", consent_.alias("consent"), pii.alias("pii_status"), F.lit(5).alias("quality"))
    return package.refusals(rows).select("doc_id", "reason")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'granted' WHEN c_custkey % 3 = 0 THEN 'denied' ELSE 'pending' END AS status, CASE WHEN c_custkey % 2 = 0 THEN 'granted' ELSE 'none' END AS recorded FROM customer")
def consent_statuses(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey")
    files = c.filter("c_custkey % 2 = 0").withColumn("status", F.lit("granted"))
    meta = c.filter("c_custkey % 3 = 0").withColumn("consent_status", F.lit("denied"))
    known = consent.current(c, files.select(F.col("c_custkey").alias("capture_id"), "status"), "c_custkey")
    return consent.status_of(files, meta, known, "c_custkey").select("c_custkey", F.col("consent_status").alias("status"), F.coalesce("consent", F.lit("none")).alias("recorded"))


@query(f"WITH {EV}, g AS (SELECT user_id, abs(value - 30) * 180 / pi() / 20 AS d FROM ev), s AS (SELECT user_id, max(d) AS peak, avg(CAST(d > {S.snap_deg_s} AS INT)) AS fast FROM g GROUP BY user_id) SELECT user_id, round(peak, 4) AS peak_deg_s, round(fast, 6) AS fast_fraction, NOT (user_id % 2 = 0 AND fast > {S.snap_fraction}) AND NOT (user_id % 2 = 1 AND peak < {S.still_peak_deg_s} AND fast < {S.still_spike_fraction}) AS plausible FROM s")
def mount_checks(spark, sf_dir):
    ev = events(spark, sf_dir, "value").withColumn("mode", F.when(F.col("user_id") % 2 == 0, "head_mounted").otherwise("wrist_mounted")).withColumn("gx", (F.col("value") - 30) / 20)
    return qa.mount_plausibility(ev, U, "mode", ["gx"]).select("user_id", F.round("peak_deg_s", 4).alias("peak_deg_s"), F.round("fast_fraction", 6).alias("fast_fraction"), "plausible")


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' AND l_tax > 0.04 THEN 'GRASPED_L' WHEN l_returnflag = 'R' THEN 'GRASPED_R' WHEN l_discount > 0.01 THEN 'MOVING' ELSE 'STATIC' END AS state, round(CASE WHEN l_returnflag = 'R' THEN least(l_quantity / 40, 1) WHEN l_discount > 0.01 THEN l_tax ELSE 0.25 END, 6) AS confidence FROM lineitem")
def interaction_state(spark, sf_dir):
    side = F.when(F.col("l_tax") > 0.04, "left").otherwise("right")
    state = canonical.interaction(F.col("l_returnflag") == "R", side, F.col("l_quantity") / 40, F.col("l_discount"), F.col("l_tax"), F.lit(0.25))
    return lineitem(spark, sf_dir, "l_returnflag", "l_tax", "l_quantity", "l_discount").select("l_orderkey", "l_linenumber", state["state"].alias("state"), F.round(state["confidence"], 6).alias("confidence"))


@query(f"WITH {E} SELECT vec_id, list_sum(list_transform(range(1, 63), lambda i: CASE WHEN e[i] > list_sum(e[1:62]) / 62 THEN CAST(pow(2, 62 - i) AS HUGEINT) ELSE 0 END)) % 1000003 AS bits FROM e")
def mean_hashes(spark, sf_dir):
    return numbers(spark, sf_dir).select("vec_id", (strings.mean_hash(part(1, 62)) % 1000003).cast("double").alias("bits"))


@query(
    f"""WITH {EV}, k AS (SELECT user_id, i, CASE WHEN event_type <> 'error' THEN value END AS v FROM ev),
f AS (SELECT user_id, i, v, max(CASE WHEN v IS NOT NULL THEN i END) OVER b AS bi, last_value(v IGNORE NULLS) OVER b AS bv, min(CASE WHEN v IS NOT NULL THEN i END) OVER a AS ai, first_value(v IGNORE NULLS) OVER a AS av, count(v) OVER (PARTITION BY user_id) AS n FROM k
WINDOW b AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY user_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
g AS (SELECT user_id, i, v, n, CASE WHEN bi IS NULL THEN av WHEN ai IS NULL THEN bv WHEN ai = bi THEN av ELSE bv + (av - bv) * (i - bi) / (ai - bi) END AS w FROM f)
SELECT user_id, i, round(CASE WHEN v IS NULL THEN -1 WHEN n < 7 THEN v ELSE avg(w) OVER (PARTITION BY user_id ORDER BY i ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) END, 5) AS z FROM g"""
)
def smoothed_depths(spark, sf_dir):
    ev = events(spark, sf_dir, "value", "event_type").withColumn("v", F.when(F.col("event_type") != "error", F.col("value")))
    return canonical.smooth_depth(ev, U, "i", "v").select("user_id", "i", F.round(F.coalesce("z_smooth", F.lit(-1.0)), 5).alias("z"))


NEXT = ["nx", "ny", "nz"]
ACTION = rotate_sql("a", [f"coalesce({n_}, 0) - e[{k}]" for n_, k in zip(NEXT, (8, 9, 10), strict=True)], back=True)


@query(
    f"""WITH {E}, l AS (SELECT vec_id, label, e FROM embeddings JOIN e USING (vec_id)),
q AS (SELECT vec_id, e, {q_sql("a", 4)}, {", ".join(f"lead(e[{15 + k}]) OVER w AS {c}" for k, c in enumerate(NEXT))} FROM l WINDOW w AS (PARTITION BY label ORDER BY vec_id))
SELECT vec_id, nx IS NOT NULL AS action_valid, {", ".join(f"CASE WHEN nx IS NULL THEN -9 ELSE round({x}, 6) END AS {c}" for x, c in zip(ACTION, "xyz", strict=True))} FROM q"""
)
def next_actions(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))
    rows = rows.withColumn("wrist", geo.pose(part(15, 3), unit(18))).withColumn("camera", geo.pose(part(8, 3), unit(4)))
    # without cameras an action is the next pose as it is; here each is then seen from its own frame's camera
    rows = rows.withColumn("unknown", F.lit(None).cast(rows.schema["camera"].dataType))
    seen = canonical.actions(rows, ["label"], "vec_id", "wrist", "unknown")
    local = geo.relative(F.col("camera"), F.col("action"))["position_m"]
    seen = seen.select("vec_id", "action_valid", local.alias("p"))
    return seen.select("vec_id", "action_valid", *rounded(**{c: F.coalesce(F.get("p", i), F.lit(-9.0)) for i, c in enumerate("xyz")}))


@query(
    f"""WITH {EV}, s AS (SELECT user_id, min(i) AS lo, max(i) + 3 AS n FROM ev GROUP BY user_id), m AS (SELECT user_id, i // 2 * 2 AS f, avg(value) AS v, count(*) AS k FROM ev GROUP BY ALL),
g AS (SELECT s.user_id, unnest(range(n)) AS f FROM s), j AS (SELECT g.user_id, g.f, v, k FROM g LEFT JOIN m USING (user_id, f)),
w AS (SELECT user_id, f, v, k, max(CASE WHEN v IS NOT NULL THEN f END) OVER b AS bi, last_value(v IGNORE NULLS) OVER b AS bv, min(CASE WHEN v IS NOT NULL THEN f END) OVER a AS ai, first_value(v IGNORE NULLS) OVER a AS av FROM j
WINDOW b AS (PARTITION BY user_id ORDER BY f ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY user_id ORDER BY f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT user_id, f AS frame_idx, coalesce(k, 0) AS samples, k IS NULL AS dropout, round(CASE WHEN bi IS NULL THEN av WHEN ai IS NULL THEN bv WHEN ai = bi THEN av ELSE bv + (av - bv) * (f - bi) / (ai - bi) END, 5) AS value FROM w"""
)
def frame_groups(spark, sf_dir):
    ev = events(spark, sf_dir, "value").withColumn("frame", F.floor(F.col("i") / 2) * 2)
    ev = ev.withColumn("frames", F.max("i").over(Window.partitionBy("user_id")) + 3)
    return sync.group_by_frame(ev, U, "frame", "frames", ["value"]).select("user_id", "frame_idx", "samples", "dropout", F.round("value", 5).alias("value"))


@query(f"WITH {EV}, m AS (SELECT user_id, i // 4 AS frame, median(t + 0.5 * (i % 3)) AS v FROM ev GROUP BY ALL), n AS (SELECT user_id, frame, v, t, row_number() OVER (PARTITION BY user_id, frame ORDER BY abs(t - v), t) AS p FROM ev JOIN m USING (user_id) WHERE i // 4 = frame) SELECT user_id, CAST(frame AS BIGINT) AS frame, round(v, 3) AS video_t, round(t, 3) AS sample_t FROM n WHERE p = 1")
def frame_clock_medians(spark, sf_dir):
    ev = events(spark, sf_dir).withColumn("frame", F.floor(F.col("i") / 4)).withColumn("v", F.col("t") + 0.5 * (F.col("i") % 3))
    out = sync.frame_clocks(ev, U, "frame", "v", "t")
    return out.select("user_id", "frame", F.round("video_t", 3).alias("video_t"), F.round("sample_t", 3).alias("sample_t"))


@query(f"WITH {EV}, d AS (SELECT user_id, i, value + 1 AS d FROM ev), c AS (SELECT *, lag(d) OVER (PARTITION BY user_id ORDER BY i) AS b FROM d) SELECT user_id, round(median(abs(d - b) / b), 5) AS median_change, round(quantile_cont(abs(d - b) / b, 0.9), 5) AS p90_change, round((max(d) - min(d)) / median(d), 5) AS swing FROM c GROUP BY user_id")
def depth_changes(spark, sf_dir):
    ev = events(spark, sf_dir, "value").withColumn("point", F.lit(0)).withColumn("d", F.col("value") + 1)
    out = canonical.depth_consistency(ev, U, "point", "i", "d")
    return out.select("user_id", *(F.round(c, 5).alias(c) for c in ("median_change", "p90_change", "swing")))


@query("SELECT arg_min(l_returnflag, (s, l_returnflag)) AS winner FROM (SELECT l_returnflag, stddev_pop(l_quantity) AS s FROM lineitem GROUP BY 1)")
def steadiest_model(spark, sf_dir):
    scores = table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.stddev_pop("l_quantity").alias("wobble"))
    return canonical.compare_models(scores, "l_returnflag", "wobble")


# ---------------------------------------------------------------- folds whose queries stand in bindings.py
ORACLE_SQL["gap_fill"] = f"""WITH RECURSIVE {EV}, {LEVEL}, {RUNS.format(x="level", src="lv")}, o AS (SELECT user_id, x, n, row_number() OVER (PARTITION BY user_id ORDER BY run) AS k FROM runs),
f AS (SELECT user_id, CAST(0 AS BIGINT) AS k, CAST([] AS STRUCT(x VARCHAR, n BIGINT, o BOOLEAN)[]) AS s FROM (SELECT DISTINCT user_id FROM o) UNION ALL
SELECT f.user_id, o.k, CASE WHEN len(s) >= 2 AND s[-1].o AND s[-1].n < 3 AND s[-2].x = o.x THEN list_append(s[1:len(s) - 2], {{'x': o.x, 'n': s[-2].n + s[-1].n + o.n, 'o': false}}) ELSE list_append(s, {{'x': o.x, 'n': o.n, 'o': true}}) END FROM f JOIN o ON o.user_id = f.user_id AND o.k = f.k + 1),
l AS (SELECT user_id, arg_max(s, k) AS s FROM f GROUP BY user_id), u AS (SELECT user_id, unnest(s) AS e, generate_subscripts(s, 1) AS run FROM l) SELECT user_id, CAST(run AS INT) AS run, e.x AS level, e.n AS n FROM u"""


@query(
    f"""WITH RECURSIVE {SIGNS}, o AS (SELECT vec_id, h, row_number() OVER (ORDER BY vec_id) AS k FROM sg),
f AS (SELECT CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS vec_id, CAST([] AS STRUCT(h BIGINT, i BIGINT)[]) AS kept, CAST(NULL AS STRUCT(d INTEGER, i BIGINT)) AS hit UNION ALL
SELECT k, vec_id, CASE WHEN hit IS NULL THEN list_append(kept, {{'h': h, 'i': vec_id}}) ELSE kept END, hit FROM (
SELECT o.k, o.vec_id, o.h, kept, list_min(list_filter(list_transform(kept, lambda e: {{'d': CAST(bit_count(xor(e.h, o.h)) AS INTEGER), 'i': e.i}}), lambda e: 1 - e.d / 32 >= 0.8)) AS hit FROM f JOIN o ON o.k = f.k + 1))
SELECT e.label, f.vec_id, coalesce(f.hit.i, -1) AS duplicate_of, coalesce(1 - f.hit.d / 32, 0) AS similarity FROM f JOIN embeddings e USING (vec_id)"""
)
def greedy_duplicates(spark, sf_dir):
    """dedup_greedy with numbers in place of nulls: -1 and 0 for what is kept."""
    out = dedup_greedy(spark, sf_dir)
    return out.select("label", "vec_id", F.coalesce("duplicate_of", F.lit(-1)).alias("duplicate_of"), F.coalesce("similarity", F.lit(0.0)).alias("similarity"))
