"""Geometry as column expressions: vectors and quaternions are arrays, boxes are arrays of x1, y1, x2, y2."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

PI = 3.141592653589793


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once: expressions are trees, so a value used twice would be there twice, and nested uses would multiply."""
    return F.get(F.transform(F.array(value), body), 0)


def let2(a: Column, b: Column, body: Callable[[Column, Column], Column]) -> Column:
    return let(a, lambda x: let(b, lambda y: body(x, y)))


def vector(*xs) -> Column:
    return F.array(*(x if isinstance(x, Column) else F.lit(float(x)) for x in xs))


def at(v: Column, i: int) -> Column:
    return F.get(v, i)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return let(v, lambda x: F.sqrt(dot(x, x)))


def minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def scale(v: Column, s: Column) -> Column:
    return F.transform(v, lambda x: x * s)


def distance(a: Column, b: Column) -> Column:
    return norm(minus(a, b))


def cross(u: Column, v: Column) -> Column:
    return let2(u, v, lambda a, b: vector(at(a, 1) * at(b, 2) - at(a, 2) * at(b, 1), at(a, 2) * at(b, 0) - at(a, 0) * at(b, 2), at(a, 0) * at(b, 1) - at(a, 1) * at(b, 0)))


def midpoint(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: (x + y) / 2)


def clip(x: Column, low, high) -> Column:
    """Null stays null."""
    return F.when(x.isNull(), x).otherwise(F.least(F.greatest(x, F.lit(low)), F.lit(high)))


def wrap_angle(x: Column) -> Column:
    """Into [-pi, pi)."""
    return F.pmod(x + PI, F.lit(2 * PI)) - PI


def joint_angle(a: Column, b: Column, c: Column) -> Column:
    """Angle at b; pi if a leg has no length."""

    def angle(u: Column, v: Column) -> Column:
        return let(norm(u) * norm(v), lambda size: F.when(size == 0, F.lit(PI)).otherwise(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(dot(u, v), size))))))

    return let(b, lambda m: let2(minus(a, m), minus(c, m), angle))


# ---------------------------------------------------------------- rotations
def quaternion_to_matrix(q: Column) -> Column:
    """w, x, y, z to nine numbers, row by row."""

    def body(v: Column) -> Column:
        w, x, y, z = (at(v, i) for i in range(4))
        return vector(1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y), 2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x), 2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y))

    return let(q, body)


def matrix_to_quaternion(m: Column) -> Column:
    """By the largest of the four squared components, which keeps the root well away from 0."""

    def body(v: Column) -> Column:
        a, b, c, d, e, f, g, h, i = (at(v, k) for k in range(9))
        squares = F.array(1 + a + e + i, 1 + a - e - i, 1 - a + e - i, 1 - a - e + i)

        def by_largest(four: Column) -> Column:
            top = F.array_max(four)
            s = 2 * F.sqrt(top)
            return (
                F.when(at(four, 0) == top, vector(s / 4, (h - f) / s, (c - g) / s, (d - b) / s))
                .when(at(four, 1) == top, vector((h - f) / s, s / 4, (b + d) / s, (c + g) / s))
                .when(at(four, 2) == top, vector((c - g) / s, (b + d) / s, s / 4, (f + h) / s))
                .otherwise(vector((d - b) / s, (c + g) / s, (f + h) / s, s / 4))
            )

        return F.when(v.isNotNull(), let(squares, by_largest))

    return let(m, body)


def multiply(p: Column, q: Column) -> Column:
    def body(u: Column, v: Column) -> Column:
        a, b, c, d = (at(u, i) for i in range(4))
        w, x, y, z = (at(v, i) for i in range(4))
        return vector(a * w - b * x - c * y - d * z, a * x + b * w + c * z - d * y, a * y - b * z + c * w + d * x, a * z + b * y - c * x + d * w)

    return let2(p, q, body)


def conjugate(q: Column) -> Column:
    return F.transform(q, lambda x, i: F.when(i == 0, x).otherwise(-x))


def normalise(q: Column) -> Column:
    return let(q, lambda v: let(norm(v), lambda n: F.transform(v, lambda x: F.try_divide(x, n))))


def rotate(q: Column, v: Column) -> Column:
    return let(q, lambda r: F.slice(multiply(multiply(r, F.concat(F.array(F.lit(0.0)), v)), conjugate(r)), 2, 3))


def axis_angle_to_quaternion(v: Column) -> Column:
    def body(u: Column, angle: Column) -> Column:
        s = F.when(angle < 1e-12, F.lit(0.5)).otherwise(F.try_divide(F.sin(angle / 2), angle))
        return F.concat(F.array(F.cos(angle / 2)), scale(u, s))

    return let(v, lambda u: let(norm(u), lambda n: body(u, n)))


def matrix_to_axis_angle(m: Column) -> Column:
    def body(q: Column) -> Column:
        upper = F.when(at(q, 0) < 0, F.transform(q, lambda x: -x)).otherwise(q)
        return let(upper, lambda u: let(norm(F.slice(u, 2, 3)), lambda n: scale(F.slice(u, 2, 3), F.when(n < 1e-12, F.lit(2.0)).otherwise(F.try_divide(2 * F.atan2(n, at(u, 0)), n)))))

    return let(matrix_to_quaternion(m), body)


def pose(position: Column, quaternion: Column) -> Column:
    return F.struct(position.alias("position_m"), quaternion.alias("quaternion_wxyz"))


def inverse_pose(p: Column) -> Column:
    return let(p, lambda a: let(conjugate(a["quaternion_wxyz"]), lambda back: pose(F.transform(rotate(back, a["position_m"]), lambda x: -x), back)))


def compose(a: Column, b: Column) -> Column:
    return let2(a, b, lambda x, y: pose(plus(rotate(x["quaternion_wxyz"], y["position_m"]), x["position_m"]), normalise(multiply(x["quaternion_wxyz"], y["quaternion_wxyz"]))))


def relative(a: Column, b: Column) -> Column:
    """b as seen from a."""
    return compose(inverse_pose(a), b)


def reproject(future: Column, camera_now: Column, camera_future: Column) -> Column:
    """A pose of a later camera frame in the camera frame of now; null without both cameras."""
    return F.when(future.isNotNull() & camera_now.isNotNull() & camera_future.isNotNull(), compose(relative(camera_now, camera_future), future))


def ego_contaminated(camera: Column) -> Column:
    return camera.isNull()


def matrix4(p: Column) -> Column:
    """Sixteen numbers, row by row."""

    def body(r: Column, t: Column) -> Column:
        return vector(*(x for row in range(3) for x in (at(r, 3 * row), at(r, 3 * row + 1), at(r, 3 * row + 2), at(t, row))), 0, 0, 0, 1)

    return let2(quaternion_to_matrix(p["quaternion_wxyz"]), p["position_m"], body)


def from_matrix4(m: Column) -> Column:
    return let(m, lambda v: pose(vector(at(v, 3), at(v, 7), at(v, 11)), matrix_to_quaternion(vector(*(at(v, k) for k in (0, 1, 2, 4, 5, 6, 8, 9, 10))))))


def _columns(x: Column, y: Column, z: Column) -> Column:
    """Nine numbers, row by row, of a matrix with these columns."""
    return let2(x, y, lambda a, b: let(z, lambda c: vector(*(at(v, row) for row in range(3) for v in (a, b, c)))))


def palm_quaternion(points: Column, wrist: int = 0, index: int = 5, pinky: int = 17) -> Column:
    """Frame of the palm: x to the index knuckle, z its normal; null where the points span no plane."""

    def frame(x: Column, aux: Column) -> Column:
        flat = lambda z: norm(z) < 1e-6
        made = lambda z: let(normalise(z), lambda n: matrix_to_quaternion(_columns(x, cross(n, x), n)))
        return let(cross(x, aux), lambda z: F.when(~flat(z), made(z)))

    whole = (F.size(points) > pinky) & (norm(minus(F.get(points, index), F.get(points, wrist))) >= 1e-6) & (norm(minus(F.get(points, pinky), F.get(points, wrist))) >= 1e-6)
    return F.when(whole, let2(normalise(minus(F.get(points, index), F.get(points, wrist))), minus(F.get(points, pinky), F.get(points, wrist)), frame))


def rot6d_to_matrix(v: Column) -> Column:
    """Two columns made orthonormal, the third their product; row by row."""

    def body(x: Column, b: Column) -> Column:
        return let(normalise(minus(b, scale(x, dot(x, b)))), lambda y: _columns(x, y, cross(x, y)))

    return let(v, lambda s: let2(normalise(F.slice(s, 1, 3)), F.slice(s, 4, 3), body))


# ---------------------------------------------------------------- cameras
def pinhole(width: Column, height: Column, hfov_deg: float = 82.0) -> Column:
    """fx, fy, cx, cy of a camera of which only the horizontal field of view is known."""
    f = width / (2 * F.tan(F.radians(F.lit(hfov_deg) / 2)))
    return F.struct(f.alias("fx"), f.alias("fy"), (width / 2).alias("cx"), (height / 2).alias("cy"))


def back_project(x: Column, y: Column, depth: Column, k: Column) -> Column:
    return vector((x - k["cx"]) * depth / k["fx"], (y - k["cy"]) * depth / k["fy"], depth)


def lift(x_norm: Column, y_norm: Column, depth: Column, k: Column, width: Column, height: Column) -> Column:
    return F.transform(back_project(x_norm * width, y_norm * height, depth, k), lambda v: F.round(v, 5))


def project(points: Column, k: Column, sx: Column, sy: Column) -> Column:
    """Pixels of points, scaled; null if one of them isn't in front of the camera."""
    ahead = F.forall(points, lambda p: at(p, 2) > 1e-6)
    pixels = F.transform(points, lambda p: vector((k["fx"] * F.try_divide(at(p, 0), at(p, 2)) + k["cx"]) * sx, (k["fy"] * F.try_divide(at(p, 1), at(p, 2)) + k["cy"]) * sy))
    return F.when(ahead, pixels)


# ---------------------------------------------------------------- boxes and masks
def iou(a: Column, b: Column) -> Column:
    """Of two boxes; 0 if neither has an area."""
    return let2(a, b, _iou)


def _iou(a: Column, b: Column) -> Column:
    w = F.greatest(F.least(at(a, 2), at(b, 2)) - F.greatest(at(a, 0), at(b, 0)), F.lit(0.0))
    h = F.greatest(F.least(at(a, 3), at(b, 3)) - F.greatest(at(a, 1), at(b, 1)), F.lit(0.0))
    area = lambda r: F.greatest(at(r, 2) - at(r, 0), F.lit(0.0)) * F.greatest(at(r, 3) - at(r, 1), F.lit(0.0))
    union = area(a) + area(b) - w * h
    return F.when(union > 0, w * h / union).otherwise(F.lit(0.0))


def clamp_box(box: Column, width: Column, height: Column) -> Column:
    limit = lambda v, top: F.greatest(F.lit(0), F.least(v.cast("int"), top.cast("int")))
    return F.array(limit(at(box, 0), width), limit(at(box, 1), height), limit(at(box, 2), width), limit(at(box, 3), height))


def encode_rle(pixels: Column, height: Column, width: Column) -> Column:
    """Lengths of alternating runs of a column-major array of booleans, the first of false: 'HxW:r0,r1,...'."""
    state = F.struct(F.lit(False).alias("v"), F.lit(0).cast("long").alias("n"), F.array().cast("array<bigint>").alias("r"))

    def step(s: Column, x: Column) -> Column:
        same = s["v"] == x
        return F.struct(x.alias("v"), F.when(same, s["n"] + 1).otherwise(F.lit(1).cast("long")).alias("n"), F.when(same, s["r"]).otherwise(F.concat(s["r"], F.array(s["n"]))).alias("r"))

    runs = F.aggregate(pixels, state, step, lambda s: F.concat(s["r"], F.array(s["n"])))
    return F.concat(height.cast("string"), F.lit("x"), width.cast("string"), F.lit(":"), F.array_join(F.transform(runs, lambda n: n.cast("string")), ","))


def decode_rle(text: Column) -> Column:
    """Column-major array of booleans."""
    runs = F.split(F.element_at(F.split(text, ":"), 2), ",")
    return F.flatten(F.transform(runs, lambda n, i: F.array_repeat(i % 2 == 1, n.cast("int"))))


def mask_iou(a: Column, b: Column) -> Column:
    """Of two arrays of booleans; 1 if both are empty."""
    count = lambda v: F.aggregate(v, F.lit(0).cast("long"), lambda s, x: s + x.cast("long"))
    both, either = count(F.zip_with(a, b, lambda x, y: x & y)), count(F.zip_with(a, b, lambda x, y: x | y))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def mask_box(pixels: Column, width: Column, height: Column) -> Column:
    """Box and centroid of a column-major mask, as shares of its sides, to six places; null if it is empty."""
    return let(pixels, lambda p: _mask_box(p, width, height))


def _mask_box(pixels: Column, width: Column, height: Column) -> Column:
    on = F.filter(F.transform(pixels, lambda p, i: F.when(p, i)), lambda i: i.isNotNull())
    xs, ys = F.transform(on, lambda i: F.floor(i / height)), F.transform(on, lambda i: F.pmod(i.cast("long"), height.cast("long")))
    mean = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / F.size(v)
    share = lambda v, side: F.round(v / side, 6)
    box = F.array(share(F.array_min(xs), width), share(F.array_min(ys), height), share(F.array_max(xs), width), share(F.array_max(ys), height))
    return F.when(F.size(on) > 0, F.struct(box.alias("bbox"), F.array(share(mean(xs), width), share(mean(ys), height)).alias("centroid")))


def mean_point(points: Column) -> Column:
    """Mean of the first two coordinates."""

    def axis(i: int) -> Column:
        return F.aggregate(points, F.lit(0.0), lambda s, p: s + at(p, i)) / F.size(points)

    return F.array(axis(0), axis(1))


def sample_depth(depth_map: Column, x_norm: Column, y_norm: Column) -> Column:
    """Depth at the nearest pixel of rows of numbers, clamped to the map; null if it isn't positive."""
    height, width = F.size(depth_map), F.size(F.get(depth_map, 0))
    pick = lambda v, n: F.greatest(F.lit(0), F.least(F.bround(v * n).cast("int"), n - 1))
    d = F.get(F.get(depth_map, pick(y_norm, height)), pick(x_norm, width))
    return F.when((d > 0) & ~F.isnan(d), d)


def nearest_object(tip: Column, objects: Column, field: str = "centroid_norm") -> Column:
    """The object whose centroid is nearest to a point with its distance; the first of equally near ones; null without any."""
    seen = F.filter(objects, lambda o: F.size(o[field]) >= 2)
    ranked = F.transform(seen, lambda o, i: F.struct(F.hypot(at(tip, 0) - at(o[field], 0), at(tip, 1) - at(o[field], 1)).alias("distance"), i.alias("place"), o.alias("object")))
    return F.array_min(ranked)


# ---------------------------------------------------------------- hands
def finger_curl(points: Column) -> Column:
    """Map of finger to one less the ratio of chord and path over its joints, of the four fingers without the thumb."""
    return let(points, _finger_curl)


def _finger_curl(points: Column) -> Column:
    chains = {"index": (5, 6, 7, 8), "middle": (9, 10, 11, 12), "ring": (13, 14, 15, 16), "pinky": (17, 18, 19, 20)}
    out = []
    for name, chain in chains.items():
        path = sum((distance(at(points, a), at(points, b)) for a, b in zip(chain, chain[1:], strict=False)), F.lit(0.0))
        chord = distance(at(points, chain[0]), at(points, chain[-1]))
        out += [F.lit(name), F.when(path > 1e-9, F.greatest(F.lit(0.0), 1 - chord / path)).otherwise(F.lit(0.0))]
    return F.create_map(*out)


def grasp_signal(points: Column) -> Column:
    return F.aggregate(F.map_values(finger_curl(points)), F.lit(0.0), lambda s, x: s + x) / 4


def near_object(hand_box: Column, objects: Column, least: float = 0.05) -> Column:
    """Whether a box overlaps an object that isn't a hand."""
    return F.exists(objects, lambda o: ~F.lower(o["label"]).contains("hand") & (iou(hand_box, o["bbox"]) >= least))


def pca_project(values: Column, basis: list[list[float]], mean: list[float]) -> Column:
    """Coordinates of values less the mean in rows of a basis."""
    centred = minus(values, vector(*mean))
    return F.array(*(dot(centred, vector(*row)) for row in basis))


def pca_restore(coordinates: Column, basis: list[list[float]], mean: list[float]) -> Column:
    n = len(mean)
    return F.array(*(F.lit(float(mean[j])) + dot(coordinates, vector(*(row[j] for row in basis))) for j in range(n)))


def present_points(points: Column) -> Column:
    """Points of a hand; null for one that a dense array holds as all NaN."""
    return F.when(~F.forall(F.flatten(points), lambda x: x.isNull() | F.isnan(x)), points)


def contact_colour(confidence: Column) -> Column:
    """Red, green, blue of a contact confidence, from grey to red; unknown is 0."""
    x = F.when(confidence.isNull() | F.isnan(confidence), F.lit(0.0)).otherwise(clip(confidence, 0.0, 1.0))
    return let(x, lambda c: F.array((128 + 127 * c).cast("int"), (128 * (1 - c)).cast("int"), (128 * (1 - c)).cast("int")))


def strips(points: Column, edges: list[tuple[int, int]]) -> Column:
    """Pairs of points of the edges whose ends are both known."""
    known = lambda p: p.isNotNull() & F.forall(p, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    pairs = [F.when(known(F.get(points, a)) & known(F.get(points, b)), F.array(F.get(points, a), F.get(points, b))) for a, b in edges]
    return F.filter(F.array(*pairs), lambda e: e.isNotNull())
