"""Image arrays: every vector as an 8 by 8 one-channel image."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomwork.functions import arrays as A
from loomwork.functions import images as I
from loomwork.functions.hashing import draw_between
from loomwork.plans import fragments as S
from loomwork.plans.registry import query
from loomwork.sources import tables as t

SEED = 3


def shown(img):
    return A.fixed6(F.flatten(img))


def c(*parts):
    return S.coin("id", *[f"'{p}'" for p in parts], f"'{SEED}'")


def between(low, high, name):
    return f"({low}::DOUBLE + {c(name)} * ({high}::DOUBLE - {low}::DOUBLE))"


# Images scaled to [0, 1]
SCALED = S.PIXELS + """,
ends AS (SELECT id, min(v) AS lo, max(v) AS hi FROM px GROUP BY id),
sc AS (SELECT id, i, j, CASE WHEN hi > lo THEN (v - lo) / (hi - lo) ELSE 0 END AS v FROM px JOIN ends USING (id))"""


def looked_up(source: str, si: str, sj: str, params: str = "", height: int = 8, width: int = 8, fill: str = "0") -> str:
    """SQL: image of height by width whose pixel (i, j) is source pixel (si, sj); p.* are parameters."""
    return f"""outp AS (SELECT p.id, r.i, s.j, ({si})::BIGINT AS si, ({sj})::BIGINT AS sj
  FROM (SELECT id{params} FROM (SELECT DISTINCT id FROM {source})) p, range({height}) r(i), range({width}) s(j)),
img AS (SELECT o.id, o.i, o.j, coalesce(x.v, {fill}) AS v FROM outp o
  LEFT JOIN {source} x ON x.id = o.id AND x.i = o.si AND x.j = o.sj)"""


@query("image_normalize", f"""
WITH {S.PIXELS} SELECT id, {S.grid('(v - 0.1307) / 0.3081')} AS normalized, {S.grid('v / 2 + 0.5')} AS restored
FROM px GROUP BY id""")
def image_normalize(spark, d):
    img = F.col("img")
    return t.images(spark, d).select("id", shown(I.normalize(img, 0.1307, 0.3081)).alias("normalized"),
                                     shown(I.denormalize(img)).alias("restored"))


@query("image_scale_intensity", f"WITH {SCALED} SELECT id, {S.grid('v')} AS scaled FROM sc GROUP BY id")
def image_scale_intensity(spark, d):
    return t.images(spark, d).select("id", shown(I.scale_intensity(F.col("img"))).alias("scaled"))


@query("image_flip", f"""
WITH {S.PIXELS}, fx AS (SELECT id, i, CASE WHEN {c('across')} < 0.5 THEN 7 - j ELSE j END AS j, v FROM px),
fy AS (SELECT id, CASE WHEN {c('down')} < 0.5 THEN 7 - i ELSE i END AS i, j, v FROM fx)
SELECT id, {S.grid('v')} AS flipped FROM fy GROUP BY id""")
def image_flip(spark, d):
    steps = [("across", 0.5, I.flip_horizontal), ("down", 0.5, I.flip_vertical)]
    return I.augment(t.images(spark, d), "img", "id", steps, SEED).select("id", shown("img").alias("flipped"))


@query("image_crop", f"""
WITH {S.PIXELS}, {looked_up('px', 'r.i + p.t', 's.j + p.l',
  f", {S.draw('8', 'id', "'top'", "'3'")} - 4 AS t, {S.draw('8', 'id', "'left'", "'3'")} - 4 AS l")},
center AS (SELECT id, {S.grid('v')} AS center FROM px WHERE i BETWEEN 2 AND 5 AND j BETWEEN 2 AND 5 GROUP BY id)
SELECT id, {S.grid('v')} AS random, any_value(center) AS center FROM img JOIN center USING (id) GROUP BY id""")
def image_crop(spark, d):
    img = F.col("img")
    return t.images(spark, d).select("id", shown(I.center_crop(img, 4, 4)).alias("center"),
                                     shown(I.random_crop(img, 8, 4, F.col("id"), SEED)).alias("random"))


def _box(name: str, area: tuple, ratio: tuple) -> str:
    """SQL CTEs giving (id, t, l, h, w) of a random rectangle."""
    share, aspect = between(*area, f"{name}-area"), f"exp({between(f'ln({ratio[0]}::DOUBLE)', f'ln({ratio[1]}::DOUBLE)', f'{name}-ratio')})"
    return f"""sides AS (SELECT vec_id AS id FROM embeddings), shape AS (SELECT id, {share} * 64 AS area, {aspect} AS aspect FROM sides),
hw AS (SELECT id, greatest(1, least(8, floor(sqrt(area / aspect) + 0.5)))::INTEGER AS h,
  greatest(1, least(8, floor(sqrt(area * aspect) + 0.5)))::INTEGER AS w FROM shape),
box AS (SELECT id, h, w, {S.draw('8 - h', 'id', f"'{name}-top'", "'3'")} AS t, {S.draw('8 - w', 'id', f"'{name}-left'", "'3'")} AS l FROM hw)"""


@query("image_resize", f"""
WITH {S.PIXELS}, {_box('crop', (0.08, 1.0), ('0.75', '4/3'))},
big AS (SELECT id, {S.grid('v', 'r.k, s.k')} AS enlarged FROM px, range(12) r(k), range(12) s(k)
  WHERE i = r.k * 8 // 12 AND j = s.k * 8 // 12 GROUP BY id),
zoomed AS (SELECT id, r.i AS i, s.j AS j, greatest(0, least(7, floor((r.i + 0.5 - 4) / z + 4)))::INTEGER AS si,
  greatest(0, least(7, floor((s.j + 0.5 - 4) / z + 4)))::INTEGER AS sj
  FROM (SELECT id, {between(0.9, 1.1, 'zoom')} AS z FROM sides), range(8) r(i), range(8) s(j)),
zoom AS (SELECT o.id, {S.grid('v', 'o.i, o.j')} AS zoomed FROM zoomed o
  JOIN px ON px.id = o.id AND px.i = o.si AND px.j = o.sj GROUP BY o.id),
cropped AS (SELECT b.id, {S.grid('v', 'r.k, s.k')} AS cropped FROM box b, range(8) r(k), range(8) s(k), px
  WHERE px.id = b.id AND px.i = b.t + r.k * b.h // 8 AND px.j = b.l + s.k * b.w // 8 GROUP BY b.id)
SELECT id, enlarged, zoomed, cropped FROM big JOIN zoom USING (id) JOIN cropped USING (id)""")
def image_resize(spark, d):
    img, key = F.col("img"), F.col("id")
    return t.images(spark, d).select(
        "id", shown(I.resize(img, 12, 12)).alias("enlarged"),
        shown(I.random_zoom(img, 0.9, 1.1, key, SEED)).alias("zoomed"),
        shown(I.random_resized_crop(img, 8, 8, key, SEED)).alias("cropped"))


@query("image_erase", f"""
WITH {S.PIXELS}, {_box('erase', (0.02, 0.33), ('0.3', '3.3'))}
SELECT id, {S.grid(f'''CASE WHEN {c('erase')} < 0.5 AND i >= t AND i < t + h AND j >= l AND j < l + w THEN 0 ELSE v END''')} AS erased
FROM px JOIN box USING (id) GROUP BY id""")
def image_erase(spark, d):
    steps = [("erase", 0.5, lambda img: I.random_erase(img, 0.0, F.col("id"), SEED))]
    return I.augment(t.images(spark, d), "img", "id", steps, SEED).select("id", shown("img").alias("erased"))


def _clamp(x):
    return f"greatest(0, least(1, {x}))"


@query("image_jitter", f"""
WITH {SCALED}, lit AS (SELECT id, i, j, {_clamp(f"v * {between(0.5, 1.5, 'brightness')}")} AS v FROM sc),
mean AS (SELECT id, avg(v) AS m FROM lit GROUP BY id),
jit AS (SELECT id, i, j, {_clamp(f"m + {between(0.5, 1.5, 'contrast')} * (v - m)")} AS v FROM lit JOIN mean USING (id)),
rgb AS (SELECT id, a.i, a.j, a.v AS r, b.v AS g, 1 - a.v AS b FROM sc a JOIN sc b USING (id) WHERE b.i = a.j AND b.j = a.i),
grey AS (SELECT *, 0.299::DOUBLE * r + 0.587::DOUBLE * g + 0.114::DOUBLE * b AS y, {between(0.5, 1.5, 'saturation')} AS s,
  {between(-0.1, 0.1, 'hue')} AS turn FROM rgb),
sat AS (SELECT id, i, j, turn, {_clamp('y + s * (r - y)')} AS r, {_clamp('y + s * (g - y)')} AS g,
  {_clamp('y + s * (b - y)')} AS b FROM grey),
hsv AS (SELECT id, i, j, turn, greatest(r, g, b) AS top, greatest(r, g, b) - least(r, g, b) AS span,
  CASE WHEN greatest(r, g, b) = least(r, g, b) THEN 0 WHEN r = greatest(r, g, b) THEN (g - b) / (r - least(g, b))
  WHEN g = greatest(r, g, b) THEN (b - r) / (g - least(r, b)) + 2 ELSE (r - g) / (b - least(r, g)) + 4 END AS sixth FROM sat),
turned AS (SELECT id, i, j, top, span, 6 * ((sixth / 6 + turn) - floor(sixth / 6 + turn)) AS h FROM hsv),
back AS (SELECT id, i, j, n, top - span * greatest(0, least(k, 4 - k, 1)) AS x
  FROM (SELECT *, (n + h) - 6 * floor((n + h) / 6) AS k FROM turned, (VALUES (5), (3), (1)) ch(n))),
color AS (SELECT id, {S.grid('x', 'n DESC, i, j')} AS color FROM back GROUP BY id)
SELECT id, {S.grid('v')} AS jittered, any_value(color) AS color FROM jit JOIN color USING (id) GROUP BY id""")
def image_jitter(spark, d):
    key = F.col("id")
    scaled = t.images(spark, d).withColumn("img", I.scale_intensity(F.col("img")))
    scaled = scaled.withColumn("turned", A.transpose(F.col("img")))
    # Three channels: the image, its transpose, and its negative.
    rgb = F.zip_with("img", "turned", lambda a, b: F.zip_with(a, b, lambda x, y: F.struct(
        x.alias("r"), y.alias("g"), (F.lit(1.0) - x).alias("b"))))
    colored = scaled.withColumn("rgb", rgb).withColumn(
        "rgb", I.jitter_color(F.col("rgb"), 0.5, 0.1, key, SEED))
    channels = F.concat(*[F.flatten("rgb").getField(channel) for channel in "rgb"])
    return colored.select("id", shown(I.jitter(F.col("img"), 0.5, 0.5, key, SEED)).alias("jittered"),
                          A.fixed6(channels).alias("color"))


@query("image_blur", f"""
WITH {S.PIXELS}, sig AS (SELECT vec_id AS id, 0.1 + {S.coin('vec_id', "'sigma'", "'3'")} * 1.9 AS s FROM embeddings),
k AS (SELECT id, d, exp(-0.5 * (d / s) * (d / s)) AS w FROM sig, range(-2, 3) r(d)),
kn AS (SELECT id, d, w / sum(w) OVER (PARTITION BY id) AS w FROM k),
bx AS (SELECT px.id, i, o.j, sum(w * v) AS v FROM range(8) o(j), kn, px WHERE px.id = kn.id AND
  px.j = CASE WHEN abs(o.j + d) > 7 THEN 14 - abs(o.j + d) ELSE abs(o.j + d) END GROUP BY px.id, i, o.j),
b AS (SELECT bx.id, o.i, j, sum(w * v) AS v FROM range(8) o(i), kn, bx WHERE bx.id = kn.id AND
  bx.i = CASE WHEN abs(o.i + d) > 7 THEN 14 - abs(o.i + d) ELSE abs(o.i + d) END GROUP BY bx.id, o.i, j)
SELECT id, {S.grid('v')} AS blurred FROM b GROUP BY id""")
def image_blur(spark, d):
    sigma = draw_between(0.1, 2.0, F.col("id"), "sigma", SEED)
    return t.images(spark, d).withColumn("s", sigma).select(
        "id", shown(I.blur(F.col("img"), 5, F.col("s"))).alias("blurred"))


_AT = "floor({} + 3.5 + 0.5)"


def _linear(a, b, e, f, shift_x="0", shift_y="0", w="1"):
    """SQL source row and column of a map given in coordinates from the centre."""
    x, y = "(s.j - 3.5)", "(r.i - 3.5)"
    return (_AT.format(f"({e} * {x} + {f} * {y} + {shift_y}) / {w}"),
            _AT.format(f"({a} * {x} + {b} * {y} + {shift_x}) / {w}"))


def _warped(name: str, params: str, si: str, sj: str) -> str:
    body = looked_up("px", si, sj, params).replace("outp", f"{name}_at").replace("img AS", f"{name}_img AS")
    return body + f", {name} AS (SELECT id, {S.grid('v')} AS {name} FROM {name}_img GROUP BY id)"


_CORNERS = ", ".join(
    f"{sign * 3.5}::DOUBLE - ({sign}) * {c(f'{axis}{n}')} * (0.6::DOUBLE * 7 / 2) AS {axis}{n}"
    for n, (sx, sy) in enumerate([(-1, -1), (1, -1), (1, 1), (-1, 1)]) for axis, sign in (("x", sx), ("y", sy)))


@query("image_warp", f"""
WITH {S.PIXELS},
{_warped('rotated', f", radians({between(0, 180, 'angle')}) AS a",
         *_linear('cos(p.a)', 'sin(p.a)', '-sin(p.a)', 'cos(p.a)'))},
{_warped('moved', f''', radians({between(0, 360, 'turn')}) AS a, {between(-0.8, 0.8, 'dx')} AS dx, {between(-0.8, 0.8, 'dy')} AS dy,
  {between(0.7, 1.3, 'size')} AS z, tan(radians({between(0, 20, 'shear')})) AS q''',
         _AT.format('(-sin(p.a) / p.z * (s.j - 3.5 - p.dx) + cos(p.a) / p.z * (r.i - 3.5 - p.dy))'),
         _AT.format('''((cos(p.a) / p.z + p.q * sin(p.a) / p.z) * (s.j - 3.5 - p.dx)
           + (sin(p.a) / p.z - p.q * cos(p.a) / p.z) * (r.i - 3.5 - p.dy))'''))},
corners AS (SELECT id, {_CORNERS} FROM (SELECT vec_id AS id FROM embeddings)),
det AS (SELECT *, (x1 - x2) * (y3 - y2) - (x3 - x2) * (y1 - y2) AS det, x0 - x1 + x2 - x3 AS sx, y0 - y1 + y2 - y3 AS sy FROM corners),
gh AS (SELECT *, (sx * (y3 - y2) - (x3 - x2) * sy) / det AS g, ((x1 - x2) * sy - sx * (y1 - y2)) / det AS h FROM det),
tilt_at AS (SELECT id, i, j, u, v, g * u + h * v + 1 AS w,
  (x1 - x0 + g * x1) * u + (x3 - x0 + h * x3) * v + x0 AS sx, (y1 - y0 + g * y1) * u + (y3 - y0 + h * y3) * v + y0 AS sy
  FROM (SELECT *, j / 7.0::DOUBLE AS u, i / 7.0::DOUBLE AS v FROM gh, range(8) r(i), range(8) s(j))),
tilted AS (SELECT o.id, {S.grid('coalesce(px.v, 0)', 'o.i, o.j')} AS tilted FROM tilt_at o LEFT JOIN px ON px.id = o.id
  AND px.i = floor(sy / w + 4) AND px.j = floor(sx / w + 4) GROUP BY o.id)
SELECT id, rotated, moved, tilted FROM rotated JOIN moved USING (id) JOIN tilted USING (id)""")
def image_warp(spark, d):
    img, key = F.col("img"), F.col("id")

    def draw(low, high, name):
        return draw_between(low, high, key, name, SEED)
    moved = I.affine(draw(0, 360, "turn"), draw(-0.8, 0.8, "dx"), draw(-0.8, 0.8, "dy"),
                     draw(0.7, 1.3, "size"), draw(0, 20, "shear"))
    return t.images(spark, d).select(
        "id", shown(I.warp(img, I.rotation(draw(0, 180, "angle")))).alias("rotated"),
        shown(I.warp(img, moved)).alias("moved"),
        shown(I.warp(img, I.perspective(8, 0.6, key, SEED))).alias("tilted"))


@query("augment_chain", f"""
WITH {SCALED}, a AS (SELECT id, i, CASE WHEN {c('mirror')} < 0.5 THEN 7 - j ELSE j END AS j, v FROM sc),
{looked_up('a', 'CASE WHEN p.hit THEN r.i + p.t ELSE r.i END', 'CASE WHEN p.hit THEN s.j + p.l ELSE s.j END',
  f", {c('shift')} < 0.7 AS hit, {S.draw('4', 'id', "'top'", "'3'")} - 2 AS t, {S.draw('4', 'id', "'left'", "'3'")} - 2 AS l")},
n AS (SELECT id, i, j, (v - 0.5) / 0.5 AS v FROM img)
SELECT id, {S.grid('v')} AS augmented FROM n GROUP BY id""")
def augment_chain(spark, d):
    scaled = t.images(spark, d).withColumn("img", I.scale_intensity(F.col("img")))
    steps = [("mirror", 0.5, I.flip_horizontal),
             ("shift", 0.7, lambda img: I.random_crop(img, 8, 2, F.col("id"), SEED)),
             ("normalize", 1.0, lambda img: I.normalize(img, 0.5, 0.5))]
    return I.augment(scaled, "img", "id", steps, SEED).select("id", shown("img").alias("augmented"))


@query("image_placeholder", f"""
WITH {S.PIXELS}, s AS (SELECT id, round(v, 6) AS corner FROM px WHERE i = 7 AND j = 7)
SELECT doc_id, s.id IS NULL AS missing, CASE WHEN s.id IS NULL THEN 224 ELSE 8 END::INTEGER AS height,
  CASE WHEN s.id IS NULL THEN 224 ELSE 8 END::INTEGER AS width,
  CASE WHEN s.id IS NULL THEN 255.0::DOUBLE ELSE corner END AS corner FROM documents LEFT JOIN s ON s.id = doc_id""")
def image_placeholder(spark, d):
    images = t.images(spark, d).select(F.col("id").alias("doc_id"), "img")
    joined = t.load(spark, d, "documents").select("doc_id").join(images, "doc_id", "left")
    filled = joined.select("doc_id", F.col("img").isNull().alias("missing"),
                           F.coalesce("img", I.placeholder()).alias("img"))
    return filled.select("doc_id", "missing", I.height(F.col("img")).alias("height"),
                         I.width(F.col("img")).alias("width"),
                         F.round(F.element_at(F.element_at("img", -1), -1), 6).alias("corner"))
