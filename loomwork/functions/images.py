"""One-channel images ARRAY<ARRAY<DOUBLE>> as column expressions.

A geometric change is a map from the output pixel (i, j) to a source pixel, so
each one is a single pass over the output.  Random parameters come from the
row's key and a seed.  Pass a plain column as ``img``: it is read per pixel.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.functions.arrays import let, total
from loomwork.functions.hashing import coin, draw_between, draw_int

WHITE = 255.0


def height(img: Column) -> Column:
    return F.size(img)


def width(img: Column) -> Column:
    return F.size(img.getItem(0))


def _count(n) -> Column:
    last = (n if isinstance(n, Column) else F.lit(n)) - 1
    return F.sequence(F.lit(0), last)


def _round_half_up(x: Column) -> Column:
    return F.floor(x + F.lit(0.5)).cast("int")


def pixels(img: Column, change: Callable[[Column], Column]) -> Column:
    return F.transform(img, lambda row: F.transform(row, change))


def sample(img: Column, rows, columns, source: Callable[[Column, Column], tuple[Column, Column]],
           fill: float | None = 0.0) -> Column:
    """Image of rows by columns whose pixel (i, j) is the source pixel; outside is ``fill``."""
    def pixel(i, j):
        si, sj = source(i, j)
        found = F.get(F.get(img, si), sj)
        return found if fill is None else F.coalesce(found, F.lit(float(fill)))
    return F.transform(_count(rows), lambda i: F.transform(_count(columns), lambda j: pixel(i, j)))


def normalize(img: Column, mean: float, std: float) -> Column:
    return pixels(img, lambda x: (x - F.lit(float(mean))) / F.lit(float(std)))


def denormalize(img: Column) -> Column:
    """Inverse of normalize(0.5, 0.5)."""
    return pixels(img, lambda x: x / F.lit(2.0) + F.lit(0.5))


def scale_intensity(img: Column) -> Column:
    """Minimum to 0, maximum to 1; a constant image becomes 0."""
    low, high = F.array_min(F.flatten(img)), F.array_max(F.flatten(img))
    return let(F.struct(low.alias("low"), (high - low).alias("span")), lambda r: pixels(
        img, lambda x: F.when(r["span"] > 0, (x - r["low"]) / r["span"]).otherwise(F.lit(0.0))))


def flip_horizontal(img: Column) -> Column:
    return F.transform(img, F.reverse)


def flip_vertical(img: Column) -> Column:
    return F.reverse(img)


def center_crop(img: Column, rows: int, columns: int) -> Column:
    top = F.floor((height(img) - rows) / F.lit(2)).cast("int")
    left = F.floor((width(img) - columns) / F.lit(2)).cast("int")
    return sample(img, rows, columns, lambda i, j: (i + top, j + left))


def random_crop(img: Column, size: int, padding: int, key: Column, seed: int) -> Column:
    """Crop at a random place of the image padded with zeros on all sides."""
    def offset(extent, name):
        return (draw_int(extent + 2 * padding - size, key, name, seed) - padding).cast("int")
    return let(F.struct(offset(height(img), "top").alias("t"), offset(width(img), "left").alias("l")),
               lambda o: sample(img, size, size, lambda i, j: (i + o["t"], j + o["l"])))


def resize(img: Column, rows: int, columns: int) -> Column:
    """Nearest neighbour."""
    return sample(img, rows, columns, lambda i, j: (
        F.floor(i * height(img) / F.lit(rows)).cast("int"),
        F.floor(j * width(img) / F.lit(columns)).cast("int")), fill=None)


def random_zoom(img: Column, low: float, high: float, key: Column, seed: int) -> Column:
    """Zoom about the centre, size kept, border repeated."""
    def back(i, extent, factor):
        middle = extent / F.lit(2.0)
        at = F.floor((i + F.lit(0.5) - middle) / factor + middle).cast("int")
        return F.greatest(F.lit(0), F.least(extent - 1, at))
    return let(draw_between(low, high, key, "zoom", seed), lambda z: sample(
        img, height(img), width(img),
        lambda i, j: (back(i, height(img), z), back(j, width(img), z)), fill=None))


def _random_box(img: Column, area: tuple[float, float], ratio: tuple[float, float],
                key: Column, name: str, seed: int) -> Column:
    """STRUCT<top, left, rows, columns> of a random rectangle inside the image."""
    share = draw_between(*area, key, f"{name}-area", seed) * height(img) * width(img)
    aspect = F.exp(draw_between(math.log(ratio[0]), math.log(ratio[1]), key, f"{name}-ratio", seed))

    def side(extent, wanted):
        return F.greatest(F.lit(1), F.least(extent, _round_half_up(wanted)))
    rows, columns = side(height(img), F.sqrt(share / aspect)), side(width(img), F.sqrt(share * aspect))
    return let(F.struct(rows.alias("rows"), columns.alias("columns")), lambda b: F.struct(
        draw_int(height(img) - b["rows"], key, f"{name}-top", seed).cast("int").alias("top"),
        draw_int(width(img) - b["columns"], key, f"{name}-left", seed).cast("int").alias("left"),
        b["rows"].alias("rows"), b["columns"].alias("columns")))


def random_resized_crop(img: Column, rows: int, columns: int, key: Column, seed: int) -> Column:
    """A random rectangle (8 to 100 % of the area, ratio 3/4 to 4/3) resized."""
    box = _random_box(img, (0.08, 1.0), (3 / 4, 4 / 3), key, "crop", seed)
    return let(box, lambda b: sample(img, rows, columns, lambda i, j: (
        (b["top"] + F.floor(i * b["rows"] / F.lit(rows))).cast("int"),
        (b["left"] + F.floor(j * b["columns"] / F.lit(columns))).cast("int")), fill=None))


def random_erase(img: Column, value: float, key: Column, seed: int,
                 area: tuple[float, float] = (0.02, 0.33)) -> Column:
    """Overwrite a random rectangle (ratio 0.3 to 3.3)."""
    box = _random_box(img, area, (0.3, 3.3), key, "erase", seed)

    def inside(b, i, j):
        return ((i >= b["top"]) & (i < b["top"] + b["rows"])
                & (j >= b["left"]) & (j < b["left"] + b["columns"]))
    return let(box, lambda b: F.transform(img, lambda row, i: F.transform(
        row, lambda x, j: F.when(inside(b, i, j), F.lit(float(value))).otherwise(x))))


def _clamp(x: Column) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))


def jitter(img: Column, brightness: float, contrast: float, key: Column, seed: int) -> Column:
    """Random brightness, then random contrast about the mean; values stay in [0, 1]."""
    def factor(name, strength):
        return draw_between(max(0.0, 1 - strength), 1 + strength, key, name, seed)

    def spread(lit):
        mean = total(F.flatten(lit)) / (height(lit) * width(lit))
        by = F.struct(mean.alias("m"), factor("contrast", contrast).alias("c"))
        return let(by, lambda s: pixels(lit, lambda x: _clamp(s["m"] + s["c"] * (x - s["m"]))))
    bright = let(factor("brightness", brightness), lambda b: pixels(img, lambda x: _clamp(x * b)))
    return let(bright, spread)


def _rgb_shift(r: Column, g: Column, b: Column, turn: Column) -> Column:
    """Pixel STRUCT<r,g,b> with its hue turned by a share of the circle."""
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    span = top - low
    sixth = (F.when(span == 0, F.lit(0.0))
             .when(top == r, (g - b) / span)
             .when(top == g, (b - r) / span + 2)
             .otherwise((r - g) / span + 4))
    hue = F.pmod(sixth / F.lit(6.0) + turn, F.lit(1.0)) * F.lit(6.0)

    def channel(n):
        k = F.pmod(F.lit(float(n)) + hue, F.lit(6.0))
        return top - span * F.greatest(F.lit(0.0), F.least(k, F.lit(4.0) - k, F.lit(1.0)))
    return F.struct(channel(5).alias("r"), channel(3).alias("g"), channel(1).alias("b"))


def jitter_color(rgb: Column, saturation: float, hue: float, key: Column, seed: int) -> Column:
    """Random saturation, then hue, of ARRAY<ARRAY<STRUCT<r,g,b>>> with values in [0, 1]."""
    by = F.struct(
        draw_between(max(0.0, 1 - saturation), 1 + saturation, key, "saturation", seed).alias("s"),
        draw_between(-hue, hue, key, "hue", seed).alias("h"))

    def one(p, f):
        # Luma weights of red, green and blue.
        grey = 0.299 * p["r"] + 0.587 * p["g"] + 0.114 * p["b"]

        def mixed(x):
            return _clamp(grey + f["s"] * (x - grey))
        blended = F.struct(mixed(p["r"]).alias("r"), mixed(p["g"]).alias("g"), mixed(p["b"]).alias("b"))
        return let(blended, lambda q: _rgb_shift(q["r"], q["g"], q["b"], f["h"]))
    return let(by, lambda f: F.transform(rgb, lambda row: F.transform(row, lambda p: one(p, f))))


def _reflect(at: Column, extent: Column) -> Column:
    inside = F.abs(at)
    return F.when(inside >= extent, 2 * (extent - 1) - inside).otherwise(inside)


def blur(img: Column, size: int, sigma: Column) -> Column:
    """Gaussian blur, one axis after the other; the border is mirrored."""
    reach = size // 2
    weights = F.transform(F.sequence(F.lit(-reach), F.lit(reach)),
                          lambda d: F.exp(F.lit(-0.5) * (d / sigma) * (d / sigma)))

    def along(line, kernel, norm):
        def at(x, p):
            terms = F.transform(kernel, lambda w, t: w * F.get(line, _reflect(p + t - reach, F.size(line))))
            return total(terms) / norm
        return F.transform(line, at)

    def both(kernel, norm):
        def columns(across):
            turned = F.transform(_count(width(img)), lambda j: F.transform(across, lambda r: F.get(r, j)))
            done = F.transform(turned, lambda line: along(line, kernel, norm))
            return let(done, lambda d: F.transform(
                _count(height(img)), lambda i: F.transform(d, lambda c: F.get(c, i))))
        return let(F.transform(img, lambda line: along(line, kernel, norm)), columns)
    return let(weights, lambda kernel: let(total(kernel), lambda norm: both(kernel, norm)))


def warp(img: Column, coefficients: Column, fill: float = 0.0) -> Column:
    """Output pixel (x, y) shows the source at ((ax+by+c)/w, (dx+ey+f)/w), w = gx+hy+1.

    ``coefficients`` is ARRAY<DOUBLE> a..h over coordinates from the image
    centre; the nearest pixel is taken and the size kept.
    """
    def place(m):
        mid_y, mid_x = (height(img) - 1) / F.lit(2.0), (width(img) - 1) / F.lit(2.0)

        def source(i, j):
            y, x = i - mid_y, j - mid_x
            w = m[6] * x + m[7] * y + F.lit(1.0)
            return (_round_half_up((m[3] * x + m[4] * y + m[5]) / w + mid_y),
                    _round_half_up((m[0] * x + m[1] * y + m[2]) / w + mid_x))
        return sample(img, height(img), width(img), source, fill)
    return let(coefficients, place)


def rotation(degrees: Column) -> Column:
    """Coefficients of a rotation about the centre."""
    none = F.lit(0.0)
    angle = F.radians(degrees)
    return F.array(F.cos(angle), F.sin(angle), none, -F.sin(angle), F.cos(angle), none, none, none)


def affine(degrees: Column, shift_x: Column, shift_y: Column, zoom: Column, shear: Column) -> Column:
    """Coefficients that undo shift, then rotation and zoom, then horizontal shear."""
    angle, lean = F.radians(degrees), F.tan(F.radians(shear))
    none = F.lit(0.0)
    cos, sin = F.cos(angle) / zoom, F.sin(angle) / zoom
    a, b, d, e = cos + lean * sin, sin - lean * cos, -sin, cos
    return F.array(a, b, -(a * shift_x + b * shift_y), d, e, -(d * shift_x + e * shift_y), none, none)


def perspective(size: int, distortion: float, key: Column, seed: int) -> Column:
    """Coefficients that map the square onto a quadrilateral with randomly moved corners."""
    half, reach = (size - 1) / 2, distortion * (size - 1) / 2
    corners = []
    for n, (sx, sy) in enumerate([(-1, -1), (1, -1), (1, 1), (-1, 1)]):
        x = F.lit(sx * half) - F.lit(float(sx)) * draw_between(0, reach, key, f"x{n}", seed)
        y = F.lit(sy * half) - F.lit(float(sy)) * draw_between(0, reach, key, f"y{n}", seed)
        corners += [x.alias(f"x{n}"), y.alias(f"y{n}")]

    def solve(q):
        sum_x, sum_y = (q[f"{v}0"] - q[f"{v}1"] + q[f"{v}2"] - q[f"{v}3"] for v in "xy")
        x12, x32 = q["x1"] - q["x2"], q["x3"] - q["x2"]
        y12, y32 = q["y1"] - q["y2"], q["y3"] - q["y2"]
        det = x12 * y32 - x32 * y12
        g, h = (sum_x * y32 - x32 * sum_y) / det, (x12 * sum_y - sum_x * y12) / det
        # u, v in 0..1 across the square; rewritten below for coordinates from the centre.
        unit = F.struct(
            (q["x1"] - q["x0"] + g * q["x1"]).alias("a"), (q["x3"] - q["x0"] + h * q["x3"]).alias("b"),
            q["x0"].alias("c"), (q["y1"] - q["y0"] + g * q["y1"]).alias("d"),
            (q["y3"] - q["y0"] + h * q["y3"]).alias("e"), q["y0"].alias("f"),
            g.alias("g"), h.alias("h"))
        return let(unit, centred)

    def centred(u):
        side = F.lit(float(size - 1))

        def shifted(x, y, c):
            return c + (x + y) / F.lit(2.0)
        w0 = shifted(u["g"], u["h"], F.lit(1.0))
        return let(w0, lambda w: F.array(
            u["a"] / side / w, u["b"] / side / w, shifted(u["a"], u["b"], u["c"]) / w,
            u["d"] / side / w, u["e"] / side / w, shifted(u["d"], u["e"], u["f"]) / w,
            u["g"] / side / w, u["h"] / side / w))
    return let(F.struct(*corners), solve)


def augment(df: DataFrame, img: str, key: str, steps: list[tuple[str, float, Callable]],
            seed: int) -> DataFrame:
    """Apply named steps in order, each with its probability.

    A step is (name, probability, function of the image column).
    """
    for name, share, change in steps:
        hit = coin(F.col(key), name, seed) < F.lit(float(share))
        df = df.withColumn(img, F.when(hit, change(F.col(img))).otherwise(F.col(img)))
    return df


def placeholder(rows: int = 224, columns: int = 224) -> Column:
    """A constant white image."""
    return F.array_repeat(F.array_repeat(F.lit(WHITE), columns), rows)
