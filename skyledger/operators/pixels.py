"""Images as pixel tables (image, y, x, value, dq): photometry, centroids, detection, composition, resampling.

Stars are (image, id, sx, sy) in pixels; a pixel belongs to the integer nearest to its centre. A star meets the pixels
of a box around it by an equi join on (image, tile): a star goes into each tile its box touches, a pixel into its own.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources.staging import staged
from .offset import median

TILE = 32


def box_join(stars: DataFrame, pixels: DataFrame, half: float) -> DataFrame:
    """Pixels at most ``half`` from the star along each axis, with dx and dy."""
    t = lambda c: F.floor(c / TILE).cast("long")
    s = stars.select(
        "*",
        F.explode(F.sequence(t(F.col("sx") - half), t(F.col("sx") + half))).alias("_tx"),
    ).select("*", F.explode(F.sequence(t(F.col("sy") - half), t(F.col("sy") + half))).alias("_ty"))
    p = pixels.withColumns({"_tx": t(F.col("x")), "_ty": t(F.col("y"))})
    j = s.join(p, ["image", "_tx", "_ty"]).drop("_tx", "_ty").withColumns({"dx": F.col("x") - F.col("sx"), "dy": F.col("y") - F.col("sy")})
    return j.where((F.abs("dx") <= half) & (F.abs("dy") <= half))


def bad(c: str = "value") -> Column:
    return F.col(c).isNull() | F.isnan(c)


def corner_area(x: str, y: str, r: float) -> str:
    """SQL: the signed area of a circle of radius r about 0 between the axes and the lines at x and y.

    Below the circle's arc that is a strip of height y as far as the arc is above it, and then what is under the arc.
    """
    x_, y_, rr = f"least(abs({x}), {r})", f"least(abs({y}), {r})", r * r
    turn = f"sqrt({rr} - {y_} * {y_})"
    under = lambda u: f"0.5 * ({u} * sqrt(greatest(0, {rr} - {u} * {u})) + {rr} * asin(least(1, {u} / {r})))"
    return f"sign({x}) * sign({y}) * CASE WHEN {x_} * {x_} + {y_} * {y_} <= {rr} THEN {x_} * {y_} ELSE {y_} * {turn} + {under(x_)} - {under(turn)} END"


def overlap_area(dx: str, dy: str, r: float) -> str:
    """SQL: the area that a circle of radius r shares with the unit pixel whose centre lies (dx, dy) from the circle's."""
    corner = lambda i, j: "(" + corner_area(f"({dx} {i} 0.5)", f"({dy} {j} 0.5)", float(r)) + ")"
    whole = f"sqrt({dx} * {dx} + {dy} * {dy})"
    return f"CASE WHEN {whole} >= {r + 0.7072} THEN 0.0 WHEN {whole} <= {r - 0.7072} THEN 1.0 ELSE {corner('+', '+')} - {corner('-', '+')} - {corner('+', '-')} + {corner('-', '-')} END"


def aperture_flux(stars: DataFrame, pixels: DataFrame, radius: float = 3.0, inner: float = 6.0, outer: float = 9.0) -> DataFrame:
    """Flux within ``radius``, each pixel by the share of it that lies inside, less the local background times the area.

    ``sky`` and ``sky_std`` are the median and the (population) standard deviation of the present pixels whose centres lie in the
    annulus. A star with more than half a pixel missing in its aperture has no flux. The annulus must be wider than the
    aperture.
    """
    j = box_join(stars, pixels, outer).withColumns({"share": F.expr(overlap_area("dx", "dy", radius)).cast("double"), "r": F.hypot("dx", "dy")})
    ring = (F.col("r") >= inner) & (F.col("r") < outer) & ~bad()
    x = j.groupBy("image", "id").agg(
        F.sum(F.when(~bad(), F.col("value") * F.col("share"))).alias("_sum"),
        F.sum(F.when(bad(), F.col("share")).otherwise(0.0)).alias("missing"),
        F.percentile(F.when(ring, F.col("value")), 0.5).alias("sky"),
        F.stddev_pop(F.when(ring, F.col("value"))).alias("sky_std"),
    )
    area = math.pi * radius * radius
    return x.select("image", "id", "missing", "sky", "sky_std", F.when(F.col("missing") <= 0.5, F.coalesce("_sum", F.lit(0.0)) - F.col("sky") * area).alias("flux"))


def recentroid(stars: DataFrame, pixels: DataFrame, half: int = 5) -> DataFrame:
    """Flux-weighted centroid of the stamp less its minimum, and how far it ``moved``; missing pixels count as 0.

    A stamp that leaves the image or has no flux over its minimum keeps the star where it is.
    """
    centre = stars.withColumns({"_ox": F.col("sx"), "_oy": F.col("sy"), "sx": F.rint("sx"), "sy": F.rint("sy")})
    j = box_join(centre, pixels, half).withColumn("value", F.when(bad(), 0.0).otherwise(F.col("value")))
    low = F.min("value").over(W.partitionBy("image", "id"))
    x = j.withColumn("w", F.col("value") - low).groupBy("image", "id").agg(F.sum("w").alias("_w"), F.sum(F.col("w") * F.col("dx")).alias("_x"), F.sum(F.col("w") * F.col("dy")).alias("_y"), F.count(F.lit(1)).alias("n"))
    y = centre.join(x, ["image", "id"], "left")
    ok = (F.col("n") == (2 * half + 1) ** 2) & (F.col("_w") > 0)
    cx = F.when(ok, F.col("sx") + F.col("_x") / F.col("_w")).otherwise(F.col("_ox"))
    cy = F.when(ok, F.col("sy") + F.col("_y") / F.col("_w")).otherwise(F.col("_oy"))
    return y.select("image", "id", cx.alias("cx"), cy.alias("cy"), F.hypot(cx - F.col("_ox"), cy - F.col("_oy")).alias("moved"))


def psf_against_aperture(
    stars: DataFrame, pixels: DataFrame, radius: float = 3.0, inner: float = 6.0, outer: float = 9.0, apart: float = 12.0, most: int = 20_000, least: int = 50, least_sn: float = 30.0, far: float = 3.0
) -> DataFrame:
    """PSF fluxes of stars (image, id, sx, sy, flux) against apertures measured on their image, one row for each image.

    Isolated stars away from the edge are taken, the brightest ``most`` of an image, and set on their centroids; ``shift`` is
    the median move. Those whose aperture is whole, positive and over ``least_sn`` times the annulus' scatter and that moved
    less than ``far`` count (n). ``correction`` and ``scatter`` are the median and the scaled median deviation of aperture minus
    PSF magnitudes, ``tail`` the share beyond 0.3 mag. Where fewer than ``least`` stars are left these are null, with a reason.
    """
    from .offset import mad_std

    size = pixels.groupBy("image").agg((F.max("x") + 1).alias("_nx"), (F.max("y") + 1).alias("_ny"))
    edge = outer + 1
    inside = (F.col("sx") > edge) & (F.col("sx") < F.col("_nx") - edge) & (F.col("sy") > edge) & (F.col("sy") < F.col("_ny") - edge)
    alone = isolated_sources(stars, apart).join(size, "image").where(inside).drop("_nx", "_ny")
    by_flux = W.partitionBy("image").orderBy(F.desc("flux"), "id")
    taken = staged(alone.withColumn("_r", F.row_number().over(by_flux)).where(F.col("_r") <= most).drop("_r"), "isolated")
    moved = staged(recentroid(taken.select("image", "id", "sx", "sy"), pixels), "centroids")
    measured = aperture_flux(moved.select("image", "id", F.col("cx").alias("sx"), F.col("cy").alias("sy")), pixels, radius, inner, outer)
    x = taken.select("image", "id", F.col("flux").alias("psf")).join(moved.select("image", "id", "moved"), ["image", "id"]).join(measured, ["image", "id"], "left")
    noise = F.col("sky_std") * math.sqrt(math.pi * radius * radius)
    clean = (F.col("flux") > 0) & (F.col("psf") > 0) & S.finite(F.col("psf")) & (F.try_divide("flux", noise) > least_sn) & (F.col("moved") < far)
    x = staged(x.withColumn("dm", F.when(clean, -2.5 * F.log10("flux") + 2.5 * F.log10("psf"))), "apertures")
    shift = x.groupBy("image").agg(F.count(F.lit(1)).alias("isolated"), median("moved").alias("shift"), F.count("dm").alias("n"))
    good = x.where("dm is not null").join(shift.where((F.col("isolated") >= least) & (F.col("n") >= least)).select("image"), "image", "left_semi")
    s = mad_std(good, ["image"], "dm")
    tail = good.join(s, "image").groupBy("image", F.col("dm_med").alias("correction"), F.col("dm_mad").alias("scatter")).agg(F.avg((F.abs(F.col("dm") - F.col("dm_med")) > 0.3).cast("double")).alias("tail"))
    reason = F.when(F.coalesce("isolated", F.lit(0)) < least, "too few isolated stars").when(F.col("n") < least, "too few clean stars after quality gate")
    out = stars.select("image").distinct().join(shift, "image", "left").join(tail, "image", "left").withColumn("reason", reason)
    seen = F.coalesce("isolated", F.lit(0)) >= least
    return out.select(
        "image", F.coalesce("isolated", F.lit(0)).alias("isolated"), F.when(seen, F.col("n")).alias("n"), F.when(seen, F.col("shift")).alias("shift"), F.when(seen, F.col("shift") > 2).alias("mismatch"), "correction", "scatter", "tail", "reason"
    )


def effective_psf(stars: DataFrame, pixels: DataFrame, half: int = 8, brightest: int = 40, least: int = 10) -> DataFrame:
    """Mean of peak-normalised stamps of the brightest stars: unsaturated 5 x 5 core, peak within a pixel of the centre."""
    centre = stars.withColumns({"sx": F.round("sx"), "sy": F.round("sy")})
    j = box_join(centre, pixels, half).withColumns({"dx": F.col("dx").cast("int"), "dy": F.col("dy").cast("int")})
    core = (F.abs("dx") <= 2) & (F.abs("dy") <= 2)
    s = j.groupBy("image", "id").agg(
        F.bool_or(core & (S.saturated(F.col("dq")) | bad())).alias("_bad"),
        F.max("value").alias("peak"),
        F.max_by(F.greatest(F.abs("dx"), F.abs("dy")), F.when(~bad(), F.col("value"))).alias("_far"),
        F.count(F.lit(1)).alias("_n"),
    )
    s = s.where(~F.col("_bad") & (F.col("_far") <= 1) & (F.col("_n") == (2 * half + 1) ** 2) & (F.col("peak") > 0))
    s = s.withColumn("_r", F.row_number().over(W.partitionBy("image").orderBy(F.col("peak").desc(), "id"))).where(F.col("_r") <= brightest)
    s = s.withColumn("n_stars", F.count(F.lit(1)).over(W.partitionBy("image"))).where(F.col("n_stars") >= least)
    return j.join(s.select("image", "id", "peak", "n_stars"), ["image", "id"]).groupBy("image", "dy", "dx", "n_stars").agg(F.avg(F.col("value") / F.col("peak")).alias("psf"))


def psf_radius(psf: DataFrame, keys: Sequence[str] = ("image",)) -> DataFrame:
    """Flux-weighted rms radius; negative pixels count as none."""
    w = F.greatest(F.col("psf"), F.lit(0.0))
    return psf.groupBy(*keys).agg(F.sqrt(F.try_divide(F.sum(w * (F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))), F.sum(w))).alias("radius"))


#: Pixels along the side of a block.
BLOCK = 128


def blocks(pixels: DataFrame, keys: Sequence[str], size: int = BLOCK, halo: int = 1) -> DataFrame:
    """Pixels with the blocks (_by, _bx) that need them: their own and those whose margin of ``halo`` pixels they lie in.

    A margin of one pixel around 128 makes 1.03 rows of one.
    """
    own = lambda c: F.floor(F.col(c) / size)
    at = lambda c: F.pmod(F.col(c), F.lit(size))
    needed = lambda c: F.explode(F.array_compact(F.array(own(c), F.when(at(c) < halo, own(c) - 1), F.when(at(c) >= size - halo, own(c) + 1))))
    x = pixels.select(*keys, F.col("y").cast("long").alias("y"), F.col("x").cast("long").alias("x"), F.col("value").cast("double").alias("value"))
    return x.select("*", needed("y").alias("_by")).select("*", needed("x").alias("_bx"))


def local_maxima(pixels: DataFrame, threshold: DataFrame, keys: Sequence[str] = ("image",)) -> DataFrame:
    """Pixels over their image's threshold that no neighbour exceeds, with the 3 x 3 flux-weighted centroid.

    Equal neighbours go to the first by (y, x). One shuffle deals pixels to blocks with a margin; a block is an array of
    bounded size, whatever the image's.
    """
    k = list(keys)
    kinds = dict(pixels.dtypes)
    fields = ", ".join([*[f"`{c}` {kinds[c]}" for c in k], "y long, x long, value double, sx double, sy double"])

    def peaks(key: tuple, table: pa.Table) -> pa.Table:
        top, left = (key[len(k) + i].as_py() * BLOCK - 1 for i in (0, 1))
        v = np.full((BLOCK + 2, BLOCK + 2), np.nan)
        v[table["y"].to_numpy() - top, table["x"].to_numpy() - left] = table["value"].to_numpy()
        own, beaten = v[1:-1, 1:-1], np.isnan(v[1:-1, 1:-1])
        total, px, py = (np.zeros_like(own) for _ in range(3))
        for dy, dx in ((i, j) for i in (-1, 0, 1) for j in (-1, 0, 1)):
            near = v[1 + dy : BLOCK + 1 + dy, 1 + dx : BLOCK + 1 + dx]
            beaten = beaten | (near > own) | ((near == own) & ((dy, dx) < (0, 0)))
            there = np.nan_to_num(near)
            total, px, py = total + there, px + there * dx, py + there * dy
        y, x = np.nonzero(~beaten)
        with np.errstate(divide="ignore", invalid="ignore"):
            off = [np.where(total[y, x] == 0, np.nan, p[y, x] / total[y, x]) for p in (px, py)]
        y_, x_ = y + top + 1, x + left + 1
        columns = [pa.array([key[i].as_py()] * len(y), table.schema.field(c).type) for i, c in enumerate(k)]
        columns += [pa.array(y_), pa.array(x_), pa.array(own[y, x]), *(pa.array(c + o, from_pandas=True) for c, o in zip((x_, y_), off))]
        return pa.Table.from_arrays(columns, names=[*k, "y", "x", "value", "sx", "sy"])

    found = blocks(pixels.where(~bad()), k).groupBy(*k, "_by", "_bx").applyInArrow(peaks, fields)
    return found.join(threshold.select(*k, "threshold"), k).where(F.col("value") > F.col("threshold")).drop("threshold")


def band_limits(pixels: DataFrame, keys: Sequence[str], low: float = 0.01, high: float = 0.995, bins: int = 4096) -> DataFrame:
    """Exact percentiles over finite pixels of each image in two passes.

    The first pass counts pixels in equal bins of the range; the second takes only the values of the bins that the
    ranks fall into, so no image's values are ever gathered whole.
    """
    k = list(keys)
    p = pixels.where(~bad()).select(*k, "value")
    box = p.groupBy(*k).agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"), F.count(F.lit(1)).alias("_n"))
    cell = F.when(F.col("_hi") > F.col("_lo"), F.least(F.floor((F.col("value") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * bins), F.lit(bins - 1))).otherwise(0)
    x = p.join(box, k).withColumn("_b", cell)
    h = x.groupBy(*k, "_n", "_b").agg(F.count(F.lit(1)).alias("_c"))
    h = h.withColumn("_to", F.sum("_c").over(W.partitionBy(*k).orderBy("_b"))).withColumn("_from", F.col("_to") - F.col("_c"))
    ranks = F.explode(F.array(*[F.struct(F.lit(n).alias("which"), ((F.col("_n") - 1) * q).alias("at")) for n, q in (("low", low), ("high", high))]))
    at = box.select(*k, ranks.alias("_q")).select(*k, "_q.which", "_q.at")
    want = at.select(*k, "which", "at", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))).alias("rank"))
    hit = want.join(h, k).where((F.col("rank") >= F.col("_from")) & (F.col("rank") < F.col("_to")))
    values = x.join(hit.select(*k, "_b", "_from").distinct(), [*k, "_b"]).withColumn("rank", F.col("_from") + F.row_number().over(W.partitionBy(*k, "_b").orderBy("value")) - 1)
    v = want.join(values.select(*k, "rank", "value"), [*k, "rank"])
    q = v.groupBy(*k, "which", "at").agg(F.min_by("value", "rank").alias("a"), F.max_by("value", "rank").alias("b"))
    q = q.withColumn("v", F.col("a") + (F.col("b") - F.col("a")) * (F.col("at") - F.floor("at")))
    return q.groupBy(*k).agg(F.max(F.when(F.col("which") == "low", F.col("v"))).alias("low"), F.max(F.when(F.col("which") == "high", F.col("v"))).alias("high"))


def two_colour(blue: DataFrame, red: DataFrame, limits: tuple[float, float, float, float], keys: Sequence[str] = ()) -> DataFrame:
    """RGB bytes of two bands: green is the mean of the stretched bands before missing pixels become 0; alpha is 0 only
    where both bands miss. With ``keys``, columns of both, many pairs of images go in one job."""
    at = [*keys, "y", "x"]
    b = blue.select(*keys, "y", "x", S.asinh_stretch(F.when(~bad(), F.col("value")), F.lit(limits[0]), F.lit(limits[1])).alias("_b"), bad().alias("_nb"))
    r = red.select(*keys, "y", "x", S.asinh_stretch(F.when(~bad(), F.col("value")), F.lit(limits[2]), F.lit(limits[3])).alias("_r"), bad().alias("_nr"))
    j = b.join(r, at, "full_outer")
    none = lambda c: F.coalesce(F.col(c), F.lit(True))
    blank = lambda c, n: F.when(none(n), F.lit(None)).otherwise(c)
    B, R = blank(F.col("_b"), "_nb"), blank(F.col("_r"), "_nr")
    to_byte = lambda c: F.floor(F.coalesce(c, F.lit(0.0)) * 255).cast("int")
    return j.select(*at, to_byte(R).alias("r"), to_byte((R + B) / 2).alias("g"), to_byte(B).alias("b"), F.when(none("_nb") & none("_nr"), 0).otherwise(255).alias("a"))


def resample(source: DataFrame, grid: DataFrame, to_source: tuple[Column, Column], keys: Sequence[str] = ()) -> DataFrame:
    """The source on another image's grid by bilinear weights; null where one of the four neighbours misses.

    grid has columns y and x; ``to_source`` gives the source position (x, y) of a grid pixel. With ``keys``, columns of
    both, many images go in one job, each grid pixel onto the source of its own keys.
    """
    g = grid.select(*keys, "y", "x", to_source[0].alias("u"), to_source[1].alias("v")).withColumns({"_u": F.floor("u"), "_v": F.floor("v")})
    four = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)]))
    n = g.select("*", four.alias("o")).select(*keys, "y", "x", "u", "v", (F.col("_u") + F.col("o.i")).alias("sx"), (F.col("_v") + F.col("o.j")).alias("sy"))
    s = source.where(~bad()).select(*keys, F.col("x").cast("long").alias("sx"), F.col("y").cast("long").alias("sy"), "value")
    w = (1 - F.abs(F.col("u") - F.col("sx"))) * (1 - F.abs(F.col("v") - F.col("sy")))
    j = n.join(s, [*keys, "sx", "sy"], "left").withColumn("w", w)
    need = F.count_if(F.col("w") > 0) == F.count_if((F.col("w") > 0) & F.col("value").isNotNull())
    return j.groupBy(*keys, "y", "x").agg(F.when(need, F.sum(F.when(F.col("w") > 0, F.col("w") * F.col("value")))).alias("value"))


def covered_fraction(resampled: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return resampled.groupBy(*keys).agg(F.avg(F.col("value").isNotNull().cast("double")).alias("covered"))


def finite_fraction(pixels: DataFrame, keys: Sequence[str]) -> DataFrame:
    return pixels.groupBy(*keys).agg(F.avg((~bad()).cast("double")).alias("finite"), F.avg(S.saturated(F.col("dq")).cast("double")).alias("saturated"), F.count(F.lit(1)).alias("n"))


def worst_frame(fractions: DataFrame, keys: Sequence[str], frame: str) -> DataFrame:
    return fractions.groupBy(*keys).agg(median("saturated").alias("median"), F.max("saturated").alias("most"), F.max_by(frame, F.struct(F.col("saturated"), -F.col(frame))).alias("worst"))


def plateau_peak(stars: DataFrame, pixels: DataFrame, half: int = 4) -> DataFrame:
    """Peak in the box around a star; three or more equal maxima give their centroid, a maximum on the box's border none."""
    j = box_join(stars.withColumns({"_sx": F.col("sx"), "_sy": F.col("sy"), "sx": F.round("sx"), "sy": F.round("sy")}), pixels, half).where(~bad())
    top = F.max("value").over(W.partitionBy("image", "id"))
    m = j.withColumn("_top", top).where(F.col("value") == F.col("_top"))
    first = F.min_by(F.struct("x", "y"), F.struct("y", "x"))
    x = m.groupBy("image", "id", "_sx", "_sy").agg(F.count(F.lit(1)).alias("n"), F.avg("x").alias("ax"), F.avg("y").alias("ay"), first.alias("_f"), F.bool_or((F.abs("dx") == half) | (F.abs("dy") == half)).alias("border"), F.bool_or(S.saturated(F.col("dq"))).alias("saturated"))
    many = F.col("n") >= 3
    px, py = F.when(many, F.col("ax")).otherwise(F.col("_f.x")), F.when(many, F.col("ay")).otherwise(F.col("_f.y"))
    return x.select("image", "id", "_sx", "_sy", "n", F.when(~F.col("border"), px).alias("px"), F.when(~F.col("border"), py).alias("py"), "saturated")


def star_positions(stars: DataFrame, pixels: DataFrame, mag: str = "mag", most: int = 200, least: int = 20) -> DataFrame:
    """Whether the brightest stars are where the image has its peaks: median distance at most 2 px, half of them matched.

    Saturated peaks are left out if at least ``least`` others remain.
    """
    s = stars.withColumn("_r", F.row_number().over(W.partitionBy("image").orderBy(mag, "id"))).where(F.col("_r") <= most).drop("_r")
    p = plateau_peak(s, pixels).withColumn("far", F.hypot(F.col("px") - F.col("_sx"), F.col("py") - F.col("_sy")))
    p = p.withColumn("_clear", F.count_if(~F.col("saturated")).over(W.partitionBy("image"))).where((F.col("_clear") < least) | ~F.col("saturated"))
    x = p.groupBy("image").agg(F.count(F.lit(1)).alias("used"), median("far").alias("distance"), F.avg(F.col("px").isNotNull().cast("double")).alias("matched"))
    return x.withColumn("pass", F.coalesce((F.col("used") >= least) & (F.col("distance") <= 2) & (F.col("matched") >= 0.5), F.lit(False)))


def common_window(df: DataFrame, centre_of: DataFrame, keys: Sequence[str], half: float) -> DataFrame:
    """Rows within ``half`` degrees of the median position of ``centre_of``, along each axis."""
    k = list(keys)
    c = centre_of.groupBy(*k).agg(median("ra").alias("_r"), median("dec").alias("_d"))
    return df.join(c, k).where((F.abs(F.col("ra") - F.col("_r")) <= half) & (F.abs(F.col("dec") - F.col("_d")) <= half)).drop("_r", "_d")


def clipped_window(centre: Column, half: int, size: int) -> tuple[Column, Column]:
    """[low, high] of a window around a centre, moved inside the frame 0..size-1."""
    low = F.greatest(F.lit(0), F.least(F.floor(centre - half), F.lit(size - 1 - 2 * half)))
    return low, F.least(low + 2 * half, F.lit(size - 1))


def covering_tile(positions: DataFrame, wcs: DataFrame, shape: tuple[int, int]) -> DataFrame:
    """The image on whose pixels most positions of a group fall, the first by name on a tie. Images are few rows."""
    w = {c: F.col(c) for c in ("crval1", "crval2", "crpix1", "crpix2", "cd11", "cd12", "cd21", "cd22")}
    j = positions.join(wcs, "tile")
    x, y = S.tan_to_pixel(F.col("ra"), F.col("dec"), w)
    inside = (x >= 0) & (x < shape[1]) & (y >= 0) & (y < shape[0])
    n = j.groupBy("tile", "field", "image").agg(F.count_if(inside).alias("n"))
    return n.groupBy("tile", "field").agg(F.min_by("image", F.struct(-F.col("n"), F.col("image"))).alias("image"), F.max("n").alias("n"))


def cells_of_band(band: Column, width: float) -> Column:
    """Cells that a declination band of ``width`` degrees is cut into: about as wide as high where the band is longest."""
    low = F.least(F.abs(band * width), F.abs((band + 1) * width))
    return F.greatest(F.lit(1), F.floor(F.cos(F.radians(F.least(low, F.lit(90.0)))) * (360.0 / width))).cast("long")


def sky_cell(df: DataFrame, width: float) -> DataFrame:
    """Positions (ra, dec in degrees) with their declination band (_band) and cell in it (_cell)."""
    band = F.floor(F.col("dec") / width).cast("long")
    n = cells_of_band(F.col("_band"), width)
    return df.withColumn("_band", band).withColumn("_cell", F.least(F.floor(F.pmod(F.col("ra"), F.lit(360.0)) / 360 * n), n - 1).cast("long"))


def footprint_cells(images: DataFrame, width: float) -> DataFrame:
    """images (solution, nx, ny) with each sky cell that they may touch, one row a cell.

    An image lies in the cap about its centre that reaches its farthest corner; the cells are those of the cap's box, which
    goes all around where the cap holds a pole. They are those of no other image, so images that lie far apart share none.
    """
    from . import match

    w = {c: F.col(c) for c in ("crval1", "crval2", "crpix1", "crpix2", "cd11", "cd12", "cd21", "cd22")}
    ra0, dec0 = S.pixel_to_tan((F.col("nx") - 1) / 2, (F.col("ny") - 1) / 2, w)
    corner = lambda i, j: S.pixel_to_tan((F.col("nx") * i - 0.5), (F.col("ny") * j - 0.5), w)
    reach = F.greatest(*[match.separation(F.col("_ra0"), F.col("_dec0"), *corner(i, j)) for i in (0, 1) for j in (0, 1)]) / 3600 * (1 + 1e-6) + 1e-9
    x = images.withColumns({"_ra0": ra0, "_dec0": dec0}).withColumn("_reach", reach)
    bands = F.sequence(F.floor(F.greatest(F.lit(-90.0), F.col("_dec0") - F.col("_reach")) / width).cast("long"), F.floor(F.least(F.lit(90.0), F.col("_dec0") + F.col("_reach")) / width).cast("long"))
    x = x.withColumn("_band", F.explode(bands)).withColumn("_n", cells_of_band(F.col("_band"), width))
    around = F.abs("_dec0") + F.col("_reach") >= 90
    side = F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.radians("_reach")) / F.cos(F.radians("_dec0")))))
    edge = lambda s: F.floor((F.col("_ra0") + side * s) / 360 * F.col("_n")).cast("long")
    cells = F.when(around | (edge(1) - edge(-1) >= F.col("_n")), F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)).otherwise(F.transform(F.sequence(edge(-1), edge(1)), lambda c: F.pmod(c, F.col("_n"))))
    return x.select(*images.columns, "_band", F.explode(F.array_distinct(cells)).alias("_cell"))


def covering_image(positions: DataFrame, images: DataFrame, keys: Sequence[str], width: float = 0.02) -> DataFrame:
    """For each group of positions the image (image, solution, nx, ny) on whose pixels most of them fall, the first by
    name on a tie. Positions meet the images above their sky cell only; images may be many and lie anywhere."""
    k = list(keys)
    j = sky_cell(positions.select(*k, "ra", "dec"), width).join(footprint_cells(images, width), ["_band", "_cell"])
    w = {c: F.col(c) for c in ("crval1", "crval2", "crpix1", "crpix2", "cd11", "cd12", "cd21", "cd22")}
    x, y = S.tan_to_pixel(F.col("ra"), F.col("dec"), w)
    inside = (x >= 0) & (x < F.col("nx")) & (y >= 0) & (y < F.col("ny"))
    n = j.where(inside).groupBy(*k, "image").agg(F.count(F.lit(1)).alias("n"))
    return n.groupBy(*k).agg(F.min_by("image", F.struct(-F.col("n"), F.col("image"))).alias("image"), F.max("n").alias("n"))


def alpha_mismatch(rgb: DataFrame, pixels: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Share of pixels whose transparency disagrees with the image's missing pixels, of each image that ``keys`` name."""
    at = [*keys, "y", "x"]
    j = rgb.select(*at, (F.col("a") == 0).alias("clear")).join(pixels.select(*at, bad().alias("_bad")), at, "full_outer")
    return j.groupBy(*keys).agg(F.avg((F.coalesce("clear", F.lit(True)) != F.coalesce("_bad", F.lit(True))).cast("double")).alias("mismatch"), F.count(F.lit(1)).alias("n"))


def wcs_round_trip(images: DataFrame, rebuilt: DataFrame, keys: Sequence[str] = ("image",), limit: float = 0.1) -> DataFrame:
    """Greatest distance (arcseconds) between the sky positions that two solutions of an image give to five of its pixels.

    images: keys, nx, ny and the solution (crval1 to cd22); rebuilt: keys and the solution read back. The pixels, from 0 on,
    are the reference pixel, moved inside the image, and the corners. Images are few rows.
    """
    from . import match

    k, names = list(keys), ("crval1", "crval2", "crpix1", "crpix2", "cd11", "cd12", "cd21", "cd22")
    j = images.select(*k, "nx", "ny", *names).join(rebuilt.select(*k, *[F.col(c).alias(f"{c}_b") for c in names]), k)
    inside = lambda c, n: F.greatest(F.lit(0.0), F.least(F.col(c).cast("double"), F.col(n) - 1.0))
    point = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    right, top, zero = F.col("nx") - 1, F.col("ny") - 1, F.lit(0)
    five = F.array(point(inside("crpix1", "nx"), inside("crpix2", "ny")), point(zero, zero), point(right, zero), point(zero, top), point(right, top))
    j = j.withColumn("_p", F.explode(five))
    x, y = F.col("_p.x"), F.col("_p.y")
    a, b = (S.pixel_to_tan(x, y, {c: F.col(c + tail) for c in names}) for tail in ("", "_b"))
    far = F.max(match.separation(*a, *b))
    return j.groupBy(*k).agg(far.alias("offset")).withColumn("passed", F.col("offset") < limit)


def isolated_sources(stars: DataFrame, pixels_apart: float) -> DataFrame:
    """Stars without another at most so many pixels away, through tiles as wide as the distance."""
    t = lambda c: F.floor(c / pixels_apart).cast("long")
    near = F.explode(F.array(*[F.struct((t(F.col("sx")) + i).alias("x"), (t(F.col("sy")) + j).alias("y")) for i in (-1, 0, 1) for j in (-1, 0, 1)]))
    a = stars.select("image", "id", "sx", "sy", t(F.col("sx")).alias("_x"), t(F.col("sy")).alias("_y"))
    b = stars.select("image", F.col("id").alias("o"), F.col("sx").alias("ox"), F.col("sy").alias("oy"), near.alias("_c")).select("image", "o", "ox", "oy", F.col("_c.x").alias("_x"), F.col("_c.y").alias("_y"))
    j = a.join(b, ["image", "_x", "_y"]).where((F.col("id") != F.col("o")) & (F.hypot(F.col("sx") - F.col("ox"), F.col("sy") - F.col("oy")) <= pixels_apart))
    return stars.join(j.select("image", "id").distinct(), ["image", "id"], "left_anti")
