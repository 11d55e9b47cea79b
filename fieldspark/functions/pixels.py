"""Column expressions on pixels and scenes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Crop adjustments of leaf area, as coefficients of x**2, x and 1.
ADJUSTMENTS = {"wheat": (0.0482, 0.9161, 0.0026), "maize": (-0.078, 1.4, -0.18)}
#: Fixed value: reflectances and cosines are stored as integers of this unit.
BAND_SCALE = 1e-4


def missing_if_nan(c: Column) -> Column:
    """NaN becomes NULL at ingest; all operators take NULL as missing."""
    return F.nanvl(c, F.lit(None).cast("double"))


def drop_negative(c: Column) -> Column:
    """A negative leaf area is missing."""
    return F.when(c >= 0, c)


def adjust_for_crop(c: Column, crop: str | None) -> Column:
    """Crop adjustment, none without a crop; an unknown crop is an error."""
    if crop is None or crop == "none":
        return c
    if crop not in ADJUSTMENTS:
        raise ValueError(f"no leaf-area adjustment for {crop!r}; there are {sorted(ADJUSTMENTS)} and none")
    a, b, d = ADJUSTMENTS[crop]
    return a * c * c + b * c + d


def binarize(c: Column, threshold: float) -> Column:
    """P5."""
    return F.when(c >= threshold, 1).otherwise(0)


def apply_mask(value: Column, mask: Column) -> Column:
    """Outside the crop mask a value is missing."""
    return F.when(mask == 1, value)


def yield_pixel(lai: Column, factor: Column) -> Column:
    """Leaf area, not below 0, times the region's factor; missing stays missing."""
    return F.when(lai.isNotNull(), F.greatest(lai, F.lit(0.0)) * factor)


def cos_band(angle_deg: Column) -> Column:
    """Cosine in units of 1e-4, cut to a whole number."""
    return (F.cos(F.radians(angle_deg)) * 10000).cast("int")


def cos_band_hls(angle: Column, nodata: float, out_nodata: int = -9999) -> Column:
    """Angles in hundredths of a degree; nodata keeps a nodata value."""
    return F.when(angle != nodata, cos_band(angle / 100)).otherwise(F.lit(out_nodata))


def harmonize(value: Column, baseline: Column, nodata: float = 0) -> Column:
    """From processing baseline 4 on, 1000 is subtracted with 0 as floor; nodata stays. No baseline is an error."""
    known = F.coalesce(baseline, F.raise_error(F.lit("processing baseline is missing")).cast("double"))
    return F.when((known >= 4) & (value != nodata), F.greatest(value, F.lit(1000)) - 1000).otherwise(value)


def keep_s2_pixel(scl: Column, cloud: Column | None = None, snow: Column | None = None, cloud_below: float = 100, snow_below: float = 100, keep: tuple[int, ...] = (4, 5)) -> Column:
    """vegetation and bare soil, and below the cloud and snow limits where those bands are there."""
    ok = scl.isin(*keep)
    for band, limit in ((cloud, cloud_below), (snow, snow_below)):
        if band is not None:
            ok = ok & F.coalesce(band < limit, F.lit(True))
    return ok


def keep_hls_pixel(fmask: Column, bits: tuple[int, ...] = (1, 2, 3, 4)) -> Column:
    """none of these bits (cloud, next to cloud, shadow, snow) is set."""
    return fmask.bitwiseAND(sum(1 << b for b in bits)) == 0


def keep_gee_pixel(scene_cloud: Column, score: Column, snow: Column, scene_below: float, score_from: float, snow_below: float) -> Column:
    """F3."""
    return (scene_cloud < scene_below) & (score >= score_from) & (snow < snow_below)


def network(bands: list[Column], weights: dict[str, list[float]], scale: float = BAND_SCALE) -> Column:
    """Leaf area from bands by a small network, as one column expression.

    weights: input_scale, input_bias (one for each band), hidden (units x bands, flat), hidden_bias,
    out (one for each unit), out_bias, target_scale, target_bias (one each). A missing band gives NULL.
    """
    n, units = len(bands), len(weights["hidden_bias"])
    if len(weights["input_scale"]) != n or len(weights["hidden"]) != n * units:
        raise ValueError(f"the network takes {len(weights['input_scale'])} bands, not {n}")  # Q12
    z = [b * scale * s + t for b, s, t in zip(bands, weights["input_scale"], weights["input_bias"])]
    out: Column = F.lit(float(weights["out_bias"][0]))
    for u in range(units):
        total: Column = F.lit(float(weights["hidden_bias"][u]))
        for k in range(n):
            total = total + z[k] * float(weights["hidden"][u * n + k])
        out = out + F.tanh(total) * float(weights["out"][u])
    return (out - float(weights["target_bias"][0])) / float(weights["target_scale"][0])


#: order of the lists in a weight row, each after its own length; five fields stand before the first
WEIGHT_LISTS = ("input_scale", "input_bias", "hidden", "hidden_bias", "out", "out_bias", "target_scale", "target_bias")


def read_weights(fields: list[float], first: int = 5) -> dict[str, list[float]]:
    """The lists of one row of a weight table (a list's length, then its members, eight times)."""
    rest, out = list(fields[first:]), {}
    for name in WEIGHT_LISTS:
        n = int(rest[0])
        out[name], rest = rest[1 : n + 1], rest[n + 1 :]
    return out
