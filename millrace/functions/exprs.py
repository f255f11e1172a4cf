"""Column expressions shared by the operators.  All run inside the JVM; no UDFs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.constants import EARTH_RADIUS_M


def hash63(value: Column) -> Column:
    """Non-negative 60-bit integer fingerprint of a string: the first 15 hex digits of its MD5."""
    return F.conv(F.substring(F.md5(value.cast("string")), 1, 15), 16, 10).cast("bigint")


def hash_bucket(value: Column, n: int) -> Column:
    """Stable bucket 0 .. n-1 of a value."""
    return (hash63(value) % F.lit(n)).cast("int")


def round_half_up(value: Column, digits: int) -> Column:
    """Round a double half up with plain arithmetic, so other engines can repeat it exactly."""
    scale = float(10**digits)
    return F.floor(value * F.lit(scale) + F.lit(0.5)).cast("double") / F.lit(scale)


def plain_number(value: Column, digits: int) -> Column:
    """A rounded number as text without exponent or trailing zeros."""
    text = round_half_up(value, digits).cast(f"decimal(38,{digits})").cast("string")
    return F.regexp_replace(text, r"\.?0+$", "") if digits else text


def strip(value: Column) -> Column:
    """Remove leading and trailing white space, line ends included."""
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def normal_tail(z: Column) -> Column:
    """P(Z > z) for z >= 0 (Abramowitz and Stegun 7.1.26, absolute error below 1.5e-7)."""
    x = z / F.sqrt(F.lit(2.0))
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(0.3275911) * x)
    poly = F.lit(1.061405429)
    for coefficient in (-1.453152027, 1.421413741, -0.284496736, 0.254829592):
        poly = poly * t + F.lit(coefficient)
    return F.lit(0.5) * poly * t * F.exp(-x * x)


def normal_cdf(x: Column, mu: Column, sigma: Column) -> Column:
    z = (x - mu) / sigma
    tail = normal_tail(F.abs(z))
    return F.when(z >= 0, F.lit(1.0) - tail).otherwise(tail)


def chi2_sf(x: Column, dof: Column) -> Column:
    """P(X > x) of the chi-square distribution for whole degrees of freedom.

    Closed form: exp(-x/2) times a finite sum; odd degrees add the normal tail.
    """
    half = x / F.lit(2.0)
    odd = F.pmod(dof, F.lit(2)) == 1
    terms = F.floor(dof / F.lit(2)).cast("int")
    # odd: half^(i-1/2) / gamma(i+1/2), i = 1..terms;  even: half^i / i!, i = 0..terms-1
    first = F.when(odd, F.exp(-half) * F.sqrt(half) / F.lit(0.886226925452758)).otherwise(F.exp(-half))
    shift = F.when(odd, F.lit(0.5)).otherwise(F.lit(0.0))
    steps = F.when(terms >= 2, F.sequence(F.lit(1), terms - 1)).otherwise(F.array().cast("array<int>"))
    start = F.struct(first.alias("term"), first.alias("total"))

    def add_term(acc: Column, i: Column) -> Column:
        term = acc["term"] * half / (i.cast("double") + shift)
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    total = F.when(terms >= 1, F.aggregate(steps, start, add_term, lambda acc: acc["total"])).otherwise(F.lit(0.0))
    return F.when(odd, F.lit(2.0) * normal_tail(F.sqrt(x)) + total).otherwise(total)


def great_circle_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Distance in metres between two points given in degrees (haversine)."""
    dlat = F.radians(lat2 - lat1) / 2
    dlon = F.radians(lon2 - lon1) / 2
    h = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine similarity of two array<double> columns."""

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)

    # A vector of zeros is at distance 1 from all others.
    near = F.coalesce(F.try_divide(dot(a, b), F.sqrt(dot(a, a) * dot(b, b))), F.lit(0.0))
    return F.when(a.isNotNull() & b.isNotNull(), F.lit(1.0) - near)
