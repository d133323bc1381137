"""Column functions on colours, vectors and rounding, and the Python functions that Spark has no match for."""

from __future__ import annotations

import json
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The published matrices between linear sRGB and OKLab.
LMS = ((0.4122214708, 0.5363325363, 0.0514459929), (0.2119034982, 0.6806995451, 0.1073969566), (0.0883024619, 0.2817188376, 0.6299787005))
LAB = ((0.2104542553, 0.7936177850, -0.0040720468), (1.9779984951, -2.4285922050, 0.4505937099), (0.0259040371, 0.7827717662, -0.8086757660))
LMS_OF_LAB = ((1.0, 0.3963377774, 0.2158037573), (1.0, -0.1055613458, -0.0638541728), (1.0, -0.0894841775, -1.2914855480))
RGB_OF_LMS = ((4.0767416621, -3.3077115913, 0.2309699292), (-1.2684380046, 2.6097574011, -0.3413193965), (-0.0041960863, -0.7034186147, 1.7076147010))


def _times(matrix, x: list[Column]) -> list[Column]:
    return [F.lit(a) * x[0] + F.lit(b) * x[1] + F.lit(c) * x[2] for a, b, c in matrix]


def srgb_to_linear(v: Column) -> Column:
    return F.when(v <= 0.04045, v / 12.92).otherwise(F.pow((v + 0.055) / 1.055, F.lit(2.4)))


def linear_to_srgb(v: Column) -> Column:
    return F.when(v <= 0.0031308, v * 12.92).otherwise(1.055 * F.pow(F.greatest(v, F.lit(0.0)), F.lit(1 / 2.4)) - 0.055)


def oklab(r: Column, g: Column, b: Column) -> list[Column]:
    """Lightness and the two opponent axes of an sRGB colour with channels from 0 to 1."""
    return _times(LAB, [F.cbrt(x) for x in _times(LMS, [srgb_to_linear(c) for c in (r, g, b)])])


def rgb_of_oklab(light: Column, a: Column, b: Column) -> list[Column]:
    linear = _times(RGB_OF_LMS, [x * x * x for x in _times(LMS_OF_LAB, [light, a, b])])
    clip = lambda x: F.least(F.greatest(x, F.lit(0.0)), F.lit(1.0))
    return [clip(linear_to_srgb(clip(x))) for x in linear]


def length(vector: Column) -> Column:
    """The Euclidean length of an array of numbers."""
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x * x))


def max_abs_delta(a: Column, b: Column) -> Column:
    """The largest difference of two vectors; 0 for empty ones, null if their lengths differ."""
    delta = F.array_max(F.transform(F.arrays_zip(a.alias("a"), b.alias("b")), lambda p: F.abs(p["a"] - p["b"])))
    return F.when(F.size(a) == F.size(b), F.coalesce(delta, F.lit(0.0)))


def determinant3(m: Column) -> Column:
    """The determinant of a 3 x 3 matrix given as nine numbers by row."""
    e = lambda i: F.element_at(m, i)
    return e(1) * (e(5) * e(9) - e(6) * e(8)) - e(2) * (e(4) * e(9) - e(6) * e(7)) + e(3) * (e(4) * e(8) - e(5) * e(7))


def max_scale_deviation(scale: Column) -> Column:
    return F.array_max(F.transform(scale, lambda s: F.abs(s - 1)))


def anchored(outer: Column, inner: Column, where: str) -> Column:
    """The offset of inner in outer: at the start, in the middle (rounded down) or at the end."""
    return {"start": F.lit(0), "middle": F.floor((outer - inner) / 2), "end": outer - inner}[where]


@F.pandas_udf(T.StringType())
def casefold(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else x.casefold())


@F.pandas_udf(T.StringType())
def nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


@F.pandas_udf(T.StringType())
def nfd(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFD", x))


@F.pandas_udf(T.DoubleType())
def round_even(x: pd.Series, digits: pd.Series) -> pd.Series:
    """Rounds the exact binary value, ties to even, as no built-in does."""
    return pd.Series([None if pd.isna(v) else round(float(v), int(d)) for v, d in zip(x, digits, strict=True)], dtype="float64")


@F.pandas_udf(T.StringType())
def canonical_json(s: pd.Series) -> pd.Series:
    """JSON text with sorted keys and no spaces; null for text that is not JSON or holds what JSON has no value for."""

    def one(x):
        try:
            return json.dumps(json.loads(x), sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)
        except (TypeError, ValueError):
            return None

    return s.map(one)
