"""Operators on documents as values: walks over JSON trees, argument rules, expected inventories, shortlists."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed values.
MAX_DIMENSION = 8192
PALETTES = ("none", "median-cut", "oklab")


def _walked(text: str | None) -> Iterator[tuple[str, object]]:
    """(location, value) of every value of a JSON text, each before those within it, in order; nothing of text that is no JSON."""
    try:
        todo = [("$", json.loads(text))] if text is not None else []
    except ValueError:
        return
    while todo:
        where, value = todo.pop()
        yield where, value
        if isinstance(value, dict):
            todo += [(f"{where}.{k}", v) for k, v in reversed(value.items())]
        elif isinstance(value, list):
            todo += [(f"{where}[{i}]", v) for i, v in reversed(list(enumerate(value)))]


def _each(documents: DataFrame, key: str, text: str, pick, name: str) -> DataFrame:
    kind = documents.schema[key].dataType.simpleString()

    def run(frames):
        for pdf in frames:
            rows = [(k, n, *x) for k, t in zip(pdf[key], pdf[text], strict=True) for n, x in enumerate(pick(t))]
            yield pd.DataFrame(rows, columns=[key, "number", "location", name])

    return documents.select(key, text).mapInPandas(run, f"`{key}` {kind}, number int, location string, `{name}` string")


def https_strings(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(key, number, location, url): the strings of a JSON text that start with https://, depth first, numbered from 0."""
    return _each(documents, key, text, lambda t: ((w, v) for w, v in _walked(t) if isinstance(v, str) and v.startswith("https://")), "url")


def value_problems(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(key, number, location, code): numbers of a JSON text that are not finite, which readers take though JSON has none."""
    return _each(documents, key, text, lambda t: ((w, "VALUE_NOT_FINITE") for w, v in _walked(t) if isinstance(v, float) and not math.isfinite(v)), "code")


def offset_time(text: Column) -> Column:
    """The time that a text in ISO 8601 names, if it names an offset too; null otherwise."""
    fits = text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}([.,]\d{1,6})?)?(Z|[+-]\d{2}:\d{2}(:\d{2})?)$")
    return F.when(fits, F.replace(text, F.lit(","), F.lit(".")).try_cast("timestamp"))


def is_integer(value: Column) -> Column:
    """Whether a variant is a whole number; true and false are none."""
    return F.coalesce(F.schema_of_variant(value) == "BIGINT", F.lit(False))


def processing_problems(requests: DataFrame, key: str) -> DataFrame:
    """(key, code) of requests (key, frame_width, frame_height, background_tolerance, alpha_threshold, contrast, palette, colors, dither) that break a rule."""
    within = lambda c, low, high: F.coalesce(F.col(c).between(low, high), F.lit(False))
    none, dither = F.col("palette") == "none", F.coalesce("dither", F.lit(False))
    rules = {
        "FRAME_WIDTH_RANGE": ~within("frame_width", 1, MAX_DIMENSION),
        "FRAME_HEIGHT_RANGE": ~within("frame_height", 1, MAX_DIMENSION),
        "BACKGROUND_TOLERANCE_RANGE": ~within("background_tolerance", 0, 255),
        "ALPHA_THRESHOLD_RANGE": ~within("alpha_threshold", 0, 255),
        "CONTRAST_RANGE": ~F.coalesce((F.col("contrast") > 0) & (F.col("contrast") <= 10) & ~F.isnan("contrast"), F.lit(False)),
        "PALETTE_UNKNOWN": ~F.coalesce(F.col("palette").isin(*PALETTES), F.lit(False)),
        "PALETTE_NOT_ASKED_FOR": none & (F.col("colors").isNotNull() | dither),
        "COLORS_REQUIRED": ~none & F.col("colors").isNull(),
        "COLORS_RANGE": ~none & F.col("colors").isNotNull() & ~F.col("colors").between(2, 256),
        "DITHER_NOT_WITH_OKLAB": (F.col("palette") == "oklab") & dither,
    }
    return requests.select(key, F.explode(F.array_compact(F.array(*(F.when(rule, F.lit(code)) for code, rule in rules.items())))).alias("code"))


def expected_inventory(subjects: DataFrame, key: str, count: str, fixed: list[str], each: list[str]) -> DataFrame:
    """(key, item): the fixed items, and each template with {} replaced by every number below the subject's count."""
    of_all = subjects.select(key, F.explode(F.array(*map(F.lit, fixed))).alias("item"))
    numbered = subjects.filter(F.col(count) > 0).select(key, F.explode(F.expr(f"sequence(0, cast(`{count}` as int) - 1)")).alias("_i"))
    items = F.array(*(F.replace(F.lit(t), F.lit("{}"), F.col("_i").cast("string")) for t in each))
    return of_all.union(numbered.select(key, F.explode(items).alias("item")))


def shortlist(candidates: DataFrame, by: str, score: Column, tie: str, most: int) -> DataFrame:
    """candidates with place (primary, or fallback) and rank: the best of each group, by score and then by name."""
    rank = F.row_number().over(Window.partitionBy(by).orderBy(score.desc_nulls_last(), tie))
    return candidates.withColumn("rank", rank).filter(F.col("rank") <= most).withColumn("place", F.when(F.col("rank") == 1, "primary").otherwise("fallback"))


def all_inputs(*tables: DataFrame) -> DataFrame:
    """(path): every path that any of the tables (path) names, once."""
    out = tables[0].select("path")
    for t in tables[1:]:
        out = out.union(t.select("path"))
    return out.distinct()


def summary(verdicts: DataFrame, verdict: str = "verdict") -> tuple[str, int]:
    """(one line of JSON, exit code) of a run: 0 if all pass, 2 if any fails, 3 if there is nothing to tell."""
    r = verdicts.agg(F.count(F.lit(1)).alias("checked"), F.count_if(~F.col(verdict).eqNullSafe("pass")).alias("failed")).first()
    code = 3 if not r["checked"] else 2 if r["failed"] else 0
    return json.dumps({"checked": r["checked"], "failed": r["failed"], "verdict": {0: "pass", 2: "fail", 3: "nothing"}[code]}, sort_keys=True), code
