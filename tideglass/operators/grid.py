"""Irregular readings onto a regular grid (problem 1).

Readings are first aggregated by source and period, on the map side too, so that a hot source costs no more than one row for
each of its periods. Harmonic regression with trend is fitted per source by its normal equations, whose sums are an ordinary
grouped aggregate; only the small systems, one row per source, are solved in numpy. Missing periods get the prediction plus
the residual interpolated between the observed periods on either side.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import pi

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideglass.operators.ticks import DAY_MS, PERIOD_MS, div, period_start

#: The trend counts years from here, so that the systems stay well conditioned.
TREND_ORIGIN_MS = 1_577_836_800_000
YEAR_MS = 365.25 * DAY_MS


def _features(at: Column, harmonics: int) -> list[Column]:
    angle = (F.pmod(at, F.lit(DAY_MS).cast("bigint")) / F.lit(float(DAY_MS))) * F.lit(2 * pi)
    waves = [f(angle * F.lit(float(k))) for k in range(1, harmonics + 1) for f in (F.sin, F.cos)]
    return [F.lit(1.0), (at - F.lit(TREND_ORIGIN_MS)) / F.lit(YEAR_MS), *waves]


def _solve(p: int):
    """Least squares from rows of sums. Systems of less than full rank (few periods) get the solution of least norm."""
    at = {(i, j): k for k, (i, j) in enumerate((i, j) for i in range(p) for j in range(i, p))}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            if part.empty:
                continue
            sums = np.stack(part["gram"].to_numpy())
            gram = np.empty((len(part), p, p))
            for (i, j), k in at.items():
                gram[:, i, j] = gram[:, j, i] = sums[:, k]
            right = np.stack(part["moment"].to_numpy())
            size = np.sqrt(np.maximum(np.einsum("nii->ni", gram), 1e-300))  # unit diagonal before the inverse
            inverse = np.linalg.pinv(gram / (size[:, :, None] * size[:, None, :]), rcond=1e-10, hermitian=True)
            fit = np.einsum("nij,nj->ni", inverse, right / size) / size
            yield pd.DataFrame({"source": part["source"].to_numpy(), "coefficients": list(fit)})

    return run


def fit_harmonics(readings: DataFrame, harmonics: int = 3) -> DataFrame:
    """source, coefficients of the regression of `value` on trend and daily harmonics at `period_start`, by `source`."""
    columns = _features(F.col("period_start"), harmonics)
    p = len(columns)
    names = [f"f{i}" for i in range(p)]
    wide = readings.select("source", "value", *(c.alias(n) for c, n in zip(columns, names, strict=True)))
    gram = [F.sum(F.col(names[i]) * F.col(names[j])) for i in range(p) for j in range(i, p)]
    moment = [F.sum(F.col(n) * F.col("value")) for n in names]
    sums = wide.groupBy("source").agg(F.array(*gram).alias("gram"), F.array(*moment).alias("moment"))
    kind = readings.schema["source"].dataType.simpleString()
    return sums.mapInPandas(_solve(p), f"source {kind}, coefficients array<double>")


def regular_grid(events: DataFrame, source: str, at: str, value: str, period_ms: int = PERIOD_MS, harmonics: int = 3) -> DataFrame:
    """One row for every period of each source and UTC day between that day's first and last period with a reading:
    source, day_utc, period_start, n_readings, is_missing, observed (mean of the period's readings), filled.

    A reading is a row whose source, `at` and `value` are neither null nor NaN. `filled` is `observed` where there is one, else
    the regression's prediction plus the residual interpolated between the nearest observed periods of the day. Days with one
    reading come out as that row; sources without readings don't come out. Repeated rows weigh as many times as they occur."""
    reading = F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")) & F.col(at).isNotNull() & F.col(source).isNotNull()
    readings = (
        events.where(reading)
        .groupBy(F.col(source).alias("source"), period_start(F.col(at), period_ms).alias("period_start"))
        .agg(F.count(F.lit(1)).alias("n_readings"), F.avg(F.col(value).cast("double")).alias("value"))
    )
    # At most one row per period of the day: neither the window nor the sequence can outgrow the calendar.
    day = Window.partitionBy("source", "day").orderBy("period_start")
    steps = (
        readings.withColumn("day", div(F.col("period_start"), DAY_MS))
        .withColumn("next_start", F.lead("period_start").over(day))
        .withColumn("next_value", F.lead("value").over(day))
        .join(fit_harmonics(readings, harmonics), "source", "left")
    )
    at_, left, right = F.col("slot"), F.col("period_start"), F.col("next_start")
    last = F.coalesce(right - F.lit(period_ms), left)
    grid = steps.withColumn("slot", F.explode(F.sequence(left, last, F.lit(period_ms).cast("bigint"))))

    def predict(when: Column) -> Column:
        terms = [c * F.col("coefficients")[i] for i, c in enumerate(_features(when, harmonics))]
        return sum(terms[1:], terms[0])

    missing = at_ > left
    share = (at_ - left) / (right - left)
    bridge = (F.col("value") - predict(left)) * (F.lit(1.0) - share) + (F.col("next_value") - predict(right)) * share
    return grid.select(
        F.col("source").alias(source),
        F.date_format(F.date_from_unix_date(F.col("day").cast("int")), "yyyy-MM-dd").alias("day_utc"),
        at_.alias("period_start"),
        F.when(missing, F.lit(0)).otherwise(F.col("n_readings")).cast("bigint").alias("n_readings"),
        missing.alias("is_missing"),
        F.when(~missing, F.col("value")).alias("observed"),
        F.when(missing, predict(at_) + bridge).otherwise(F.col("value")).alias("filled"),
    )
