"""Feature selection (M3-M5).

The F-test selection runs distributed in MLlib.  The report needs one
Pearson r per candidate, which comes from a single aggregation pass
(``profile.target_correlations``); only those few dozen scalars reach the driver,
where the F(1, n-2) tail probability is evaluated.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import UnivariateFeatureSelector, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopcast.operators.clean import numeric_columns
from shopcast.operators.profile import target_correlations
from shopcast.operators.train import EXCLUDE

col = F.col


def candidates(df: DataFrame, exclude=EXCLUDE) -> list[str]:
    """M3: numeric columns that are not in the exclusion list."""
    return numeric_columns(df, exclude)


def select_features(df: DataFrame, cols: list[str], label: str = "sales",
                    alpha: float = 0.05) -> list[str]:
    """M4: F-test of regression, false-positive-rate mode at ``alpha``."""
    vec = VectorAssembler(inputCols=cols, outputCol="_fv", handleInvalid="skip").transform(df)
    sel = UnivariateFeatureSelector(featuresCol="_fv", outputCol="_sel", labelCol=label,
                                    selectionMode="fpr")
    sel.setFeatureType("continuous").setLabelType("continuous").setSelectionThreshold(alpha)
    model = sel.fit(vec.select("_fv", label))
    return [cols[i] for i in model.selectedFeatures]


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz)."""
    tiny, eps = 1e-300, 1e-15
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 10000):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < eps:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbeta = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    front = math.exp(lbeta + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _betacf(a, b, x) / a
    return 1.0 - front * _betacf(b, a, 1.0 - x) / b


def f_sf(f_stat: float, d1: float, d2: float) -> float:
    """Upper tail P(F > f) of the F(d1, d2) distribution."""
    if f_stat <= 0 or math.isnan(f_stat):
        return 1.0
    if math.isinf(f_stat):
        return 0.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f_stat))


REPORT_SCHEMA = T.StructType([
    T.StructField("feature", T.StringType()), T.StructField("abs_corr", T.DoubleType()),
    T.StructField("f_stat", T.DoubleType()), T.StructField("p_value", T.DoubleType()),
    T.StructField("selected", T.BooleanType())])


def feature_report(df: DataFrame, cols: list[str], selected: list[str],
                   label: str = "sales") -> DataFrame:
    """M5: abs r with the label (4 digits), F = (n-2) r^2 / (1 - r^2 + 1e-12),
    p (6 digits), selected flag; sorted by abs r.  A zero-variance column
    has r = 0."""
    chosen = set(selected)
    rows = []
    for row in target_correlations(df, label, cols).collect():
        rv, n = row["r"], row["n"]
        fs = (n - 2) * rv * rv / (1.0 - rv * rv + 1e-12)
        rows.append((row["feature"], round(abs(rv), 4), fs, round(f_sf(fs, 1.0, n - 2.0), 6),
                     row["feature"] in chosen))
    spark = df.sparkSession
    return spark.createDataFrame(rows, REPORT_SCHEMA).orderBy(col("abs_corr").desc(), "feature")
