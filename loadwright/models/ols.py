"""Least squares with an intercept: fit, summary table, predictions, plot data.

The fit is Spark ML's ``LinearRegression`` with the ``normal`` solver and no
penalty: executors sum the (k+1)x(k+1) normal equations in one
``treeAggregate`` pass and the driver solves the tiny system.  The same
solver yields standard errors, t and p values.

Predictions are a plain column expression ``b0 + b1*x1 + ...`` built from the
fitted coefficients, so scoring stays inside whole-stage codegen with no
vector assembly.  For one predictor the closed form is also available from
SQL aggregates (``regr_slope`` / ``regr_intercept``) in a single pass.

Rows with a NULL in the target or a predictor are left out (listwise).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadwright.functions import student

INTERCEPT_TERM = "const"


def round_sig(x: float, digits: int = 8) -> float:
    """Round to significant digits (presentation precision of reports)."""
    if x is None or x == 0 or not math.isfinite(x):
        return x
    return round(x, digits - 1 - int(math.floor(math.log10(abs(x)))))


@dataclass
class OlsFit:
    y: str
    xs: list[str]
    intercept: float
    coefficients: list[float]
    model: object  # pyspark.ml.regression.LinearRegressionModel

    def terms(self) -> list[tuple[str, float]]:
        return [(INTERCEPT_TERM, self.intercept)] + list(zip(self.xs, self.coefficients))


class SingularDesign(ValueError):
    """The normal equations have no unique solution."""


def ols_fit(df: DataFrame, y: str, xs: list[str]) -> OlsFit:
    """First chosen column on all the others (the original fitted every remaining column)."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    data = df.select(F.col(y).cast("double").alias(y), *[F.col(x).cast("double").alias(x) for x in xs])
    data = data.na.drop()
    assembled = VectorAssembler(inputCols=xs, outputCol="_features").transform(data)
    lr = LinearRegression(featuresCol="_features", labelCol=y, solver="normal", regParam=0.0,
                          elasticNetParam=0.0, fitIntercept=True, standardization=False)
    model = lr.fit(assembled)
    try:
        model.summary.coefficientStandardErrors
    except Exception as exc:  # Spark falls back to an iterative solver without standard errors
        raise SingularDesign(f"the predictors {list(xs)} are linearly dependent, constant, or too many for the rows") from exc
    return OlsFit(y, list(xs), float(model.intercept), [float(c) for c in model.coefficients], model)


def linear_predictor(intercept: float, coefficients: list[float], xs: list[str]) -> Column:
    """``b0 + b1*x1 + b2*x2 + ...`` evaluated left to right."""
    expr = F.lit(float(intercept))
    for b, x in zip(coefficients, xs):
        expr = expr + F.lit(float(b)) * F.col(x).cast("double")
    return expr


def ols_predict(fit: OlsFit, df: DataFrame, out: str = "prediction", digits: int | None = None) -> DataFrame:
    """Add the fitted value for every row; ``digits`` rounds the coefficients first."""
    b0, bs = fit.intercept, fit.coefficients
    if digits:
        b0, bs = round_sig(b0, digits), [round_sig(b, digits) for b in bs]
    return df.withColumn(out, linear_predictor(b0, bs, fit.xs))


def ols_summary_rows(fit: OlsFit) -> list[dict]:
    """Per term: coef, std_err, t_value, p_value (intercept first, named ``const``)."""
    s = fit.model.summary
    se, tv, pv = list(s.coefficientStandardErrors), list(s.tValues), list(s.pValues)
    # Spark lists the intercept last
    order = [len(fit.xs)] + list(range(len(fit.xs)))
    rows = []
    for (term, coef), i in zip(fit.terms(), order):
        rows.append({"term": term, "coef": coef, "std_err": float(se[i]),
                     "t_value": float(tv[i]), "p_value": float(pv[i])})
    return rows


def ols_fit_stats(fit: OlsFit) -> dict:
    """Model-level statistics: n, degrees of freedom, R2, adjusted R2, F, log-likelihood, AIC, BIC."""
    s = fit.model.summary
    n = int(s.numInstances)
    k = len(fit.xs)
    df_resid = n - k - 1
    ssr = float(s.meanSquaredError) * n
    r2 = float(s.r2)
    f_stat = (r2 / k) / ((1.0 - r2) / df_resid) if r2 < 1.0 else float("inf")
    log_lik = -0.5 * n * (math.log(2.0 * math.pi) + math.log(ssr / n) + 1.0)
    n_params = k + 1
    return {
        "n": n, "df_model": k, "df_resid": df_resid, "r2": r2, "adj_r2": float(s.r2adj),
        "f_stat": f_stat, "log_lik": log_lik, "aic": 2.0 * n_params - 2.0 * log_lik,
        "bic": n_params * math.log(n) - 2.0 * log_lik, "ssr": ssr,
    }


def simple_fit_columns(y: str, x: str) -> list[Column]:
    """One-pass closed form for a single predictor, as SQL aggregates."""
    ycol, xcol = F.col(y).cast("double"), F.col(x).cast("double")
    return [
        F.regr_slope(ycol, xcol).alias("slope"),
        F.regr_intercept(ycol, xcol).alias("intercept"),
        F.regr_r2(ycol, xcol).alias("r2"),
        F.regr_count(ycol, xcol).alias("n"),
    ]


def regression_points(df: DataFrame, y: str, x: str, fraction: float | None = None, seed: int = 42) -> DataFrame:
    """The scatter part of the regression plot: all ``(x, y)`` pairs, or a Bernoulli sample on request."""
    points = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).na.drop()
    return points if fraction is None else points.sample(fraction=fraction, seed=seed)


def p_values(rows: DataFrame, t: str = "t_value", df: str = "df_resid") -> DataFrame:
    """Adds ``p_value``, the two-sided p-value of each t statistic (JVM expressions)."""
    return rows.withColumn("p_value", student.two_sided_p(F.col(t), F.col(df)))


#: Confidence of the regression line's band.
CONFIDENCE = 0.95
BAND_DECIMALS = 6


def regression_line(df: DataFrame, y: str, x: str, steps: int = 50, digits: int = 8, confidence: float = CONFIDENCE) -> DataFrame:
    """Data for the regression plot: the fitted line on an even grid from min(x) to max(x).

    Each grid point carries the fitted value, the standard error of the fitted
    mean, ``sqrt(s2 * (1/n + (x - mean_x)^2 / Sxx))``, and the band that holds
    the mean with ``confidence`` (Student's t with n - 2 degrees of freedom).
    The fit is one aggregate pass whose single row comes to the driver; the grid follows from it.
    """
    ycol, xcol = F.col(y).cast("double"), F.col(x).cast("double")
    agg = df.agg(
        F.regr_slope(ycol, xcol).alias("b1"), F.regr_intercept(ycol, xcol).alias("b0"),
        F.regr_count(ycol, xcol).alias("n"), F.regr_avgx(ycol, xcol).alias("mx"),
        F.regr_sxx(ycol, xcol).alias("sxx"), F.regr_syy(ycol, xcol).alias("syy"),
        F.regr_sxy(ycol, xcol).alias("sxy"),
        F.min(F.when(ycol.isNotNull(), xcol)).alias("x_min"),
        F.max(F.when(ycol.isNotNull(), xcol)).alias("x_max"),
    ).first()
    n = int(agg["n"])
    if n <= 2 or not agg["sxx"]:
        raise SingularDesign(f"a line needs more than two rows and two different values of {x}")
    b0, b1 = round_sig(agg["b0"], digits), round_sig(agg["b1"], digits)
    s2 = round_sig((agg["syy"] - agg["sxy"] * agg["sxy"] / agg["sxx"]) / (n - 2), digits)
    mx, sxx = round_sig(agg["mx"], digits), round_sig(agg["sxx"], digits)
    x_min, x_max = float(agg["x_min"]), float(agg["x_max"])
    grid = df.sparkSession.range(0, steps + 1).select(F.col("id").cast("int").alias("step"))
    xg = F.lit(x_min) + F.col("step").cast("double") * (F.lit(x_max) - F.lit(x_min)) / F.lit(float(steps))
    dev = F.col("x") - F.lit(mx)
    return (grid.withColumn("x", xg)
            .withColumn("y_hat", F.lit(b0) + F.lit(b1) * F.col("x"))
            .withColumn("se_fit", F.sqrt(F.lit(s2) * (F.lit(1.0) / F.lit(float(n)) + dev * dev / F.lit(sxx))))
            .crossJoin(F.broadcast(_critical(df, n - 2, confidence)))      # one row
            .withColumn("lower", F.round(F.col("y_hat") - F.col("_t") * F.col("se_fit"), BAND_DECIMALS))
            .withColumn("upper", F.round(F.col("y_hat") + F.col("_t") * F.col("se_fit"), BAND_DECIMALS)).drop("_t"))


def _critical(df: DataFrame, degrees: int, confidence: float) -> DataFrame:
    """One row: the t value of a two-sided band."""
    one = df.sparkSession.range(1).select(F.lit(degrees).alias("_df"))
    return one.select(student.quantile((1 + confidence) / 2, F.col("_df")).alias("_t"))
