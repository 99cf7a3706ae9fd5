"""Statistics of margin: each test is one aggregate pass and arithmetic on its few rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marginalia import storage
from marginalia.functions.columns import CUT_EDGES, CUT_LABELS, clip, cut, mean, one_row
from marginalia.functions.tails import f_tail, t_two_sided
from marginalia.operators.windows import exact_quantiles

NUMERIC = [
    "sales", "quantity", "discount", "profit", "profit_margin", "ship_days", "cost",
    "profit_per_unit",
]


def _correlations(lines: DataFrame, pairs: list[tuple[str, str]]) -> list[Column]:
    """Aggregate expressions for Pearson correlations of column pairs.

    Columns are centred on their means first, so plain sums of products lose no precision, and
    each square is summed once rather than once per pair: the aggregate stays small enough to
    be compiled. Pairs with missing values fall back to ``corr``, which skips them pairwise.
    """
    names = sorted({name for pair in pairs for name in pair})
    first = lines.agg(
        F.count("*").alias("_rows"),
        *[F.count(name).alias(f"n_{name}") for name in names],
        *[F.avg(F.col(name).cast("double")).alias(f"m_{name}") for name in names],
    ).first()
    full = {name for name in names if first[f"n_{name}"] == first["_rows"] > 0}

    def centred(name: str) -> Column:
        return F.col(name).cast("double") - F.lit(first[f"m_{name}"])

    expressions = []
    for a, b in pairs:
        if a in full and b in full:
            spread = F.sqrt(F.sum(centred(a) * centred(a)) * F.sum(centred(b) * centred(b)))
            expressions.append(F.try_divide(F.sum(centred(a) * centred(b)), spread))
        else:
            expressions.append(F.corr(F.col(a).cast("double"), F.col(b).cast("double")))
    return expressions


def corr_matrix(lines: DataFrame, columns: list[str] = NUMERIC) -> DataFrame:
    """Pearson correlations of all column pairs in long form."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), value.alias("corr"))
            for (a, b), value in zip(pairs, _correlations(lines, pairs))
        ]
    )
    upper = lines.agg(cells.alias("cells")).select(F.explode("cells").alias("e")).select("e.*")
    both = F.array(
        F.struct(F.col("col_a").alias("a"), F.col("col_b").alias("b")),
        F.struct(F.col("col_b").alias("a"), F.col("col_a").alias("b")),
    )
    mirrored = upper.select(F.explode(F.array_distinct(both)).alias("p"), "corr")
    return mirrored.select(F.col("p.a").alias("col_a"), F.col("p.b").alias("col_b"), "corr")


def profit_drivers(lines: DataFrame, target: str = "profit") -> DataFrame:
    """Correlation of every other numeric column with the target, strongest first."""
    others = [name for name in NUMERIC if name != target]
    values = _correlations(lines, [(name, target) for name in others])
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("driver"), value.alias("corr"))
            for name, value in zip(others, values)
        ]
    )
    rows = lines.agg(cells.alias("cells")).select(F.explode("cells").alias("e")).select("e.*")
    return rows.orderBy(F.col("corr").desc(), "driver")


def anova(lines: DataFrame, value: str, group: str) -> DataFrame:
    """One-way analysis of variance from the count, mean and variance of each group."""
    present = lines.where(F.col(group).isNotNull() & F.col(value).isNotNull())
    groups = present.groupBy(group).agg(
        F.count("*").cast("double").alias("n"),
        F.avg(value).alias("m"),
        F.var_pop(value).alias("v"),
    )
    # sum n*m^2 - N*M^2 would cancel badly, so group means are centred first.
    everyone = Window.partitionBy()
    grand = F.sum(F.col("n") * F.col("m")).over(everyone) / F.sum("n").over(everyone)
    parts = groups.withColumn("d", F.col("m") - grand).agg(
        F.count("*").alias("groups"),
        F.sum("n").cast("bigint").alias("n"),
        F.sum(F.col("n") * F.col("d") * F.col("d")).alias("ss_between"),
        F.sum(F.col("n") * F.col("v")).alias("ss_within"),
    )
    parts = parts.withColumns(
        {"df_between": F.col("groups") - 1, "df_within": F.col("n") - F.col("groups")}
    )
    between = F.try_divide(F.col("ss_between"), F.col("df_between"))
    within = F.try_divide(F.col("ss_within"), F.col("df_within"))
    tested = parts.withColumn("f_statistic", F.try_divide(between, within))
    tested = tested.withColumn(
        "p_value", f_tail(F.col("f_statistic"), F.col("df_between"), F.col("df_within"))
    )
    return tested.withColumn("significant", F.col("p_value") < 0.05)


def margin_by_segment(lines: DataFrame) -> DataFrame:
    known = lines.where(F.col("segment").isNotNull())
    means = known.groupBy("segment").agg(mean("profit_margin").alias("avg_margin"))
    return means.orderBy("avg_margin", "segment")


def welch(lines: DataFrame, value: str, first: Column, second: Column) -> DataFrame:
    """Unequal-variance t-test between two filters of the same rows."""
    side = F.when(first, 1).when(second, 2)
    moments = lines.agg(
        *[
            expression.alias(f"{name}_{k}")
            for k in (1, 2)
            for name, expression in {
                "n": F.count(F.when(side == k, F.col(value))),
                "mean": F.avg(F.when(side == k, F.col(value))),
                "var": F.var_samp(F.when(side == k, F.col(value))),
            }.items()
        ]
    )
    a = F.try_divide(F.col("var_1"), F.col("n_1"))
    b = F.try_divide(F.col("var_2"), F.col("n_2"))
    freedom = F.try_divide(
        (a + b) * (a + b),
        F.try_divide(a * a, F.col("n_1") - 1) + F.try_divide(b * b, F.col("n_2") - 1),
    )
    tested = moments.withColumns(
        {
            "t_statistic": F.try_divide(F.col("mean_1") - F.col("mean_2"), F.sqrt(a + b)),
            "df": freedom,
        }
    ).drop("var_1", "var_2")
    tested = tested.withColumn("p_value", t_two_sided(F.col("t_statistic"), F.col("df")))
    return tested.withColumn("significant", F.col("p_value") < 0.05)


def welch_discount(lines: DataFrame) -> DataFrame:
    discount = F.col("discount")
    return welch(lines, "profit_margin", discount == 0, discount > 0)


def discount_bins(lines: DataFrame) -> DataFrame:
    """Mean margin per discount bin; a sort key keeps the bins in order."""
    banded = lines.withColumn("disc_band", cut("discount", CUT_EDGES, CUT_LABELS))
    banded = banded.where(F.col("disc_band").isNotNull())
    order = F.array_position(F.array(*[F.lit(x) for x in CUT_LABELS]), F.col("disc_band"))
    means = banded.groupBy("disc_band").agg((mean("profit_margin") * 100).alias("avg_margin_pct"))
    return means.withColumn("band_order", order).orderBy("band_order")


def clipped_margin(lines: DataFrame) -> DataFrame:
    return lines.select(clip("profit_margin", -1.0, 1.0).alias("margin"))


def margin_moments(lines: DataFrame) -> DataFrame:
    """Skewness and excess kurtosis (population forms) of margin held to [-1, 1]."""
    return clipped_margin(lines).agg(
        F.count("margin").alias("n"),
        F.skewness("margin").alias("skewness"),
        F.kurtosis("margin").alias("kurtosis"),
    )


def normality(moments: DataFrame) -> DataFrame:
    """D'Agostino-Pearson test from n, skewness and excess kurtosis.

    K2 has two degrees of freedom, for which the chi-square tail is exp(-K2 / 2).
    """
    n, g1, g2 = F.col("n").cast("double"), F.col("skewness"), F.col("kurtosis")
    y = g1 * F.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = (
        3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3)
        / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    )
    w2 = F.sqrt(2 * (beta2 - 1)) - 1
    delta = 1 / F.sqrt(0.5 * F.ln(w2))
    alpha = F.sqrt(2 / (w2 - 1))
    z_skew = delta * F.ln(y / alpha + F.sqrt((y / alpha) * (y / alpha) + 1))
    mean_b2 = 3 * (n - 1) / (n + 1)
    var_b2 = 24 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (g2 + 3 - mean_b2) / F.sqrt(var_b2)
    root_beta1 = (
        6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9))
        * F.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    )
    a = 6 + 8 / root_beta1 * (2 / root_beta1 + F.sqrt(1 + 4 / (root_beta1 * root_beta1)))
    base = (1 - 2 / a) / (1 + x * F.sqrt(2 / (a - 4)))
    cube = F.signum(base) * F.pow(F.abs(base), F.lit(1 / 3))
    z_kurt = (1 - 2 / (9 * a) - cube) / F.sqrt(2 / (9 * a))
    tested = moments.withColumns({"z_skewness": z_skew, "z_kurtosis": z_kurt})
    tested = tested.withColumn(
        "k2", F.col("z_skewness") * F.col("z_skewness") + F.col("z_kurtosis") * F.col("z_kurtosis")
    )
    return tested.withColumns(
        {"p_value": F.exp(-F.col("k2") / 2), "normal": F.exp(-F.col("k2") / 2) >= 0.05}
    )


def margin_normality(lines: DataFrame) -> DataFrame:
    return normality(margin_moments(lines))


def histogram(df: DataFrame, value: str, bins: int = 60) -> DataFrame:
    """Equal-width counts between the minimum and maximum; the maximum is in the last bin."""
    present = df.select(F.col(value).cast("double").alias("_v")).where("_v IS NOT NULL")
    span = present.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    placed = present.withColumn("_span", one_row(span)).select("_v", "_span.*")
    lo, hi = F.col("_lo"), F.col("_hi")
    share = F.coalesce(F.try_divide(F.col("_v") - lo, hi - lo), F.lit(0.0))
    number = F.least(F.floor(share * bins), F.lit(bins - 1)).cast("bigint")
    counts = placed.groupBy(number.alias("bin")).agg(
        F.count("*").alias("count"), F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi")
    )
    step = (hi - lo) / bins
    return counts.select(
        "bin", (lo + F.col("bin") * step).alias("lower"), (lo + (F.col("bin") + 1) * step).alias("upper"),
        "count",
    )


def margin_histogram(lines: DataFrame, bins: int = 60) -> DataFrame:
    """Histogram of clipped margin with its mean and median on every row."""
    margins = clipped_margin(lines)
    centre = margins.agg(F.avg("margin"))
    middle = exact_quantiles(margins, "margin", {"median_margin": 0.5})
    counts = histogram(margins, "margin", bins)
    return counts.withColumns({"mean_margin": centre.scalar(), "median_margin": middle.scalar()})


def box_summary(df: DataFrame, value: str, group: str) -> DataFrame:
    """Quartiles, whiskers within 1.5 interquartile ranges, and outliers per group."""
    present = df.where(F.col(group).isNotNull() & F.col(value).isNotNull())
    quartiles = exact_quantiles(present, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [group])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    # The quartiles are one row per group, broadcast by their file size, so a hot group is not moved.
    return (
        present.join(storage.stage(quartiles, "quartiles"), group)
        .groupBy(group, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col(value))).alias("whisker_low"),
            F.max(F.when(inside, F.col(value))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )
