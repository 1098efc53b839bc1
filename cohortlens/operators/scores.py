"""Classification, regression, ordinal, calibration and survival metrics.

All functions take ``by``: the same metric per task, fold or group in one pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.expr import clip, share, squared
from cohortlens.functions.ordering import running_totals
from cohortlens.operators.ranking_metrics import long_metrics


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where undefined."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def binary(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall and F1 of the positive class."""
    y, p = F.col(truth) == 1, F.col(pred) == 1
    tp, fp, fn = F.count_if(y & p), F.count_if(~y & p), F.count_if(y & ~p)
    return df.groupBy(*by).agg(
        F.avg((F.col(truth) == F.col(pred)).cast("double")).alias("accuracy"),
        ratio(tp, tp + fp).alias("precision"),
        ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def class_counts(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Per class: true positives, predicted and actual rows (an exploded pair per row)."""
    sides = F.array(
        F.struct(F.col(truth).alias("class"), F.lit(1).alias("actual"), F.lit(0).alias("predicted")),
        F.struct(F.col(pred).alias("class"), F.lit(0).alias("actual"), F.lit(1).alias("predicted")),
    )
    hit = (F.col(truth) == F.col(pred)).cast("int")
    rows = df.select(*by, hit.alias("_hit"), F.explode(sides).alias("s"))
    return rows.groupBy(*by, F.col("s.class").alias("class")).agg(
        F.sum(F.col("_hit") * F.col("s.actual")).alias("tp"),
        F.sum("s.predicted").alias("predicted"),
        F.sum("s.actual").alias("support"),
    )


def per_class(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    c = class_counts(df, truth, pred, by)
    tp = F.col("tp")
    return c.select(
        *by,
        "class",
        ratio(tp, F.col("predicted")).alias("precision"),
        ratio(tp, F.col("support")).alias("recall"),
        ratio(2 * tp, F.col("predicted") + F.col("support")).alias("f1"),
        "support",
    )


def weighted_f1(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    return per_class(df, truth, pred, by).groupBy(*by).agg(
        (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("weighted_f1")
    )


def confusion(df: DataFrame, truth: str, pred: str, n_classes: int) -> DataFrame:
    """All cells (actual, predicted, n) of labels 0..n-1, empty ones included."""
    counts = df.groupBy(F.col(truth).alias("actual"), F.col(pred).alias("predicted")).agg(F.count("*").alias("n"))
    cells = [(i, j) for i in range(n_classes) for j in range(n_classes)]
    grid = df.sparkSession.createDataFrame(cells, "actual int, predicted int")
    return grid.join(counts, ["actual", "predicted"], "left").fillna(0, subset=["n"])


def roc_auc(df: DataFrame, truth: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve with ties at one half; NULL when a class is absent."""
    counts = df.groupBy(*by, score).agg(
        F.count_if(F.col(truth) == 1).alias("_pos"), F.count_if(F.col(truth) != 1).alias("_neg")
    )
    upto = running_totals(counts, score, {"_upto": "_neg"}, within=by)
    below = F.col("_upto") - F.col("_neg") / 2
    return upto.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("_pos") * below), F.sum("_pos").cast("double") * F.sum("_neg")).alias("roc_auc")
    )


def pr_auc(df: DataFrame, truth: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Average precision: Σ ΔR · P over distinct scores from high to low."""
    counts = df.groupBy(*by, score).agg(F.count_if(F.col(truth) == 1).alias("_pos"), F.count("*").alias("_n"))
    upto = running_totals(counts, score, {"_tp": "_pos", "_seen": "_n"}, within=by, descending=True)
    return upto.groupBy(*by).agg(
        F.try_divide(F.sum(F.col("_pos") * F.col("_tp") / F.col("_seen")), F.sum("_pos")).alias("pr_auc")
    )


def macro_auc(df: DataFrame, truth: str, probabilities: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Mean one-versus-rest AUC; classes without both sides are left out; 0 if none is left."""
    cells = [
        F.struct(F.lit(k).alias("class"), (F.col(truth) == k).cast("int").alias("is"), F.col(c).alias("p"))
        for k, c in enumerate(probabilities)
    ]
    long = df.select(*by, F.explode(F.array(*cells)).alias("c")).select(*by, "c.*")
    each = roc_auc(long, "is", "p", [*by, "class"])
    return each.groupBy(*by).agg(F.coalesce(F.avg("roc_auc"), F.lit(0.0)).alias("macro_auc"))


def brier(df: DataFrame, truth: str, prob: str, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(squared(F.col(prob) - F.col(truth))).alias("brier"))


def calibration_curve(df: DataFrame, truth: str, prob: str, n_bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Mean prediction and actual rate per occupied equal-width bin."""
    at = F.least(F.floor(F.col(prob) * n_bins), F.lit(n_bins - 1)).cast("int")
    return df.groupBy(*by, at.alias("bin")).agg(
        F.count("*").alias("n"), F.avg(prob).alias("mean_predicted"), F.avg(F.col(truth).cast("double")).alias("rate")
    )


def calibration_error(df: DataFrame, truth: str, prob: str, n_bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Mean gap between prediction and rate over occupied bins, each bin counting once."""
    curve = calibration_curve(df, truth, prob, n_bins, by)
    return curve.groupBy(*by).agg(F.avg(F.abs(F.col("rate") - F.col("mean_predicted"))).alias("calibration_error"))


def class_calibration(df: DataFrame, truth: str, probabilities: Sequence[str], n_bins: int = 5) -> DataFrame:
    """Calibration per class: rows, error, mean probability and actual rate."""
    cells = [
        F.struct(F.lit(k).alias("class"), (F.col(truth) == k).cast("int").alias("is"), F.col(c).alias("p"))
        for k, c in enumerate(probabilities)
    ]
    long = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    # the bin sums give the error as well as the overall means
    curve = calibration_curve(long, "is", "p", n_bins, ["class"])
    stats = curve.groupBy("class").agg(
        F.sum(F.col("rate") * F.col("n")).alias("_pos"),
        F.avg(F.abs(F.col("rate") - F.col("mean_predicted"))).alias("_error"),
        (F.sum(F.col("mean_predicted") * F.col("n")) / F.sum("n")).alias("_mean"),
        (F.sum(F.col("rate") * F.col("n")) / F.sum("n")).alias("_rate"),
    )
    seen = F.col("_pos") > 0
    return stats.select(
        "class",
        F.round("_pos", 0).cast("bigint").alias("n_samples"),
        F.when(seen, F.col("_error")).alias("calibration_error"),
        F.when(seen, F.col("_mean")).alias("mean_predicted"),
        F.when(seen, F.col("_rate")).alias("actual_rate"),
    )


def expected_calibration_error(per_class_rows: DataFrame) -> DataFrame:
    """Class errors weighted by frequency; NULL if a class has no error."""
    whole = F.count("calibration_error") == F.count("*")
    error = F.try_divide(F.sum(F.col("n_samples") * F.col("calibration_error")), F.sum("n_samples"))
    return per_class_rows.agg(F.when(whole, error).alias("ece"))


def ordinal(df: DataFrame, truth: str, pred: str, by: Sequence[str] = ()) -> DataFrame:
    """Mean absolute error and the shares exact, within one and within two."""
    gap = F.abs(F.col(truth) - F.col(pred))
    return df.groupBy(*by).agg(
        F.avg(gap).alias("mae"),
        share(gap == 0).alias("exact"),
        share(gap <= 1).alias("within_one"),
        share(gap <= 2).alias("within_two"),
    )


def kappa(df: DataFrame, truth: str, pred: str, n_classes: int, by: Sequence[str] = ()) -> DataFrame:
    """Quadratic weighted kappa of labels 0..n-1, 0 where undefined.

    With squared weights the expected disagreement follows from the sums of both
    labels and their squares, so one pass of sums is enough.
    """
    i, j = F.col(truth).cast("double"), F.col(pred).cast("double")
    known = df.where(F.col(truth).between(0, n_classes - 1) & F.col(pred).between(0, n_classes - 1))
    n = F.count("*")
    observed = F.sum(squared(i - j))
    expected = F.sum(squared(i)) + F.sum(squared(j)) - 2 * F.sum(i) * F.sum(j) / n
    return known.groupBy(*by).agg(
        F.when(expected > 0, 1 - observed / expected).otherwise(F.lit(0.0)).alias("qwk")
    )


def regression(df: DataFrame, truth: str, pred: str, by: Sequence[str] = (), bounds: tuple | None = None) -> DataFrame:
    """MAE, RMSE, R², Pearson correlation and, with bounds, the MAE of clipped predictions."""
    y, p = F.col(truth).cast("double"), F.col(pred).cast("double")
    extra = [F.avg(F.abs(y - clip(p, *bounds))).alias("mae_clipped")] if bounds else []
    return df.groupBy(*by).agg(
        F.avg(F.abs(y - p)).alias("mae"),
        F.sqrt(F.avg(squared(y - p))).alias("rmse"),
        (1 - F.try_divide(F.avg(squared(y - p)), F.var_pop(y))).alias("r2"),
        F.corr(y, p).alias("corr"),
        *extra,
    )


def concordance(df: DataFrame, time: str, event: str, risk: str) -> DataFrame:
    """Concordance index of censored times: tied risks count one half."""
    from cohortlens.operators.survival import comparable_pairs

    pairs = comparable_pairs(df.select(F.col(time).alias("time"), F.col(event).alias("event"), F.col(risk).alias("risk")))
    return pairs.select(
        F.try_divide(F.col("concordant") + 0.5 * F.col("tied"), "comparable").alias("c_index"), "comparable"
    )


def recall_of_top(df: DataFrame, truth: str, score: str, key: str, top_share: float = 0.2) -> DataFrame:
    """Share of all positives among the top share of rows, and the precision there."""
    from cohortlens.operators.prep import place_in_group

    ordered = df.withColumn("_all", F.lit(0)).withColumn("_order", -F.col(score))
    placed = place_in_group(ordered, "_all", "_order", key, many_ties=True)
    n = df.agg(F.ceil(F.count("*") * top_share)).scalar()
    top = F.col("_place") <= n
    positive = F.col(truth) == 1
    return placed.agg(
        ratio(F.count_if(top & positive), F.count_if(positive)).alias("recall_top"),
        ratio(F.count_if(top & positive), F.count_if(top)).alias("precision_top"),
    )


def suite(parts: Mapping[str, DataFrame]) -> DataFrame:
    """One-row metric tables, by prefix, as rows (metric, value)."""
    out = None
    for prefix, one in parts.items():
        named = one.toDF(*[f"{prefix}_{c}" if prefix else c for c in one.columns])
        rows = long_metrics(named, named.columns)
        out = rows if out is None else out.unionByName(rows)
    return out


def metric(name: str) -> Column:
    """Aggregate over (metric, value) rows: the value of one metric."""
    return F.max(F.when(F.col("metric") == name, F.col("value")))


def or_default(name: str, default: float) -> Column:
    return F.coalesce(metric(name), F.lit(default))


def with_composites(rows: DataFrame, composites: Mapping[str, Column]) -> DataFrame:
    """Append composite scores, each an aggregate over the metric rows."""
    one = rows.agg(*[c.alias(n) for n, c in composites.items()])
    return rows.unionByName(long_metrics(one, list(composites)))


def mean_of(suffix: str) -> Column:
    """Mean over the heads' metrics with a suffix."""
    return F.coalesce(F.avg(F.when(F.col("metric").endswith(suffix), F.col("value"))), F.lit(0.0))


def at_least_zero(c: Column) -> Column:
    return F.greatest(F.lit(0.0), c)


# --- evaluation suites, one per prediction task ---------------------------------------


def evaluate_enrolment(df: DataFrame) -> DataFrame:
    """Columns y_true, y_pred, score."""
    parts = [
        binary(df, "y_true", "y_pred"),
        roc_auc(df, "y_true", "score"),
        pr_auc(df, "y_true", "score"),
        brier(df, "y_true", "score"),
        calibration_error(df, "y_true", "score"),
    ]
    return together(parts)


def together(parts: Sequence[DataFrame]) -> DataFrame:
    out = long_metrics(parts[0], parts[0].columns)
    for one in parts[1:]:
        out = out.unionByName(long_metrics(one, one.columns))
    return out


def heads(df: DataFrame, tasks: Sequence[str]) -> DataFrame:
    """Columns y_<task>, p_<task> of several heads as rows (task, y, p), read once."""
    cells = [
        F.struct(F.lit(t).alias("task"), F.col(f"y_{t}").cast("double").alias("y"), F.col(f"p_{t}").cast("double").alias("p"))
        for t in tasks
    ]
    return df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def by_task(table: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """A per-task metric table as rows; metric names are <task>_<new name>."""
    rows = long_metrics(table.withColumnsRenamed(dict(names)), list(names.values()), ["task"])
    return rows.select(F.concat_ws("_", "task", "metric").alias("metric"), "value")


def evaluate_degree(df: DataFrame, n_classes: int = 5) -> DataFrame:
    """Columns y, p, prob_0..: ordinal agreement, accuracy and calibration."""
    probabilities = [f"prob_{k}" for k in range(n_classes)]
    ece = expected_calibration_error(class_calibration(df, "y", probabilities))
    return together([ordinal(df, "y", "p"), kappa(df, "y", "p", n_classes), ece])


def evaluate_retention(df: DataFrame) -> DataFrame:
    """Columns y_/p_ of risk, score, category, departure and prob_risk."""
    levels = heads(df, ["category", "departure"])
    rows = suite(
        {
            "risk": binary(df, "y_risk", "p_risk"),
            "score": regression(df, "y_score", "p_score", bounds=(0.0, 100.0)).select("mae", "rmse", "mae_clipped"),
        }
    )
    rows = (
        rows.unionByName(suite({"risk": roc_auc(df, "y_risk", "prob_risk")}))
        .unionByName(by_task(ordinal(levels, "y", "p", ["task"]), {"exact": "exact", "within_one": "within_1"}))
        .unionByName(by_task(ordinal(levels, "y", "p", ["task"]), {"exact": "accuracy"}))
        .unionByName(by_task(kappa(levels, "y", "p", 4, ["task"]), {"qwk": "qwk"}))
    )
    return with_composites(
        rows, {"composite_accuracy": mean_of("_accuracy"), "composite_roc_auc": mean_of("_roc_auc")}
    )


def evaluate_graduates(df: DataFrame, classes: Mapping[str, int]) -> DataFrame:
    """Columns y_/p_<task> and prob_<task>_<k>: accuracy and macro AUC per head, QWK of salary."""
    rows = by_task(ordinal(heads(df, list(classes)), "y", "p", ["task"]), {"exact": "accuracy"})
    cells = [
        F.struct(
            F.lit(t).alias("task"),
            F.lit(k).alias("class"),
            (F.col(f"y_{t}") == k).cast("int").alias("is"),
            F.col(f"prob_{t}_{k}").alias("p"),
        )
        for t, n in classes.items()
        for k in range(n)
    ]
    long = df.select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    each = roc_auc(long, "is", "p", ["task", "class"])
    macro = each.groupBy("task").agg(F.coalesce(F.avg("roc_auc"), F.lit(0.0)).alias("roc_auc"))
    rows = rows.unionByName(by_task(macro, {"roc_auc": "roc_auc"}))
    if "salary" in classes:
        rows = rows.unionByName(suite({"salary": kappa(df, "y_salary", "p_salary", classes["salary"])}))
    return with_composites(
        rows, {"composite_roc_auc": mean_of("_roc_auc"), "composite_accuracy": mean_of("_accuracy")}
    )


def evaluate_survey(df: DataFrame, themes: Sequence[str]) -> DataFrame:
    """Columns y_/p_ of satisfied, nps and every theme."""
    numbers = regression(heads(df, ["nps", *themes]), "y", "p", ["task"])
    kept = by_task(numbers, {"mae": "mae", "r2": "r2"})
    corr = by_task(numbers.where(F.col("task") == "nps"), {"corr": "corr"})
    satisfied = suite(
        {
            "satisfaction": binary(df, "y_satisfied", "p_satisfied").select("accuracy"),
            "satisfaction_": roc_auc(df, "y_satisfied", "p_satisfied"),
        }
    ).withColumn("metric", F.replace("metric", F.lit("__"), F.lit("_")))
    rows = satisfied.unionByName(kept).unionByName(corr)
    theme = lambda suffix: F.avg(F.when(F.col("metric").isin([f"{t}_{suffix}" for t in themes]), F.col("value")))
    return with_composites(
        rows,
        {
            "avg_theme_mae": theme("mae"),
            "avg_theme_r2": theme("r2"),
            "overall_score": or_default("satisfaction_accuracy", 0.5) * 0.3
            + at_least_zero(metric("nps_r2")) * 0.2
            + at_least_zero(theme("r2")) * 0.5,
        },
    )


def evaluate_exam(df: DataFrame) -> DataFrame:
    """Columns y_/p_ of mark, pass, grade and prob_pass."""
    rows = suite(
        {
            "mark": regression(df, "y_mark", "p_mark"),
            "pass": binary(df, "y_pass", "p_pass").drop("f1"),
            "grade": ordinal(df, "y_grade", "p_grade").select(
                F.col("exact").alias("accuracy"), F.col("within_one").alias("within_1")
            ),
        }
    )
    rows = (
        rows.unionByName(suite({"pass": roc_auc(df, "y_pass", "prob_pass")}))
        .unionByName(suite({"grade": kappa(df, "y_grade", "p_grade", 4)}))
        .unionByName(together([brier(df, "y_pass", "prob_pass")]))
    )
    score = (
        at_least_zero(or_default("mark_r2", 0.0)) * 0.30
        + or_default("pass_roc_auc", 0.5) * 0.35
        + or_default("grade_qwk", 0.0) * 0.20
        + at_least_zero(1 - or_default("mark_mae", 10.0) / 10) * 0.15
    )
    return with_composites(rows, {"overall_score": score})


def evaluate_wellbeing(df: DataFrame) -> DataFrame:
    """Columns y_/p_ of score, risk, support and prob_risk."""
    rows = suite(
        {
            "score": regression(df, "y_score", "p_score"),
            "at_risk": binary(df, "y_risk", "p_risk").drop("f1"),
            "support": ordinal(df, "y_support", "p_support").select(
                F.col("exact").alias("accuracy"), F.col("within_one").alias("within_1")
            ),
        }
    )
    rows = (
        rows.unionByName(suite({"at_risk": roc_auc(df, "y_risk", "prob_risk")}))
        .unionByName(suite({"support": kappa(df, "y_support", "p_support", 4)}))
        .unionByName(together([brier(df, "y_risk", "prob_risk")]))
    )
    score = (
        at_least_zero(or_default("score_r2", 0.0)) * 0.30
        + or_default("at_risk_roc_auc", 0.5) * 0.40
        + or_default("support_qwk", 0.0) * 0.15
        + at_least_zero(1 - or_default("score_mae", 20.0) / 20) * 0.15
    )
    return with_composites(rows, {"overall_score": score})


def evaluate_demand(df: DataFrame) -> DataFrame:
    """Columns y_/p_ of enrollment, fill_rate and category."""
    numbers = regression(heads(df, ["enrollment", "fill_rate"]), "y", "p", ["task"])
    rows = by_task(numbers, {"mae": "mae", "r2": "r2"})
    rows = rows.unionByName(by_task(numbers.where(F.col("task") == "enrollment"), {"rmse": "rmse"}))
    rows = rows.unionByName(
        suite({"demand_category": ordinal(df, "y_category", "p_category").select(F.col("exact").alias("accuracy"))})
    )
    score = (
        F.least(F.lit(1.0), 20 / F.greatest(metric("enrollment_mae"), F.lit(1.0))) * 0.25
        + at_least_zero(metric("enrollment_r2")) * 0.25
        + at_least_zero(metric("fill_rate_r2")) * 0.25
        + metric("demand_category_accuracy") * 0.25
    )
    return with_composites(rows, {"overall_score": score})
