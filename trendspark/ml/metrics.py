"""Classification metrics as DataFrame aggregates."""

from __future__ import annotations

from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendspark.operators.prefix import running_totals
from trendspark.session import c


def confusion(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """One row: tn, fp, fn, tp."""

    def cell(actual: int, guess: int) -> Column:
        return F.count_if((c(label) == actual) & (c(pred) == guess))

    return df.agg(cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp"))


def _ratio(num: Column, den: Column, empty: float | None = 0.0) -> Column:
    return F.when(den > 0, num / den).otherwise(F.lit(empty).cast("double"))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def binary_metrics(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Accuracy, macro F1, precision and recall (0 when undefined), wasted and missed rates (null when undefined)."""
    m = confusion(df, label, pred)
    tn, fp, fn, tp = (c(n).cast("double") for n in ("tn", "fp", "fn", "tp"))
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    precision0, recall0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp)
    # A class neither true nor predicted anywhere has no part in the mean.
    seen1, seen0 = (tp + fp + fn > 0).cast("int"), (tn + fp + fn > 0).cast("int")
    both = _f1(precision, recall) * seen1 + _f1(precision0, recall0) * seen0
    return m.select(
        _ratio(tn + tp, tn + fp + fn + tp).alias("accuracy"),
        _ratio(both, (seen0 + seen1).cast("double")).alias("f1"),
        precision.alias("precision"),
        recall.alias("recall"),
        _ratio(fp, fp + tp, None).alias("wasted_rate"),
        _ratio(fn, fn + tp, None).alias("missed_rate"),
    )


def roc_auc(df: DataFrame, score: str, label: str = "label") -> DataFrame:
    """Exact area under the curve: a positive beats a negative with a lower score, ties count half."""
    counts = (
        df.filter(c(score).isNotNull() & c(label).isNotNull())
        .groupBy(c(score).alias("score"))
        .agg(F.count_if(c(label) == 1).alias("pos"), F.count_if(c(label) == 0).alias("neg"))
    )
    ranked = running_totals(counts, ["score"], {"neg_upto": c("neg")})
    wins = c("pos") * (c("neg_upto") - c("neg") / 2)
    return ranked.agg(
        F.try_divide(F.sum(wins), (F.sum("pos") * F.sum("neg")).cast("double")).alias("roc_auc")
    )


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """(class, precision, recall, f1, support) per class, then accuracy, macro and weighted averages."""
    pairs = df.groupBy(c(label).cast("int").alias("label"), c(pred).cast("int").alias("pred")).agg(
        F.count(F.lit(1)).alias("n")
    )
    # One cell per (label, prediction): seen from both sides, then folded per class.
    sides = F.array(
        F.struct(c("label").alias("cls"), c("n").alias("actual"), F.lit(0).cast("bigint").alias("guessed"), F.lit(0).cast("bigint").alias("hit")),
        F.struct(
            c("pred").alias("cls"), F.lit(0).cast("bigint").alias("actual"), c("n").alias("guessed"),
            F.when(c("label") == c("pred"), c("n")).otherwise(0).cast("bigint").alias("hit"),
        ),
    )
    per = pairs.select(F.inline(sides)).groupBy("cls").agg(F.sum("actual").alias("support"), F.sum("guessed").alias("guessed"), F.sum("hit").alias("hit"))
    hit, support = c("hit").cast("double"), c("support").cast("double")
    precision, recall = _ratio(hit, c("guessed").cast("double")), _ratio(hit, support)
    per = per.select(
        c("cls").cast("string").alias("class"), precision.alias("precision"), recall.alias("recall"),
        _f1(precision, recall).alias("f1"), "support", "hit",
    )
    figures = ["precision", "recall", "f1"]
    total = F.sum("support")
    accuracy = F.sum("hit") / total
    folded = per.agg(
        accuracy.alias("acc"),
        total.alias("support"),
        *[F.avg(n).alias(f"m_{n}") for n in figures],
        *[(F.sum(c(n) * c("support")) / total).alias(f"w_{n}") for n in figures],
    )
    rows = F.array(
        F.struct(F.lit("accuracy").alias("class"), *[c("acc").alias(n) for n in figures], c("support").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), *[c(f"m_{n}").alias(n) for n in figures], c("support").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), *[c(f"w_{n}").alias(n) for n in figures], c("support").alias("support")),
    )
    return per.drop("hit").unionByName(folded.select(F.inline(rows)))


class MacroF1Evaluator(Evaluator, HasLabelCol, HasPredictionCol):
    """Mean of the two classes' F1, for Spark ML model search."""

    def __init__(self, labelCol: str = "label", predictionCol: str = "prediction") -> None:
        super().__init__()
        self._set(labelCol=labelCol, predictionCol=predictionCol)

    def _evaluate(self, dataset: DataFrame) -> float:
        return float(binary_metrics(dataset, self.getLabelCol(), self.getPredictionCol()).first()["f1"])

    def isLargerBetter(self) -> bool:
        return True
