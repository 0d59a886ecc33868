"""Comparing predictions with annotations."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newscov.functions.answers import MISSING_KEY_MACRO, MISSING_KEY_MICRO, run_name
from newscov.functions.labels import code_of, coded_labels, indicators, present_labels
from newscov.schemas import ANNOTATION_COLUMNS, EVALUATION_COLUMNS, METRICS, PREDICTION_COLUMNS, require_columns
from newscov.sources.inline import literal_rows
from newscov.taxonomy import METRIC_CODES, PUBLISHED_RUN

# Classes that a confusion matrix has columns for.
MOST_CLASSES = 1_000
METRIC_NAMES = ("precision", "recall", "f1", "top1", "top3", "unsure")


def _ratio(part: Column, whole: Column) -> Column:
    """part / whole, 0 where the denominator is 0."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def evaluation_columns(predictions: DataFrame, *keep: str) -> DataFrame:
    """Keep the columns an evaluation needs; fails if one is missing."""
    return require_columns(predictions, *EVALUATION_COLUMNS).select(*keep, *EVALUATION_COLUMNS)


def label_lists(predictions: DataFrame, macro: bool = False) -> DataFrame:
    """Add ``truth`` and ``predicted`` lists: codes for the micro set, raw labels for the macro set."""
    collect = present_labels if macro else coded_labels
    return predictions.withColumns(
        {"truth": collect(*ANNOTATION_COLUMNS), "predicted": collect(*PREDICTION_COLUMNS)}
    )


def label_counts(lists: DataFrame, codes=METRIC_CODES, by: list[str] | None = None) -> DataFrame:
    """Per label: rows where it was hit, predicted and true. One map-side aggregated pass."""
    return _tallies(lists, codes, by or [], top=3).where("label IS NOT NULL").drop("rows", *METRIC_NAMES[3:])


def _tallies(lists: DataFrame, codes, by: list[str], top: int | None) -> DataFrame:
    """Sums per label, and under a null label the row-level sums, in a single aggregation.

    Each row yields one entry per label it names plus one for itself, so nothing
    is joined and partial sums shrink to one row per label before the shuffle.
    """
    known = F.array(*map(F.lit, codes))
    truth, predicted = F.col("truth"), F.col("predicted")
    leading = predicted if top is None else F.slice(predicted, 1, top)
    fields = ("label", "hit", "predicted", "actual", "rows", "top1", "top3", "unsure")

    def entry(*values) -> Column:
        return F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(f) for f, v in zip(fields, values)])

    def per_label(label: Column) -> Column:
        guessed, right = F.array_contains(predicted, label), F.array_contains(truth, label)
        return entry(label, _flag(guessed & right), _flag(guessed), _flag(right), 0, 0, 0, 0)

    row = entry(
        F.lit(None).cast("string"), 0, 0, 0, 1,
        _flag(F.array_contains(truth, F.try_element_at(predicted, F.lit(1)))),
        _flag(F.arrays_overlap(leading, truth)),
        _flag(F.size(predicted) == 0),
    )
    named = F.array_intersect(F.array_union(truth, predicted), known)
    entries = F.concat(F.transform(named, per_label), F.array(row))
    return (
        lists.select(*by, F.inline(entries))
        .groupBy(*by, "label")
        .agg(*[F.sum(f).alias(f) for f in fields[1:]])
    )


def multilabel_metrics(
    lists: DataFrame,
    codes=METRIC_CODES,
    by: list[str] | None = None,
    top: int | None = 3,
    half_even: bool = False,
) -> DataFrame:
    """Support-weighted precision, recall and F1, top-1 / top-3 accuracy and share of empty predictions.

    Percentages with two decimals, one row per ``by`` group. ``top=None`` accepts a hit at any rank.
    """
    by = by or []
    p = _ratio(F.col("hit"), F.col("predicted"))
    r = _ratio(F.col("hit"), F.col("actual"))
    f1 = _ratio(2 * F.col("hit"), F.col("predicted") + F.col("actual"))
    # Rows and labels share one table: a label's row counts are 0 and the other way round.
    support = F.coalesce(F.sum("actual"), F.lit(0))
    rows = F.sum("rows")

    def percent(part: Column, whole: Column) -> Column:
        return (F.bround if half_even else F.round)(_ratio(part, whole) * 100, 2)

    weighted = {name: percent(F.sum(m * F.col("actual")), support) for name, m in zip(METRIC_NAMES, (p, r, f1))}
    plain = {name: percent(F.sum(name), rows) for name in METRIC_NAMES[3:]}
    tallies = _tallies(lists, codes, by, top)
    return tallies.groupBy(*by).agg(*[c.alias(n) for n, c in (weighted | plain).items()])


def label_indicator(lists: DataFrame, *keep: str, column: str = "truth", codes=METRIC_CODES) -> DataFrame:
    """One 0/1 column per code."""
    return lists.select(*keep, *indicators(F.col(column), list(codes)))


def hallucinations(predictions: DataFrame, legacy: bool = False) -> DataFrame:
    """Rows with a prediction that is neither a code nor a name of the taxonomy.

    The placeholder of an answer without the key is no prediction and so not invented.
    ``legacy`` looks for the unknown mark after normalisation has removed it, so it finds none.
    """
    if legacy:
        lists = label_lists(predictions)
        return lists.agg(F.count_if(F.array_contains("predicted", "N/A")).alias("hallucinations"))
    known = [*METRIC_CODES, MISSING_KEY_MICRO, MISSING_KEY_MACRO]
    unknown = [
        F.col(c).isNotNull() & code_of(F.col(c)).isNull() & ~F.col(c).isin(known) for c in PREDICTION_COLUMNS
    ]
    any_unknown = reduce(or_, unknown)
    return predictions.agg(F.count_if(any_unknown).alias("hallucinations"))


def metrics_by_run(
    predictions: DataFrame, path_column: str = "path", name_parts: int = 3, published=(PUBLISHED_RUN,)
) -> DataFrame:
    """Metrics of every run at once, keyed by the run name in its file path, plus published rows."""
    runs = label_lists(predictions).withColumn("source", run_name(F.col(path_column), name_parts))
    measured = multilabel_metrics(runs, by=["source"])
    return measured.unionByName(literal_rows(predictions.sparkSession, published, METRICS.names))


def runs(predictions: DataFrame, path_column: str = "path", name_parts: int = 3) -> DataFrame:
    """Distinct run paths and names."""
    return predictions.select(path_column).distinct().withColumn("source", run_name(F.col(path_column), name_parts))


def _class_pairs(scored: DataFrame, actual: str, predicted: str) -> DataFrame:
    return scored.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n")
    )


def confusion(scored: DataFrame, actual: str = "label", predicted: str = "predicted", classes=(0, 1)) -> DataFrame:
    """Counts per actual (rows) and predicted (columns) class.

    Both sides hold ``classes`` and every other class either side has, which a small job finds
    out: one row per class. Pairs with a null are left out. More than ``MOST_CLASSES`` classes raise, as
    the table would have a column for each.
    """
    pairs = _class_pairs(scored, actual, predicted).where("actual IS NOT NULL AND predicted IS NOT NULL")
    named = pairs.select(F.explode(F.array_distinct(F.array("actual", "predicted"))).alias("class")).distinct()
    seen = named.limit(MOST_CLASSES + 1).collect()
    if len(seen) > MOST_CLASSES:
        raise ValueError(f"{actual} and {predicted} hold more than {MOST_CLASSES} classes")
    both = sorted({*classes, *[row["class"] for row in seen]})
    counts = [F.coalesce(F.sum(F.when(F.col("predicted") == c, F.col("n"))), F.lit(0)).alias(f"predicted_{c}") for c in both]
    kind = scored.schema[actual].dataType
    spine = literal_rows(scored.sparkSession, [(c,) for c in both], ["actual"]).withColumn("actual", F.col("actual").cast(kind))
    return spine.join(pairs, "actual", "left").groupBy("actual").agg(*counts).orderBy("actual")


def class_report(scored: DataFrame, actual: str = "label", predicted: str = "predicted") -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted averages."""
    pairs = _class_pairs(scored, actual, predicted)
    hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
    entries = F.array(
        F.struct(F.col("actual").alias("class"), hit.alias("hit"), F.lit(0).alias("guessed"), F.col("n").alias("support")),
        F.struct(F.col("predicted").alias("class"), F.lit(0).alias("hit"), F.col("n").alias("guessed"), F.lit(0).alias("support")),
    )
    sums = pairs.select(F.inline(entries)).groupBy("class").agg(
        *[F.sum(c).alias(c) for c in ("hit", "guessed", "support")]
    )
    scores = ("precision", "recall", "f1")
    per_class = sums.select(
        F.col("class").cast("string").alias("class"),
        "hit",
        F.col("support").cast("bigint").alias("support"),
        _ratio(F.col("hit"), F.col("guessed")).alias("precision"),
        _ratio(F.col("hit"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hit"), F.col("guessed") + F.col("support")).alias("f1"),
    )
    # One rollup gives the classes and, as its grand total, everything the averages need.
    total = F.sum("support")
    rolled = per_class.rollup("class").agg(
        F.grouping_id().alias("_total"),
        total.alias("support"),
        _ratio(F.sum("hit"), total).alias("_accuracy"),
        *[F.avg(c).alias(c) for c in scores],
        *[_ratio(F.sum(F.col(c) * F.col("support")), total).alias(f"_weighted_{c}") for c in scores],
    )

    def line(name: Column, values) -> Column:
        return F.struct(name.alias("class"), *[F.col(v).alias(c) for c, v in zip(scores, values)], F.col("support"))

    averages = F.array(
        line(F.lit("accuracy"), ["_accuracy"] * 3),
        line(F.lit("macro avg"), scores),
        line(F.lit("weighted avg"), [f"_weighted_{c}" for c in scores]),
    )
    own = F.array(line(F.col("class"), scores))
    return rolled.select(F.inline(F.when(F.col("_total") == 1, averages).otherwise(own)))


def class_weights(labelled: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights n / (k * n_c) per class."""
    per_class = labelled.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    classes = Window.partitionBy()  # one row per class
    weight = F.sum("n").over(classes) / (F.count("*").over(classes) * F.col("n"))
    return per_class.select(label, "n", weight.alias("weight"))


def accuracy_logloss(
    scored: DataFrame,
    actual: str = "label",
    predicted: str = "predicted",
    confidence: str = "confidence",
    weight: Column | None = None,
    floor: float = 1e-7,
) -> DataFrame:
    """Accuracy and weighted log loss, given the probability of the predicted one of two classes.

    Rows without an actual class count for neither.
    """
    scored = scored.where(F.col(actual).isNotNull())
    weight = F.lit(1.0) if weight is None else weight
    right = F.col(actual) == F.col(predicted)
    of_truth = F.when(right, F.col(confidence)).otherwise(1 - F.col(confidence))
    bounded = F.least(F.greatest(of_truth, F.lit(floor)), F.lit(1 - floor))
    return scored.agg(
        F.avg(right.cast("int")).alias("accuracy"),
        F.try_divide(F.sum(-weight * F.log(bounded)), F.sum(weight)).alias("logloss"),
    )


def split_total(split_sizes: DataFrame) -> DataFrame:
    """Rows over all splits."""
    return split_sizes.agg(F.sum("n").alias("len_dataset"))
