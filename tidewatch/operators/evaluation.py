"""Classifier evaluation.

Input: a table of ``(y, score)`` rows (optionally grouped, e.g. by fold).

Rank-based metrics need, for every distinct score, the number of rows with
a lower score.  Instead of one global sort, scores are first collapsed to
distinct values with per-value counts (partial aggregation, so a score held
by most rows is one row after the map side).  The distinct scores are then
cut into contiguous score ranges holding about ``rows_per_bucket`` distinct
values each: the number of ranges comes from the distinct count, the cut
points from approximate quantiles, and Spark ML's ``Bucketizer`` assigns
them (binary search).  Range totals (one row per range and group, broadcast
when bounded) give each range's offset, and a window *inside* each range
orders at most about ``rows_per_bucket`` scores, however the scores are
distributed.  All counts are integers, so AUC is an exact rational U / (P*N).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.session import materialize

# ---- fixed values: decision rules of the reference -------------------------
DECISION_THRESHOLD = 0.465
F_BETA = 1.5
CLASS_NAMES = {0: "Tidak Banjir", 1: "Banjir"}
# ---------------------------------------------------------------------------

ROWS_PER_BUCKET = 4_000_000
OFFSET_BROADCAST_MAX_ROWS = 1_000_000


def _ratio(a: Column, b: Column) -> Column:
    """a / b with 0 for an empty denominator (sklearn's zero_division=0)."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def split_scored(scored: DataFrame, y: str = "y", score: str = "score") -> tuple[DataFrame, DataFrame]:
    """Rows that rank metrics can use, and the rejects: a missing or NaN score
    or a missing label.  Infinite scores rank first and last."""
    good = F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")) & F.col(y).isNotNull()
    return scored.where(good), scored.where(~good)


def _score_ranges(g: DataFrame, rows_per_bucket: int) -> tuple[DataFrame, int]:
    """Contiguous score ranges of about ``rows_per_bucket`` distinct scores
    each; returns ``g`` with an integer ``bucket`` and the range count."""
    n = g.count()
    b = max(1, -(-n // rows_per_bucket))
    if b == 1:
        return g.withColumn("bucket", F.lit(0)), 1
    from pyspark.ml.feature import Bucketizer

    cuts = g.approxQuantile("score", [i / b for i in range(1, b)], 1.0 / (4 * b))
    splits = [-float("inf")] + sorted(set(cuts)) + [float("inf")]
    out = Bucketizer(splits=splits, inputCol="score", outputCol="_bucket").transform(g)
    return out.withColumn("bucket", F.col("_bucket").cast("int")).drop("_bucket"), len(splits) - 1


def score_counts(scored: DataFrame, by=(), y: str = "y", score: str = "score",
                 rows_per_bucket: int = ROWS_PER_BUCKET,
                 groups_bound: int | None = None) -> DataFrame:
    """Per distinct score: positives, negatives, and the number of positive
    and negative rows with a strictly lower score (``pos_below``,
    ``neg_below``), plus the group totals ``P`` and ``N``.
    ``groups_bound``: known upper bound on the number of ``by`` groups (the
    range-offset table is then broadcast without a check)."""
    by = list(by)
    scored, _ = split_scored(scored, y, score)
    g = scored.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(F.col(y).cast("bigint")).alias("pos"),
        F.sum((F.lit(1) - F.col(y)).cast("bigint")).alias("neg"))
    # ``g`` (one row per distinct score) is read by the range cut, the range
    # offsets and the in-range windows: a checkpoint in the shared folder
    # instead of re-reading the input.
    g = materialize(g)
    g, buckets = _score_ranges(g, rows_per_bucket)
    tot = g.groupBy(*by, "bucket").agg(F.sum("pos").alias("bpos"), F.sum("neg").alias("bneg"))
    wb = Window.partitionBy(*by).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    wall = Window.partitionBy(*by)
    off = tot.select(*by, "bucket",
                     F.coalesce(F.sum("bpos").over(wb), F.lit(0)).alias("opos"),
                     F.coalesce(F.sum("bneg").over(wb), F.lit(0)).alias("oneg"),
                     F.sum("bpos").over(wall).alias("P"), F.sum("bneg").over(wall).alias("N"))
    wi = Window.partitionBy(*by, "bucket").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    g = g.select("*", F.coalesce(F.sum("pos").over(wi), F.lit(0)).alias("ipos"),
                 F.coalesce(F.sum("neg").over(wi), F.lit(0)).alias("ineg"))
    # ``off`` has at most ``buckets`` rows per group.
    n_groups = 1 if not by else groups_bound
    if n_groups is not None and n_groups * buckets <= OFFSET_BROADCAST_MAX_ROWS:
        off = F.broadcast(off)
    elif off.limit(OFFSET_BROADCAST_MAX_ROWS + 1).count() <= OFFSET_BROADCAST_MAX_ROWS:
        off = F.broadcast(off)
    g = g.join(off, [*by, "bucket"], "inner")
    return g.select(*by, "score", "pos", "neg",
                    (F.col("opos") + F.col("ipos")).alias("pos_below"),
                    (F.col("oneg") + F.col("ineg")).alias("neg_below"), "P", "N")


def auc(scored: DataFrame, by=(), y: str = "y", score: str = "score",
        groups_bound: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """ROC AUC by the rank-sum formula with mid-ranks for ties (equal to
    the trapezoidal ROC area).  ``U2 = sum(pos * (2*below + n + 1)) - P*(P+1)``
    is an integer; AUC = U2 / (2*P*N)."""
    by = list(by)
    c = score_counts(scored, by, y, score, groups_bound=groups_bound,
                     rows_per_bucket=rows_per_bucket)
    below = F.col("pos_below") + F.col("neg_below")
    n = F.col("pos") + F.col("neg")
    dec = "decimal(38,0)"
    agg = c.groupBy(*by).agg(
        F.sum((F.col("pos").cast(dec) * (F.lit(2) * below + n + F.lit(1)).cast(dec))).alias("_s"),
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"))
    p, q = F.col("positives"), F.col("negatives")
    u2 = F.col("_s") - p.cast(dec) * (p + F.lit(1)).cast(dec)
    return agg.select(*by, "positives", "negatives",
                      F.try_divide(u2.cast("double"),
                                   (F.lit(2) * p).cast("double") * q.cast("double")).alias("auc"))


def roc_curve(scored: DataFrame, by=(), y: str = "y", score: str = "score",
              groups_bound: int | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """For every distinct score used as threshold (score >= t is
    positive): cumulative true / false positives and their rates."""
    by = list(by)
    c = score_counts(scored, by, y, score, groups_bound=groups_bound,
                     rows_per_bucket=rows_per_bucket)
    tp = F.col("P") - F.col("pos_below")
    fp = F.col("N") - F.col("neg_below")
    return c.select(*by, F.col("score").alias("threshold"), tp.alias("tp"), fp.alias("fp"),
                    _ratio(tp, F.col("P")).alias("tpr"), _ratio(fp, F.col("N")).alias("fpr"))


def fbeta_curve(roc: DataFrame, beta: float = F_BETA) -> DataFrame:
    """Precision, recall and F-beta at every threshold of ``roc_curve``."""
    b2 = F.lit(float(beta * beta))
    prec = _ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = F.col("tpr")
    return roc.withColumns({"precision": prec, "recall": rec}).withColumn(
        "fbeta", _ratio((F.lit(1.0) + b2) * F.col("precision") * F.col("recall"),
                        b2 * F.col("precision") + F.col("recall")))


def best_threshold(roc: DataFrame, by=(), beta: float = F_BETA) -> DataFrame:
    """Threshold with the highest F-beta (lowest threshold on ties)."""
    by = list(by)
    fb = fbeta_curve(roc, beta)
    key = F.struct(F.col("fbeta"), (-F.col("threshold")).alias("nt"))
    best = fb.groupBy(*by).agg(F.max_by(F.struct("threshold", "fbeta", "precision", "recall"),
                                        key).alias("b"))
    return best.select(*by, "b.threshold", "b.fbeta", "b.precision", "b.recall")


def predict(scored: DataFrame, threshold: float = DECISION_THRESHOLD, score: str = "score",
            out: str = "pred") -> DataFrame:
    """M6: hard decision ``score >= threshold``."""
    return scored.withColumn(out, (F.col(score) >= F.lit(float(threshold))).cast("int"))


def confusion_counts(pred: DataFrame, by=(), y: str = "y", yhat: str = "pred") -> DataFrame:
    """Tp / fp / fn / tn in one aggregate pass."""
    yy, pp = F.col(y) == 1, F.col(yhat) == 1
    return pred.groupBy(*by).agg(
        F.count_if(yy & pp).alias("tp"), F.count_if(~yy & pp).alias("fp"),
        F.count_if(yy & ~pp).alias("fn"), F.count_if(~yy & ~pp).alias("tn"))


def class_report(pred: DataFrame, by=(), y: str = "y", yhat: str = "pred") -> DataFrame:
    """Per-class precision, recall, F1 and support (two rows per group)."""
    by = list(by)
    cc = confusion_counts(pred, by, y, yhat)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def cls(label, hit, false_pos, miss):
        p = _ratio(hit, hit + false_pos)
        r = _ratio(hit, hit + miss)
        return F.struct(F.lit(label).alias("class"), F.lit(CLASS_NAMES[label]).alias("name"),
                        p.alias("precision"), r.alias("recall"),
                        _ratio(F.lit(2.0) * p * r, p + r).alias("f1"),
                        (hit + miss).alias("support"), hit.alias("correct"))

    rows = cc.select(*by, F.explode(F.array(cls(0, tn, fn, fp), cls(1, tp, fp, fn))).alias("c"))
    return rows.select(*by, "c.*")


def report_averages(report: DataFrame, by=()) -> DataFrame:
    """Accuracy, macro average and support-weighted average."""
    by = list(by)
    s = F.col("support")
    agg = report.groupBy(*by).agg(
        F.sum("support").alias("total"),
        F.sum("correct").alias("_correct"),
        *[F.sum(F.when(F.col("class") == k, F.col(m))).alias(f"{m}{k}")
          for m in ("precision", "recall", "f1") for k in (0, 1)],
        *[F.sum(F.when(F.col("class") == k, s)).alias(f"s{k}") for k in (0, 1)])
    t = F.col("total").cast("double")

    def macro(m):
        return (F.col(f"{m}0") + F.col(f"{m}1")) / F.lit(2.0)

    def weighted(m):
        return (F.col(f"{m}0") * F.col("s0") + F.col(f"{m}1") * F.col("s1")) / t

    acc = F.col("_correct").cast("double") / t

    def row(name, p, r, f):
        return F.struct(F.lit(name).alias("average"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), F.col("total").alias("support"))

    none = F.lit(None).cast("double")
    rows = F.array(
        row("accuracy", none, none, acc),
        row("macro avg", macro("precision"), macro("recall"), macro("f1")),
        row("weighted avg", weighted("precision"), weighted("recall"), weighted("f1")))
    return agg.select(*by, F.inline(rows))


def accuracy_f1(pred: DataFrame, by=(), y: str = "y", yhat: str = "pred") -> DataFrame:
    """Accuracy and positive-class F1 per group (for fold summaries)."""
    cc = confusion_counts(pred, by, y, yhat)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    p = _ratio(tp, tp + fp)
    r = _ratio(tp, tp + fn)
    return cc.select(*by, _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                     _ratio(F.lit(2.0) * p * r, p + r).alias("f1"))


def mean_std(metrics: DataFrame, cols, by=(), places: int = 4) -> DataFrame:
    """A10: mean and population standard deviation of per-fold metrics,
    rounded to the published 4 places."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    s = float(10 ** places)
    out = metrics.groupBy(*by).agg(F.count(F.lit(1)).alias("folds"), *aggs)
    return out.select(*by, "folds", *[
        (F.rint(F.col(f"{c}_{k}") * F.lit(s)) / F.lit(s)).alias(f"{c}_{k}")
        for c in cols for k in ("mean", "std")])


def auc_and_decision(scored: DataFrame, by=(), threshold: float = DECISION_THRESHOLD,
                     y: str = "y", score: str = "score", groups_bound: int | None = None,
                     rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """AUC, accuracy and positive-class F1 at ``threshold`` from one pass:
    the per-score counts already hold the confusion counts of any threshold
    (``score >= threshold`` is positive)."""
    by = list(by)
    c = score_counts(scored, by, y, score, groups_bound=groups_bound,
                     rows_per_bucket=rows_per_bucket)
    below = F.col("pos_below") + F.col("neg_below")
    n = F.col("pos") + F.col("neg")
    dec = "decimal(38,0)"
    hit = F.col("score") >= F.lit(float(threshold))
    agg = c.groupBy(*by).agg(
        F.sum((F.col("pos").cast(dec) * (F.lit(2) * below + n + F.lit(1)).cast(dec))).alias("_s"),
        F.sum("pos").alias("P"), F.sum("neg").alias("N"),
        F.sum(F.when(hit, F.col("pos")).otherwise(F.lit(0))).alias("tp"),
        F.sum(F.when(hit, F.col("neg")).otherwise(F.lit(0))).alias("fp"))
    p, q = F.col("P"), F.col("N")
    tp, fp = F.col("tp"), F.col("fp")
    fn, tn = p - tp, q - fp
    u2 = F.col("_s") - p.cast(dec) * (p + F.lit(1)).cast(dec)
    prec, rec = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    return agg.select(
        *by,
        F.try_divide(u2.cast("double"), (F.lit(2) * p).cast("double") * q.cast("double")).alias("auc"),
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(F.lit(2.0) * prec * rec, prec + rec).alias("f1"))
