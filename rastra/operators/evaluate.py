"""Evaluation: recall, false alarms, calibration, losses, classification scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rastra.functions.algebra import col, sigmoid, smooth_label
from rastra.functions.geo import KM_PER_DEGREE
from rastra.operators.joins import point_pairs
from rastra.operators.scan import running_sum
from rastra.storage import settle


def reach(km: float, per_degree: float = 1.0) -> float:
    """A distance in the unit of the coordinates, of which ``per_degree`` make a degree."""
    return km / KM_PER_DEGREE * per_degree


def recall_at_k(predictions: DataFrame, sites: DataFrame, k: int, distance: float, score: str = "score", key: str = "id") -> DataFrame:
    """Share of the sites nearer than ``distance`` to one of the ``k`` best predictions; 0 without sites."""
    top = predictions.orderBy(F.desc(score), key).limit(k)
    found = point_pairs(sites, top, distance, "left_semi").agg(F.count("*").alias("matched"))
    total = sites.agg(F.count("*").alias("sites"))
    both = found.withColumn("_k", F.lit(1)).join(total.withColumn("_k", F.lit(1)), "_k")  # a row each
    return both.select("sites", "matched", F.coalesce(F.try_divide("matched", "sites"), F.lit(0.0)).alias("recall"))


def false_alarms(predictions: DataFrame, sites: DataFrame, total_area_km2: float, distance: float) -> DataFrame:
    """Predictions with no site nearer than ``distance``, and how many a 1000 km2; 0 for no area."""
    alone = point_pairs(predictions, sites, distance, "left_anti").agg(F.count("*").alias("false_positives"))
    rate = F.col("false_positives") / F.lit(total_area_km2 / 1000.0) if total_area_km2 > 0 else F.lit(0.0)
    return alone.withColumn("per_1000_km2", rate)


def calibration(predictions: DataFrame, sites: DataFrame, distance: float, n_bins: int = 10, score: str = "score", key: str = "id") -> DataFrame:
    """Bins ``[lo, hi)`` of the score: count, share of true positives, mean score; empty bins give 0 and their middle.

    A score of 1 falls in no bin. Edges are ``i * (1 / n)``.
    """
    hits = point_pairs(predictions, sites, distance, "left_semi").select(F.col(key).alias("_hit")).distinct()
    flagged = predictions.join(hits, F.col(key) == F.col("_hit"), "left")
    step = 1.0 / n_bins
    guess = F.floor(F.col(score) * n_bins).cast("int")
    # the edge just above or below a score may round to the other side
    number = F.when(F.col(score) < guess * step, guess - 1).when(F.col(score) >= (guess + 1) * step, guess + 1).otherwise(guess)
    seen = flagged.groupBy(number.alias("_bin")).agg(F.count("*").alias("n"), F.avg(F.col("_hit").isNotNull().cast("double")).alias("a"), F.avg(score).alias("c"))
    bins = predictions.sparkSession.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    joined = bins.join(seen, F.col("bin") == F.col("_bin"), "left")
    return joined.select(
        "bin", (F.col("bin") * step).alias("lo"), ((F.col("bin") + 1) * step).alias("hi"),
        F.coalesce("n", F.lit(0)).alias("count"), F.coalesce("a", F.lit(0.0)).alias("accuracy"),
        F.coalesce("c", (F.col("bin") + 0.5) * step).alias("confidence"),
    )


def bce(logit: Column | str, target: Column | str) -> Column:
    """Binary cross-entropy from a logit, without overflow."""
    x, t = col(logit), col(target)
    return F.greatest(x, F.lit(0.0)) - x * t + F.log1p(F.exp(-F.abs(x)))


def focal_term(logit: Column | str, target: Column | str, alpha: float = 0.25, gamma: float = 2.0, smoothing: float = 0.05) -> Column:
    t = smooth_label(target, smoothing)
    p = sigmoid(logit)
    pt = p * t + (1 - p) * (1 - t)
    return (alpha * t + (1 - alpha) * (1 - t)) * F.pow(1 - pt, F.lit(gamma)) * bce(logit, t)


def losses(rows: DataFrame, logit: str = "logit", target: str = "target", group: list[str] | None = None, dice_weight: float = 0.5, eps: float = 1e-6, **focal) -> DataFrame:
    """``focal``, ``dice`` (of unsmoothed targets) and ``combined`` in one pass."""
    p, t = sigmoid(logit), F.col(target)
    sums = rows.groupBy(*(group or [])).agg(
        F.avg(focal_term(logit, target, **focal)).alias("focal"),
        (1 - (2 * F.sum(p * t) + eps) / (F.sum(p) + F.sum(t) + eps)).alias("dice"),
    )
    return sums.withColumn("combined", F.col("focal") + dice_weight * F.col("dice"))


def precision_recall(rows: DataFrame, logit: str = "logit", target: str = "target", group: list[str] | None = None) -> DataFrame:
    """Counts, precision, recall and F1 at a probability above one half; ratios without a denominator are 0."""
    said, true = sigmoid(logit) > 0.5, F.col(target) > 0.5
    n = rows.groupBy(*(group or [])).agg(F.count_if(said & true).alias("tp"), F.count_if(said & ~true).alias("fp"), F.count_if(~said & true).alias("fn"))
    zero = F.lit(0.0)
    return n.withColumns(
        {
            "precision": F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")), zero),
            "recall": F.coalesce(F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")), zero),
            "f1": F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), zero),
        }
    )


def _bucket(x: Column, cuts: list[float]) -> Column:
    """How many of the ascending cuts are at or below ``x``, by binary search in one array."""
    if not cuts:
        return F.lit(0)
    listed = F.array(*[F.lit(float(c)) for c in cuts])
    start = F.struct(F.lit(0).alias("lo"), F.lit(len(cuts)).alias("hi"))

    def halve(r: Column, _: Column) -> Column:
        middle = F.floor((r["lo"] + r["hi"]) / 2).cast("int")
        left = (r["lo"] < r["hi"]) & (x < F.get(listed, middle))
        right = (r["lo"] < r["hi"]) & ~left
        return F.struct(F.when(right, middle + 1).otherwise(r["lo"]).alias("lo"), F.when(left, middle).otherwise(r["hi"]).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(len(cuts).bit_length())), start, halve)["lo"]


def auroc(rows: DataFrame, score: Column, target: str = "target", buckets: int = 1024) -> DataFrame:
    """Area under the ROC curve by ranks, ties counting half; null if a class is absent.

    Rows are summed by score first and ranked in ``buckets`` whose limits are quantiles of the distinct scores, so that no score far from the others leaves one bucket with all of them.
    """
    by = rows.select(score.alias("s"), F.col(target).alias("t")).groupBy("s").agg(
        F.count_if(F.col("t") > 0.5).alias("pos"), F.count_if(F.col("t") <= 0.5).alias("neg")
    )
    by = settle(by, "auroc_scores")
    cuts = by.agg(F.percentile_approx("s", [i / buckets for i in range(1, buckets)], 100 * buckets)).first()[0] or []
    bucket = _bucket(F.col("s"), sorted(set(cuts)))
    ranked = running_sum(by, F.col("neg"), bucket, [F.col("s")], name="below")
    area = ranked.agg(F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2.0)).alias("u"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    return area.select(F.try_divide(F.col("u"), F.col("p") * F.col("n")).alias("auroc"))


def latency_percentiles(rows: DataFrame, value: str, group: list[str] | None = None) -> DataFrame:
    """``p50, p95, p99`` with linear interpolation; 0 for no rows."""
    found = rows.groupBy(*(group or [])).agg(F.percentile(value, F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99))).alias("p"))
    return found.select(*(group or []), *[F.coalesce(F.col("p")[i], F.lit(0.0)).alias(n) for i, n in enumerate(("p50", "p95", "p99"))])


def early_stopping(epochs: DataFrame, loss: str = "loss", epoch: str = "epoch", patience: int = 10, lr_patience: int = 5, factor: float = 0.5, keep: int = 3) -> DataFrame:
    """Training history with best loss so far, epochs since it, whether to stop, learning-rate cuts, and the ``keep`` best checkpoints.

    One row an epoch: a history is short, so its windows run in one task.
    """
    from pyspark.sql.window import Window

    over = Window.orderBy(epoch)
    best = F.min(loss).over(over.rowsBetween(Window.unboundedPreceding, 0))
    before = F.min(loss).over(over.rowsBetween(Window.unboundedPreceding, -1))
    h = epochs.withColumns({"best": best, "improved": before.isNull() | (F.col(loss) < before)})
    since = F.col(epoch) - F.max(F.when(F.col("improved"), F.col(epoch))).over(over.rowsBetween(Window.unboundedPreceding, 0))
    h = h.withColumn("stale", since)
    cuts = F.count_if((F.col("stale") > 0) & (F.col("stale") % (lr_patience + 1) == 0)).over(over.rowsBetween(Window.unboundedPreceding, 0))
    kept = F.row_number().over(Window.orderBy(loss, epoch)) <= keep
    return h.withColumns({"stop": F.col("stale") >= patience, "lr_scale": F.pow(F.lit(factor), cuts), "kept": kept})
