"""Routing, order-swapped verdicts, the gate, calibration and recommendation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.stats import ratio, wilson


def stage(identical: Column) -> Column:
    return F.when(identical, "agreed").otherwise("to_judge")


def side_of(slot: Column, order: Column) -> Column:
    """The side a slot shows: order 0 has old first, order 1 new first."""
    return F.when(slot == "tie", "tie").when((slot == "1") == (order == 0), "old").when(slot.isin("1", "2"), "new")


def consensus(first: Column, second: Column) -> Column:
    """The side both orders name, else null."""
    return F.when(first == second, first)


def decision(identical: Column, winner: Column) -> Column:
    return F.when(identical, "agree").when(winner.isNull(), "inconclusive").when(winner == "old", "model_better").when(winner == "tie", "tie").otherwise("deepseek_better")


def confirmed(decided: Column, severity_total: Column, threshold: Column) -> Column:
    """Whether an error counts as confirmed: null while the threshold is."""
    return F.when(decided != "deepseek_better", F.lit(False)).otherwise(severity_total >= threshold)


def truth_winner(f1_old: Column, f1_new: Column) -> Column:
    """Which side a gold labeling prefers: old, new or, within 1e-9, tie."""
    return F.when(F.abs(f1_old - f1_new) < 1e-9, "tie").when(f1_old > f1_new, "old").otherwise("new")


def calibration(cases: DataFrame) -> DataFrame:
    """One row from cases(winner: old, new, tie or null for a flip; truth; identical): accuracy and kappa over judged cases
    with a verdict, precision and recall of finding errors, false alarms, flips, and equal cases that were wrong."""
    judged = cases.filter(~F.col("identical"))
    n = lambda c: F.count_if(c).cast("long")
    hit, truth = F.col("winner") == "new", F.col("truth") == "new"
    facts = judged.agg(
        F.count("*").alias("n_judged"), n(F.col("winner").isNull()).alias("flips"), n(F.col("winner").isNotNull()).alias("n_verdicts"),
        n(F.col("winner") == F.col("truth")).alias("right"), n(hit & truth).alias("tp"), n(hit).alias("n_found"), n(truth).alias("n_errors"),
        n(hit & ~truth).alias("false_alarms"), n(~truth).alias("n_sound"),
    )
    equal = cases.filter("identical").agg(F.count("*").alias("n_equal"), n(F.col("truth") == "new").alias("equal_but_wrong"))
    k = kappa(judged.filter(F.col("winner").isNotNull()), "winner", "truth").select("kappa")
    one = facts.crossJoin(equal).crossJoin(k)  # one row each
    r = lambda a, b: ratio(F.col(a), F.col(b))
    return one.select("n_judged", "n_verdicts", r("right", "n_verdicts").alias("accuracy"), "kappa", r("tp", "n_found").alias("detect_precision"), r("tp", "n_errors").alias("detect_recall"), r("false_alarms", "n_sound").alias("false_alarm"), r("flips", "n_judged").alias("flip_rate"), r("equal_but_wrong", "n_equal").alias("agree_but_wrong"))


def error_type(budget: Column, fatal: Column, attempts: Column, most: int) -> Column:
    """What an exception in a stage leads to: budget_exceeded and failed end a case, retry does not."""
    return F.when(budget, "budget_exceeded").when(fatal | (attempts >= most), "failed").otherwise("retry")


def verified_recommendation(judge: Column, quality: Column, by_level: Column, limits: dict) -> Column:
    """struct<status,reasons,slices,corrected_error_rate>.

    judge: struct<kappa,false_alarm,flip_rate,precision>, null without a calibration; quality: struct<k,n,rate,ci_low> of
    confirmed errors; by_level: array of the same with level. limits: min_severity, min_kappa, max_false_alarm,
    max_flip_rate, min_cases, max_error_rate; one that is None leaves everything uncalibrated."""
    missing = [k for k, v in limits.items() if v is None]
    empty = F.array().cast("array<string>")
    row = lambda status, reasons, slices, rate: F.struct(F.lit(status).alias("status") if isinstance(status, str) else status.alias("status"), reasons.alias("reasons"), slices.alias("slices"), rate.cast("double").alias("corrected_error_rate"))
    none = F.lit(None)
    if missing:
        return row("uncalibrated", F.array(*map(F.lit, missing)), empty, none)
    weak = F.array_compact(F.array(
        F.when(judge["kappa"].isNull() | (judge["kappa"] < limits["min_kappa"]), "kappa"),
        F.when(judge["false_alarm"].isNull() | (judge["false_alarm"] > limits["max_false_alarm"]), "false_alarm"),
        F.when(judge["flip_rate"] > limits["max_flip_rate"], "flip_rate"),
    ))
    over = lambda q: (q["k"] >= limits["min_cases"]) & (F.coalesce(q["ci_low"], F.lit(0.0)) >= limits["max_error_rate"])
    slices = F.transform(F.filter(by_level, over), lambda q: q["level"])
    status = F.when(over(quality) | (F.size(slices) > 0), "retrain").otherwise("no_retrain")
    fine = row(status, F.array(F.concat_ws("/", quality["k"].cast("string"), quality["n"].cast("string"))), slices, quality["rate"] * judge["precision"])
    return F.when(judge.isNull(), row("uncalibrated", F.array(F.lit("calibration")), empty, none)).when(F.size(weak) > 0, row("judge_unreliable", weak, empty, none)).otherwise(fine)


def kappa(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """One row: n, po, pe, kappa (null for no pairs or pe = 1), from the table of counts."""
    table = pairs.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).cast("string").alias("x"), F.col(b).cast("string").alias("y")).agg(F.count("*").alias("n"))
    side = table.select(F.explode(F.array(F.struct(F.col("x").alias("v"), F.col("n").alias("na"), F.lit(0).cast("long").alias("nb"), F.when(F.col("x") == F.col("y"), F.col("n")).otherwise(0).alias("same")), F.struct(F.col("y").alias("v"), F.lit(0).cast("long").alias("na"), F.col("n").alias("nb"), F.lit(0).cast("long").alias("same")))).alias("s")).select("s.*")
    margin = side.groupBy("v").agg(F.sum("na").alias("na"), F.sum("nb").alias("nb"), F.sum("same").alias("same"))
    one = margin.agg(F.sum("na").alias("n"), F.sum("same").alias("same"), F.sum(F.col("na").cast("double") * F.col("nb")).alias("cross"))
    one = one.select("n", ratio(F.col("same"), F.col("n")).alias("po"), F.try_divide(F.col("cross"), F.col("n").cast("double") * F.col("n")).alias("pe"))
    return one.withColumn("kappa", F.when(F.col("pe") < 1, (F.col("po") - F.col("pe")) / (1 - F.col("pe"))))


def sweep(cases: DataFrame, severity: str, error: str) -> DataFrame:
    """Per threshold t: support and errors of cases with severity >= t, precision and recall. Equal severities are summed
    first, so the window runs over distinct thresholds only."""
    by = cases.groupBy(F.col(severity).alias("t")).agg(F.count("*").alias("n"), F.sum(F.col(error).cast("long")).alias("k"))
    by = by.unionByName(cases.sparkSession.sql("SELECT 0D AS t, 0L AS n, 0L AS k")).groupBy(F.col("t").cast("double").alias("t")).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    up = W.orderBy("t").rangeBetween(W.currentRow, W.unboundedFollowing)
    return by.select("t", F.sum("n").over(up).alias("support"), F.sum("k").over(up).alias("errors"), F.sum("k").over(W.partitionBy()).alias("all")).select("t", "support", "errors", ratio(F.col("errors"), F.col("support")).alias("precision"), ratio(F.col("errors"), F.col("all")).alias("recall"))


def suggest(swept: DataFrame, precision: float, support: int) -> DataFrame:
    return swept.agg(F.min(F.when((F.col("precision") >= precision) & (F.col("support") >= support), F.col("t"))).alias("t"))


def recommend(n: Column, errors: Column, n_level: Column, level_errors: Column, limits: dict) -> tuple[Column, Column]:
    """(status, reasons): uncalibrated while a limit is null, else retrain if the interval's low end passes a limit."""
    if any(v is None for v in limits.values()):
        return F.lit("uncalibrated"), F.array(F.lit("limits"))
    low, level_low = wilson(errors, n)[0], wilson(level_errors, n_level)[0]
    reasons = F.array_compact(F.array(F.when((n >= limits["min_cases"]) & (low >= limits["overall"]), "overall"), F.when((n_level >= limits["min_slice"]) & (level_low >= limits["slice"]), "slice")))
    return F.when(F.size(reasons) > 0, "retrain").when(n < limits["min_cases"], "insufficient").otherwise("keep"), reasons
