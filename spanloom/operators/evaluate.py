"""Evaluation of labelings against each other and against a reference: set scores, coverage, drift, probes, statistics.

Spans compare as sets inside a row; only counts are shuffled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import nearest_p95, prf, ratio
from ..schema import LEVELS
from .decode import covered
from .decisions import consensus


def _sum(c) -> Column:
    return F.coalesce(F.sum(c), F.lit(0)).cast("long")


def aligned(pred: DataFrame, gold: DataFrame, key: str, same: str) -> DataFrame:
    """pred and gold by key; a pair whose column `same` differs fails the query. Columns of gold get the suffix _gold."""
    g = gold.select(key, *(F.col(c).alias(f"{c}_gold") for c in gold.columns if c != key))
    equal = F.col(same).eqNullSafe(F.col(f"{same}_gold"))
    checked = F.when(equal, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit(f"{same} differs at "), F.col(key).cast("string"))))
    return pred.join(g, key).filter(checked)


def three_way(rows: DataFrame) -> DataFrame:
    """(level, n, x_hits, y_hits, both, x_full, y_full) of rows(ref, x, y), sets of <level,text>. The level `all` sums up and
    alone has the rows that match in whole, and n_x and n_y."""
    sets = rows.select(*(F.array_distinct(F.coalesce(c, F.array().cast("array<struct<level:string,text:string>>"))).alias(c) for c in ("ref", "x", "y")))
    at = lambda a, level: F.size(F.filter(a, lambda s: s["level"] == level))
    hit, full = lambda c: F.array_intersect("ref", c), lambda c: ((F.size("ref") == F.size(c)) & (F.size(F.array_except("ref", c)) == 0)).cast("int")
    both = F.array_intersect(hit("x"), F.col("y"))
    line = lambda level, n, x, y, b, nx, ny, fx, fy: F.struct(F.lit(level).alias("level"), n.alias("n"), x.alias("x_hits"), y.alias("y_hits"), b.alias("both"), nx.alias("n_x"), ny.alias("n_y"), fx.alias("x_full"), fy.alias("y_full"))
    no = F.lit(0)
    lines = [line("all", F.size("ref"), F.size(hit("x")), F.size(hit("y")), F.size(both), F.size("x"), F.size("y"), full("x"), full("y"))]
    lines += [line(v, at("ref", v), at(hit("x"), v), at(hit("y"), v), at(both, v), at("x", v), at("y", v), no, no) for v in LEVELS]
    flat = sets.select(F.explode(F.array(*lines)).alias("l")).select("l.*")
    g = flat.groupBy("level").agg(*(_sum(c).alias(c) for c in flat.columns[1:]))
    return g.filter((F.col("level") == "all") | (F.col("n") > 0))


def drift(base: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """(group, total, matches, rate, mean_diff, max_diff) of two versions of a tagger, rows(key, group, tokens, label_ids,
    probs, special): tokens that are special are left out; a probability is that of the base's label. Unlike tokens fail."""
    rows = aligned(base, other, key, "tokens")
    per = F.arrays_zip("label_ids", "label_ids_gold", "probs", "probs_gold", "special")
    t = rows.select("group", F.explode(per).alias("t")).filter(~F.col("t.special"))
    diff = F.abs(F.get("t.probs", F.col("t.label_ids")) - F.get("t.probs_gold", F.col("t.label_ids")))
    g = t.select("group", (F.col("t.label_ids") == F.col("t.label_ids_gold")).alias("same"), diff.alias("d")).groupBy("group")
    return g.agg(F.count("*").alias("total"), F.count_if("same").alias("matches"), F.avg("d").alias("mean_diff"), F.max("d").alias("max_diff")).withColumn("rate", ratio(F.col("matches"), F.col("total")))


def coverage(rows: DataFrame) -> DataFrame:
    """(level, n, agree, n_a, n_b) of rows(text, a, b) by the letters and digits that spans of a level cover on either side;
    the level `any` counts rows, and as `agree` those without a level in dispute."""
    cover = [F.struct(F.lit(v).alias("level"), covered(F.col("text"), F.col("a"), v).alias("a"), covered(F.col("text"), F.col("b"), v).alias("b")) for v in LEVELS]
    c = rows.select(F.filter(F.array(*cover), lambda x: (F.size(x["a"]) > 0) | (F.size(x["b"]) > 0)).alias("c"))
    one = lambda level, agree, a, b: F.struct(level.alias("level"), agree.cast("int").alias("agree"), a.cast("int").alias("a"), b.cast("int").alias("b"))
    each = F.transform("c", lambda x: one(x["level"], x["a"] == x["b"], F.size(x["a"]) > 0, F.size(x["b"]) > 0))
    whole = one(F.lit("any"), ~F.exists("c", lambda x: x["a"] != x["b"]), F.exists("c", lambda x: F.size(x["a"]) > 0), F.exists("c", lambda x: F.size(x["b"]) > 0))
    flat = c.select(F.explode(F.concat(each, F.array(whole))).alias("l")).select("l.*")
    return flat.groupBy("level").agg(F.count("*").alias("n"), _sum("agree").alias("agree"), _sum("a").alias("n_a"), _sum("b").alias("n_b"))


def tagger_scores(rows: DataFrame) -> DataFrame:
    """(part, tp, n_pred, n_gold, p, r, f1) of rows(bio, spans, bio_gold, spans_gold): spans as sets of places and levels, in
    all, truncated ones, and by level; the part `tokens` has equal tags, `rows` those equal in all with their flags."""
    place = lambda x: F.array_distinct(F.transform(x, lambda s: F.struct(s["level"], s["start"], s["end"])))
    flagged = lambda x: F.array_distinct(F.transform(x, lambda s: F.struct(s["level"], s["start"], s["end"], s["truncated"])))
    only = lambda x, keep: place(F.filter(x, keep))
    line = lambda part, tp, p, g: F.struct(F.lit(part).alias("part"), tp.cast("long").alias("tp"), p.cast("long").alias("n_pred"), g.cast("long").alias("n_gold"))
    score = lambda part, a, b: line(part, F.size(F.array_intersect(a, b)), F.size(a), F.size(b))
    p, g = F.col("spans"), F.col("spans_gold")
    tags = F.size(F.filter(F.zip_with("bio", "bio_gold", lambda a, b: a == b), lambda x: x))
    full = (F.size(flagged(p)) == F.size(flagged(g))) & (F.size(F.array_except(flagged(p), flagged(g))) == 0)
    lines = [line("tokens", tags, F.size("bio"), F.size("bio_gold")), line("rows", full, F.lit(1), F.lit(1)), score("spans", place(p), place(g)), score("truncated", only(p, lambda s: s["truncated"]), only(g, lambda s: s["truncated"]))]
    of = lambda v: lambda s: s["level"] == v
    lines += [score(v, only(p, of(v)), only(g, of(v))) for v in LEVELS]
    flat = rows.select(F.explode(F.array(*lines)).alias("l")).select("l.*")
    t = flat.groupBy("part").agg(*(_sum(c).alias(c) for c in ("tp", "n_pred", "n_gold"))).filter((F.col("n_pred") + F.col("n_gold") > 0) | ~F.col("part").isin(*LEVELS))
    a, b, f = prf(F.col("tp"), F.col("n_pred"), F.col("n_gold"), 0.0)
    return t.select("*", a.alias("p"), b.alias("r"), f.alias("f1"))


def probe_scores(probes: DataFrame) -> DataFrame:
    """probes(kind, first, second: good, other, tie or null) with the consensus of both orders: consistent if they agree,
    correct if they agree on the good side, or on a tie for kind identical."""
    both = consensus(F.col("first"), F.col("second"))
    want = F.when(F.col("kind") == "identical", "tie").otherwise("good")
    return probes.withColumns({"consistent": both.isNotNull(), "correct": F.coalesce(both == want, F.lit(False))})


def probe_summary(scored: DataFrame, calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(by kind: n, correct, flips), (one row over calls(kind, raw, attempts, elapsed, cost, error): slots picked for identical
    probes, errors, retries, latency, costs). A judge is probed with few calls, so their latencies fit a row."""
    by = scored.groupBy("kind").agg(F.count("*").alias("n"), F.count_if("correct").alias("correct"), F.count_if(~F.col("consistent")).alias("flips"))
    good, same = F.col("error").isNull(), F.col("kind") == "identical"
    pick = lambda k: F.count_if(good & same & (F.col("raw") == k)).alias(f"picks_{k}")
    one = calls.agg(*map(pick, ("1", "2", "tie")), F.count_if(~good).alias("errors"), F.count_if(good & (F.col("attempts") > 1)).alias("retried"), F.round(F.avg(F.when(good, F.col("elapsed"))), 1).alias("latency_mean"), nearest_p95(F.collect_list(F.when(good, F.col("elapsed")))).alias("latency_p95"), F.round(F.sum("cost"), 5).alias("cost_usd"))
    return by, one


def dataset_stats(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one row of ratios over rows(text, spans, is_full, source_id, group), counts of (what, name) for levels and groups);
    lengths by sample.order_statistics."""
    full, part = F.col("is_full"), ~F.col("is_full")
    share = lambda when, c: F.round(F.coalesce(ratio(F.count_if(when & c), F.count_if(when)), F.lit(0.0)), 3)
    cut = F.exists("spans", lambda s: s["truncated"])
    one = rows.agg(
        F.count("*").alias("rows"), F.count_if(full).alias("full"), F.count_if(part).alias("prefix"), F.count_distinct("source_id").alias("source_ids"),
        share(full, F.col("text") == F.lower("text")).alias("full_lowercase"), share(full, ~F.contains("text", F.lit(","))).alias("full_no_comma"),
        share(full, F.exists("spans", lambda s: s["level"] == "L7")).alias("full_has_L7"), F.round(F.coalesce(F.avg(F.when(full, F.length("text"))), F.lit(0.0)), 1).alias("full_avg_len"),
        share(part, cut).alias("prefix_truncated"), share(part, F.size("spans") == 0).alias("prefix_no_span"),
    )
    names = rows.select(F.explode(F.concat(F.array(F.struct(F.lit("group").alias("what"), F.col("group").alias("name"))), F.transform("spans", lambda s: F.struct(F.lit("level").alias("what"), s["level"].alias("name"))))).alias("x")).select("x.*")
    return one, names.groupBy("what", "name").agg(F.count("*").alias("n"))


def row_errors(text: Column, tokens: Column, bio: Column, spans: Column) -> Column:
    """What a generated row breaks: text of a span, overlap, numbers of tokens and tags, a flag before the last span."""
    wrong = F.exists(spans, lambda s: F.substring(text, s["start"] + 1, s["end"] - s["start"]) != s["text"])
    order = F.array_sort(spans)
    pair = F.zip_with(order, F.slice(order, F.lit(2), F.greatest(F.size(order), F.lit(1))), lambda a, b: a["end"] > b["start"])
    early = F.exists(F.slice(order, F.lit(1), F.greatest(F.size(order) - 1, F.lit(0))), lambda s: s["truncated"])
    return F.array_compact(F.array(F.when(wrong, "span_text"), F.when(F.exists(pair, lambda x: x), "overlap"), F.when(F.size(tokens) != F.size(bio), "length"), F.when(early, "truncated"), F.when(F.length(F.trim(text)) == 0, "empty")))
