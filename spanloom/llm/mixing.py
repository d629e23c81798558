"""Mixing sources to target weights over a tree of domains, languages and sources.

A budget of tokens goes down the tree. At each node it is split among the children by weight; a child that can't use
its share (its tokens times max_epochs) takes what it has and the rest goes to its siblings, by weight again. As a node
never gets more than its subtree holds, shortages are settled among siblings before they reach an ancestor's.

A leaf reads its documents in epochs, each in an own seeded order: whole epochs as often as they fit, then the longest
prefix of the next epoch that fits. The prefix is found by 4096 slices of the order, summed with partial aggregation,
then by 4096 slices of the one slice that the cut falls into; only a 2^24th of a leaf's documents are sorted, by their
ids alone, so a leaf of any size spreads over tasks.

Tokens are words here (`words` of common). Everything is DataFrame expressions.

Defined results: null languages and sources are the empty name; null or blank texts hold no tokens and come with their
slice; rows of one doc_id share their place in the order and come together; an empty table, or a budget of 0, gives no
rows with tokens; a text counts whole, however long; extra columns are kept, but for those that the facts are named like.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Workspace, match_counted, words

TREE = ("_domain", "_lang", "_source")
SLICE = 3  # hexadecimal digits of a level
LEVELS = 2
FACTS = ("domain", "epoch", "n_tokens")
#: Leaves that may be broadcast; beyond it documents meet the leaves by a shuffled join.
FEW_LEAVES = 100_000


def by_number(source: Column) -> Column:
    """The default domain: the trailing number of a source's name, dealt over four domains."""
    n = F.coalesce(F.regexp_extract(source, "([0-9]{1,9})$", 1).try_cast("int"), F.lit(0))
    return F.element_at(F.array(*map(F.lit, ("web", "books", "code", "reference"))), F.pmod(n, F.lit(4)) + 1)


@dataclass(frozen=True)
class Targets:
    """weights: of paths (domain,), (domain, lang) and (domain, lang, source); a path not named weighs 1."""

    weights: dict[tuple[str, ...], float] = field(default_factory=dict)
    share: float = 0.6  # of all tokens
    max_epochs: int = 4
    seed: int = 17

    def weight(self, depth: int) -> Column:
        own = [(k, v) for k, v in self.weights.items() if len(k) == depth]
        if not own:
            return F.lit(1.0)
        table = F.create_map(*(F.lit(x) for k, v in own for x in ("\x01".join(k), float(v))))
        return F.coalesce(F.try_element_at(table, F.concat_ws("\x01", *TREE[:depth])), F.lit(1.0))


TARGETS = Targets({("web",): 0.5, ("books",): 0.2, ("code",): 0.2, ("reference",): 0.1} | {(d, "en"): 4.0 for d in ("web", "books", "code", "reference")})


def split(nodes: DataFrame, parent: list[str], by: str) -> DataFrame:
    """nodes(parent..., name, weight, cap, above) with budget: `above` of each parent filled up to the caps by weight.

    In the order of cap / weight the children that are full come first; the level of the others follows from sums."""
    over = W.partitionBy(*(parent or [F.lit(0)]))
    before = over.orderBy("_ratio", by).rowsBetween(W.unboundedPreceding, -1)
    n = nodes.withColumn("_ratio", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(float("inf"))))
    n = n.withColumn("_left", F.greatest(F.lit(0.0), F.col("above") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))))
    n = n.withColumn("_w", F.sum("weight").over(over) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    n = n.withColumn("_level", F.when(F.col("_w") > 1e-12, F.col("_left") / F.col("_w")).otherwise(F.lit(0.0)))
    n = n.withColumn("_full", F.col("_ratio") <= F.col("_level"))
    n = n.withColumn("_cut", F.min(F.when(~F.col("_full"), F.struct("_ratio", by, "_level"))).over(over))
    n = n.withColumn("budget", F.when(F.col("_full"), F.col("cap")).otherwise(F.col("_cut._level") * F.col("weight")))
    return n.drop("_ratio", "_left", "_w", "_level", "_full", "_cut")


def budgets(leaves: DataFrame, targets: Targets) -> DataFrame:
    """leaves(_domain, _lang, _source, tokens, n) with budget (tokens, double)."""
    levels = [leaves.groupBy(*TREE[:d]).agg((F.sum("tokens") * targets.max_epochs).cast("double").alias("cap")).withColumn("weight", targets.weight(d)) for d in (1, 2, 3)]
    whole = leaves.agg((F.coalesce(F.sum("tokens"), F.lit(0)) * min(targets.share, targets.max_epochs)).cast("double").alias("above"))
    top = split(levels[0].crossJoin(whole), [], TREE[0])  # one row joins: the total
    mid = split(levels[1].join(top.select(TREE[0], F.col("budget").alias("above")), TREE[0]), [TREE[0]], TREE[1])
    low = split(levels[2].join(mid.select(*TREE[:2], F.col("budget").alias("above")), list(TREE[:2])), list(TREE[:2]), TREE[2])
    return leaves.join(low.select(*TREE, "budget"), list(TREE))


def _order(epoch: Column, seed: int, doc_id: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), epoch.cast("string"), doc_id.cast("string")))


def mix(docs: DataFrame, targets: Targets = TARGETS, domain=by_number, facts: bool = False) -> DataFrame:
    """The chosen documents, one row per epoch that holds them; with facts also domain, epoch and n_tokens."""
    work = Workspace(docs.sparkSession, "mixing")
    text = lambda c: F.coalesce(c, F.lit(""))
    path = {"_domain": domain(text(F.col("source"))), "_lang": text(F.col("lang")), "_source": text(F.col("source"))}
    slim = docs.select("doc_id", *(c.alias(n) for n, c in path.items()), F.size(words(F.col("text"))).cast("long").alias("tokens"))
    slim = work.save(slim, "slim")
    leaves = work.save(slim.groupBy(*TREE).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")), "leaves")
    plan = budgets(leaves, targets).withColumn("whole", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens") + 1e-9)).otherwise(F.lit(0)).cast("long"))
    plan = plan.withColumn("rest", F.greatest(F.lit(0.0), F.col("budget") - F.col("whole") * F.col("tokens")))
    plan = work.save(plan, "plan")
    few = plan.count() <= FEW_LEAVES
    meet = lambda rows, plan: rows.join(F.broadcast(plan.drop("n")), list(TREE)) if few else match_counted(rows, plan, list(TREE), "n").drop("n")
    own = meet(slim, plan.select(*TREE, "n", "whole", "rest")).withColumn("h", _order(F.col("whole"), targets.seed, F.col("doc_id")))
    own = work.save(own.select(*TREE, "doc_id", "tokens", "rest", "h"), "order")
    # at: the slice that the prefix ends in, level by level; before: the tokens of the order up to it.
    here, cut = own.withColumns({"at": F.lit(""), "before": F.lit(0).cast("long")}), None
    for depth in range(1, LEVELS + 1):
        inner = here if cut is None else meet(own, cut.select(*TREE, "n", "at", "before")).filter(F.col("h").startswith(F.col("at")))
        sums = inner.groupBy(*TREE, "rest", "before", F.substring("h", 1, SLICE * depth).alias("at")).agg(F.sum("tokens").alias("t"))
        end = F.col("before") + F.sum("t").over(W.partitionBy(*TREE).orderBy("at"))
        past = sums.withColumn("end", end).filter(F.col("end") > F.col("rest"))
        cut = work.save(past.groupBy(*TREE).agg(F.min(F.struct("at", (F.col("end") - F.col("t")).alias("before"))).alias("c")).join(plan.select(*TREE, "n"), list(TREE)).select(*TREE, "n", "c.*"), f"cut{depth}")
    edge = meet(own, cut.select(*TREE, "n", "at", "before")).filter(F.col("h").startswith(F.col("at"))).select(*TREE, "h", "tokens", "before", "rest").groupBy(*TREE, "h", "before", "rest").agg(F.sum("tokens").alias("t"))
    upto = F.sum("t").over(W.partitionBy(*TREE).orderBy("h")) + F.col("before")
    # The first place of the order that no longer fits; without one the whole epoch fits.
    stop = edge.withColumn("end", upto).filter(F.col("end") > F.col("rest")).groupBy(*TREE).agg(F.min("h").alias("stop"))
    plan = work.save(plan.join(stop, list(TREE), "left"), "stops")
    row = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("_id"), *(c.alias(n) for n, c in path.items()))
    here = meet(row, plan.select(*TREE, "n", "whole", "stop")).withColumn("h", _order(F.col("whole"), targets.seed, F.col("_id")))
    last = F.col("whole") - F.when(F.col("stop").isNull() | (F.col("h") < F.col("stop")), 0).otherwise(1)
    epochs = F.when(last >= 0, F.sequence(F.lit(0).cast("long"), last)).otherwise(F.array().cast("array<bigint>"))
    both = here.select("row", F.col("_domain").alias("domain"), F.explode(epochs).alias("epoch"))
    if not facts:
        return both.select("row.*")
    return both.select(*(F.col("row").getField(c).alias(c) for c in docs.columns if c not in FACTS), "domain", "epoch", F.size(words(F.col("row.text"))).cast("long").alias("n_tokens"))
