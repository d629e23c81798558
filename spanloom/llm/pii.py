"""Personal data and secrets by weak supervision.

Base spans (email, ip, card, phone) come from fixed patterns with their checks and always stay. Further spans of kind
`secret` are added: candidate tokens are judged by regex, gazetteer and context labelers, which vote 1, 0 or abstain.
Expectation-maximisation over the votes estimates each labeler's reliability without labels; the posteriors then train
a logistic span classifier over votes and shape, and candidates it accepts are added where no base span lies.

Everything on the rows is DataFrame expressions. What leaves the cluster is the count of each pattern of votes and
shape bits, at most 3^6 * 2^3 rows whatever the corpus; EM and the classifier's fit run over these counts.

Defined results: a null or empty text has no spans; the sha256 of no spans is that of the empty string; repeated rows are
judged each for itself; an empty table gives no rows, and a model that adds nothing; extra columns are kept by
`find`, but for those named like a kind; a text of any length is searched whole, in time linear in it.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

#: The base patterns. Java's possessive loops match what the plain ones do here and use no stack. A match
#: from inside a run goes on like one from the run's start, so only starts of runs (or ends of matches) are tried.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "phone": "+", "ip": "."}
KINDS = (*BASE, "secret")
CANDIDATE = r"[A-Za-z0-9_/+=-]{16,}+"
#: Gazetteer of names that secrets are stored under, and of prefixes that issuers put on keys.
NAMES = "password|passwd|pwd|secret|token|api_?key|access_?key|auth|bearer|credential"
PREFIXES = "AKIA|ASIA|ghp_|gho_|sk-|xoxb-|xoxp-|eyJ"
SHAPED = f"^(?:{PREFIXES})[A-Za-z0-9_-]{{12,}}$"
NAMED = f"(?:{NAMES})[\\s\"':=]*$"
OWN = f"(?i)^(?:{NAMES})="
BEFORE = 24
LABELERS = ("key_shape", "hex_run", "own_name", "name_before", "mixed", "harmless_before")
SHAPES = ("long", "upper_and_digit", "many_digits")


def _luhn(m: Column) -> Column:
    d = F.regexp_replace(m, "[^0-9]", "")
    return let(d, lambda x: F.length(x).between(13, 19) & F.call_function("luhn_check", x))


def _octets(m: Column) -> Column:
    def fits(x: Column) -> Column:
        bare = F.ltrim(x, F.lit("0"))
        return (F.length(bare) <= 2) | ((F.length(bare) == 3) & (bare <= "255"))

    return F.forall(F.split(m, r"\.", -1), fits)


def _digits(m: Column) -> Column:
    return F.length(F.regexp_replace(m, "[^0-9]", "")).between(9, 15)


CHECKS = {"ip": _octets, "card": _luhn, "phone": _digits}


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as array<struct<start,end,m>> in code points, end exclusive.

    The pieces between matches (split) and the matches themselves alternate, so their lengths add up to positions."""
    empty = F.array().cast("array<struct<start:int,end:int,m:string>>")

    def place(found: Column) -> Column:
        def step(a: Column, i: Column, gaps: Column) -> Column:
            start = a["at"] + F.length(F.get(gaps, i))
            end = start + F.length(F.get(found, i))
            return F.struct(end.alias("at"), F.concat(a["out"], F.array(F.struct(start.alias("start"), end.alias("end"), F.get(found, i).alias("m")))).alias("out"))

        zero = F.struct(F.lit(0).alias("at"), empty.alias("out"))
        run = let(F.split(text, pattern, -1), lambda gaps: F.aggregate(F.sequence(F.lit(0), F.size(found) - 1), zero, lambda a, i: step(a, i, gaps), lambda a: a["out"]))
        return F.when(F.size(found) == 0, empty).otherwise(run)

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), place)


def _filtered(spans: Column, check: Callable[[Column], Column]) -> Column:
    return F.filter(spans, lambda s: check(s["m"]))


def _named(spans: Column, kind: str, name: Callable[[Column, str], Column]) -> Column:
    return F.transform(spans, lambda s: name(s, kind))


def base_spans(text: Column) -> dict[str, Column]:
    out = {}
    for kind, pattern in BASE.items():
        found = matches(text, pattern)
        if kind in CHECKS:
            found = _filtered(found, CHECKS[kind])
        need = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else text.rlike("[0-9]")
        out[kind] = F.when(need, found).otherwise(F.array().cast("array<struct<start:int,end:int,m:string>>"))
    return out


def candidates(text: Column) -> Column:
    """Long tokens of letters and digits, of an issuer's shape or named as a credential, with the text before each."""
    found = F.transform(matches(text, CANDIDATE), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["m"].alias("m"), F.lower(F.substring(text, F.greatest(F.lit(1), s["start"] - BEFORE + 1), F.least(F.lit(BEFORE), s["start"]))).alias("before")))
    return F.filter(found, lambda c: (c["m"].rlike("[0-9]") & c["m"].rlike("[A-Za-z]")) | c["m"].rlike(SHAPED) | c["before"].rlike(NAMED) | c["m"].rlike(OWN))


def votes(c: Column) -> dict[str, Column]:
    m, before, none = c["m"], c["before"], F.lit(None).cast("int")
    shaped = m.rlike(SHAPED)
    few_digits = ~shaped & (F.length(F.regexp_replace(m, "[^0-9]", "")) < 3)
    mixed = F.length(F.regexp_replace(m, "[A-Za-z_/+=-]*([0-9]+)", "x")) >= 3
    return {
        "key_shape": F.when(shaped, 1).otherwise(none),
        "hex_run": F.when(m.rlike("(?:^|[^A-Za-z0-9])[0-9a-f]{16,}$") & ~few_digits, 1).when(few_digits, 0).otherwise(none),
        "own_name": F.when(m.rlike(OWN), 1).otherwise(none),
        "name_before": F.when(before.rlike(NAMED), 1).otherwise(none),
        "mixed": F.when(mixed, 1).when(shaped, none).otherwise(0),
        "harmless_before": F.when(before.rlike(r"(?:https?:|www\.|commit|version|isbn|doi)\S*\s*$") | m.contains("//"), 0).otherwise(none),
    }


def shapes(c: Column) -> dict[str, Column]:
    m = c["m"]
    return {"long": (F.length(m) >= 20).cast("int"), "upper_and_digit": m.rlike("^[A-Z0-9]+$").cast("int"), "many_digits": (F.length(F.regexp_replace(m, "[^0-9]", "")) >= 4).cast("int")}


@dataclass(frozen=True)
class Model:
    """weights: per feature; reliabilities: per labeler P(vote 1 | secret) and P(vote 1 | not), as EM left them."""

    bias: float
    weights: dict[str, float]
    reliabilities: dict[str, tuple[float, float]]


def _features(row: dict) -> dict[str, float]:
    x = {n: float(row[n]) for n in SHAPES}
    for n in LABELERS:
        x[f"{n}=1"], x[f"{n}=0"] = float(row[n] == 1), float(row[n] == 0)
    return x


def fit_counts(rows: list[dict], rounds: int = 50, steps: int = 300) -> Model:
    """EM, then the classifier, over counted patterns: dicts of LABELERS (1, 0, None), SHAPES (0, 1) and n."""
    names = [*(f"{n}={v}" for n in LABELERS for v in (1, 0)), *SHAPES]
    if not rows:
        return Model(-10.0, dict.fromkeys(names, 0.0), dict.fromkeys(LABELERS, (0.5, 0.5)))
    total = sum(r["n"] for r in rows)
    scale = 1000 / total if total > 1000 else 1.0  # pseudo-counts keep their share, however large the corpus
    prior, hit, false = 0.5, dict.fromkeys(LABELERS, 0.85), dict.fromkeys(LABELERS, 0.15)
    post = [0.5] * len(rows)
    for _ in range(rounds):
        for k, r in enumerate(rows):
            z = math.log(prior / (1 - prior))
            for n in LABELERS:
                if r[n] is not None:
                    z += math.log(hit[n] / false[n]) if r[n] else math.log((1 - hit[n]) / (1 - false[n]))
            post[k] = 1 / (1 + math.exp(-max(-30, min(30, z))))
        weight = [r["n"] * scale for r in rows]
        prior = (2 + sum(w * p for w, p in zip(weight, post, strict=True))) / (4 + sum(weight))
        for n in LABELERS:
            seen = [(w, p, r[n]) for w, p, r in zip(weight, post, rows, strict=True) if r[n] is not None]
            # Beta pseudo-counts and a floor: a labeler may be weak but not worse than chance, so the classes can't swap.
            hit[n] = max(0.55, (8.5 + sum(w * p for w, p, v in seen if v)) / (10 + sum(w * p for w, p, _ in seen)))
            false[n] = min(0.45, (1.5 + sum(w * (1 - p) for w, p, v in seen if v)) / (10 + sum(w * (1 - p) for w, p, _ in seen)))
    xs, bias, weights = [_features(r) for r in rows], 0.0, dict.fromkeys(names, 0.0)
    weight = [r["n"] * scale for r in rows]
    for _ in range(steps):
        gb, gw = 0.0, dict.fromkeys(names, 0.0)
        for x, w, p in zip(xs, weight, post, strict=True):
            z = bias + sum(weights[n] * x[n] for n in names)
            e = w * (1 / (1 + math.exp(-max(-30, min(30, z)))) - p)
            gb += e
            for n in names:
                gw[n] += e * x[n]
        rate = 2.0 / sum(weight)
        bias -= rate * gb
        for n in names:
            weights[n] -= rate * (gw[n] + 0.01 * weights[n])
    return Model(bias, weights, {n: (hit[n], false[n]) for n in LABELERS})


def fit(docs: DataFrame) -> Model:
    """Counts vote patterns over all documents and fits the model to the counts."""
    text = F.coalesce("text", F.lit(""))
    c = docs.select(F.explode(candidates(text)).alias("c"))
    flags = c.select(*(v.alias(n) for n, v in (votes(F.col("c")) | shapes(F.col("c"))).items()))
    counts = flags.groupBy(*LABELERS, *SHAPES).agg(F.count("*").alias("n"))
    rows = sorted((r.asDict() for r in counts.collect()), key=str)
    return fit_counts(rows)


def secret_spans(text: Column, base: list[Column], model: Model) -> Column:
    """Candidates that the model accepts and no base span overlaps; a leading `name=` is not part of the span."""

    def accepted(c: Column) -> Column:
        z = F.lit(model.bias)
        v, s = votes(c), shapes(c)
        for n in LABELERS:
            z = z + F.when(v[n] == 1, model.weights[f"{n}=1"]).when(v[n] == 0, model.weights[f"{n}=0"]).otherwise(0.0)
        for n in SHAPES:
            z = z + s[n] * F.lit(model.weights[n])
        return z >= 0

    def clear(c: Column) -> Column:
        out = F.lit(True)
        for b in base:
            out = out & ~F.exists(b, lambda s: (s["start"] < c["end"]) & (s["end"] > c["start"]))
        return out

    def trimmed(c: Column) -> Column:
        skip = F.length(F.regexp_extract(c["m"], f"(?i)^(?:(?:{NAMES})=)?", 0))
        return F.struct((c["start"] + skip).alias("start"), c["end"].alias("end"), F.substring(c["m"], skip + 1, F.length(c["m"])).alias("m"))

    return F.transform(F.filter(candidates(text), lambda c: clear(c) & accepted(c)), trimmed)


def find(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs with one array of spans <start,end,m> per kind: email, ip, card, phone, secret."""
    model = model or fit(docs)
    text = F.coalesce("text", F.lit(""))
    row = docs.select(F.struct("*").alias("row"), text.alias("t"))
    base = row.select("row", "t", F.struct(*(s.alias(k) for k, s in base_spans(F.col("t")).items())).alias("b"))
    full = base.select("row", "b", secret_spans(F.col("t"), [F.col(f"b.{k}") for k in BASE], model).alias("secret"))
    own = (F.col("row").getField(c).alias(c) for c in docs.columns if c not in KINDS)
    return full.select(*own, *(F.col(f"b.{k}").alias(k) for k in BASE), "secret")


def joined(kinds: tuple[str, ...]) -> Column:
    """`kind:start:end` of the spans of some kinds in the order given, then by start, comma-joined."""
    parts = [_named(F.col(k), k, lambda s, k: F.concat_ws(":", F.lit(k), s["start"].cast("string"), s["end"].cast("string"))) for k in kinds]
    return F.array_join(F.concat(*parts), ",")


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs with every span replaced by `[kind]`; spans that overlap count as the one that starts first."""
    found = find(docs.select(F.struct("*").alias("doc"), "text"), model)
    spans = F.array_sort(F.concat(*(_named(F.col(k), k, lambda s, k: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(k).alias("kind"))) for k in KINDS)))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    step = lambda a, s: F.when(s["start"] < a["at"], a).otherwise(F.struct(s["end"].alias("at"), F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, s["start"] - a["at"]), F.lit("["), s["kind"], F.lit("]")).alias("out")))
    text = F.aggregate(spans, zero, step, lambda a: F.concat(a["out"], F.substring(F.col("text"), a["at"] + 1, F.length("text"))))
    return found.select(F.col("doc").withField("text", F.when(F.col("text").isNotNull(), text)).alias("doc")).select("doc.*")
