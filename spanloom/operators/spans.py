"""Span and tag algebra inside the row: higher-order functions, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import SPAN, VIOLATION

TAG = "^(O|[BI]-L[1-7])$"
OPEN = "^[BI]-."
TOKEN_CUT = r"[\p{L}\p{N}]"


def let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def indexes(x: Column) -> Column:
    return F.when(F.size(x) > 0, F.sequence(F.lit(0), F.size(x) - 1)).otherwise(F.array().cast("array<int>"))


def span(start: Column, end: Column, level: Column, text: Column, truncated: Column | None = None) -> Column:
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"), level.alias("level"), text.alias("text"), (F.lit(False) if truncated is None else truncated).alias("truncated"))


def invalid_tags(bio: Column) -> Column:
    return F.filter(indexes(bio), lambda i: ~F.get(bio, i).rlike(TAG))


def transition_errors(bio: Column) -> Column:
    """Positions of an I- tag whose predecessor has not its level; the predecessor counts as it stands."""

    def bad(i: Column) -> Column:
        tag, last = F.get(bio, i), F.coalesce(F.get(bio, i - 1), F.lit("O"))
        return tag.startswith("I-") & ~last.isin("O") & (F.substring(last, 3, 9) != F.substring(tag, 3, 9)) | (tag.startswith("I-") & (last == "O"))

    return F.filter(indexes(bio), bad)


def locate_tokens(text: Column, tokens: Column) -> Column:
    """Offsets <start,end> of tokens that follow each other with only white space between and after them; null if they don't."""
    zero = F.struct(F.lit(0).alias("at"), F.lit(True).alias("ok"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(a: Column, t: Column) -> Column:
        p = F.call_function("locate", t, text, a["at"] + 1)
        skipped = F.substring(text, a["at"] + 1, p - 1 - a["at"])
        ok = a["ok"] & (F.length(t) > 0) & (p > 0) & ~skipped.rlike(r"(?U)\S")
        return F.struct((p - 1 + F.length(t)).cast("int").alias("at"), ok.alias("ok"), F.concat(a["out"], F.array(F.struct((p - 1).cast("int").alias("start"), (p - 1 + F.length(t)).cast("int").alias("end")))).alias("out"))

    return F.aggregate(tokens, zero, step, lambda a: F.when(a["ok"] & ~F.substring(text, a["at"] + 1, F.length(text)).rlike(r"(?U)\S"), a["out"]))


def islands(tags: Column) -> Column:
    """Runs of a B- tag and the I- tags of its level after it: array<struct<first,last,level>>; a stray I- opens a run."""

    def opens(i: Column) -> Column:
        tag, last = F.get(tags, i), F.coalesce(F.get(tags, i - 1), F.lit("O"))
        return tag.rlike(OPEN) & (tag.startswith("B-") | ~last.rlike(OPEN) | (F.substring(last, 3, 9) != F.substring(tag, 3, 9)))

    def closes(i: Column) -> Column:
        tag, after = F.get(tags, i), F.coalesce(F.get(tags, i + 1), F.lit("O"))
        return tag.rlike(OPEN) & (after.startswith("B-") | ~after.rlike(OPEN) | (F.substring(after, 3, 9) != F.substring(tag, 3, 9)))

    pairs = F.arrays_zip(F.filter(indexes(tags), opens).alias("first"), F.filter(indexes(tags), closes).alias("last"))
    return F.transform(pairs, lambda p: F.struct(p["first"].alias("first"), p["last"].alias("last"), F.substring(F.get(tags, p["first"]), 3, 9).alias("level")))


def spans_from_bio(text: Column, tokens: Column, bio: Column) -> Column:
    """Spans of a tagged text; null if its tokens can't be located or are not as many as its tags."""
    build = lambda at: F.transform(islands(bio), lambda s: let(F.struct(F.get(at, s["first"])["start"].alias("a"), F.get(at, s["last"])["end"].alias("b")), lambda o: span(o["a"], o["b"], s["level"], F.substring(text, o["a"] + 1, o["b"] - o["a"]))))
    return let(locate_tokens(text, tokens), lambda at: F.when(at.isNotNull() & (F.size(tokens) == F.size(bio)), build(at)))


def tokens_and_bio(text: Column, spans: Column) -> tuple[Column, Column]:
    """Tokens cut at span edges, white space and every other non-alphanumeric character, and their tags.

    The first span that covers a token owns it."""
    n = F.length(text)
    char = lambda i: F.substring(text, i + 1, F.lit(1))
    plain = lambda i: char(i).rlike(TOKEN_CUT)
    chars = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    inner = F.flatten(F.transform(F.filter(chars, lambda i: ~plain(i)), lambda i: F.array(i, i + 1)))
    edges = F.flatten(F.transform(spans, lambda s: F.array(s["start"], s["end"])))
    cuts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0), n), inner, edges)))
    pieces = let(cuts, lambda c: F.transform(F.slice(c, F.lit(1), F.greatest(F.lit(0), F.size(c) - 1)), lambda a, k: F.struct(a.alias("a"), F.get(c, k + 1).alias("b"))))
    pieces = F.filter(pieces, lambda p: F.substring(text, p["a"] + 1, p["b"] - p["a"]).rlike(r"(?U)\S"))

    def tag(p: Column) -> Column:
        owner = F.get(F.filter(spans, lambda s: (s["start"] <= p["a"]) & (s["end"] >= p["b"])), F.lit(0))
        return F.when(owner.isNull(), F.lit("O")).when(owner["start"] == p["a"], F.concat(F.lit("B-"), owner["level"])).otherwise(F.concat(F.lit("I-"), owner["level"]))

    return F.transform(pieces, lambda p: F.substring(text, p["a"] + 1, p["b"] - p["a"])), F.transform(pieces, tag)


def occurrences(text: Column, needle: Column) -> Column:
    """Starts of all occurrences, overlapping ones too."""
    k = F.length(needle)
    at = F.when((k > 0) & (F.length(text) >= k), F.sequence(F.lit(0), F.length(text) - k)).otherwise(F.array().cast("array<int>"))
    return F.filter(at, lambda i: F.substring(text, i + 1, k) == needle)


def place_spans(text: Column, spans: Column) -> Column:
    """struct<spans,hard,soft>: spans that fit stay; then, in order, the others move to their only free occurrence or are
    reported. A repaired span occupies its place for those after it, hence the fold."""
    none = F.lit(None)
    note = lambda rule, s, fixed=none: F.struct(F.lit(rule).alias("rule"), s["level"].alias("level"), s["text"].alias("text"), s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end"), fixed.cast("int").alias("fixed_start"))
    known = lambda s: F.coalesce(s["level"].rlike("^L[1-7]$"), F.lit(False))
    named = lambda s: F.coalesce(F.length(s["text"]) > 0, F.lit(False))
    fits = lambda s: F.coalesce((s["start"] >= 0) & (s["start"] < s["end"]) & (s["end"] <= F.length(text)) & (F.substring(text, s["start"] + 1, s["end"] - s["start"]) == s["text"]), F.lit(False))
    as_span = lambda s: span(s["start"], s["end"], s["level"], s["text"], s["truncated"])
    notes = lambda x: x.cast(f"array<{VIOLATION}>")
    bad = F.filter(spans, lambda s: ~known(s) | ~named(s))
    zero = F.struct(
        F.transform(F.filter(spans, lambda s: known(s) & fits(s)), as_span).cast(f"array<{SPAN}>").alias("spans"),
        notes(F.transform(bad, lambda s: F.when(known(s), note("span_empty", s)).otherwise(note("level_invalid", s)))).alias("hard"),
        F.array().cast(f"array<{VIOLATION}>").alias("soft"),
    )

    def step(a: Column, s: Column) -> Column:
        free = F.filter(occurrences(text, s["text"]), lambda i: ~F.exists(a["spans"], lambda t: (i < t["end"]) & (i + F.length(s["text"]) > t["start"])))

        def place(f: Column) -> Column:
            at = F.get(f, F.lit(0))
            state = lambda spans, hard, soft: F.struct(spans.alias("spans"), hard.alias("hard"), soft.alias("soft"))
            wrong = lambda rule: state(a["spans"], F.concat(a["hard"], notes(F.array(note(rule, s)))), a["soft"])
            moved = span(at, at + F.length(s["text"]), s["level"], s["text"], s["truncated"])
            good = state(F.concat(a["spans"], F.array(moved).cast(f"array<{SPAN}>")), a["hard"], F.concat(a["soft"], notes(F.array(note("offset_repaired", s, at)))))
            return F.when(F.size(f) == 1, good).when(F.size(f) == 0, wrong("text_not_in_input")).otherwise(wrong("offset_ambiguous"))

        return let(free, place)

    def crossed(a: Column) -> Column:
        order = F.array_sort(a["spans"])
        hits = F.filter(F.transform(order, lambda s, i: F.struct(s.alias("s"), F.get(order, i - 1).alias("p"))), lambda x: x["p"].isNotNull() & (x["p"]["end"] > x["s"]["start"]))
        return F.struct(order.alias("spans"), F.concat(a["hard"], notes(F.transform(hits, lambda x: note("overlap", x["s"])))).alias("hard"), a["soft"].alias("soft"))

    return F.aggregate(F.filter(spans, lambda s: known(s) & named(s) & ~fits(s)), zero, step, crossed)


def validate_spans(text: Column, spans: Column) -> Column:
    """struct<spans,hard,soft>: spans in order, each kept, repaired to its only free occurrence, or reported.

    A repaired span occupies its place for those after it, hence the fold. One pass in the order given, with rule names
    of its own; place_spans settles the spans that fit before it repairs any."""
    none = F.lit(None)
    zero = F.struct(F.array().cast(f"array<{SPAN}>").alias("spans"), F.array().cast(f"array<{VIOLATION}>").alias("hard"), F.array().cast(f"array<{VIOLATION}>").alias("soft"))
    note = lambda rule, s, fixed=none: F.struct(F.lit(rule).alias("rule"), s["level"].alias("level"), s["text"].alias("text"), s["start"].cast("int").alias("start"), s["end"].cast("int").alias("end"), fixed.cast("int").alias("fixed_start"))

    def step(a: Column, s: Column) -> Column:
        free = F.filter(occurrences(text, s["text"]), lambda i: ~F.exists(a["spans"], lambda t: (i < t["end"]) & (i + F.length(s["text"]) > t["start"])))

        def place(f: Column) -> Column:
            fits = (s["start"] >= 0) & (s["end"] <= F.length(text)) & (F.substring(text, s["start"] + 1, s["end"] - s["start"]) == s["text"])
            add = lambda x: F.concat(a["spans"], F.array(x))
            keep = lambda spans, hard, soft: F.struct(spans.alias("spans"), hard.alias("hard"), soft.alias("soft"))
            bad = lambda rule: keep(a["spans"], F.concat(a["hard"], F.array(note(rule, s))), a["soft"])
            fixed = F.get(f, F.lit(0))
            return (
                F.when(~s["level"].rlike("^L[1-7]$"), bad("level_invalid"))
                .when(F.length(s["text"]) == 0, bad("span_empty"))
                .when(fits, keep(add(span(s["start"], s["end"], s["level"], s["text"], s["truncated"])), a["hard"], a["soft"]))
                .when(F.size(f) == 1, keep(add(span(fixed, fixed + F.length(s["text"]), s["level"], s["text"], s["truncated"])), a["hard"], F.concat(a["soft"], F.array(note("offset_fixed", s, fixed)))))
                .when(F.size(f) == 0, bad("span_not_in_input"))
                .otherwise(bad("offset_ambiguous"))
            )

        return let(free, place)

    def crossed(a: Column) -> Column:
        order = F.array_sort(a["spans"])
        hits = F.filter(F.transform(order, lambda s, i: F.struct(s.alias("s"), F.get(order, i - 1).alias("p"))), lambda x: x["p"].isNotNull() & (x["p"]["end"] > x["s"]["start"]))
        return F.struct(order.alias("spans"), F.concat(a["hard"], F.transform(hits, lambda x: note("span_overlap", x["s"]))).alias("hard"), a["soft"].alias("soft"))

    return F.aggregate(spans, zero, step, crossed)


def validate_bio(text: Column, tokens: Column, bio: Column, spans: Column) -> Column:
    """Soft rules that a tagged text breaks, by name; unequal numbers of tokens and tags are the only one reported."""
    got = spans_from_bio(text, tokens, bio)
    plain = lambda x: F.array_sort(F.transform(x, lambda s: F.struct(s["start"], s["end"], s["level"])))
    rest = F.array_compact(F.array(
        F.when(F.size(invalid_tags(bio)) > 0, "tag_invalid"),
        F.when(F.size(transition_errors(bio)) > 0, "iob2_transition"),
        F.when(locate_tokens(text, tokens).isNull(), "tokens_not_in_input"),
        F.when(got.isNotNull() & (plain(got) != plain(spans)), "bio_spans_mismatch"),
    ))
    return F.when(F.size(tokens) != F.size(bio), F.array(F.lit("length_mismatch"))).otherwise(rest)


def validate_parse(text: Column, tokens: Column, bio: Column, spans: Column) -> Column:
    """struct<ok,spans,hard,soft,bio>: ok without a hard violation; tags are held against the repaired spans."""
    build = lambda v: F.struct((F.size(v["hard"]) == 0).alias("ok"), v["spans"].alias("spans"), v["hard"].alias("hard"), v["soft"].alias("soft"), validate_bio(text, tokens, bio, v["spans"]).alias("bio"))
    return let(place_spans(text, spans), build)


def split_longest(spans: Column) -> Column:
    """The longest span that holds a space, cut at its first space into two of its level."""
    spaced = F.filter(spans, lambda s: F.contains(s["text"], F.lit(" ")))
    longest = F.array_max(F.transform(spaced, lambda s: F.struct(F.length(s["text"]).alias("n"), (-s["start"]).alias("back"), s.alias("s"))))["s"]

    def halves(s: Column) -> Column:
        k = F.instr(s["text"], F.lit(" "))
        left = span(s["start"], s["start"] + k - 1, s["level"], F.substring(s["text"], F.lit(1), k - 1))
        right = span(s["start"] + k, s["end"], s["level"], F.substring(s["text"], k + 1, F.length(s["text"])))
        return F.array_sort(F.concat(F.filter(spans, lambda t: t["start"] != s["start"]), F.array(left, right)))

    return F.when(longest.isNull(), spans).otherwise(let(longest, halves))
