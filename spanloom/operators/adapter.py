"""Adapter from a foreign tag set to spans of levels: rules over arrays of <token,label>, each a fold inside the row.

Labels are `B_X`, `I_X`, `NUMBER`, `..._TYPE` or others, which stand for no entity. `@@` ends a token that the next one
continues without a space.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import bare_place, fold, plain_key, undo_bpe
from .spans import let

#: Which entity a type word opens, the level of an entity, words that belong to the name after them, names
#: of the country.
TYPES = {"STREET_TYPE": "STREET", "WARD_TYPE": "WARD", "DIST_TYPE": "DIST", "CITY_TYPE": "CITY", "PRO_TYPE": "PRO", "NUMBER_TYPE": "NUMBER"}
LEVEL_OF = {"STREET": "L5", "WARD": "L4", "DIST": "L3", "CITY": "L2", "PRO": "L2", "NUMBER": "L6"}
PREFIXES = ("thành", "phố", "tp", "tp.", "tỉnh", "quận", "q", "q.", "huyện", "phường", "p", "p.", "xã", "x", "x.", "thị", "trấn", "đường", "số", "ngõ", "ngách", "hẻm", "lô", "khu")
COUNTRY = ("viet nam", "vietnam", "vn")

PAIRS = "array<struct<token:string,label:string>>"


def _map(table: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in table.items() for x in kv))


def _entity(label: Column) -> Column:
    """The entity of a B_ or I_ label, null for other labels and entities without a level."""
    return F.when(label.rlike(f"^[BI]_(?:{'|'.join(LEVEL_OF)})$"), F.substring(label, 3, 99))


def _pair(token: Column, label: Column) -> Column:
    return F.struct(token.alias("token"), label.alias("label"))


def _scan(pairs: Column, relabel) -> Column:
    """Folds from left to right: relabel(the pair before as it came out, the pair) is a pair's new label."""
    last = lambda a: F.get(a, F.size(a) - 1)
    return F.aggregate(pairs, F.array().cast(PAIRS), lambda a, p: F.concat(a, F.array(_pair(p["token"], relabel(last(a), p)))))


def continue_words(pairs: Column) -> Column:
    """A token after one that ends in @@ has its entity or number, unless it is punctuation alone."""

    def relabel(last: Column, p: Column) -> Column:
        glued = F.coalesce(last["token"].endswith("@@"), F.lit(False)) & ~p["token"].rlike(r"(?U)^[^\w]+$")
        return F.when(glued & _entity(last["label"]).isNotNull(), F.concat(F.lit("I_"), _entity(last["label"]))).when(glued & (last["label"] == "NUMBER"), "NUMBER").otherwise(p["label"])

    return _scan(pairs, relabel)


def repair_starts(pairs: Column) -> Column:
    """An I_ label whose predecessor has not its entity becomes B_."""
    follows = lambda last, p: F.coalesce(F.substring(last["label"], 3, 99) == F.substring(p["label"], 3, 99), F.lit(False))
    return _scan(pairs, lambda last, p: F.when(p["label"].startswith("I_") & ~follows(last, p), F.concat(F.lit("B_"), F.substring(p["label"], 3, 99))).otherwise(p["label"]))


def absorb_prefixes(pairs: Column, prefixes: tuple[str, ...] = PREFIXES) -> Column:
    """From right to left, a prefix word joins the entity after it."""
    word = lambda p: F.rtrim(F.lower(undo_bpe(p["token"])), F.lit(","))

    def step(a: Column, p: Column) -> Column:  # a: the pairs after p, nearest first
        after = F.get(a, F.lit(0))
        entity = _entity(after["label"])
        joins = F.coalesce(word(p).isin(*prefixes) & entity.isNotNull(), F.lit(False))
        inner = F.concat(F.lit("I_"), entity)
        opened = F.concat(F.array(_pair(p["token"], after["label"]), _pair(after["token"], inner)), F.slice(a, F.lit(2), F.greatest(F.size(a) - 1, F.lit(0))))
        begun = F.concat(F.array(_pair(p["token"], F.concat(F.lit("B_"), entity))), a)
        return F.when(joins & after["label"].startswith("B_"), opened).when(joins & (p["label"] != inner), begun).otherwise(F.concat(F.array(p), a))

    return F.aggregate(F.reverse(pairs), F.array().cast(PAIRS), step)


def merge_types(pairs: Column) -> Column:
    """A type word begins its entity, and a B_ of it right after goes on."""

    def relabel(last: Column, p: Column) -> Column:
        goes_on = F.coalesce(last["typed"] & (p["label"] == last["label"]), F.lit(False))
        own = F.try_element_at(_map(TYPES), p["label"])
        return F.when(goes_on, F.concat(F.lit("I_"), F.substring(p["label"], 3, 99))).when(own.isNotNull(), F.concat(F.lit("B_"), own)).otherwise(p["label"])

    kind = "array<struct<token:string,label:string,typed:boolean>>"
    step = lambda a, p: F.concat(a, F.array(F.struct(p["token"].alias("token"), relabel(F.get(a, F.size(a) - 1), p).alias("label"), F.try_element_at(_map(TYPES), p["label"]).isNotNull().alias("typed"))))
    return F.aggregate(pairs, F.array().cast(kind), step, lambda a: F.transform(a, lambda p: _pair(p["token"], p["label"])))


def entity_spans(pairs: Column) -> Column:
    """<level,text> of runs of one entity; numbers go on with a house number or begin one."""
    part = lambda t: F.when(t.endswith("@@"), undo_bpe(t)).otherwise(F.concat(t, F.lit(" ")))
    runs = "array<struct<level:string,text:string>>"
    zero = F.struct(F.array().cast(runs).alias("done"), F.lit(None).cast("struct<level:string,text:string>").alias("open"))
    closed = lambda a: F.when(a["open"].isNotNull(), F.concat(a["done"], F.array(a["open"]))).otherwise(a["done"])
    state = lambda done, run: F.struct(done.alias("done"), run.alias("open"))
    run = lambda level, text: F.struct(level.alias("level"), text.alias("text"))

    def step(a: Column, p: Column) -> Column:
        level = F.try_element_at(_map(LEVEL_OF), _entity(p["label"]))
        grown = state(a["done"], run(a["open"]["level"], F.concat(a["open"]["text"], part(p["token"]))))
        number, same = p["label"] == "NUMBER", F.coalesce(a["open"]["level"] == level, F.lit(False))
        at_number = F.coalesce(a["open"]["level"] == "L6", F.lit(False))
        return (
            F.when((number & at_number) | (p["label"].startswith("I_") & same), grown)
            .when(number, state(closed(a), run(F.lit("L6"), part(p["token"]))))
            .when(p["label"].startswith("B_") & level.isNotNull(), state(closed(a), run(level, part(p["token"]))))
            .otherwise(state(closed(a), F.lit(None).cast("struct<level:string,text:string>")))
        )

    return F.aggregate(pairs, zero, step, closed)


def relabel_places(spans: Column, provinces: list[str], country: tuple[str, ...] = COUNTRY) -> Column:
    """Names of the country are L1, names of provinces found as L3 or L4 are L2."""
    known = lambda name, table: name.isin(*table) if table else F.lit(False)
    level = lambda s: F.when(known(fold(s["text"]), country), "L1").when(s["level"].isin("L3", "L4") & known(F.trim(bare_place(fold(s["text"]))), provinces), "L2").otherwise(s["level"])
    return F.transform(spans, lambda s: F.struct(level(s).alias("level"), s["text"].alias("text")))


def adapted(pairs: Column, provinces: list[str]) -> Column:
    """All rules in their order; texts are left as joined, `tidy` makes them comparable."""
    rules = (continue_words, repair_starts, absorb_prefixes, merge_types)
    out = pairs.cast(PAIRS)
    for rule in rules:
        out = rule(out)
    return let(entity_spans(out), lambda s: relabel_places(s, provinces))


def tidy(text: Column) -> Column:
    """The comparable form of a span's text; a column of its own, as NFC needs Python and can't stand in a lambda."""
    return plain_key(text)
