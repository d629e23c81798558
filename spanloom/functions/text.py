"""Text functions as Column expressions. NFC alone needs Python: no built-in normalizes Unicode."""

from __future__ import annotations

import unicodedata
from functools import cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: unicodedata.normalize("NFC", x), na_action="ignore")


def nfc(x: Column) -> Column:
    """NFC form. Text of ASCII characters only is NFC already and never leaves the JVM's result."""
    return F.when(x.rlike(r"[^\x00-\x7f]"), _nfc(x)).otherwise(x)


@cache
def mark_table() -> tuple[str, str]:
    """Letters of U+00C0..U+1EF9 that decompose into a base and marks, and their bases; đ and Đ by hand."""
    pairs = {"đ": "d", "Đ": "D"}
    for code in range(0xC0, 0x1EFA):
        base = "".join(c for c in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(c) != "Mn")
        if len(base) == 1 and base != chr(code):
            pairs[chr(code)] = base
    return "".join(pairs), "".join(pairs.values())


#: Combining marks of the five Vietnamese tones in the order of their code points, numbered from 1.
TONES = ("\u0300", "\u0301", "\u0303", "\u0309", "\u0323")


@cache
def tone_tables() -> tuple[str, str, str]:
    """Toned letters, the same without their tone (circumflex, breve and horn stay), and the tones' digits."""
    src, plain, digit = "", "", ""
    for code in range(0xC0, 0x1EFA):
        parts = unicodedata.normalize("NFD", chr(code))
        tone = [c for c in parts if c in TONES]
        rest = unicodedata.normalize("NFC", "".join(c for c in parts if c not in TONES))
        if len(tone) == 1 and len(rest) == 1:
            src, plain, digit = src + chr(code), plain + rest, digit + str(TONES.index(tone[0]) + 1)
    return src, plain, digit


def strip_marks(x: Column) -> Column:
    src, dst = mark_table()
    return F.regexp_replace(F.translate(x, src, dst), r"\p{Mn}+", "")


def squeeze(x: Column) -> Column:
    return F.regexp_replace(x, r"(?U)\s+", " ")


def match_key(x: Column, normalize: bool = True) -> Column:
    """Comparison key of an entity: NFC, lower case, single spaces, no outer punctuation."""
    return F.btrim(squeeze(F.lower(nfc(x) if normalize else x)), F.lit(" ,.;:-"))


def fold(x: Column) -> Column:
    """Lower case without marks; anything but word characters, spaces and dots becomes a space."""
    return F.trim(squeeze(F.regexp_replace(strip_marks(F.lower(x)), r"(?U)[^\w\s.]", " ")))


def bare_place(x: Column) -> Column:
    """A folded place name without a leading word for city or province."""
    return F.regexp_replace(x, r"^(tp\.?|thanh pho|tinh|t\.)\s+", "")


def group_key(x: Column) -> Column:
    return F.trim(F.regexp_replace(strip_marks(F.lower(nfc(x))), r"(?U)[^\w/]+", " "))


def canon(token: Column) -> Column:
    """A token with its tone as a trailing digit, wherever the tone was written (hoà and hòa alike)."""
    src, plain, digit = tone_tables()
    tone = F.regexp_extract(F.translate(F.regexp_replace(token, f"[^{src}]", ""), src, digit), "^[1-5]", 0)
    return F.concat(F.translate(token, src, plain), tone)


def plain_key(x: Column) -> Column:
    """NFC, lower case, single spaces, none outside; punctuation stays."""
    return F.trim(squeeze(F.lower(nfc(x))))


def letters_only(x: Column) -> Column:
    """Maximal runs of letters (and letter-like numbers) of the lower-cased text."""
    return F.regexp_extract_all(F.lower(x), F.lit(r"[\p{L}\p{Nl}\p{No}]+"), F.lit(0))


def has_diacritic(x: Column) -> Column:
    return strip_marks(x) != x


def undo_bpe(x: Column) -> Column:
    return F.regexp_replace(x, "@@$", "")


def markdown_cell(x: Column) -> Column:
    return F.regexp_replace(F.replace(x, F.lit("|"), F.lit(r"\|")), r"\r?\n", " ")


#: Address abbreviations and what they stand for; the last four count only before a dot or a digit.
ABBREVIATIONS = {"kp": "khu phố", "tp": "thành phố", "kdc": "khu dân cư", "kđt": "khu đô thị", "kdt": "khu đô thị", "kcn": "khu công nghiệp", "sn": "số nhà"}
LETTERS = {"p": "phường", "f": "phường", "q": "quận", "h": "huyện"}


def expand(line: Column) -> Column:
    """Abbreviations written out, in title case where they began with a capital; a line without any stays as it is.

    Short forms of several letters count where no letter touches them, single letters before a dot or, with a space at
    most between, a digit."""
    out = line
    for short, full in {**ABBREVIATIONS, **LETTERS}.items():
        before, tail = (r"(?<![\p{L}\p{N}])", r"(?:\.\s*|(?=\s?\p{Nd}))") if short in LETTERS else (r"(?<!\p{L})", r"\.?(?!\p{L})")
        for first, value in ((short[0], full), (short[0].upper(), full.title())):
            rest = "".join(f"[{c}{c.upper()}]" for c in short[1:])
            out = F.regexp_replace(out, f"{before}{first}{rest}{tail}", f"{value} ")
    words = "khu|thành|phường|quận|huyện|số"
    tidy = F.regexp_replace(out, rf"(?iu)(\p{{Nd}})(?=(?:{words})(?![\p{{L}}\p{{N}}_]))", "$1 ")
    tidy = F.trim(F.regexp_replace(F.regexp_replace(tidy, " {2,}", " "), r" ([,.)])", "$1"))
    return F.when(out == line, line).otherwise(tidy)


def url_path(url: Column) -> Column:
    """The path of a URL: what lies between its host and a query or fragment."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def stem(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, "^.*/", ""), r"\.[^.]*$", "")


def case_id(path: Column, index: Column) -> Column:
    return F.format_string("%s#%05d", stem(path), index)


def unit(*parts: Column) -> Column:
    """A number in [0, 1) from the SHA-256 of the parts joined by `|`: the same in every engine."""
    return F.conv(F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def prefix_cut(x: Column, u: Column) -> Column:
    """The first max(5, n*(.4+.55u)) characters, for u in [0, 1)."""
    return F.substring(x, F.lit(1), F.greatest(F.lit(5), (F.length(x) * (F.lit(0.4) + u * F.lit(0.55))).cast("int")))


def level_chain(spans: Column) -> Column:
    """Levels in the order of starts, joined by `>`."""
    return F.when(F.size(spans) == 0, F.lit("(rỗng)")).otherwise(F.array_join(F.transform(F.array_sort(spans), lambda s: s["level"]), ">"))


#: Spellings of a verdict.
VERDICTS = {"1": "1", "2": "2", "tie": "tie", "hoa": "tie", "hoà": "tie", "hòa": "tie"}


def verdict(x: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(v) for kv in VERDICTS.items() for v in kv)), F.lower(F.trim(x)))


def extract_json(x: Column) -> Column:
    """JSON text inside a model's answer: a fenced block, else the whole, else the widest bracketed part; else null."""
    fenced = F.regexp_extract(x, r"(?s)```(?:json)?\s*(.*?)```", 1)
    body = F.btrim(F.when(fenced != "", fenced).otherwise(x), F.lit(" \t\r\n"))
    wide = F.regexp_extract(body, r"(?s)[{\[].*[}\]]", 0)
    whole = body.rlike(r"(?s)^[{\[].*[}\]]$")
    return F.coalesce(F.when(whole & F.try_parse_json(body).isNotNull(), body), F.when((wide != "") & F.try_parse_json(wide).isNotNull(), wide))
