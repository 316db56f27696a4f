"""Column functions on strings: normal form, scripts, tokens, names of files and lines."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What Python's str.isspace accepts below U+3100 and beyond.
WS = r"[\s\x0B\x1C-\x1F\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
# The script's ranges, and the wider one that frequency counts use.
CHEROKEE = r"\x{13A0}-\x{13FF}\x{AB70}-\x{ABBF}"
CHEROKEE_WIDE = r"\x{13A0}-\x{13FF}\x{AB70}-\x{ABFF}"
LATIN = "A-Za-z"
# Signs that candidate words are stripped of.
SIGNS = ".,!?\"()'-“”"


@F.pandas_udf(T.StringType())
def nfc(col: pd.Series) -> pd.Series:
    """Unicode NFC; text that is in it already (all ASCII) passes unread."""
    return col.map(lambda x: x if x is None or x.isascii() or unicodedata.is_normalized("NFC", x) else unicodedata.normalize("NFC", x))


def one_spaced(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, WS + "+", " "))


def normalize_truth(c: Column, compose: bool = True) -> Column:
    """NFC, full upper case, white space runs to one space, trimmed; null becomes empty.

    ``compose=False`` leaves NFC out, so that the whole expression stays in the
    JVM, for text known to be composed.
    """
    return F.coalesce(one_spaced(F.upper(nfc(c) if compose else c)), F.lit(""))


def count_class(c: Column, chars: str) -> Column:
    """How many characters of ``c`` are in the character class; null counts as none."""
    return F.coalesce(F.regexp_count(c, F.lit(f"[{chars}]")), F.lit(0))


def script_share(c: Column, target: str = CHEROKEE, other: str = LATIN) -> Column:
    """Target letters over letters of both scripts, null without any."""
    t, o = count_class(c, target), count_class(c, other)
    return F.when(t + o > 0, t / (t + o))


def script_class(c: Column, target: str = CHEROKEE, other: str = LATIN, low: float = 0.40, high: float = 0.45) -> Column:
    """Empty, English (share below ``low``), Cherokee (above ``high``) or Mixed (the closed band between)."""
    s = script_share(c, target, other)
    return F.when(s.isNull(), "Empty").when(s < low, "English").when(s > high, "Cherokee").otherwise("Mixed")


def script_class_of_counts(target: Column, other: Column, low: float = 0.40, high: float = 0.45) -> Column:
    share = target / (target + other)
    return F.when(target + other == 0, "Empty").when(share < low, "English").when(share > high, "Cherokee").otherwise("Mixed")


def weighted_score(ftm: Column, chr_: Column, eng: Column, share: Column) -> Column:
    return 0.2 * ftm + 0.5 * chr_ - 0.5 * eng + 0.5 * share * 100


def weighted_class(ftm: Column, chr_: Column, eng: Column, share: Column, chars: Column) -> Column:
    """Line language by the weighted score of three confidences and the script's share.

    Empty if there are no characters and both script confidences are 0; a null
    input (failed recognition) is English.
    """
    s = weighted_score(ftm, chr_, eng, share)
    return (
        F.when((chars == 0) & (chr_ == 0) & (eng == 0), "Empty")
        .when(s >= 32.1158, "Cherokee")
        .when((share > 0.05) | (s >= 20), "Mixed")
        .otherwise("English")
    )


def rule_is_cherokee(ftm: Column, chr_: Column, eng: Column, share: Column, t: float, a: float, b: float, c: float) -> Column:
    return (share >= t) | ((share >= 0.15) & (ftm >= a) & (chr_ >= b) & (eng < c))


def clean_word(c: Column) -> Column:
    """Letters, digits and the script's characters only."""
    return F.regexp_replace(c, rf"[^\p{{L}}\p{{N}}{CHEROKEE}]", "")


def raw_position(raw: Column, n: Column) -> Column:
    """Characters of ``raw`` up to and with the ``n``-th that :func:`clean_word` keeps; null if it keeps fewer."""
    kept = F.filter(F.transform(F.split(raw, ""), lambda ch, i: F.struct(ch.alias("ch"), i.alias("i"))), lambda x: clean_word(x["ch"]) != "")
    return F.get(kept, n - 1)["i"] + 1


def strip_signs(c: Column) -> Column:
    return F.btrim(c, F.lit(SIGNS))


def tokens(c: Column) -> Column:
    """White-space tokens, none empty; null gives an empty array."""
    return F.coalesce(F.filter(F.split(c, WS + "+"), lambda x: x != ""), F.array().cast("array<string>"))


def ends_hyphenated(c: Column) -> Column:
    return F.coalesce(F.endswith(F.regexp_replace(c, WS + "+$", ""), F.lit("-")), F.lit(False))


def replace_token(c: Column, old: Column, new: Column) -> Column:
    """Every white-space token equal to ``old`` becomes ``new``; spacing becomes single where any changes."""
    t = tokens(c)
    return F.when(F.array_contains(t, old), F.array_join(F.transform(t, lambda x: F.when(x == old, new).otherwise(x)), " ")).otherwise(c)


def has_any(c: Column, chars: list[str]) -> Column:
    """Whether any of the characters occurs."""
    if not chars:
        return F.lit(False)
    return F.coalesce(F.arrays_overlap(F.split(c, ""), F.array(*map(F.lit, chars))), F.lit(False))


def lower_script(c: Column) -> Column:
    """The script's capital letters (U+13A0 to U+13F5) to small ones, nothing else."""
    upper = "".join(map(chr, range(0x13A0, 0x13F6)))
    return F.translate(c, upper, upper.lower())


def or_else(*cs: Column) -> Column:
    """The first that is neither null nor empty, else null."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])


# names ----------------------------------------------------------------------


def line_name(scan: Column, column: Column, line: Column) -> Column:
    """``1828-02-21/seq-4.jp2``, 1, 7 to ``1828-02-21_seq-4_col_01_line_007``."""
    stem = F.regexp_replace(F.regexp_replace(scan, r"\.[^./]*$", ""), r"[/\\]", "_")
    return F.format_string("%s_col_%02d_line_%03d", stem, column, line)


def base_name(path: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(path, r"^.*[/\\]", ""), r"\.[^.]*$", "")


def document_of(name: Column) -> Column:
    """Document part of a file's base name."""
    verse = F.array_join(F.slice(F.split(name, "_"), 1, 3), "_")
    page = F.regexp_extract(name, r"^(\d{4}-\d{2}-\d{2}_seq-\d+)", 1)
    return F.when(F.startswith(name, F.lit("cnt_")), verse).when(page != "", page).otherwise("unknown_doc")


def line_of(name: Column) -> Column:
    """Line part of a file's base name."""
    verse = F.array_join(F.slice(F.split(name, "_"), 4, 2), "_")
    line = F.regexp_extract(name, r"(line_\d+)", 1)
    return F.when(F.startswith(name, F.lit("cnt_")), verse).when(line != "", line).otherwise("unknown_line")


def date_of(name: Column) -> Column:
    return F.try_to_timestamp(F.regexp_extract(name, r"(\d{4}-\d{2}-\d{2})", 1), F.lit("yyyy-MM-dd")).cast("date")


def url_parts(line: Column) -> Column:
    """Base URL, date and edition of a seed line, null where it is none."""
    pattern = r"^(https://[^\s/]+/lccn/[^/\s]+/(\d{4}-\d{2}-\d{2})/(ed-\d+)/)"
    t = F.trim(line)
    get = lambda i: F.regexp_extract(t, pattern, i)
    return F.when(t.rlike(pattern), F.struct(get(1).alias("base_url"), get(2).alias("date"), get(3).alias("edition")))


def checkpoint_iteration(name: Column) -> Column:
    """The second number of ``…_<n>_<m>.checkpoint``, null where there is none."""
    return F.regexp_extract(name, r"_(\d+)_(\d+)\.checkpoint$", 2).try_cast("int")


def percent_after(text: Column, label: str) -> Column:
    """The number that follows ``label`` up to a percent sign or comma."""
    return F.regexp_extract(text, rf"{label}\s*[=:]\s*([0-9.]+)", 1).try_cast("double")


def verse_parts(key: Column) -> Column:
    """Book, chapter and verse of a six-digit key."""
    part = lambda a: F.substring(key, a, 2).try_cast("int")
    return F.struct(part(1).alias("book"), part(3).alias("chapter"), part(5).alias("verse"))


def numbered(number: Column, text: Column, first: Column) -> Column:
    """A verse's first line with its number before it; other lines as they are."""
    return F.when(first, F.when(F.coalesce(text, F.lit("")) == "", number).otherwise(F.concat_ws(" ", number, text))).otherwise(text)


def image_title(hocr: Column, name: Column) -> Column:
    """The image named in an hOCR text's titles, replaced."""
    return F.regexp_replace(hocr, F.lit(r'image\s+"[^"]*"'), F.concat(F.lit('image "'), name, F.lit('"')))
