"""One consistent form for text that looks alike (problem 6).

Two equal implementations share the tables of this module:

* :func:`canonical_forms`, the operator: texts that can change are exploded to
  positioned code points, joined with a broadcast table of decompositions and
  look-alikes, marks ordered by combining class, recomposed and rebuilt;
* :func:`canonical`, the same for one Python string, for operators that
  already run in Python.

Null stays null, an empty text stays empty, letter case, Cherokee small
letters, runs of plain spaces, line breaks and lines in two languages stay as
they are.  All tables are fixed by Unicode or listed here, so their size does
not depend on the data.  A text in which nothing is another form of a usual
character comes out in Unicode's form NFC.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

CHR = "Ꭰ-Ᏽᏸ-ᏽꭰ-ꮿ"

# Latin letters and digits with the Cherokee letters they look like.
# Where two letters look alike the commoner one comes first.
LOOKS_CHEROKEE = {
    "A": "Ꭺ", "B": "Ᏼ", "C": "Ꮯ", "D": "Ꭰ", "E": "Ꭼ", "G": "Ꮐ", "H": "Ꮋ", "J": "Ꭻ", "K": "Ꮶ", "L": "Ꮮ", "M": "Ꮇ",
    "P": "Ꮲ", "R": "ᎡᏒ", "S": "ᏕᏚ", "T": "Ꭲ", "V": "Ꮩ", "W": "ᏔᎳ", "Y": "ᎽᎩ", "Z": "Ꮓ",
    "b": "Ꮟ", "d": "Ꮷ", "h": "Ꮒ", "i": "Ꭵ", "4": "Ꮞ", "6": "Ꮾ",
}
# Cyrillic and Greek letters with the Latin letters they look like.
LOOKS_LATIN = {
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P",
    "С": "C", "Т": "T", "У": "Y", "Х": "X", "а": "a", "е": "e", "ѕ": "s", "і": "i", "ј": "j", "о": "o", "р": "p",
    "с": "c", "у": "y", "х": "x", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P",
    "Τ": "T", "Υ": "Y", "Χ": "X", "ο": "o", "ν": "v", "ι": "i", "α": "a", "ρ": "p", "υ": "u",
    "Օ": "O", "Ս": "U", "օ": "o", "ո": "n", "ս": "u", "հ": "h", "ց": "g",
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N",
    "ꓡ": "L", "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O", "ꓴ": "U",
    "ɑ": "a", "ɡ": "g", "ı": "i", "ȷ": "j",
}
# Hyphens of unusual kind.  Dashes (U+2013, U+2014) are not hyphens.
HYPHENS = "‐‑‒−﹘﹣－"

LATIN_OF = {c[0]: k for k, c in LOOKS_CHEROKEE.items() if k.isupper()} | {c[1]: k for k, c in LOOKS_CHEROKEE.items() if len(c) > 1}
TO_CHR = {k: c[0] for k, c in LOOKS_CHEROKEE.items()}


#: kinds of compatibility form that are the usual characters in other dress, whatever their category
_DRESS = ("wide", "narrow", "small", "font", "noBreak", "vertical", "initial", "medial", "final", "isolated")


@lru_cache(maxsize=1)
def plain_map() -> dict[str, str]:
    """Code points that are only another form of usual ones, whatever word they stand in, in form NFC."""
    out: dict[str, str] = {}
    for cp in [*range(0x80, 0xAC00), *range(0xD7A4, 0xD800), *range(0xF900, 0x20000), *range(0x2F800, 0x2FA20), *range(0xE0000, 0xE0200)]:
        ch = chr(cp)
        cat = unicodedata.category(ch)
        dec = unicodedata.decomposition(ch)
        kind = dec[1:].split(">")[0] if dec[:1] == "<" else "canonical"
        whole = unicodedata.normalize("NFKC", ch)
        if ch in HYPHENS:
            out[ch] = "-"
        elif cat == "Zs":
            out[ch] = " "
        elif cat == "Cf" or cp == 0x34F or 0xFE00 <= cp <= 0xFE0F or 0x180B <= cp <= 0x180D or 0xE0100 <= cp <= 0xE01EF:
            out[ch] = ""
        elif ch in LOOKS_LATIN:
            out[ch] = LOOKS_LATIN[ch]
        elif not dec or kind == "canonical":
            out[ch] = unicodedata.normalize("NFC", ch)
        elif (kind in _DRESS or (kind != "fraction" and (cat[0] in "LN" or cat == "So"))) and " " not in whole and "\u2044" not in whole:
            out[ch] = whole
    return {k: v for k, v in out.items() if v != k}


@lru_cache(maxsize=1)
def pair_map() -> dict[str, str]:
    """A character and the next one to the single character, for all canonical pairs that compose; Hangul goes by arithmetic."""
    out = {}
    for cp in [*range(0xC0, 0xAC00), *range(0xF900, 0x20000)]:
        dec = unicodedata.decomposition(chr(cp))
        if dec and dec[0] != "<" and " " in dec:
            pair = "".join(chr(int(x, 16)) for x in dec.split())
            if unicodedata.normalize("NFC", pair) == chr(cp):
                out[pair] = chr(cp)
    return out


@lru_cache(maxsize=1)
def mark_classes() -> dict[str, int]:
    """Combining class of every mark that has one."""
    return {chr(cp): c for cp in [*range(0x300, 0xAC00), *range(0xF900, 0x20000)] if (c := unicodedata.combining(chr(cp)))}


@lru_cache(maxsize=1)
def followers() -> str:
    """Marks, and letters that can compose with the one before: a character and those after it are one cluster."""
    return "".join(sorted({*mark_classes(), *(p[-1] for p in pair_map()), *map(chr, range(0x1161, 0x1176)), *map(chr, range(0x11A8, 0x11C3))}))


def _ranges(chars: str) -> str:
    """The inside of a character class."""
    cps, out = sorted(map(ord, chars)), []
    for c in cps:
        if out and out[-1][1] == c - 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in out)


_LOOK = "".join(LOOKS_CHEROKEE)
_OTHER = "".join(c for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789" if c not in LOOKS_CHEROKEE)
_WHOLE = rf"(?:^|[ \n])[^A-Za-z0-35789{CHR} \n]*[{_LOOK.strip('46')}][^{_OTHER}{CHR} \n]*(?:$|[ \n])"


#: Characters that never change on their own; anything else makes a text worth a look.
_SAFE = rf"\t\n\r -~{CHR}À-ÿ§¬–—‘’“”…•°£¢©«»¡¿¶†‡"
#: between a Cherokee letter and the next Latin one of its token; any Latin letter decides the token's script
_BETWEEN = rf"[^A-Za-z46{CHR} \n]*"
_SPECIAL = rf"[^{_SAFE}]|[{CHR}]{_BETWEEN}[A-Za-z46]|[A-Za-z46]{_BETWEEN}[{CHR}]"
#: A text that no part of this matches is its own canonical form (Java and Python read it alike).
SUSPECT = f"{_SPECIAL}|{_WHOLE}"
_SUSPECT = re.compile(SUSPECT)


_TOKENS = re.compile(r"[^ \n]*[ \n]?")
_CHR_LETTER = re.compile(f"[{CHR}]")
_LATIN = re.compile("[A-Za-z]")


#: combining marks; a Latin letter with one is not a plain letter that could look like another
_MARKS = _ranges("".join(mark_classes()))
_ACCENTED = f"[A-Za-z][{_MARKS}]+"
_DROP_ACCENTED = re.compile(_ACCENTED)


def _is_cherokee(tok: str) -> bool:
    c, latin = len(_CHR_LETTER.findall(tok)), _LATIN.findall(tok)
    return c > 0 and c >= len(latin) and all(x in LOOKS_CHEROKEE for x in latin)


def _script(tok: str, prev: str, nxt: str, first: bool, last: bool) -> str:
    """Script whose look-alikes a token takes: ``chr``, ``lat`` or ``none``."""
    tok = _DROP_ACCENTED.sub("", tok)
    c = _CHR_LETTER.findall(tok)
    latin = _LATIN.findall(tok)
    looks = [x for x in tok if x in LOOKS_CHEROKEE]
    if c:
        if not looks and not latin:
            return "none"
        foreign = [x for x in latin if x not in LOOKS_CHEROKEE]
        back = all(x in LATIN_OF for x in c)
        if foreign:
            return "lat" if back else "none"
        return "lat" if back and len(latin) > len(c) else "chr"
    if latin and len(looks) == len(re.findall("[A-Za-z0-9]", tok)):
        near_p, near_n = _is_cherokee(prev), _is_cherokee(nxt)
        if (near_p or first) and (near_n or last) and (near_p or near_n):
            return "chr"
    return "none"


def canonical(text: str | None, known=None) -> str | None:
    """The one form of ``text``; ``known`` (a set of terms) settles letters with two look-alikes."""
    if not text:
        return text
    if text.isascii():
        return text
    if not _SUSPECT.search(text):
        return text
    out = []
    for tok, s in _scripts(text):
        if s == "chr":
            done = _put(tok, TO_CHR)
            tok = _settle(tok, done, known) if known is not None else done
        elif s == "lat":
            tok = _put(tok, LATIN_OF)
        out.append(tok)
    return unicodedata.normalize("NFC", "".join(out))


def _scripts(text: str) -> Iterator[tuple[str, str]]:
    """A text's tokens in plain letters, each with the script whose look-alikes it takes."""
    plain = plain_map()
    mapped = "".join(plain.get(x, x) for x in text)
    toks = _TOKENS.findall(mapped)[:-1] if mapped else []
    for i, tok in enumerate(toks):
        yield tok, _script(tok, toks[i - 1] if i else "", toks[i + 1] if i + 1 < len(toks) else "", i == 0, i == len(toks) - 1)


def wanted(text: str | None) -> set[str]:
    """The letters, second look-alikes as first ones, by which :func:`canonical` looks for known terms."""
    if not text or text.isascii() or not _SUSPECT.search(text):
        return set()
    return {core.translate(_TO_FIRST) for tok, s in _scripts(text) if s == "chr" and (core := _open(tok, _put(tok, TO_CHR)))}


def _put(tok: str, by: dict[str, str]) -> str:
    """``tok`` with its letters mapped, but for those that carry a mark."""
    marks = mark_classes()
    return "".join(x if y in marks else by.get(x, x) for x, y in zip(tok, tok[1:] + " "))


_terms: dict[int, tuple] = {}


def _by_letters(known) -> dict[str, list[str]]:
    """Terms by their Cherokee letters, second look-alikes as first ones; made once per set of terms."""
    if id(known) not in _terms:
        _terms.clear()
        by: dict[str, set[str]] = {}
        for t in known:
            up = _NO_CHR.sub("", t.upper())
            if any(x in _FIRST + _SECOND for x in up):
                by.setdefault(up.translate(_TO_FIRST), set()).add(up)
        _terms[id(known)] = known, {k: sorted(v, key=_order) for k, v in by.items()}
    return _terms[id(known)][1]


def _order(term: str) -> str:
    return term.translate(str.maketrans(_FIRST + _SECOND, "0" * len(_FIRST) + "1" * len(_SECOND)))


def _open(tok: str, done: str) -> str:
    """The Cherokee letters of ``done`` if a known term may settle them."""
    core = _NO_CHR.sub("", done)
    return core if any(x in _TWO for x in tok) and core.upper() == core and core in done else ""


def _settle(tok: str, done: str, known) -> str:
    """``done`` with the first known term for its letters that keeps all letters of ``tok`` that were Cherokee already."""
    if not (core := _open(tok, done)):
        return done
    seen = "".join(x for x in tok if x in LOOKS_CHEROKEE or _CHR_LETTER.match(x))
    for term in _by_letters(known).get(core.translate(_TO_FIRST), ()):
        if len(term) == len(seen) and all(x in _TWO or TO_CHR.get(x, x) == y for x, y in zip(seen, term)):
            return done.replace(core, term)
    return done


def tables(spark: SparkSession) -> DataFrame:
    """``(cp, plain, to_chr, to_lat, dec)``: the fixed mapping of single code points; ``dec`` are the full decomposition's code points with their classes."""
    plain, marks = plain_map(), mark_classes()
    # a composed character is taken apart too, so that marks after it find their order
    apart = {c for p, c in pair_map().items()}
    keys = sorted({*plain, *marks, *LOOKS_CHEROKEE, *LATIN_OF, *apart})
    rows = []
    for k in keys:
        p = plain.get(k, k)
        dec = [(x, unicodedata.combining(x)) for x in unicodedata.normalize("NFD", p)] if not "\uac00" <= p <= "\ud7a3" else [(p, 0)]
        rows.append((k, p, TO_CHR.get(p), LATIN_OF.get(k), dec or [("", 0)]))
    return spark.createDataFrame(rows, "cp string, plain string, to_chr string, to_lat string, dec array<struct<c:string,ccc:int>>")


#: letters that two look-alikes exist for: Latin, first, second
_TWO = "".join(k for k, c in LOOKS_CHEROKEE.items() if len(c) > 1)
_FIRST, _SECOND = "".join(LOOKS_CHEROKEE[k][0] for k in _TWO), "".join(LOOKS_CHEROKEE[k][1] for k in _TWO)
_TO_FIRST, _NO_CHR = str.maketrans(_SECOND, _FIRST), re.compile(f"[^{CHR}]")
#: terms that may settle look-alikes; they are broadcast
MOST_KNOWN = 200_000


def settling(known: DataFrame) -> DataFrame:
    """One row with the map ``__known`` from letters, second look-alikes as first ones, to all terms that have them."""
    up = F.regexp_replace(F.upper("term"), f"[^{CHR}]", "")
    t = known.where(F.col("term").isNotNull()).select(up.alias("t")).where(F.col("t").rlike(f"[{_SECOND}]") | F.col("t").rlike(f"[{_FIRST}]"))
    if t.count() > MOST_KNOWN:
        raise ValueError(f"at most {MOST_KNOWN} terms can settle look-alikes")
    order = F.translate("t", _FIRST + _SECOND, "0" * len(_FIRST) + "1" * len(_SECOND))
    # terms of one key differ in look-alikes only
    t = t.groupBy(F.translate("t", _SECOND, _FIRST).alias("k")).agg(F.array_sort(F.collect_set(F.struct(order.alias("o"), "t"))).alias("ts"))
    return t.agg(F.map_from_entries(F.collect_list(F.struct("k", F.col("ts.t").alias("ts")))).alias("__known"))


def _composed(cluster):
    """A cluster's characters (``base``, ``ccc``, ``put`` in canonical order) recomposed: a mark joins the character before it unless one of its class or none lies between."""
    pairs = F.create_map(*[F.lit(v) for kv in pair_map().items() for v in kv])
    l_, v_, t_, s_ = 0x1100, 0x1161, 0x11A7, 0xAC00

    def code(c):
        return F.ascii(c)  # the code point, whatever it is

    def join(a, b):
        ca, cb = code(a), code(b)
        lv = (ca >= l_) & (ca < l_ + 19) & (cb >= v_) & (cb < v_ + 21)
        lvt = (ca >= s_) & (ca < s_ + 11172) & ((ca - s_) % 28 == 0) & (cb > t_) & (cb < t_ + 28)
        char = lambda n: F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
        return F.when(lv, char(s_ + ((ca - l_) * 21 + (cb - v_)) * 28)).when(lvt, char(ca + (cb - t_))).otherwise(F.try_element_at(pairs, F.concat(a, b)))

    def step(acc, x):
        # blocked: a character of class 0 or of the same class stands between the starter and this one
        free = (acc["last"] == -1) | ((acc["last"] != 0) & (acc["last"] < x["ccc"]))
        both = F.when(acc["starter"].isNotNull() & free, join(acc["starter"], x["put"]))
        new = (x["ccc"] == 0) & both.isNull()
        return F.struct(
            F.when(new, F.concat(acc["done"], F.coalesce(acc["starter"], F.lit("")), acc["tail"])).otherwise(acc["done"]).alias("done"),
            F.when(both.isNotNull(), both).when(new, x["put"]).otherwise(acc["starter"]).alias("starter"),
            F.when(new, "").when(both.isNull(), F.concat(acc["tail"], x["put"])).otherwise(acc["tail"]).alias("tail"),
            F.when(both.isNotNull(), acc["last"]).when(new, -1).otherwise(x["ccc"]).alias("last"),
        )

    zero = F.struct(F.lit("").alias("done"), F.lit(None).cast("string").alias("starter"), F.lit("").alias("tail"), F.lit(-1).alias("last"))
    return F.aggregate(cluster, zero, step, lambda acc: F.concat(acc["done"], F.coalesce(acc["starter"], F.lit("")), acc["tail"]))


def settling_terms(rows: DataFrame, key: list[str], texts: list[str], words: DataFrame) -> DataFrame:
    """``key`` and ``terms``: all terms of ``words(word)`` that may settle look-alikes in :func:`canonical` of the row's ``texts``; other rows are left out.

    For terms of any number, joined by their letters instead of broadcast.
    """
    schema = T.StructType([*rows.select(*key).schema.fields, T.StructField("want", T.ArrayType(T.StringType()))])
    k = len(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            want = [sorted(set().union(*map(wanted, x))) for x in zip(*[c.to_pylist() for c in b.columns[k:]])]
            yield pa.RecordBatch.from_arrays([*b.columns[:k], pa.array(want, pa.list_(pa.string()))], schema.names)

    suspect = F.exists(F.array(*texts), lambda x: F.coalesce(x.rlike(SUSPECT), F.lit(False)))
    want = rows.where(suspect).select(*key, *texts).mapInArrow(run, schema).select(*key, F.explode("want").alias("want"))
    up = words.select(F.regexp_replace(F.upper("word"), f"[^{CHR}]", "").alias("term")).where(F.col("term").rlike(f"[{_FIRST}{_SECOND}]")).distinct()
    return want.join(up.withColumn("want", F.translate("term", _SECOND, _FIRST)), "want").groupBy(*key).agg(F.collect_set("term").alias("terms"))


def canonical_forms(df: DataFrame, key: list[str], text: str, out: str = "form", known: DataFrame | None = None) -> DataFrame:
    """``df``'s ``key`` columns, ``text`` and its canonical form ``out``.

    ``key`` must be unique; rows with a null or unchanged text pass through
    without any shuffle, only texts that can change are exploded.  ``known``
    (a small table with ``term``) settles letters that have two look-alikes;
    without it, or where no term fits, the commoner one is taken.
    """
    spark = df.sparkSession
    base = df.select(*key, F.col(text).alias("__text"))
    suspect = F.coalesce(F.col("__text").rlike(SUSPECT), F.lit(False))
    keep = base.where(~suspect).select(*key, F.col("__text").alias(text), F.col("__text").alias(out))
    look, chr_re = f"[{_LOOK}]", f"[{CHR}]"
    # Plain forms come first, so that a word's script is judged on usual letters.
    plain = plain_map()
    fold = {k: next((x for x in v if x.isascii() and x.isalpha() and x not in LOOKS_CHEROKEE), next((x for x in v if x.isascii() and x.isalnum()), "")) for k, v in plain.items()}
    fold = {k: v for k, v in fold.items() if v}
    b = base.where(suspect).withColumn("__t", F.translate("__text", "".join(fold), "".join(fold.values())))
    odd = "".join(k for k, v in plain.items() if v == " ")
    unseen = "[" + "".join(k for k, v in plain.items() if v == "") + "]"
    b = b.withColumn("__toks", F.split(F.translate("__t", odd, " " * len(odd)), r"(?<=[ \n])"))
    # One character may be mapped to none or several only through the join below; tokens keep their length here.

    def script(t, i):
        seen = lambda x: F.regexp_replace(x, unseen, "")
        chrs = lambda x: F.regexp_count(x, F.lit(chr_re))
        has = lambda x: F.coalesce((chrs(x) > 0) & (chrs(x) >= F.regexp_count(x, F.lit("[A-Za-z]"))) & ~x.rlike(f"[A-Za-z&&[^{_LOOK}]]"), F.lit(False))
        toks = F.col("__toks")
        prev, nxt = F.get(toks, i - 1), F.get(toks, i + 1)
        # a last empty token is an end, not a neighbour
        end = nxt.isNull() | (nxt == "")
        t = F.regexp_replace(seen(t), _ACCENTED, "")
        c, latin = chrs(t), F.regexp_count(t, F.lit("[A-Za-z]"))
        looks, foreign = F.regexp_count(t, F.lit(look)), F.regexp_count(t, F.lit(f"[A-Za-z&&[^{_LOOK}]]"))
        alnum = F.regexp_count(t, F.lit("[A-Za-z0-9]"))
        back = F.regexp_count(t, F.lit("[" + "".join(LATIN_OF) + "]")) == c
        near = (has(prev) | (i == 0)) & (has(nxt) | end) & (has(prev) | has(nxt))
        return (
            F.when((c > 0) & ((looks > 0) | (latin > 0)), F.when(foreign > 0, F.when(back, "lat").otherwise("none")).when(back & (latin > c), "lat").otherwise("chr"))
            .when((c == 0) & (latin > 0) & (looks == alnum) & near, "chr")
            .otherwise("none")
        )

    toks = F.transform("__toks", lambda t, i: F.struct(F.length(t).alias("n"), script(t, i).alias("s")))
    scripts = F.flatten(F.transform(toks, lambda x: F.array_repeat(x["s"], x["n"])))
    open_ = F.transform("__toks", lambda t, i: F.when((script(t, i) == "chr") & t.rlike(f"[{_TWO}]"), F.regexp_replace(t, f"[^{CHR}{_LOOK}]", "")))
    b = b.withColumn("__open", F.when(F.exists(open_, lambda x: x.isNotNull()), open_) if known is not None else F.lit(None).cast("array<string>"))
    cps = F.arrays_zip(F.split("__text", "").alias("cp"), scripts.alias("s"))
    points = b.select(*key, "__text", "__open", F.posexplode(cps).alias("__pos", "__x")).select(*key, "__text", "__open", "__pos", F.col("__x.cp").alias("__cp"), F.col("__x.s").alias("__s")).where(F.col("__cp") != "")
    m = F.broadcast(tables(spark).toDF("__cp", "__plain", "__chr", "__lat", "__dec"))
    plainly, looks = F.coalesce("__plain", "__cp"), F.when(F.col("__s") == "chr", F.col("__chr")).when(F.col("__s") == "lat", F.col("__lat"))
    dec = F.coalesce("__dec", F.array(F.struct(F.col("__cp").alias("c"), F.lit(0).alias("ccc"))))
    # the text itself and what settles it ride on the first code point
    first = lambda c: F.when(F.col("__pos") == 0, F.col(c)).alias(c)
    j = points.withColumn("__marked", F.col("__text").rlike(f"[{_ranges(followers())}]")).join(m, "__cp", "left")
    back = [F.first("__text", ignorenulls=True).alias(text), F.first("__open", ignorenulls=True).alias("__open")]

    # without marks every code point is its own cluster
    alone = j.where(~F.col("__marked")).select(*key, first("__text"), first("__open"), F.struct(F.col("__pos").alias("pos"), F.coalesce(looks, plainly).alias("put")).alias("__x"))
    alone = alone.groupBy(*key).agg(*back, F.array_join(F.transform(F.array_sort(F.collect_list("__x")), lambda x: x["put"]), "").alias(out))

    # with marks: decomposed code points in order; clusters are numbered by the characters that begin one
    d = j.where("__marked").select(*key, first("__text"), first("__open"), "__pos", looks.alias("__looks"), F.posexplode(dec).alias("__sub", "__d")).select(*key, "__text", "__open", "__pos", "__sub", "__looks", "__d.*").where((F.col("c") != "") | (F.col("__pos") == 0))
    w = Window.partitionBy(*key).orderBy("__pos", "__sub")
    follows = F.col("c").isin(*followers())
    d = d.withColumn("__next", F.coalesce(F.lead("ccc").over(w), F.lit(0))).withColumn("__cluster", F.sum((~follows).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    # marks are ordered by class behind the last character without one; a letter that carries a mark looks like no other
    d = d.withColumn("__base", F.coalesce(F.sum((F.col("ccc") == 0).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)))
    put = F.when((F.col("__next") == 0) & F.col("__looks").isNotNull(), F.col("__looks")).otherwise(F.col("c"))
    one = F.struct(F.col("__base").alias("base"), "ccc", F.col("__pos").alias("pos"), F.col("__sub").alias("sub"), put.alias("put"))
    clusters = d.groupBy(*key, "__cluster").agg(*[c.alias(n) for c, n in ((F.first("__text", ignorenulls=True), "__text"), (F.first("__open", ignorenulls=True), "__open"))], F.array_sort(F.collect_list(one)).alias("__a"))
    clusters = clusters.withColumn("__put", F.when(F.size("__a") == 1, F.col("__a")[0]["put"]).otherwise(_composed(F.col("__a"))))
    many = clusters.groupBy(*key).agg(*back, F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__cluster", "__put"))), lambda x: x["__put"]), "").alias(out))
    done = alone.unionByName(many).select(*key, text, "__open", out)
    if known is None:
        return keep.unionByName(done.drop("__open"))

    def settled(f, t):
        """The final token ``f`` with the known term for its letters, if that keeps all letters of ``t`` that were Cherokee already."""
        core = F.regexp_replace(f, f"[^{CHR}]", "")
        terms = F.try_element_at("__known", F.translate(F.upper(core), _SECOND, _FIRST))

        def keeps(term):
            same = F.zip_with(F.split(t, ""), F.split(term, ""), lambda x, y: x.isin(*_TWO) | (F.translate(x, "".join(TO_CHR), "".join(TO_CHR.values())) == y))
            return (F.length(term) == F.length(t)) & F.forall(same, lambda ok: F.coalesce(ok, F.lit(False)))

        term = F.get(F.filter(terms, keeps), F.lit(0))
        fits = t.isNotNull() & term.isNotNull() & (F.upper(core) == core) & f.contains(core)
        return F.when(fits, F.replace(f, core, term)).otherwise(f)

    tokens = F.zip_with(F.split(out, r"(?<=[ \n])"), "__open", settled)
    done = done.withColumn("__known", settling(known).scalar())
    done = done.withColumn(out, F.when(F.col("__open").isNotNull(), F.array_join(tokens, "")).otherwise(F.col(out)))
    return keep.unionByName(done.select(*key, text, out))
