"""Splitting oversized items at natural boundaries (problem 9).

All in SQL functions, in time proportional to the text.  A text is viewed as its UTF-8 bytes (one character per
byte, which is one token of the byte-level tokenizer), and one regular
expression with bounded quantifiers takes pieces off its front: alternatives
are ordered by the strength of the boundary they end at (paragraph, line,
sentence, word), each greedy up to the limit, with a cut between characters as
the last resort.  Every piece after the first looks back ``overlap`` tokens, to
the next character boundary at or before that.

A null text has no pieces, an empty one a single empty piece.  A text within
the limit is one piece.  Repeated rows are cut each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linecorpus.llm.tokens import bodies, view

#: bytes by which a look-back may grow to reach a character's start
SLACK = 3


def as_bytes(text: Column) -> Column:
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def as_text(view: Column) -> Column:
    return F.decode(F.encode(view, "ISO-8859-1"), "UTF-8")


def cutter(most: int) -> str:
    """The pattern that takes one piece of at most ``most`` tokens off a text's front."""
    least = max(1, most // 2)
    ends = (r"(?<=\n[ \t]{0,3}\n)", r"(?<=\n)", r"(?<=[.!?;][\"')]{0,1}[ \n\t])", r"(?<=[ \n\t\r])")
    strong = "|".join(f".{{{least},{most}}}{e}" for e in ends)
    return rf"(?s)(?:.{{1,{most}}}\z|{strong}|.{{1,{most}}}(?<=[ \n\t\r])|.{{1,{most}}}(?![\x80-\xBF]))"


#: pieces of one block of running sums
BLOCK = 256


def _starts(parts: Column) -> Column:
    """Where each of ``parts`` starts, by sums over blocks and within them, so no array grows piece by piece to the text's length."""
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / BLOCK).cast("int")), lambda b: F.slice(parts, b * BLOCK + 1, BLOCK))
    push = lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n))
    zero = F.array(F.lit(0))
    within = F.transform(blocks, lambda ps: F.aggregate(ps, zero, lambda acc, p: push(acc, F.length(p))))
    before = F.aggregate(within, zero, lambda acc, w: push(acc, F.element_at(w, -1)))
    return F.flatten(F.zip_with(within, F.slice(before, 1, F.size(within)), lambda w, at: F.transform(F.slice(w, 1, F.size(w) - 1), lambda x: x + at)))


def pieces(df: DataFrame, key: list[str], text: str, limit: int, overlap: int = 0, tokenizer: str = "byt5", path: str | None = None) -> DataFrame:
    """``key``, ``piece`` (from 0), ``start`` and ``tokens`` of the piece in the text, and ``body``.

    With another ``tokenizer`` (:mod:`linecorpus.llm.tokens`) the text is viewed
    as one sign per token of the whole text, which tells how strong a boundary
    the token ends at; ``start`` and ``tokens`` then count that tokenizer's tokens.
    """
    if limit < 8 or not 0 <= overlap <= limit // 2:
        raise ValueError("a limit of 8 tokens or more and an overlap of at most half of it are needed")
    if tokenizer != "byt5":
        return _token_pieces(df, key, text, limit, overlap, tokenizer, path)
    most = limit - overlap - (SLACK if overlap else 0)
    b = df.where(F.col(text).isNotNull()).select(*[F.col(k).alias(f"__key{i}") for i, k in enumerate(key)], as_bytes(F.col(text)).alias("__b"))
    keys = [F.col(f"__key{i}").alias(k) for i, k in enumerate(key)]
    whole = F.length("__b") <= limit
    b = b.withColumn("__p", F.when(whole, F.array("__b")).otherwise(F.regexp_extract_all("__b", F.lit(cutter(most)), F.lit(0))))
    b = b.withColumn("__s", _starts(F.col("__p")))
    # of two pieces in a row one is at least half of what may be taken, so that many before one hold all it looks back to
    back = 2 * (-(-(overlap + SLACK) // max(1, most // 2)) + 1)
    continues = lambda t, k: F.substring(t, F.length(t) - k + 1, F.lit(1)).rlike("[\\x80-\\xBF]")

    def one(p, i):
        at = F.get("__s", i)
        if not overlap:
            return F.struct(i.alias("piece"), at.cast("int").alias("start"), F.length(p).alias("tokens"), p.alias("body"))
        first = F.greatest(F.lit(0), i - back)
        tail = F.right(F.array_join(F.slice("__p", first + 1, F.greatest(F.lit(0), i - first)), ""), F.lit(overlap + SLACK))
        # the look-back grows to the start of the character that its first byte is part of
        n = F.when(F.length(tail) <= overlap, F.length(tail)).when(~continues(tail, overlap), overlap).when(~continues(tail, overlap + 1), overlap + 1).when(~continues(tail, overlap + 2), overlap + 2).otherwise(overlap + 3)
        return F.struct(i.alias("piece"), (at - n).cast("int").alias("start"), (F.length(p) + n).cast("int").alias("tokens"), F.concat(F.right(tail, n), p).alias("body"))

    cut = b.select(*keys, F.explode(F.transform("__p", one)).alias("__x"))
    return cut.select(*key, "__x.piece", "__x.start", "__x.tokens", as_text(F.col("__x.body")).alias("body"))


def token_cutter(most: int) -> str:
    """:func:`cutter` over the signs of a view by tokens."""
    least = max(1, most // 2)
    strong = "|".join(f".{{{least},{most}}}(?<=[{e}])" for e in ("P", "PL", "PLS", "PLSW"))
    return rf"(?:.{{1,{most}}}\z|{strong}|.{{1,{most}}}(?<=[PLSW])|.{{1,{most}}}(?<!c)|.{{1,{most}}})"


def _token_pieces(df: DataFrame, key: list[str], text: str, limit: int, overlap: int, tokenizer: str, path: str | None) -> DataFrame:
    """A look-back may start within a character of several tokens; such a piece's body starts with the whole character."""
    most = limit - overlap
    b = df.where(F.col(text).isNotNull()).select(*[F.col(k).alias(f"__key{i}") for i, k in enumerate(key)], F.col(text).alias("__t"), view(F.col(text), tokenizer, path).alias("__v"))
    keys = [F.col(f"__key{i}").alias(k) for i, k in enumerate(key)]
    b = b.withColumn("__p", F.when(F.length("__v.signs") <= limit, F.array("__v.signs")).otherwise(F.regexp_extract_all("__v.signs", F.lit(token_cutter(most)), F.lit(0))))
    b = b.withColumn("__s", _starts(F.col("__p")))

    def one(p, i):
        at = F.get("__s", i)
        begin = F.greatest(F.lit(0), at - overlap)
        return F.struct(i.alias("piece"), begin.cast("int").alias("start"), (at + F.length(p) - begin).cast("int").alias("tokens"))

    b = b.withColumn("__c", F.transform("__p", one))
    # the bodies of all pieces of a text in one pass over it
    cut = b.select(*keys, F.explode(F.arrays_zip(F.col("__c").alias("c"), bodies("__t", "__v.ends", "__c").alias("body"))).alias("__x"))
    return cut.select(*key, "__x.c.piece", "__x.c.start", "__x.c.tokens", "__x.body")
