"""Sizes in tokens of public tokenizers, and texts cut by their tokens."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def size(text: Column, tokenizer: str = "byt5", path: str | None = None) -> Column:
    """Tokens of ``text``; null for null.

    ``byt5`` is the byte-level tokenizer without its closing token: one token per
    UTF-8 byte, counted in the JVM.  Otherwise ``tokenizer`` is ``tokenizers``,
    ``tiktoken`` or ``sentencepiece`` and ``path`` the vocabulary file, which
    every executor must be able to read; it is opened once per Python process.
    """
    if tokenizer == "byt5":
        return F.octet_length(text).cast("long")
    if tokenizer not in ("tokenizers", "tiktoken", "sentencepiece") or not path:
        raise ValueError("name one of byt5, tokenizers, tiktoken, sentencepiece, and for the latter three a path")
    @F.pandas_udf("long")
    def count(col: pd.Series) -> pd.Series:
        sizes = counter(tokenizer, path)
        some = [x for x in col if x is not None]
        got = iter(sizes(some) if some else [])
        return pd.Series([None if x is None else next(got) for x in col], dtype="Int64", index=col.index)

    return count(text)


_counters: dict[tuple[str, str], object] = {}
_encoders: dict[tuple[str, str], object] = {}


def counter(tokenizer: str, path: str):
    if (tokenizer, path) not in _counters:
        if tokenizer == "tokenizers":
            from tokenizers import Tokenizer

            t = Tokenizer.from_file(path)
            t.encode_special_tokens = True
            _encoders[tokenizer, path] = t
            _counters[tokenizer, path] = lambda texts: [len(e.ids) for e in t.encode_batch(texts, add_special_tokens=False)]
        elif tokenizer == "sentencepiece":
            import sentencepiece

            p = sentencepiece.SentencePieceProcessor(model_file=path)
            _encoders[tokenizer, path] = p
            _counters[tokenizer, path] = lambda texts: [len(x) for x in p.encode(texts, num_threads=1)]
        else:
            import base64

            import tiktoken

            pattern = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
            enc = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
            _encoders[tokenizer, path] = enc
            _counters[tokenizer, path] = lambda texts: [len(enc.encode_ordinary(x)) for x in texts]
    return _counters[tokenizer, path]


VIEW = T.StructType([T.StructField("signs", T.StringType()), T.StructField("ends", T.ArrayType(T.IntegerType()))])


def spans(tokenizer: str, path: str, text: str) -> list[int]:
    """Where each token of ``text`` ends, in bytes of its UTF-8; the last one at the text's end."""
    total = len(text.encode("utf-8"))
    if tokenizer == "tiktoken":
        counter(tokenizer, path)
        enc, ends, at = _encoders[tokenizer, path], [], 0
        for b in enc.decode_tokens_bytes(enc.encode_ordinary(text)):
            at += len(b)
            ends.append(at)
        return ends
    counter(tokenizer, path)
    if tokenizer == "tokenizers":
        ends = [b for _, b in _encoders[tokenizer, path].encode(text, add_special_tokens=False).offsets]
    else:
        ends = [p.end for p in _encoders[tokenizer, path].encode(text, out_type="immutable_proto").pieces]
    # from code points to bytes; what a normaliser drops belongs to the token after it
    sizes, at, out, done = [len(c.encode("utf-8")) for c in text], 0, [], 0
    for e in ends:
        while at < e:
            done += sizes[at]
            at += 1
        out.append(done)
    if out:
        out[-1] = total
    return out


def signs(text: str, ends: list[int]) -> str:
    """For each token the strength of the boundary it ends at: P, L, S, W, i (within a word), c (within a character)."""
    raw, out = text.encode("utf-8"), []
    for e in ends:
        before, last = raw[max(0, e - 8) : e], raw[e - 1 : e]
        if e < len(raw) and raw[e] & 0xC0 == 0x80:
            out.append("c")
        elif last == b"\n":
            out.append("P" if before[:-1].rstrip(b" \t").endswith(b"\n") else "L")
        elif last in (b" ", b"\t", b"\r"):
            out.append("S" if before[:-1].rstrip(b"\"')").endswith((b".", b"!", b"?", b";")) else "W")
        elif raw[e : e + 1] in (b" ", b"\n", b"\t"):
            # tokens that begin with the space: the word ends here all the same
            out.append("S" if before.rstrip(b"\"')").endswith((b".", b"!", b"?", b";")) else "W")
        else:
            out.append("i")
    return "".join(out)


def view(text: Column, tokenizer: str, path: str | None) -> Column:
    """One sign per token of ``text`` and where the tokens end."""

    @F.pandas_udf(VIEW)
    def run(col: pd.Series) -> pd.DataFrame:
        got = [([], "") if x is None else (e := spans(tokenizer, path, x), signs(x, e)) for x in col]
        return pd.DataFrame({"signs": [g[1] for g in got], "ends": [g[0] for g in got]})

    return run(text)


def bodies(text: str, ends: str, cuts: str) -> Column:
    """The pieces ``cuts`` (structs with ``start`` and ``tokens``) of column ``text``."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def run(t: pd.Series, e: pd.Series, c: pd.Series) -> pd.Series:
        out = []
        for x, at, cs in zip(t, e, c):
            raw, got = x.encode("utf-8"), []
            for p in cs:
                a, b = (at[p["start"] - 1] if p["start"] else 0), (at[p["start"] + p["tokens"] - 1] if p["tokens"] else 0)
                while a and raw[a] & 0xC0 == 0x80 if a < len(raw) else False:
                    a -= 1
                got.append(raw[a:b].decode("utf-8", "ignore"))
            out.append(got)
        return pd.Series(out)

    return run(F.col(text), F.col(ends), F.col(cuts))
