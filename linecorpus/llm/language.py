"""Language of records and of their one-language stretches (problem 2).

Words are judged one by one by hyperdimensional profiles
(:mod:`linecorpus.llm.hyper`) of English, of Cherokee in its own letters and of
Cherokee in Latin ones; names count for neither.  A text is

* ``Empty`` without letters (null and empty texts too),
* ``Mixed`` where each language has at least a quarter of the words,
* else ``Cherokee`` or ``English``.

The confidence of a stretch is the mean of its words' certainty, that of a
record the share of its words that speak for its language, times that mean.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linecorpus.llm.forms import CHR, canonical, plain_map
from linecorpus.llm.hyper import CACHE, Profiles
from linecorpus.plans.lineage import ensure_checkpoint_dir

MISSING = ("", "Error", "und")
#: of the fitting; another one fits anew
VERSION = 3
#: bound on the labelled lines that the profiles are fitted on, beside the lexicon
SAMPLE_LINES = 5_000
#: bound on the lexicon's terms, beyond which the operator refuses
LEXICON_TERMS = 200_000

_WORD = re.compile(r"\S+")
_LETTER = re.compile(r"[^\W\d_]")
_CHR = re.compile(f"[{CHR}]")
_BREAK = re.compile(r"[-¬=\xad]\s*\n\s*")
_NAME = re.compile(r"^[A-ZÀ-Þ][a-zà-ÿ]+$")
_END = re.compile(r"[.!?:]['\"”’)\]]*$")


class Judge:
    """Languages of words and texts; holds trained profiles and the known terms, which are no names."""

    def __init__(self, profiles: Profiles, names: Profiles | None, known: frozenset[str]):
        self.p, self.names, self.known = profiles, names, known
        self.en, self.chr = self.p.names.index("en"), [i for i, n in enumerate(self.p.names) if n != "en"]
        self.memo: dict[str, float] = {}

    @classmethod
    def train(cls, lexicon: list[tuple[str, str]], samples: list[tuple[str, str]], **more) -> Judge:
        words: dict[str, list[str]] = {"en": [], "lat": [], "syl": []}
        known = frozenset(term.upper() for term, _ in lexicon)
        for term, lang in lexicon:
            words["en" if lang == "en" else "syl" if _CHR.search(term) else "lat"].append(term)
        names = set()
        for text, lang in samples:
            toks = [x.strip(".,;:!?—–()[]\"'") for x in text.split()]
            for i, w in enumerate(toks):
                if _NAME.match(w) and w.upper() not in known and i and not _END.search(text.split()[i - 1]):
                    names.add(w)
                elif lang in ("English", "Cherokee") and _LETTER.search(w) and not (_NAME.match(w) and w.upper() not in known):
                    words["syl" if _CHR.search(w) else "en" if lang == "English" else "lat"].append(w)
        by = Profiles.train({"name": sorted(names), "word": [w for w in words["en"]] + [w for w in words["lat"]][:: max(1, len(words["lat"]) // 2000)]}, dims=2048, epochs=4) if names else None
        return cls(Profiles.train(words, **more), by, known)

    def margin(self, word: str) -> float:
        """Above 0 English, below 0 Cherokee."""
        m = self.memo.get(word)
        if m is None:
            if len(self.memo) > CACHE:
                self.memo.clear()
            s = self.p.word(word)
            m = self.memo[word] = float(s[self.en] - max(s[i] for i in self.chr))
        return m

    def is_name(self, word: str, starts: bool) -> bool:
        """A capitalised unknown Latin word is a name; where a sentence starts, if its letters look like one."""
        if not _NAME.match(word) or word.upper() in self.known:
            return False
        if not starts or self.names is None:
            return abs(self.margin(word)) < 0.06 or self.margin(word) > 0
        s = self.names.word(word)
        return bool(s[0] > s[1])

    def words(self, text: str, spans: list[tuple[int, int]] | None = None) -> list[tuple[int, int, float]]:
        """Start, end and margin of each word that counts; ``spans`` are the places to give for the text's tokens."""
        out, starts = [], True
        for at, m in enumerate(_WORD.finditer(text)):
            tok = m.group()
            if _LETTER.search(tok):
                w = tok.strip(".,;:!?—–()[]\"'“”‘’*|&^~§")
                if not self.is_name(w, starts):
                    out.append((*(spans[at] if spans else m.span()), self.margin(w)))
                starts = bool(_END.search(tok))
        if len(out) > 1:
            ms = [x[2] for x in out]
            # a doubtful word leans on its neighbours
            for i, (a, b, v) in enumerate(out):
                if abs(v) < 0.02:
                    near = [*ms[max(0, i - 1) : i], *ms[i + 1 : i + 2]]
                    out[i] = (a, b, v + sum(max(-0.06, min(0.06, x)) for x in near) / len(near))
        return out

    def judge(self, text: str | None, segments: bool = False):
        """``(language, confidence, segments)``; a segment is (language, start, end, confidence)."""
        if not text or not _LETTER.search(text):
            return "Empty", 1.0, []
        given, text = text, canonical(text)
        ws = self.words(text, places(given)) if segments else self.words(_BREAK.sub("", text))
        if not ws:
            return "English", 0.0, [("English", 0, len(given), 0.0)]
        en = sum(v > 0 for *_, v in ws)
        n = len(ws)
        sure = [min(1.0, 0.5 + abs(v) * 8) for *_, v in ws]
        low = min(en, n - en)
        lang = "Mixed" if 4 * low >= n else "English" if 2 * en > n else "Cherokee"
        share = 1.0 if lang == "Mixed" else (n - low) / n
        segs = []
        if segments:
            for (a, b, v), c in zip(ws, sure):
                k = "English" if v > 0 else "Cherokee"
                if segs and segs[-1][0] == k:
                    segs[-1][2] = b
                    segs[-1][3].append(c)
                else:
                    segs.append([k, a, b, [c]])
            segs = [(k, a, b, sum(c) / len(c)) for k, a, b, c in segs]
        return lang, share * sum(sure) / n, segs


def places(text: str) -> list[tuple[int, int]]:
    """Where the tokens of a text's canonical form stand in the text itself."""
    plain = plain_map()
    # a token of invisible characters alone is none in the canonical form
    return [m.span() for m in _WORD.finditer(text) if m.group().isascii() or any(plain.get(x, x) for x in m.group())]


def fitted(spark: SparkSession, lexicon: DataFrame, samples: DataFrame):
    """A broadcast :class:`Judge` with all terms of the lexicon (at most :data:`LEXICON_TERMS`), fitted on them and on at most :data:`SAMPLE_LINES` lines, chosen by a hash.

    The prototypes are kept in a table beside the checkpoints, named by what
    they were fitted on, and read from there the next time.
    """
    lex = [tuple(r) for r in lexicon.where(F.col("term").isNotNull() & F.col("lang").isin("en", "chr")).select("term", "lang").distinct().limit(LEXICON_TERMS + 1).collect()]
    if len(lex) > LEXICON_TERMS:
        raise ValueError(f"the lexicon may have at most {LEXICON_TERMS} terms")
    few = samples.where(F.col("text").isNotNull())
    share = min(1.0, SAMPLE_LINES / max(1, few.count())) * (1 << 20)
    sam = [tuple(r) for r in few.where(F.pmod(F.xxhash64("sample_id"), F.lit(1 << 20)) < share).select("text", "lang").collect()]
    lex.sort(key=str)
    sam.sort(key=str)
    mark = hashlib.blake2b(repr((VERSION, lex, sam)).encode("utf-8", "surrogatepass"), digest_size=12).hexdigest()
    path = f"{ensure_checkpoint_dir(spark)}/../prototypes/{mark}"
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    if file.getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
        got = {r["part"]: Profiles(list(r["names"]), np.frombuffer(r["vectors"], np.float32).reshape(len(r["names"]), r["dims"]), r["dims"], r["seed"]) for r in spark.read.parquet(path).collect()}
        judge = Judge(got["words"], got.get("names"), frozenset(t.upper() for t, _ in lex))
    else:
        judge = Judge.train(lex, sam)
        rows = [(n, p.names, p.letters.dims, p.letters.seed, p.vectors.astype(np.float32).tobytes()) for n, p in (("words", judge.p), ("names", judge.names)) if p is not None]
        spark.createDataFrame(rows, "part string, names array<string>, dims int, seed int, vectors binary").coalesce(1).write.mode("overwrite").parquet(path)
    return spark.sparkContext.broadcast(judge)


SEGMENT = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("confidence", T.DoubleType())]))


def languages(df: DataFrame, judge, text: str, segments: bool = True) -> DataFrame:
    """``df`` with ``language``, ``confidence`` and, if wanted, ``segments`` of column ``text``.

    A segment is a stretch of one language: start and end in code points of the
    text as given.  Other columns pass through Python unread; those
    named like a result give way to it.
    """
    kind = T.StructType([T.StructField("language", T.StringType()), T.StructField("confidence", T.DoubleType())] + ([T.StructField("segments", SEGMENT)] if segments else []))

    @F.pandas_udf(kind)
    def judged(col: pd.Series) -> pd.DataFrame:
        j = judge.value
        got = [j.judge(x, segments) for x in col]
        out = pd.DataFrame({"language": [g[0] for g in got], "confidence": [float(g[1]) for g in got]})
        if segments:
            out["segments"] = [[{"lang": k, "start": a, "end": b, "confidence": float(c)} for k, a, b, c in g[2]] for g in got]
        return out

    got = df.withColumn("__judged", judged(F.col(text)))
    return got.select(*[c for c in df.columns if c not in kind.names], "__judged.*")


def wrong_labels(df: DataFrame, judge, text: str, recorded: str) -> DataFrame:
    """Rows of ``df`` whose ``recorded`` language is missing or differs from the judged one."""
    df = df.withColumnRenamed(recorded, "__recorded") if recorded in ("language", "confidence") else df
    recorded = recorded if recorded in df.columns else "__recorded"
    got = languages(df, judge, text, segments=False)
    named = F.when(F.col(recorded) == "chr", "Cherokee").when(F.col(recorded) == "en", "English").when(F.col(recorded) == "mixed", "Mixed").otherwise(F.col(recorded))
    return got.where(F.col(recorded).isNull() | F.col(recorded).isin(*MISSING) | ~named.eqNullSafe(F.col("language")))
