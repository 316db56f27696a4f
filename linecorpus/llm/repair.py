"""Noise in text from scanned pages (problem 5).

Lines are read one by one: page furniture (running headers, page numbers) is
recognised, words broken at line ends are marked, and every word that is not
known for sure is handed on.  These words, each distinct one once, are looked
up by intersecting a Levenshtein automaton with the vocabulary's trie
(:mod:`linecorpus.llm.trie`), shard by shard of the vocabulary, which finds all
candidates.  A candidate's weight is its frequency times the probability of the
edits (:class:`linecorpus.llm.channel.Channel`); the word is misread if that is
more than the probability of its being right as it stands: its own frequency,
or that of a right word the vocabulary lacks
(:class:`linecorpus.llm.channel.Spelling`).  Candidates of like weight are
ranked by how often they stand beside the neighbouring words.  Text is changed
only where the evidence is clear (:data:`CLEAR`); a plausible word stays.

Known words, headers, counts and candidates are tables of any size; a word of
the vocabulary or made of such words is known however rare it is.  What is
broadcast is bounded: the commonest :data:`COMMON` words, which spare a join
but change no result, one shard of the vocabulary at a time, a bitmap of
headers of fixed size, and the models, which are counted over all words and all
lines read several times and whose size depends on letters only.

Null and empty texts have no faults and repair to themselves.  Of repeated
rows of one ``id`` the last ``ord`` goes into the running text.  Columns of
other names are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from linecorpus.llm.channel import FIRST, LAST, OFTEN, STEM, TAIL, Channel, Spelling, edit_of
from linecorpus.llm.forms import CHR, canonical, settling_terms
from linecorpus.llm.trie import Trie
from linecorpus.plans.lineage import cut

#: commonest words that tasks hold; those of a larger vocabulary are found by joins
COMMON = 100_000
#: vocabulary words of one shard of the look-up
SHARD = 50_000
#: distinct page numbers that a running header must have stood with
HEADER_PAGES = 3
#: letters of the longest run that counts as a vocabulary word; more is text without spaces
WORD_LETTERS = 100
#: log-odds above which text is changed; for capitalised words, which may be names, above the second
CLEAR, CLEAR_NAME = 4.0, 7.0
#: candidates within these log-odds of the best are ranked with their context
TIE = 3.0
#: cells of the headers' bitmap
CELLS = 1 << 22

EDGE = ".,;:!?—–()[]\"'“”‘’*"
_LETTER = re.compile(r"[^\W\d_]")
_BROKEN = re.compile(r"[^\W\d_][.,;:]?[-¬=\xad][.,;:]?\s*$")
_ONLY_NUMBER = re.compile(r"^[\s\[\](){}*.—–-]*\d{1,4}[\s\[\](){}*.—–-]*$")
# a decorated number at a line's start or end
_NUMBER_FIRST = re.compile(r"^\s*(?:\[\s*\d{1,4}\s*\]|\(\s*\d{1,4}\s*\)|([—–*-])\s*\d{1,4}\s*\1)\s+")
_NUMBER_LAST = re.compile(r"\s+(?:\[\s*\d{1,4}\s*\]|\(\s*\d{1,4}\s*\)|([—–*-])\s*\d{1,4}\s*\1)\s*$")
# beside headers the number may be plain
_FURNITURE = re.compile(r"[\[(—–*-]*\s*\d{1,4}\s*[\])—–*-]*\.?|[—–-]")
_JUNK = re.compile(rf"[^\W\d_][|&^*§~0-9]|[|&^*§~0-9][^\W\d_]")
_ORDINAL = re.compile(r"^\d+(?:st|nd|rd|th|d)$", re.I)
_CHR_LETTER = re.compile(f"[{CHR}]")


def fold(word: str) -> str:
    return word.strip(EDGE).upper()


def junk(word: str) -> bool:
    """A sign or digit directly beside a letter, which no word has."""
    return bool(_JUNK.search(word)) and not _ORDINAL.match(word)


class Lines:
    """What one line shows by itself; holds known words (``whole``: all of them) and the headers' bitmap."""

    def __init__(self, known: frozenset[str], cells: bytes, whole: bool = True):
        self.known, self.cells, self.whole = known, cells, whole

    def headed(self, words: list[str]) -> list[tuple[str, int]]:
        """Beginnings of a line (folded words) that may be a running header: phrase, and tokens it takes up."""
        out, crc, made = [], 0, []
        for i, w in enumerate(words):
            if not w or w.isdigit():
                continue
            w = f" {w}" if made else w
            crc = zlib.crc32(w.encode("utf-8", "surrogatepass"), crc)
            made.append(w)
            if len(made) > 1 and self.cells[(crc & (CELLS - 1)) >> 3] >> (crc & 7) & 1:
                out.append(("".join(made), i + 1))
        return out

    def odd(self, words: list[str], broken: bool) -> list[int]:
        """Places of the words to look up."""
        out = []
        for i, w in enumerate(words):
            if not w or (broken and i == len(words) - 1) or w in self.known or not _LETTER.search(w):
                continue
            parts = w.split("-")
            if len(parts) > 1 and all(p in self.known for p in parts if p):
                continue
            out.append(i)
        return out

    def look(self, text: str, terms: list[str] | None = None):
        """``(canonical text, local faults, headed, odd)``; ``terms`` may settle look-alikes where not all known words are held.

        ``headed`` holds (line, phrase, tokens), ``odd`` (place, word, first,
        left word, right word); places number the tokens of all lines.
        """
        text = canonical(text, self.known if self.whole else frozenset(terms or ()))
        faults, heads, odd, at = set(), [], [], 0
        lines = text.split("\n")
        for k, line in enumerate(lines):
            toks = line.split()
            if not toks:
                continue
            if _ONLY_NUMBER.match(line):
                # a number on a line of its own inside a text is a verse's, not a page's
                if len(lines) == 1:
                    faults.add("number")
                at += len(toks)
                continue
            if _NUMBER_FIRST.match(line) or _NUMBER_LAST.search(line):
                faults.add("number")
            broken = bool(_BROKEN.search(line))
            if broken:
                faults.add("broken")
            words = [fold(t) for t in toks]
            heads += [(k, p, n) for p, n in self.headed(words)]
            for i in self.odd(words, broken):
                odd.append((at + i, words[i], i == 0, words[i - 1] if i else "", words[i + 1] if i + 1 < len(words) else ""))
            at += len(toks)
        return text, sorted(faults), heads, odd

    def correct(self, text: str, put: dict[int, str]) -> tuple[str, list[tuple[int, str, int]]]:
        """A canonical text with the tokens of the places in ``put`` set right, and its beginnings that may be headers."""
        out, heads, at = [], [], 0
        for k, line in enumerate(text.split("\n")):
            toks = line.split()
            if any(at + i in put for i in range(len(toks))):
                toks = [recase(t, put[at + i]) if at + i in put else t for i, t in enumerate(toks)]
                line = " ".join(toks)
            if toks and not _ONLY_NUMBER.match(line):
                heads += [(k, p, n) for p, n in self.headed([fold(t) for t in toks])]
            at += len(toks)
            out.append(line)
        return "\n".join(out), heads


def assemble(text: str | None, heads: dict[int, int]) -> tuple[str, bool]:
    """A corrected text without page furniture; whether its last word goes on in the next row.

    ``heads`` gives the tokens of each line's running header.
    """
    out, goes_on = "", False
    for k, line in enumerate((text or "").split("\n")):
        if not line.strip() or (_ONLY_NUMBER.match(line) and "\n" not in text):
            continue
        toks = line.split()
        if k in heads:
            toks = toks[heads[k] :]
            while toks and _FURNITURE.fullmatch(toks[0]):
                toks = toks[1:]
            line = " ".join(toks)
        line = _NUMBER_LAST.sub("", _NUMBER_FIRST.sub("", line))
        broken = bool(_BROKEN.search(line))
        piece = " ".join(line.split())
        if not piece:
            continue
        if broken:
            piece = re.sub(r"[.,;:]?[-¬=\xad][.,;:]?$", "", piece)
        out = out + piece if goes_on or not out else out + " " + piece
        goes_on = broken
    return out, goes_on


def recase(token: str, true: str) -> str:
    """``true`` (upper case) in the case and between the punctuation of ``token``."""
    core = token.strip(EDGE)
    a = token.find(core) if core else 0
    low = [x for x in core if x.isalpha()]
    if low and all(x.islower() for x in low) and not _CHR_LETTER.search(core):
        true = true.lower()
    elif low and low[0].isupper() and len(low) > 1 and any(x.islower() for x in low[1:]) and not _CHR_LETTER.search(core):
        true = true.capitalize()
    elif low and all("ꭰ" <= x <= "ꮿ" or "ᏸ" <= x <= "ᏽ" for x in low):
        true = true.lower()
    return token[:a] + true + token[a + len(core) :] if core else token


class Judge:
    """Log-odds of a word's readings; holds one shard of the vocabulary and the fitted models."""

    def __init__(self, words, channel: Channel, spelling: Spelling, log_total: float):
        self.trie, self.channel, self.spelling, self.log_total = Trie(words), channel, spelling, log_total
        self.most = math.log(max([1, *(n for _, n in words)])) - log_total

    def readings(self, word: str, n: int) -> tuple[float, float, list[tuple[str, float]]]:
        """``(right, derived, candidates)``: log-probabilities of the word as it stands, as a form of a word of this shard, and of each candidate."""
        sp = self.spelling
        right = max(sp.log_unknown + sp.letters(word), math.log(n) - self.log_total if n else -math.inf)
        one = self.trie.within(word, 1, self.channel)
        two = self.trie.within(word, 2, self.channel, right - self.most) if 4 <= len(word) <= WORD_LETTERS else one
        derived = max([sp.derived(v, word) for v in one if v != word], default=-math.inf) + sp.log_unknown
        got = [(v, math.log(max(1, c)) - self.log_total + p) for v, (c, p) in two.items() if v != word]
        return right, derived, [(v, s) for v, s in got if s > max(right, derived)]


# Spark ------------------------------------------------------------------------

ODD = T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("word", T.StringType()), T.StructField("first", T.BooleanType()), T.StructField("left", T.StringType()), T.StructField("right", T.StringType())]))
HEADS = T.ArrayType(T.StructType([T.StructField("k", T.IntegerType()), T.StructField("phrase", T.StringType()), T.StructField("toks", T.IntegerType())]))
_ODD_ARROW = pa.list_(pa.struct([("at", pa.int32()), ("word", pa.string()), ("first", pa.bool_()), ("left", pa.string()), ("right", pa.string())]))
_HEADS_ARROW = pa.list_(pa.struct([("k", pa.int32()), ("phrase", pa.string()), ("toks", pa.int32())]))


def folded(word):
    return F.upper(F.btrim(word, F.lit(EDGE)))


def words_of(documents: DataFrame) -> DataFrame:
    """``(words)``: the tokens of each document in order, words broken at line ends joined."""
    joined = F.regexp_replace("text", r"[-¬=\x{AD}]\s*\n\s*", "")
    return documents.select(F.split(joined, r"\s+").alias("words"))


def word_counts(documents: DataFrame) -> DataFrame:
    """``(word, n)`` of all words of all documents."""
    words = words_of(documents).select(F.explode("words").alias("w")).select(folded(F.col("w")).alias("word"))
    return words.where(F.length("word").between(1, WORD_LETTERS) & F.col("word").rlike(r"\p{L}")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def running_headers(lines: DataFrame, text: str, pages: int = HEADER_PAGES) -> DataFrame:
    """``(phrase)``: lines of two words or more that stand alone with at least ``pages`` different page numbers.

    Rows repeated with the same number count once.  The number is at most four
    digits, so at most 10,000 distinct ones per phrase reach an aggregate.
    """
    upper = F.upper(F.trim(F.col(text)))
    deco = r"[\[(—–*-]?\s*(\d{1,4})\s*[\])—–*-]?\.?"
    before = F.regexp_extract(upper, rf"^{deco}\s+\D+$", 1)
    after = F.regexp_extract(upper, rf"^\D+\s{deco}$", 1)
    number = F.when(before != "", before).otherwise(after)
    words = F.filter(F.transform(F.split(F.regexp_replace(upper, r"[\d\[\]()*—–.,;:-]+", " "), r"\s+"), F.trim), lambda w: w != "")
    c = lines.where(F.col(text).rlike(r"\d")).select(number.try_cast("int").alias("page"), words.alias("w")).where(F.col("page").isNotNull() & (F.size("w") >= 2))
    c = c.select(F.array_join("w", " ").alias("phrase"), "page").distinct()
    return c.groupBy("phrase").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= pages).select("phrase")


def differing(texts: list[str]) -> Iterator[tuple[str, str]]:
    """Folded tokens that differ in one place of two readings with as many tokens."""
    toks = [[fold(t) for t in x.split()] for x in dict.fromkeys(texts)]
    for i, a in enumerate(toks):
        for b in toks[i + 1 :]:
            yield from ((x, y) for x, y in (zip(a, b) if len(a) == len(b) else ()) if x != y and x and y)


def learnt(readings: list[tuple], known) -> tuple[Counter, Counter]:
    """Edits and letters counted over lines that were read several times: ``(true, read)`` to how often, letter to how often."""
    seen, letters = Counter(), Counter()
    for row in readings:
        texts = [canonical(x, known) for x in row if x]
        for x in texts:
            letters.update(c for c in x.upper() if c.isalpha())
        for x, y in differing(texts):
            if (x in known) != (y in known):
                e = edit_of(x, y) if x in known else edit_of(y, x)
                if e:
                    seen[e] += 1
    return seen, letters


#: pairs and letters that a task counts before it hands them on
HELD = 100_000


def edits(readings: DataFrame, key: str, vocabulary: DataFrame, held, whole: bool) -> tuple[dict, dict]:
    """:func:`learnt` over a table: ``held`` is a broadcast set of known words, all of the vocabulary's if ``whole``."""
    cols = [c for c in readings.columns if c != key]
    rows = readings.withColumn("__terms", F.lit(None).cast("array<string>"))
    if not whole:
        rows = readings.join(settling_terms(readings, [key], cols, vocabulary).withColumnRenamed("terms", "__terms"), key, "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n = held.value, Counter()

        def counted():
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in n], pa.string()), pa.array([y for _, y in n], pa.string()), pa.array(n.values(), pa.int64())], ["x", "y", "n"])

        for b in batches:
            for *row, terms in zip(*[c.to_pylist() for c in b.columns]):
                mine = known if whole else frozenset(terms or ())
                texts = [canonical(x, mine) for x in row if x]
                n.update((c, None) for x in texts for c in x.upper() if c.isalpha())
                for x, y in differing(texts):
                    a, b_ = x in known, y in known
                    if (a != b_ or not (a or whole)) and edit_of(x, y):
                        n[min(x, y), max(x, y)] += 1
            if len(n) > HELD:
                yield counted()
                n.clear()
        yield counted()

    got = cut(rows.select(*cols, "__terms").mapInArrow(run, "x string, y string, n long").groupBy("x", "y").agg(F.sum("n").alias("n")))
    letters = {r["x"]: r["n"] for r in got.where("y is null").collect()}
    sure = vocabulary.select("word", F.lit(True).alias("sure"))
    pairs = got.where("y is not null").join(sure.toDF("x", "__x"), "x", "left").join(sure.toDF("y", "__y"), "y", "left").where(F.isnull("__x") != F.isnull("__y"))

    def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            e = [edit_of(x, y) for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in e], pa.string()), pa.array([y for _, y in e], pa.string()), b.column(2)], ["true", "read", "n"])

    true, read = F.when(F.isnull("__x"), F.col("y")).otherwise(F.col("x")), F.when(F.isnull("__x"), F.col("x")).otherwise(F.col("y"))
    seen = pairs.select(true, read, "n").mapInArrow(cores, "true string, read string, n long").groupBy("true", "read").agg(F.sum("n").alias("n"))
    return {(r["true"], r["read"]): r["n"] for r in seen.collect()}, letters


def spelling(vocabulary: DataFrame, size: int, unknown: float) -> Spelling:
    """:class:`Spelling` of a vocabulary of any size: only counts of letter groups reach the driver."""
    w = F.col("word")
    s, n = F.concat(F.lit(FIRST * 2), w, F.lit(LAST)), F.length(w)
    tri = vocabulary.select(F.explode(F.transform(F.sequence(F.lit(1), n + 1), lambda i: F.substring(s, i, F.lit(3)))).alias("g")).groupBy("g").count()
    long = vocabulary.where(n >= STEM)
    parts = F.transform(F.sequence(F.lit(0), F.least(F.lit(TAIL), n - STEM)), lambda t: F.struct(F.substring(w, F.lit(1), n - t).alias("stem"), F.substring(w, n - t + 1, t).alias("tail")))
    stems = cut(long.select(F.explode(parts).alias("p")).select("p.stem", "p.tail"))
    have = cut(stems.groupBy("tail").count().where(F.col("count") >= OFTEN))
    # two endings that stems share often are each frequent, so the others are left out before they are paired
    often = cut(stems.join(have.select("tail"), "tail", "left_semi"))
    both = often.select("stem", F.col("tail").alias("a")).join(often.select("stem", F.col("tail").alias("b")), "stem").where("a != b")
    ends = both.groupBy("a", "b").count().where(F.col("count") >= OFTEN)
    counts = [{tuple(r[:-1]) if len(r) > 2 else r[0]: r["count"] for r in df.collect()} for df in (tri, have, ends)]
    return Spelling.counted(size, *counts, unknown)


@dataclass
class Shared:
    """Tables of any size, and broadcasts of bounded size."""

    counts: DataFrame
    vocabulary: DataFrame
    headers: DataFrame
    shards: int
    lines: object
    models: object
    #: tasks hold the whole vocabulary
    whole: bool = True


def fitted(spark: SparkSession, lexicon: DataFrame, documents: DataFrame, lines: DataFrame, text: str, readings: DataFrame | None = None, key: str = "ord") -> Shared:
    """Counts the words of all documents, finds the running headers and fits the models.

    ``readings`` has a unique ``key`` and lines read several times, one reading a column, all strings.
    """
    counts = cut(word_counts(documents))
    headers = cut(running_headers(lines, text))
    lex = lexicon.where(F.length("term") > 0).select(F.upper("term").alias("word")).distinct()
    heads = headers.select(F.explode(F.split("phrase", " ")).alias("word"))
    vocabulary = cut(counts.where("n >= 2").unionByName(lex.unionByName(heads).withColumn("n", F.lit(1).cast("long"))).groupBy("word").agg(F.max("n").alias("n")))
    facts = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.sum((F.col("n") == 1).cast("long")), F.lit(0)).alias("once")).first()
    size = vocabulary.count()
    # the least frequency whose words are no more than COMMON, in steps of a quarter power of two
    step = F.floor(4 * F.log2("n"))
    room, least = COMMON, 0
    for r in vocabulary.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        if (room := room - r["count"]) < 0:
            least = r["step"] + 1
            break
    whole = least == 0
    sc = spark.sparkContext
    known = frozenset(r["word"] for r in vocabulary.where(step >= least).select("word").collect())
    seen, letters = {}, {}
    if readings is not None:
        cols = [c for c in readings.columns if c != key]
        two = sum((F.coalesce(F.length(c), F.lit(0)) > 0).cast("int") for c in cols) >= 2
        differ = ~F.coalesce(F.greatest(*[F.col(c) for c in cols]) == F.least(*[F.col(c) for c in cols]), F.lit(True))
        seen, letters = edits(readings.where(two & differ), key, vocabulary, sc.broadcast(known), whole)
    channel = Channel(seen, letters)
    unknown = min(0.01, (facts["once"] + 1) / (facts["total"] + 1))
    cells = bytearray(CELLS >> 3)
    crc = F.crc32("phrase").bitwiseAND(CELLS - 1)
    # at most CELLS numbers
    for r in headers.select(crc.alias("c")).distinct().collect():
        cells[r["c"] >> 3] |= 1 << (r["c"] & 7)
    log_total = math.log(max(1, facts["total"], size))
    models = sc.broadcast((channel, spelling(vocabulary, size, unknown), log_total))
    return Shared(counts, vocabulary, headers, max(1, -(-size // SHARD)), sc.broadcast(Lines(known, bytes(cells), whole)), models, whole)


def unknown_words(words: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``words(word)`` without those of the vocabulary and those whose parts between hyphens all are."""
    sure = vocabulary.select("word")
    words = cut(words.join(sure, "word", "left_anti"))
    parts = words.where(F.contains("word", F.lit("-"))).select("word", F.explode(F.filter(F.split("word", "-"), lambda p: p != "")).alias("part"))
    odd = parts.join(sure.toDF("part"), "part", "left_anti").select("word").distinct()
    return words.where(~F.contains("word", F.lit("-"))).unionByName(odd)


def judged(words: DataFrame, shared: Shared) -> DataFrame:
    """``(word, junk, rest, readings)`` of distinct ``words(word)``.

    ``readings`` are the candidates (word, odds) that are likelier than the word
    itself, best first; ``rest``: the word is the end of a vocabulary word.
    Known words that tasks do not hold are left out.
    """
    spark = words.sparkSession
    if not shared.whole:
        words = unknown_words(words, shared.vocabulary)
    w = cut(words.join(shared.counts, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("n")).repartition(2 * spark.sparkContext.defaultParallelism, "word"))
    schema = "word string, junk boolean, right double, derived double, found array<struct<word:string,logp:double>>"
    arrow = pa.schema([("word", pa.string()), ("junk", pa.bool_()), ("right", pa.float64()), ("derived", pa.float64()), ("found", pa.list_(pa.struct([("word", pa.string()), ("logp", pa.float64())])))])

    def look_up(shard, models):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            j = None
            for b in batches:
                if b.num_rows and j is None:
                    j = Judge(shard.value, *models.value)
                rows = [(x, junk(x), *j.readings(x, n)) for x, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
                cols = list(zip(*rows)) if rows else [[]] * 5
                found = [[{"word": v, "logp": s} for v, s in f] for f in cols[4]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip([*cols[:4], found], arrow)], schema=arrow)

        return w.mapInArrow(run, schema)

    got = None
    for s in range(shared.shards):
        mine = shared.vocabulary.where(F.pmod(F.xxhash64("word"), F.lit(shared.shards)) == s)
        part = look_up(spark.sparkContext.broadcast([(r["word"], r["n"]) for r in mine.collect()]), shared.models)
        got = part if got is None else got.unionByName(part)
    g = got.groupBy("word").agg(F.first("junk").alias("junk"), F.greatest(F.max("right"), F.max("derived")).alias("right"), F.flatten(F.collect_list("found")).alias("found"))
    odds = F.transform("found", lambda x: F.struct((x["logp"] - F.col("right")).alias("odds"), x["word"].alias("word")))
    g = g.select("word", "junk", F.array_sort(F.filter(odds, lambda x: x["odds"] > 0), lambda x, y: F.when(x["odds"] > y["odds"], -1).when(x["odds"] < y["odds"], 1).when(x["word"] < y["word"], -1).when(x["word"] > y["word"], 1).otherwise(0)).alias("readings"))
    v = shared.vocabulary.where(F.length("word") > 2)
    ends = v.select(F.explode(F.transform(F.sequence(F.lit(2), F.length("word") - 1), lambda i: F.substring("word", i, F.length("word")))).alias("word"))
    rest = ends.join(w.select("word"), "word", "left_semi").distinct().withColumn("rest", F.lit(True))
    return g.join(rest, "word", "left").select("word", "junk", F.coalesce("rest", F.lit(False)).alias("rest"), "readings")


def looked(df: DataFrame, shared: Shared, key: list[str], text: str, every: bool = False) -> DataFrame:
    """``key``, the canonical text if ``every``, ``faults``, ``heads`` and ``odd``; unless ``every``, only rows that have any of these."""
    schema = T.StructType([*df.select(*key).schema.fields, *([T.StructField("__text", T.StringType())] if every else []), T.StructField("faults", T.ArrayType(T.StringType())), T.StructField("heads", HEADS), T.StructField("odd", ODD)])
    lines, k = shared.lines, len(key)
    rows = df.where(F.col(text) != "").select(*key, text)
    terms = F.lit(None).cast("array<string>")
    if not shared.whole:
        rows, terms = rows.join(settling_terms(rows, key, [text], shared.vocabulary).withColumnRenamed("terms", "__terms"), key, "left"), F.col("__terms")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = lines.value
        for b in batches:
            got = [r.look(t, x) for t, x in zip(b.column(k).to_pylist(), b.column(k + 1).to_pylist())]
            keep = [every or bool(g[1] or g[2] or g[3]) for g in got]
            got = [g for g, ok in zip(got, keep) if ok]
            cols = [b.column(i).filter(pa.array(keep, pa.bool_())) for i in range(k)] + ([pa.array([g[0] for g in got], pa.string())] if every else [])
            cols.append(pa.array([g[1] for g in got], pa.list_(pa.string())))
            cols.append(pa.array([[dict(zip(("k", "phrase", "toks"), h)) for h in g[2]] for g in got], _HEADS_ARROW))
            cols.append(pa.array([[dict(zip(("at", "word", "first", "left", "right"), o)) for o in g[3]] for g in got], _ODD_ARROW))
            yield pa.RecordBatch.from_arrays(cols, schema.names)

    return rows.select(*key, text, terms).mapInArrow(run, schema)


def faulty(df: DataFrame, shared: Shared, key: list[str], text: str) -> DataFrame:
    """``key`` columns and ``faults`` (broken, header, misread, number) of the rows whose text has any; ``key`` is unique."""
    # keys travel as one column, so their names cannot clash
    names, df, key = key, df.select(F.struct(*key).alias("__key"), text), ["__key"]
    got = cut(looked(df, shared, key, text))
    odd = got.select(*key, F.explode("odd").alias("o")).select(*key, "o.word", "o.first")
    bad = judged(odd.select("word").distinct(), shared).where(F.col("junk") | (F.size("readings") > 0)).select("word", F.col("rest") & ~F.col("junk"))
    misread = odd.join(bad.toDF("word", "__rest"), "word").where(~(F.col("first") & F.col("__rest"))).select(*key, F.lit("misread").alias("fault"))
    head = got.select(*key, F.explode("heads.phrase").alias("phrase")).join(shared.headers, "phrase").select(*key, F.lit("header").alias("fault"))
    local = got.select(*key, F.explode("faults").alias("fault"))
    every = local.unionByName(misread).unionByName(head).groupBy(*key).agg(F.array_sort(F.collect_set("fault")).alias("faults"))
    return every.select(*[F.col("__key")[c].alias(c) for c in names], "faults")


def context(pairs: DataFrame, documents: DataFrame) -> DataFrame:
    """``(left, right, n)``: how often the word pairs of ``pairs(left, right)`` stand beside each other in all documents; pairs never seen are left out."""
    w = words_of(documents).select(F.transform("words", folded).alias("w"))
    both = w.select(F.explode(F.zip_with(F.slice("w", 1, F.size("w") - 1), F.slice("w", 2, F.size("w")), lambda a, b: F.struct(a.alias("left"), b.alias("right")))).alias("p")).select("p.left", "p.right")
    return both.join(pairs.distinct(), ["left", "right"], "left_semi").groupBy("left", "right").agg(F.count(F.lit(1)).alias("n"))


def mended(df: DataFrame, shared: Shared, key: list[str], text: str, documents: DataFrame | None = None) -> DataFrame:
    """``key``, ``mended`` text and ``goes_on``: whether its last word continues in the next line; ``key`` is unique.

    ``documents`` give the context of candidates of like weight.
    """
    names, df, key = key, df.select(F.struct(*key).alias("__key"), text), ["__key"]
    a = cut(looked(df, shared, key, text, every=True))
    odd = a.select(*key, F.explode("odd").alias("o")).select(*key, "o.*")
    verdict = judged(odd.select("word").distinct(), shared).where(F.size("readings") > 0).withColumnRenamed("rest", "__rest")
    j = odd.join(verdict, "word").where(~(F.col("first") & F.col("__rest") & ~F.col("junk")))
    best = F.element_at("readings", 1)["odds"]
    near = F.filter("readings", lambda x: x["odds"] >= best - TIE)
    if documents is None:
        put = j.select(*key, "at", F.struct(best.alias("odds"), F.element_at("readings", 1)["word"].alias("true")).alias("pick"))
    else:
        j = cut(j.select(*key, "at", "left", "right", near.alias("near")))
        one = j.where(F.size("near") == 1).select(*key, "at", F.struct(F.col("near")[0]["odds"].alias("odds"), F.col("near")[0]["word"].alias("true")).alias("pick"))
        c = j.where(F.size("near") > 1).select(*key, "at", "left", "right", F.explode("near").alias("x")).select(*key, "at", "left", "right", "x.odds", F.col("x.word").alias("true"))
        n = cut(context(c.select("left", F.col("true").alias("right")).union(c.select(F.col("true").alias("left"), "right")).where("left != '' and right != ''"), documents))
        c = c.join(n.toDF("left", "true", "n_left"), ["left", "true"], "left").join(n.toDF("true", "right", "n_right"), ["true", "right"], "left")
        beside = F.log1p(F.coalesce("n_left", F.lit(0)) + F.coalesce("n_right", F.lit(0)))
        many = c.groupBy(*key, "at").agg(F.max_by(F.struct("odds", "true"), F.struct((F.col("odds") + beside).alias("s"), F.col("true"))).alias("pick"))
        put = one.unionByName(many)
    puts = put.groupBy(*key).agg(F.collect_list(F.struct("at", "pick.odds", "pick.true")).alias("__put"))
    # only lines that have something to put right cross the network again
    some = a.where(F.size("odd") > 0).drop("odd", "faults", "heads").join(puts, key, "left")
    schema = T.StructType([*df.select(*key).schema.fields, T.StructField("__text", T.StringType()), T.StructField("heads", HEADS)])
    lines, k = shared.lines, len(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = lines.value
        for b in batches:
            got = []
            for t, put in zip(b.column(k).to_pylist(), b.column(k + 1).to_pylist()):
                toks = t.split()
                sure = {p["at"]: p["true"] for p in put or () if p["odds"] > (CLEAR_NAME if toks[p["at"]].strip(EDGE)[:1].isupper() and toks[p["at"]].isascii() else CLEAR)}
                got.append(r.correct(t, sure))
            heads = [[dict(zip(("k", "phrase", "toks"), h)) for h in g[1]] for g in got]
            yield pa.RecordBatch.from_arrays([*b.columns[:k], pa.array([g[0] for g in got], pa.string()), pa.array(heads, _HEADS_ARROW)], schema.names)

    right = cut(some.mapInArrow(run, schema)).unionByName(a.where(F.size("odd") == 0).select(*key, "__text", "heads"))
    hit = right.where(F.size("heads") > 0).select(*key, F.explode("heads").alias("h")).select(*key, "h.*").join(shared.headers, "phrase").groupBy(*key, "k").agg(F.max("toks").alias("toks"))
    cuts = hit.groupBy(*key).agg(F.map_from_entries(F.collect_list(F.struct("k", "toks"))).alias("__cuts"))
    kind = T.StructType([T.StructField("mended", T.StringType()), T.StructField("goes_on", T.BooleanType())])

    @F.pandas_udf(kind)
    def whole(col: pd.Series, cuts: pd.Series) -> pd.DataFrame:
        got = [assemble(x, dict(c) if c is not None else {}) for x, c in zip(col, cuts)]
        return pd.DataFrame({"mended": [g[0] for g in got], "goes_on": [g[1] for g in got]})

    none = F.lit(None).cast("map<int,int>").alias("__cuts")
    both = right.where(F.size("heads") == 0).select(*key, "__text", none).unionByName(right.where(F.size("heads") > 0).drop("heads").join(cuts, key, "left").select(*key, "__text", "__cuts"))
    return both.select(*key, whole("__text", "__cuts").alias("__m")).select(*[F.col("__key")[c].alias(c) for c in names], "__m.*")


#: lines of one column that one task orders
BUCKET = 65_536
#: a line that ends a sentence ends a paragraph
_STOP = r"[.!?][\"'”’)\]]*$"


def paragraphs(lines: DataFrame, shared: Shared, text: str, documents: DataFrame | None = None) -> DataFrame:
    """``(tbl, place, par, n_lines, body)``: continuous text of each column or verse, in paragraphs numbered from 0.

    ``lines`` has ``tbl``, ``id``, ``ord`` (latest wins) and the text.  Page
    furniture is gone before lines are put one after another, so a word broken
    over it is whole again.  A paragraph ends with a line that ends a sentence
    and is never cut within a word.  Lines are ordered in buckets of
    :data:`BUCKET`, of which only sums are carried on, so a column may have any
    length; a paragraph also ends where its bucket does.
    """
    last = lines.where(F.col("id").isNotNull()).groupBy("tbl", "id").agg(F.max_by(text, "ord").alias(text))
    place = F.regexp_replace("id", r"_line_\d+$", "")
    no = F.regexp_extract("id", r"_line_(\d+)$", 1).try_cast("int")
    m = mended(last.select("tbl", place.alias("place"), F.coalesce(no, F.lit(0)).alias("no"), F.col("id").alias("__id"), text), shared, ["tbl", "place", "no", "__id"], text, documents).where("mended != ''")
    m = m.withColumn("bucket", F.floor(F.col("no") / BUCKET)).withColumn("stop", (~F.col("goes_on") & F.col("mended").rlike(_STOP)).cast("int"))
    w = Window.partitionBy("tbl", "place", "bucket").orderBy("no", "__id")
    inside = F.coalesce(F.sum("stop").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    g = m.withColumn("par", inside).groupBy("tbl", "place", "bucket", "par").agg(F.array_sort(F.collect_list(F.struct("no", "__id", F.concat("mended", F.when(F.col("goes_on"), "").otherwise(" ")).alias("t")))).alias("a"))
    g = g.withColumn("n_lines", F.size("a").cast("long")).withColumn("body", F.rtrim(F.array_join(F.transform("a", lambda x: x["t"]), "")))
    number = F.row_number().over(Window.partitionBy("tbl", "place").orderBy("bucket", "par")) - 1
    return g.select("tbl", "place", number.alias("par"), "n_lines", "body")
