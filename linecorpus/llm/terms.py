"""Frequency of every distinct term, in total and by records (problem 4).

Each task reads its records in order and keeps, for each term, last-seen
counters: occurrences, records and the record that held it last; a term's
record count grows only when another record comes, so no per-record sets are
needed.  Partial counters are hash-partitioned by term and summed.

A null or empty text is no record; a text of white space alone is a record
without terms.  Ties do not arise; repeated rows count each; an empty table
gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: counters a task holds before it passes them on
HELD = 500_000


def term_counts(df: DataFrame, text: str) -> DataFrame:
    """``(term, occurrences, records)`` of all terms of column ``text``: NFC, upper case, split at white space."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[int]] = {}
        record = 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"term": list(held), "occurrences": [x[0] for x in held.values()], "records": [x[1] for x in held.values()]}, pa.schema([("term", pa.string()), ("occurrences", pa.int64()), ("records", pa.int64())]))

        for b in batches:
            for t in b.column(0).to_pylist():
                if not t:
                    continue
                record += 1
                for w in unicodedata.normalize("NFC", t).upper().split():
                    c = held.get(w)
                    if c is None:
                        held[w] = [1, 1, record]
                    else:
                        c[0] += 1
                        if c[2] != record:
                            c[1] += 1
                            c[2] = record
            if len(held) > HELD:
                yield out()
                held.clear()
        if held:
            yield out()

    part = df.select(text).where(F.col(text) != "").mapInArrow(run, "term string, occurrences long, records long")
    return part.groupBy("term").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))


def marked_terms(df: DataFrame, text: str, rare_below: int = 3, common_above: float = 0.01) -> DataFrame:
    """:func:`term_counts` with ``mark``: ``rare``, ``common`` or null.

    ``rare`` is in fewer than ``rare_below`` records, ``common`` in more than
    the share ``common_above`` of them; a term that is both is rare.
    """
    total = df.where(F.col(text) != "").agg(F.count(F.lit(1))).scalar()
    c = term_counts(df, text)
    # in whole millionths, so that no share is rounded across the line
    above = F.col("records") * 1_000_000 > F.lit(round(common_above * 1_000_000)) * total
    return c.withColumn("mark", F.when(F.col("records") < rare_below, "rare").when(above, "common"))
