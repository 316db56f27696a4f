"""Filling fixed-capacity containers (problem 7).

Best-two-fit: a container is filled greedily, each time with the largest item
that fits; then its smallest item is replaced by two unpacked ones that fit the
gap so widened more tightly.

The items are dealt to shards by a hash, which no hot source can skew, and each
shard is packed on its own.  Containers left less than :data:`FULL` full are
opened again and their items packed together in the next round, until these fit
one shard or a round closes less than a tenth of what it was given: then the
items left cannot be packed much better, and their containers stay.  An item above the capacity is cut at natural boundaries first
(:mod:`linecorpus.llm.pieces`); no other is cut.

Null texts are left out, empty ones take a place of size 0 each; equal sizes are
packed in order of their keys, so the result is the same on every run.
"""

from __future__ import annotations

from bisect import bisect_right, insort

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linecorpus.llm.pieces import pieces
from linecorpus.llm.tokens import size
from linecorpus.plans.lineage import cut

#: items of one shard
SHARD = 4000
#: a container filled to this share stays closed
FULL = 0.97
#: a round that closes a smaller share of its items is the last
GAIN = 0.1


class _Shelf:
    """Unpacked items by size."""

    def __init__(self, sizes: list[int]):
        self.by: dict[int, list[int]] = {}
        for i in range(len(sizes) - 1, -1, -1):
            self.by.setdefault(sizes[i], []).append(i)
        self.sizes = sorted(self.by)

    def largest(self, room: int) -> int | None:
        """The largest size that fits ``room``."""
        k = bisect_right(self.sizes, room)
        return self.sizes[k - 1] if k else None

    def take(self, size: int) -> int:
        items = self.by[size]
        i = items.pop()
        if not items:
            del self.by[size]
            self.sizes.pop(bisect_right(self.sizes, size) - 1)
        return i

    def put(self, size: int, item: int) -> None:
        if size in self.by:
            self.by[size].append(item)
        else:
            self.by[size] = [item]
            insort(self.sizes, size)

    def two(self, room: int, above: int) -> tuple[int, int] | None:
        """Two unpacked sizes of the greatest sum within ``room`` that exceeds ``above``."""
        s = self.sizes
        lo, hi, best, found = 0, bisect_right(s, room) - 1, above, None
        while lo <= hi:
            if lo == hi and len(self.by[s[lo]]) < 2:
                break
            t = s[lo] + s[hi]
            if t > room:
                hi -= 1
                continue
            if t > best:
                best, found = t, (s[lo], s[hi])
                if t == room:
                    break
            lo += 1
        return found


def pack(sizes: list[int], capacity: int) -> list[list[int]]:
    """Best-two-fit of items (by index) into containers."""
    shelf, out = _Shelf(sizes), []
    while shelf.sizes:
        room, got = capacity, []
        while (n := shelf.largest(room)) is not None:
            got.append((n, shelf.take(n)))
            room -= n
        if not got:
            raise ValueError("an item is larger than the capacity")
        if room and len(got) > 1:
            least, item = min(got)
            pair = shelf.two(room + least, least)
            if pair:
                got.remove((least, item))
                got += [(x, shelf.take(x)) for x in pair]
                shelf.put(least, item)
        out.append([i for _, i in got])
    return out


def containers(df: DataFrame, key: str, text: str, capacity: int, shard: int = SHARD, tokenizer: str = "byt5", path: str | None = None) -> DataFrame:
    """``(key, piece, tokens, container, filled)``: the container of each document or piece.

    ``piece`` is null for an uncut document.  ``container`` is a name,
    ``filled`` the tokens in it.  Sizes are counted by ``tokenizer``
    (:mod:`linecorpus.llm.tokens`).
    """
    whole = df.where(F.col(text).isNotNull()).select(F.col(key).alias("__k"), F.col(text).alias("__t"), size(F.col(text), tokenizer, path).alias("tokens"))
    fits = F.col("tokens") <= capacity
    cut_up = pieces(whole.where(~fits), ["__k"], "__t", capacity, 0, tokenizer, path)
    items = whole.where(fits).select("__k", F.lit(None).cast("int").alias("piece"), "tokens").unionByName(cut_up.select("__k", "piece", F.col("tokens").cast("long").alias("tokens")))
    items = cut(items)
    kind = items.schema["__k"].dataType.simpleString()
    schema = f"__k {kind}, piece int, tokens long, container string, filled long"

    def run(name: str):
        def packed(group, pdf):
            import pandas as pd

            pdf = pdf.sort_values(["tokens", "__k", "piece"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
            sizes = [int(x) for x in pdf["tokens"]]
            box, filled = [0] * len(sizes), [0] * len(sizes)
            for b, ids in enumerate(pack(sizes, capacity)):
                t = sum(sizes[i] for i in ids)
                for i in ids:
                    box[i], filled[i] = b, t
            return pd.DataFrame({"__k": pdf["__k"], "piece": pdf["piece"].astype("Int32"), "tokens": pdf["tokens"], "container": [f"{name}-{int(group[0]):05d}-{b:06d}" for b in box], "filled": filled})

        return packed

    done, n, k = None, items.count(), 0
    while True:
        shards = max(1, -(-n // shard))
        placed = items.withColumn("__s", F.pmod(F.xxhash64(F.lit(k), "__k", "piece"), F.lit(shards)).cast("int"))
        got = cut(placed.groupBy("__s").applyInPandas(run(f"r{k}"), schema))
        rest = got.where(F.col("filled") < FULL * capacity).select("__k", "piece", "tokens")
        left = 0 if shards == 1 else rest.count()
        last = shards == 1 or n - left < GAIN * n
        closed = got if last else got.where(F.col("filled") >= FULL * capacity)
        done = closed if done is None else done.unionByName(closed)
        if last or not left:
            break
        items, n, k = rest, left, k + 1
    return done.withColumnRenamed("__k", key)
