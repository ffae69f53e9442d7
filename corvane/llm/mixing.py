"""Mixing sources to target weights through blocks of words.

Each source's words, its documents in a fixed order, form one stream cut into blocks of ``block``
words. The mix is a sequence of slots in output shards. A source has as many slots as its target needs, and
throws them over the shards by a multinomial draw, so that a shard's source counts are a multinomial draw too, given its size.
A source's j-th slot takes block perm(j mod n) of its n blocks, perm a keyed pseudorandom permutation of indices for each epoch:
every block comes once before any comes twice. The last slot takes as many words of its block as the
target still wants. Blocks are joined to slots by (source, block), never gathered by source.

Null and empty texts have no words. Null is a source like others. Repeated rows are documents of their own; an empty
table gives no rows; a very long text is many blocks; rows with a null id are documents like others. Reruns draw the
same. ``mix`` drops columns but those in ``keep``; ``mixed`` keeps all, whatever their names. The driver holds one row a source.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from corvane.llm._spark import cut, stored

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint"))


def targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Shares of total by weight; what exceeds ``most`` times a source's size goes to the others by weight until none exceeds it."""
    out, free = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(total)
    while free:
        weight = sum(weights[i] for i in free)
        over = {i for i in free if left * weights[i] / weight > most * sizes[i]} if weight else set()
        if not over:
            for i in free:
                out[i] = left * weights[i] / weight if weight else 0.0
            break
        for i in over:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in over)
        free -= over
    return out


def _round(half: np.ndarray, key: int, i: int) -> np.ndarray:
    f = (half + np.uint64((key * 2 + 1 + i * 0x9E3779B97F4A7C15) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
    f ^= f >> np.uint64(29)
    f *= np.uint64(0x94D049BB133111EB)
    return f >> np.uint64(32)


def permute(j: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """A keyed bijection of 0..n-1 at each j (its inverse if ``back``): four Feistel rounds over the next even power of two, walked until below n."""
    if n <= 1:
        return np.zeros(len(j), np.int64)
    bits = np.uint64(max(1, -(-int(n - 1).bit_length() // 2)))
    mask = (np.uint64(1) << bits) - np.uint64(1)

    def rounds(x: np.ndarray) -> np.ndarray:
        a, b = x >> bits, x & mask
        for i in range(4):
            if back:
                a, b = b ^ (_round(a, key, 3 - i) & mask), a
            else:
                a, b = b, a ^ (_round(b, key, i) & mask)
        return (a << bits) | b

    x = rounds(j.astype(np.uint64))
    while (out := x >= n).any():
        x[out] = rounds(x[out])
    return x.astype(np.int64)


def throw(n: int, shards: int, seed: tuple[int, ...]) -> np.ndarray:
    """n slots over shards of equal chance."""
    return np.random.Generator(np.random.PCG64(list(seed))).multinomial(n, np.full(shards, 1 / shards))


class Stream:
    """A source's words as blocks, and the slots that take ``target`` of them."""

    def __init__(self, sid: int, size: int, target: int, block: int, seed: int):
        self.sid, self.size, self.target, self.block, self.seed = sid, size, target, block, seed
        self.blocks = -(-size // block)
        self.last = size - (self.blocks - 1) * block  # words of the last block
        self.whole, self.rest = divmod(target, size) if size else (0, 0)
        # Where the last block, which may be shorter, comes in the epoch that is not taken whole.
        self.short = int(permute(np.array([self.blocks - 1]), self.blocks, self.key(self.whole), True)[0]) if size else 0
        part = -(-self.rest // block)
        if part > self.short:
            part = -(-(self.rest + block - self.last) // block)
        self.slots = self.whole * self.blocks + part

    def key(self, epoch: int) -> int:
        return self.seed * 1_000_003 + self.sid * 101 + epoch

    def take(self, j: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Epoch, block and number of words of each slot."""
        epoch, i = np.divmod(j, self.blocks)
        index = np.empty(len(j), np.int64)
        for e in np.unique(epoch):
            index[epoch == e] = permute(i[epoch == e], self.blocks, self.key(int(e)))
        words = np.where(index == self.blocks - 1, self.last, self.block)
        before = i * self.block - (self.block - self.last) * (i > self.short)
        return epoch, index, np.where(epoch < self.whole, words, np.minimum(words, self.rest - before))


#: Shards that are drawn for together.
TOGETHER = 1024


class Mix:
    """sizes: one row per document (rid, source, size, source_size, target, and its block range);
    slots: one row per slot (shard, slot, source_key, epoch, block); pieces: blocks' parts of documents."""

    def __init__(self, docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.0, most: float = 3.0, block: int = 256, seed: int = 17, text: str = "text", source: str = "source", row: str = "doc_id", keep: tuple[str, ...] = (), rid: Column | None = None, per_shard: int = 4096):
        spark = docs.sparkSession
        # Documents lie in a source's stream by a hash of id and text, so the mix is the same however the table is read.
        place = F.xxhash64(*([row] if row in docs.columns else []), F.xxhash64(text))
        d = docs.select((F.monotonically_increasing_id() if rid is None else rid).alias("rid"), F.col(source).cast("string").alias("source"), *keep, n_words(F.col(text)).alias("size"), place.alias("place"))
        d = cut(d)
        total = d.groupBy("source").agg(F.sum("size").alias("n"), F.count("*").alias("docs")).collect()  # one row a source
        rows = sorted(((x["source"], x["n"]) for x in total), key=lambda x: (x[0] is None, x[0] or ""))
        chunk = F.pmod("place", F.lit(max(1, sum(x["docs"] for x in total) // 1_000)))
        sizes = [n for _, n in rows]
        goal = targets(sizes, [weights[i % len(weights)] for i in range(len(rows))], share * sum(sizes), most)
        streams = [Stream(i, n, min(round(t), int(most * n)), block, seed) for i, (n, t) in enumerate(zip(sizes, goal, strict=True))]
        known = spark.createDataFrame([(i, s, n, t, streams[i].target, streams[i].slots) for i, ((s, n), t) in enumerate(zip(rows, goal, strict=True))], "sid int, source string, source_size bigint, target double, words bigint, slots bigint")
        # Running word counts in two levels: within a chunk of a source, then over its chunks.
        per = d.groupBy("source", chunk.alias("chunk")).agg(F.sum("size").alias("n"))
        per = per.withColumn("before", F.sum("n").over(W.partitionBy("source").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1))).drop("n")
        own = F.sum("size").over(W.partitionBy("source", "chunk").orderBy("place", "rid").rowsBetween(W.unboundedPreceding, -1))
        d = d.withColumn("chunk", chunk).withColumn("own", F.coalesce(own, F.lit(0)))
        d = d.alias("d").join(per.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.chunk") == F.col("p.chunk"))).select("d.*", "before")
        d = d.alias("d").join(known.alias("k"), F.col("d.source").eqNullSafe(F.col("k.source"))).select("d.*", "sid", "source_size", "target")
        self.sizes = d.withColumn("first", F.col("own") + F.coalesce("before", F.lit(0))).drop("own", "before", "chunk", "place")
        lo, hi = F.floor(F.col("first") / block), F.floor((F.col("first") + F.col("size") - 1) / block)
        b = self.sizes.where("size > 0").select("rid", "sid", "first", "size", F.explode(F.sequence(lo, hi)).alias("block"))
        start = F.greatest(F.col("block") * block, F.col("first"))
        self.pieces = b.select("rid", "sid", "block", (start - F.col("first")).alias("start"), (start - F.col("block") * block).alias("inside"), (F.least((F.col("block") + 1) * block, F.col("first") + F.col("size")) - start).alias("n"))

        n_slots = sum(x.slots for x in streams)
        shards = max(1, -(-n_slots // per_shard))
        groups = -(-shards // TOGETHER)

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """A source's slots over groups of shards: the first slot and the number of each group's."""
            for part in batches:
                for sid, n in zip(part["sid"].to_pylist(), part["slots"].to_pylist(), strict=True):
                    count = throw(n, groups, (seed, sid))
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(groups)), pa.array(np.full(groups, sid, np.int32)), pa.array(np.cumsum(count) - count), pa.array(count)], ["group", "sid", "j", "n"])

        def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in batches:
                for group, sid, j, n in zip(*(part[c].to_pylist() for c in ("group", "sid", "j", "n")), strict=True):
                    width = min(TOGETHER, shards - group * TOGETHER)
                    count = throw(n, width, (seed, sid, group + 1))
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(width) + group * TOGETHER), pa.array(np.full(width, sid, np.int32)), pa.array(j + np.cumsum(count) - count), pa.array(count)], ["shard", "sid", "j", "n"])

        def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            streams: dict[int, Stream] = {}
            for part in batches:
                for shard, sid, j, n, at, size, words in zip(*(part[c].to_pylist() for c in ("shard", "sid", "j", "n", "at", "source_size", "words")), strict=True):
                    own = streams.get(sid) or streams.setdefault(sid, Stream(sid, size, words, block, seed))
                    for low in range(j, j + n, 100_000):
                        x = np.arange(low, min(low + 100_000, j + n))
                        epoch, index, take = own.take(x)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), shard)), pa.array(at + x - j), pa.array(np.full(len(x), sid, np.int32)), pa.array(epoch.astype(np.int32)), pa.array(index), pa.array(take)], ["shard", "slot", "sid", "epoch", "block", "take"])

        plan = known.where("slots > 0").select("sid", "slots").mapInArrow(deal, "group bigint, sid int, j bigint, n bigint").where("n > 0").repartition(max(1, groups // 8), "group", "sid")
        plan = plan.mapInArrow(within, "shard bigint, sid int, j bigint, n bigint").where("n > 0")
        at = F.coalesce(F.sum("n").over(W.partitionBy("shard").orderBy("sid").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        plan = plan.withColumn("at", at).join(known.select("sid", "source_size", "words"), "sid").select("shard", "sid", "j", "n", "at", "source_size", "words")
        self.slots = plan.repartition(max(1, n_slots // 50_000), "shard", "sid").mapInArrow(slots, "shard bigint, slot bigint, sid int, epoch int, block bigint, take bigint")

    def taken(self) -> DataFrame:
        """rid, epoch, start, n: each part of a document that the mix takes, with its shard and slot."""
        # Spark cannot see that the slots, made from a short plan, grow with the input: never broadcast them.
        met = self.slots.hint("merge").join(self.pieces, ["sid", "block"]).withColumn("n", F.least("n", F.col("take") - F.col("inside")))
        return met.where("n > 0").select("shard", "slot", "rid", "epoch", "start", "n")


def mix(docs: DataFrame, **options) -> DataFrame:
    """One row per document: rid, source, size, source_size, target and taken (words the mix takes, repeats counted)."""
    m = Mix(docs, **options)
    t = m.taken().groupBy("rid").agg(F.sum("n").alias("taken"))
    return m.sizes.join(t, "rid", "left").withColumn("taken", F.coalesce("taken", F.lit(0).cast("bigint"))).drop("sid", "first")


def mixed(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """The mix as documents: for each epoch, what it takes of a document, in the document's order, with docs' own columns.

    A document taken whole keeps its text as it is; of others the taken stretches of words are cut
    out of the text with their own white space and joined by a line break.
    """
    names = docs.columns
    # Row numbers are given once, and the mix and its texts are read from what was written then.
    held = stored(docs.withColumn("__rid", F.monotonically_increasing_id()), "mixing")
    m = Mix(held, text=text, rid=F.col("__rid"), **options)
    t = m.taken().groupBy("rid", "epoch").agg(F.sort_array(F.collect_list(F.struct("start", "n"))).alias("parts"), F.sum("n").alias("n"))
    t = t.groupBy("rid").agg(F.collect_list(F.struct("n", "parts")).alias("copies"))
    numbered = held.join(t.withColumnRenamed("rid", "__rid").withColumnRenamed("copies", "__copies"), "__rid")
    numbered = numbered.withColumn("__size", n_words(F.col(text))).withColumn("__copy", F.explode("__copies")).drop("__copies", "__rid")

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        from corvane.llm._arrow import slices

        word = re.compile(WORD)
        for b in slices(batches, text, 8_000_000):
            texts = b[text].to_pylist()
            for i, (copy, size) in enumerate(zip(b["__copy"].to_pylist(), b["__size"].to_pylist(), strict=True)):
                if copy["n"] == size:
                    continue
                at = [x.span() for x in word.finditer(texts[i])]
                runs: list[list[int]] = []
                for p in copy["parts"]:
                    if runs and runs[-1][1] == p["start"]:
                        runs[-1][1] += p["n"]
                    else:
                        runs.append([p["start"], p["start"] + p["n"]])
                texts[i] = "\n".join(texts[i][at[x][0] : at[y - 1][1]] for x, y in runs)
            yield pa.RecordBatch.from_arrays([pa.array(texts, b.schema.field(text).type) if n == text else b[n] for n in names], names)

    out = numbered.mapInArrow(cut_out, docs.schema)
    return out.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in names else out
