"""Ordered and random selection: interleaving, quotas, strata, windows, placement, packing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corvane.functions import numeric


def interleave(df: DataFrame, source: str, order: list[str], stop_at_shortest: bool = False) -> DataFrame:
    """``turn``: a row's place within its source; sorted by (turn, source), sources take turns and drop out when exhausted."""
    out = df.withColumn("turn", F.row_number().over(W.partitionBy(source).orderBy(*order)))
    if not stop_at_shortest:
        return out
    shortest = df.groupBy(source).agg(F.count("*").alias("n")).agg(F.min("n").alias("__least"))
    return out.join(F.broadcast(shortest), F.col("turn") <= F.col("__least")).drop("__least")  # one row


def stratified(df: DataFrame, strata: list[str], row: str, n: int, seed: str = "0") -> DataFrame:
    """n rows a stratum by seeded digest order, with the probability that a row of it is taken."""
    ranked = df.withColumn("__d", numeric.hash_rank(seed, F.col(row))).withColumn("rank", F.row_number().over(W.partitionBy(*strata).orderBy("__d", row))).where(F.col("rank") <= n)
    size = df.groupBy(*strata).agg(F.count("*").alias("__n"))
    return ranked.join(size, strata).withColumn("inclusion", F.least(F.lit(n), F.col("__n")) / F.col("__n")).drop("__d", "__n")


def capped(df: DataFrame, group: str, order: list[Column], cap: int) -> DataFrame:
    """At most ``cap`` rows a group, the first by order."""
    return df.withColumn("__r", F.row_number().over(W.partitionBy(group).orderBy(*order))).where(F.col("__r") <= cap).drop("__r")


def largest_remainder(weights: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Whole quotas that sum to total: floors, then one more by falling remainder, ties by key. weights is one row a group."""
    share = F.col(weight) / F.sum(weight).over(W.partitionBy()) * total
    q = weights.withColumn("__share", share).withColumn("__floor", F.floor("__share")).withColumn("__left", F.lit(total) - F.sum("__floor").over(W.partitionBy()))
    rank = F.row_number().over(W.orderBy(F.desc(F.col("__share") - F.col("__floor")), key))
    return q.withColumn("quota", (F.col("__floor") + F.when(rank <= F.col("__left"), 1).otherwise(0)).cast("bigint")).drop("__share", "__floor", "__left")


def mixture_weights(df: DataFrame, language: str, hours: str, temperature: float = 1.0, undated_seconds: float = 10.0) -> DataFrame:
    """Share of each language: hours (undated rows count some seconds) to the power 1/temperature, normalised."""
    h = df.groupBy(language).agg(F.sum(F.coalesce(F.col(hours), F.lit(undated_seconds / 3600))).alias("hours"))
    p = F.pow(F.col("hours"), 1 / temperature)
    return h.withColumn("weight", p / F.sum(p).over(W.partitionBy()))  # one row a language


def windows(df: DataFrame, group: str, order: list[str], size: int, ranks: int = 1, micro: int = 1) -> DataFrame:
    """Fixed windows of ``size`` rows within a group, and within a window the rank that takes a row: chunks of ``micro`` in turn."""
    at = F.row_number().over(W.partitionBy(group).orderBy(*order)) - 1
    return df.withColumn("__at", at).withColumn("window", F.floor(F.col("__at") / size)).withColumn("rank", F.pmod(F.floor(F.pmod("__at", F.lit(size)) / micro), F.lit(ranks))).drop("__at")


def greedy_packs(df: DataFrame, group: str, order: str, length: str, budget: int, cap: int) -> DataFrame:
    """(group, order, pack): in order, a pack takes rows while longest * count fits the budget and count the cap.

    A row over budget alone is a pack of its own. A fold over the group's ordered lengths keeps the open pack only.
    """
    rows = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(length).cast("bigint").alias("n"))))
    start = F.struct(F.lit(0).cast("bigint").alias("top"), F.lit(0).alias("count"), F.lit(0).alias("pack"), F.array().cast("array<int>").alias("out"))

    def step(a, x):
        top = F.greatest(a["top"], x["n"])
        fits = (a["count"] == 0) | ((a["count"] < cap) & (top * (a["count"] + 1) <= budget))
        pack = F.when(fits, a["pack"]).otherwise(a["pack"] + 1)
        return F.struct(F.when(fits, top).otherwise(x["n"]).alias("top"), F.when(fits, a["count"] + 1).otherwise(1).alias("count"), pack.alias("pack"), F.concat(a["out"], F.array(pack)).alias("out"))

    folded = df.groupBy(group).agg(rows.alias("rows")).withColumn("packs", F.aggregate("rows", start, step)["out"])
    return folded.select(group, F.explode(F.arrays_zip("rows", "packs")).alias("z")).select(group, F.col("z.rows.o").alias(order), F.col("z.rows.n").alias(length), F.col("z.packs").alias("pack"))


PLACED = "outcome string, batch int"


def place(df: DataFrame, group: str, order: list[str], source: str, text_key: str, path: str, batch_size: int, source_cap: float, text_cap: int = 2, least_distinct: float = 0.5) -> DataFrame:
    """Exact best-first batch placement within a group: outcome and batch of each row.

    Row by row: a path already placed is a duplicate; a source is capped once the batch holds
    its share (binding only when the batch has as many rows as the cap); a text is capped across
    batches. A full batch with too small a share of distinct texts is refused: its rows get that outcome,
    its paths and texts are free again. The order decides, so a group is one sequential pass: rows
    stream through sorted, and state is one counter a path and text.
    """
    from collections import Counter
    from collections.abc import Iterator

    import pyarrow as pa

    from corvane.ship import ship

    ship(df.sparkSession)
    names = df.columns
    cap = max(1, int(batch_size * source_cap))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, rows = None, []

        def emit(last: bool):
            nonlocal rows
            # Rows of the open batch wait for its verdict; all before them are settled.
            ready = rows if last else []
            if not last:
                while rows and rows[0][1] is not None:
                    ready.append(rows.pop(0))
            else:
                rows = []
            if ready:
                cols = list(zip(*(r[0] for r in ready), strict=True))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(cols, kinds, strict=True)), pa.array([r[1] or "open" for r in ready]), pa.array([r[2] for r in ready], pa.int32())], [*names, "outcome", "batch"])

        for b in batches:
            kinds = b.schema.types
            cols = {n: b[n].to_pylist() for n in names}
            for i in range(b.num_rows):
                row = tuple(cols[n][i] for n in names)
                if cols[group][i] != current:
                    yield from emit(True)
                    current, seen, texts, index, refused = cols[group][i], set(), Counter(), 0, 0
                    mine: list = []
                    sources: Counter = Counter()
                    own: Counter = Counter()
                p, s, t = cols[path][i], cols[source][i], cols[text_key][i]
                if p in seen:
                    rows.append([row, "duplicate_path", None])
                elif len(mine) >= cap and sources[s] >= cap:
                    rows.append([row, "source_capped", None])
                elif texts[t] + own[t] >= text_cap:
                    rows.append([row, "text_capped", None])
                else:
                    entry = [row, None, index]
                    rows.append(entry)
                    mine.append((entry, p))
                    seen.add(p)
                    sources[s] += 1
                    own[t] += 1
                    if len(mine) == batch_size:
                        good = len(own) >= least_distinct * len(mine)
                        for e, path_ in mine:
                            e[1] = "accepted" if good else "refused_low_diversity"
                            if not good:
                                e[2] = None
                                seen.discard(path_)
                        if good:
                            texts += own
                        index, mine, sources, own = index + 1, [], Counter(), Counter()
            if current is not None:
                yield from emit(False)
        yield from emit(True)

    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    laid = df.repartition(F.col(group)).sortWithinPartitions(group, *order)
    return laid.mapInArrow(run, StructType([*df.schema, StructField("outcome", StringType()), StructField("batch", IntegerType())]))


def sort_within(df: DataFrame, window: str, group: str, value: str, row: str) -> DataFrame:
    """``place`` of a row in its window when each group's rows stand by value; groups keep their share of the window."""
    return df.withColumn("place", F.row_number().over(W.partitionBy(window, group).orderBy(value, row)))


def draws(df: DataFrame, group: str, counts: dict[str, int], seed: str = "0") -> DataFrame:
    """Rows drawn with replacement: counts[g] draws of each group, each an index from a digest; reruns agree.

    Rows get an index within their group and draws meet them by (group, index); a row drawn twice stands twice.
    """
    spark = df.sparkSession
    plan = spark.createDataFrame(list(counts.items()), "__g string, __n bigint")
    at = df.withColumn("__i", F.row_number().over(W.partitionBy(group).orderBy(*[c for c in df.columns if c != group])) - 1)
    size = df.groupBy(group).agg(F.count("*").alias("__size"))
    want = plan.where("__n > 0").select("__g", F.explode(F.sequence(F.lit(1).cast("bigint"), "__n")).alias("draw")).join(size, F.col("__g") == F.col(group))
    want = want.select("__g", "draw", F.pmod(F.xxhash64(F.lit(seed), "__g", "draw"), "__size").alias("__j"))
    return want.join(at, (F.col("__g") == F.col(group)) & (F.col("__j") == F.col("__i"))).select(*df.columns, "draw")


def pairs(a: DataFrame, b: DataFrame, row: str, n: int) -> DataFrame:
    """n different pairs of a row of each table, walking the diagonals of their product; rows have dense ids from 0."""
    na, nb = a.count(), b.count()
    if not na or not nb:
        raise ValueError("an empty side has no pairs")
    i, j = numeric.diagonal_pair(F.col("slot"), na, nb)
    slots = a.sparkSession.range(min(n, na * nb)).withColumnRenamed("id", "slot").select("slot", i.alias("i"), j.alias("j"))
    left, right = (d.select(F.col(row).alias(k), *(F.col(c).alias(f"{c}_{k}") for c in d.columns if c != row)) for d, k in ((a, "i"), (b, "j")))
    return slots.join(left, "i").join(right, "j")


def highest_averages(work: dict[str, float], seats: int) -> dict[str, int]:
    """Seats given one by one to the largest work per seat it would then have; everyone with work gets one first."""
    import heapq

    out = {k: 1 for k, w in work.items() if w > 0}
    heap = [(-w / 2, k) for k, w in work.items() if w > 0]
    heapq.heapify(heap)
    for _ in range(seats - len(out)):
        if not heap:
            break
        _, k = heapq.heappop(heap)
        out[k] += 1
        heapq.heappush(heap, (-work[k] / (out[k] + 1), k))
    return out


def least_loaded(work: dict[str, float], ranks: int) -> dict[str, int]:
    """Heaviest item first, each to the rank with the least load so far, lowest rank on ties."""
    load, out = [0.0] * ranks, {}
    for k in sorted(work, key=lambda k: (-work[k], k)):
        out[k] = min(range(ranks), key=lambda r: (load[r], r))
        load[out[k]] += work[k]
    return out
