"""Session helpers shared by the operators: tables, checkpoints, row numbers, components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.ship import ship


#: Rows of an Arrow batch. Texts make rows long, and a batch lies in memory on both sides of the pipe.
BATCH = ("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table; the session's Arrow batches become shorter unless they have been set already."""
    if BATCH[0] not in spark.conf.getAll:
        spark.conf.set(*BATCH)
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; only a local session without one (a test) gets its own."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir")
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="corvane-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


#: Removes the shuffle files of a plan when it has run; else they stay until the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared folder and goes on from there; what the plan shuffled goes at once, for nothing reads it again."""
    spark = df.sparkSession
    shared_dir(spark)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        own = df.select("*")  # a plan of its own, which no later action on df runs again
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return own.checkpoint()


def sample(ids: DataFrame, n: int, seed: int = 3, distinct: bool = True) -> DataFrame:
    """n rows of ids, those of least hash; rows that cannot be among them do not leave their task.

    Both the share and the hash are of distinct rows, so repeated rows weigh once; ``distinct`` may be off where few rows repeat.
    """
    own = ids.distinct() if distinct else ids
    key = F.xxhash64(*(F.col(c) for c in ids.columns), F.lit(seed))
    total = own.count()
    share = 1.0 if total == 0 else min(1.0, (1.5 * n + 1000) / total)
    return own.where(F.pmod(key, F.lit(1 << 30)) < share * (1 << 30)).orderBy(F.pmod(key, F.lit(1 << 30)), key).limit(n)


def _folder(spark: SparkSession, where: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet to a folder of its own under the shared one, and read again; the folder goes when the application ends."""
    spark = df.sparkSession
    where = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(where)
    path, files = _folder(spark, where)
    files.deleteOnExit(path)
    return spark.read.parquet(where)


def discard(df: DataFrame) -> None:
    """Removes the folder of a table that ``stored`` gave and nothing will read again."""
    for where in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path, files = _folder(df.sparkSession, where)
        files.delete(path, True)


def bitmap(keys: DataFrame, key: str, bits: int) -> DataFrame:
    """One row: a bitmap of fixed size (``bits``) that has the bit of every key set."""
    h = F.pmod(F.xxhash64(key), F.lit(bits))
    words = keys.select(h.alias("h")).groupBy(F.floor(F.col("h") / 64).alias("id")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod("h", F.lit(64)).cast("int"))).alias("w"))
    whole = keys.sparkSession.range(bits // 64).join(words, "id", "left").select("id", F.coalesce("w", F.lit(0).cast("bigint")).alias("w"))
    return whole.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "w"))), lambda x: x["w"]).alias("__bitmap"))


def may_hold(key: Column, bits: int) -> Column:
    h = F.pmod(F.xxhash64(key), F.lit(bits))
    word = F.get("__bitmap", F.floor(h / 64).cast("int"))
    return F.call_function("shiftrightunsigned", word, F.pmod(h, F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1


def near(rows: DataFrame, keys: DataFrame, key: str, bits: int = 1 << 24) -> DataFrame:
    """rows less most of those whose key is not among keys."""
    return rows.join(F.broadcast(bitmap(keys, key, bits)), may_hold(F.col(key), bits)).drop("__bitmap")


def components(edges: DataFrame, u: str = "u", v: str = "v", rounds: int = 60) -> DataFrame:
    """Connected components as (node, root), root the smallest node, for nodes that have an edge.

    Distributed union-find: every round hooks each node's neighbours to the smallest one it
    sees (large star), then shortens parent chains (small star), until no edge changes. State
    is the edge table alone; each round is written to the shared folder. Groups are only ever
    reduced to a minimum, which combines before the shuffle, and are never gathered.
    """
    e = cut(edges.select(F.col(u).alias("a"), F.col(v).alias("b")).where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    seen = None
    for _ in range(rounds):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").where("a <> b")
        e = cut(small.distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError("components did not settle")
    roots = e.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
