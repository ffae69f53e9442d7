"""Fuzzy line dedup by MinHash, in DataFrame functions alone.

Lines (trimmed, not blank) are sets of character shingles. Identical lines are one node. A
node's signature comes from one hash of every shingle (of eight characters: shorter ones are
shared by chance by too many lines): the hash picks one of 16 bins and the bin
keeps its least value. Long lines drop, before the bins, hashes too large to be a bin's least value
but by a chance of about one in eight (an empty bin is a value too). Eight bands of three bins make
bucket keys, which finds 98 to 99 in 100 pairs at the threshold and nearly all above 0.85. Nodes are compared
with the least and the greatest node of each of their buckets first, which links most of a group of near copies;
then all nodes of a bucket meet, in blocks, unless they are of one component already. Pairs whose signatures agree
in too few bins go, and in the blocks those that a parity sketch of both shingle sets proves to be under the threshold; the rest are
verified by the exact Jaccard index of their shingle sets, and a distributed union-find over verified pairs makes
components. The first line of a component (smallest document id, then position) stays; all its other
lines go.

Null texts and rows with a null id stay as they are; blank lines stay. Rows sharing an id and a text
are one document: they lose the same lines. Very long lines are lines like others; an empty table gives no rows. Columns of docs
called like the two counts are replaced, all others are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm._spark import bitmap, components, cut, may_hold, near

BLANKS = " \t\r\f\v"


def _trim(line: Column) -> Column:
    """line without blanks at its ends; the slow function runs only where there are some."""
    ends = [test(F.lit(c)) for c in BLANKS for test in (line.startswith, line.endswith)]
    some = ends[0]
    for x in ends[1:]:
        some = some | x
    return F.when(some, F.trim(line, F.lit(BLANKS))).otherwise(line)


def _code(line: Column) -> Column:
    """Two bytes a UTF-16 unit, so that a shingle is found without counting from the start."""
    return F.encode(line, "UTF-16BE")


def _last_start(width: int) -> Column:
    return F.greatest(F.floor(F.octet_length("code") / 2).cast("int") - width, F.lit(0))


#: Characters up to which a line's shingles are taken by substrings.
SHORT = 256


def _set(line: str, width: int) -> Column:
    """The shingle hashes of a line, of two bytes a UTF-16 unit. Where each character is one unit, shingles are byte ranges, found without counting.
    In other lines, substrings count from the start, which costs least in short ones; in long ones a lookahead lists the shingles."""
    # The array of one binds the bytes once; a lambda's body is evaluated for each shingle.
    plain = f"element_at(transform(array(encode({line}, 'UTF-16BE')), b -> transform(sequence(1, octet_length(b) - {2 * width - 1}, 2), i -> xxhash64(substring(b, i, {2 * width})))), 1)"
    short = f"transform(sequence(1, length({line}) - {width - 1}), i -> substring({line}, i, {width}))"
    # A search goes on by UTF-16 units, so places within a character are passed over.
    long = rf"regexp_extract_all({line}, '(?s)(?![\\x{{DC00}}-\\x{{DFFF}}])(?=(.{{{width}}}))', 1)"
    wide = f"transform(case when length({line}) <= {width} then array({line}) when length({line}) <= {SHORT} then {short} else {long} end, x -> xxhash64(encode(x, 'UTF-16BE')))"
    return F.expr(f"case when length({line}) > {width} and octet_length(encode({line}, 'UTF-16BE')) = 2 * length({line}) then {plain} else {wide} end")


def _key(text: Column) -> Column:
    return F.xxhash64(text.cast("string"))


def _lines(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    keyed = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).where("doc_id is not null and text is not null").withColumn("text_key", _key(F.col("text")))
    lines = keyed.select("doc_id", "text_key", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line")).withColumn("line", _trim(F.col("line"))).where("line <> ''")
    return lines.withColumns({"k1": F.xxhash64("line"), "k2": F.xxhash64(F.lit(7), "line")})


BINS = 16
#: Eight triples of bins; no two share more than one bin.
BANDS = [(0, 1, 2), (3, 4, 5), (6, 7, 8), (9, 10, 11), (12, 13, 14), (0, 5, 15), (3, 8, 13), (1, 6, 11)]
#: Bits a bin keeps of its least value; 0 is an empty bin. Four bins make a long, each with a free bit above it.
BITS = 14
PITCH = BITS + 1


def signatures(lines: DataFrame, width: int) -> DataFrame:
    """k1, n (lines) and q0..q3, sixteen bins of 14 bits each, of each distinct line: one row a shingle, reduced at once to one row a line."""
    s = lines.select("k1", _code(F.col("line")).alias("code"))
    s = s.select("k1", "code", F.explode(F.sequence(F.lit(0), _last_start(width))).alias("i"))
    h = F.xxhash64(F.substring("code", F.col("i") * 2 + 1, F.lit(2 * width)))
    s = s.select("k1", "i", F.octet_length("code").cast("double").alias("size"), h.alias("h"))
    s = s.select("k1", "i", F.shiftrightunsigned("h", 33).cast("int").alias("value"), F.pmod("h", F.lit(BINS)).cast("int").alias("bin"), (F.shiftrightunsigned("h", 33) * F.col("size") <= 2.0**31 * 4 * BINS).alias("low"))
    s = s.where("low or i = 0").withColumn("bin", F.when(F.col("low"), F.col("bin")).otherwise(-1))
    s = s.groupBy("k1").agg(F.sum(F.when(F.col("i") == 0, 1).otherwise(0)).alias("n"), *(F.min(F.when(F.col("bin") == j, F.col("value"))).alias(f"b{j}") for j in range(BINS)))
    # Low bits of a least value are as good as random; the high ones are small for every line.
    part = lambda j: F.shiftleft(F.coalesce(F.col(f"b{j}") % (2**BITS - 1) + 1, F.lit(0)).cast("bigint"), PITCH * (j % 4))
    quads = [part(j).bitwiseOR(part(j + 1)).bitwiseOR(part(j + 2)).bitwiseOR(part(j + 3)).alias(f"q{j // 4}") for j in range(0, BINS, 4)]
    return s.select("k1", "n", *quads)


def _bin(j: int, of: str = "") -> Column:
    return F.shiftrightunsigned(F.col(f"{of}q{j // 4}"), PITCH * (j % 4)).bitwiseAND(F.lit(2**BITS - 1))


def _bands() -> Column:
    """The bucket keys of a node: band and its three bins.

    A band with a single filled bin says little more than that a line has one common shingle; it counts
    only for lines so short that most of their bins are empty.
    """
    filled = [(_bin(j) != 0).cast("int") for j in range(BINS)]
    short = sum(filled) < BINS // 2
    keys = []
    for k, (a, b, c) in enumerate(BANDS):
        three = _bin(a).bitwiseOR(F.shiftleft(_bin(b), BITS)).bitwiseOR(F.shiftleft(_bin(c), 2 * BITS))
        n = filled[a] + filled[b] + filled[c]
        keys.append(F.when((n >= 2) | (short & (n == 1)), three.bitwiseOR(F.lit(k << 3 * BITS).cast("bigint"))))
    return F.array_compact(F.array(*keys))


def _filled(quad: Column) -> Column:
    """How many of four bins are not 0: adding the greatest value carries into the free bit of just those."""
    every = sum(1 << PITCH * j for j in range(4))
    return F.bit_count((quad + F.lit(every * (2**BITS - 1))).bitwiseAND(F.lit(every << BITS)))


def _alike(a: str, b: str, share: float) -> Column:
    """Whether two signatures agree in at least such a share of the bins that either has filled."""
    quads = [(F.col(f"{a}q{i}"), F.col(f"{b}q{i}")) for i in range(BINS // 4)]
    unlike, either = sum(_filled(x.bitwiseXOR(y)) for x, y in quads), sum(_filled(x.bitwiseOR(y)) for x, y in quads)
    return unlike <= F.lit(1 - share + 1e-9) * either


#: Words of 64 bits of a parity sketch.
PARITY = 16
#: Nodes of a bucket that meet in one task at once.
BLOCK = 512


def _parities(text_of: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """k1, size and p0..p15: the number of a line's shingles, and for each of 1,024 slots whether an odd number of them falls there."""
    h = text_of.join(nodes, "k1").select("k1", F.explode(F.array_distinct(_set("line", width))).alias("h"))
    h = h.select("k1", F.pmod("h", F.lit(64 * PARITY)).cast("int").alias("slot")).select("k1", F.floor(F.col("slot") / 64).alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("slot") % 64).alias("bit"))
    return h.groupBy("k1").agg(F.count("*").alias("size"), *(F.coalesce(F.bit_xor(F.when(F.col("word") == j, F.col("bit"))), F.lit(0).cast("bigint")).alias(f"p{j}") for j in range(PARITY)))


def _may_reach(a: str, b: str, share: float) -> Column:
    """False only if the Jaccard index is under ``share``: sets too unlike in size, or more slots of unlike parity than shingles
    that one set alone may have. Written with each sketch word once, for the condition is compiled as one method."""
    x, y = F.col(f"{a}size"), F.col(f"{b}size")
    apart = sum(F.bit_count(F.col(f"{a}p{j}").bitwiseXOR(F.col(f"{b}p{j}"))) for j in range(PARITY))
    sizes = (x >= F.lit(share - 1e-9) * y) & (y >= F.lit(share - 1e-9) * x)
    return sizes & (F.lit(1 + share) * apart <= F.lit(1 - share) * (x + y) + 1e-6)


def _signed(pairs: DataFrame, node: DataFrame) -> DataFrame:
    """pairs with the signatures of both nodes."""
    for side in "ab":
        pairs = pairs.join(node.select(F.col("k1").alias(side), *(F.col(f"q{i}").alias(f"{side}q{i}") for i in range(BINS // 4))), side)
    return pairs


def _others(member: DataFrame, node: DataFrame, text_of: DataFrame, width: int, threshold: float) -> DataFrame:
    """ra, rb: the components (``root`` of member) that a near pair of a bucket's nodes joins, once a task and pair of components.

    Every two nodes of a bucket meet in one cell, that of their two blocks, so a large bucket is dealt over many tasks. Signatures,
    then sketches, then the exact Jaccard index decide where two nodes meet: only what near pairs join leaves.
    """
    live = member.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("first"), F.max("root").alias("last")).where("first < last").select("key", "n")
    own = cut(member.select("key", "k1", "root").join(cut(live), "key"))
    known = _parities(text_of, own.select("k1").distinct(), width).join(node.drop("n"), "k1")
    own = own.join(known, "k1").withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    own = cut(own.withColumn("block", F.pmod(F.xxhash64(F.lit(11), "k1"), F.col("blocks")).cast("int")).drop("n"))
    own = own.join(text_of, "k1")
    named = lambda s: [F.col(c).alias(f"{s}{c}") for c in ("k1", "root", "line", *known.drop("k1").columns)]
    left = own.select("key", F.col("block").alias("i"), F.explode(F.sequence("block", F.col("blocks") - 1)).alias("j"), *named("a"))
    right = own.select("key", F.explode(F.sequence(F.lit(0), F.col("block"))).alias("i"), F.col("block").alias("j"), *named("b"))
    exact = F.col("asize") + F.col("bsize") >= (1 + threshold) * F.size(F.array_union(_set("aline", width), _set("bline", width)))
    met = left.join(right, ["key", "i", "j"]).where("(i < j or ak1 < bk1) and aroot <> broot").where(_alike("a", "b", threshold - 0.35) & _may_reach("a", "b", threshold) & exact)
    return met.select(F.least("aroot", "broot").alias("ra"), F.greatest("aroot", "broot").alias("rb")).distinct()


def _verified(pairs: DataFrame, text_of: DataFrame, width: int, threshold: float) -> DataFrame:
    """The pairs whose shingle sets have a Jaccard index of at least ``threshold``."""
    both = pairs.join(text_of.toDF("a", "la"), "a").join(text_of.toDF("b", "lb"), "b").select("a", "b", _set("la", width).alias("sa"), _set("lb", width).alias("sb"))
    both = both.select("a", "b", F.size(F.array_union("sa", "sb")).alias("all"), F.size(F.array_intersect("sa", "sb")).alias("common"))
    return both.where(F.col("common") >= threshold * F.col("all")).select("a", "b")


def gone(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 6, threshold: float = 0.8, sketch_width: int = 8, bits: int = 1 << 24) -> DataFrame:
    """doc_id, text_key and the positions (``gone``) of the lines that go, for each document that loses any."""
    lines = _lines(docs, doc_id, text)
    node = cut(signatures(lines, sketch_width))
    banded = node.select("k1", F.explode(_bands()).alias("key"))
    bucket = cut(banded.groupBy("key").agg(F.min("k1").alias("low"), F.max("k1").alias("high"), F.count("*").alias("n")).where("low < high"))
    # Of two nodes the ends say which they are; only larger buckets are dealt again.
    pairs = bucket.where("n = 2").select(F.col("low").alias("x"), F.col("high").alias("y"))
    crowd = bucket.where("n > 2").select("key", "low", "high")
    # A bitmap of fixed size, whatever the input, keeps most rows that no join will want out of the shuffle.
    member = cut(near(banded, crowd, "key", bits).join(crowd, "key"))
    pairs = pairs.unionByName(member.select(F.col("k1").alias("x"), F.explode(F.array("low", "high")).alias("y")).where("x <> y"))
    pairs = _signed(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), node)
    pairs = cut(pairs.where(_alike("a", "b", threshold - 0.35)).select("a", "b"))

    met = pairs.select(F.explode(F.array("a", "b")).alias("k1")).unionByName(member.select("k1")).withColumn("met", F.lit(True))
    some = node.where("n > 1").select("k1", F.lit(False).alias("met")).unionByName(met).groupBy("k1").agg(F.max("met").alias("met"))
    some = cut(some)
    # Texts travel only with lines that may be met.
    wanted = near(lines, some, "k1", bits).join(F.broadcast(bitmap(some.where("met"), "k1", bits)), F.lit(True)).withColumn("line", F.when(may_hold(F.col("k1"), bits), F.col("line"))).drop("__bitmap")
    held = cut(wanted.join(some, "k1").select("k1", "k2", "doc_id", "pos", "text_key", F.when(F.col("met"), F.col("line")).alias("line"), "met"))
    text_of = cut(held.where("met").groupBy("k1").agg(F.min("line").alias("line")))
    component = cut(components(_verified(pairs, text_of, width, threshold), "a", "b").select(F.col("node").alias("k1"), "root"))
    own = member.select("key", "k1").join(component, "k1", "left").withColumn("root", F.coalesce("root", "k1"))
    rest = cut(_others(own, node, text_of, width, threshold))
    joined = cut(components(rest, "ra", "rb")).toDF("root", "least")
    grown = component.join(joined, "root", "left").select("k1", F.coalesce("least", "root").alias("root"))
    component = grown.unionByName(joined.toDF("k1", "root").join(component, "k1", "left_anti"))
    fate = held.select("k1", "k2", "doc_id", "pos", "text_key").join(component, "k1", "left")
    fate = fate.withColumn("sub", F.when(F.col("root").isNull(), F.col("k2")).otherwise(0)).withColumn("root", F.coalesce("root", "k1"))
    # Written, so that the join below reads both sides from shuffles and a group with very many lines can be split.
    stays = cut(fate.groupBy("root", "sub").agg(F.min(F.struct("doc_id", "pos", "text_key")).alias("stays")))
    out = fate.join(stays, ["root", "sub"]).where("(doc_id, pos, text_key) <> (stays.doc_id, stays.pos, stays.text_key)")
    return out.select("doc_id", "text_key", "pos").groupBy("doc_id", "text_key").agg(F.collect_set("pos").alias("gone"))


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits: int = 1 << 24, counts: tuple[str, str] = ("n_lines", "n_removed"), **options) -> DataFrame:
    """docs with the lines that go taken out of ``text``, and two ``counts``: lines before, lines gone."""
    marks = cut(gone(docs, doc_id, text, bits=bits, **options)).select(F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"), F.col("gone").alias("__gone"))
    own = docs.withColumn("__key", _key(F.col(text))).join(F.broadcast(bitmap(marks, "__key", bits)), F.lit(True))
    own = own.withColumn("__may", F.coalesce(may_hold(F.col("__key"), bits), F.lit(False))).drop("__bitmap")
    touched = own.where("__may").join(marks, (F.col(doc_id).cast("bigint") == F.col("__id")) & (own["__key"] == marks["__key"]), "left").select(*docs.columns, "__gone")
    whole = touched.unionByName(own.where("not __may").select(*docs.columns, F.lit(None).cast("array<int>").alias("__gone")))
    kept = F.array_join(F.filter(F.split(text, "\n", -1), lambda x, i: ~F.array_contains("__gone", i)), "\n")
    n_lines = F.coalesce(F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("bigint")
    rest = [F.when(F.col("__gone").isNull(), F.col(text)).otherwise(kept).alias(text) if c == text else F.col(c) for c in docs.columns if c not in counts]
    return whole.select(*rest, n_lines.alias(counts[0]), F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("bigint").alias(counts[1]))
