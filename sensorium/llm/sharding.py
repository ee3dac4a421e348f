"""Sharding by a k-d tree with distributed weighted medians.

Texts become groups (equal texts), each with a byte weight and coordinates in [0, 2**60): its
length, source, language and content hash. A node that has to hold ``m`` shards is cut along its widest
dimension at the weighted quantile floor(m/2)/m, until every leaf is one shard of the target bytes.
The quantile is found for all nodes of a level at once by refined histograms: executors sum bytes
into ``BINS`` intervals per shard that a node holds, and only those sums reach the driver (at most shards x BINS rows,
whatever the input). Every coordinate ends in bits of the content hash, so equal lengths or one hot
source still split. Each level's nodes are a stored column, and its cuts literals of the plan.

No cut can run through a group. So groups over a small part of the target (at most shards / ``HEAVY`` of them) are dealt first,
largest first to the shard with most room, and the tree shares out what room is left in each shard.

Law ``bytes``: shard sizes are near equal. Equal texts stay in one shard, unless their group alone exceeds the
target or no shard has room for it; then its rows are groups of their own and spread. Slots number a shard's rows from 0 through
hashed blocks, so no task sorts a whole shard.

Only DataFrame functions run. Defined results: null text weighs 16 bytes and hashes as the empty text; null ids,
sources and languages are ordinary values; repeated rows are rows of their own, each with a slot, and spread like any others where
their group does; a text of any length is one row; an empty table gives no rows; further columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import heapq
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from .common import quoted, written

SHARDS = 40
ROW_BYTES = 16
BINS = 512
#: A cut may miss its quantile by this part of a shard's target.
TOLERANCE = 0.004
#: Groups over this part of the target are dealt before the tree is cut.
HEAVY = 0.02
#: Rows of a block within which slots are numbered.
SLOT_ROWS = 20_000
_TOP, _LOW = 1 << 60, 1 << 40
#: What equal texts share.
KEY = ["content", "text_crc32", "size"]


def _coordinate(value: Column, content: Column) -> Column:
    """``value`` in [0, 1) as the leading 20 of 60 bits; the content hash fills the rest."""
    lead = F.least(F.floor(value * F.lit(float(1 << 20))), F.lit((1 << 20) - 1)).cast("long")
    return lead * F.lit(_LOW) + F.pmod(content, F.lit(_LOW))


def _nominal(c: Column) -> Column:
    return F.pmod(F.xxhash64(c, F.lit("nominal")), F.lit(1 << 20)) / F.lit(float(1 << 20))


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text",
          nominal: tuple[str, ...] = ("source", "lang")) -> DataFrame:
    """One row per document: id, size, text_crc32, law, shard, slot, grown_shard (null under this law)."""
    text = F.coalesce(quoted(text_col), F.lit(""))
    names = [c for c in nominal if c in docs.columns]
    rows = written(docs.select(
        quoted(id_col).alias("id"), F.xxhash64(quoted(id_col), F.monotonically_increasing_id()).alias("salt"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.md5(text).alias("content"), *[_nominal(quoted(c)).alias(f"n{i}") for i, c in enumerate(names)]), "shard-rows")
    groups = rows.groupBy("content", "text_crc32", "size").agg(
        F.count("*").alias("copies"), *[F.min(f"n{i}").alias(f"n{i}") for i in range(len(names))])
    groups = groups.withColumn("bytes", F.col("size") * F.col("copies"))
    total = groups.agg(F.sum("bytes").alias("b"), F.sum("copies").alias("n")).first()
    target = (total["b"] or 0) / shards
    heavy = groups.filter(F.col("bytes") > HEAVY * target).select(*KEY, "copies").collect()  # at most shards / HEAVY rows
    dealt, apart, loose, room = _deal(heavy, shards, target)
    units = groups.filter(F.col("bytes") <= HEAVY * target).withColumn("part", F.lit(None).cast("long"))
    if loose:
        # a group of many light rows spreads row by row
        units = units.unionByName(rows.join(_keyed(rows, [], loose), KEY)
                                  .groupBy(*KEY, F.col("salt").alias("part"))
                                  .agg(F.count("*").alias("copies"), *[F.min(f"n{i}").alias(f"n{i}") for i in range(len(names))])
                                  .withColumn("bytes", F.col("size") * F.col("copies")))
    mark = F.xxhash64("content", "part")
    length = F.log2(F.col("size").cast("double")) / F.lit(40.0)
    dims = [length, *[F.col(f"n{i}") for i in range(len(names))], F.pmod(mark, F.lit(1 << 20)) / F.lit(float(1 << 20))]
    units = written(units.select(*KEY, "part", "bytes",
                                 F.array(*[_coordinate(d, mark) for d in dims]).alias("d"), F.lit(0).cast("long").alias("node")), "shard-units")
    units = kd_leaves(units, len(dims), shards, target, room)
    placed = units.select("content", F.col("text_crc32").alias("u_crc"), F.col("size").alias("u_size"), "part", "shard")
    row = rows.withColumnRenamed("salt", "own")
    same = (F.col("text_crc32") == F.col("u_crc")) & (F.col("size") == F.col("u_size"))
    whole = placed.filter("part is null").select(F.col("content").alias("u_content"), "u_crc", "u_size", "shard")
    whole_rows = row.join(whole, (F.col("content") == F.col("u_content")) & same, "left") \
        .select(*row.columns, F.col("shard").alias("whole_shard"))
    out = [whole_rows.filter("whole_shard is not null").withColumnRenamed("whole_shard", "shard")]
    if loose:
        parts = placed.filter("part is not null").withColumnRenamed("content", "p_content")
        out.append(whole_rows.filter("whole_shard is null").join(
            parts, (F.col("content") == F.col("p_content")) & (F.col("own") == F.col("part")) & same))
    if dealt:
        out.append(rows.join(_keyed(rows, ["shard"], dealt), KEY))
    if apart:
        # heavy rows: as many as room was found for in each shard
        nth = F.row_number().over(Window.partitionBy(*KEY).orderBy("id"))
        out.append(rows.join(_keyed(rows, [], [k for k, _ in apart]), KEY).withColumn("nth", nth)
                   .join(_keyed(rows, ["shard", "above", "upto"], [(*k, *c) for k, cs in apart for c in cs]), KEY)
                   .filter("nth > above and nth <= upto"))
    out = reduce(DataFrame.unionByName, [x.select("id", "size", "text_crc32", F.col("shard").cast("long").alias("shard")) for x in out])
    numbered = _slots(out, total["n"] or 0, shards)
    return numbered.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                           "slot", F.lit(None).cast("int").alias("grown_shard"))


def _deal(heavy: list[Row], shards: int, target: float) -> tuple[list, list, list, list[float]]:
    """Heavy groups, largest first, each to the shard with most room: (key, shard) of those dealt whole; of those of heavy rows
    dealt one by one the key and its (shard, rows above, rows up to); keys of groups whose light rows the tree is to spread;
    and the room left in each shard."""
    room = [(-target, k) for k in range(shards)]  # largest first
    heapq.heapify(room)
    dealt, apart, loose = [], [], []
    # over the target: by the size of a row
    todo = [(-(g["size"] if g["copies"] * g["size"] > target else g["copies"] * g["size"]), *(g[c] for c in KEY), g["copies"]) for g in heavy]
    heapq.heapify(todo)
    while todo:
        weight, content, crc, size, copies = heapq.heappop(todo)
        key, weight = (content, crc, size), -weight
        whole = weight == copies * size
        free = -room[0][0] + TOLERANCE * target
        if whole and (copies == 1 or weight <= free):
            left, k = room[0]
            heapq.heapreplace(room, (left + weight, k))
            dealt.append((*key, k))
        elif size <= HEAVY * target:
            loose.append(key)
        elif whole:
            heapq.heappush(todo, (-size, *key, copies))
        else:
            at: Counter[int] = Counter()
            for _ in range(copies):
                left, k = room[0]
                heapq.heapreplace(room, (left + size, k))
                at[k] += 1
            above, cuts = 0, []
            for k, n in sorted(at.items()):
                cuts.append((k, above, above + n))
                above += n
            apart.append((key, cuts))
    return dealt, apart, loose, [max(0.0, -left) for left, _ in sorted(room, key=lambda x: x[1])]


def _keyed(df: DataFrame, names: list[str], rows: list[tuple]) -> DataFrame:
    """A broadcast table of keys, each with further numbers."""
    values = ", ".join(f"('{c}', {crc}L, {size}L" + "".join(f", {v}L" for v in more) + ")" for c, crc, size, *more in rows)
    return F.broadcast(df.sparkSession.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(KEY + names)})"))


def _of_node(values: dict[int, int]) -> Column:
    """The number of each tree node (null for others): at most a few per shard, so a literal."""
    return F.create_map(*[F.lit(int(x)).cast("long") for kv in values.items() for x in kv])[F.col("node")]


def kd_leaves(units: DataFrame, dims: int, shards: int, target: float, room: list[float]) -> DataFrame:
    """``units`` (array of coordinates ``d``, ``bytes``, ``node`` = 0) with the column ``shard`` of its leaf, as ``room`` allows."""
    leaves = {0: (0, shards)}  # node -> (first shard, shards); nodes still to cut have over one shard
    at = units
    while any(m > 1 for _, m in leaves.values()):
        open_ = [k for k, v in leaves.items() if v[1] > 1]
        spans = {r["node"]: r for r in at.filter(F.col("node").isin(open_)).groupBy("node").agg(
            F.sum("bytes").alias("bytes"), *[f(F.col("d")[k]).alias(f"{n}{k}") for k in range(dims) for n, f in (("lo", F.min), ("hi", F.max))]).collect()}
        cuts = {}
        for k in open_:
            if k in spans:
                r, (at_shard, m) = spans[k], leaves[k]
                left, both = sum(room[at_shard:at_shard + m // 2]), sum(room[at_shard:at_shard + m])
                d = max(range(dims), key=lambda d: (r[f"hi{d}"] - r[f"lo{d}"], -d))
                cuts[k] = {"dim": d, "bins": BINS * m, "lo": r[f"lo{d}"], "hi": r[f"hi{d}"] + 1,
                           "want": r["bytes"] * (left / both if both else (m // 2) / m), "below": 0}
        _medians(at, cuts, TOLERANCE * target)
        grown = {}
        for k, (first, m) in leaves.items():
            if m == 1:
                grown[k] = (first, 1)
            else:
                grown[2 * k + 1], grown[2 * k + 2] = (first, m // 2), (first + m // 2, m - m // 2)
        if cuts:
            cut = _of_node({k: c["cut"] for k, c in cuts.items()})
            below = _at_dim({k: c["dim"] for k, c in cuts.items()}) < cut
            at = written(at.withColumn("node", F.when(cut.isNull(), F.col("node")).otherwise(
                2 * F.col("node") + F.when(below, 1).otherwise(2))), "shard-level")
        leaves = grown
    return at.withColumn("shard", _of_node({k: first for k, (first, _) in leaves.items()})).drop("node")


def _at_dim(dims: dict[int, int]) -> Column:
    """The coordinate along which each node is cut."""
    return F.get("d", _of_node(dims).cast("int"))


def _medians(at: DataFrame, cuts: dict, slack: float) -> None:
    """Sets ``cut`` of each node: the bytes below it come as near to ``want`` as whole units allow."""
    todo = dict(cuts)
    while todo:
        width = {k: max(1, -(-(c["hi"] - c["lo"]) // c["bins"])) for k, c in todo.items()}
        lo, hi, w = (_of_node(v) for v in ({k: c["lo"] for k, c in todo.items()}, {k: c["hi"] for k, c in todo.items()}, width))
        x = at.select("node", "bytes", _at_dim({k: c["dim"] for k, c in todo.items()}).alias("x"), lo.alias("lo"), hi.alias("hi"), w.alias("w")) \
            .filter("x >= lo and x < hi")
        sums: dict = {k: [] for k in todo}
        for r in x.groupBy("node", F.expr("(x - lo) div w").alias("bin")).agg(F.sum("bytes").alias("b"), F.count("*").alias("n")).collect():
            sums[r["node"]].append((r["bin"], r["b"], r["n"]))
        for k, c in list(todo.items()):
            below, pick = c["below"], None
            for b, size, n in sorted(sums[k]):
                pick = (b, size, n, below)
                if below + size >= c["want"]:
                    break
                below += size
            b, size, n, below = pick
            start, end = c["lo"] + b * width[k], min(c["hi"], c["lo"] + (b + 1) * width[k])
            if n == 1 or width[k] == 1 or size <= slack:
                c["cut"] = start if c["want"] - below <= below + size - c["want"] else end
                del todo[k]
            else:
                c["lo"], c["hi"], c["below"] = start, end, below


def _slots(rows: DataFrame, n: int, shards: int) -> DataFrame:
    """A gapless number from 0 in each shard: rows are numbered within hashed blocks, blocks are added up."""
    blocks = max(1, -(-n // (shards * SLOT_ROWS)))
    # equal rows get different blocks, which are stored with them
    rows = written(rows.withColumn("block", F.pmod(F.xxhash64("id", "size", "text_crc32", F.monotonically_increasing_id()), F.lit(blocks))), "shard-placed")
    sums = rows.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = sums.select("shard", "block", (F.sum("n").over(Window.partitionBy("shard").orderBy("block")) - F.col("n")).alias("before"))
    inner = F.row_number().over(Window.partitionBy("shard", "block").orderBy("id", "size", "text_crc32"))
    return rows.withColumn("inner", inner).join(before, ["shard", "block"]).withColumn("slot", F.col("before") + F.col("inner") - 1)
