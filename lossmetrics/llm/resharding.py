"""Resharding by minimum-cost flow: blocks of the old shards go to the new ones so that the fewest bytes move.

A layout is a folder of generations. Generation 0 has the old shards, each cut in blocks: one parquet folder per shard and
block. Only the sizes of the shards reach the driver, one number each. A flow network from old sizes to new capacities, in
which staying is free and moving costs one per byte, gives the transfers. In every old shard the blocks are laid end to end
and cut at those transfers: first what stays, then what goes to each other shard. A block inside one transfer moves whole; the
few blocks on a cut are divided by row. The blocks that change are written anew in the next generation, and the list of
retired blocks says which ones not to read; files that do not change are never touched, and a job that dies half way leaves
the old generation as it was.

Sizes differ from the capacities by half a row at every cut at most.

Defined cases: a null text has no bytes and counts 1 for its row; a null old shard counts as shard 0; repeated rows are kept
each; an empty table gives an empty layout; columns named ``shard``, ``block`` or ``size`` are replaced.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lossmetrics.llm.tables import folder, written


def transfers(old: dict[int, int], new: dict[int, int]) -> dict[tuple[int, int], int]:
    """Minimum-cost flow from old shard sizes to new capacities by successive cheapest paths; (from, to) to bytes."""
    nodes = ["source", "sink", *(("old", i) for i in old), *(("new", j) for j in new)]
    room: dict[tuple, int] = {}
    cost: dict[tuple, int] = {}

    def edge(a, b, amount: int, price: int) -> None:
        room[a, b], room[b, a], cost[a, b], cost[b, a] = amount, 0, price, -price

    for i, size in old.items():
        edge("source", ("old", i), size, 0)
        for j in new:
            edge(("old", i), ("new", j), size, int(i != j))
    for j, size in new.items():
        edge(("new", j), "sink", size, 0)
    beside: dict = {n: [b for a, b in room if a == n] for n in nodes}
    left = sum(old.values())
    if left > sum(new.values()):
        raise ValueError("the new shards cannot hold the old ones")
    while left:
        best, via, queue = {"source": 0}, {}, deque(["source"])
        while queue:  # cheapest path in the residual network
            a = queue.popleft()
            for b in beside[a]:
                price = best[a] + cost[a, b]
                if room[a, b] > 0 and price < best.get(b, 1 << 62):
                    best[b], via[b] = price, a
                    queue.append(b)
        path, at = [], "sink"
        while at != "source":
            path.append((via[at], at))
            at = via[at]
        amount = min(left, *(room[e] for e in path))
        for a, b in path:
            room[a, b] -= amount
            room[b, a] += amount
        left -= amount
    return {(i, j): room[("new", j), ("old", i)] for i in old for j in new if room[("new", j), ("old", i)] > 0}


class Layout:
    """The generations of a table in shards and blocks."""

    def __init__(self, files: list[DataFrame], retired: DataFrame | None = None):
        self.files, self.retired = files, retired

    def rows(self) -> DataFrame:
        """All current rows with ``shard`` and ``block``."""
        if self.retired is None:
            return self.files[0]
        return self.files[0].join(self.retired, ["shard", "block"], "left_anti").unionByName(self.files[1])


def _write(df: DataFrame, name: str) -> DataFrame:
    path = folder(df, name)
    df.write.option("compression", "zstd").partitionBy("shard", "block").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lay_out(docs: DataFrame, old_shard, text: str = "text") -> Layout:
    """Generation 0: every input task writes one block of each shard that it meets, without a shuffle."""
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    rows = docs.drop("shard", "block", "size").withColumn("size", size)
    rows = rows.withColumn("shard", F.coalesce(old_shard.cast("int"), F.lit(0))).withColumn("block", F.spark_partition_id().cast("long"))
    return Layout([_write(rows, "shards")])


def reshard(layout: Layout, shards: int, key: str = "doc_id") -> Layout:
    """The next generation: ``shards`` shards of equal bytes, with the fewest bytes moved."""
    files = layout.rows()
    spark = files.sparkSession
    blocks = written(files.groupBy("shard", "block").agg(F.sum("size").alias("bytes")), "blocks")
    sizes = {r["shard"]: r["bytes"] for r in blocks.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect()}  # one row a shard
    total = sum(sizes.values())
    capacity = {j: total // shards + int(j < total % shards) for j in range(shards)}
    cuts, at = [], dict.fromkeys(sizes, 0)
    for (i, j), amount in sorted(transfers(sizes, capacity).items(), key=lambda x: (x[0][0], x[0][0] != x[0][1], x[0][1])):
        cuts.append((i, j, at[i], at[i] + amount))
        at[i] += amount
    ranges = F.broadcast(spark.createDataFrame(cuts, "shard int, target int, lo long, hi long"))  # old x new shards at most
    ahead = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = blocks.withColumn("start", F.coalesce(F.sum("bytes").over(ahead), F.lit(0)))
    inside = (F.col("hi") > F.col("start")) & (F.col("lo") < F.col("start") + F.col("bytes"))
    pieces = placed.join(ranges, "shard").where(inside).groupBy("shard", "block", "start")
    goals = pieces.agg(F.count(F.lit(1)).alias("parts"), F.min("target").alias("target"))
    goals = written(goals.where("parts > 1 OR target <> shard"), "moves")
    whole = files.join(goals.where("parts = 1").select("shard", "block", "target"), ["shard", "block"])
    before = Window.partitionBy("shard", "block").orderBy(key, "size", "__hash").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.col("start") + F.coalesce(F.sum("size").over(before), F.lit(0)) + F.col("size") / 2
    cut = files.join(goals.where("parts > 1").select("shard", "block", "start"), ["shard", "block"])
    cut = cut.withColumn("__hash", F.xxhash64(*[c for c in files.columns if c not in ("shard", "block")]))
    cut = cut.withColumn("__middle", middle).join(ranges, "shard").where("__middle >= lo AND __middle < hi")
    moved = whole.unionByName(cut.select(*whole.columns))
    # A block keeps its number, made distinct by the shard that it comes from.
    named = moved.withColumn("block", (F.col("shard") + 1).cast("long") * F.lit(1 << 40) + F.col("block")).withColumn("shard", F.col("target"))
    return Layout([files, _write(named.select(*files.columns), "shards")], goals.select("shard", "block"))


def slots(layout: Layout, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``key``, ``size``, ``text_crc32``, ``shard``, ``slot``) of all rows as read from the layout; slots are gapless per shard."""
    rows = layout.rows()
    light = rows.select(key, "size", F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32"), "shard", "block")
    counts = rows.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("rows"))
    ahead = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "block", F.coalesce(F.sum("rows").over(ahead), F.lit(0)).alias("first"))
    within = Window.partitionBy("shard", "block").orderBy(key, "text_crc32", "size")
    numbered = light.withColumn("place", F.row_number().over(within) - 1).join(first, ["shard", "block"])
    return numbered.select(key, "size", "text_crc32", "shard", (F.col("first") + F.col("place")).cast("long").alias("slot"))
