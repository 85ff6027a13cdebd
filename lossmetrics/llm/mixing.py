"""Mixing sources to target weights by Poisson replication.

Every source has a mean repetition rate: the target number of its rows over the rows it has. The number of copies of a
document is the inverse of the Poisson distribution with that mean at a uniform number hashed from the seed and the id, so it
does not depend on partitions, order or retries. Documents are repeated by their counts and dealt out by a hash of id and
copy, then sorted by it: a shuffle of the whole table.

Means above ``PART`` are split in equal parts that are drawn separately and added, so that no probability underflows.

Only one row per source is gathered. That table is written, so Spark broadcasts it when it is small and joins it by source
otherwise; then documents of one source are spread over ``SALT`` keys.

Defined cases: a null source is a source of its own; a null id is drawn like the id "null"; equal ids are drawn alike; a
source without a weight, or with a weight that is null or not positive, gives no rows; an empty table gives an empty table;
columns named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossmetrics.llm.tables import written

PART = 32.0
#: Entries of a cumulative distribution; at a mean of 32 what is left has less than 2**-52.
STEPS = 120
SALT = 32
_SCALE = float(1 << 52)


def uniform(*parts: Column | str) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 digest."""
    digest = F.md5(F.concat_ws(":", *parts))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / _SCALE


def tempered(docs: DataFrame, source: str = "source", power: float = 0.5) -> DataFrame:
    """(``source``, ``weight``): the rows of each source to a power, between equal weights (0) and the given mix (1)."""
    return docs.groupBy(F.coalesce(source, F.lit("")).alias("source")).agg(F.pow(F.count(F.lit(1)).cast("double"), power).alias("weight"))


def rates(docs: DataFrame, weights: DataFrame, total: int | None = None, source: str = "source") -> DataFrame:
    """(``source``, ``rate``, ``parts``, ``cdf``) per source; ``total`` is the number of rows wanted, by default as many as now."""
    counts = docs.groupBy(F.coalesce(source, F.lit("")).alias("source")).agg(F.count(F.lit(1)).alias("rows"))
    clean = weights.where("weight > 0").select(F.coalesce("source", F.lit("")).alias("source"), F.col("weight").cast("decimal(30,12)").alias("weight"))
    given = counts.join(clean.groupBy("source").agg(F.sum("weight").alias("weight")), "source")
    sums = given.agg(F.sum("weight").alias("all_weights"))
    rows = F.lit(total) if total is not None else F.col("all_rows")
    every = counts.agg(F.sum("rows").alias("all_rows"))
    out = given.join(F.broadcast(sums)).join(F.broadcast(every))  # one row each
    out = out.withColumn("rate", rows.cast("double") * F.col("weight").cast("double") / F.col("all_weights").cast("double") / F.col("rows"))
    out = out.withColumn("parts", F.ceil(F.col("rate") / PART).cast("int")).withColumn("mean", F.col("rate") / F.col("parts"))
    # p(k) = p(k - 1) * mean / k, added up as it goes.
    steps = F.expr(
        f"aggregate(sequence(1, {STEPS}), named_struct('p', exp(-mean), 'c', array(exp(-mean))), "
        "(a, k) -> named_struct('p', a.p * mean / k, 'c', array_append(a.c, element_at(a.c, -1) + a.p * mean / k)), a -> a.c)"
    )
    return out.select("source", "rate", "parts", steps.alias("cdf"))


def replicate(docs: DataFrame, rates: DataFrame, seed: int = 0, key: str = "doc_id", source: str = "source") -> DataFrame:
    """The columns of ``docs`` with ``copy`` (from 0) and ``order_key``, one row per copy, shuffled globally."""
    spread = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))
    table = written(rates.withColumn("__salt", spread).select(F.col("source").alias("__source"), "__salt", "parts", "cdf"), "rates")
    ident = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    rows = (
        docs.drop("copy", "order_key")
        .withColumn("__source", F.coalesce(source, F.lit("")))
        .withColumn("__salt", F.pmod(F.hash(key), F.lit(SALT)))
        .withColumn("__id", ident)
        .join(table, ["__source", "__salt"])
    )
    drawn = F.transform(F.sequence(F.lit(1), F.col("parts")), lambda j: uniform(F.lit(str(seed)), "__id", j.cast("string")))
    count = F.aggregate(
        "__drawn", F.lit(0), lambda n, u: n + F.size(F.filter("cdf", lambda c: c <= u))
    )
    counted = rows.withColumn("__drawn", drawn).withColumn("__n", count).where("__n > 0")
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("__n") - 1)))
    digest = F.md5(F.concat_ws(":", F.lit(f"{seed}-order"), "__id", F.col("copy").cast("string")))
    keyed = copies.withColumn("order_key", F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"))
    kept = [c for c in docs.columns if c not in ("copy", "order_key")]
    return keyed.select(*kept, "copy", "order_key").repartition("order_key").sortWithinPartitions("order_key")
