"""Document fingerprints from spot signatures: chains of content words that follow common words.

A spot is a common word (an anchor, from a fixed list). Its signature is the anchor with the next ``chain`` words that are
not anchors, hashed to 32 bits; near the end of a text the chain is shorter. The fingerprint of a text is the sorted set of
its signatures, written in hexadecimal; the likeness of two fingerprints is the Jaccard coefficient of their sets.

``near_pairs`` compares whole tables: equal fingerprints form a class, sets are partitioned by their length so that only
sets of the same or the next partition can reach the threshold, and within these the rarest signatures of a set are its
only join keys, with lengths checked before any set is compared.

Everything is DataFrame functions. Nothing is broadcast by hand, and no window or list holds the rows of a common key.

Defined cases: words are runs of letters and digits, lower-cased; a text without a complete spot has one signature, the hash
of all its words, so a null text equals an empty one and no set is empty; equal texts have equal fingerprints; columns named
like a result are replaced, all others stay.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossmetrics.llm.tables import written

#: Anchors: common words of the languages read here (English, German, French, Spanish).
ANCHORS = tuple(
    """
    a an and are as at be but by for from had has have he her his i in is it its not of on or she that the their they this to was
    were which will with you
    als auf aus bei das dem den der des die ein eine einer er es für im ist mit nicht sich sie und von wie zu
    au aux avec ce dans du elle en est et il je la le les leur ne nous ou par pas plus pour que qui sa se ses son sur un une
    al como con de del el ella esta este lo los las más no para pero por si sin su sus una y
    """.split()
)
CHAIN = 2


def with_signatures(df: DataFrame, text: str = "text", result: str = "signatures", anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN) -> DataFrame:
    """``df`` with the sorted distinct signatures of the whole text as an array of integers."""
    words = F.array_remove(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+"), "")
    # One string per content word, with the anchors directly before it in front; no word holds a space or a line feed.
    ended = F.transform("__words", lambda w: F.concat(w, F.when(w.isin(*anchors), F.lit(" ")).otherwise(F.lit("\n"))))
    last = lambda run: F.substring_index(run, " ", -1)
    runs = F.col("__runs")

    def spots(run: Column, place: Column) -> Column:
        follow = [F.coalesce(F.get(F.col("__content"), place + k), F.lit("")) for k in range(chain)]
        before = F.slice(F.split(run, " "), 1, F.size(F.split(run, " ")) - 1)
        return F.when(F.instr(run, " ") > 0, F.transform(before, lambda anchor: F.hash(anchor, *follow)))

    return (
        df.drop(result)
        .withColumn("__words", words)
        .withColumn("__all", F.split(F.array_join(ended, ""), "\n"))
        # What follows the last content word is no spot.
        .withColumn("__runs", F.slice("__all", 1, F.size("__all") - 1))
        .withColumn("__content", F.transform(runs, last))
        .withColumn("__spots", F.flatten(F.filter(F.transform(runs, spots), lambda s: s.isNotNull())))
        .withColumn(
            result,
            F.when(F.size("__spots") > 0, F.sort_array(F.array_distinct("__spots"))).otherwise(F.array(F.hash(F.array_join("__words", " ")))),
        )
        .drop("__words", "__all", "__runs", "__content", "__spots")
    )


def written_form(signatures: str) -> Column:
    """The fingerprint as text: eight hexadecimal digits per signature."""
    return F.array_join(F.transform(signatures, lambda s: F.lpad(F.hex(s.bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))), 8, "0")), "")


def likeness(a: str, b: str) -> Column:
    """Jaccard coefficient of two signature sets."""
    both = F.size(F.array_intersect(a, b))
    return both / (F.size(a) + F.size(b) - both)


def neighbours(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``row``, ``rows``, ``previous``, ``take``) by distinct (id, text): the row before it in a circle by id, and how many characters that takes of it.

    Ids are sorted in ranges. Each range looks up its neighbours alone; the table of last rows has one row per range.
    """
    ids = docs.select(F.col(key).alias("id"), F.xxhash64(key, text).alias("row"), F.coalesce(F.length(text), F.lit(0)).alias("chars"))
    ids = ids.groupBy("id", "row", "chars").agg(F.count(F.lit(1)).alias("rows"))
    ranges = written(ids.repartitionByRange("id", "row").withColumn("part", F.spark_partition_id()), "order")
    inside = Window.partitionBy("part").orderBy("id", "row")
    lasts = ranges.groupBy("part").agg(F.max(F.struct(F.col("id").isNotNull().alias("given"), "id", "row", "chars")).alias("last"))
    circle = Window.orderBy("part")  # one row per range
    before = lasts.select("part", F.coalesce(F.lag("last").over(circle), F.max("last").over(Window.partitionBy())).alias("before"))
    chars = F.coalesce(F.lag("chars").over(inside), F.col("before.chars"))
    return (
        ranges.join(before, "part")
        .select("row", "rows", F.coalesce(F.lag("row").over(inside), F.col("before.row")).alias("previous"), F.floor(chars / 4).cast("int").alias("take"))
    )


def with_edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(``id``, ``text``, ``signatures``, ``edited``, ``next_signatures``) per row.

    ``edited`` is the text with its last quarter replaced by the beginning of the next text in the order of ids, the last
    one followed by the first. Whole texts are shuffled once, by row; only beginnings and signatures go to the row before.
    Rows that occur more than once are handled once and come back as often.
    """
    order = neighbours(docs, key, text)
    once = docs.groupBy(F.xxhash64(key, text).alias("row")).agg(F.first(F.struct(F.col(key).alias("id"), F.col(text).alias("text"))).alias("d"))
    placed = once.join(order, "row").select("row", "rows", "previous", "take", "d.id", F.coalesce("d.text", F.lit("")).alias("text"))
    placed = with_signatures(placed, "text")
    begins = placed.select(
        F.col("previous").alias("row"), F.expr("substring(text, 1, take)").alias("begin"), F.col("signatures").alias("next_signatures")
    )
    kept = F.expr("substring(text, 1, length(text) - int(floor(length(text) / 4)))")
    return (
        placed.select("row", "rows", "id", "text", "signatures")
        .join(begins, "row")
        .withColumn("edited", F.concat(kept, "begin"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "rows")))
        .select("id", "text", "signatures", "edited", "next_signatures")
    )


def near_pairs(df: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """Pairs (``a``, ``b``, ``likeness``) of class representatives, and the membership (``key``, ``representative``).

    Null ids take no part. A representative is the smallest id of its class.
    """
    sets = written(with_signatures(df.where(F.col(key).isNotNull()).select(key, text), text).select(key, "signatures"), "spots")
    classes = sets.groupBy("signatures").agg(F.min(key).alias("representative"))
    members = sets.join(classes, "signatures").select(key, "representative")
    reps = written(classes.select(F.col("representative").alias("id"), "signatures", F.size("signatures").alias("size")), "classes")
    # Sets of one partition differ in length by the factor of the threshold at most, so a match is in the same or the next.
    part = F.floor(F.log("size") / -math.log(threshold - 1e-3)).cast("int")
    spots = reps.select("id", "size", F.explode("signatures").alias("spot"))
    often = spots.groupBy("spot").agg(F.count(F.lit(1)).alias("df"))
    ranked = spots.join(often, "spot").groupBy("id", "size").agg(F.array_sort(F.collect_list(F.struct("df", "spot"))).alias("found"))
    keep = (F.col("size") - F.ceil(F.col("size") * threshold) + 1).cast("int")
    keys = ranked.withColumn("keep", keep).select("id", "size", part.alias("part"), F.explode(F.expr("slice(found, 1, keep)")).alias("f"))
    keys = written(keys.where("f.df > 1").select("id", "size", "part", F.col("f.spot").alias("spot")), "keys")
    probes = keys.withColumn("part", F.explode(F.array(F.col("part"), F.col("part") + 1)))
    fits = (F.col("a.size") >= F.ceil(F.col("b.size") * threshold)) & (F.struct("a.size", "a.id") < F.struct("b.size", "b.id"))
    found = probes.alias("a").join(keys.alias("b"), ["part", "spot"]).where(fits).select(F.col("a.id").alias("a"), F.col("b.id").alias("b")).distinct()
    side = lambda n: reps.select(F.col("id").alias(n), F.col("signatures").alias(f"{n}_set"))
    compared = found.join(side("a"), "a").join(side("b"), "b").select("a", "b", likeness("a_set", "b_set").alias("likeness"))
    return compared.where(F.col("likeness") >= threshold), members
