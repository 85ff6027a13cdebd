"""Similarity join of documents on the Jaccard coefficient of their word n-grams, by vertical partitioning.

The global order of the n-grams is that of their 64-bit hashes. Equal steps in it cut every document's set into fragments.

1. Documents with equal sets form a class, which a hash of the set names. Classes are compared, not ids: rows of one id with
   different texts are different documents. Ids come back in at the end, the smallest of each component.
2. The first fragment of every set is compared over the whole corpus. In a link at ratio t a set keeps at most the share
   1 - t of its n-grams to itself, so a class with more n-grams of its own in that fragment alone has no link. Nearly all
   documents end here, at the price of shuffling one fragment.
3. The rest are read again with all fragments; a bit map of their ids (``sieve``) spares the other texts the shuffle. By the prefix principle two sets can only link when they share one of their
   |x| - ceil(t |x|) + 1 rarest n-grams. In the list of such an n-gram, the member with the fewest n-grams of its own is the
   centre, and every other member is paired with it: as many pairs as members.
4. Overlaps of a pair are counted in every fragment separately and summed; the sum decides exactly.
5. Links found so far give components. Only pairs of members of one centre in different components are left. Two members share
   no more than each has in common with the centre, plus what each shares with others beyond it; pairs that this bound
   leaves are counted in the same way. So a group of near copies costs a star, not all its pairs, and no link between
   different components is lost.

Hashes have 64 bits: a wrong link needs a collision of n-grams or of whole sets.

Defined cases: a text with fewer words than n is one n-gram; a null, empty or blank text has an empty set, links with
nothing and is its own component; repeated rows and equal texts fall in one class; rows of one id with different texts
are linked each by its own text; a null id comes back with a null component, and a text that only rows without an id have
links with nothing; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from lossmetrics.functions.distributions import union_all
from lossmetrics.llm import sieve
from lossmetrics.llm.batches import assemble, blocks, with_fields
from lossmetrics.llm.graph import components
from lossmetrics.llm.tables import written
from lossmetrics.llm.words import BLOCK_BYTES, Block, mix

#: Fragments of the global order: equal ranges of the hash by its upper bits.
FRAGMENT_BITS = 2
FRAGMENTS = 1 << FRAGMENT_BITS


def ngram_sets(texts: list[str | None], n: int) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text, A-Z lower-cased."""
    block = Block(texts, lower_ascii=True)
    words, owner = block.word_hashes(), block.owner
    found = np.zeros(max(0, len(words) - n + 1), np.uint64)
    for k in range(n):
        found = found * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(found)]
    inside = owner[: len(found)] == owner[n - 1 :] if len(found) else np.zeros(0, bool)
    hashes, owners = mix(found[inside]), owner[: len(found)][inside]
    count = np.bincount(owner, minlength=block.texts)
    first = np.searchsorted(owner, np.arange(block.texts))
    short = np.flatnonzero((count > 0) & (count < n))
    extra = np.zeros(len(short), np.uint64)
    for k in range(n - 1):
        more = count[short] > k
        extra[more] = mix(extra[more] + words[first[short[more]] + k] * np.uint64(2 * k + 3))
    hashes, owners = np.concatenate([hashes, mix(extra + np.uint64(1))]), np.concatenate([owners, short])
    order = np.lexsort((hashes, owners))
    hashes, owners = hashes[order], owners[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    hashes, owners = hashes[new], owners[new]
    return np.split(hashes, np.searchsorted(owners, np.arange(1, block.texts)))


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    values = pa.array(np.concatenate([np.zeros(0, np.int64), *parts]).astype(kind.to_pandas_dtype()))
    return pa.ListArray.from_arrays(pa.array(ends), values)


def _class_of(sets: list[np.ndarray]) -> np.ndarray:
    """A hash of each set; n-gram hashes are mixed already."""
    return mix(np.array([s.sum() for s in sets], np.uint64)).view(np.int64)


def _first_fragments(docs: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(``id``, ``n``, ``class``, ``head``): set size, hash of the set, and its first fragment in 32 bits."""
    schema = StructType(
        [docs.schema[key], StructField("n", LongType()), StructField("class", LongType()), StructField("head", ArrayType(IntegerType()))]
    )
    step = np.uint64((1 << 64) // FRAGMENTS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, text, BLOCK_BYTES):
            sets = ngram_sets(part.column(text).to_pylist(), n)
            heads = [(s[: np.searchsorted(s, step)] & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(key),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(_class_of(sets)),
                    _lists(heads, pa.int32()),
                ],
                [key, "n", "class", "head"],
            )

    return docs.select(key, text).mapInArrow(run, schema).withColumnRenamed(key, "id")


def _all_fragments(texts: DataFrame, n: int) -> DataFrame:
    """(``id``, ``n``, ``grams``) with the whole set of each row's ``text``; ``id`` is its ``node``."""
    schema = StructType([StructField("id", LongType()), StructField("n", LongType()), StructField("grams", ArrayType(LongType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, "text", BLOCK_BYTES):
            sets = ngram_sets(part.column("text").to_pylist(), n)
            found = [part.column("node"), pa.array([len(s) for s in sets], pa.int64()), _lists([s.view(np.int64) for s in sets], pa.int64())]
            yield pa.RecordBatch.from_arrays(found, schema.fieldNames())

    return texts.select("node", "text").mapInArrow(run, schema)


#: Columns that ``with_class`` adds.
CLASS, SIZE = "__class", "__n"


def with_class(docs: DataFrame, text: str, n: int) -> DataFrame:
    """``docs`` with the class and the size of each row's set."""
    schema = with_fields(docs, [StructField(CLASS, LongType()), StructField(SIZE, LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in blocks(batches, text, BLOCK_BYTES):
            sets = ngram_sets(part.column(text).to_pylist(), n)
            yield assemble(part, schema, {CLASS: pa.array(_class_of(sets)), SIZE: pa.array([len(s) for s in sets], pa.int64())})

    return docs.mapInArrow(run, schema)


def _spare(percent: int) -> Column:
    """How many n-grams a set of size n can have to itself in a link: n - ceil(percent n / 100)."""
    return F.floor(F.col("n") * (100 - percent) / 100).cast("long")


def _possible(percent: int, most: Column | None = None) -> Column:
    """Whether the sizes, and an upper bound of the overlap, leave room for a link between sides a and b."""
    most = F.least("a.others", "b.others") if most is None else most
    return 100 * most >= percent * (F.col("a.n") + F.col("b.n") - most)


def _overlaps(pairs: DataFrame, fragments: DataFrame) -> DataFrame:
    """(``a``, ``b``, ``a_n``, ``b_n``, ``overlap``) of ``pairs``: counted by fragment, then summed."""
    one = fragments.select(F.col("id").alias("a"), "fragment", F.col("n").alias("a_n"), F.col("grams").alias("a_grams"))
    two = fragments.select(F.col("id").alias("b"), "fragment", F.col("n").alias("b_n"), F.col("grams").alias("b_grams"))
    both = pairs.join(one, "a").join(two, ["b", "fragment"])
    partial = both.select("a", "b", "a_n", "b_n", F.size(F.array_intersect("a_grams", "b_grams")).alias("overlap"))
    return partial.groupBy("a", "b", "a_n", "b_n").agg(F.sum("overlap").alias("overlap"))


def _linked(overlaps: DataFrame, percent: int) -> DataFrame:
    return overlaps.where(F.expr(f"100 * overlap >= {percent} * (a_n + b_n - overlap)")).select("a", "b")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _candidates(docs: DataFrame, heads: DataFrame, key: str, text: str, n: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(``id``, ``n``, ``grams``) of the classes that the first fragment does not rule out, and their (``class``, ``node``).

    From here on ``id`` is the node: a number that the written list gives a class, small and so cheap to shuffle.
    """
    single = (
        heads.select("class", F.explode("head").alias("gram"))
        .groupBy("gram")
        .agg(F.min("class").alias("class"), F.max("class").alias("last"))
        .where("class = last")
        .groupBy("class")
        .agg(F.count(F.lit(1)).alias("own"))
    )
    classes = heads.where("n > 0").groupBy("class").agg(F.min("id").alias("id"), F.max("n").alias("n"))
    left = classes.join(single, "class", "left").where(F.coalesce("own", F.lit(0)) <= _spare(percent)).select("class", "id")
    left = written(left.where(F.col("id").isNotNull()).withColumn("node", F.monotonically_increasing_id()), "left")
    # Texts of ids that are not listed are not shuffled; other texts of these ids are read and left out by their class.
    likely, _ = sieve.split(docs.select(F.col(key).alias("id"), F.col(text).alias("text")), left, "id")
    texts = with_class(likely, "text", n).withColumnRenamed(CLASS, "class").join(left, ["class", "id"]).dropDuplicates(["class", "id"])
    return written(_all_fragments(texts, n), "sets"), left


def links(sets: DataFrame, percent: int) -> DataFrame:
    """(``a``, ``b``): links between (``id``, ``n``, ``grams``) that connect all that is connected."""
    grams = sets.select("id", "n", F.explode("grams").alias("gram"))
    often = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    rows = (
        grams.join(often, "gram")
        .groupBy("id", "n")
        .agg(F.array_sort(F.collect_list(F.struct("df", "gram"))).alias("found"))
        .withColumn("others", F.size("found").cast("long"))
        .where(F.col("n") - F.col("others") <= _spare(percent))
    )
    rows = written(rows, "rows")
    fragments = rows.select("id", "n", F.explode(F.sequence(F.lit(0), F.lit(FRAGMENTS - 1))).alias("fragment"), "found")
    fragments = fragments.withColumn("grams", F.expr(f"transform(filter(found, f -> shiftrightunsigned(f.gram, {64 - FRAGMENT_BITS}) = fragment), f -> f.gram)"))
    fragments = written(fragments.drop("found"), "fragments")
    prefix = F.expr("slice(found, 1, greatest(0, int(spare + 1 - (n - others))))")
    posts = rows.withColumn("spare", _spare(percent)).select("id", "n", "others", F.explode(prefix).alias("f"))
    posts = posts.select("id", "n", "others", F.col("f.gram").alias("gram"))
    centres = posts.groupBy("gram").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct(F.expr("n - others").alias("own"), "id", "n", "others")).alias("c"))
    centres = centres.where("size > 1").select("gram", F.col("c.id").alias("id"), F.col("c.n").alias("n"), F.col("c.others").alias("others"))
    posts = written(posts.join(centres.select("gram", F.col("id").alias("centre")), "gram"), "posts")
    stars = posts.alias("a").join(centres.alias("b"), "gram").where(F.col("a.id") != F.col("b.id")).where(_possible(percent))
    counted = written(_overlaps(_ordered(stars.select(F.col("a.id").alias("x"), F.col("b.id").alias("y"))), fragments), "stars")
    first = _linked(counted, percent)
    groups = components(first)
    label = lambda side: groups.select(F.col("node").alias(side), F.col("component").alias(f"{side}_group"))
    members = posts.where("id <> centre").select("centre", "id", "n", "others").distinct()
    pair = [F.least("id", "centre") == F.col("a"), F.greatest("id", "centre") == F.col("b")]
    members = members.join(counted.select("a", "b", "overlap"), pair, "left").join(label("id"), "id", "left").join(label("centre"), "centre", "left")
    # ``common``: n-grams shared with the centre; ``beyond``: others that occur elsewhere. Without a count both may be all.
    members = members.select(
        "centre", "id", "n", "others", F.coalesce("overlap", "others").alias("common"),
        F.coalesce(F.col("others") - F.col("overlap"), F.col("others")).alias("beyond"),
        F.coalesce("id_group", "id").alias("group"), F.coalesce("centre_group", "centre").alias("main"),
    )
    members = written(members, "members")
    # What two members share lies in their centre, or beyond it.
    most = F.least("a.others", "b.others", F.least("a.common", "b.common") + F.least("a.beyond", "b.beyond"))
    rest = (
        members.where("group <> main").alias("a")
        .join(members.alias("b"), "centre")
        .where("a.group <> b.group AND (b.group = b.main OR a.id < b.id)")
        .where(_possible(percent, most))
        .select(F.col("a.id").alias("x"), F.col("b.id").alias("y"))
    )
    return first.union(_linked(_overlaps(_ordered(rest), fragments), percent))


def _groups(docs: DataFrame, heads: DataFrame, key: str, text: str, n: int, percent: int) -> DataFrame:
    """(``class``, ``id``, ``rows``, ``component``) of every class: its smallest id, and the component's name if it has links."""
    sets, left = _candidates(docs, heads, key, text, n, percent)
    found = components(links(sets, percent)).join(left, "node").select("class", "component")
    classes = heads.where("n > 0").groupBy("class").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("rows"))
    return classes.join(found, "class", "left")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """(``key``, ``n_shingles``, ``component_id``) per row: documents are linked at ``percent`` of their union or more."""
    heads = written(_first_fragments(docs, key, text, n), "heads")
    groups = _groups(docs, heads, key, text, n, percent).where("rows > 1 OR component IS NOT NULL")
    first = groups.where("component IS NOT NULL").groupBy("component").agg(F.min("id").alias("first"))
    labels = groups.join(first, "component", "left").select("class", F.coalesce("first", "id").alias("component"))
    joined = heads.select("id", "n", F.when(F.col("n") > 0, F.col("class")).alias("class")).join(labels, "class", "left")
    return joined.select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near duplicates: that with the smallest id.

    Rows of one id and one set of n-grams are one document; rows of one id with different texts are judged each by its own
    text. Rows without an id or without words are in no group and stay.
    """
    heads = written(_first_fragments(docs, key, text, n), "heads")
    known = heads.where("n > 0 AND id IS NOT NULL").groupBy("id", "class").agg(F.count(F.lit(1)).alias("copies"))
    groups = _groups(docs, heads, key, text, n, percent).select("class", F.coalesce(F.concat(F.lit("of "), "component"), F.col("class").cast("string")).alias("group"), (F.col("component").isNotNull() | (F.col("rows") > 1)).alias("shared"))
    # Rows of classes of their own are neither compared nor moved.
    several = known.join(groups.where("shared"), "class")
    stays = several.groupBy("group").agg(F.min(F.struct("id", "class")).alias("first")).select("group", F.lit(True).alias("stays"), "first.*")
    gone = several.join(stays, ["group", "id", "class"], "left").where("stays IS NULL").select(F.col("id").alias(key), F.col("class").alias(CLASS))
    repeated = known.where("copies > 1").select(F.col("id").alias(key), F.col("class").alias(CLASS))
    gone = written(gone, "gone")
    # The lists are settled before they meet the texts; only texts of listed ids are shuffled.
    repeated = written(repeated.join(gone, [key, CLASS], "left_anti"), "repeated")
    apart = written(gone.unionByName(repeated), "apart")
    likely, others = sieve.split(docs, apart, key)
    marked = with_class(likely, text, n).withColumn(CLASS, F.when(F.col(SIZE) > 0, F.col(CLASS)))
    once = marked.join(repeated, [key, CLASS], "left_semi").dropDuplicates([key, CLASS])
    return union_all([df.select(*docs.columns) for df in (others, marked.join(apart, [key, CLASS], "left_anti"), once)])
