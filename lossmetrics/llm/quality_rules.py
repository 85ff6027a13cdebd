"""Quality rules: counts over words and lines, and a hashed n-gram log-likelihood ratio against a trusted target.

Words and pairs of neighbouring words are hashed into ``buckets``. Two multinomials are counted over all documents: one
over the whole corpus, one over its trusted part. The score of a document is the mean, over its n-grams, of the logarithm of
target probability over corpus probability, so it does not grow with the length; a document is kept when it passes the base
rules and its score reaches a fixed threshold. Everything is DataFrame functions.

What is broadcast is one row with ``buckets`` 4-byte weights, 256 KB at the default, whatever the data.

Defined cases: a null text has no words and fails the base rules, as does an empty one; a text without n-grams scores 0; a
null id is never trusted; an id that is labelled more than once is trusted when all its labels are 1; without a trusted
document all weights are 0 and the base rules alone decide; repeated rows are judged alike; columns named like a result are
replaced, all others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossmetrics.llm.tables import written

BUCKETS = 1 << 16
THRESHOLD = -0.12
#: Counts added per bucket on both sides, so that absence from a small target says little.
PRIOR = 20.0
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
_SPACE = r"[\x20\x09-\x0D]+"
RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "llr", "kept"]


def _with_words(df: DataFrame, text: str) -> DataFrame:
    """``df`` with ``__words``, and ``__hashes``, one 64-bit hash for each."""
    words = F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), _SPACE), "")
    return df.withColumn("__words", words).withColumn("__hashes", F.transform("__words", lambda w: F.xxhash64(w)))


def _runs(count: Column, last_of_run: int, each) -> Column:
    """``each(i)`` for every start of a run of so many words; an empty array for shorter texts."""
    starts = F.sequence(F.lit(0), count - last_of_run)
    return F.when(count >= last_of_run, F.transform(starts, each)).otherwise(F.array().cast("array<bigint>"))


def _buckets(buckets: int) -> Column:
    """Buckets of all words and of all pairs of neighbours."""
    h = F.col("__hashes")
    single = F.transform(h, lambda x: F.pmod(x, F.lit(buckets).cast("long")))
    pairs = _runs(F.size(h), 2, lambda i: F.pmod(F.xxhash64(h[i], h[i + 1]), F.lit(buckets).cast("long")))
    return F.concat(single, pairs)


def with_base_rules(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the counts of the base rules and ``base_failed``."""
    pinned = _base(_with_words(df.drop(*RESULTS), text), text).drop("__words", "__hashes").withColumn("__pin", F.monotonically_increasing_id())
    return _unpinned(pinned)


def _unpinned(df: DataFrame) -> DataFrame:
    """Results that depend on ``__pin``, a number that Spark may not move.

    Without it a filter on a result is pushed below the steps that compute it, and a list that one step makes is then made
    anew for every element of the next.
    """
    found = [c for c in RESULTS if c in df.columns]
    return df.withColumns({c: F.when(F.col("__pin") >= 0, F.col(c)) for c in found}).drop("__pin")


def _base(df: DataFrame, text: str) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    h = F.col("__hashes")
    out = (
        df.withColumn("n_words", F.size("__words").cast("long"))
        .withColumn("word_chars", F.length(F.regexp_replace(whole, _SPACE, "")).cast("long"))
        .withColumn("n_symbols", F.length(F.regexp_replace(whole, r"[^#*$%&|<>]++", "")).cast("long"))
        .withColumn("__lines", lines)
        .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"))
        .withColumn("__windows", _runs(F.size(h), WINDOW, lambda i: F.xxhash64(*[h[i + k] for k in range(WINDOW)])))
    )
    # Only texts with a repeated window go on. Their windows are sorted as one number each: the upper bits of the hash over
    # the position, which takes as many bits as the text needs.
    out = out.withColumn(
        "__places",
        F.expr("shiftleft(1L, length(bin(size(__windows)))) - 1L"),
    ).withColumn(
        "__sorted",
        F.when(
            F.size(F.array_distinct("__windows")) < F.size("__windows"),
            F.sort_array(F.expr("transform(__windows, (w, i) -> (w & ~__places) | i)")),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    same = "(__sorted[{0}] & ~__places) = (v & ~__places)"
    out = out.withColumn(
        "__found",
        F.sort_array(
            F.expr(
                f"transform(filter(__sorted, (v, i) -> (i > 0 AND {same.format('i - 1')}) OR "
                f"(i + 1 < size(__sorted) AND {same.format('i + 1')})), v -> v & __places)"
            )
        ),
    )
    covered = (
        f"aggregate(transform(__found, (p, i) -> CASE WHEN i + 1 < size(__found) THEN least({WINDOW}L, __found[i + 1] - p) "
        f"ELSE {WINDOW}L END), 0L, (a, x) -> a + x)"
    )
    return (
        out.withColumn("n_repeat_words", F.expr(covered))
        .withColumn(
            "base_failed",
            (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")),
        )
        .drop("__lines", "__windows", "__places", "__sorted", "__found")
    )


def trusted_ids(labels: DataFrame, key: str = "doc_id", label: str = "quality") -> DataFrame:
    """(``__bucket``, ``__bits``): a bitmap of the integer ids all of whose labels are 1, 32,768 ids a row.

    It is written, so Spark knows its size, about one bit per id: it is broadcast when that is small and joined by bucket
    otherwise.
    """
    known = labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.coalesce(F.col(label), F.lit(0))).alias("__label"))
    good = known.where("__label = 1").select(F.col(key).cast("long").alias("id"))
    bits = good.groupBy(F.bitmap_bucket_number("id").alias("__bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("__bits"))
    return written(bits, "trusted")


def _is_trusted(docs: DataFrame, trusted: DataFrame, key: str, text: str) -> DataFrame:
    """(``text``, ``__trusted``) of every row; ``__trusted`` is 0 or 1."""
    ident = F.col(key).cast("long")
    marked = docs.select(text, F.bitmap_bucket_number(ident).alias("__bucket"), F.bitmap_bit_position(ident).cast("int").alias("__place"))
    byte = F.conv(F.hex(F.substring("__bits", F.floor(F.col("__place") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.expr("shiftright(__byte, __place % 8) & 1")
    joined = marked.join(trusted, "__bucket", "left").withColumn("__byte", byte)
    return joined.select(text, F.coalesce(bit, F.lit(0)).alias("__trusted"))


def bucket_weights(docs: DataFrame, trusted: DataFrame, key: str = "doc_id", text: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """One row: ``weights``, the log ratio of every bucket. Counts are taken over all documents."""
    marked = _is_trusted(docs, trusted, key, text)
    grams = _with_words(marked, text).select("__trusted", F.explode(_buckets(buckets)).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("corpus"), F.sum("__trusted").alias("target"))
    full = docs.sparkSession.range(buckets).select(F.col("id").alias("bucket")).join(F.broadcast(counts), "bucket", "left")
    one = full.select("bucket", F.coalesce("corpus", F.lit(0)).alias("corpus"), F.coalesce("target", F.lit(0)).alias("target"))
    listed = one.groupBy().agg(
        F.array_sort(F.collect_list(F.struct("bucket", "corpus", "target"))).alias("cells"),
        F.sum("corpus").alias("corpus"),
        F.sum("target").alias("target"),
    )
    # The corpus multinomial times the size of the target is what the target would hold if it were like the corpus.
    expected = lambda c: c["corpus"] * F.col("target") / F.col("corpus")
    weight = lambda c: F.log((c["target"] + PRIOR) / (expected(c) + PRIOR))
    zero = F.lit(0.0)
    return listed.select(
        F.transform("cells", lambda c: F.when(F.col("target") > 0, weight(c)).otherwise(zero).cast("float")).alias("__weights")
    )


def judge(docs: DataFrame, weights: DataFrame, text: str = "text", buckets: int = BUCKETS, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with all results; the weights are the one row of ``bucket_weights``."""
    scored = (
        _base(_with_words(docs.drop(*RESULTS), text), text)
        .withColumn("__buckets", _buckets(buckets))
        .drop("__words", "__hashes")
        .withColumn("__pin", F.monotonically_increasing_id())
        .join(F.broadcast(weights))  # one row of a fixed size
    )
    total = F.aggregate("__buckets", F.lit(0.0), lambda a, b: a + F.col("__weights")[b.cast("int")])
    judged = scored.withColumn("llr", total / F.greatest(F.size("__buckets"), F.lit(1)))
    judged = judged.withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))
    return _unpinned(judged.drop("__buckets", "__weights"))
