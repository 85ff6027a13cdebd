"""Registered queries of the training-text operators: query name to function of (session, data folder), and SQL texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lossmetrics.llm import bpe, classifier, divergence, filter_audit, jaccard, licenses, mixing, packing, quality_rules, resharding, spotsigs, url_filter, warc
from lossmetrics.llm.tables import written

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the token ids and of the decoded text of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, tokenizer_path(), ("n_tokens", "ids_sha256", "decoded_sha256"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and log-likelihood verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trusted = quality_rules.trusted_ids(table(spark, sf_dir, "labels"))
    judged = quality_rules.judge(docs, quality_rules.bucket_weights(docs, trusted))
    return judged.select("doc_id", *quality_rules.RESULTS)


def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text, with the likeness to the edited and to the next text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = spotsigs.with_signatures(spotsigs.with_edited(docs), "edited", "edited_signatures")
    return both.select(
        F.col("id").alias("doc_id"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        spotsigs.written_form("signatures").alias("fingerprint"),
        spotsigs.written_form("edited_signatures").alias("edited_fingerprint"),
        spotsigs.likeness("signatures", "edited_signatures").alias("near_edited"),
        spotsigs.likeness("signatures", "next_signatures").alias("near_next"),
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule or model verdict of every page's url."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_filter.judge(pages, url_filter.train(url_filter.labelled()))
    return judged.select("page_id", "host", "path", "rule", "verdict", "unwanted")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives, read back and put together."""
    pages = table(spark, sf_dir, "pages")
    path = warc.write(pages.select("page_id", "url", "html"))
    records = written(warc.read(spark, path, payloads=False).drop("payload"), "records")  # parsed once
    capture = warc.captures(records)
    return capture.select(
        F.col("metadata.page_id").cast("long").alias("page_id"),
        F.col("metadata.payload_bytes").alias("payload_bytes"),
        F.col("response.digest").alias("payload_digest"),
        F.col("response.kind").alias("record_type"),
        F.col("response.refers_to").cast("long").alias("refers_to"),
    )


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents repeated to tempered source weights, as many rows as there are documents, in a global shuffle."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return mixing.replicate(docs, mixing.rates(docs, mixing.tempered(docs), source="source"))


def source_tree(docs: DataFrame) -> DataFrame:
    """Documents as files: source/lang/group/file. The first id of a group of 64 is its licence file, as is the first of 4096 of its language."""
    place = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")))
    group = F.concat_ws("/", place, F.floor(F.col("doc_id") / 64).cast("string"))
    top, first = F.pmod("doc_id", F.lit(4096)) == 0, F.pmod("doc_id", F.lit(64)) == 0
    named = F.when(top, F.concat(place, F.lit("/LICENSE"))).when(first, F.concat(group, F.lit("/LICENSE")))
    return docs.withColumn("path", named.otherwise(F.concat(group, F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License of every document, laid out as a tree of files."""
    files = source_tree(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))
    return licenses.scan(files.select("doc_id", "path", "text")).select("doc_id", "path", "license", "basis", "cosine")


def op8_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents moved from shards by source to eight shards of equal bytes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    old = resharding.lay_out(docs, F.pmod(F.crc32("source"), F.lit(8)))
    placed = resharding.slots(resharding.reshard(old, 8))
    return placed.select("*", F.lit("bytes").alias("law"), F.lit(None).cast("int").alias("grown_shard"))


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links at 90 percent of three-word shingles."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.near_duplicates(docs, n=3, percent=90)


def held_out(key: str = "doc_id") -> Column:
    """Whether an id belongs to the fold whose labels are never learnt from; a null id does not."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 == 0, F.lit(False))


def quality_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> classifier.Model:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out())
    return classifier.train(docs, labels)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = classifier.score(docs, quality_model(spark, docs, sf_dir))
    predicted = (F.col("score") >= 0.3).cast("int")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted.alias("predicted"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from the documents of each language, at each step of each order."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit.audit(docs, table(spark, sf_dir, "labels"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens cut and packed in sequences of 2,048."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(written(packing.pieces(docs, tokenizer_path()), "pieces"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How differently the sources of each language use its terms: all pairs of sources, and the leading terms of each."""
    return divergence.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


def registry() -> dict[str, Query]:
    return {
        "op1_bpe": op1_bpe,
        "op2_quality_rules": op2_quality_rules,
        "op3_spotsigs": op3_spotsigs,
        "op4_url_filter": op4_url_filter,
        "op5_warc": op5_warc,
        "op6_mixing": op6_mixing,
        "op7_license_scan": op7_license_scan,
        "op8_resharding": op8_resharding,
        "op9_ngram_jaccard": op9_ngram_jaccard,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_filter_audit": op11_filter_audit,
        "op12_packing": op12_packing,
        "op13_source_divergence": op13_source_divergence,
    }


OP6_SQL = """
WITH counts AS (SELECT coalesce(source, '') AS s, count(*) AS rows FROM documents GROUP BY 1),
weights AS (SELECT s, rows, sqrt(rows::DOUBLE)::DECIMAL(30, 12) AS weight FROM counts),
rates AS (
    SELECT s, sum(rows) OVER ()::DOUBLE * weight::DOUBLE / (sum(weight) OVER ())::DOUBLE / rows AS rate FROM weights
),
parts AS (SELECT s, ceil(rate / 32.0)::INT AS parts, rate / ceil(rate / 32.0) AS mean FROM rates),
cdf AS (
    SELECT s, parts, sum(exp(k * ln(mean) - mean - lgamma(k + 1))) OVER (PARTITION BY s ORDER BY k) AS c
    FROM parts, range(0, 121) AS r(k)
),
draws AS (
    SELECT d.rowid AS row, d.doc_id, p.s, ('0x' || substr(md5('0:' || d.doc_id || ':' || j), 1, 13))::BIGINT / 4503599627370496.0 AS u
    FROM (SELECT *, row_number() OVER () AS rowid FROM documents) d JOIN parts p ON p.s = coalesce(d.source, ''), range(1, 9) AS r(j)
    WHERE j <= p.parts
),
numbers AS (
    SELECT row, count(*) AS n FROM draws JOIN cdf ON cdf.s = draws.s AND cdf.c <= draws.u GROUP BY row
)
SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, copy::INT AS copy,
    ('0x' || substr(md5('0-order:' || d.doc_id || ':' || copy), 1, 15))::BIGINT AS order_key
FROM (SELECT *, row_number() OVER () AS rowid FROM documents) d JOIN numbers ON numbers.row = d.rowid, range(0, 1000) AS r(copy)
WHERE copy < n
"""


OP5_SQL = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS bytes, sha1(coalesce(html, '')) AS digest FROM pages),
h AS (SELECT *, max(page_id) OVER (PARTITION BY digest, bytes) AS head FROM p)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
    CASE WHEN bytes >= 1000 AND page_id < head THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN bytes >= 1000 AND page_id < head THEN head END AS refers_to
FROM h
"""


OP11_SQL = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS part FROM documents),
words AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first FROM texts),
marks AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
fails AS (
    SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
        len(words) < 200 AS a,
        100 * len(list_distinct(words)) < 50 * len(words) AS b,
        100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text) AS c,
        regexp_matches(text, '[#$%&*|]') AS d,
        coalesce(doc_id > first, false) AS e
    FROM words LEFT JOIN marks USING (doc_id)
),
sets AS (
    SELECT part, CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
        || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END AS failed,
        count(*) AS n, sum(good::INT) AS good, sum(toxic::INT) AS toxic
    FROM fails GROUP BY 1, 2
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
    FROM letters p JOIN letters q ON q.x <> p.x JOIN letters r ON r.x NOT IN (p.x, q.x) JOIN letters s ON s.x NOT IN (p.x, q.x, r.x)
    JOIN letters t ON t.x NOT IN (p.x, q.x, r.x, s.x)
),
steps AS (
    SELECT filter_order, step::INT AS step, substr(filter_order, step, 1) AS own, substr(filter_order, 1, step - 1) AS before
    FROM orders, range(1, 6) AS g(step)
),
totals AS (
    SELECT part, filter_order, step, own,
        sum(CASE WHEN NOT gone AND NOT hit THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN NOT gone AND hit THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN gone AND hit THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN failed = own THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN NOT gone AND hit THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN NOT gone AND hit THEN toxic ELSE 0 END) AS toxic_lost
    FROM (
        SELECT *, contains(failed, own) AS hit, translate(before, failed, '') <> before AS gone FROM sets, steps
    )
    GROUP BY 1, 2, 3, 4
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
    unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
    (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM totals
"""


OP13_SQL = """
WITH docs AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
),
found AS (
    SELECT row, lang, source,
        unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM docs
),
kept AS (SELECT lang, term FROM found GROUP BY 1, 2 HAVING count(DISTINCT row) >= 30),
known AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
counts AS (SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
groups AS (
    SELECT lang, source, coalesce(v, 0) AS v, coalesce(total, 0) AS total
    FROM (SELECT DISTINCT lang, source FROM docs) LEFT JOIN known USING (lang)
    LEFT JOIN (SELECT lang, source, sum(n) AS total FROM counts GROUP BY 1, 2) USING (lang, source)
),
shares AS (
    SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (total + 5 * v) AS p
    FROM groups JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
),
whole AS (
    SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(n) + 5)) // (sum(sum(n)) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q
    FROM counts GROUP BY 1, 2
),
pairs AS (
    SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN (
        SELECT x.lang, x.source, y.source AS other, sum(abs(x.p - y.p)) AS value
        FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 3
    ) d ON d.lang = a.lang AND d.source = a.source AND d.other = b.source
),
terms AS (SELECT lang, source, term AS item, p - q AS value FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
    SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
    UNION ALL
    SELECT lang, source, 'term', item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


def oracle_sql() -> dict[str, str]:
    return {"op5_warc": OP5_SQL, "op6_mixing": OP6_SQL, "op11_filter_audit": OP11_SQL, "op13_source_divergence": OP13_SQL}
