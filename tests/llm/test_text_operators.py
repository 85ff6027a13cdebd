"""Encoding, rules, fingerprints, similarity join and classifier against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from lossmetrics.llm import bpe, classifier, graph, jaccard, quality_rules, queries, sieve, spotsigs

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df):
    return sorted((r.asDict() for r in df.collect()), key=lambda r: (r["doc_id"] is not None, r["doc_id"]))


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def test_bpe_is_the_library(spark, awkward, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path())
    got = rows_of(queries.registry()["op1_bpe"](spark, awkward))
    assert len(got) == len(texts)
    for row, text in zip(got, texts):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == sha(" ".join(map(str, ids)))
        assert row["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))


def test_bpe_words_share_prefixes():
    with open(queries.tokenizer_path(), encoding="utf-8") as file:
        vocabulary = bpe.Vocabulary(file.read())
    words = ["a" * n for n in range(1, 60)] + ["haha" * n for n in range(1, 9)] + ["internationalisation", "international", "inter", "in"]
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path())
    found = vocabulary.encode_words(words)
    for word in words:
        assert np.frombuffer(found[word], np.int32).tolist() == library.encode(word, add_special_tokens=False).ids
    with pytest.raises(ValueError):
        bpe.Vocabulary('{"model": {"type": "Unigram"}, "normalizer": {"normalizers": []}, "pre_tokenizer": {"pretokenizers": [{"invert": false}]}}')


def test_encode_keeps_columns_and_replaces_result(spark):
    df = spark.createDataFrame([(1, "hello world", "x"), (1, "hello world", "x"), (None, None, "y")], "doc_id long, text string, ids string")
    out = bpe.decode(bpe.encode(df, queries.tokenizer_path()), queries.tokenizer_path())
    assert out.columns == ["doc_id", "ids", "decoded"]
    got = rows_of(out)
    assert got[0]["ids"] == [] and got[0]["decoded"] == ""
    assert got[1] == got[2] and got[1]["decoded"] == "hello</w> world</w>"


def base_rules(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    count = Counter(windows)
    hit = set()
    for k, w in enumerate(windows):
        if count[w] > 1:
            hit.update(range(k, k + 5))
    failed = len(words) < 10 or 100 * len(hit) > 20 * len(words)
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit), "base_failed": failed,
    }


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def gram_buckets(text):
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in WORD.findall(text or "")]
    pair = lambda a, b: xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42))
    return [signed(h) % quality_rules.BUCKETS for h in hashes] + [signed(pair(a, b)) % quality_rules.BUCKETS for a, b in zip(hashes, hashes[1:])]


def test_quality_rules_by_brute_force(spark, awkward, texts):
    got = rows_of(queries.registry()["op2_quality_rules"](spark, awkward))
    labels = defaultdict(list)
    for r in spark.read.parquet(f"{awkward}/labels.parquet").where("doc_id is not null").collect():
        labels[r["doc_id"]].append(r["quality"])
    grams = [gram_buckets(t) for t in texts]
    corpus, target = Counter(), Counter()
    for k, found in enumerate(grams):
        corpus.update(found)
        if labels.get(k) and min(labels[k]) == 1:
            target.update(found)
    share = target.total() / corpus.total()
    weight = lambda b: np.float32(math.log((target[b] + quality_rules.PRIOR) / (corpus[b] * share + quality_rules.PRIOR)))
    for row, text, found in zip(got, texts, grams, strict=True):
        want = base_rules(text)
        assert {k: row[k] for k in want} == want, text[:50] if text else text
        score = sum(float(weight(b)) for b in found) / max(1, len(found))
        assert row["llr"] == pytest.approx(score, abs=1e-9)
        assert row["kept"] == (not want["base_failed"] and score >= quality_rules.THRESHOLD)


def test_rules_stay_fast_under_a_filter(spark):
    """A filter on a result must not be pushed below the lists that it is made from."""
    df = spark.createDataFrame([(1, "a b c d e " * 2000)], "doc_id long, text string")
    out = quality_rules.with_base_rules(df).where("n_repeat_words > 10 AND n_dup_lines = 0 AND base_failed")
    assert out.select("n_repeat_words").collect()[0][0] == 10000


def spot_set(text):
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    anchors = set(spotsigs.ANCHORS)
    content = [k for k, w in enumerate(words) if w not in anchors]
    out = set()
    for k, w in enumerate(words):
        after = [words[c] for c in content if c > k][: spotsigs.CHAIN]
        if w in anchors and after:
            out.add((w, *after, *[""] * (spotsigs.CHAIN - len(after))))
    return out or {("", *words)}


def test_spotsigs_by_brute_force(spark, awkward, texts):
    got = rows_of(queries.registry()["op3_spotsigs"](spark, awkward))
    plain = [t or "" for t in texts]
    for k, (row, text) in enumerate(zip(got, plain, strict=True)):
        after = plain[(k + 1) % len(plain)]
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        assert row["n_chars"] == len(text) and row["edited_sha256"] == sha(edited)
        a, b, c = spot_set(text), spot_set(edited), spot_set(after)
        assert len(row["fingerprint"]) == 8 * len(a)
        assert row["near_edited"] == pytest.approx(len(a & b) / len(a | b))
        assert row["near_next"] == pytest.approx(len(a & c) / len(a | c))
    by_text = defaultdict(set)
    for row, text in zip(got, plain):
        by_text[text].add(row["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())


def test_spotsigs_repeated_rows_and_pairs(spark):
    text = "the river runs to the sea and the boats wait in the harbour for a storm of the century with no wind at the shore"
    rows = [(1, text), (1, text), (2, text + " the end"), (3, text), (None, text), (4, "of other words the text is made by nobody")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert spotsigs.with_edited(df).count() == 6
    pairs, members = spotsigs.near_pairs(df, threshold=0.7)
    assert {(r["a"], r["b"]) for r in pairs.collect()} == {(1, 2)}
    assert {(r["doc_id"], r["representative"]) for r in members.collect()} == {(1, 1), (2, 2), (3, 1), (4, 4)}


def brute_components(texts, n, percent):
    sets = []
    for t in texts:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set())
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [(len(s), find(k)) for k, s in enumerate(sets)]


def test_jaccard_by_brute_force(spark, awkward, texts):
    got = rows_of(queries.registry()["op9_ngram_jaccard"](spark, awkward))
    assert [(r["n_shingles"], r["component_id"]) for r in got] == brute_components(texts, 3, 90)


def test_jaccard_chain_of_near_copies(spark):
    """A chain whose ends do not link, copies around a base that is missing, and pairs that only meet beyond their centre."""
    base = [f"w{k}" for k in range(150)]
    texts = []
    for step in range(12):
        words = list(base)
        for k in range(step):
            words[10 * k] = f"v{k}"
        texts += [" ".join(words), " ".join(words)]
    for k in range(10):
        words = [*base]
        words[3 + 12 * k] = f"x{k}"
        words[7 + 12 * k] = f"y{k % 3}"
        texts.append(" ".join(words))
    texts += ["a b", "A B", "a b c", None, ""]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    for n, percent in ((3, 90), (5, 80), (1, 95)):
        got = rows_of(jaccard.near_duplicates(df, n=n, percent=percent))
        assert [(r["n_shingles"], r["component_id"]) for r in got] == brute_components(texts, n, percent)


@pytest.mark.parametrize("n", [3, 5])
def test_ngram_sets_of_short_blocks(n):
    for count in range(n + 1):
        sets = jaccard.ngram_sets([" ".join("abcde"[:count])], n)
        assert [len(s) for s in sets] == [min(count, 1)]


def test_jaccard_null_and_repeated_ids(spark):
    text = "some words that are long enough to have shingles"
    df = spark.createDataFrame([(5, text), (5, text), (7, text), (None, text), (None, None)], "doc_id long, text string")
    got = sorted(((r["doc_id"] or -1), (r["component_id"] or -1)) for r in jaccard.near_duplicates(df, n=3).collect())
    assert got == [(-1, -1), (-1, -1), (5, 5), (5, 5), (7, 5)]


def test_jaccard_one_id_with_two_texts(spark):
    """Every text is linked by itself, in whatever order the rows come."""
    a = " ".join(f"a{k}" for k in range(40))
    b = " ".join(f"b{k}" for k in range(40))
    near = b.replace("b39", "c39")
    rows = [(5, a), (5, b), (7, near), (8, a), (9, "x y z w v u t"), (9, "x y z w v u t"), (9, None), (None, b), (None, "only without an id at all")]
    for order in (rows, rows[::-1], rows[3:] + rows[:3]):
        df = spark.createDataFrame(order, "doc_id long, text string").repartition(3)
        got = {(r["doc_id"], r["component_id"]) for r in jaccard.near_duplicates(df).collect()}
        assert got == {(5, 5), (7, 5), (8, 5), (9, 9), (None, None)}
        kept = sorted((r["doc_id"] or 0, r["text"] or "") for r in jaccard.one_of_each(df.withColumn("own", F.lit(1))).collect())
        assert kept == sorted([(5, a), (5, b), (9, "x y z w v u t"), (9, ""), (0, b), (0, "only without an id at all")])


def test_components_of_long_paths(spark):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (101, 102), (7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    found = {r["node"]: r["component"] for r in graph.components(df).collect()}
    assert found == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100}
    assert graph.components(df.where("a > 1000")).count() == 0


def test_classifier_learns_and_holds_out(spark, awkward, texts):
    got = rows_of(queries.registry()["op10_quality_classifier"](spark, awkward))
    assert [r["doc_id"] for r in got] == list(range(len(texts)))
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_classifier_accuracy_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    scores = queries.registry()["op10_quality_classifier"](spark, folder).where("held_out")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = scores.join(labels, "doc_id").select("predicted", "quality").collect()
    assert len(rows) > 50 and sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.95


def test_classifier_is_repeatable_and_takes_one_class():
    words = classifier.Block(["good words here", "junk!! junk!!"], code_points=True)
    owner, bucket = classifier.features(words, 64)
    counts = [np.unique(bucket[owner == k], return_counts=True) for k in (0, 1)]
    one = classifier.fit(counts, np.array([1, 0]), 64)
    assert (one.weights == classifier.fit(counts, np.array([1, 0]), 64).weights).all()
    good, junk = one.scores(["good words", "junk!!"])
    assert good > junk
    assert classifier.fit([], np.zeros(0, int), 64).scores([None, "x"]).tolist() == [0.5, 0.5]


def test_classifier_scores_a_text_alike_wherever_it_stands():
    model = classifier.Model(np.random.default_rng(3).uniform(-9, 9, 1 << 16).astype(np.float32), 0.1)
    texts = ["hello there", "", None, "a", "\n", " b", "été \U0001f600", "the end\n"]
    alone = [model.scores([t])[0] for t in texts]
    assert alone[1] == alone[2] == alone[4] == 1 / (1 + np.exp(-0.1))
    for before in texts:
        for text, score in zip(texts, alone):
            assert model.scores([before, text])[1] == score and model.scores([text, before])[0] == score
    owner, _ = classifier.features(classifier.Block(["", "ab c", ""], code_points=True), 64)
    assert owner.tolist() == [1] * 7  # two words, their pair, and the windows "\nab", "ab ", " c\n", "\nab "


@pytest.mark.parametrize("name", ["op1_bpe", "op2_quality_rules", "op3_spotsigs", "op9_ngram_jaccard", "op10_quality_classifier"])
def test_empty_tables(spark, empty, name):
    assert queries.registry()[name](spark, empty).count() == 0


def test_deduplication_shuffles_texts_once_per_list(spark, capsys):
    """With lists too long to broadcast: one join for what goes and what is repeated, one for the repeated rows."""
    near = " ".join(f"w{k}" for k in range(60))
    texts = [(1, near), (2, near + " x"), (3, "other words of a text of its own"), (3, "other words of a text of its own"), (2, near + " x"), (4, None)]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        found = jaccard.one_of_each(df)
        found.explain()
        assert capsys.readouterr().out.count("SortMergeJoin") == 2
        assert sorted(tuple(r) for r in found.collect()) == sorted({texts[0], texts[2], texts[5]})
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_deduplication_shuffles_only_listed_texts(spark, tmp_path, monkeypatch):
    """With lists too long to broadcast, no join of the candidates or of the result shuffles the texts of other ids."""
    near = " ".join(f"w{k}" for k in range(60))
    rows = [(k, " ".join(f"d{k}x{i}" for i in range(60))) for k in range(3000)] + [(5000, near), (5001, near + " x"), (None, near)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    splits = []
    real = sieve.split

    def split(*args):
        splits.append(real(*args))
        return splits[-1]

    monkeypatch.setattr(jaccard.sieve, "split", split)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert jaccard.one_of_each(df).count() == 3002
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert len(splits) == 2  # the candidates and the result
    # Texts as short as these are ruled out by their first fragment in three of four cases only.
    for (likely, others), most in zip(splits, (1500, 30)):
        assert likely.count() + others.count() == 3003 and likely.count() < most


@pytest.mark.parametrize("bits", [sieve.LEAST, 1 << 17])
def test_sieve_loses_no_listed_row(spark, monkeypatch, bits):
    monkeypatch.setattr(sieve, "_bits", lambda keys: bits)
    df = spark.range(20000).select(F.when(F.col("id") % 1000 != 7, F.concat(F.lit("k"), "id")).alias("key"), F.col("id").alias("own"))
    keys = df.where("own % 7 = 0").select("key")
    likely, others = sieve.split(df, keys, "key")
    assert likely.columns == others.columns == df.columns
    assert likely.where("own % 7 = 0 AND key IS NOT NULL").count() == keys.where("key IS NOT NULL").count()
    assert others.where("key IS NULL").count() == 20
    assert likely.count() + others.count() == 20000
    assert likely.count() < keys.count() * (1.7 if bits == sieve.LEAST else 1.2)
    none, rest = sieve.split(df, keys.where("false"), "key")
    assert (none.count(), rest.count()) == (0, 20000)
