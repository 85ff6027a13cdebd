"""Perfect hashes and the divergence of sources against plain Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lossmetrics.llm import divergence, queries
from lossmetrics.llm.perfect_hash import PerfectHash

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top):
    """Rows are (lang, source, text)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    docs = defaultdict(Counter)
    counts = defaultdict(Counter)
    for lang, source, text in rows:
        terms = TERM.findall(text.translate(LOWER))
        docs[lang].update(set(terms))
        counts[lang, source].update(terms)
    out = set()
    share = lambda n, total, v: 1 + 10**9 * (n + 5) // (total + 5 * v)
    for lang in {r[0] for r in rows}:
        kept = [t for t, n in docs[lang].items() if n >= least]
        own = {s: {t: counts[g, s][t] for t in kept} for g, s in counts if g == lang}
        whole = Counter()
        for c in own.values():
            whole.update(c)
        p = {s: {t: share(c[t], sum(c.values()), len(kept)) for t in kept} for s, c in own.items()}
        q = {t: share(whole[t], sum(whole.values()), len(kept)) for t in kept}
        for s in own:
            pairs = [(sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in own if o != s]
            terms = [(p[s][t] - q[t], t) for t in kept if own[s][t] > 0 and p[s][t] > q[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                for rank, (value, item) in enumerate(sorted(found, key=lambda x: (-x[0], x[1].encode())), 1):
                    if part == "pair" or rank <= top:
                        out.add((lang, s, part, item, value, rank))
    return out


def got(df):
    rows = [(r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 20_000])
def test_perfect_hash_is_minimal_and_verified(n):
    keys = [f"key{k}".encode() for k in range(n)]
    made = PerfectHash.load(PerfectHash(keys).dump())
    assert len(made) == n
    assert sorted(made.lookup(keys).tolist()) == list(range(n))
    assert [made.keys[k] for k in made.lookup(keys)] == keys
    strangers = [f"other{k}".encode() for k in range(5000)]
    assert (made.lookup(strangers) == -1).all()
    if n >= 1000:  # strangers do reach numbers; only the stored key tells
        from lossmetrics.llm.perfect_hash import hashes

        assert (made.candidates(hashes(strangers)) >= 0).any()


def test_perfect_hash_equal_hashes_and_repeats(monkeypatch):
    from lossmetrics.llm import perfect_hash

    monkeypatch.setattr(perfect_hash, "hashes", lambda keys: np.array([len(k) for k in keys], np.uint64))
    keys = [b"a", b"b", b"cc", b"dd", b"eee"]
    made = PerfectHash.load(PerfectHash(keys).dump())
    assert sorted(made.lookup(keys).tolist()) == list(range(5))
    assert made.lookup([b"z", b"zz", b"zzz", b"zzzz"]).tolist() == [-1] * 4
    with pytest.raises(ValueError):
        PerfectHash([b"a", b"a"])


def sample(n=160):
    rng = random.Random(3)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(90)] + ["Straße", "ÉTÉ", "ñu", "it's", "a1b", "x\x85y", "y" * 90]
    rows = []
    for k in range(n):
        lang = ("en", "de", None, "fr")[k % 4 if k % 7 else 0]
        source = f"src{rng.randrange(5)}" if k % 9 else None
        rows.append((lang, source, " ".join(rng.choice(words[: 20 + 15 * (k % 6)]) for _ in range(rng.randrange(0, 60)))))
    rows += [("xx", "one", "lonely"), ("yy", "a", None), ("yy", "b", ""), ("yy", "c", "123 #"), rows[0], rows[0], ("en", "src1", "common " * 3000)]
    return rows


@pytest.mark.parametrize("head_terms", [divergence.HEAD_TERMS, 20, 0])
def test_audit_is_exact_with_and_without_the_shuffled_rest(spark, monkeypatch, head_terms):
    monkeypatch.setattr(divergence, "SHARD_TERMS", 16)
    rows = sample()
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(3)
    for name in ("term", "n", "slot", "part", "value", "p"):
        df = df.withColumn(name, F.lit("own"))
    assert got(divergence.audit(df, least=4, top=7, head_terms=head_terms)) == plain(rows, 4, 7)


def test_small_bounds_and_matrices(spark, monkeypatch):
    for name, value in (("HELD_TERMS", 10), ("HELD_SLOTS", 10), ("CELLS", 40), ("SHARD_TERMS", 8)):
        monkeypatch.setattr(divergence, name, value)
    rows = sample(60)
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert got(divergence.audit(df, least=2, top=50)) == plain(rows, 2, 50)


def test_shares_beyond_64_bits(spark):
    n, total, terms = 9 * 10**15, 9 * 10**17, 10**9
    df = spark.createDataFrame([(n, total, terms), (0, 0, 0), (0, 0, 1)], "n long, total long, terms long")
    value = [r[0] for r in df.select(divergence.share("n", "total", "terms")).collect()]
    assert value == [1 + 10**9 * (n + 5) // (total + 5 * terms), None, 1 + 10**9]


def test_registered_query(spark, awkward, empty):
    run = queries.registry()["op13_source_divergence"]
    docs = pq.read_table(f"{awkward}/documents.parquet", columns=["lang", "source", "text"]).to_pylist()
    assert got(run(spark, awkward)) == plain([tuple(d.values()) for d in docs], 30, 50)
    assert run(spark, empty).count() == 0
