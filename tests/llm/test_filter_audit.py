"""The filter audit against a replay of every order, document by document."""

import re
from itertools import permutations

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from lossmetrics.llm import filter_audit, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
KEYS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failed(rows):
    """Set of filters that each (id, text, part) fails."""
    out = []
    for doc_id, text, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        own = set()
        own |= {"A"} if len(words) < 200 else set()
        own |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        own |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 3 * len(text) else set()
        own |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        own |= {"E"} if doc_id is not None and any(o is not None and o < doc_id and (t or "") == text for o, t, _ in rows) else set()
        out.append(own)
    return out


def replay(rows, good, toxic):
    """Every order applied to every document."""
    sets = failed(rows)
    want = {}
    for part in {p or "" for _, _, p in rows}:
        docs = [(i, s) for (i, _, p), s in zip(rows, sets) if (p or "") == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = list(docs)
            for step, letter in enumerate(order, 1):
                hit = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                total[letter] += len(hit)
                all_hit = sum(letter in s for _, s in docs)
                want[part, order, step] = [
                    len(left), len(hit), all_hit - len(hit), sum(s == {letter} for _, s in docs),
                    sum(d[0] in good for d in hit), sum(d[0] in toxic for d in hit),
                ]
        for (p, order, step), row in want.items():
            if p == part:
                row.append(total[order[step - 1]])
    return want


def as_dict(df):
    rows = df.collect()
    out = {(r["part"], r["filter_order"], r["step"]): [r[k] for k in (*KEYS, "shapley")] for r in rows}
    assert len(out) == len(rows)
    return out


def test_intervals_cover_every_order_once():
    for mask in range(32):
        for step in range(1, 6):
            covered = [0] * 120
            for m, s, _, low, high, kept, removed, redundant, _ in filter_audit.rank_intervals():
                if (m, s) == (mask, step):
                    for r in range(low, high):
                        covered[r] += kept + removed + redundant
            for rank, order in enumerate(filter_audit.ORDERS):
                before, own = order[: step - 1], order[step - 1]
                hit = mask >> "ABCDE".index(own) & 1
                gone = any(mask >> "ABCDE".index(x) & 1 for x in before)
                assert covered[rank] == (1 if hit or not gone else 0)
    assert [filter_audit.lehmer_rank(o) for o in filter_audit.ORDERS] == list(range(120))


def test_query_on_awkward_rows(spark, awkward):
    docs = pq.read_table(f"{awkward}/documents.parquet", columns=["doc_id", "text", "lang"]).to_pylist()
    labels = pq.read_table(f"{awkward}/labels.parquet").to_pylist()
    rows = [(d["doc_id"], d["text"], d["lang"]) for d in docs]
    good = {x["doc_id"] for x in labels if x["quality"] == 1 and x["doc_id"] is not None}
    assert as_dict(queries.registry()["op11_filter_audit"](spark, awkward)) == replay(rows, good, set())


@pytest.mark.parametrize("clash", [False, True])
def test_null_ids_repeated_rows_and_labels(spark, clash):
    long = " ".join(f"w{k}" for k in range(210))
    rows = [
        (1, long, "en"), (1, long, "en"), (1, long, "de"), (4, long, None), (None, long, "en"), (None, "", "en"), (0, "", "xx"), (9, None, "xx"),
        (5, "A" * 10 + " #", "en"), (6, "x " * 300, "en"), (7, "A B " * 200, "en"), (8, long + " |", "en"), (3, long + "\x1c\x85", "en"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    if clash:
        for name in ("part", "mask", "digest", "first", "rows", "good", "quality"):
            df = df.withColumn(name, F.lit("own"))
    marks = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (6, 1, None), (None, 1, 1), (77, 1, 1), (7, 0, 1), (5, None, 1)], "doc_id long, quality int, toxic int")
    assert as_dict(filter_audit.audit(df, marks)) == replay(rows, {1, 6}, {1, 7, 5})


def test_empty_tables(spark, empty):
    assert queries.registry()["op11_filter_audit"](spark, empty).count() == 0


def test_no_labels(spark):
    df = spark.createDataFrame([(1, "a", "en")], "doc_id long, text string, lang string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = filter_audit.audit(df, none)
    assert got.count() == 600
    assert got.where("good_lost + toxic_lost > 0").count() == 0
    assert got.where("filter_order = 'ABCDE' and step = 1").first()["removed"] == 1
