"""Packing against the library's ids, the bound on sequences and a plain best fit."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossmetrics.llm import bpe, packing, queries
from lossmetrics.llm.tables import written


def check_places(rows, capacity=2048):
    """Places of a sequence are gapless and no longer than it; how many sequences there are."""
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and 0 < length <= capacity
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_query_on_awkward_rows(spark, awkward, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path())
    rows = queries.registry()["op12_packing"](spark, awkward).collect()
    found = defaultdict(dict)
    for r in rows:
        assert r["piece"] not in found[r["doc_id"]]
        found[r["doc_id"]][r["piece"]] = r
    assert set(found) == set(range(len(texts)))
    for k, text in enumerate(texts):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        assert sorted(found[k]) == list(range(-(-len(ids) // 2048)))
        for n, r in found[k].items():
            piece = ids[2048 * n : 2048 * (n + 1)]
            assert (r["start"], r["length"]) == (2048 * n, len(piece))
            assert r["ids_crc32"] == zlib.crc32(np.array(piece, "<u4").tobytes())
    total = sum(r["length"] for r in rows)
    assert check_places(rows) <= -(-total // 2048) + 1


def test_empty(spark, empty):
    assert queries.registry()["op12_packing"](spark, empty).count() == 0


def plain_best_fit(lengths, capacity, most):
    """Open sequences searched one by one; of equal ones the one that was last put back."""
    open_, closed = [], []

    def take(free):
        return open_.pop(max(k for k, s in enumerate(open_) if capacity - sum(s) == free))

    for x in lengths:
        fits = [capacity - sum(s) for s in open_ if capacity - sum(s) >= x]
        best = [*(take(min(fits)) if fits else []), x]
        (closed if sum(best) == capacity else open_).append(best)
        if len(open_) > most:
            closed.append(take(min(capacity - sum(s) for s in open_)))
    return sorted(map(sorted, closed)), sorted(map(sorted, open_))


@pytest.mark.parametrize("most", [1, 3, 50])
def test_bit_set_is_best_fit(most):
    rng = random.Random(most)
    lengths = [rng.randint(1, 40) for _ in range(400)]
    held = packing.OpenSequences(40, most)
    closed = []
    for n, x in enumerate(lengths):
        rows = held.put((n, x), x)
        if rows is not None:
            closed.append(sorted(r[1] for r in rows))
        assert held.count <= most
    left = sorted(sorted(r[1] for r in rows) for _, rows in held.rest())
    assert (sorted(closed), left) == plain_best_fit(lengths, 40, most)


def test_rounds_keep_every_piece(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES", 40)
    monkeypatch.setattr(packing, "_ROWS", 7)
    rng = random.Random(1)
    rows = [(k if k % 50 else None, "own", rng.choice([1, 2, 30, 51, 70, 100])) for k in range(900)]
    df = written(spark.createDataFrame(rows, "doc_id long, extra string, length long").repartition(9), "test")
    got = packing.pack(df, capacity=100, most=5).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["extra"], r["length"]) for r in got) == sorted((a is None, a or 0, b, c) for a, b, c in rows)
    used, least = check_places(got, 100), -(-sum(r[2] for r in rows) // 100)
    one_each = sum(r[2] in (70, 100, 51) for r in rows)
    assert used <= max(least, one_each) * 1.1 + 1


def test_sequences_hold_the_tokens(spark):
    texts = [(1, "hello world"), (2, None), (2, "a b c " * 900), (None, "hello")]
    df = spark.createDataFrame(texts, "key long, body string").withColumn("length", F.lit("own"))
    cut = packing.pieces(df, queries.tokenizer_path(), capacity=64, doc_id="key", text="body", keep_ids=True)
    packed = packing.pack(written(cut, "test"), capacity=64)
    sequences = {r["sequence_id"]: r for r in packing.token_sequences(packed).collect()}
    for r in packed.collect():
        own = sequences[r["sequence_id"]]["ids"][r["offset"] : r["offset"] + r["length"]]
        assert own == r["ids"] and zlib.crc32(np.array(own, "<u4").tobytes()) == r["ids_crc32"]
    assert sum(len(s["ids"]) for s in sequences.values()) == 2 + 1 + 1 + 2700 + 1 + 1 + 1
    assert all(s["starts"][0] == 0 for s in sequences.values())


def test_facts_of_pairs_are_kept_by_token():
    """What fits before a token is found at the token, without a pair made for each look, and outlives a task."""
    with open(queries.tokenizer_path(), encoding="utf-8") as file:
        vocabulary = bpe.Vocabulary(file.read())
    words = ["walking", "walked", "talkings", "unwalkable", "zzzxqj", "straße", "x" * 200]
    found = vocabulary.encode_words(words)
    facts = {b: dict(before) for b, before in vocabulary._fits.items() if before}
    assert facts and sum(map(len, facts.values())) == vocabulary._facts
    vocabulary.store()
    assert not vocabulary._fits and vocabulary._facts == 0
    vocabulary.restore()
    assert {b: before for b, before in vocabulary._fits.items() if before} == facts
    assert vocabulary.encode_words(words) == found
    vocabulary._clear_fits()
    assert vocabulary.encode_words(words) == found and vocabulary._facts == sum(map(len, vocabulary._fits.values()))
