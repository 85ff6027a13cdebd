"""Divergence of the sources of each language: how differently they use its terms, exactly counted.

1. The first pass counts in how many documents of its language each term occurs; terms in at least ``least`` documents are
   kept. Blocks are counted in the tasks, so a term of every document is one row per task.
2. Kept terms get minimal perfect hashes with stored keys, in shards of some thousand terms, built side by side. A shard
   is one language and one range of CRC-32, so that a reader finds it from the term alone.
3. The shards are broadcast. The second pass counts the distinct terms of a block, looks them up, compares the stored key and
   adds the counts to one dense array of slots per (language, source).
4. Smoothed shares are whole numbers in units of 10**-9. Terms of one group of slots, as rows of all sources, form a matrix
   whose rows are subtracted pairwise; the sums per pair of sources are then added up.

Bound of the broadcast: ``HEAD_TERMS`` terms of at most ``KEY_BYTES`` bytes, the most frequent ones by steps of document
frequency. The kept terms beyond, if there are any, are counted by a shuffled, pre-aggregated join instead, with the same
result; nothing is left out.

Defined cases: null text, language and source are ''; a language without kept terms has pairs of value 0 and no terms; a
language with one source has no pairs; repeated rows are counted each; an empty table gives an empty result; other columns are
ignored. Sums are 64-bit integers, products of counts decimals of 38 digits.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossmetrics.llm.batches import blocks
from lossmetrics.llm.perfect_hash import PerfectHash
from lossmetrics.llm.tables import written

#: Documents of its language that a kept term occurs in.
LEAST = 30
#: Ranks reported of the terms of a group.
TOP_TERMS = 50
#: Most terms in the broadcast hashes, and most bytes of such a term: 64 MB of keys at the very most.
HEAD_TERMS, KEY_BYTES = 1 << 20, 64
#: Terms of a shard, on average.
SHARD_TERMS = 1 << 14
#: Distinct terms counted in a task, and slots of its dense arrays, before the counts are handed on.
HELD_TERMS, HELD_SLOTS = 400_000, 4 << 20
#: Cells of one matrix of sources and terms.
CELLS = 1 << 15
_TO_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Terms of a UTF-8 text: runs of letters A to Z, lower-cased, and of symbols beyond ASCII."""
    return text.translate(_TO_TERMS).split()


def _texts(docs: DataFrame, lang: str, source: str, text: str) -> DataFrame:
    plain = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    return docs.select(plain(lang, "lang"), plain(source, "source"), plain(text, "text"))


def _rows(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) if t != pa.string() else pa.array(v, pa.binary()).cast(t) for v, t in columns.values()], list(columns))


def document_frequencies(texts: DataFrame) -> DataFrame:
    """(lang, term, docs): exact number of documents of each language that a term occurs in."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = defaultdict(Counter)

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, count in held.items():
                yield _rows({"lang": ([lang.encode()] * len(count), pa.string()), "term": (list(count), pa.string()), "docs": (list(count.values()), pa.int64())})
            held.clear()

        for block in blocks(batches, "text"):
            for lang, text in zip(block.column("lang").to_pylist(), block.column("text").cast(pa.binary()).to_pylist()):
                held[lang].update(set(terms_of(text)))
            if sum(map(len, held.values())) > HELD_TERMS:
                yield from flush()
        yield from flush()

    return texts.mapInArrow(run, "lang string, term string, docs long").groupBy("lang", "term").agg(F.sum("docs").alias("docs"))


def kept_terms(texts: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, term, docs) of the terms that at least ``least`` documents of the language hold, as a written table."""
    return written(document_frequencies(texts).where(F.col("docs") >= least), "terms")


def _head(kept: DataFrame, head_terms: int) -> Column:
    """Whether a kept term is among those that are broadcast: short, and frequent enough that no more than ``head_terms`` are."""
    short = F.octet_length("term") <= KEY_BYTES
    step = F.floor(F.log2("docs") * 8).cast("int")
    steps = kept.where(short).groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect()  # at most 8 x 63 rows
    lowest, total = 1 << 30, 0
    for s, n in steps:
        total += n
        if total > head_terms:
            break
        lowest = s
    return short & (step >= lowest)


def shards(head: DataFrame) -> DataFrame:
    """(lang, shard, shards, n, data): one minimal perfect hash per shard of the terms of each language."""
    per_lang = head.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / SHARD_TERMS).cast("int").alias("shards"))
    dealt = head.join(per_lang, "lang").select("lang", "shards", "term", F.pmod(F.crc32("term"), F.col("shards")).cast("int").alias("shard"))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        made = PerfectHash([t.encode() for t in rows["term"].sort_values()])
        first = rows.iloc[0]
        return pd.DataFrame({"lang": [first["lang"]], "shard": [first["shard"]], "shards": [first["shards"]], "n": [len(made)], "data": [made.dump()]})

    return dealt.groupBy("lang", "shard").applyInPandas(build, "lang string, shard int, shards int, n int, data binary")


class Slots:
    """The perfect hashes of all shards; a term's slot is its number in its shard plus the shard's start within the language."""

    def __init__(self, rows: list[tuple[str, int, int, int, bytes]]):
        self.parts: dict[str, list[PerfectHash]] = {}
        self.starts: dict[str, np.ndarray] = {}
        none = PerfectHash([])
        for lang in sorted({r[0] for r in rows}):
            own = {r[1]: r for r in rows if r[0] == lang}
            count = next(iter(own.values()))[2]
            self.parts[lang] = [PerfectHash.load(own[k][4]) if k in own else none for k in range(count)]
            self.starts[lang] = np.cumsum([0] + [len(p) for p in self.parts[lang]])

    def size(self, lang: str) -> int:
        return int(self.starts[lang][-1]) if lang in self.starts else 0

    def find(self, lang: str, terms: list[bytes]) -> np.ndarray:
        """Slot of every term, -1 for a term that has none."""
        out = np.full(len(terms), -1, np.int64)
        parts = self.parts.get(lang)
        if not parts or not terms:
            return out
        shard = np.fromiter(map(zlib.crc32, terms), np.int64, len(terms)) % len(parts)
        order = np.argsort(shard, kind="stable")
        ends = np.cumsum(np.bincount(shard, minlength=len(parts)))
        for k, part in enumerate(parts):
            own = order[ends[k - 1] if k else 0 : ends[k]]
            if len(own) and len(part):
                number = part.lookup([terms[j] for j in own])
                out[own] = np.where(number >= 0, number + self.starts[lang][k], -1)
        return out

    def table(self) -> Iterator[tuple[str, int, bytes]]:
        for lang, parts in self.parts.items():
            for start, part in zip(self.starts[lang], parts):
                for k, term in enumerate(part.keys):
                    yield lang, int(start) + k, term


_loaded: dict[int, Slots] = {}


def _slots(broadcast) -> Slots:
    """One set of hashes per Python worker and broadcast."""
    if broadcast.id not in _loaded:
        _loaded.clear()
        _loaded[broadcast.id] = Slots(broadcast.value)
    return _loaded[broadcast.id]


class _Sent:
    """A broadcast with a name that workers can tell it by."""

    def __init__(self, spark, rows):
        self._sent = spark.sparkContext.broadcast(rows)
        self.id = hash(tuple(zlib.crc32(r[4]) for r in rows))

    @property
    def value(self):
        return self._sent.value


def recount(texts: DataFrame, sent: _Sent, with_rest: bool) -> DataFrame:
    """(lang, source, slot, term, n): occurrences per group, by slot; terms without a slot by name, if ``with_rest``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = _slots(sent)
        dense: dict[tuple[str, str], np.ndarray] = {}
        rest: dict[tuple[str, str], Counter] = defaultdict(Counter)

        def rows(group: tuple[str, str], slot: list, term: list, n: list) -> pa.RecordBatch:
            names = [[g.encode()] * len(n) for g in group]
            return _rows({"lang": (names[0], pa.string()), "source": (names[1], pa.string()), "slot": (slot, pa.int64()), "term": (term, pa.string()), "n": (n, pa.int64())})

        def flush() -> Iterator[pa.RecordBatch]:
            for group, counts in dense.items():
                hit = np.flatnonzero(counts)
                yield rows(group, hit.tolist(), [None] * len(hit), counts[hit].tolist())
            for group, count in rest.items():
                yield rows(group, [None] * len(count), list(count), list(count.values()))
            dense.clear()
            rest.clear()

        for block in blocks(batches, "text"):
            found: dict[tuple[str, str], list[bytes]] = defaultdict(list)
            for lang, source, text in zip(block.column("lang").to_pylist(), block.column("source").to_pylist(), block.column("text").cast(pa.binary()).to_pylist()):
                found[lang, source].append(text)
            for group, own in found.items():
                count = Counter(terms_of(b" ".join(own)))
                terms, n = list(count), np.fromiter(count.values(), np.int64, len(count))
                slot = slots.find(group[0], terms)
                if group not in dense:
                    dense[group] = np.zeros(slots.size(group[0]), np.int64)
                hit = slot >= 0
                dense[group][slot[hit]] += n[hit]  # a slot is one term, so no slot comes twice
                if with_rest:
                    for k in np.flatnonzero(~hit):
                        rest[group][terms[k]] += int(n[k])
            if sum(map(len, dense.values())) > HELD_SLOTS or sum(map(len, rest.values())) > HELD_TERMS:
                yield from flush()
        yield from flush()

    return texts.mapInArrow(run, "lang string, source string, slot long, term string, n long")


def counts(texts: DataFrame, kept: DataFrame, head_terms: int = HEAD_TERMS) -> DataFrame:
    """(lang, source, term, n): occurrences of the kept terms in every group that has them, as a written table."""
    spark = texts.sparkSession
    is_head = _head(kept, head_terms)
    built = written(shards(kept.where(is_head)), "hashes")
    tail = kept.where(~F.coalesce(is_head, F.lit(False)))
    with_rest = not tail.isEmpty()
    rows = [tuple(r) for r in built.select("lang", "shard", "shards", "n", "data").orderBy("lang", "shard").collect()]  # bounded by HEAD_TERMS and KEY_BYTES
    sent = _Sent(spark, [(lang, shard, count, n, bytes(data)) for lang, shard, count, n, data in rows])
    found = recount(texts, sent, with_rest).groupBy("lang", "source", "slot", "term").agg(F.sum("n").alias("n"))
    found = written(found, "counts") if with_rest else found
    starts = built.select("lang", "shard", F.sum("n").over(Window.partitionBy("lang").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)).alias("start"))

    def names(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, start, data in zip(*(batch.column(c).to_pylist() for c in ("lang", "start", "data"))):
                keys = PerfectHash.load(data).keys
                yield _rows({"lang": ([lang.encode()] * len(keys), pa.string()), "slot": (list(range(start or 0, (start or 0) + len(keys))), pa.int64()), "term": (keys, pa.string())})

    named = built.join(starts, ["lang", "shard"]).select("lang", "start", "data").mapInArrow(names, "lang string, slot long, term string")
    out = found.where("slot is not null").drop("term").join(named, ["lang", "slot"]).select("lang", "source", "term", "n")
    if with_rest:
        out = out.union(found.where("slot is null").join(tail.select("lang", "term"), ["lang", "term"], "left_semi").select("lang", "source", "term", "n"))
    return written(out, "group-counts")


def share(n: str, total: str, terms: str) -> Column:
    """1 + floor(10**9 * (n + 5) / (total + 5 * terms)), exactly; null without terms."""
    wide = lambda e: f"cast({e} as decimal(20, 0))"
    above = f"cast(1000000000 as decimal(10, 0)) * ({wide(n)} + 5)"
    below = f"({wide(total)} + 5 * {wide(terms)})"
    return F.when(F.expr(f"{below} > 0"), 1 + F.expr(f"cast({above} as decimal(38, 0)) div cast({below} as decimal(38, 0))"))


def groups(texts: DataFrame, kept: DataFrame, counted: DataFrame) -> DataFrame:
    """(lang, source, place, sources, terms, total, rare) of every group: its number in the language, the kept terms, their occurrences and the share of a term it lacks."""
    all_groups = texts.select("lang", "source").distinct()
    totals = counted.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    known = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    in_lang = Window.partitionBy("lang")
    found = all_groups.join(totals, ["lang", "source"], "left").join(known, "lang", "left").select(
        "lang", "source",
        (F.row_number().over(in_lang.orderBy("source")) - 1).alias("place"),
        F.count(F.lit(1)).over(in_lang).cast("int").alias("sources"),
        F.coalesce("terms", F.lit(0)).alias("terms"),
        F.coalesce("total", F.lit(0)).alias("total"),
    )
    return written(found.withColumn("rare", share("0", "total", "terms")), "groups")


def pair_values(counted: DataFrame, group: DataFrame) -> DataFrame:
    """(lang, source, item, value): sum of the differences of shares over all kept terms, for every two sources of a language."""
    # As many matrices as keep each near CELLS cells, or near the size of the result where there are very many sources.
    cells = F.greatest(F.lit(CELLS), F.col("sources") * F.col("sources"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("terms") * F.col("sources") / cells)).cast("int")
    sized = group.withColumn("parts", parts)
    heads = sized.select("lang", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "place", "sources", F.lit(None).cast("string").alias("term"), F.col("rare").alias("p"))
    joined = counted.join(sized, ["lang", "source"])
    cellrows = joined.select("lang", F.pmod(F.xxhash64("term"), F.col("parts")).cast("int").alias("part"), "place", "sources", "term", share("n", "total", "terms").alias("p"))

    def differences(rows: pd.DataFrame) -> pd.DataFrame:
        head = rows["term"].isna().to_numpy()
        size = int(rows["sources"].iloc[0])
        place = rows["place"].to_numpy(np.int64)
        rare = np.zeros(size, np.int64)
        rare[place[head]] = rows["p"][head].fillna(0).astype("int64")
        term, names = pd.factorize(rows["term"][~head])
        matrix = np.repeat(rare[:, None], len(names), axis=1)
        matrix[place[~head], term] = rows["p"][~head].astype("int64")
        a, b = np.triu_indices(size, 1)
        value = [np.abs(matrix[k + 1 :] - matrix[k]).sum(axis=1) for k in range(size - 1)]
        value = np.concatenate(value) if value else np.zeros(0, np.int64)
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "a": a.astype(np.int32), "b": b.astype(np.int32), "value": value})

    sums = heads.unionByName(cellrows).groupBy("lang", "part").applyInPandas(differences, "lang string, a int, b int, value long")
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    both = sums.union(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    name = lambda place, new: group.select("lang", F.col("place").alias(place), F.col("source").alias(new))
    return both.join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"]).select("lang", "source", "item", "value")


def term_values(counted: DataFrame, group: DataFrame) -> DataFrame:
    """(lang, source, item, value): kept terms that a group uses more than its language does, with the difference of the shares."""
    per_lang = group.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    whole = counted.groupBy("lang", "term").agg(F.sum("n").alias("lang_n")).join(per_lang, "lang")
    found = counted.join(whole, ["lang", "term"]).join(group, ["lang", "source"])
    found = found.select("lang", "source", F.col("term").alias("item"), share("n", "total", "terms").alias("p"), share("lang_n", "lang_total", "terms").alias("q"))
    return found.where("p > q").select("lang", "source", "item", (F.col("p") - F.col("q")).alias("value"))


def audit(docs: DataFrame, least: int = LEAST, top: int = TOP_TERMS, head_terms: int = HEAD_TERMS, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): all pairs of sources, and the terms that set a source apart up to rank ``top``."""
    texts = _texts(docs, lang, source, text)
    kept = kept_terms(texts, least)
    counted = counts(texts, kept, head_terms)
    group = groups(texts, kept, counted)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    return ranked(pair_values(counted, group), "pair").union(ranked(term_values(counted, group), "term").where(F.col("rank") <= top))
