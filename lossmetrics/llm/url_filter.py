"""URL filter: rules by host and path, and a logistic regression on hashed character n-grams for the rest.

The model is trained in numpy from a small labelled table of hosts and paths, a parameter whose size does not depend on the
data; what every task gets is one weight per bucket. Judging is map-only: each url is read once, in Arrow batches.

Defined cases: a null url and one without "://" have an empty host and path, fit no rule and get the verdict of the bias
(allow); repeated rows are judged alike; of rules of equal length the blocking one wins; an empty table gives an empty table;
columns named like a result are replaced.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from lossmetrics.llm.batches import assemble, with_fields

BUCKETS = 1 << 16
SIZES = (3, 4, 5)

# Words of unwanted hosts by kind, words of ordinary hosts, and words that go with either.
UNWANTED = {
    "gambling": ("casino", "poker", "roulette", "blackjack", "jackpot", "slots", "betting", "bookmaker", "lottery", "bingo", "wager", "bets"),
    "pharmacy": ("pills", "viagra", "cialis", "pharmacy", "meds", "tablets", "steroids", "tramadol", "slimming", "dosage"),
    "adult": ("adult", "porn", "xxx", "sexy", "nude", "escorts", "webcam", "erotic", "hookup", "milf"),
    "malware": ("malware", "virus", "warez", "keygen", "cracked", "torrent", "phishing", "exploit", "botnet", "hacked"),
    "trackers": ("ads", "adserver", "tracker", "tracking", "popup", "banners", "clicks", "affiliate", "pixel", "retarget"),
    "spam": ("spam", "backlinks", "payday", "forex", "replica", "giveaway", "scam", "bulkmail", "getrich", "crypto"),
}
ORDINARY = (
    "library", "weather", "history", "garden", "museum", "science", "recipes", "council", "railway", "hospital", "teacher", "hiking",
    "letters", "orchard", "bakery", "bicycle", "camera", "carpenter", "chess", "church", "climate", "college", "cooking", "cricket",
    "dairy", "dance", "dentist", "design", "diary", "drawing", "economy", "engine", "family", "fashion", "ferry", "fishing", "flowers",
    "football", "forest", "furniture", "gallery", "geology", "grammar", "guitar", "harbour", "harvest", "health", "hotel", "island",
    "journal", "kitchen", "knitting", "language", "lawyer", "lighthouse", "magazine", "market", "maths", "meadow", "medicine", "minister",
    "mountain", "music", "nature", "news", "novel", "nursery", "opera", "painting", "parish", "pension", "physics", "pianist", "planet",
    "plumber", "poetry", "police", "pottery", "printing", "radio", "research", "river", "sailing", "school", "sculpture", "software",
    "sports", "stamps", "surgery", "tailor", "teaching", "theatre", "tourism", "transport", "travel", "university", "valley", "village",
    "vineyard", "volunteer", "walking", "wildlife", "windmill", "woodland", "workshop", "writing", "zoology",
)
EITHER = (
    "best", "big", "blue", "buy", "cheap", "city", "club", "direct", "easy", "fast", "find", "first", "free", "good", "green", "group", "guide",
    "home", "info", "land", "life", "line", "list", "live", "max", "my", "net", "new", "now", "one", "online", "plus", "point", "pro", "red",
    "shop", "site", "smart", "star", "store", "super", "the", "time", "today", "top", "web", "world", "zone",
)
NAMES_PER_WORD = 16
#: Probability from which an url is unwanted: the least, in steps of 0.05, at which at most one in forty ordinary names is blocked whose
#: word was left out of training (``left_out``).
THRESHOLD = 0.85
#: (host and path, rule's verdict) as given to the query.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)


def names() -> list[tuple[str, str, int]]:
    """(name, the word that decides, unwanted): every word alone and with words that go with either, drawn by a hash."""
    out = []
    for words, label in ((sum(UNWANTED.values(), ()), 1), (ORDINARY, 0)):
        for word in words:
            forms = [f for e in EITHER for f in (f"{e}-{word}", f"{word}-{e}", f"{e}{word}", f"{word}{e}")]
            drawn = sorted(forms, key=lambda f: zlib.crc32(f.encode()))[: NAMES_PER_WORD - 1]
            out += [(name, word, label) for name in (word, *drawn)]
    return out


def hosted(name: str, label: int) -> tuple[str, str, int]:
    """A row of the labelled table: the name under an ordinary prefix and ending with an ordinary path, drawn alike for both labels."""
    draw = zlib.crc32(b"host" + name.encode())
    prefix = ("", "www.", "blog.", "m.")[draw % 4]
    ending = ("example.com", "example.net", "example.org", "net", "com", "org", "info", "co.uk")[draw // 4 % 8]
    path = ("", "/", "/en/1820", "/fr/736.html", "/es/30594/", "/de/4851", "/index.html", "/a/b")[draw // 32 % 8]
    return f"{prefix}{name}.{ending}", path, label


def labelled() -> list[tuple[str, str, int]]:
    """The labelled table: (host, path, unwanted)."""
    return [hosted(name, label) for name, _, label in names()]


def left_out(folds: int = 5, by_word: bool = False) -> list[tuple[str, int, float]]:
    """(name, unwanted, score) of every labelled name by a model trained without it; ``by_word``: without any name of its word."""
    rows, out = names(), []
    fold = [zlib.crc32((word if by_word else name).encode()) % folds for name, word, _ in rows]
    for k in range(folds):
        model = train([hosted(name, label) for (name, _, label), f in zip(rows, fold, strict=True) if f != k])
        out += [(name, label, model.score(*hosted(name, label)[:2])) for (name, _, label), f in zip(rows, fold, strict=True) if f == k]
    return out


def _grams(host: str, path: str, buckets: int) -> list[int]:
    out = []
    for mark, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        data = text.encode("utf-8")
        out += [zlib.crc32(mark.encode() + data[k : k + n]) % buckets for n in SIZES for k in range(len(data) - n + 1)]
    return out


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, host: str, path: str) -> float:
        """Probability that a url is unwanted; the bias alone for an empty one."""
        grams = _grams(host, path, len(self.weights)) if host or path else []
        mean = self.weights[grams].sum() / np.sqrt(len(grams)) if grams else 0.0
        return float(1 / (1 + np.exp(-(self.bias + mean))))


def train(rows: list[tuple[str, str, int]], buckets: int = BUCKETS, epochs: int = 400, rate: float = 300.0, decay: float = 1e-5) -> Model:
    """Logistic regression by gradient descent over all labelled rows, kept as (row, bucket) pairs; both labels weigh alike."""
    grams = [_grams(host, path, buckets) for host, path, _ in rows]
    sizes = np.array([max(1, len(g)) for g in grams])
    at = np.repeat(np.arange(len(rows)), [len(g) for g in grams])
    bucket = np.fromiter((g for own in grams for g in own), np.int64)
    value = 1 / np.sqrt(sizes[at])
    y = np.array([r[2] for r in rows], float)
    share = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    weights, bias = np.zeros(buckets), 0.0
    for _ in range(epochs):
        sums = np.bincount(at, weights[bucket] * value, len(rows))
        error = (1 / (1 + np.exp(-(sums + bias))) - y) * share
        weights -= rate * (np.bincount(bucket, error[at] * value, buckets) + decay * weights)
        bias -= rate / 10 * float(error.sum())
    return Model(weights, bias)


def split_url(url: str) -> tuple[Column, Column]:
    """Host, with A-Z lower-cased, and path of an url column; empty where there is no "://"."""
    whole = F.coalesce(F.col(url), F.lit(""))
    rest = F.when(F.instr(whole, "://") > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return lower, F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)


def judge(pages: DataFrame, model: Model, rules: Iterable[tuple[str, str]] = RULES, url: str = "url", threshold: float = THRESHOLD) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``unwanted`` (the model's probability) and ``verdict``."""
    host, path = split_url(url)
    parts = pages.drop("host", "path", "rule", "unwanted", "verdict").withColumns({"host": host, "path": path})
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for pattern, outcome in sorted(rules, key=lambda r: (len(r[0]), r[1] == "block")):
        name, _, start = pattern.partition("/")
        own = (F.col("host") == name) | F.col("host").endswith("." + name)
        fits = own & F.col("path").startswith("/" + start)
        rule, verdict = F.when(fits, pattern).otherwise(rule), F.when(fits, outcome).otherwise(verdict)
    shared = pages.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # 8 bytes a bucket
    ruled = parts.withColumns({"rule": rule, "verdict": verdict})
    schema = with_fields(ruled, [StructField("unwanted", DoubleType(), False), StructField("verdict", StringType(), False)])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*shared.value)
        for batch in batches:
            scores = [own.score(h, p) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True)]
            final = [v or ("block" if s >= threshold else "allow") for v, s in zip(batch.column("verdict").to_pylist(), scores, strict=True)]
            yield assemble(batch, schema, {"unwanted": pa.array(scores, pa.float64()), "verdict": pa.array(final, pa.string())})

    return ruled.mapInArrow(run, schema)
