"""Isolation-forest anomalies: features, trees, scores, explanations and summaries.

Tree t is grown from at most 256 claims chosen by hash, in its own task. The forest (200 trees of at most 511 nodes) is a
few megabytes whatever the data size, so it is broadcast and claims are scored where they lie.
"""

from __future__ import annotations

import itertools
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from lossmetrics import config
from lossmetrics.functions.columns import month_of
from lossmetrics.functions.distributions import quantiles, stacked_counts
from lossmetrics.plans.warehouse import write_table
from lossmetrics.session import shared_dir

FEATURES = ["log_paid_amount", "days_to_close", "days_to_report", "severity_level", "litigation_flag"]
SAMPLE = 256
TREES = 200


def _median_of(feature: str, n: Column) -> Column:
    """Median of one feature from stacked value counts."""
    return F.percentile(F.col("value"), F.lit(0.5), F.when(F.col("feature") == feature, n).otherwise(0))


def medians(claims: DataFrame) -> DataFrame:
    """One row with the median of every feature; 0 where a feature has no value."""
    log_paid = F.log1p(F.greatest(F.col("paid_amount"), F.lit(0.0)))
    out = quantiles(claims, F.when(F.col("paid_amount").isNotNull(), log_paid), {"log_paid_amount": 0.5})
    counts = stacked_counts(claims, FEATURES[1:])
    others = counts.groupBy().agg(*[_median_of(c, F.col("n")).alias(c) for c in FEATURES[1:]])
    out = out.crossJoin(F.broadcast(others))  # one row each
    return out.select(*[F.coalesce(c, F.lit(0.0)).alias(f"_{c}") for c in FEATURES])


def features(claims: DataFrame, known: Row | None = None) -> DataFrame:
    """Claims with the five features as ``x_*``, missing values replaced by the median.

    ``known`` is the row of ``medians`` if it has been read already; then the claims are not scanned for it again.
    """
    log_paid = F.when(F.col("paid_amount").isNotNull(), F.log1p(F.greatest(F.col("paid_amount"), F.lit(0.0))))
    values = {"log_paid_amount": log_paid} | {c: F.col(c).cast("double") for c in FEATURES[1:]}
    joined = claims.crossJoin(F.broadcast(medians(claims))) if known is None else claims
    middle = {c: F.col(f"_{c}") if known is None else F.lit(known[f"_{c}"]) for c in FEATURES}
    return joined.select(*claims.columns, *[F.coalesce(values[c], middle[c]).alias(f"x_{c}") for c in FEATURES])


def standardised(featured: DataFrame) -> DataFrame:
    """Claim id and features scaled to mean 0 and population deviation 1 (a constant feature stays 0)."""
    stats = featured.agg(
        *[F.avg(f"x_{c}").alias(f"m_{c}") for c in FEATURES], *[F.stddev_pop(f"x_{c}").alias(f"s_{c}") for c in FEATURES]
    )
    scaled = [
        F.coalesce(F.try_divide(F.col(f"x_{c}") - F.col(f"m_{c}"), F.col(f"s_{c}")), F.lit(0.0)).alias(c) for c in FEATURES
    ]
    return featured.crossJoin(F.broadcast(stats)).select("claim_id", *scaled)


def tree_samples(featured: DataFrame, trees: int = TREES, size: int = SAMPLE, seed: int = config.SEED) -> DataFrame:
    """At most ``size`` claims per tree, chosen by hashes of the claim id.

    A first cut keeps about one and a half times the rows that are needed, so a table of any size sends only some
    77,000 rows to the trees. In a small table every claim goes to several trees.
    """
    count = featured.count()
    copies = min(trees, max(1, math.ceil(1.5 * trees * size / max(count, 1))))
    share = min(1.0, 1.5 * trees * size / max(count * copies, 1))
    spread = F.xxhash64(F.lit(seed), "claim_id")
    picked = featured.where(F.pmod(spread, F.lit(1_000_000_007)) < F.lit(math.ceil(share * 1_000_000_007)))
    x = [f"x_{c}" for c in FEATURES]
    first = F.pmod(F.xxhash64(F.lit(seed + 1), "claim_id"), F.lit(trees))
    dealt = picked.select("claim_id", *x, first.alias("first"), F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("k"))
    placed = dealt.withColumn("tree", ((F.col("first") + F.col("k")) % trees).cast("int"))
    order = Window.partitionBy("tree").orderBy(F.xxhash64(F.lit(seed), "tree", "claim_id"), "claim_id")
    return placed.withColumn("r", F.row_number().over(order)).where(F.col("r") <= size).select("tree", "r", *x)


TREE_SCHEMA = (
    "tree int, feature array<int>, threshold array<double>, left array<int>, right array<int>, depth array<int>, size array<int>"
)


def grow(samples: DataFrame, size: int = SAMPLE, seed: int = config.SEED) -> DataFrame:
    """One isolation tree per group of samples, as node arrays (feature -1 marks a leaf)."""
    width = len(FEATURES)

    def build(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("r")
        tree = int(frame["tree"].iloc[0])
        x = frame[[f"x_{c}" for c in FEATURES]].to_numpy(dtype=float)
        rng = np.random.default_rng([seed, tree])
        limit = max(1, math.ceil(math.log2(max(size, 2))))
        nodes: list[list] = []
        todo = [(np.arange(len(x)), 0, None, None)]
        while todo:
            rows, depth, parent, side = todo.pop()
            node = len(nodes)
            nodes.append([-1, 0.0, -1, -1, depth, len(rows)])
            if parent is not None:
                nodes[parent][side] = node
            part = x[rows]
            low, high = part.min(axis=0), part.max(axis=0)
            open_features = np.flatnonzero(high > low)
            if depth >= limit or len(rows) <= 1 or not len(open_features):
                continue
            f = int(open_features[rng.integers(len(open_features))]) if len(open_features) < width else int(rng.integers(width))
            cut = float(rng.uniform(low[f], high[f]))
            goes_left = part[:, f] <= cut
            nodes[node][0], nodes[node][1] = f, cut
            todo.append((rows[~goes_left], depth + 1, node, 3))
            todo.append((rows[goes_left], depth + 1, node, 2))
        columns = ["feature", "threshold", "left", "right", "depth", "size"]
        return pd.DataFrame({"tree": [tree], **{c: [[n[i] for n in nodes]] for i, c in enumerate(columns)}})

    return samples.groupBy("tree").applyInPandas(build, TREE_SCHEMA)


def _average_depth(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among n values, the length added below a leaf."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 2)
    return np.where(n > 2, 2 * (np.log(safe - 1) + np.euler_gamma) - 2 * (n - 1) / safe, np.where(n == 2, 1.0, 0.0))


def collect_forest(trees: DataFrame) -> list[dict[str, np.ndarray]]:
    """The forest on the driver: at most ``TREES`` rows of a few hundred numbers each."""
    forest = []
    for row in trees.orderBy("tree").collect():
        tree = {c: np.array(row[c]) for c in ("feature", "threshold", "left", "right", "depth", "size")}
        tree["value"] = tree["depth"] + _average_depth(tree["size"])
        forest.append(tree)
    return forest


def fit_forest(featured: DataFrame, trees: int = TREES, size: int = SAMPLE, seed: int = config.SEED):
    return collect_forest(grow(tree_samples(featured, trees, size, seed), size, seed))


def _steps(tree: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature, threshold and (left, right) child of every node; a leaf leads to itself."""
    leaf, own = tree["feature"] < 0, np.arange(len(tree["feature"]))
    child = np.column_stack([np.where(leaf, own, tree["left"]), np.where(leaf, own, tree["right"])]).ravel()
    return np.maximum(tree["feature"], 0), tree["threshold"], child


def score(featured: DataFrame, forest: list[dict], size: int = SAMPLE) -> DataFrame:
    """Claims with ``raw_score``: minus 2 ** -(mean depth / expected depth); lower is more anomalous."""
    shared = featured.sparkSession.sparkContext.broadcast(forest)
    grown_on = max((int(t["size"][0]) for t in forest), default=size)
    scale = float(_average_depth(np.array([grown_on]))[0]) or 1.0
    depth_limit = max((int(t["depth"].max()) for t in forest), default=0)

    @F.pandas_udf("double")
    def raw_score(*columns: pd.Series) -> pd.Series:
        x = np.stack([c.to_numpy(dtype=float) for c in columns], axis=1)
        total, flat, first = np.zeros(len(x)), x.ravel(), np.arange(len(x)) * x.shape[1]
        for tree in shared.value:
            asked, threshold, child = _steps(tree)
            at = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth_limit):
                right = ~(flat.take(first + asked.take(at)) <= threshold.take(at))
                at = child.take(2 * at + right)
            total += tree["value"][at]
        return pd.Series(-np.power(2.0, -total / max(len(shared.value), 1) / scale))

    return featured.withColumn("raw_score", raw_score(*[F.col(f"x_{c}") for c in FEATURES]))


def detect(
    claims: DataFrame, contamination: float = config.CONTAMINATION, trees: int = TREES, seed: int = config.SEED
) -> tuple[DataFrame, list[dict]]:
    """Claims with ``anomaly_score`` (below 0 is anomalous) and ``is_anomaly``, and the forest behind them.

    The cut-off is the exact contamination quantile of the scores, one number. The scores are written once to the shared
    folder, because the quantile and everything after it read them; select only the claim columns that are needed.
    """
    featured = features(claims, medians(claims).first())
    forest = fit_forest(featured, trees, seed=seed)
    spark = claims.sparkSession
    folder = f"{shared_dir(spark)}/lossmetrics/{spark.sparkContext.applicationId}/scores/{uuid.uuid4().hex}"
    scored = write_table(score(featured, forest), folder)
    # Scores lie between -1 and 0; stretched, the first cut of the quantile has thousands of slices to use.
    found = quantiles(scored, F.col("raw_score") * 1e6, {"cut": contamination}).first()["cut"]
    cut = 0.0 if found is None else found / 1e6
    out = scored.withColumn("anomaly_score", F.col("raw_score") - F.lit(cut))
    return out.withColumn("is_anomaly", F.col("anomaly_score") < 0).drop("raw_score"), forest


SUMMARY_COLUMNS = ["paid_amount", "days_to_close", "days_to_report", "severity_level", "litigation_flag"]


def compare(flagged: DataFrame) -> DataFrame:
    """Mean and median of each measure for normal and anomalous claims, and the difference of the means in percent."""
    flag = F.col("is_anomaly")
    sums = []
    for column in SUMMARY_COLUMNS:
        sums += [F.avg(F.when(~flag, F.col(column))).alias(f"nm_{column}"), F.avg(F.when(flag, F.col(column))).alias(f"am_{column}")]
    wide = flagged.agg(*sums)

    whole = SUMMARY_COLUMNS[1:]
    counts = stacked_counts(flagged, whole, ["is_anomaly"])
    middles = []
    for c in whole:
        middles.append(_median_of(c, F.when(~flag, F.col("n")).otherwise(0)).alias(f"nd_{c}"))
        middles.append(_median_of(c, F.when(flag, F.col("n")).otherwise(0)).alias(f"ad_{c}"))
    paid = [
        quantiles(flagged.where(~flag), "paid_amount", {"nd_paid_amount": 0.5}),
        quantiles(flagged.where(flag), "paid_amount", {"ad_paid_amount": 0.5}),
    ]
    for part in [counts.agg(*middles), *paid]:
        wide = wide.crossJoin(F.broadcast(part))  # one row each

    def entry(column: str) -> Column:
        normal, anomalous = (F.coalesce(f"{m}_{column}", F.lit(0.0)) for m in ("nm", "am"))
        return F.struct(
            F.lit(column).alias("feature"),
            F.round(normal, 2).alias("normal_mean"),
            F.round(anomalous, 2).alias("anomaly_mean"),
            F.round(F.coalesce(f"nd_{column}", F.lit(0.0)), 2).alias("normal_median"),
            F.round(F.coalesce(f"ad_{column}", F.lit(0.0)), 2).alias("anomaly_median"),
            F.when(normal != 0, F.round((anomalous - normal) / normal * 100, 2)).otherwise(0.0).alias("pct_diff_mean"),
        )

    return wide.select(F.inline(F.array(*[entry(c) for c in SUMMARY_COLUMNS])))


def monthly_rate(flagged: DataFrame) -> DataFrame:
    dated = flagged.where(F.col("incident_date").isNotNull())
    hits = F.count_if(F.col("is_anomaly"))
    return dated.groupBy(month_of("incident_date").alias("incident_month")).agg(
        F.count(F.lit(1)).alias("total_claims"),
        hits.alias("anomaly_count"),
        F.round(hits / F.count(F.lit(1)) * 100, 2).alias("anomaly_rate"),
    )


def _leaf_tables(forest: list[dict]) -> list[dict[str, np.ndarray]]:
    """Per tree the leaf boxes and, per leaf and subset of satisfied features, the Shapley value of each feature.

    Knowing the features in S, a leaf is reached with weight prod(inside S: satisfied) * prod(outside S: share of the
    samples that pass), so a claim's values depend on it only through the mask of features it satisfies.
    """
    width = len(FEATURES)
    full = 1 << width
    bits = [[(m >> f) & 1 for f in range(width)] for m in range(full)]
    weight = [math.factorial(s) * math.factorial(width - s - 1) / math.factorial(width) for s in range(width)]
    tables = []
    for tree in forest:
        low, high, pass_share, value = [], [], [], []
        todo = [(0, np.full(width, -np.inf), np.full(width, np.inf), np.ones(width))]
        while todo:
            node, lo, hi, share = todo.pop()
            f = int(tree["feature"][node])
            if f < 0:
                low.append(lo), high.append(hi), pass_share.append(share), value.append(tree["value"][node])
                continue
            cut = tree["threshold"][node]
            for child, is_left in ((tree["left"][node], True), (tree["right"][node], False)):
                l2, h2, s2 = lo.copy(), hi.copy(), share.copy()
                if is_left:
                    h2[f] = min(h2[f], cut)
                else:
                    l2[f] = max(l2[f], cut)
                s2[f] *= tree["size"][child] / tree["size"][node]
                todo.append((int(child), l2, h2, s2))
        share, value = np.array(pass_share), np.array(value)
        # reach[leaf, satisfied mask, known subset]
        reach = np.empty((len(value), full, full))
        for m, s in itertools.product(range(full), range(full)):
            factors = [np.full(len(value), float(bits[m][f])) if bits[s][f] else share[:, f] for f in range(width)]
            reach[:, m, s] = np.prod(factors, axis=0)
        phi = np.zeros((len(value), full, width))
        for f in range(width):
            for s in range(full):
                if not bits[s][f]:
                    phi[:, :, f] += weight[sum(bits[s])] * (reach[:, :, s | (1 << f)] - reach[:, :, s])
        tables.append({"low": np.array(low), "high": np.array(high), "phi": phi * value[:, None, None]})
    return tables


def explain(flagged: DataFrame, forest: list[dict], top: int = 3) -> DataFrame:
    """The strongest features of every anomalous claim by exact Shapley values of the mean depth, largest first."""
    tables = flagged.sparkSession.sparkContext.broadcast(_leaf_tables(forest))
    width = len(FEATURES)
    x = [f"x_{c}" for c in FEATURES]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = 1 << np.arange(width)
        for batch in batches:
            for at in range(0, len(batch), 512):
                part = batch.iloc[at : at + 512]
                values = part[x].to_numpy(dtype=float)
                phi = np.zeros((len(part), width))
                for table in tables.value:
                    inside = (values[:, None, :] > table["low"]) & (values[:, None, :] <= table["high"])
                    mask = inside @ powers
                    phi += table["phi"][np.arange(len(table["phi"]))[None, :], mask].sum(axis=1)
                phi /= max(len(tables.value), 1)
                best = np.argsort(-np.abs(phi), axis=1, kind="stable")[:, :top]
                yield pd.DataFrame(
                    {
                        "claim_id": np.repeat(part["claim_id"].to_numpy(), best.shape[1]),
                        "rank": np.tile(np.arange(1, best.shape[1] + 1), len(part)),
                        "feature": np.array(FEATURES, dtype=object)[best].ravel(),
                        "shap_value": np.take_along_axis(phi, best, axis=1).ravel(),
                    }
                )

    rows = flagged.where("is_anomaly").select("claim_id", *x)
    return rows.mapInPandas(run, "claim_id string, rank int, feature string, shap_value double")


def with_top_reason(flagged: DataFrame, reasons: DataFrame) -> DataFrame:
    """Anomalous claims with the name of their strongest feature."""
    first = reasons.where("rank = 1").select("claim_id", F.col("feature").alias("top_reason"))
    return flagged.where("is_anomaly").join(first, "claim_id", "left").na.fill("", ["top_reason"])
