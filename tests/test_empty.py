"""Every operator accepts a table without rows."""

import pytest

from lossmetrics import queries
from lossmetrics.plans import cleaning, star, warehouse
from lossmetrics.sources import schemas

# These read the source tables directly or refuse to train on nothing.
OTHER = {"s1_read_claims", "s2_read_dimension", "w1_dim_provider", "w2_dim_region", "w3_dim_diagnosis", "w4_dim_root_cause"}
# Queries that share the fit of a severity model, a cross-validation or a calibration.
TRAINED = {n for n, q in queries.model_queries().items() if getattr(q, "fit", None) in ("severity", "scores", "calibration")}
NAMES = sorted(set(queries.registry()) - OTHER - TRAINED)


@pytest.fixture(scope="module")
def empty(spark, star_sources):
    typed = cleaning.typed(spark.createDataFrame([], schemas.raw_claims_schema()))
    dims = warehouse.build_dims(star_sources)
    fact = star.fact_claim(cleaning.clean_claims(typed), dims)
    summary = spark.createDataFrame([], schemas.summary_schema())
    handle = (spark.sparkContext.applicationId, "empty")
    warehouse._open[handle] = warehouse.Warehouse(typed, star_sources, dims, fact, summary)
    return "empty"


@pytest.mark.parametrize("name", NAMES)
def test_no_rows(spark, empty, name):
    rows = queries.registry()[name](spark, empty).collect()
    assert len(rows) <= 60


@pytest.mark.parametrize("name", sorted(TRAINED))
def test_training_on_nothing_is_refused(spark, empty, name):
    with pytest.raises(ValueError):
        queries.registry()[name](spark, empty)
