"""The documents made of events: how they are cut must not show."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from overflight.operators import completeness, density, metrics, staging
from overflight.plans.events import bronze_from_events
from overflight.sources.reference import region_area
from tests.helpers import rows

SF_DIR = "/root/testdata/sf0.001"
AS_OF = datetime(2024, 1, 31, 12)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
def test_the_cut_of_documents_does_not_show(spark):
    def results(piece_ids):
        bronze = bronze_from_events(spark, SF_DIR, piece_ids)
        stg = staging.stage(bronze)
        return bronze.count(), [
            rows(completeness.incomplete_days(bronze, AS_OF, 30, 200)),
            rows(completeness.daily_health(bronze, AS_OF, 7, 30)),
            rows(metrics.metric_snapshots(bronze, AS_OF, 30)),
            rows(bronze.groupBy("snapshot_time").agg(F.sum(staging.state_count("raw")))),
            rows(density.region_density(stg, region_area(spark))),
        ]

    (whole, wanted), (cut, got) = results(1 << 40), results(7)
    assert cut > whole
    assert got == wanted
