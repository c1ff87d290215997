from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reviewmill.schema import REVIEW_SCHEMA, ROW_ID  # noqa: E402
from reviewmill.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, memory="6g", checkpoint_dir=str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture
def make_reviews(spark):
    """Build a review table from dictionaries; absent columns get plain defaults."""

    def build(rows, partitions=2):
        filled = []
        for i, row in enumerate(rows):
            base = {
                "Review_ID": i,
                "Rating": 5,
                "Year_Month": "2015-6",
                "Reviewer_Location": "Utopia",
                "Review_Text": f"text number {i}",
                "Branch": "park_a",
            }
            base.update(row)
            filled.append((base.get(ROW_ID, i), *[base[f.name] for f in REVIEW_SCHEMA.fields]))
        schema = f"{ROW_ID} long, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in REVIEW_SCHEMA.fields)
        return spark.createDataFrame(filled, schema).repartition(partitions)

    return build
