"""Frames of awkward documents."""

from __future__ import annotations

import pytest
from awkward_texts import CLASHES, awkward_texts


@pytest.fixture(scope="session")
def awkward(spark):
    """The texts, with null language for some, and columns with clashing names."""
    rows = [
        (k, t, ("en", "de", None)[n % 3], *(f"{c}{n}" for c in CLASHES)) for n, (k, t) in enumerate(awkward_texts())
    ]
    schema = "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in CLASHES)
    return spark.createDataFrame(rows, schema).repartition(3).cache()


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.where("false")
