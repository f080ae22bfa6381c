"""Every core query against its SQL, and that the others run."""

import pytest

from quillstream.plans import registry

from .oracle import FOLDER, compare


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_query_equals_sql(spark, name):
    compare(spark, registry.QUERIES, registry.SQL, name)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_query_runs(spark, name):
    assert registry.QUERIES[name](spark, FOLDER).count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
