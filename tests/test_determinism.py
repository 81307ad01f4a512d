"""Results do not depend on the partition layout: the same report under
different shuffle partition counts (different hash layouts) gives the same rows."""

import pytest

from ledgerlens.plans.registry import QUERIES

from conftest import SF01

NAMES = ["rfm_segments", "heaviest_products", "retention_matrix", "share_by_type_top5",
         "monthly_share", "products_never_ordered", "transactions_two_januaries"]


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_under_other_layouts(spark, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for parts in ("3", "8", "29"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            results.append(sorted(map(tuple, QUERIES[name](spark, SF01).collect()), key=repr))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert results[0] == results[1] == results[2]
