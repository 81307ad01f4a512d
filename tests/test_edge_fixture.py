"""Every report against its oracle on the crafted edge-case source folder."""

import pytest

import edge_fixture
from ledgerlens.plans.oracles import ORACLES
from ledgerlens.plans.registry import QUERIES
from oracle_compare import compare, duck_connection


@pytest.fixture(scope="module", params=[11, 3], ids=["seed11", "seed3"])
def edge(request, tmp_path_factory):
    folder = edge_fixture.build(str(tmp_path_factory.mktemp(f"edge{request.param}")), seed=request.param)
    return folder, duck_connection(folder)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_report_on_edge_cases(spark, edge, name):
    folder, con = edge
    ok, msg = compare(spark, name, QUERIES[name], ORACLES[name], folder, con)
    assert ok, msg


def test_share_when_a_scenario_repeats(spark, tmp_path):
    """The denominator is counted before the join: repeated scenarios don't inflate it."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    folder = edge_fixture.build(str(tmp_path), seed=11)
    part = pq.read_table(f"{folder}/part.parquet")
    pq.write_table(pa.concat_tables([part, part.slice(0, 4)]), f"{folder}/part.parquet")
    ok, msg = compare(spark, "share_by_type_top5", QUERIES["share_by_type_top5"], ORACLES["share_by_type_top5"], folder, duck_connection(folder))
    assert ok, msg
