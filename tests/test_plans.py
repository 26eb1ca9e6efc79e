"""The physical plans: what is pushed down, what is read, how often JSON is parsed, what is moved."""

from __future__ import annotations

import re

import pytest

from msgmart.operators import arrays, increments, latest
from msgmart.plans import jobs
from msgmart.plans.jobs.common import AVAILABILITY_MESSAGES, MESSAGES
from msgmart.plans.runner import Options, Runner
from msgmart.session import setting
from msgmart.sources.envelope import between_marks
from msgmart.sources.tables import Tables
from msgmart.workloads import lake

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    with setting(df.sparkSession, "spark.sql.maxMetadataStringLength", "100000"):
        return df._jdf.queryExecution().executedPlan().toString()


def count(word: str, text: str) -> int:
    return len(re.findall(rf"\b{word}\b", text))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    tables = Tables(spark, root=str(tmp_path_factory.mktemp("plans")))
    builders = {
        MESSAGES: (lake.vvm_area, lake.kls_event, lake.presales, lake.service_order),
        AVAILABILITY_MESSAGES: (lake.availability_v1, lake.availability_v2),
    }
    for name, some in builders.items():
        for build in some:
            tables.append(build(spark, FOLDER), name)
            tables.append(build(spark, FOLDER), f"{name}_by_type", ["messagetype"])
    return tables


def new_messages(tables, spec, suffix=""):
    found = spec.messages(tables.read(spec.source + suffix))
    return between_marks(found, "20190101000000", "20300101000000")


@pytest.mark.parametrize("spec", jobs.DAILY, ids=lambda s: s.process)
def test_bounds_type_and_version_reach_the_scan(tables, spec):
    text = plan(spec.main(new_messages(tables, spec)))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "GreaterThan(acl_dop,20190101000000)" in pushed
    assert "LessThanOrEqual(acl_dop,20300101000000)" in pushed
    assert "messagetype" in pushed and "messageversion" in pushed


@pytest.mark.parametrize("spec", jobs.DAILY, ids=lambda s: s.process)
def test_json_is_parsed_once_and_nothing_is_moved(tables, spec):
    text = plan(spec.main(new_messages(tables, spec)))
    whole = len(re.findall(r"from_json\([^\n]*?, jsonstruct#\d+", text))
    assert whole == 1 and count("get_json_object", text) <= 1
    assert text.count("FileScan") == 1
    assert count("Exchange", text) == (1 if spec.latest else 0)
    assert "Python" not in text


def test_children_parse_once_too(tables):
    spec = jobs.PRESALES
    for frame in spec.outputs(new_messages(tables, spec)).values():
        text = plan(frame)
        assert count("Exchange", text) == 0
        assert len(re.findall(r"jsonstruct#\d+, Some", text)) == 1


def test_a_condition_on_children_repeats_no_parse(tables):
    """Elements are parsed below the explode: a filter above it has them as they are."""
    spec = jobs.PRESALES
    history = spec.outputs(spec.messages(tables.read(MESSAGES)))["cl_f_presalesorder_history_mt"]
    above = history._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert "Filter" in above and "from_json" not in above


def test_a_table_kept_by_type_is_pruned(tables):
    text = plan(jobs.KLS_EVENT.main(new_messages(tables, jobs.KLS_EVENT, "_by_type")))
    assert re.search(r"PartitionFilters: \[[^\]]*messagetype[^\]]* = IBT - KLSEvent", text)


def test_unused_columns_are_not_read(tables):
    text = plan(jobs.LATEST_PRESALES.main(new_messages(tables, jobs.LATEST_PRESALES)))
    read = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert "bdmp" not in read


def test_measuring_reads_no_payload(spark, tables):
    found = new_messages(tables, jobs.KLS_EVENT)
    seen = []
    original = type(found).first

    def remember(self):
        seen.append(plan(self))
        return original(self)

    type(found).first = remember
    try:
        increments.measure(found)
        increments.measure(found, key="acl_id")
    finally:
        type(found).first = original
    for text in seen:
        assert "jsonstruct" not in text
    assert "partial_count" in seen[1]


def test_latest_reduces_before_the_shuffle(tables):
    found = new_messages(tables, jobs.PRESALES).select("acl_loadnumber", "acl_dop", "acl_id")
    text = plan(latest.latest_by_max(found, "acl_loadnumber", ["acl_dop", "acl_id"]))
    assert "partial_max" in text.split("Exchange")[-1]
    text = plan(latest.latest_by_rank(found, "acl_loadnumber", ["acl_dop", "acl_id"]))
    assert "WindowGroupLimit" in text.split("Exchange")[-1]


def test_joins_carry_no_hint(tables):
    """Sides of a join grow with the data; which one fits into memory is measured at run time."""
    for spec in (jobs.AVAILABILITY_V2, jobs.SERVICE_ORDER):
        frame = spec.main(new_messages(tables, spec), how="join")
        logical = frame._jdf.queryExecution().analyzed().toString()
        assert "ResolvedHint" not in logical


def test_unique_ids_are_worked_on_inside_the_row(tables):
    runner = Runner(tables, tables)
    spec = jobs.AVAILABILITY_V2
    found = increments.measure(spec.messages(tables.read(spec.source)), key=runner.key(spec))
    assert found.repeated == 0 and found.most == 1
    with runner._main(spec, new_messages(tables, spec), None, None, None) as main:
        assert "Exchange" not in plan(main)


def test_split_moves_no_message_with_an_id_of_its_own(tables):
    runner = Runner(tables, tables)
    spec = jobs.AVAILABILITY_V2
    new = new_messages(tables, spec)
    repeated = increments.repeated_of(increments.per_id(new, "acl_id", "acl_dop"), "acl_id")
    with runner._main(spec, new, None, None, repeated, most=2) as main:
        logical = main._jdf.queryExecution().analyzed().toString()
        assert "ResolvedHint" not in logical
        physical = plan(main)
        assert physical.count("from_json") >= 2 and physical.count("LeftAnti") == 1 and "Window" not in physical


def test_ids_of_few_messages_are_united_by_one_aggregate(tables):
    spec = jobs.AVAILABILITY_V2
    physical = plan(spec.main(new_messages(tables, spec), how="few"))
    assert "collect_list" in physical and "Window" not in physical
    assert physical.count("LeftOuter") == 1


def test_no_window_by_id_and_no_gathering_of_busy_ids(tables, monkeypatch):
    """What is united excludes ids of many messages; these meet their elements by id, part and piece."""
    spec = jobs.SERVICE_ORDER
    monkeypatch.setattr(arrays, "any_busy", lambda *_: True)
    logical = spec.main(new_messages(tables, spec), how="join")._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in logical and "ResolvedHint" not in logical
    gathered = logical[logical.index("collect_list") :].split("Union")[0]
    assert "Join LeftAnti" in gathered and "> 1000" in logical
    assert any("part" in line and "piece" in line for line in logical.splitlines() if "Join LeftOuter" in line)
