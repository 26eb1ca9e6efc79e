"""Tables, control tables and whole runs: repeated, idle, late, broken and resumed."""

from __future__ import annotations

import json
import re

import pytest
from pyspark.sql import functions as F

from msgmart.plans import jobs
from msgmart.plans.control import LOG, TRACKING, Control, mark_of
from msgmart.plans.jobs.common import AVAILABILITY_MESSAGES, MESSAGES
from msgmart.plans.runner import BUCKET, MissingMark, Options, Runner
from msgmart.sources.envelope import ENVELOPE
from msgmart.sources.tables import Tables, aligned

ZERO = "00000000000000"


@pytest.fixture
def tables(spark, tmp_path):
    return Tables(spark, root=str(tmp_path))


def land(tables, kind, version, payloads, table=MESSAGES):
    """``payloads``: (id, stamp, payload or text)."""
    rows = [
        (i, stamp, 7, kind, version, p if isinstance(p, str) else json.dumps(p), "ls", "bi", "ba")
        for i, stamp, p in payloads
    ]
    tables.append(tables.spark.createDataFrame(rows, ENVELOPE), table)


def start(tables, *specs):
    for spec in specs:
        Control(tables).advance(spec.process, spec.source, ZERO)


def column(tables, table, name):
    return sorted((r[0] for r in tables.read(table).select(name).collect()), key=repr)


# -- tables ------------------------------------------------------------------------------------


def test_append_matches_by_name_and_refuses_unknown_columns(spark, tables):
    tables.append(spark.createDataFrame([(1, "a")], "n int, s string"), "t")
    tables.append(spark.createDataFrame([("b", 2)], "S string, N bigint"), "t")
    tables.append(spark.createDataFrame([(3,)], "n int"), "t")
    assert sorted(tuple(r) for r in tables.read("t").fillna("").collect()) == [(1, "a"), (2, "b"), (3, "")]
    with pytest.raises(ValueError, match="extra"):
        tables.append(spark.createDataFrame([(4, "x")], "n int, extra string"), "t")
    assert tables.count("t") == 3


def test_missing_table(tables):
    assert not tables.exists("nothing") and tables.find("nothing", "a int") is None


def test_aligned_orders_and_casts(spark):
    frame = spark.createDataFrame([("1", 2)], "b string, a int")
    target = spark.createDataFrame([(0, 0, "")], "a bigint, b int, c string").schema
    assert [tuple(r) for r in aligned(frame, target).collect()] == [(2, 1, None)]


def test_catalog_tables(spark, tmp_path):
    spark.sql(f"CREATE DATABASE catalog_test LOCATION '{tmp_path}'")
    tables = Tables(spark, database="catalog_test")
    frame = spark.createDataFrame([(1, "x"), (2, "y")], "amount int, part string")
    tables.append(frame, "t", ["part"])
    tables.replace_partitions(spark.createDataFrame([("x", 9)], "part string, amount int"), "t", ["part"])
    assert sorted(tuple(r) for r in tables.read("t").collect()) == [(2, "y"), (9, "x")]
    start(tables, jobs.VVM_AREA)
    land(tables, "DigiOSS - vvmArea", "1", [("1", "20200101000000", {"number": 1})])
    assert Runner(tables, tables).run(jobs.VVM_AREA).rows == 1
    assert tables.exists(jobs.VVM_AREA.target) and not tables.exists("other")


def test_a_place_is_needed(spark):
    with pytest.raises(ValueError):
        Tables(spark)


# -- control -----------------------------------------------------------------------------------


def test_marks(spark, tables):
    control = Control(tables)
    assert control.mark("p", "t").value is None
    assert control.advance("p", "t", "20200101000000")
    assert control.advance("q", "t", "20190101000000", "other_column")
    assert control.advance("p", "t", "20200102000000")
    assert not control.advance("p", "t", None) and not control.advance("p", "t", "")
    assert control.mark("p", "t").value == "20200102000000"
    assert control.mark("q", "t").column == "other_column"
    assert control.mark("p", "elsewhere").value is None
    assert tables.count(TRACKING) == 2
    assert tables.read(TRACKING).filter("bdmp_loadstamp rlike '^....-..-.. ..:..:..$'").count() == 2


def test_the_greatest_row_wins_by_value_then_column(spark):
    rows = [("t", "2", "a", "p"), ("t", "10", "z", "p"), ("t", "2", "b", "p"), ("t", "9", "a", "q")]
    tracking = spark.createDataFrame(
        rows, "table_name string, max_tracking_value string, col_name string, etl_process_name string"
    )
    assert (mark_of(tracking, "p", "t").value, mark_of(tracking, "p", "t").column) == ("2", "b")


def test_log(tables):
    control = Control(tables)
    assert control.log("p", "text1", "text2", "text3", "DEBUG") and not control.log("p", "")
    row = tables.read(LOG).first()
    assert (row.workflow, row.process, row.log_type, row.log_entry, row.log_entry2, row.log_entry3) == (
        "al2cl",
        "p",
        "DEBUG",
        "text1",
        "text2",
        "text3",
    )
    assert row.log_time is not None


# -- runs --------------------------------------------------------------------------------------

AREA = "DigiOSS - vvmArea"


def test_increments_idle_runs_and_late_rows(tables):
    spec, runner = jobs.VVM_AREA, Runner(tables, tables)
    start(tables, spec)
    land(tables, AREA, "1", [("1", "20200101000000", {"number": 1}), ("2", "20200102000000", {"number": 2})])
    land(tables, AREA, "2", [("9", "20200105000000", {"number": 9})])  # another version
    first = runner.run(spec)
    assert (first.rows, first.high) == (2, "20200102000000")
    assert runner.run(spec).rows == 0 and runner.run(spec).written == ()
    land(
        tables,
        AREA,
        "1",
        [
            ("3", "20200103000000", {"number": 3}),
            ("4", "20200102000000", {"number": 4}),  # equal to the mark: not seen
            ("5", "20200101120000", {"number": 5}),  # late: not seen
        ],
    )
    assert runner.run(spec).rows == 1
    assert column(tables, spec.target, "number") == ["1", "2", "3"]
    assert Control(tables).mark(spec.process, spec.source).value == "20200103000000"
    log = tables.read(LOG).filter(F.col("log_entry2").contains("doing_Insert=False"))
    assert log.count() == 2


def test_looking_back_finds_late_rows_once(tables):
    spec, runner = jobs.PRESALES, Runner(tables, tables)
    start(tables, spec)
    land(tables, PSO, "1", [("1", "20200105000000", OLD)])
    runner.run(spec)
    land(tables, PSO, "1", [("2", "20200103000000", OLD), ("3", "20200105000000", NEW)])
    assert runner.run(spec).rows == 0
    for _ in range(2):
        runner.run(spec, since="20200101000000")
        assert column(tables, spec.target, "acl_id_int") == ["1", "2", "3"]
        assert column(tables, "cl_f_presalesorder_orderitem_mt", "acl_id_int") == ["1", "1", "2", "2"]
    assert Control(tables).mark(spec.process, spec.source).value == "20200105000000"


def test_missing_mark(tables):
    land(tables, AREA, "1", [("1", "20200101000000", {"number": 1})])
    with pytest.raises(MissingMark, match="proc_f_vvmarea"):
        Runner(tables, tables).run(jobs.VVM_AREA)
    with pytest.raises(MissingMark):
        Runner(tables, tables).run_all([jobs.VVM_AREA])


def test_no_message_of_the_type(tables):
    start(tables, jobs.NVT_AREA)
    land(tables, AREA, "1", [("1", "20200101000000", {"number": 1})])
    for schema in ("declared", "inferred", "merged"):
        assert Runner(tables, tables, Options(schema=schema)).run(jobs.NVT_AREA).rows == 0
    assert not tables.exists(jobs.NVT_AREA.target)


def test_malformed_and_partial_payloads(tables):
    start(tables, jobs.VVM_AREA)
    land(
        tables,
        AREA,
        "1",
        [
            ("1", "20200101000000", '{"number": "1", "creationDate'),
            ("2", "20200101000001", {"thresholdData": {"threshold": 5}, "creationDate": 1579174772080}),
            ("3", "20200101000002", {"number": "3", "unknown": [1]}),
        ],
    )
    Runner(tables, tables).run(jobs.VVM_AREA)
    got = {r.acl_id_int: r for r in tables.read(jobs.VVM_AREA.target).collect()}
    assert got["1"].number is None and got["3"].number == "3"
    assert (got["2"].threshold, got["2"].creationDate_ISO) == ("5", "2020-01-16 11:39:32")
    assert got["2"].is_reporting_relevant is None and got["2"].bdmp_loadstamp == "ls"


WORK = "DigiOSS - WorkOrderEvent"


@pytest.mark.parametrize("schema", ["declared", "inferred", "merged"])
def test_work_order_field_names_in_either_case(tables, schema):
    start(tables, jobs.WORK_ORDER)
    times = {"eventDateTime": "2020-07-01T12:00:00.000Z"}
    land(
        tables,
        WORK,
        "1",
        [
            ("1", "20200101000000", {**times, "eventPayload": {"workOrderId": "camel"}}),
            ("2", "20200101000001", {**times, "eventPayload": {"workorderid": "lower"}}),
        ],
    )
    Runner(tables, tables, Options(schema=schema)).run(jobs.WORK_ORDER)
    assert column(tables, jobs.WORK_ORDER.target, "workorderid") == ["camel", "lower"]
    assert str(tables.read(jobs.WORK_ORDER.target).first().eventdatetime) == "2020-07-01 10:00:00"


def test_merged_schema_grows_with_the_runs(tables):
    spec, runner = jobs.KLS_EVENT, Runner(tables, tables, Options(schema="merged"))
    start(tables, spec)
    land(tables, "IBT - KLSEvent", "1", [("1", "20200101000000", {"eventType": "a"})])
    runner.run(spec)
    later = {"eventPayload": {"klsId": "k", "modificationDate": "2020-01-01T12:00:00.000Z"}}
    land(tables, "IBT - KLSEvent", "2", [("2", "20200102000000", later)])
    runner.run(spec)
    got = {r.acl_id_int: (r.eventType, r.klsid_ps) for r in tables.read(spec.target).collect()}
    assert got == {"1": ("a", None), "2": (None, "k")}


PSO = "VVM - PreSalesOrder"
OLD = {
    "id": "p1",
    "lastModifiedAt": "2019-05-13T12:38:45.123456+02:00",
    "location": {"buildingDetails": {"type": "single"}},
    "installationAddress": {"klsId": 1, "zip": "01234"},
    "salesDetails": {"channel": "shop"},
    "items": [{"id": "i1", "name": "n1"}, {"id": "i2"}],
    "history": [
        {"id": "h1", "itemType": "state_transition", "payload": {"data": {"from": "a", "to": "b"}}},
        {"id": "h2", "itemType": "note"},
    ],
}
NEW = {
    "id": "p2",
    "installationLocation": {"address": {"klsId": 2}, "landlordCompany": {"name": "c"}},
    "provisionData": {"channel": "web"},
    "items": [],
}


@pytest.mark.parametrize("schema", ["declared", "inferred"])
def test_presales_layouts_and_children(tables, schema):
    start(tables, jobs.PRESALES)
    land(tables, PSO, "1", [("1", "20190513123845", OLD), ("2", "20190812095557", NEW)])
    result = Runner(tables, tables, Options(schema=schema)).run(jobs.PRESALES)
    assert len(result.written) == 3
    main = {r.presalesorderid_ps: r for r in tables.read("cl_f_presalesorder_mt").collect()}
    old, new = main["p1"], main["p2"]
    assert [str(r.klsid_ps) for r in (old, new)] == ["1", "2"]
    assert [r.saleschannel for r in (old, new)] == ["shop", "web"]
    assert (old.buildingtype, old.zip_code, new.companyname) == ("single", "01234", "c")
    assert [r.landlordiscompany for r in (old, new)] == [False, True]
    assert str(old.lastmodifiedat_iso) == "2019-05-13 10:38:45"
    assert (new.orderitems_json, old.acl_loadnumber_int) == ("[]", 7)
    items = tables.read("cl_f_presalesorder_orderitem_mt").orderBy("orderitemid_ps").collect()
    assert [(r.acl_id_int, r.orderitemid_ps, r.productname) for r in items] == [("1", "i1", "n1"), ("1", "i2", None)]
    history = tables.read("cl_f_presalesorder_history_mt").collect()
    assert [(r.historyid_ps, r.oldstate, r.newstate) for r in history] == [("h1", "a", "b")]


@pytest.mark.parametrize("schema", ["declared", "inferred"])
def test_text_of_the_array_is_that_of_the_payload(tables, schema):
    """The text column equals the JSON path of the payload, numbers and escapes included."""
    parts = [
        '[{"id":1.50,"name":"ä\\n\\"x","lineNumber":1e5, "conditions":[ ]}]',
        "[]",
        "null",
        '"text"',
        "7",
        '{"a": 1.10}',
        '[{"id":"a"}], "cut":',
    ]
    start(tables, jobs.PRESALES)
    land(tables, PSO, "1", [(str(i), "20200101000000", f'{{"items":{p}}}') for i, p in enumerate(parts)])
    Runner(tables, tables, Options(schema=schema)).run(jobs.PRESALES)
    messages = tables.read(MESSAGES).select(
        "acl_id", F.get_json_object("jsonstruct", "$.items").alias("want")
    )
    got = tables.read(jobs.PRESALES.target).select("acl_id_int", "orderitems_json")
    both = got.join(messages, F.col("acl_id") == F.col("acl_id_int")).collect()
    assert len(both) == len(parts)
    assert all(r.orderitems_json == r.want for r in both)


@pytest.mark.parametrize("broken", ["cl_f_presalesorder_mt", "cl_f_presalesorder_history_mt", TRACKING])
def test_a_broken_run_is_resumed_without_loss_or_repeat(tables, monkeypatch, broken):
    """The write of one table fails; the next run completes all of them, with new rows on top."""
    spec = jobs.PRESALES
    start(tables, spec)
    land(tables, PSO, "1", [("1", "20190513123845", OLD), ("2", "20190812095557", NEW)])
    save = Tables._save

    def failing(self, writer, name):
        if name == broken:
            raise OSError("lost the driver")
        save(self, writer, name)

    monkeypatch.setattr(Tables, "_save", failing)
    with pytest.raises(OSError):
        Runner(tables, tables).run(spec)
    monkeypatch.setattr(Tables, "_save", save)
    assert Control(tables).begun(spec.process, ZERO)
    assert Control(tables).mark(spec.process, spec.source).value == ZERO
    land(tables, PSO, "1", [("3", "20200101000000", {**OLD, "id": "p3"})])
    assert Runner(tables, tables).run(spec).rows == 3
    assert column(tables, "cl_f_presalesorder_mt", "acl_id_int") == ["1", "2", "3"]
    assert column(tables, "cl_f_presalesorder_orderitem_mt", "acl_id_int") == ["1", "1", "3", "3"]
    assert column(tables, "cl_f_presalesorder_history_mt", "acl_id_int") == ["1", "3"]
    assert not Control(tables).begun(spec.process, "20200101000000")


def availability(names):
    item = {
        "eligibilityUnavailabilityReason": [{"code": "c", "label": "l"}],
        "service": {
            "place": [{"id": "k", "street": "s", "@type": "t"}],
            "serviceCharacteristic": [{"name": n, "value": v, "@type": None} for n, v in names],
        },
    }
    payload = {"serviceQualification": {"serviceQualificationItem": [item]}}
    return {"availabilityCheckCalledEvent": {"eventId": "e", "eventPayload": payload}}


V2 = "DigiOSS - FiberAvailabilityEvent V2"


def run_availability(tables, payloads, **options):
    start(tables, jobs.AVAILABILITY_V2)
    land(tables, V2, "2", payloads, AVAILABILITY_MESSAGES)
    Runner(tables, tables, Options(**options)).run(jobs.AVAILABILITY_V2)
    return tables.read(jobs.AVAILABILITY_V2.target)


@pytest.mark.parametrize("schema", ["declared", "inferred"])
def test_availability_attributes(tables, schema):
    got = run_availability(
        tables,
        [
            ("1", "20200101000000", availability([("Technologie", "x"), ("Technologie", "y"), ("DatumVon", "2020-01-01T00:00:00.000Z")])),
            ("2", "20200101000000", availability([])),
            ("3", "20200101000000", {"availabilityCheckCalledEvent": {"eventId": "bare"}}),
        ],
        schema=schema,
    )
    rows = sorted((r.acl_id_int, r.technologie, r.klsid_ps) for r in got.collect() if r.acl_id_int != "3")
    assert rows == [("1", "x", "k"), ("1", "y", "k"), ("2", None, "k")]
    assert {str(r.planbeginngfausbau) for r in got.filter("acl_id_int = '1'").collect()} == {"2019-12-31 23:00:00"}
    bare = got.filter("acl_id_int = '3'").first()
    assert (bare.eventid, bare.klsid_ps, bare.address_type) == ("bare", None, None)
    address = got.filter("acl_id_int = '2'").first().address_type
    assert (json.loads(address) if schema == "declared" else address.asDict())["street"] == "s"


def test_repeated_ids_take_the_join(tables):
    """Two messages with one id meet each other's attributes, as the joins do."""
    payloads = [
        ("1", "20200101000000", availability([("Technologie", "x")])),
        ("1", "20200101000000", availability([("Technologie", "y")])),
        ("2", "20200101000000", availability([("Technologie", "z")])),
    ]
    got = run_availability(tables, payloads)
    assert sorted((r.acl_id_int, r.technologie) for r in got.collect()) == [
        ("1", "x"),
        ("1", "x"),
        ("1", "y"),
        ("1", "y"),
        ("2", "z"),
    ]


def test_every_form_gives_the_rows_of_the_joins(tables):
    """Unique, repeated and missing ids together."""
    names = ["Technologie", "Kooperationspartner", "Ausbaustand Glasfaser", "Technologie"]
    payloads = []
    for n, id_ in enumerate(["1", "2", "2", "3", None, None, "4", "4", "4"]):
        pairs = [(name, f"{n}{i}") for i, name in enumerate(names[: n % 5])]
        payloads.append((id_, "20200101000000", availability(pairs)))
    spec = jobs.AVAILABILITY_V2
    got = run_availability(tables, payloads)
    want = spec.main(spec.messages(tables.read(spec.source)), how="join")
    assert got.count() == want.count() > 9
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_first_reason_is_kept_whole(tables):
    spec = jobs.AVAILABILITY_V1
    start(tables, spec)
    reasons = [["plain"], [{"code": "c", "label": "l"}], []]
    payloads = [
        (
            str(i),
            "20200101000000",
            {"eventPayload": {"serviceQualification": {"serviceQualificationItem": [{"eligibilityUnavailabilityReason": r}]}}},
        )
        for i, r in enumerate(reasons)
    ]
    land(tables, "DigiOSS - FiberAvailabilityEvent", "1", payloads, AVAILABILITY_MESSAGES)
    Runner(tables, tables).run(spec)
    got = {r.acl_id_int: r.eligibilityUnavailabilityReasonCode for r in tables.read(spec.target).collect()}
    assert got == {"0": "plain", "1": '{"code":"c","label":"l"}', "2": None}


def test_two_systems_of_service_orders(tables):
    spec = jobs.SERVICE_ORDER
    start(tables, spec)

    def order(name, action="add", state="active"):
        item = {"id": "i", "state": "s", "action": action, "service": {"id": "s1", "name": name, "serviceState": state}}
        return {"event": {"ServiceOrder": {"id": "o", "orderDate": "2020-07-01T12:00:00.000Z", "orderItem": [item]}}}

    land(tables, spec.types[0], "1", [("1", "20200101000000", order("GigaAnschluss"))])
    land(tables, spec.types[1], "1", [("2", "20200101000000", order("GigaAnschluss", "remove"))])
    land(tables, "other", "1", [("3", "20200101000000", order("GigaAnschluss"))])
    Runner(tables, tables).run(spec)
    got = {r.acl_id_int: (r.s_name, str(r.orderDate_iso)) for r in tables.read(spec.target).collect()}
    assert got == {
        "1": ("GigaAnschluss", "2020-07-01 12:00:00"),
        "2": (None, "2020-07-01 12:00:00"),
    }


@pytest.mark.parametrize("refresh", ["full", "merge"])
def test_latest_snapshot(tables, refresh):
    spec, runner = jobs.LATEST_PRESALES, Runner(tables, tables, Options(refresh=refresh))
    day = "2020-01-0{}T00:00:00.5Z".format
    land(tables, PSO, "1", [("1", "20200101000000", {"id": "a", "lastModifiedAt": day(1)}), ("2", "20200101000000", {"id": "b", "lastModifiedAt": day(5)})])
    runner.run(spec)
    assert column(tables, spec.target, "acl_id_int") == ["1", "2"]
    land(tables, PSO, "1", [("3", "20200102000000", {"id": "a", "lastModifiedAt": day(2)}), ("4", "20200102000000", {"id": "b", "lastModifiedAt": day(4)})])
    runner.run(spec)
    runner.run(spec)
    rows = sorted((r.presalesorderid_ps, r.acl_id_int, r.rnk) for r in tables.read(spec.target).collect())
    assert rows == [("a", "3", 1), ("b", "2", 1)]
    assert Control(tables).mark(spec.process, spec.source).value == "20200102000000"


def _files(tables, name):
    return {r[0] for r in tables.read(name).select("_metadata.file_path").distinct().collect()}


def _presales(tables, number, keys, day):
    stamp = f"2020010{day}000000"
    rows = [(f"{number}{k}", stamp, {"id": f"key{k}", "lastModifiedAt": f"2020-01-0{day}T00:00:00.5Z"}) for k in keys]
    land(tables, PSO, "1", rows)


def test_a_merge_touches_the_buckets_of_new_keys_only(tables):
    spec, runner = jobs.LATEST_PRESALES, Runner(tables, tables, Options(refresh="merge", buckets=16))
    _presales(tables, 1, range(60), 1)
    runner.run(spec)
    before, buckets = _files(tables, spec.target), dict(tables.read(spec.target).select("presalesorderid_ps", BUCKET).collect())
    assert len(set(buckets.values())) > 10
    _presales(tables, 2, [3, 99], 2)
    fresh = runner._bucketed(spec.main(spec.messages(tables.read(spec.source)).where("acl_dop = '20200102000000'")), spec)
    touched = {r[BUCKET] for r in fresh.collect()}
    tree = runner.merged(spec, fresh)._jdf.queryExecution().executedPlan().toString()
    filters = re.findall(r"PartitionFilters: \[([^]]*)", tree)
    assert any(all(t in f for t in touched) and f"{BUCKET}#" in f for f in filters)
    runner.run(spec)
    after = _files(tables, spec.target)
    kept = {f for f in before if not any(f"{BUCKET}={t}/" in f for t in touched)}
    assert kept and kept < after and not (before - kept) & after
    rows = {r.presalesorderid_ps: r.acl_id_int for r in tables.read(spec.target).collect()}
    assert len(rows) == 61 and rows["key3"] == "23" and rows["key99"] == "299" and rows["key4"] == "14"


def test_a_broken_merge_is_repeated(tables, monkeypatch):
    """Broken before and after the buckets are replaced; another number of buckets is a new layout."""
    spec, runner = jobs.LATEST_PRESALES, Runner(tables, tables, Options(refresh="merge", buckets=4))
    _presales(tables, 1, range(9), 1)
    runner.run(spec)
    for day, late in ((2, False), (3, True)):
        _presales(tables, day, [day], day)
        replace = tables.replace_partitions

        def broken(frame, name, by, late=late, replace=replace):
            if name == spec.target:
                if late:
                    replace(frame, name, by)
                raise OSError("lost")
            replace(frame, name, by)

        with monkeypatch.context() as patched:
            patched.setattr(tables, "replace_partitions", broken)
            with pytest.raises(OSError):
                runner.run(spec)
        assert tables.read(spec.target).count() == 9
        runner.run(spec)
        rows = {r.presalesorderid_ps: r.acl_id_int for r in tables.read(spec.target).collect()}
        assert len(rows) == 9 and rows[f"key{day}"] == f"{day}{day}"
    Runner(tables, tables, Options(refresh="merge", buckets=2)).run(spec)
    assert {r[BUCKET].split("-")[0] for r in tables.read(spec.target).collect()} == {"2"}


def test_run_all_stops_at_the_first_failure(tables):
    start(tables, jobs.VVM_AREA, jobs.NVT_AREA)
    land(tables, AREA, "1", [("1", "20200101000000", {"number": 1})])
    land(tables, "DigiOSS - NvtArea", "1", [("2", "20200103000000", {"businessId": 2})])
    results = Runner(tables, tables).run_all([jobs.VVM_AREA, jobs.NVT_AREA], upto="20200102000000")
    assert [(r.process, r.rows) for r in results] == [("proc_f_vvmarea", 1), ("proc_f_nvtarea", 0)]
    results = Runner(tables, tables, Options(rebalance=True)).run_all([jobs.VVM_AREA, jobs.NVT_AREA])
    assert [r.rows for r in results] == [0, 1]


def test_order_of_the_daily_run():
    assert [s.process for s in jobs.DAILY] == [
        "proc_f_pso_latestversion",
        "proc_f_vvmarea",
        "proc_f_fiberavailabilitycheck_v1",
        "proc_f_fiberavailabilitycheck_v2",
        "proc_f_serviceorder_event",
        "proc_f_cio",
        "proc_f_nvtarea",
        "proc_f_kls_event",
        "proc_f_fiberonlocation",
        "proc_f_workorderevent",
        "proc_f_presalesorder",
    ]
