"""Hand-made documents with one of every defect, through to the thirteen tables."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.coerce import capture_extras, coerce_table, extra_columns_profile
from tidemark.plans import industrial
from tidemark.plans.contracts import CONTRACTS, FK_EDGES, MASTER_KEYS, TARGET_OF, target_of
from tidemark.sources import documents
from tidemark.sources.zones import ZONES, read_raw, read_zone, zone_schema
from tidemark.sinks.zones import write_zone

TAG, HEX = "TAG-00001", "0123456789A"


def m(n, **kw):
    record = {
        "MeasurementID": f"MEAS-{HEX}{n}",
        "TagID": TAG,
        "Timestamp": "2026-01-31T10:00:00",
        "Value": 12.5,
        "QualityFlag": "Good",
    }
    record.update(kw)
    return {k: v for k, v in record.items() if v is not Ellipsis}


MEASUREMENTS = [
    m(0),
    m(1, Value="12.5"),
    m(2, Timestamp="01/31/2026 10:00:00"),
    m(3, Timestamp="31-Jan-2026 10:00"),
    m(4, Timestamp="20260131100000"),
    m(5, Value=None),
    m(6, QualityFlag=...),
    m(7, Value="a lot"),
    m(8, SensorFirmwareVersion="v1.2", CalibrationOffset=0.1),
    m(9, QualityFlag="Good (revised)"),
    m("X", Value=1.0),
    {"TagID": TAG, "Value": 1},
    m("A", Value=None),
    # Copies come after the originals.
    m(0),
    m(1, Value=12.5, Timestamp="20260131100000"),
    m(2, Value=17.0),
    m("A", Value=99),
    m(6, QualityFlag=None),
    {"TagID": TAG, "Value": 2},
]


def document(**changes):
    doc = {
        "tag": {
            "TagID": TAG,
            "TagName": "flow",
            "Description": "flow meter",
            "UnitOfMeasure": "m3",
            "EquipmentID": "EQ-0001",
            "LocationID": "LOC-0009",
        },
        "equipment": {
            "EquipmentID": "EQ-0001",
            "EquipmentName": "pump",
            "EquipmentType": "rotating",
            "Manufacturer": "maker",
            "InstallDate": "31-Jan-2020",
        },
        "location": {
            "LocationID": "LOC-0001",
            "SiteName": "site",
            "Area": "north",
            "GPSCoordinates": "1.0,2.0",
        },
        "customer": {
            "CustomerID": "CUST-0001",
            "CustomerName": "buyer",
            "Industry": "energy",
            "ContactInfo": "a@b.c",
            "Region": "west",
        },
        "measurements": MEASUREMENTS,
        "alarms": [
            {
                "AlarmID": f"ALM-{HEX}0",
                "TagID": TAG,
                "AlarmType": "HighHigh",
                "ThresholdValue": "55.5",
                "Timestamp": "2026-01-31T10:00:00.250000",
                "Status": "Active",
            }
        ],
        "maintenance": [
            {
                "MaintenanceID": f"MNT-{HEX}{i}",
                "TagID": TAG,
                "WorkOrderID": work_order,
                "MaintenanceDate": "20260131",
                "ActionTaken": "cleaned",
                "Technician": "someone",
            }
            for i, work_order in enumerate(["WO-12345", "WO-12345 (revised)", "W" * 21])
        ],
        "events": [
            {
                "EventID": f"EVT-{HEX}0",
                "TagID": TAG,
                "EventType": "ModeChange",
                "Timestamp": "2026-01-31T10:00:00",
                "Notes": "auto to manual",
            }
        ],
        "contracts": [
            {
                "ContractID": f"CTR-{HEX}{i}",
                "CustomerID": "CUST-0001",
                "TagID": TAG,
                "ContractStartDate": "2026-01-31",
                "ContractEndDate": end,
                "ContractVolume": 1000.0,
                "PricePerUnit": 2.5,
            }
            for i, end in enumerate(["2028-01-31", "2025-01-31", "01/31/2028"])
        ],
        "billing": [
            {
                "BillingID": f"BIL-{HEX}{i}",
                "TagID": TAG,
                "CustomerID": "CUST-0002",
                "BillingPeriod": period,
                "ConsumptionVolume": 500,
                "TotalAmount": 900.5,
                "PaymentStatus": "Paid",
            }
            for i, period in enumerate(["2026-01", "2026-13", "2026-01 (revised)"])
        ],
        "inventory": [
            {
                "InventoryID": f"INV-{HEX}{i}",
                "TagID": TAG,
                "MaterialType": "Gasket Kit",
                "Quantity": quantity,
                "StorageLocation": "Field Cabinet 3",
                "LastUpdated": "31-Jan-2026 10:00",
            }
            for i, quantity in enumerate([5, "5", 5.5, -1])
        ],
        "regulatory_compliance": [
            {
                "ComplianceID": f"CMP-{HEX}0",
                "TagID": TAG,
                "RegulationName": "NFPA 30",
                "InspectionDate": "01/31/2026",
                "Status": "Pending Review",
                "Inspector": "someone",
            }
        ],
        "financial_forecasts": [
            {
                "ForecastID": f"FRC-{HEX}{i}",
                "TagID": TAG,
                "ForecastDate": "2026-07-01",
                "ExpectedConsumption": "1000",
                "ExpectedRevenue": 5000.0,
                "RiskFactor": risk,
            }
            for i, risk in enumerate([0.5, 1.5])
        ],
    }
    doc.update(changes)
    return doc


def envelopes(spark, *datas, start=dt.datetime(2026, 2, 1)):
    return spark.createDataFrame(
        [
            (TAG, "source", start + dt.timedelta(hours=6 * i), d if isinstance(d, str) else json.dumps(d))
            for i, d in enumerate(datas)
        ],
        zone_schema("raw"),
    )


@pytest.fixture(scope="module")
def cleaned(spark):
    return industrial.clean_documents(envelopes(spark, document(), "{broken", "[1]", '"text"'))


def reasons_by(df, key):
    return {r[key][-1] if r[key] else None: sorted(r.reasons) for r in df.collect()}


def test_every_row_is_accounted_for(cleaned):
    doc = document()
    for key, table in TARGET_OF.items():
        n = 1 if key in MASTER_KEYS else len(doc[key])
        c = cleaned[table]
        assert c.valid.count() + c.bad.count() + c.duplicates.count() == n, table


def test_measurements(cleaned):
    c = cleaned["measurement"]
    valid = {r.measurement_id[-1]: r for r in c.valid.collect()}
    assert set(valid) == set("012348A")
    at = dt.datetime(2026, 1, 31, 10)
    assert {r.timestamp for r in valid.values()} == {at}
    # Originals stay, unless only the copy is valid.
    assert valid["2"].value == 12.5 and valid["A"].value == 99.0
    assert valid["8"]._extra == {"SensorFirmwareVersion": "v1.2", "CalibrationOffset": "0.1"}
    bad = c.bad.filter("measurement_id is not null")
    assert reasons_by(bad, "measurement_id") == {
        "5": ["null:value"],
        "6": ["null:quality_flag"],
        "7": ["type:value"],
        "9": ["domain:quality_flag"],
        "X": ["format:measurement_id"],
    }
    assert bad.filter("measurement_id like '%7'").first()._sent["Value"] == "a lot"
    # Rows without a key are no copies of each other.
    keyless = c.bad.filter("measurement_id is null").collect()
    assert len(keyless) == 2 and all("null:measurement_id" in r.reasons for r in keyless)
    assert c.duplicates.count() == 5


def test_other_tables(cleaned):
    def valid(table):
        return [r.asDict() for r in cleaned[table].valid.select(*CONTRACTS[table].names).collect()]

    def bad(table):
        return reasons_by(cleaned[table].bad, CONTRACTS[table].key)

    assert valid("equipment")[0]["install_date"] == dt.date(2020, 1, 31)
    assert valid("location")[0]["gps_coordinates"] == "1.0,2.0"
    assert valid("alarm")[0]["threshold_value"] == 55.5
    assert valid("alarm")[0]["timestamp"] == dt.datetime(2026, 1, 31, 10, 0, 0, 250000)
    assert bad("maintenance") == {
        "1": ["format:work_order_id"],
        "2": ["format:work_order_id", "length:work_order_id"],
    }
    assert bad("customer_contract") == {"1": ["range:contract_days"]}
    assert bad("billing") == {
        "1": ["format:billing_period"],
        "2": ["format:billing_period", "length:billing_period"],
    }
    assert bad("inventory") == {"2": ["type:quantity"], "3": ["range:quantity"]}
    assert sorted(r["quantity"] for r in valid("inventory")) == [5, 5]
    assert bad("financial_forecast") == {"1": ["range:risk_factor"]}
    assert valid("regulatory_compliance")[0]["inspection_date"] == dt.date(2026, 1, 31)
    for table in ("tag", "customer", "event"):
        assert len(valid(table)) == 1 and not bad(table)


def test_relationships_and_enrichment(cleaned):
    tables = industrial.valid_tables(cleaned)
    report = {(r.child, r.parent): r.orphan_rows for r in industrial.tag_fk_report(tables).collect()}
    assert len(report) == len(FK_EDGES) == 13
    assert {edge for edge, n in report.items() if n} == {
        ("tag.location_id", "location.location_id"),
        ("billing.customer_id", "customer.customer_id"),
    }
    wide = industrial.enrich_tag_fact(tables["customer_contract"], tables)
    assert {(r.equipment_name, r.site_name, r.customer_name) for r in wide.collect()} == {
        ("pump", None, "buyer")
    }


def test_unreadable_documents(spark):
    raw = envelopes(spark, document(), "{broken", "[1]", '"text"', "")
    bad = industrial.unreadable(raw)
    assert sorted(r.data for r in bad.collect()) == ["", '"text"', "[1]", "{broken"]
    assert {tuple(r.reasons) for r in bad.collect()} == {("malformed:data",)}


def test_latest_document_wins(spark):
    later = document(measurements=[m(0, Value=77.0), m(5, Value=5)])
    c = industrial.clean_documents(envelopes(spark, document(), later))["measurement"]
    got = {r.measurement_id[-1]: r.value for r in c.valid.collect()}
    assert got["0"] == 77.0 and got["5"] == 5.0


def test_missing_and_malformed_children(spark):
    parsed = documents.parse_tag_document(
        envelopes(spark, {"measurements": [m(0), m(1)], "alarms": None, "events": "none", "tag": {}})
    )
    assert documents.child_record_counts(parsed).first().child_records == 2
    assert documents.explode_child(parsed, "alarms").count() == 0
    assert documents.explode_child(parsed, "forecasts").count() == 0
    assert [r.pos for r in documents.explode_child(parsed, "measurements").collect()] == [0, 1]
    counts = documents.explode_all(parsed).groupBy("table").count()
    assert dict(rows(counts)) == {"measurement": 2, "tag": 1}
    # What no table can take is reported with its envelope.
    assert [r.reasons for r in documents.malformed(parsed).collect()] == [["malformed:events"]]
    other = documents.parse_tag_document(envelopes(spark, {"measurements": {"MeasurementID": "x"}, "tag": ["t"]}))
    assert sorted(documents.malformed(other).first().reasons) == ["malformed:measurements", "malformed:tag"]


def test_one_pass_agrees_with_one_table_at_a_time(spark):
    parsed = documents.parse_tag_document(envelopes(spark, document(), document()))
    every = documents.explode_all(parsed).withColumn("record", F.to_json("record"))
    for key, table in TARGET_OF.items():
        one = documents.explode_child(parsed, key).withColumn("record", F.to_json("record"))
        assert rows(every.filter(F.col("table") == table).drop("table")) == rows(one)


def test_unexpected_columns(spark):
    parsed = documents.parse_tag_document(envelopes(spark, document()))
    records = documents.explode_child(parsed, "measurements")
    expected = CONTRACTS["measurement"].sources
    profile = extra_columns_profile(records, expected, table="measurement")
    assert rows(profile) == [
        ("measurement", "CalibrationOffset", 1),
        ("measurement", "SensorFirmwareVersion", 1),
    ]
    extras = capture_extras(records, expected).filter("_extra is not null").collect()
    assert [r._extra["CalibrationOffset"] for r in extras] == ["0.1"]
    typed = coerce_table(records, CONTRACTS["measurement"])
    assert set(CONTRACTS["measurement"].names) <= set(typed.columns)


def test_names():
    assert target_of("forecasts") == "financial_forecast"
    assert target_of("compliance") == target_of("regulatory_compliance")
    assert CONTRACTS["measurement"].key == "measurement_id"
    assert CONTRACTS["tag"].names[:2] == ["tag_id", "tag_name"]
    assert {c for e in FK_EDGES for c in (e[0], e[2])} <= set(CONTRACTS)


def test_zones_round_trip(spark, tmp_path, cleaned):
    raw = envelopes(spark, document())
    write_zone(raw, "raw", f"{tmp_path}/raw")
    assert rows(read_raw(spark, f"{tmp_path}/raw")) == rows(raw)
    contract = CONTRACTS["measurement"]
    valid = cleaned["measurement"].valid.select(*contract.names)
    for zone in ("cleaned", "validated"):
        envelope = industrial.to_envelope(valid, contract, zone)
        assert envelope.columns == ["tag_id", "source_name", ZONES[zone][1], "data"]
        write_zone(envelope, zone, f"{tmp_path}/{zone}")
        back = industrial.from_envelope(read_zone(spark, zone, f"{tmp_path}/{zone}"), contract)
        assert rows(back) == rows(valid)


def test_save_and_reload(spark, tmp_path, cleaned):
    out = str(tmp_path / "zones")
    industrial.save_cleaned(cleaned, out)
    for _ in range(2):
        names = industrial.load_validated(spark, out, "tag_store", str(tmp_path / "store"))
    assert len(names) == 13
    for name in names:
        table = name.split(".")[1]
        got = spark.table(name)
        assert got.columns == [*CONTRACTS[table].names, "_loaded_at"]
        assert got.count() == cleaned[table].valid.count()
    bad = spark.read.parquet(f"{out}/bad/measurement")
    assert bad.count() == cleaned["measurement"].bad.count()


def one_document(spark, **lists):
    data = json.dumps(lists)
    return spark.createDataFrame([("TAG-00001", "s", data)], "tag_id string, source_name string, data string").withColumn(
        "ingested_at", F.lit("2026-02-01").cast("timestamp")
    )


def test_records_that_are_no_objects_keep_what_was_sent(spark):
    raw = one_document(spark, measurements=[1, "x", None, [2, 3], {"MeasurementID": "m"}])
    cleaned = industrial.clean_documents(raw)["measurement"]
    got = {r.pos: r for r in cleaned.bad.collect()}
    assert len(got) == 5 and cleaned.valid.isEmpty() and cleaned.duplicates.isEmpty()
    sent = {0: "1", 1: '"x"', 3: "[2,3]"}
    for pos, text in sent.items():
        assert got[pos]["_sent"] == {"(record)": text} and "malformed:record" in got[pos].reasons and got[pos]["_extra"] is None
    assert "malformed:record" not in got[4].reasons and got[4]["_sent"] == {"MeasurementID": "m"}


def test_domains_and_revised_text(spark):
    one = {"TagID": "TAG-00001", "Quantity": 1, "LastUpdated": "2026-01-01 00:00:00"}
    raw = one_document(
        spark,
        inventory=[
            {**one, "InventoryID": "INV-00000000000A", "MaterialType": "Gold", "StorageLocation": "Warehouse B-05"},
            {**one, "InventoryID": "INV-00000000000B", "MaterialType": "Lubricant", "StorageLocation": "Warehouse B-05 (revised)"},
        ],
        regulatory_compliance=[
            {"ComplianceID": "CMP-00000000000A", "TagID": "TAG-00001", "RegulationName": "API 570 (revised)",
             "InspectionDate": "2026-01-01", "Status": "Exempted", "Inspector": "me (revised)"},
        ],
    )
    cleaned = industrial.clean_documents(raw)
    reasons = lambda t: sorted(tuple(r.reasons) for r in cleaned[t].bad.collect())
    assert reasons("inventory") == [("domain:material_type",), ("domain:storage_location",)]
    assert reasons("regulatory_compliance") == [("domain:regulation_name", "revised:inspector")]


def test_a_batch_is_audited_while_it_is_written(spark, tmp_path):
    raw = one_document(spark, measurements=[1, {"MeasurementID": "MEAS-00000000000A", "TagID": "TAG-00001", "Timestamp": "2026-01-01 00:00:00", "Value": 1, "QualityFlag": "Good"}] * 2)
    raw = raw.unionByName(raw.withColumn("data", F.lit("no document")))
    audit = {r.table: r for r in industrial.run_batch(raw, str(tmp_path), "b7").collect()}
    assert tuple(audit["measurement"])[2:] == ("complete", 4, 1, 2, 1) and len(audit) == 13
    assert all(r.status == "complete" and r.batch_id == "b7" for r in audit.values())
    assert spark.read.parquet(f"{tmp_path}/audit").count() == 13
    cleaned = spark.read.schema(zone_schema("cleaned")).json(f"{tmp_path}/cleaned/measurement")
    assert cleaned.count() == 4 and cleaned.filter("data like '%MEAS-%'").count() == 2
    assert spark.read.json(f"{tmp_path}/bad/documents").count() == 1


LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
    " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
)


def test_documents_of_lines_are_written_without_a_json_writer(spark, tmp_path):
    from workload.documents import tag_documents

    day = dt.datetime(1995, 2, 3)
    line = lambda order, part, supplier, shipped=day: (order, part, supplier, 2, 3.0, 10.5, 0.0, 0.02, "R", "O", shipped)
    lines = [line(1, 8, 5), line(2, 14, 5), line(3, None, 5), line(4, 8, None), line(5, 8, 5, None), line(None, 8, 5)]
    spark.createDataFrame(lines, LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    made = tag_documents(spark, str(tmp_path))
    # A generic writer of each line's records took half of the time of the whole job.
    assert "structstojson" not in made._jdf.queryExecution().optimizedPlan().toString().lower()

    def document(order, equipment):
        return {
            "tag": {"TagID": "TAG-00005", "TagName": "flow", "Description": "flow meter", "UnitOfMeasure": "m3",
                    **{k: v for k, v in equipment.items() if k == "EquipmentID"}, "LocationID": "LOC-0002"},
            "equipment": {**equipment, "EquipmentType": "meter", "Manufacturer": "maker", "InstallDate": "03-Feb-1995"},
            "location": {"LocationID": "LOC-0002", "SiteName": "site", "Area": "area", "GPSCoordinates": "1.5,2.5"},
            "measurements": [{"MeasurementID": f"MEAS-{order * 8 + 2:012X}", "TagID": "TAG-00005",
                              "Timestamp": "1995-02-03T00:00:00", "Value": 10.5, "QualityFlag": "Good"}],
        }

    texts = [r.data for r in made.collect()]
    assert texts.count(None) == 3
    got = sorted((json.loads(t) for t in texts if t), key=lambda x: x["measurements"][0]["MeasurementID"])
    assert got == [
        document(1, {"EquipmentID": "EQ-0008", "EquipmentName": "Part 8"}),
        document(2, {"EquipmentID": "EQ-0014"}),
        document(3, {}),
    ]
    assert [list(x["equipment"])[:2] for x in got][0] == ["EquipmentID", "EquipmentName"]


def test_texts_are_looked_at_without_a_pattern(spark):
    texts = ['{"a": 1}', ' \t\n\x0b\f\r{"a": 1}', '\u00a0{"a": 1}', "[{}]", "", "  ", None, ' \n{"a": ', "x{}"]
    parsed = documents.parse_tag_document(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, data string"))
    assert "rlike" not in parsed._jdf.queryExecution().optimizedPlan().toString().lower()
    # JSON itself knows no vertical tab or form feed: the second starts like an object and is none.
    assert [r.k for r in parsed.filter("doc IS NOT NULL").orderBy("k").collect()] == [0]
    assert parsed.filter("k = 0").select(F.try_variant_get("doc", "$.a", "int")).first()[0] == 1
    spaced = spark.createDataFrame([(" \t\r\n{}",)], "data string")
    assert documents.parse_tag_document(spaced).filter("doc IS NOT NULL").count() == 1
