"""Tag documents: made from order lines, then read, cleaned and checked."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import coerce
from tidemark.operators.reports import dq_report
from tidemark.plans import industrial
from tidemark.plans.contracts import CONTRACTS
from tidemark.sources import documents
from workload.inputs import dealt_out, table

# One document per order line. Supplier, part and order stand in for tag,
# equipment and location. The defects follow from the line's own values.
_FIELDS = {
    "tag_id": "'TAG-' || lpad(CAST(l_suppkey AS {text}), 5, '0')",
    "equipment_id": "'EQ-' || lpad(CAST(l_partkey AS {text}), 4, '0')",
    "location_id": "'LOC-000' || CAST(l_linenumber AS {text})",
    "measurement_id": "'MEAS-' || lpad(upper({hex}), 12, '0')",
    # Every seventh part has equipment without a name.
    "equipment_name": "CASE WHEN l_partkey % 7 <> 0 THEN 'Part ' || CAST(l_partkey AS {text}) END",
}


def _fields(**kw) -> dict[str, str]:
    return {name: sql.format(**kw) for name, sql in _FIELDS.items()}


def tag_documents(spark, d):
    """Raw envelopes: ``tag_id, source_name, ingested_at, data``."""
    f = {
        k: F.expr(v)
        for k, v in _fields(text="string", hex="hex(l_orderkey * 8 + l_linenumber)").items()
    }
    flag = F.col("l_returnflag")
    stamp = (
        F.when(flag == "R", F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"))
        .when(flag == "A", F.date_format("l_shipdate", "MM/dd/yyyy HH:mm:ss"))
        .otherwise(F.date_format("l_shipdate", "yyyyMMddHHmmss"))
    )
    number = F.col("l_extendedprice").cast("string")
    value = (
        F.when(F.col("l_quantity") == 7, "null")
        .when(F.col("l_quantity") == 9, '"n/a"')
        .when(F.col("l_linestatus") == "F", F.concat(F.lit('"'), number, F.lit('"')))
        .otherwise(number)
    )

    def measurement(value, quality, extra):
        return F.concat(
            F.lit('{"MeasurementID": "'), f["measurement_id"],
            F.lit('", "TagID": "'), f["tag_id"],
            F.lit('", "Timestamp": "'), stamp,
            F.lit('", "Value": '), value,
            F.lit(', "QualityFlag": "'), quality, F.lit('"'), extra, F.lit("}"),
        )

    extra = F.when(F.col("l_discount") == 0.1, ', "SensorFirmwareVersion": "v1.2"').otherwise("")
    first = measurement(
        value, F.when(F.col("l_tax") == 0.08, "Bad (revised)").otherwise("Good"), extra
    )
    copy = measurement((F.col("l_extendedprice") + 1).cast("string"), F.lit("Uncertain"), F.lit(""))
    # Written out: to_json takes as long as the rest of a line's work. Only an equipment's id
    # and name may be missing from a record: without any other field there is no document.
    equipment = F.coalesce(F.concat(F.lit('"EquipmentID":"'), f["equipment_id"], F.lit('",')), F.lit(""))
    name = F.coalesce(F.concat(F.lit('"EquipmentName":"'), f["equipment_name"], F.lit('",')), F.lit(""))
    masters = F.concat(
        F.lit('{"tag":{"TagID":"'), f["tag_id"],
        F.lit('","TagName":"flow","Description":"flow meter","UnitOfMeasure":"m3",'), equipment,
        F.lit('"LocationID":"'), f["location_id"], F.lit('"},"equipment":{'), equipment, name,
        F.lit('"EquipmentType":"meter","Manufacturer":"maker","InstallDate":"'),
        F.date_format("l_shipdate", "dd-MMM-yyyy"), F.lit('"},"location":{"LocationID":"'), f["location_id"],
        F.lit('","SiteName":"site","Area":"area","GPSCoordinates":"1.5,2.5"'),
    )
    data = F.concat(
        masters, F.lit('}, "measurements": ['),
        first,
        F.when(F.col("l_discount") > 0.05, F.concat(F.lit(", "), copy)).otherwise(""),
        # Lines sold without tax lost the end of their document on the way.
        F.when(F.col("l_tax") == 0, "]").otherwise("]}"),
    )
    # The table may be a single row group; its rows are dealt out as a raw zone's files would be.
    return dealt_out(table(spark, d, "lineitem"), "l_orderkey").select(
        f["tag_id"].alias("tag_id"),
        F.lit("lines").alias("source_name"),
        F.expr(
            "l_shipdate + INTERVAL '1' SECOND * l_partkey + INTERVAL '0.000001' SECOND * l_suppkey"
        ).cast("timestamp").alias("ingested_at"),
        data.alias("data"),
    )


_SQL = _fields(text="VARCHAR", hex="printf('%x', l_orderkey * 8 + l_linenumber)")
# Readable documents, with the fields of their records.
_LINES = f"""(SELECT {', '.join(f'{sql} AS {name}' for name, sql in _SQL.items())},
  l_shipdate + to_seconds(l_partkey) + to_microseconds(l_suppkey) AS ingested_at,
  l_shipdate, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem WHERE l_tax <> 0)"""
_MEASUREMENTS = f"""(SELECT measurement_id, tag_id, l_shipdate AS "timestamp",
    CASE WHEN l_quantity NOT IN (7, 9) THEN l_extendedprice END AS value,
    CASE WHEN l_tax = 0.08 THEN 'Bad (revised)' ELSE 'Good' END AS quality_flag,
    0 AS pos, ingested_at, concat_ws(',',
      CASE l_quantity WHEN 7 THEN 'null:value' WHEN 9 THEN 'type:value' END,
      CASE WHEN l_tax = 0.08 THEN 'domain:quality_flag' END) AS reasons
  FROM {_LINES}
  UNION ALL SELECT measurement_id, tag_id, l_shipdate, l_extendedprice + 1, 'Uncertain', 1,
    ingested_at, '' FROM {_LINES} WHERE l_discount > 0.05)"""
_BEST = f"""(SELECT *, row_number() OVER (PARTITION BY measurement_id
  ORDER BY reasons = '' DESC, ingested_at DESC, pos) AS rn FROM {_MEASUREMENTS})"""
_EQUIPMENT = f"""(SELECT equipment_id, equipment_name, 'meter' AS equipment_type,
  'maker' AS manufacturer, CAST(l_shipdate AS DATE) AS install_date FROM {_LINES}
  QUALIFY row_number() OVER (PARTITION BY equipment_id
    ORDER BY equipment_name IS NOT NULL DESC, ingested_at DESC) = 1)"""
_TAG = f"""(SELECT tag_id, 'flow' AS tag_name, 'flow meter' AS description,
  'm3' AS unit_of_measure, equipment_id, location_id FROM {_LINES}
  QUALIFY row_number() OVER (PARTITION BY tag_id ORDER BY ingested_at DESC) = 1)"""


def parsed(spark, d):
    return documents.parse_tag_document(tag_documents(spark, d))


def explode_documents(spark, d):
    return documents.explode_child(parsed(spark, d), "measurements").select(
        "tag_id",
        "pos",
        F.try_variant_get("record", "$.MeasurementID", "string").alias("measurement_id"),
        F.try_variant_get("record", "$.QualityFlag", "string").alias("quality_flag"),
    )


def explode_all_tables(spark, d):
    records = documents.explode_all(parsed(spark, d))
    return records.groupBy("table").agg(F.count(F.lit(1)).alias("n"))


def child_record_counts(spark, d):
    counts = documents.child_record_counts(parsed(spark, d), keep=("tag_id", "doc"))
    return counts.groupBy("tag_id", "child_records").agg(F.count(F.lit(1)).alias("n"))


def malformed_documents(spark, d):
    bad = industrial.unreadable(tag_documents(spark, d))
    return bad.select(
        "tag_id",
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"),
        F.concat_ws(",", "reasons").alias("reasons"),
    )


def _records(spark, d, *tables):
    return industrial.stage_records(tag_documents(spark, d), tables)


def _measurements(spark, d):
    return industrial.clean_table(_records(spark, d, "measurement"), CONTRACTS["measurement"])


def clean_measurement_valid(spark, d):
    return coerce.project_contract(_measurements(spark, d).valid, CONTRACTS["measurement"])


def clean_measurement_bad(spark, d):
    bad = _measurements(spark, d).bad
    return bad.select(
        *CONTRACTS["measurement"].names, "pos", F.concat_ws(",", "reasons").alias("reasons")
    )


def clean_measurement_duplicates(spark, d):
    repeats = _measurements(spark, d).duplicates
    return repeats.select(
        "measurement_id", "pos", "quality_flag", F.concat_ws(",", "reasons").alias("reasons")
    )


def clean_equipment(spark, d):
    cleaned = industrial.clean_table(_records(spark, d, "equipment"), CONTRACTS["equipment"])
    return coerce.project_contract(cleaned.valid, CONTRACTS["equipment"])


def clean_tag(spark, d):
    cleaned = industrial.clean_table(_records(spark, d, "tag"), CONTRACTS["tag"])
    return coerce.project_contract(cleaned.valid, CONTRACTS["tag"])


def _tables(spark, d):
    tables = ("equipment", "location", "tag", "measurement")
    records = _records(spark, d, *tables)
    valid = industrial.valid_tables(
        {t: industrial.clean_table(records, CONTRACTS[t]) for t in tables}
    )
    return industrial.settle_tables(valid, records)


def tag_fk_report(spark, d):
    return industrial.tag_fk_report(_tables(spark, d))


def tag_enrich(spark, d):
    tables = _tables(spark, d)
    wide = industrial.enrich_tag_fact(tables["measurement"], tables)
    return wide.select("measurement_id", "tag_id", "value", "equipment_name", "site_name")


def table_quality(spark, d):
    """Passed, failed and broken rules of all records of two tables."""
    tables = ("measurement", "equipment")
    records = _records(spark, d, *tables)
    checked = [
        industrial.check_table(records, CONTRACTS[t]).select(F.lit(t).alias("table"), "reasons")
        for t in tables
    ]
    return dq_report(checked[0].unionByName(checked[1]))


def unexpected_columns(spark, d):
    expected = {t: c.sources for t, c in CONTRACTS.items()}
    records = documents.explode_all(parsed(spark, d))
    return coerce.extra_columns_profile(records, expected, table="table")


def envelope_round_trip(spark, d):
    contract = CONTRACTS["measurement"]
    valid = _measurements(spark, d).valid
    return industrial.from_envelope(industrial.to_envelope(valid, contract, "cleaned"), contract)


_MEASUREMENT_NAMES = 'measurement_id, tag_id, "timestamp", value, quality_flag'

QUERIES = {
    "explode_documents": (
        explode_documents,
        f"SELECT tag_id, CAST(pos AS INTEGER) AS pos, measurement_id, quality_flag FROM {_MEASUREMENTS}",
    ),
    "explode_all_tables": (
        explode_all_tables,
        f"""SELECT 'measurement' AS "table", count(*) AS n FROM {_MEASUREMENTS} UNION ALL
          SELECT unnest(['tag', 'equipment', 'location']), count(*) FROM {_LINES}""",
    ),
    "child_record_counts": (
        child_record_counts,
        """SELECT 'TAG-' || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS tag_id,
          CASE WHEN l_tax = 0 THEN 0 WHEN l_discount > 0.05 THEN 2 ELSE 1 END AS child_records,
          count(*) AS n FROM lineitem GROUP BY 1, 2""",
    ),
    "malformed_documents": (
        malformed_documents,
        """SELECT 'TAG-' || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS tag_id,
          l_shipdate + to_seconds(l_partkey) + to_microseconds(l_suppkey) AS ingested_at,
          'malformed:data' AS reasons FROM lineitem WHERE l_tax = 0""",
    ),
    "clean_measurement_valid": (
        clean_measurement_valid,
        f"SELECT {_MEASUREMENT_NAMES} FROM {_BEST} WHERE rn = 1 AND reasons = ''",
    ),
    "clean_measurement_bad": (
        clean_measurement_bad,
        f"""SELECT {_MEASUREMENT_NAMES}, CAST(pos AS INTEGER) AS pos, reasons FROM {_BEST}
          WHERE rn = 1 AND reasons <> ''""",
    ),
    "clean_measurement_duplicates": (
        clean_measurement_duplicates,
        f"""SELECT measurement_id, CAST(pos AS INTEGER) AS pos, quality_flag, reasons
          FROM {_BEST} WHERE rn > 1""",
    ),
    "clean_equipment": (
        clean_equipment,
        f"SELECT * FROM {_EQUIPMENT} WHERE equipment_name IS NOT NULL",
    ),
    "clean_tag": (clean_tag, f"SELECT * FROM {_TAG}"),
    "tag_fk_report": (
        tag_fk_report,
        f"""SELECT 'tag.equipment_id' AS child, 'equipment.equipment_id' AS parent,
            count(DISTINCT equipment_id) AS orphan_keys, count(*) AS orphan_rows FROM {_TAG}
            WHERE equipment_id NOT IN
              (SELECT equipment_id FROM {_EQUIPMENT} WHERE equipment_name IS NOT NULL)
          UNION ALL SELECT 'tag.location_id', 'location.location_id', 0, 0
          UNION ALL SELECT 'measurement.tag_id', 'tag.tag_id', 0, 0""",
    ),
    "tag_enrich": (
        tag_enrich,
        f"""SELECT m.measurement_id, m.tag_id, m.value, e.equipment_name, 'site' AS site_name
          FROM {_BEST} m LEFT JOIN {_TAG} t ON t.tag_id = m.tag_id
          LEFT JOIN (SELECT * FROM {_EQUIPMENT} WHERE equipment_name IS NOT NULL) e
            ON e.equipment_id = t.equipment_id
          WHERE m.rn = 1 AND m.reasons = ''""",
    ),
    "table_quality": (
        table_quality,
        f"""SELECT "table", rule, count(*) AS n FROM (
          SELECT 'measurement' AS "table",
            unnest(['rows', CASE WHEN reasons = '' THEN 'passed' ELSE 'failed' END]) AS rule
            FROM {_MEASUREMENTS}
          UNION ALL SELECT 'measurement', unnest(string_split(reasons, ','))
            FROM {_MEASUREMENTS} WHERE reasons <> ''
          UNION ALL SELECT 'equipment', unnest(['rows',
            CASE WHEN equipment_name IS NULL THEN 'failed' ELSE 'passed' END]) FROM {_LINES}
          UNION ALL SELECT 'equipment', 'null:equipment_name' FROM {_LINES}
            WHERE equipment_name IS NULL) GROUP BY 1, 2""",
    ),
    "unexpected_columns": (
        unexpected_columns,
        f"""SELECT 'measurement' AS "table", 'SensorFirmwareVersion' AS "column", count(*) AS n
          FROM {_LINES} WHERE l_discount = 0.1""",
    ),
    "envelope_round_trip": (
        envelope_round_trip,
        f"SELECT {_MEASUREMENT_NAMES} FROM {_BEST} WHERE rn = 1 AND reasons = ''",
    ),
}
