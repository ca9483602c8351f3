"""Documents with all thirteen tables: made from order lines, then cleaned, audited and checked for lost parents.

A document stands for a supplier and a line number. It has four master records, and the
lines dealt to nine arrays by their quantity, so some arrays have hundreds of records. The
defects follow from the values of the lines.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import coerce
from tidemark.plans import industrial
from tidemark.plans.contracts import CONTRACTS, FK_EDGES, TARGET_OF
from tidemark.session import drop_written, shared_dir, sparing_disk, write_through
from workload.inputs import table

_TAG = "'TAG-' || lpad(CAST(l_suppkey AS {text}), 5, '0')"
_EQUIPMENT = "'EQ-' || lpad(CAST(l_suppkey % 10000 AS {text}), 4, '0')"
_LOCATION = "'LOC-' || lpad(CAST(l_suppkey % 500 AS {text}), 4, '0')"
_CUSTOMER = "'CUST-' || lpad(CAST({} % 10000 AS {{text}}), 4, '0')"
_ID = "'{}-' || lpad(upper({{hex}}), 12, '0')"


def _pick(values: list[str], by: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {by} % {len(values)} {cases} END"


# Of each table: the fields as they are sent, written so that both dialects read them; the
# typed value where it differs from what is sent; and when the rules refuse the row.
_DAY, _TIME = "CAST(CAST(l_shipdate AS DATE) AS {text})", "CAST(l_shipdate AS {text})"
_AS_DAY, _AS_TIME = "CAST(l_shipdate AS DATE)", "l_shipdate"
_PRICE = "CASE WHEN l_linestatus = 'F' THEN CAST(l_extendedprice AS {text}) ELSE 'x' END"
_AS_PRICE = "CASE WHEN l_linestatus = 'F' THEN l_extendedprice END"

MASTERS = {
    "equipment": (
        {"EquipmentID": _EQUIPMENT, "EquipmentName": "CASE WHEN l_suppkey % 5 <> 1 THEN 'pump' END",
         "EquipmentType": "'meter'", "Manufacturer": "'maker'", "InstallDate": "'2020-01-31'"},
        {"InstallDate": "DATE '2020-01-31'"}, "l_suppkey % 5 = 1"),
    "location": (
        {"LocationID": _LOCATION, "SiteName": "CASE WHEN l_suppkey % 7 <> 3 THEN 'site' ELSE 'site (revised)' END",
         "Area": "'north'", "GPSCoordinates": "'1.5,2.5'"},
        {}, "l_suppkey % 7 = 3"),
    "customer": (
        {"CustomerID": _CUSTOMER.format("l_suppkey"), "CustomerName": "'name'", "Industry": "'oil'",
         "ContactInfo": "CASE WHEN l_suppkey % 6 <> 2 THEN 'a@b' END", "Region": "'west'"},
        {}, "l_suppkey % 6 = 2"),
    "tag": (
        {"TagID": _TAG, "TagName": "'flow'", "Description": "CASE WHEN l_suppkey % 9 <> 4 THEN 'flow meter' END",
         "UnitOfMeasure": "'m3'", "EquipmentID": _EQUIPMENT, "LocationID": _LOCATION},
        {}, "l_suppkey % 9 = 4"),
}
ARRAYS = {
    "measurement": (
        {"MeasurementID": _ID.format("MEAS"), "TagID": _TAG, "Timestamp": _TIME, "Value": _PRICE, "QualityFlag": "'Good'"},
        {"Timestamp": _AS_TIME, "Value": _AS_PRICE}, "l_linestatus <> 'F'"),
    "alarm": (
        {"AlarmID": _ID.format("ALM"), "TagID": _TAG, "AlarmType": _pick(["High", "LowLow", "Loud"], "l_partkey"),
         "ThresholdValue": "l_discount", "Timestamp": _TIME, "Status": "'Active'"},
        {"Timestamp": _AS_TIME}, "l_partkey % 3 = 2"),
    "maintenance": (
        {"MaintenanceID": _ID.format("MNT"), "TagID": _TAG,
         "WorkOrderID": "CASE WHEN l_partkey % 5 = 0 THEN 'WO-1 (revised)' ELSE 'WO-12345' END", "MaintenanceDate": _DAY,
         "ActionTaken": "CASE WHEN l_returnflag = 'R' THEN 'cleaned (revised)' ELSE 'cleaned' END", "Technician": "'someone'"},
        {"MaintenanceDate": _AS_DAY}, "l_partkey % 5 = 0 OR l_returnflag = 'R'"),
    "event": (
        {"EventID": _ID.format("EVT"), "TagID": _TAG, "EventType": _pick(["ProcessTrip", "ModeChange"], "l_partkey"),
         "Timestamp": "CASE WHEN l_returnflag = 'N' THEN 'some day' ELSE " + _TIME + " END", "Notes": "'all well'"},
        {"Timestamp": "CASE WHEN l_returnflag <> 'N' THEN l_shipdate END"}, "l_returnflag = 'N'"),
    "customer_contract": (
        {"ContractID": _ID.format("CTR"), "CustomerID": _CUSTOMER.format("l_partkey"), "TagID": _TAG,
         "ContractStartDate": "'2020-01-01'", "ContractEndDate": _pick(["2021-06-01", "2020-02-01"], "l_partkey"),
         "ContractVolume": "l_quantity", "PricePerUnit": "CAST(l_extendedprice AS {text})"},
        {"ContractStartDate": "DATE '2020-01-01'", "ContractEndDate": "CAST(" + _pick(["2021-06-01", "2020-02-01"], "l_partkey") + " AS DATE)",
         "PricePerUnit": "l_extendedprice"}, "l_partkey % 2 = 1"),
    "billing": (
        {"BillingID": _ID.format("BIL"), "TagID": _TAG, "CustomerID": _CUSTOMER.format("l_partkey"),
         "BillingPeriod": _pick(["2024-01", "2024-13", "2024-12"], "l_partkey"), "ConsumptionVolume": "l_quantity",
         "TotalAmount": "l_extendedprice", "PaymentStatus": _pick(["Paid", "Overdue"], "l_partkey")},
        {}, "l_partkey % 3 = 1"),
    "inventory": (
        {"InventoryID": _ID.format("INV"), "TagID": _TAG, "MaterialType": _pick(["Gasket Kit", "Lubricant", "Gold"], "l_partkey"),
         "Quantity": "CAST(l_partkey % 9 - 1 AS INT)", "StorageLocation": "'Warehouse B-05'", "LastUpdated": _TIME},
        {"LastUpdated": _AS_TIME}, "l_partkey % 3 = 2 OR l_partkey % 9 = 0"),
    "regulatory_compliance": (
        {"ComplianceID": _ID.format("CMP"), "TagID": _TAG, "RegulationName": _pick(["API 570", "NFPA 30", "API 570 (revised)"], "l_partkey"),
         "InspectionDate": _DAY, "Status": "'Exempted'", "Inspector": "'someone'"},
        {"InspectionDate": _AS_DAY}, "l_partkey % 3 = 2"),
    "financial_forecast": (
        {"ForecastID": _ID.format("FRC"), "TagID": _TAG, "ForecastDate": _DAY, "ExpectedConsumption": "l_quantity",
         "ExpectedRevenue": "l_extendedprice", "RiskFactor": "l_discount * 12"},
        {"ForecastDate": _AS_DAY}, "l_discount * 12 > 1"),
}
_KEYS = {t: k for k, t in TARGET_OF.items()}
_ORDER = ["l_orderkey", "l_partkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_shipdate"]


def plant_documents(spark, d):
    """Raw envelopes with all thirteen tables, and some records that are no objects."""
    dialect = {"text": "string", "hex": "hex(l_orderkey * 8 + l_linenumber)"}

    def record(fields):
        return F.to_json(F.struct(*[F.expr(sql.format(**dialect)).alias(name) for name, sql in fields.items()]))

    # The lines of a document meet before they are made into text, which is several times as long.
    lines = table(spark, d, "lineitem").repartition("l_suppkey", "l_linenumber")
    position = F.struct(*_ORDER)
    arrays = []
    for i, (name, (fields, _, _)) in enumerate(ARRAYS.items()):
        mine = F.when(F.col("l_quantity").cast("int") % 9 == i, F.struct(position.alias("o"), record(fields).alias("r")))
        listed = F.transform(F.array_sort(F.collect_list(mine)), lambda x: x["r"])
        if name == "alarm":
            odd = F.when(F.col("l_suppkey") % 5 == 0, F.array(F.lit("7"), F.lit('"x"'))).otherwise(F.array().cast("array<string>"))
            listed = F.concat(listed, odd)
        arrays.append(F.concat(F.lit(f'"{_KEYS[name]}": ['), F.array_join(listed, ", "), F.lit("]")))
    masters = [F.concat(F.lit(f'"{name}": '), record(fields)) for name, (fields, _, _) in MASTERS.items()]
    return lines.groupBy("l_suppkey", "l_linenumber").agg(F.concat_ws(", ", *arrays).alias("lists")).select(
        F.expr(_TAG.format(**dialect)).alias("tag_id"),
        F.lit("plant").alias("source_name"),
        F.timestamp_seconds(F.col("l_suppkey") * 10 + F.col("l_linenumber")).alias("ingested_at"),
        F.concat(F.lit("{"), F.concat_ws(", ", *masters, "lists"), F.lit("}")).alias("data"),
    )


def _typed(name):
    """Every record of a table in SQL: typed columns, whether the rules refuse it, and its rank among those of its key."""
    dialect = {"text": "VARCHAR", "hex": "printf('%x', l_orderkey * 8 + l_linenumber)"}
    fields, typed, refused = (MASTERS if name in MASTERS else ARRAYS)[name]
    contract = CONTRACTS[name]
    columns = ", ".join(f'{typed.get(f.source, fields[f.source]).format(**dialect)} AS "{f.name}"' for f in contract.fields)
    if name in MASTERS:
        rows, within = "(SELECT DISTINCT l_suppkey, l_linenumber FROM lineitem)", "1"
    else:
        place = list(ARRAYS).index(name)
        rows, within = f"(SELECT * FROM lineitem WHERE CAST(l_quantity AS INT) % 9 = {place})", ", ".join(_ORDER)
    return f"""(SELECT *, row_number() OVER (PARTITION BY "{contract.key}" ORDER BY refused, seen DESC, place) AS rn FROM (
      SELECT {columns}, {refused} AS refused, l_suppkey * 10 + l_linenumber AS seen,
        row_number() OVER (ORDER BY {within}) AS place FROM {rows}))"""


def _valid(name):
    names = ", ".join(f'"{n}"' for n in CONTRACTS[name].names)
    return f"SELECT {names} FROM {_typed(name)} WHERE rn = 1 AND NOT refused"


def _clean(name):
    def query(spark, d):
        records = industrial.stage_records(plant_documents(spark, d), [name])
        cleaned = industrial.clean_table(records, CONTRACTS[name])
        return coerce.project_contract(cleaned.valid, CONTRACTS[name])

    query.__doc__ = f"The valid rows of {name}, from documents with all tables."
    return query


def _landed(spark, d):
    """The documents as files, like those of a raw zone: a batch reads them twice. Few to a file, as they are long."""
    with sparing_disk(spark):
        return write_through(plant_documents(spark, d), "plant", most_rows=2_000)


def _batch(spark, d, out):
    landed = _landed(spark, d)
    return industrial.run_batch(landed, out, "b1", spent=lambda: drop_written(landed))


def pipeline_audit(spark, d):
    """One batch through all zones; what it was and became, by table, as observed while it was written."""
    return _batch(spark, d, shared_dir(spark, "batch")).drop("batch_id")


def pipeline_zone_counts(spark, d):
    """The rows that lie in the zones after a batch."""
    out = shared_dir(spark, "batch")
    _batch(spark, d, out)
    counts = None
    for zone, read in (("cleaned", spark.read.text), ("valid", spark.read.parquet), ("bad", spark.read.parquet), ("duplicates", spark.read.parquet)):
        for t in CONTRACTS:
            one = read(f"{out}/{zone}/{t}").agg(F.count(F.lit(1)).alias("n")).select(F.lit(zone).alias("zone"), F.lit(t).alias("table"), "n")
            counts = one if counts is None else counts.unionByName(one)
    return counts


def _plant_tables(spark, d):
    return industrial.valid_tables(industrial.clean_documents(plant_documents(spark, d)))


def plant_fk_report(spark, d):
    """All thirteen relationships of the valid tables."""
    return industrial.tag_fk_report(_plant_tables(spark, d))


def plant_lost_ancestors(spark, d):
    """Records whose tag is there, but not the tag's equipment or location."""
    return industrial.tag_lost_ancestors(_plant_tables(spark, d))


def _counts(name):
    odd = "(SELECT 2 * count(DISTINCT (l_suppkey, l_linenumber)) FROM lineitem WHERE l_suppkey % 5 = 0)" if name == "alarm" else "0"
    return f"""(SELECT '{name}' AS "table", count(*) AS n, count(*) FILTER (rn = 1 AND NOT refused) AS good,
      count(*) FILTER (rn = 1 AND refused) AS poor, count(*) FILTER (rn > 1) AS again,
      {odd} AS odd FROM {_typed(name)})"""


_ALL_COUNTS = " UNION ALL ".join(f"SELECT * FROM {_counts(t)}" for t in CONTRACTS)


def _fk(edge):
    child, fk, parent, pk = edge
    return f"""SELECT '{child}.{fk}' AS child, '{parent}.{pk}' AS parent, count(DISTINCT {fk}) AS orphan_keys,
      count(*) AS orphan_rows FROM ({_valid(child)}) WHERE {fk} NOT IN (SELECT {pk} FROM ({_valid(parent)}))"""


def _lost(child, lower):
    _, fk, parent, pk = lower
    return f"""SELECT '{child}.tag_id -> tag.{fk} -> {parent}' AS path, count(DISTINCT c.tag_id) AS keys, count(*) AS rows
      FROM ({_valid(child)}) c JOIN ({_valid("tag")}) t ON t.tag_id = c.tag_id
      WHERE t.{fk} NOT IN (SELECT {pk} FROM ({_valid(parent)})) HAVING count(*) > 0"""


_NEW = [t for t in CONTRACTS if t not in ("measurement", "equipment", "tag")]

QUERIES = {
    **{f"clean_{t}": (_clean(t), _valid(t)) for t in _NEW},
    "pipeline_audit": (
        pipeline_audit,
        f"""SELECT "table", 'complete' AS status, n + odd AS records, good AS valid, poor + odd AS bad,
          again AS duplicates FROM ({_ALL_COUNTS})""",
    ),
    "pipeline_zone_counts": (
        pipeline_zone_counts,
        f"""SELECT unnest(['cleaned', 'valid', 'bad', 'duplicates']) AS zone, "table",
          unnest([n + odd, good, poor + odd, again]) AS n FROM ({_ALL_COUNTS})""",
    ),
    "plant_fk_report": (plant_fk_report, " UNION ALL ".join(map(_fk, FK_EDGES))),
    "plant_lost_ancestors": (
        plant_lost_ancestors,
        " UNION ALL ".join(_lost(e[0], lower) for e in FK_EDGES if e[2] == "tag" for lower in FK_EDGES if lower[0] == "tag"),
    ),
}
