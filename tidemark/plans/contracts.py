"""What the thirteen industrial tables must look like."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from tidemark.functions import snake_name

_KINDS = {
    "text": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
}


@dataclass(frozen=True)
class Field:
    source: str
    kind: str
    length: int | None = None

    @property
    def name(self) -> str:
        return snake_name(self.source)

    @property
    def data_type(self) -> T.DataType:
        return _KINDS[self.kind]


# ---------------------------------------------------------------------------
# Source keys, target tables, columns with their types and
# lengths, value domains, identifier formats and relationships of the sources.
# ---------------------------------------------------------------------------

TARGET_OF = {
    "equipment": "equipment",
    "location": "location",
    "customer": "customer",
    "tag": "tag",
    "measurements": "measurement",
    "alarms": "alarm",
    "maintenance": "maintenance",
    "events": "event",
    "contracts": "customer_contract",
    "billing": "billing",
    "inventory": "inventory",
    "regulatory_compliance": "regulatory_compliance",
    "financial_forecasts": "financial_forecast",
}

MASTER_KEYS = ("equipment", "location", "customer", "tag")

# Other names under which defect notes list two of the source keys.
KEY_ALIASES = {"compliance": "regulatory_compliance", "forecasts": "financial_forecasts"}

# Column in the source, and its type; text has its longest length in bytes. The first
# column is the table's key.
COLUMNS = {
    "equipment": (
        Field("EquipmentID", "text", 20),
        Field("EquipmentName", "text", 100),
        Field("EquipmentType", "text", 50),
        Field("Manufacturer", "text", 100),
        Field("InstallDate", "date"),
    ),
    "location": (
        Field("LocationID", "text", 20),
        Field("SiteName", "text", 100),
        Field("Area", "text", 100),
        Field("GPSCoordinates", "text", 50),
    ),
    "customer": (
        Field("CustomerID", "text", 20),
        Field("CustomerName", "text", 100),
        Field("Industry", "text", 50),
        Field("ContactInfo", "text", 200),
        Field("Region", "text", 50),
    ),
    "tag": (
        Field("TagID", "text", 20),
        Field("TagName", "text", 100),
        Field("Description", "text", 200),
        Field("UnitOfMeasure", "text", 20),
        Field("EquipmentID", "text", 20),
        Field("LocationID", "text", 20),
    ),
    "measurement": (
        Field("MeasurementID", "text", 20),
        Field("TagID", "text", 20),
        Field("Timestamp", "timestamp"),
        Field("Value", "double"),
        Field("QualityFlag", "text", 20),
    ),
    "alarm": (
        Field("AlarmID", "text", 20),
        Field("TagID", "text", 20),
        Field("AlarmType", "text", 30),
        Field("ThresholdValue", "double"),
        Field("Timestamp", "timestamp"),
        Field("Status", "text", 20),
    ),
    "maintenance": (
        Field("MaintenanceID", "text", 20),
        Field("TagID", "text", 20),
        Field("WorkOrderID", "text", 20),
        Field("MaintenanceDate", "date"),
        Field("ActionTaken", "text", 200),
        Field("Technician", "text", 100),
    ),
    "event": (
        Field("EventID", "text", 20),
        Field("TagID", "text", 20),
        Field("EventType", "text", 30),
        Field("Timestamp", "timestamp"),
        Field("Notes", "text", 500),
    ),
    "customer_contract": (
        Field("ContractID", "text", 20),
        Field("CustomerID", "text", 20),
        Field("TagID", "text", 20),
        Field("ContractStartDate", "date"),
        Field("ContractEndDate", "date"),
        Field("ContractVolume", "double"),
        Field("PricePerUnit", "double"),
    ),
    "billing": (
        Field("BillingID", "text", 20),
        Field("TagID", "text", 20),
        Field("CustomerID", "text", 20),
        Field("BillingPeriod", "text", 10),
        Field("ConsumptionVolume", "double"),
        Field("TotalAmount", "double"),
        Field("PaymentStatus", "text", 20),
    ),
    "inventory": (
        Field("InventoryID", "text", 20),
        Field("TagID", "text", 20),
        Field("MaterialType", "text", 50),
        Field("Quantity", "int"),
        Field("StorageLocation", "text", 100),
        Field("LastUpdated", "timestamp"),
    ),
    "regulatory_compliance": (
        Field("ComplianceID", "text", 20),
        Field("TagID", "text", 20),
        Field("RegulationName", "text", 50),
        Field("InspectionDate", "date"),
        Field("Status", "text", 30),
        Field("Inspector", "text", 100),
    ),
    "financial_forecast": (
        Field("ForecastID", "text", 20),
        Field("TagID", "text", 20),
        Field("ForecastDate", "date"),
        Field("ExpectedConsumption", "double"),
        Field("ExpectedRevenue", "double"),
        Field("RiskFactor", "double"),
    ),
}

# The time column each fact is sorted by, within its tag.
SORTED_BY = {
    "measurement": "timestamp",
    "alarm": "timestamp",
    "maintenance": "maintenance_date",
    "event": "timestamp",
    "customer_contract": "contract_start_date",
    "billing": "billing_period",
    "inventory": "last_updated",
    "regulatory_compliance": "inspection_date",
    "financial_forecast": "forecast_date",
}

DOMAINS = {
    "measurement": {"quality_flag": ("Good", "Bad", "Uncertain", "Substituted")},
    "alarm": {
        "alarm_type": ("High", "Low", "HighHigh", "LowLow", "RateOfChange"),
        "status": ("Active", "Acknowledged", "Cleared", "Shelved"),
    },
    "event": {
        "event_type": (
            "ProcessTrip",
            "ManualOverride",
            "SetpointChange",
            "ModeChange",
            "SystemRestart",
            "CommunicationLoss",
        )
    },
    "billing": {"payment_status": ("Paid", "Pending", "Overdue", "Disputed")},
    "inventory": {
        "material_type": (
            "Spare Sensor",
            "Gasket Kit",
            "Lubricant",
            "Filter Element",
            "Wiring Harness",
            "Calibration Gas",
            "O-Ring Set",
            "Circuit Board",
        ),
        "storage_location": (
            "Warehouse A-12",
            "Warehouse B-05",
            "Field Cabinet 3",
            "Maintenance Shop",
            "Satellite Store C",
        ),
    },
    "regulatory_compliance": {
        "regulation_name": (
            "EPA 40 CFR 60",
            "OSHA 29 CFR 1910",
            "API 570",
            "ASME B31.3",
            "NFPA 30",
            "DOT 49 CFR 195",
        ),
        "status": ("Compliant", "Non-Compliant", "Pending Review", "Exempted"),
    },
}

FORMATS = {
    "equipment": {"equipment_id": r"^EQ-\d{4}$"},
    "location": {"location_id": r"^LOC-\d{4}$"},
    "customer": {"customer_id": r"^CUST-\d{4}$"},
    "tag": {
        "tag_id": r"^TAG-\d{5}$",
        "equipment_id": r"^EQ-\d{4}$",
        "location_id": r"^LOC-\d{4}$",
    },
    "measurement": {"measurement_id": r"^MEAS-[0-9A-F]{12}$", "tag_id": r"^TAG-\d{5}$"},
    "alarm": {"alarm_id": r"^ALM-[0-9A-F]{12}$", "tag_id": r"^TAG-\d{5}$"},
    "maintenance": {
        "maintenance_id": r"^MNT-[0-9A-F]{12}$",
        "tag_id": r"^TAG-\d{5}$",
        "work_order_id": r"^WO-\d{5}$",
    },
    "event": {"event_id": r"^EVT-[0-9A-F]{12}$", "tag_id": r"^TAG-\d{5}$"},
    "customer_contract": {
        "contract_id": r"^CTR-[0-9A-F]{12}$",
        "customer_id": r"^CUST-\d{4}$",
        "tag_id": r"^TAG-\d{5}$",
    },
    "billing": {
        "billing_id": r"^BIL-[0-9A-F]{12}$",
        "tag_id": r"^TAG-\d{5}$",
        "customer_id": r"^CUST-\d{4}$",
        "billing_period": r"^\d{4}-(0[1-9]|1[0-2])$",
    },
    "inventory": {"inventory_id": r"^INV-[0-9A-F]{12}$", "tag_id": r"^TAG-\d{5}$"},
    "regulatory_compliance": {
        "compliance_id": r"^CMP-[0-9A-F]{12}$",
        "tag_id": r"^TAG-\d{5}$",
    },
    "financial_forecast": {"forecast_id": r"^FRC-[0-9A-F]{12}$", "tag_id": r"^TAG-\d{5}$"},
}

# What a source appends to text that it has changed.
REVISED = " (revised)"

# Conditions every row must meet, as Spark SQL.
RANGES = {
    "customer_contract": {
        "contract_days": "datediff(contract_end_date, contract_start_date) BETWEEN 365 AND 1095",
        "contract_volume": "contract_volume > 0",
        "price_per_unit": "price_per_unit > 0",
    },
    "billing": {"consumption_volume": "consumption_volume > 0", "total_amount": "total_amount > 0"},
    "inventory": {"quantity": "quantity >= 0"},
    "financial_forecast": {
        "expected_consumption": "expected_consumption > 0",
        "expected_revenue": "expected_revenue > 0",
        "risk_factor": "risk_factor BETWEEN 0 AND 1",
    },
}

# child table, child column, parent table, parent column
FK_EDGES = (
    ("tag", "equipment_id", "equipment", "equipment_id"),
    ("tag", "location_id", "location", "location_id"),
    ("measurement", "tag_id", "tag", "tag_id"),
    ("alarm", "tag_id", "tag", "tag_id"),
    ("maintenance", "tag_id", "tag", "tag_id"),
    ("event", "tag_id", "tag", "tag_id"),
    ("customer_contract", "tag_id", "tag", "tag_id"),
    ("customer_contract", "customer_id", "customer", "customer_id"),
    ("billing", "tag_id", "tag", "tag_id"),
    ("billing", "customer_id", "customer", "customer_id"),
    ("inventory", "tag_id", "tag", "tag_id"),
    ("regulatory_compliance", "tag_id", "tag", "tag_id"),
    ("financial_forecast", "tag_id", "tag", "tag_id"),
)

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class Contract:
    table: str
    fields: tuple[Field, ...]

    @property
    def key(self) -> str:
        return self.fields[0].name

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def sources(self) -> list[str]:
        return [f.source for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.data_type) for f in self.fields])


CONTRACTS = {table: Contract(table, fields) for table, fields in COLUMNS.items()}


def target_of(key: str) -> str:
    """The table a payload key is loaded into."""
    return TARGET_OF[KEY_ALIASES.get(key, key)]
