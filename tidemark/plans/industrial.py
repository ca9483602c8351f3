"""Tag documents to the thirteen validated tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.checks import fk_counts, fk_report, lost_ancestors
from tidemark.operators.coerce import coerce_table, contract_rules
from tidemark.operators.dedup import keep_best, surplus
from tidemark.operators.joins import Dimension, enrich, flatten_tag
from tidemark.operators.rules import is_valid, reasons, split_valid
from tidemark.plans.contracts import CONTRACTS, FK_EDGES, SORTED_BY, TARGET_OF, Contract
from tidemark.session import drop_written, in_parallel, sparing_disk, write_through
from tidemark.sinks.layout import cluster_fact
from tidemark.sinks.tables import reload_table
from tidemark.sinks.zones import write_zone
from tidemark.sources.documents import explode_all, malformed, parse_tag_document
from tidemark.sources.zones import ZONES

_TEXT = "_text"
#: Records of a table are much alike and shrink to a few bytes each in a file, but every one is parsed,
#: checked and ranked when it is read: by their bytes alone, tens of millions would fall to one task.
ROWS_PER_FILE = 200_000
#: Copies of a table of which the identifiers are sent to every task, at 8 bytes each.
FEW_COPIES = 1_000_000


@dataclass(frozen=True)
class Cleaned:
    """A table's rows after cleaning: ``valid + bad + duplicates`` is what came in."""

    valid: DataFrame
    bad: DataFrame
    duplicates: DataFrame


def stage_records(
    raw: DataFrame, tables: Sequence[str] | None = None, counts: Observation | None = None
) -> DataFrame:
    """All records of all documents, or those of some tables, written once to
    the shared folder by table.

    The task that parses a document writes its records, to the files of all tables: gathered
    by table they would go through a shuffle, which takes more disk than the files. No file
    holds more than ``ROWS_PER_FILE`` rows, so a large table is read back by many tasks.

    ``_row`` numbers the rows. It is given by the task that writes them, so
    whatever is read back later, after a lost executor too, agrees on it.

    ``counts`` gets the number of records of each table, taken by the tasks that write them.
    """
    parsed = parse_tag_document(raw).select(
        F.col("tag_id").alias("_doc_tag"), F.col("ingested_at").alias("_ingested_at"), "doc"
    )
    keys = {key: t for key, t in TARGET_OF.items() if tables is None or t in tables}
    records = explode_all(parsed, ("_doc_tag", "_ingested_at"), keys)
    records = records.withColumn("_row", F.monotonically_increasing_id())
    if counts is not None:
        records = records.observe(counts, *[F.count_if(F.col("table") == t).alias(t) for t in keys.values()])
    with sparing_disk(raw.sparkSession):
        return write_through(records, "records", partition_by=("table",), most_rows=ROWS_PER_FILE)


def check_table(records: DataFrame, contract: Contract) -> DataFrame:
    """Typed rows of one table with the reasons against each."""
    mine = records.filter(F.col("table") == contract.table).drop("table")
    # A filter on the reasons is not moved below the stack; there it would read every value once for each rule.
    found = F.stack(F.lit(1), reasons(contract_rules(contract))).alias("reasons")
    checked = coerce_table(mine, contract).select("*", found)
    # The values as sent are kept for rows somebody will have to look at.
    return checked.withColumn("_sent", F.when(~is_valid(), F.col(_TEXT))).drop(_TEXT)


def clean_table(records: DataFrame, contract: Contract, stage: bool = False) -> Cleaned:
    """Types first, then rules, then one row per key: a valid one before an
    invalid one, the latest document, the earliest place in it.

    With ``stage`` the settled rows are written to the shared folder, for
    callers that use more than one of the three results. Without it the valid rows
    are ranked among themselves: an invalid row is never before one of them.
    """
    checked = check_table(records, contract)
    best = _best(checked, contract)
    if stage:
        best = write_through(best, contract.table, most_rows=ROWS_PER_FILE)
    valid, bad = split_valid(best)
    if not stage:
        valid = _best(checked.filter(is_valid()).drop("reasons"), contract, [])
    return Cleaned(valid.drop("_sent"), bad, surplus(checked, best, "_row"))


def _best(checked: DataFrame, contract: Contract, first: Sequence[Column] | None = None) -> DataFrame:
    first = [is_valid().desc()] if first is None else first
    order = [*first, F.col("_ingested_at").desc(), F.col("pos"), F.col("_row")]
    return keep_best(checked, contract.key, order, row_id="_row")


def clean_documents(raw: DataFrame) -> dict[str, Cleaned]:
    """Every table of a raw zone, cleaned. The documents are read and parsed once."""
    records = stage_records(raw)
    cleaned = in_parallel(lambda c: clean_table(records, c, stage=True), CONTRACTS.values())
    return dict(zip(CONTRACTS, cleaned))


def save_cleaned(cleaned: dict[str, Cleaned], out: str) -> None:
    """Write ``valid``, ``bad`` and ``duplicates``, each with a folder per table.

    Valid facts are laid out by tag and time, the way they will be read.
    """

    def save(table: str) -> None:
        result = cleaned[table]
        valid = result.valid.select(*CONTRACTS[table].names)
        if table in SORTED_BY:
            valid = cluster_fact(valid, "tag_id", SORTED_BY[table])
        valid.write.parquet(f"{out}/valid/{table}")
        result.bad.write.parquet(f"{out}/bad/{table}")
        result.duplicates.write.parquet(f"{out}/duplicates/{table}")

    in_parallel(save, cleaned)


#: One row for each table of a batch. ``records`` is what came in, counted when it was staged.
AUDIT = "batch_id string, table string, status string, records long, valid long, bad long, duplicates long"


def run_batch(
    raw: DataFrame, out: str, batch_id: str, tables: Sequence[str] | None = None, spent: Callable[[], None] | None = None
) -> DataFrame:
    """One batch from the raw zone to the validated one; returns its audit, as ``AUDIT`` says.

    Writes ``cleaned`` (typed rows as JSON envelopes), ``valid``, ``bad`` and ``duplicates``,
    each with a folder for every table, and ``bad/documents`` with what could not be read.
    The counts are observed in the tasks that write the files, so nothing is read again to
    count it. What a table is made from goes as soon as its zones are written, two tables
    at a time, and ``spent`` is called when ``raw`` is not read any more. A table is ``complete`` if its rows in the three zones are its records, else
    ``incomplete``. The audit of the batch is also written to ``out/audit``.
    """
    spark = raw.sparkSession
    staged = Observation()
    contracts = [c for t, c in CONTRACTS.items() if tables is None or t in tables]
    written = F.count(F.lit(1)).alias("rows")

    def clean(contract: Contract) -> tuple:
        table, seen = contract.table, {z: Observation() for z in ("valid", "bad", "duplicates")}
        checked = write_through(check_table(records, contract), f"checked-{table}", most_rows=ROWS_PER_FILE)
        drop_written(records, f"table={table}")
        write_zone(to_envelope(checked, contract, "cleaned"), "cleaned", f"{out}/cleaned/{table}", "errorifexists", "gzip")
        came, kept = staged.get[table], Observation()
        best = write_through(_best(checked, contract).observe(kept, written), table, most_rows=ROWS_PER_FILE)
        few = came - kept.get["rows"] <= FEW_COPIES
        valid, bad = split_valid(best)
        valid = valid.select(*contract.names)
        if table in SORTED_BY:
            valid = cluster_fact(valid, "tag_id", SORTED_BY[table])
        zones = {"valid": valid, "bad": bad, "duplicates": surplus(checked, best, "_row", few)}
        for zone, df in zones.items():
            df.observe(seen[zone], written).write.parquet(f"{out}/{zone}/{table}")
        drop_written(checked)
        drop_written(best)
        counts = [seen[z].get["rows"] for z in zones]
        return (batch_id, table, "complete" if sum(counts) == came else "incomplete", came, *counts)

    with sparing_disk(spark):
        unreadable(raw).write.option("compression", "gzip").json(f"{out}/bad/documents")
        records = stage_records(raw, tables, staged)
        if spent:
            spent()
        rows = in_parallel(clean, contracts, at_once=2)
        audit = spark.createDataFrame(rows, AUDIT)
        audit.coalesce(1).write.parquet(f"{out}/audit")
    return audit


def load_validated(
    spark: SparkSession, out: str, database: str = "staging", root: str | None = None
) -> list[str]:
    """Empty and reload all thirteen warehouse tables from the validated files."""

    def load(table: str) -> str:
        name = f"{database}.{table}"
        valid = spark.read.schema(CONTRACTS[table].schema).parquet(f"{out}/valid/{table}")
        reload_table(valid, name, f"{root.rstrip('/')}/{table}" if root else None)
        return name

    return in_parallel(load, CONTRACTS)


def unreadable(raw: DataFrame) -> DataFrame:
    """Envelopes for the bad zone, because their document is no JSON object."""
    return malformed(parse_tag_document(raw))


def valid_tables(cleaned: dict[str, Cleaned]) -> dict[str, DataFrame]:
    return {t: c.valid.select(*CONTRACTS[t].names) for t, c in cleaned.items()}


def settle_tables(tables: dict[str, DataFrame], records: DataFrame) -> dict[str, DataFrame]:
    """Write tables that were made of staged records, for callers that need nothing else of the records.

    One follows the other, and the records of a table go as soon as it is written: never
    are the records of all tables, the shuffles and the results there at the same time.
    """
    out = {}
    with sparing_disk(records.sparkSession):
        for table, df in tables.items():
            out[table] = write_through(df, table, most_rows=ROWS_PER_FILE)
            drop_written(records, f"table={table}")
    return out


def tag_fk_report(tables: dict[str, DataFrame]) -> DataFrame:
    return fk_report(tables, FK_EDGES)


def tag_lost_ancestors(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows whose tag is there, but not the tag's equipment or location."""
    return lost_ancestors(tables, FK_EDGES, write_through(fk_counts(tables, FK_EDGES), "fk-counts"))


def enrich_tag_fact(fact: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """A fact with its tag, equipment and location, and its customer if it names one."""
    tag = flatten_tag(tables["tag"], tables["equipment"], tables["location"])
    dims = [Dimension(tag, "tag_id")]
    if "customer_id" in fact.columns:
        dims.append(Dimension(tables["customer"], "customer_id"))
    return enrich(fact, dims)


def to_envelope(df: DataFrame, contract: Contract, zone: str) -> DataFrame:
    """Typed rows as a zone's envelopes; ``source_name`` is the table."""
    tag = F.col("tag_id") if "tag_id" in df.columns else F.lit(None).cast("string")
    return df.select(
        tag.alias("tag_id"),
        F.lit(contract.table).alias("source_name"),
        F.current_timestamp().alias(ZONES[zone][1]),
        F.to_json(F.struct(*contract.names)).alias("data"),
    )


def from_envelope(df: DataFrame, contract: Contract) -> DataFrame:
    mine = df.filter(F.col("source_name") == contract.table)
    return mine.select(F.from_json("data", contract.schema).alias("r")).select("r.*")
