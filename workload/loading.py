"""Sources and sinks: tables written in a source's format, loaded, and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F


from tidemark.plans import learning
from tidemark.session import shared_dir
from tidemark.sinks import layout, tables, zones
from tidemark.sources import files
from tidemark.sources.registry import DatasetSpec, load_registry
from tidemark.sources.zones import read_raw, read_zone, register_zone
from workload import inputs
from workload.documents import tag_documents
from workload.incremental import FIRST, LATER, first_load, later_load
from workload.inputs import ENROLLMENTS, FLAT_EVENTS, table
from workload.quality import _CHECKED, _checked

LOAD_DATE = "2024-03-01"
OPTIONS = ["TRUNCATECOLUMNS", "BLANKSASNULL", "EMPTYASNULL", "TIMEFORMAT 'auto'"]
_ENROLLMENT_COLUMNS = [
    {"name": "enrollment_id", "type": "varchar(64)"},
    {"name": "user_id", "type": "varchar(64)"},
    {"name": "course_id", "type": "varchar(64)"},
    {"name": "enrolled_at", "type": "timestamp"},
    {"name": "enrollment_source", "type": "varchar(64)"},
]


def _registry(root: str, **dataset) -> dict[str, DatasetSpec]:
    return load_registry(
        {
            "defaults": {"root_prefix": "raw", "copy_options": OPTIONS},
            "datasets": {
                "enrollments": {"columns": _ENROLLMENT_COLUMNS, **dataset},
                "absent": {"required": False},
            },
        },
        base_uri=root,
    )


def _land(spark, label: str, df, fmt: str, **options) -> str:
    """Write ``df`` to a fresh root as the day's enrollments; the root is returned."""
    root = shared_dir(spark, label)
    df.write.options(**options).format(fmt).save(f"{root}/raw/enrollments/{LOAD_DATE}")
    return root


def _name(label: str) -> str:
    return f"tide_check.{label}_{uuid.uuid4().hex[:12]}"


def load_csv(spark, d):
    """Compressed CSV with a header and its own delimiter, by the registry."""
    source = inputs.enrollments(spark, d).withColumn(
        "enrolled_at", F.date_format("enrolled_at", "MM/dd/yyyy HH:mm:ss")
    )
    root = _land(spark, "csv", source, "csv", header=True, sep="|", compression="gzip")
    specs = _registry(root, format="csv", delimiter="|", compression="gzip")
    return files.read_dated(spark, specs, LOAD_DATE)["enrollments"]


def load_json(spark, d):
    source = inputs.enrollments(spark, d).withColumn(
        "enrolled_at", F.date_format("enrolled_at", "yyyyMMddHHmmss")
    )
    root = _land(spark, "json", source, "json")
    return files.read_dated(spark, _registry(root, format="json"), LOAD_DATE)["enrollments"]


def load_jsonpaths(spark, d):
    """Nested events flattened by an ordered list of paths."""
    root = _land(spark, "jsonpaths", inputs.raw_events(spark, d), "text")
    specs = _registry(
        root,
        format="json",
        jsonpaths=[
            "$.id",
            "$.actor.account.name",
            "$['object']['id']",
            "$.timestamp",
            "$.verb.id",
        ],
    )
    return files.read_dated(spark, specs, LOAD_DATE)["enrollments"]


def load_parquet(spark, d):
    root = _land(spark, "parquet", inputs.enrollments(spark, d), "parquet")
    return files.read_dated(spark, _registry(root, format="parquet"), LOAD_DATE)["enrollments"]


def load_variant(spark, d):
    """Whole documents into one VARIANT column, some wrapped under ``payload``."""
    text = F.when(
        F.get_json_object("value", "$.context.platform") == "ios",
        F.concat(F.lit('{"payload": '), F.col("value"), F.lit("}")),
    ).otherwise(F.col("value"))
    lines = inputs.raw_events(spark, d).select(text.alias("value"))
    root = _land(spark, "variant", lines, "text")
    specs = _registry(root, format="json", columns=[{"name": "payload", "type": "super"}])
    payload = files.read_dated(spark, specs, LOAD_DATE)["enrollments"]
    return learning.stg_events(payload).drop("raw_duration")


def bad_lines(spark, d):
    """Lines that are no JSON."""
    lines = inputs.raw_events(spark, d).select(
        F.when(F.col("value").contains('"ios"'), F.col("value"))
        .otherwise(F.rtrim("value", F.lit("}")))
        .alias("value")
    )
    root = _land(spark, "badlines", lines, "text")
    found = files.bad_lines(spark, f"{root}/raw/enrollments/{LOAD_DATE}")
    return found.select(F.get_json_object(F.concat("value", F.lit("}}")), "$.id").alias("event_id"))


_PART_COLUMNS = [
    {"name": "part", "type": "bigint"},
    {"name": "name", "type": "varchar(64)"},
    {"name": "kind", "type": "varchar(64)"},
]


def _part_lines(spark, d):
    """Parts as CSV lines with quotes, delimiters and line breaks inside of quoted fields."""
    name = F.concat(F.lit('He said ""'), F.col("p_name"), F.lit('"", ok'))
    broken = F.concat(F.col("p_type"), F.when(F.col("p_size") < 10, "\nnext").otherwise(""))
    return table(spark, d, "part").select(
        F.col("p_partkey").alias("k"),
        F.col("p_size").alias("size"),
        F.concat(F.col("p_partkey"), F.lit(',"'), name, F.lit('","'), broken, F.lit('"')).alias("value"),
    )


def load_csv_quoted(spark, d):
    """Doubled quotes, delimiters and line breaks inside of quoted fields."""
    root = _land(spark, "quoted", _part_lines(spark, d).select("value"), "text")
    specs = _registry(root, columns=_PART_COLUMNS, header=False, multiline=True)
    return files.read_dated(spark, specs, LOAD_DATE)["enrollments"].drop("load_date")


def load_bad_lines_csv(spark, d):
    """Lines with a field too many or too few are left out of the load and listed apart."""
    line = F.concat_ws(",", "p_partkey", "p_brand", "p_type")
    lines = table(spark, d, "part").select(
        F.when(F.col("p_size") < 10, F.concat(line, F.lit(",more")))
        .when(F.col("p_size") < 20, F.col("p_partkey").cast("string"))
        .otherwise(line)
        .alias("value")
    )
    root = _land(spark, "ragged", lines, "text")
    specs = _registry(root, columns=_PART_COLUMNS, header=False)
    good = files.read_dated(spark, specs, LOAD_DATE, strict=False)["enrollments"]
    bad = files.rejected_lines(spark, specs["enrollments"], f"{root}/raw/enrollments/{LOAD_DATE}")
    return good.select("part", F.lit(True).alias("loaded")).unionByName(
        bad.select(F.split("line", ",")[0].cast("bigint").alias("part"), F.lit(False).alias("loaded"))
    )


def load_bad_lines_json(spark, d):
    """Lines that are no JSON are left out of the load and listed apart."""
    document = F.to_json(F.struct(F.col("p_partkey").alias("part"), F.col("p_brand").alias("name")))
    lines = table(spark, d, "part").select(
        F.when(F.col("p_size") < 10, F.rtrim(document, F.lit("}"))).otherwise(document).alias("value")
    )
    root = _land(spark, "malformed", lines, "text")
    specs = _registry(root, columns=_PART_COLUMNS, format="json")
    good = files.read_dated(spark, specs, LOAD_DATE, strict=False)["enrollments"]
    bad = files.rejected_lines(spark, specs["enrollments"], f"{root}/raw/enrollments/{LOAD_DATE}")
    number = F.regexp_extract("line", '"part":([0-9]+)', 1).cast("bigint")
    return good.select("part", F.lit(True).alias("loaded")).unionByName(
        bad.select(number.alias("part"), F.lit(False).alias("loaded"))
    )


def load_time_layout(spark, d):
    """Times in a declared layout, or as seconds since 1970; a text that stands for NULL."""
    source = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.date_format("o_orderdate", "dd.MM.yyyy HH:mm:ss").alias("a"),
        F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("us"),
        F.when(F.col("o_orderstatus") == "F", "NUL").otherwise(F.col("o_orderstatus")).alias("s"),
    ).select("k", "a", F.expr("us div 1000000").cast("string").alias("b"), "s")
    columns = [{"name": "k", "type": "bigint"}, {"name": "a", "type": "timestamp"}, {"name": "s", "type": "varchar(8)"}]
    out = None
    for text, layout in (("a", "DD.MM.YYYY HH24:MI:SS"), ("b", "epochsecs")):
        root = _land(spark, "layout", source.select("k", text, "s"), "csv")
        specs = load_registry(
            {
                "defaults": {"root_prefix": "raw", "copy_options": [f"TIMEFORMAT AS '{layout}'", "NULL AS 'NUL'"]},
                "datasets": {"enrollments": {"columns": columns, "header": False}},
            },
            base_uri=root,
        )
        loaded = files.read_dated(spark, specs, LOAD_DATE)["enrollments"].drop("load_date")
        out = loaded if out is None else out.unionByName(loaded)
    return out


def load_options(spark, d):
    """Blank and empty text to NULL, long text cut, times in any known layout."""
    p = F.col("p_type")
    source = table(spark, d, "part").select(
        F.col("p_partkey").cast("string").alias("part"),
        F.when(p == "ECONOMY", "  ").when(p == "SMALL", "").otherwise(p).alias("kind"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") < 10, "31-Jan-2024")
        .when(F.col("p_size") < 20, "01/31/2024")
        .otherwise("2024-01-31T00:00:00")
        .alias("seen_at"),
        F.col("p_retailprice").cast("string").alias("price"),
    )
    spec = DatasetSpec(
        name="parts",
        table="parts",
        path="",
        load_options=tuple(OPTIONS),
        columns=(
            ("part", "varchar(20)"),
            ("kind", "varchar(20)"),
            ("name", "varchar(6)"),
            ("seen_at", "timestamp"),
            ("price", "double precision"),
        ),
    )
    return files.apply_load_options(source, spec)


def _dated(df):
    return df.withColumn("load_date", F.lit(LOAD_DATE).cast("date"))


def append_load(spark, d):
    """The same load twice: appended rows are there twice."""
    name, root = _name("append"), shared_dir(spark, "append")
    for _ in range(2):
        tables.append_table(_dated(first_load(spark, d)), name, "load_date", root)
    return spark.table(name)


def replace_load(spark, d):
    """The same load twice, replacing its date; another date is left alone."""
    name, root = _name("replace"), shared_dir(spark, "replace")
    other = later_load(spark, d).withColumn("load_date", F.lit("2024-03-02").cast("date"))
    tables.append_table(other, name, "load_date", root)
    for _ in range(2):
        tables.append_table(
            _dated(first_load(spark, d)), name, "load_date", root, mode="replace_date"
        )
    return spark.table(name)


def truncate_reload(spark, d):
    name, root = _name("reload"), shared_dir(spark, "reload")
    tables.reload_table(first_load(spark, d), name, root)
    tables.reload_table(later_load(spark, d), name, root)
    return spark.table(name).drop("_loaded_at")


def build_table(spark, d):
    """A rebuilt table takes on new columns."""
    name, root = _name("build"), shared_dir(spark, "build")
    tables.build_table(first_load(spark, d), name, root=root)
    tables.build_table(
        later_load(spark, d).withColumn("o_year", F.year("o_orderdate")), name, root=root
    )
    return spark.table(name)


def _by_year(df):
    return df.withColumn("o_year", F.year("o_orderdate"))


def incremental_fact(spark, d):
    """Two runs of an incremental fact: newer rows only, merged by key."""
    name, root = _name("fact"), shared_dir(spark, "fact")
    for load in (first_load(spark, d), later_load(spark, d)):
        tables.incremental_table(
            _by_year(load), name, "o_orderkey", "o_orderdate", partition_by="o_year", root=root, any_catalog=True
        )
    return spark.table(name)


def merge_partitions(spark, d):
    """A merge that rewrites only the years it touches."""
    name, root = _name("merge"), shared_dir(spark, "merge")
    for load in (first_load(spark, d), later_load(spark, d)):
        tables.merge_table(_by_year(load), name, "o_orderkey", "o_year", root=root)
    return spark.table(name)


def zone_split(spark, d):
    """Valid and bad rows, each from its own folder."""
    out = shared_dir(spark, "split")
    zones.write_split(_checked(spark, d), f"{out}/valid", f"{out}/bad")
    valid = spark.read.parquet(f"{out}/valid").withColumn("reasons", F.lit(""))
    bad = spark.read.parquet(f"{out}/bad").withColumn("reasons", F.concat_ws(",", "reasons"))
    return valid.unionByName(bad)


def raw_zone(spark, d):
    """Envelopes written to the raw zone, read as a catalog table and as files."""
    path, name = shared_dir(spark, "raw"), _name("raw")
    zones.write_zone(tag_documents(spark, d), "raw", path)
    register_zone(spark, name, "raw", path)
    by_name = spark.table(name).groupBy("tag_id").agg(F.count(F.lit(1)).alias("documents"))
    by_path = read_raw(spark, path).groupBy("tag_id").agg(
        F.max("ingested_at").cast("timestamp_ntz").alias("last_ingested_at")
    )
    return by_name.join(by_path, "tag_id")


def validated_zone(spark, d):
    path = shared_dir(spark, "validated")
    envelopes = tag_documents(spark, d).withColumnRenamed("ingested_at", "validated_at")
    zones.write_zone(envelopes, "validated", path)
    found = read_zone(spark, "validated", path)
    return found.groupBy("tag_id").agg(F.count(F.lit(1)).alias("documents"))


def cluster_fact(spark, d):
    """Lines laid out by part and ship date; all of them are still there."""
    path = shared_dir(spark, "clustered")
    lines = table(spark, d, "lineitem")
    layout.cluster_fact(lines, "l_partkey", "l_shipdate").write.parquet(path)
    return spark.read.parquet(path)


_FLAT_STAGED = f"SELECT *, md5(event_id) AS event_sk FROM {FLAT_EVENTS}"
_DATE = f"DATE '{LOAD_DATE}' AS load_date"
_TAG = "'TAG-' || lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS tag_id"
_MERGED = f"""SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM (
  SELECT * FROM {FIRST} t WHERE NOT EXISTS
    (SELECT 1 FROM {LATER} s WHERE s.o_orderkey = t.o_orderkey)
  UNION ALL SELECT * FROM {LATER})"""

QUERIES = {
    "load_csv": (load_csv, f"SELECT *, {_DATE} FROM {ENROLLMENTS}"),
    "load_json": (load_json, f"SELECT *, {_DATE} FROM {ENROLLMENTS}"),
    "load_jsonpaths": (
        load_jsonpaths,
        f"""SELECT event_id AS enrollment_id, user_id, course_id, event_ts AS enrolled_at,
          event_type AS enrollment_source, {_DATE} FROM {FLAT_EVENTS}""",
    ),
    "load_parquet": (load_parquet, f"SELECT *, {_DATE} FROM {ENROLLMENTS}"),
    "load_variant": (load_variant, _FLAT_STAGED),
    "bad_lines": (
        bad_lines,
        f"SELECT event_id FROM {FLAT_EVENTS} WHERE device_type <> 'ios'",
    ),
    "load_options": (
        load_options,
        """SELECT CAST(p_partkey AS VARCHAR) AS part,
          CASE WHEN p_type NOT IN ('ECONOMY', 'SMALL') THEN p_type END AS kind,
          left(p_name, 6) AS name, TIMESTAMP '2024-01-31' AS seen_at, p_retailprice AS price
          FROM part""",
    ),
    "load_csv_quoted": (
        load_csv_quoted,
        """SELECT p_partkey AS part, 'He said "' || p_name || '", ok' AS name,
          p_type || CASE WHEN p_size < 10 THEN chr(10) || 'next' ELSE '' END AS kind FROM part""",
    ),
    "load_bad_lines_csv": (
        load_bad_lines_csv,
        "SELECT p_partkey AS part, p_size >= 20 AS loaded FROM part",
    ),
    "load_bad_lines_json": (
        load_bad_lines_json,
        "SELECT p_partkey AS part, p_size >= 10 AS loaded FROM part",
    ),
    "load_time_layout": (
        load_time_layout,
        """SELECT k, a, s FROM (SELECT o_orderkey AS k, date_trunc('second', o_orderdate) AS a,
          CASE WHEN o_orderstatus <> 'F' THEN o_orderstatus END AS s FROM orders), range(2)""",
    ),
    "append_load": (
        append_load,
        f"SELECT *, {_DATE} FROM {FIRST} UNION ALL SELECT *, {_DATE} FROM {FIRST}",
    ),
    "replace_load": (
        replace_load,
        f"""SELECT *, {_DATE} FROM {FIRST}
          UNION ALL SELECT *, DATE '2024-03-02' FROM {LATER}""",
    ),
    "truncate_reload": (truncate_reload, f"SELECT * FROM {LATER}"),
    "build_table": (
        build_table,
        f"SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM {LATER}",
    ),
    "incremental_fact": (
        incremental_fact,
        f"""SELECT *, CAST(year(o_orderdate) AS INTEGER) AS o_year FROM (SELECT * FROM {FIRST}
          UNION ALL SELECT * FROM {LATER}
            WHERE o_orderdate > (SELECT max(o_orderdate) FROM {FIRST}))""",
    ),
    "merge_partitions": (merge_partitions, _MERGED),
    "zone_split": (zone_split, f"SELECT * FROM {_CHECKED}"),
    "raw_zone": (
        raw_zone,
        f"""SELECT {_TAG}, count(*) AS documents, max(date_trunc('milliseconds', l_shipdate
          + to_seconds(l_partkey) + to_microseconds(l_suppkey))) AS last_ingested_at
          FROM lineitem GROUP BY 1""",
    ),
    "validated_zone": (
        validated_zone,
        f"SELECT {_TAG}, count(*) AS documents FROM lineitem GROUP BY 1",
    ),
    "cluster_fact": (cluster_fact, "SELECT * FROM lineitem"),
}
