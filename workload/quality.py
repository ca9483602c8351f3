"""Checks, cleaning, deduplication, joins and quality reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import coerce_date, coerce_number, coerce_timestamp
from tidemark.operators import checks, coerce, dedup, joins, reports, rules
from tidemark.plans import learning
from tidemark.plans.contracts import Contract, Field
from tidemark.session import write_through
from workload import inputs
from workload.inputs import COURSES, ENROLLMENTS, FLAT_EVENTS, USERS, table
from workload.learning import fact_events_frame

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ID = [*LINE_KEY, "l_partkey", "l_suppkey", "l_extendedprice"]


# --- declared tests ---------------------------------------------------------


def check_unique(spark, d):
    return checks.duplicates(table(spark, d, "lineitem"), LINE_KEY)


_NULLABLE = ["event_id", "user_id", "course_id", "event_type", "time_spent_sec", "rating"]


def check_not_null(spark, d):
    return checks.null_counts(inputs.flat_events(spark, d), _NULLABLE)


def null_keys(spark, d):
    events = inputs.flat_events(spark, d)
    return checks.null_keys(events, "event_type").select("event_id", "user_id", "event_ts")


def check_relationships(spark, d):
    owing = table(spark, d, "customer").filter("c_acctbal >= 0")
    return checks.orphans(table(spark, d, "orders"), owing, "o_custkey", "c_custkey")


# Parents with a condition, so that some children have lost theirs.
_PARENTS = {
    "orders": "o_orderstatus <> 'P'",
    "part": "p_size < 40",
    "supplier": "s_acctbal >= 0",
    "customer": "c_acctbal >= 0",
    "nation": "n_regionkey <> 1",
    "region": "r_regionkey < 4",
}
_EDGES = (
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"),
)


def fk_graph(spark, d):
    tables = {t: table(spark, d, t) for t in ("lineitem", *_PARENTS)}
    return checks.fk_report(tables, _EDGES, {t: F.expr(c) for t, c in _PARENTS.items()})


def fk_lost_ancestors(spark, d):
    """Rows whose parent is there, but not its parent, or that one's: by path through the graph."""
    tables = {t: table(spark, d, t) for t in ("lineitem", *_PARENTS)}
    known = {t: F.expr(c) for t, c in _PARENTS.items()}
    counts = write_through(checks.fk_counts(tables, _EDGES, known), "fk-counts")
    return checks.lost_ancestors(tables, _EDGES, counts, known)


def _paths(start):
    for edge in _EDGES:
        if edge[0] == start[-1][2]:
            yield [*start, edge]
            yield from _paths([*start, edge])


def _lost_sql(path):
    (table, fk, _, _), last = path[0], path[-1]
    joins = " ".join(f"JOIN (SELECT * FROM {p} WHERE {_PARENTS[p]}) ON {c} = {pk}" for _, c, p, pk in path[:-1])
    label = " -> ".join(f"{t}.{c}" for t, c, _, _ in path) + f" -> {last[2]}"
    return f"""SELECT '{label}' AS path, count(DISTINCT {fk}) AS keys, count(*) AS rows FROM {table} {joins}
      WHERE {last[1]} NOT IN (SELECT {last[3]} FROM {last[2]} WHERE {_PARENTS[last[2]]}) HAVING count(*) > 0"""


def _fk_sql(child, fk, parent, pk):
    return f"""SELECT '{child}.{fk}' AS child, '{parent}.{pk}' AS parent,
      count(DISTINCT {fk}) AS orphan_keys, count(*) AS orphan_rows FROM {child}
      WHERE {fk} IS NOT NULL AND {fk} NOT IN
        (SELECT {pk} FROM {parent} WHERE {_PARENTS[parent]})"""


def _test_tables(spark, d):
    users = inputs.users(spark, d).filter("created_at >= timestamp_ntz'2020-02-01'")
    stg_users = learning.stg_users(users)
    stg_courses = learning.stg_courses(inputs.courses(spark, d))
    stg_enrollments = learning.stg_enrollments(inputs.enrollments(spark, d))
    events = learning.stg_events_flat(inputs.flat_events(spark, d))
    return {
        "stg_users": stg_users,
        "stg_courses": stg_courses,
        "stg_enrollments": stg_enrollments,
        "stg_events": events,
        "dim_users": learning.dim_users(stg_users),
        "dim_courses": learning.dim_courses(stg_courses),
        "fact_events": learning.fact_events(events),
        "fact_enrollments": learning.fact_enrollments(stg_enrollments),
    }


def data_tests(spark, d):
    return checks.run_tests(_test_tables(spark, d), learning.TESTS)


def tests_sql(users: str) -> str:
    """The declared tests over the stand-ins, with these users."""
    users = f"(SELECT *, md5(user_id) AS user_sk, upper(country) AS country_code FROM {users})"
    source = {
        "stg_users": users,
        "dim_users": users,
        "stg_courses": f"(SELECT *, md5(course_id) AS course_sk FROM {COURSES})",
        "dim_courses": f"(SELECT *, md5(course_id) AS course_sk FROM {COURSES})",
        "stg_enrollments": ENROLLMENTS,
        "fact_enrollments": f"(SELECT *, 'x' AS enrollment_channel FROM {ENROLLMENTS})",
        "stg_events": FLAT_EVENTS,
        "fact_events": f"(SELECT *, 0 AS is_completed, 0 AS safe_time_spent_sec FROM {FLAT_EVENTS})",
    }
    parts = []
    for t in learning.TESTS:
        frm = source[t.table]
        if t.kind == "not_null":
            n = f"(SELECT count(*) FROM {frm} WHERE {t.column} IS NULL)"
        elif t.kind == "predicate":
            n = f"(SELECT count(*) FROM {frm} WHERE {t.column})"
        elif t.kind == "unique":
            n = f"""(SELECT count(*) FROM (SELECT {t.column} FROM {frm}
              WHERE {t.column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1))"""
        else:
            n = f"""(SELECT count(*) FROM {frm} WHERE {t.column} IS NOT NULL
              AND {t.column} NOT IN (SELECT {t.parent_column} FROM {source[t.parent]}))"""
        parts.append(f"SELECT '{t.name}' AS test, {n} AS failures")
    return "SELECT test, failures, failures = 0 AS passed FROM (" + " UNION ALL ".join(parts) + ")"


# --- joins ------------------------------------------------------------------


def star_enrich(spark, d):
    nation = table(spark, d, "nation")
    region = table(spark, d, "region")
    suppliers = joins.enrich(
        table(spark, d, "supplier")
        .withColumnRenamed("s_suppkey", "l_suppkey")
        .withColumnRenamed("s_nationkey", "n_nationkey"),
        [
            joins.Dimension(nation.withColumnRenamed("n_regionkey", "r_regionkey"), "n_nationkey"),
            joins.Dimension(region, "r_regionkey"),
        ],
    )
    parts = table(spark, d, "part").withColumnRenamed("p_partkey", "l_partkey")
    wide = joins.enrich(
        table(spark, d, "lineitem"),
        [joins.Dimension(suppliers, "l_suppkey"), joins.Dimension(parts, "l_partkey")],
    )
    return wide.select(*LINE_ID, "l_quantity", "p_brand", "p_type", "s_name", "n_name", "r_name")


# --- duplicates -------------------------------------------------------------


def _with_copies(spark, d):
    lines = table(spark, d, "lineitem")
    return lines.unionByName(lines.filter("l_returnflag = 'R'"))


def dedup_exact(spark, d):
    return dedup.drop_exact(_with_copies(spark, d))


def _ranked(lines):
    valid = F.col("l_discount") > 0.02
    order = [valid.desc(), F.col("l_shipdate").desc(), *map(F.col, LINE_ID[2:])]
    return dedup.keep_best(lines, LINE_KEY, order)


def dedup_keep_best(spark, d):
    return _ranked(table(spark, d, "lineitem"))


def dedup_surplus(spark, d):
    lines = table(spark, d, "lineitem")
    return dedup.surplus(lines, _ranked(lines), LINE_ID)


_RANKED = """(SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_discount > 0.02 DESC, l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem)"""


def dedup_near(spark, d):
    """Rows of one key: the cheaper discount counts as valid, the part as the place."""
    return dedup.resolve_near(
        table(spark, d, "lineitem"),
        LINE_KEY,
        position=LINE_ID[2:],
        valid=F.col("l_tax") < 0.05,
        prefer="revised_wins",
        revised=F.col("l_returnflag") == "R",
    )


_CONFLICT_COLUMNS = ["l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"]


def dup_conflicts(spark, d):
    report = dedup.conflict_report(table(spark, d, "lineitem"), LINE_KEY, _CONFLICT_COLUMNS)
    return report.withColumn("differing", F.concat_ws(",", "differing"))


def _conflicts_sql() -> str:
    parts = ", ".join(
        f"CASE WHEN count(DISTINCT {c}) > 1 OR (count({c}) > 0 AND count({c}) < count(*))"
        f" THEN '{c}' END"
        for c in _CONFLICT_COLUMNS
    )
    return f"""SELECT * FROM (SELECT l_orderkey, l_linenumber, count(*) AS n_rows,
      concat_ws(',', {parts}) AS differing FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
      WHERE differing <> ''"""


# --- coercion ---------------------------------------------------------------

_QUANTITY = (
    "CASE l_returnflag WHEN 'R' THEN {number} WHEN 'A' THEN {text} ELSE {bad} END"
)


def coerce_numbers(spark, d):
    """Quantities as JSON numbers, as text, as words, and missing."""
    quantity = (
        F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("string"))
        .when(
            F.col("l_returnflag") == "A",
            F.concat(F.lit('"'), F.col("l_quantity").cast("string"), F.lit('"')),
        )
        .when(F.col("l_linestatus") == "O", '"n/a"')
        .otherwise("null")
    )
    text = F.concat(F.lit('{"Quantity": '), quantity, F.lit("}"))
    v = table(spark, d, "lineitem").select(*LINE_ID, F.parse_json(text).alias("v"))
    return v.select(
        *LINE_ID,
        coerce_number("v", "$.Quantity").alias("quantity"),
        coerce_number("v", "$.Price").alias("price"),
    )


def _order_texts(spark, d):
    date, p = F.col("o_orderdate"), F.col("o_orderpriority")
    stamp = date + F.expr("make_dt_interval(0, 0, 0, cast(o_orderkey % 86400 as decimal(18,6)))")
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.when(p == "1-URGENT", F.date_format(date, "yyyy-MM-dd"))
        .when(p == "2-HIGH", F.date_format(date, "MM/dd/yyyy"))
        .when(p == "3-MEDIUM", F.date_format(date, "dd-MMM-yyyy"))
        .when(p == "5-LOW", F.date_format(date, "yyyyMMdd"))
        .otherwise("some day")
        .alias("date_text"),
        F.when(p == "1-URGENT", F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss"))
        .when(p == "2-HIGH", F.date_format(stamp, "MM/dd/yyyy HH:mm:ss"))
        .when(p == "3-MEDIUM", F.date_format(stamp, "dd-MMM-yyyy HH:mm"))
        .when(p == "5-LOW", F.date_format(stamp, "yyyyMMddHHmmss"))
        .alias("stamp_text"),
    )


def coerce_dates(spark, d):
    return _order_texts(spark, d).select(
        "o_orderkey",
        coerce_date("date_text").alias("order_date"),
        coerce_timestamp("stamp_text").alias("order_stamp"),
    )


# --- rules and routing ------------------------------------------------------


def _order_rules():
    return [
        *rules.null_rules(["o_custkey", "o_orderstatus"]),
        *rules.domain_rules({"o_orderpriority": ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]}),
        *rules.range_rules({"price": "o_totalprice BETWEEN 2000 AND 450000"}),
    ]


def _holey_orders(spark, d):
    return table(spark, d, "orders").withColumns(
        {
            "o_custkey": F.when(F.col("o_totalprice") >= 5000, F.col("o_custkey")),
            "o_orderstatus": F.nullif("o_orderstatus", F.lit("P")),
        }
    )


def _checked(spark, d):
    return rules.with_reasons(_holey_orders(spark, d), _order_rules())


_HOLEY = """(SELECT * REPLACE (CASE WHEN o_totalprice >= 5000 THEN o_custkey END AS o_custkey,
  nullif(o_orderstatus, 'P') AS o_orderstatus) FROM orders)"""
_CHECKED = f"""(SELECT *, concat_ws(',',
  CASE WHEN o_custkey IS NULL THEN 'null:o_custkey' END,
  CASE WHEN o_orderstatus IS NULL THEN 'null:o_orderstatus' END,
  CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW')
    THEN 'domain:o_orderpriority' END,
  CASE WHEN NOT (o_totalprice BETWEEN 2000 AND 450000) THEN 'range:price' END) AS reasons
  FROM {_HOLEY})"""


def null_reasons(spark, d):
    found = rules.with_reasons(
        _holey_orders(spark, d), rules.null_rules(["o_custkey", "o_orderstatus"])
    )
    return found.select("o_orderkey", F.concat_ws(",", "reasons").alias("reasons"))


def route_valid(spark, d):
    return rules.split_valid(_checked(spark, d))[0]


def route_bad(spark, d):
    bad = rules.split_valid(_checked(spark, d))[1]
    return bad.withColumn("reasons", F.concat_ws(",", "reasons"))


def _breaking(df, rule_list, *cols):
    found = rules.with_reasons(df, rule_list)
    return found.filter(~rules.is_valid()).select(
        *cols, F.concat_ws(",", "reasons").alias("reasons")
    )


def accepted_values(spark, d):
    allowed = rules.domain_rules({"event_type": ["view", "start", "complete"]})
    return _breaking(inputs.flat_events(spark, d), allowed, "event_id", "event_type")


def range_checks(spark, d):
    limits = rules.range_rules(
        {
            "quantity": "l_quantity BETWEEN 3 AND 48",
            "discounted": F.col("l_discount") <= F.col("l_tax") + 0.05,
        }
    )
    return _breaking(table(spark, d, "lineitem"), limits, *LINE_ID)


def id_format(spark, d):
    # Names ending in an even digit are the well-formed ones here.
    formats = rules.format_rules({"c_name": r"^Customer#\d{8}[02468]$"})
    return _breaking(table(spark, d, "customer"), formats, "c_custkey", "c_name")


def text_length(spark, d):
    limits = rules.length_rules({"p_name": 9, "p_type": 5})
    return _breaking(table(spark, d, "part"), limits, "p_partkey")


def dq_report(spark, d):
    return reports.dq_report(_checked(spark, d), table=F.lit("orders"))


def batch_audit(spark, d):
    lines = table(spark, d, "lineitem").withColumn(
        "batch", F.date_format("l_shipdate", "yyyy-MM-dd")
    )
    return reports.batch_audit(lines, "batch", ok=F.col("l_quantity") > 2)


# --- unexpected columns -----------------------------------------------------

EXPECTED = ["OrderID", "Price"]


def _order_records(spark, d):
    """Orders as JSON; some carry one or two columns nobody has declared."""
    p = F.col("o_orderpriority")
    extra = F.when(p == "1-URGENT", F.concat(F.lit(', "Priority": "'), p, F.lit('"'))).when(
        p == "2-HIGH",
        F.concat(
            F.lit(', "Priority": 2, "EscalationLevel": "'), F.col("o_orderstatus"), F.lit('"')
        ),
    ).otherwise("")
    text = F.concat(
        F.lit('{"OrderID": '),
        F.col("o_orderkey").cast("string"),
        F.lit(', "Price": '),
        F.col("o_totalprice").cast("string"),
        extra,
        F.lit("}"),
    )
    return table(spark, d, "orders").select("o_orderkey", F.parse_json(text).alias("record"))


def extra_columns_profile(spark, d):
    return coerce.extra_columns_profile(_order_records(spark, d), EXPECTED, table="orders")


def extra_columns_capture(spark, d):
    found = coerce.capture_extras(_order_records(spark, d), EXPECTED)
    return found.select(
        "o_orderkey",
        F.col("_extra")["Priority"].alias("priority"),
        F.col("_extra")["EscalationLevel"].alias("escalation_level"),
        F.coalesce(F.size("_extra"), F.lit(0)).alias("n_extra"),
    )


def contract_projection(spark, d):
    """Events as the contracted fields of the fact, whatever else the table holds."""
    fields = (Field("EventID", "text", 64), Field("UserID", "text", 64), Field("EventTs", "timestamp"), Field("EventCategory", "text", 16))
    wanted = Contract("event", fields)
    return coerce.project_contract(fact_events_frame(spark, d), wanted)


def snake_case_rename(spark, d):
    pascal = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("OrderID"),
        F.col("o_custkey").alias("CustomerID"),
        F.col("o_orderdate").alias("LastUpdated"),
        F.col("o_orderstatus").alias("GPSCoordinates"),
    )
    return coerce.to_snake(pascal)


QUERIES = {
    "check_unique": (
        check_unique,
        """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
          GROUP BY 1, 2 HAVING count(*) > 1""",
    ),
    "check_not_null": (
        check_not_null,
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS n_null FROM {FLAT_EVENTS}"
            for c in _NULLABLE
        ),
    ),
    "null_keys": (
        null_keys,
        f"SELECT event_id, user_id, event_ts FROM {FLAT_EVENTS} WHERE event_type IS NULL",
    ),
    "check_relationships": (
        check_relationships,
        """SELECT * FROM orders WHERE o_custkey IS NOT NULL AND o_custkey NOT IN
          (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
    ),
    "fk_graph": (fk_graph, " UNION ALL ".join(_fk_sql(*e) for e in _EDGES)),
    "fk_lost_ancestors": (
        fk_lost_ancestors,
        " UNION ALL ".join(_lost_sql(p) for e in _EDGES for p in _paths([e])),
    ),
    "data_tests": (data_tests, tests_sql(f"(SELECT * FROM {USERS} WHERE created_at >= TIMESTAMP '2020-02-01')")),
    "star_enrich": (
        star_enrich,
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, p_brand, p_type,
          s_name, n_name, r_name FROM lineitem
          LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = s_nationkey
          LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN part ON p_partkey = l_partkey""",
    ),
    "dedup_exact": (
        dedup_exact,
        """SELECT DISTINCT * FROM (SELECT * FROM lineitem UNION ALL
          SELECT * FROM lineitem WHERE l_returnflag = 'R')""",
    ),
    "dedup_keep_best": (dedup_keep_best, f"SELECT * EXCLUDE (rn) FROM {_RANKED} WHERE rn = 1"),
    "dedup_surplus": (dedup_surplus, f"SELECT * EXCLUDE (rn) FROM {_RANKED} WHERE rn > 1"),
    "dedup_near": (
        dedup_near,
        """SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
          ORDER BY l_tax < 0.05 DESC, l_returnflag = 'R' DESC, l_partkey, l_suppkey, l_extendedprice) = 1""",
    ),
    "dup_conflicts": (dup_conflicts, _conflicts_sql()),
    "coerce_numbers": (
        coerce_numbers,
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
          CASE WHEN l_returnflag IN ('R', 'A') THEN l_quantity END AS quantity,
          CAST(NULL AS DOUBLE) AS price FROM lineitem""",
    ),
    "coerce_dates": (
        coerce_dates,
        """SELECT o_orderkey, CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
          THEN CAST(o_orderdate AS DATE) END AS order_date,
          CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
            WHEN o_orderpriority = '3-MEDIUM'
            THEN date_trunc('minute', o_orderdate + to_seconds(o_orderkey % 86400))
            ELSE o_orderdate + to_seconds(o_orderkey % 86400) END AS order_stamp
          FROM orders""",
    ),
    "null_reasons": (
        null_reasons,
        f"""SELECT o_orderkey, concat_ws(',',
          CASE WHEN o_custkey IS NULL THEN 'null:o_custkey' END,
          CASE WHEN o_orderstatus IS NULL THEN 'null:o_orderstatus' END) AS reasons
          FROM {_HOLEY}""",
    ),
    "route_valid": (route_valid, f"SELECT * EXCLUDE (reasons) FROM {_CHECKED} WHERE reasons = ''"),
    "route_bad": (route_bad, f"SELECT * FROM {_CHECKED} WHERE reasons <> ''"),
    "accepted_values": (
        accepted_values,
        f"""SELECT event_id, event_type, 'domain:event_type' AS reasons FROM {FLAT_EVENTS}
          WHERE event_type NOT IN ('view', 'start', 'complete')""",
    ),
    "range_checks": (
        range_checks,
        """SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, concat_ws(',',
          CASE WHEN NOT (l_quantity BETWEEN 3 AND 48) THEN 'range:quantity' END,
          CASE WHEN NOT (l_discount <= l_tax + CAST(0.05 AS DOUBLE)) THEN 'range:discounted' END)
          AS reasons FROM lineitem) WHERE reasons <> ''""",
    ),
    "id_format": (
        id_format,
        """SELECT c_custkey, c_name, 'format:c_name' AS reasons FROM customer
          WHERE NOT regexp_matches(c_name, '^Customer#\\d{8}[02468]$')""",
    ),
    "text_length": (
        text_length,
        """SELECT * FROM (SELECT p_partkey, concat_ws(',',
          CASE WHEN strlen(p_name) > 9 THEN 'length:p_name' END,
          CASE WHEN strlen(p_type) > 5 THEN 'length:p_type' END) AS reasons FROM part)
          WHERE reasons <> ''""",
    ),
    "dq_report": (
        dq_report,
        f"""SELECT 'orders' AS "table", rule, count(*) AS n FROM (
          SELECT 'rows' AS rule FROM {_CHECKED} UNION ALL
          SELECT CASE WHEN reasons = '' THEN 'passed' ELSE 'failed' END FROM {_CHECKED} UNION ALL
          SELECT unnest(string_split(reasons, ',')) FROM {_CHECKED} WHERE reasons <> '')
          GROUP BY rule""",
    ),
    "batch_audit": (
        batch_audit,
        """SELECT strftime(l_shipdate, '%Y-%m-%d') AS batch_id,
          CASE WHEN count(*) FILTER (l_quantity <= 2) = 0 THEN 'SUCCEEDED' ELSE 'FAILED' END
            AS status,
          count(*) FILTER (l_quantity > 2) AS records_written,
          count(*) FILTER (l_quantity <= 2) AS records_failed FROM lineitem GROUP BY 1""",
    ),
    "extra_columns_profile": (
        extra_columns_profile,
        """SELECT 'orders' AS "table", "column", count(*) AS n FROM (
          SELECT 'Priority' AS "column" FROM orders
            WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') UNION ALL
          SELECT 'EscalationLevel' FROM orders WHERE o_orderpriority = '2-HIGH') GROUP BY 2""",
    ),
    "extra_columns_capture": (
        extra_columns_capture,
        """SELECT o_orderkey,
          CASE o_orderpriority WHEN '1-URGENT' THEN o_orderpriority WHEN '2-HIGH' THEN '2' END
            AS priority,
          CASE o_orderpriority WHEN '2-HIGH' THEN o_orderstatus END AS escalation_level,
          CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 ELSE 0 END AS n_extra
          FROM orders""",
    ),
    "contract_projection": (
        contract_projection,
        f"""SELECT event_id, user_id, event_ts,
          CASE WHEN event_type IN ('view', 'start', 'complete', 'rate') THEN event_type
            ELSE 'other' END AS event_category FROM {FLAT_EVENTS}""",
    ),
    "snake_case_rename": (
        snake_case_rename,
        """SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS last_updated,
          o_orderstatus AS gps_coordinates FROM orders""",
    ),
}
