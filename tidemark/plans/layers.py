"""All models in order: history, staging, dimensions, facts, tests, reports.

The functions take and return DataFrames. Nothing runs before a result is
written or counted, so the models of one report become one Spark plan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.checks import DataTest, run_tests
from tidemark.operators.incremental import delete_insert, merge_upsert
from tidemark.operators.snapshot import snapshot
from tidemark.plans import learning
from tidemark.plans.graph import Model, run_graph
from tidemark.session import in_parallel, write_through
from tidemark.sinks.history import snapshot_version
from tidemark.sinks.versions import Manifest, VersionedTable

#: Snapshots by raw table: the history's name and the key.
HISTORIES = {"users": ("users_snapshot", "user_id"), "courses": ("courses_snapshot", "course_id")}
#: Incremental tables by raw table: (table, model of its new rows, key, date, strategy).
MERGED = {
    "enrollments": (
        ("stg_enrollments", "new_enrollments", "enrollment_id", "enrolled_date", "delete+insert"),
        ("fact_enrollments", "new_enrollment_facts", "enrollment_id", "enrolled_date", "merge"),
    ),
    "events": (
        ("stg_events", "new_events", "event_id", "event_date", "delete+insert"),
        ("fact_events", "new_event_facts", "event_id", "event_date", "merge"),
    ),
}
#: Tables made anew by every run, by raw table.
REBUILT = {"users": ("stg_users", "dim_users"), "courses": ("stg_courses", "dim_courses")}
REPORTS = {
    "daily_active_learners": learning.daily_active_learners,
    "weekly_active_learners": learning.weekly_active_learners,
    "course_completion_rates": learning.course_completion_rates,
}
RAW = ("users", "courses", "enrollments", "events")


def run_layers(
    raw: Mapping[str, DataFrame],
    existing: Mapping[str, DataFrame] | None = None,
    lookback: str | None = None,
    keep: Callable[[str, DataFrame], DataFrame] = lambda name, df: df,
) -> dict[str, DataFrame]:
    """All tables after this run, from the raw tables and the tables of the last run.

    ``raw`` has ``users``, ``courses``, ``enrollments`` and ``events``; an
    optional dataset that was not delivered may be missing, and so are its models.

    Nothing is written, unless ``keep`` is given: it then gets every table that several
    others are made from, once, and returns it as read back.
    """
    old = existing or {}
    raw = {n: raw[n] for n in RAW if n in raw}
    merges = {"merge": merge_upsert, "delete+insert": delete_insert}
    models = layer_models(raw, old, lookback)
    merged = [m for n in raw for m in MERGED.get(n, ())]
    models += [
        Model(t, (new,), lambda df, t=t, key=key, how=how: merges[how](old.get(t), df, key))
        for t, new, key, _, how in merged
    ]
    histories = [(n, *HISTORIES[n]) for n in raw if n in HISTORIES]
    models += [
        Model(h, (n,), lambda df, h=h, key=key: snapshot(old.get(h), df, key, updated_at="created_at"))
        for n, h, key in histories
    ]
    wanted = [m.name for m in models if not m.name.startswith("new_")]
    built = run_graph(models, raw, wanted, keep)
    return {t: built[t] for t in wanted}


def layer_models(
    raw: Iterable[str], old: Mapping[str, DataFrame], lookback: str | None = None, grain: str | None = None
) -> list[Model]:
    """The models that can be built from the raw tables at hand, as a graph.

    ``old`` has the incremental tables of the last run; a model of them yields the rows
    that are to be merged. With ``grain`` facts carry the first day of that span of time.
    """

    def dated(df: DataFrame, ts: str, date: str) -> DataFrame:
        return df.withColumn(date, F.date_trunc(grain, F.col(ts)).cast("date")) if grain else df

    models = {
        "users": [
            Model("stg_users", ("users",), learning.stg_users),
            Model("dim_users", ("stg_users",), learning.dim_users),
        ],
        "courses": [
            Model("stg_courses", ("courses",), learning.stg_courses),
            Model("dim_courses", ("stg_courses",), learning.dim_courses),
        ],
        "enrollments": [
            Model("new_enrollments", ("enrollments",), lambda raw: dated(
                learning.stg_enrollments(raw, old.get("stg_enrollments"), lookback), "enrolled_at", "enrolled_date")),
            Model("new_enrollment_facts", ("stg_enrollments",), lambda staged: dated(
                learning.fact_enrollments(staged, old.get("fact_enrollments"), lookback), "enrolled_at", "enrolled_date")),
        ],
        "events": [
            Model("new_events", ("events",), lambda raw: dated(
                _stage_events(raw, old.get("stg_events"), lookback), "event_ts", "event_date")),
            Model("new_event_facts", ("stg_events",), lambda staged: dated(
                learning.fact_events(staged, old.get("fact_events"), lookback), "event_ts", "event_date")),
            *[Model(r, ("fact_events",), build) for r, build in REPORTS.items()],
        ],
    }
    return [m for name in raw for m in models.get(name, ())]


def publish_layers(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    lookback: str | None = None,
    grain: str = "day",
    suite: Sequence[DataTest] = learning.TESTS,
) -> dict[str, VersionedTable]:
    """One run of all models into versioned tables below ``root``, gated by the tests.

    Everything is written first: histories, staged tables, dimensions, and the partitions
    of the facts that the load touches. The tests in ``suite`` then look at the tables as
    they would be. If one fails, ``FailedTests`` is raised and no table has changed,
    whichever raw tables were loaded. Otherwise all are published, and the reports are
    built. An empty suite tests nothing.

    Facts carry the first day of their ``grain`` of time, such as their month, as one more
    column, which they are partitioned by. The state of a run is these tables alone, so
    any later session goes on from them.
    """
    raw = {n: raw[n] for n in RAW if n in raw}
    root = root.rstrip("/")
    rebuilt = [t for n in raw for t in REBUILT.get(n, ())]
    histories = [(n, *HISTORIES[n]) for n in raw if n in HISTORIES]
    merged = [m for n in raw for m in MERGED.get(n, ())]
    wanted = [*rebuilt, *[h for _, h, _ in histories], *[m[0] for m in merged]]
    reports = list(REPORTS) if "events" in raw else []
    tables = {t: VersionedTable(spark, f"{root}/{t}") for t in [*wanted, *reports]}
    # The mark of an incremental table is looked for in its last partition, which grows with its time.
    old = {m[0]: tables[m[0]].read_last() for m in merged if tables[m[0]].exists()}
    pending: dict[str, Manifest] = {}

    def replaced(name: str, df: DataFrame) -> DataFrame:
        pending[name] = tables[name].replace(df, publish=False)
        return tables[name].read(pending[name])

    def joined(name: str, key: str, date: str, strategy: str, df: DataFrame) -> DataFrame:
        if tables[name].exists():
            pending[name] = tables[name].merge(df, key, strategy, publish=False)
        else:
            pending[name] = tables[name].replace(df, date, key, publish=False)
        return tables[name].read(pending[name])

    def remembered(name: str, key: str, df: DataFrame) -> DataFrame:
        pending[name] = snapshot_version(df, tables[name].root, key, "created_at", publish=False)
        return tables[name].read(pending[name])

    models = layer_models(raw, old, lookback, grain)
    models += [Model(t, (new,), partial(joined, t, key, date, how)) for t, new, key, date, how in merged]
    models += [Model(h, (n,), partial(remembered, h, key)) for n, h, key in histories]

    def keep(name: str, df: DataFrame) -> DataFrame:
        if name in pending:
            # Written by the model itself, into its own table.
            return df
        return replaced(name, df) if name in rebuilt else write_through(df, name)

    built = run_graph(models, raw, wanted, keep, always=rebuilt)
    asked = {t for test in suite for t in (test.table, test.parent) if t}
    others = {t: VersionedTable(spark, f"{root}/{t}") for t in asked - set(built)}
    held = {t: v.read() for t, v in others.items() if v.exists()}
    require_passed({**held, **{t: built[t] for t in wanted}}, suite)
    in_parallel(lambda t: tables[t].commit(pending[t]), wanted)
    fact = tables["fact_events"].read() if reports else None
    in_parallel(lambda r: tables[r].replace(REPORTS[r](fact)), reports)
    return tables


class FailedTests(ValueError):
    """Declared tests that did not pass, with their counts of failures."""


def require_passed(tables: Mapping[str, DataFrame], suite: Sequence[DataTest]) -> None:
    """Raise ``FailedTests`` unless every test in the suite passes, as far as its tables are there."""
    if not suite:
        return
    # One row per test, so what is collected does not grow with the data.
    failed = check_layers(tables, suite).filter("NOT passed").collect()
    if failed:
        raise FailedTests(", ".join(f"{r.test}: {r.failures}" for r in failed))


def _stage_events(
    raw: DataFrame, existing: DataFrame | None = None, lookback: str | None = None
) -> DataFrame:
    whole = "payload" in raw.columns
    staging = learning.stg_events if whole else learning.stg_events_flat
    return staging(raw, existing, lookback)


def run_reports(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {name: build(tables["fact_events"]) for name, build in REPORTS.items()}


def check_layers(
    tables: Mapping[str, DataFrame], suite: Sequence[DataTest] = learning.TESTS
) -> DataFrame:
    """The declared tests whose tables are there."""
    return run_tests(
        tables,
        [t for t in suite if t.table in tables and (t.parent is None or t.parent in tables)],
    )
