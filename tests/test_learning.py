"""The learning models on hand-made events, against plain Python."""

from __future__ import annotations

import datetime as dt
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.checks import DataTest
from tidemark.plans import learning
from tidemark.plans.graph import Model, run_graph
from tidemark.plans.layers import FailedTests, check_layers, publish_layers, run_layers
from tidemark.session import write_through
from tidemark.sinks.versions import VersionedTable
from tidemark.sources.files import variant_payload

QUIET = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def event(n, kind="view", user="u1", course="c1", ts="2024-01-01T10:00:00", duration=None, rating=None):
    return {
        "id": f"e{n}",
        "actor": {"account": {"name": user}},
        "object": {"id": course},
        "verb": {"id": kind},
        "timestamp": ts,
        "result": {"duration": duration, "rating": rating},
        "context": {"platform": "ios", "app_version": "1", "device": "d", "ip": "::1", "session_id": "s"},
    }


def raw_events(spark, *events):
    lines = [(e if isinstance(e, str) else json.dumps(e),) for e in events]
    return spark.createDataFrame(lines, "value string").select(variant_payload("value").alias("payload"))


def staged(spark, *events):
    return learning.stg_events(raw_events(spark, *events))


def test_stg_events(spark):
    got = {
        r.event_id: r
        for r in staged(
            spark,
            event(1, duration="PT1H1M30S", rating=4.5),
            event(2, duration=59, rating="3"),
            event(3, duration="soon", rating="good", ts="no time"),
            {"id": "e4"},
            "not json",
        ).collect()
    }
    assert got["e1"].time_spent_sec == 3690 and got["e1"].raw_duration == "PT1H1M30S"
    assert got["e1"].event_ts == dt.datetime(2024, 1, 1, 10) and got["e1"].ip_address == "::1"
    assert got["e2"].time_spent_sec == 59 and got["e2"].rating == 3.0
    assert got["e3"].time_spent_sec is None and got["e3"].rating is None and got["e3"].event_ts is None
    assert got["e4"].user_id is None and got[None].event_sk is not None


def python_score(kind, seconds, rating):
    points = {"complete": 5, "start": 3, "view": 1}.get(kind, 0)
    minutes = min(int((seconds or 0) / 60), 5)
    return points + minutes + (2 if rating is not None and rating > 0 else 0)


KINDS = ["view", "start", "complete", "rate", "skip", None]


@QUIET
@given(
    st.lists(
        st.tuples(
            st.sampled_from(KINDS),
            st.one_of(st.none(), st.sampled_from([-61, -1, 0, 59, 60, 300, 301, 99999])),
            st.one_of(st.none(), st.sampled_from([0, 1, 4.5, -1])),
        ),
        min_size=1,
        max_size=8,
    )
)
def test_fact_events(spark, cases):
    events = [event(i, k, duration=s, rating=r) for i, (k, s, r) in enumerate(cases)]
    fact = {r.event_id: r for r in learning.fact_events(staged(spark, *events)).collect()}
    for i, (kind, seconds, rating) in enumerate(cases):
        row = fact[f"e{i}"]
        assert row.engagement_score == python_score(kind, seconds, rating)
        assert row.is_completed == (kind == "complete")
        assert row.has_rating == (rating is not None and rating > 0)
        assert row.safe_rating == (rating or None)
        assert row.safe_time_spent_sec == max(seconds or 0, 0)
        assert row.event_category == (kind if kind in KINDS[:4] else "other")


def test_enrollment_channels(spark):
    sources = ["ORGANIC_search", "paid-ads", "paid organic", "email", None]
    data = [(f"n{i}", "u", "c", dt.datetime(2024, 1, 1), s) for i, s in enumerate(sources)]
    df = spark.createDataFrame(
        data,
        "enrollment_id string, user_id string, course_id string, enrolled_at timestamp_ntz,"
        " enrollment_source string",
    )
    fact = learning.fact_enrollments(learning.stg_enrollments(df))
    got = [r.enrollment_channel for r in fact.orderBy("enrollment_id").collect()]
    assert got == ["organic", "paid", "organic", "unknown", "unknown"]


def test_reports(spark):
    fact = learning.fact_events(
        staged(
            spark,
            event(1, "start", "u1"),
            event(2, "complete", "u1"),
            event(3, "start", "u2"),
            event(4, "complete", "u3", ts="2024-01-08T00:00:00"),
            event(5, "view", None),
            event(6, "view", "u9", course="c2", ts="nonsense"),
        )
    )
    daily = learning.daily_active_learners(fact).collect()
    assert [tuple(r) for r in daily] == [
        (None, 1),
        (dt.date(2024, 1, 8), 1),
        (dt.date(2024, 1, 1), 2),
    ]
    weekly = learning.weekly_active_learners(fact).collect()
    assert [tuple(r) for r in weekly][1:] == [(dt.date(2024, 1, 8), 1), (dt.date(2024, 1, 1), 2)]
    assert rows(learning.course_completion_rates(fact)) == [("c1", 3, 2, 2 / 3)]


def raw_tables(spark, *events, created="2024-01-01"):
    day = dt.datetime.fromisoformat(created)
    return {
        "users": spark.createDataFrame(
            [("u1", "ann o'neil", "de", day), ("u2", "bob", None, day)],
            "user_id string, name string, country string, created_at timestamp_ntz",
        ),
        "courses": spark.createDataFrame(
            [("c1", "t", None, "easy", day)],
            "course_id string, title string, category string, difficulty string, created_at timestamp_ntz",
        ),
        "enrollments": spark.createDataFrame(
            [("n1", "u1", "c1", day, "paid"), ("n2", "u9", "c1", day, "organic")],
            "enrollment_id string, user_id string, course_id string, enrolled_at timestamp_ntz,"
            " enrollment_source string",
        ),
        "events": raw_events(spark, *events),
    }


FIRST = [event(1), event(2, "start", ts="2024-01-02T00:00:00")]
SECOND = [
    event(2, "complete", ts="2024-01-03T00:00:00"),
    event(3, ts="2024-01-04T00:00:00", course="c9"),
    event(4, ts="2024-01-01T00:00:00"),
]


def test_layers_over_two_runs(spark):
    out = run_layers(raw_tables(spark, *FIRST))
    assert rows(out["fact_events"], "event_id", "event_type") == [("e1", "view"), ("e2", "start")]
    out = run_layers(raw_tables(spark, *SECOND, created="2024-02-01"), out)
    # e2 is replaced, e3 is new, e4 is older than the mark.
    want = [("e1", "view"), ("e2", "complete"), ("e3", "view")]
    assert rows(out["stg_events"], "event_id", "event_type") == want
    assert rows(out["fact_events"], "event_id", "event_type") == want
    assert out["users_snapshot"].count() == 4 and out["dim_users"].count() == 2
    assert out["daily_active_learners"].count() == 3
    failed = {r.test: r.failures for r in check_layers(out).filter("not passed").collect()}
    assert failed == {
        "not_null(dim_users.country_code)": 1,
        "not_null(dim_courses.category)": 1,
        "relationships(stg_enrollments.user_id -> stg_users.user_id)": 1,
        "relationships(fact_enrollments.user_id -> dim_users.user_id)": 1,
        "relationships(stg_events.course_id -> stg_courses.course_id)": 1,
        "relationships(fact_events.course_id -> dim_courses.course_id)": 1,
    }
    assert len(learning.TESTS) == 34


def test_optional_datasets_may_be_absent(spark):
    raw = raw_tables(spark, *FIRST)
    out = run_layers({"events": raw["events"]})
    assert set(out) == {
        "stg_events", "fact_events", "daily_active_learners",
        "weekly_active_learners", "course_completion_rates",
    }


def test_published_layers_agree(spark, tmp_path):
    root = str(tmp_path / "school")
    first, second = raw_tables(spark, *FIRST), raw_tables(spark, *SECOND, created="2024-02-01")
    want = run_layers(second, run_layers(first))
    for raw in (first, second, second):
        tables = publish_layers(spark, raw, root, suite=())
    assert set(tables) == set(want)
    for name, df in want.items():
        got = tables[name].read().select(*df.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, df.collect())), name
    assert set(tables["fact_events"].manifest().parts) == {"2024-01-01", "2024-01-03", "2024-01-04"}
    assert set(tables["users_snapshot"].manifest().parts) == {"open", "settled"}


def test_failing_tests_withhold_every_table(spark, tmp_path):
    root = str(tmp_path / "gated")
    raw = raw_tables(spark, *FIRST)
    passing = [DataTest("fact_events", "not_null", "event_id")]
    failing = [*passing, DataTest("fact_events", "predicate", "event_id IS NOT NULL")]
    with pytest.raises(FailedTests, match="predicate"):
        publish_layers(spark, raw, root, suite=failing)
    names = ("fact_events", "dim_users", "users_snapshot", "daily_active_learners")
    assert not any(VersionedTable(spark, f"{root}/{t}").exists() for t in names)
    tables = publish_layers(spark, raw, root, suite=passing)
    assert all(tables[t].exists() for t in names) and tables["daily_active_learners"].read().count() > 0


def test_the_gate_holds_for_a_load_of_users_alone(spark, tmp_path):
    root = str(tmp_path / "users")
    raw = raw_tables(spark, *FIRST)
    publish_layers(spark, {"users": raw["users"]}, root, suite=KEYS)
    broken = {"users": raw["users"].withColumn("user_id", F.when(F.col("user_id") != "u2", F.col("user_id")))}
    with pytest.raises(FailedTests, match="not_null\\(dim_users.user_id\\)"):
        publish_layers(spark, broken, root, suite=KEYS)
    assert rows(VersionedTable(spark, f"{root}/dim_users").read(), "user_id") == [("u1",), ("u2",)]
    # A relationship is tested against the parent published before.
    edge = [DataTest("fact_enrollments", "relationships", "user_id", "dim_users", "user_id")]
    with pytest.raises(FailedTests, match="fact_enrollments: 1|dim_users.user_id\\): 1"):
        publish_layers(spark, {"enrollments": raw["enrollments"]}, root, suite=edge)


KEYS = [t for t in learning.TESTS if t.kind in ("not_null", "unique") and t.column in ("user_id", "user_sk")]


def test_raw_tables_are_read_once(spark, tmp_path):
    """Staging, history, dimensions, facts, reports and 34 tests read each raw row once."""
    count = spark.sparkContext.accumulator(0)

    def passed(batches):
        for b in batches:
            count.add(b.num_rows)
            yield b

    raw = raw_tables(spark, *FIRST)
    raw["events"] = raw["events"].select(F.to_json("payload").alias("line"))
    size = sum(df.count() for df in raw.values())
    seen = {n: df.mapInArrow(passed, df.schema) for n, df in raw.items()}
    seen["events"] = seen["events"].select(variant_payload("line").alias("payload"))
    publish_layers(spark, seen, str(tmp_path), suite=())
    assert count.value == size
    count.value = 0
    tables = run_layers(seen, keep=lambda name, df: write_through(df, name))
    check_layers(tables).collect()
    assert count.value == size


def test_graph():
    ran, kept = [], []
    build = lambda name: lambda *parents: ran.append(name) or f"{name}({','.join(parents)})"
    models = [
        Model("a", ("s",), build("a")), Model("b", ("a",), build("b")), Model("c", ("a", "t"), build("c")),
        Model("d", ("b", "c"), build("d")), Model("unused", ("s",), build("unused")),
    ]
    keep = lambda name, df: kept.append(name) or df
    out = run_graph(models, {"s": "s", "t": "t"}, ["d", "b"], keep)
    assert out["d"] == "d(b(a(s)),c(a(s),t))" and sorted(ran) == ["a", "b", "c", "d"]
    # Only what several others need, or what is wanted and needed, is written.
    assert sorted(kept) == ["a", "b"]
    with pytest.raises(KeyError):
        run_graph(models, {"s": "s"}, ["d"], keep)
    with pytest.raises(ValueError, match="wait"):
        run_graph([Model("x", ("y",), build("x")), Model("y", ("x",), build("y"))], {}, ["x"], keep)


def test_registered_layers_are_gated(spark, monkeypatch):
    from tidemark.plans import layers as plans
    from workload import layers

    ran = []
    gate = plans.require_passed
    monkeypatch.setattr(plans, "require_passed", lambda tables, suite: (ran.append({t.kind for t in suite}), gate(tables, suite)))
    layers.materialized_layers(spark, "/root/testdata/sf0.001")
    assert ran == [{"not_null", "unique"}] * 2
