"""Models run in the order of their inputs."""

import threading
from dataclasses import replace

import pytest

from sparkelt import schemas as S
from sparkelt.fixtures import raw_feed
from sparkelt.plans import pipeline as P
from sparkelt.plans.graph import run_in_order, with_upstream
from sparkelt.plans.incremental import Model


def test_jobs_start_after_what_they_read():
    reads = {"d": {"b", "c"}, "b": {"a"}, "c": {"a"}, "a": set(), "alone": set()}
    seen, both = [], threading.Barrier(2, timeout=20)

    def job(node, done):
        if node in ("b", "c"):
            both.wait()  # passes only if they run side by side
        seen.append(node)
        return node + "".join(sorted(done.values()))

    assert run_in_order(reads, job) == {"a": "a", "b": "ba", "c": "ca", "d": "dbaca", "alone": "alone"}
    assert seen.index("a") < min(seen.index("b"), seen.index("c")) and seen.index("d") > seen.index("c")
    assert with_upstream(reads, ["b"]) == {"a", "b"}
    assert run_in_order({}, job) == {}


def test_a_failure_is_raised_and_stops_what_depends_on_it():
    seen = []

    def job(node, done):
        if node == "a":
            raise RuntimeError("lost")
        seen.append(node)

    with pytest.raises(RuntimeError, match="lost"):
        run_in_order({"a": set(), "b": {"a"}, "c": set()}, job)
    assert seen == ["c"]


def test_cycles_and_unknown_inputs_are_errors(warehouse):
    both = replace(P.INT_BOTH, inputs={**P.INT_BOTH.inputs, "fact_trip": None})
    with pytest.raises(ValueError, match="cycle"):
        P.run_models(warehouse, models=P.MODELS | {"int_both_taxi": both})
    lost = replace(P.FACT, inputs={"nowhere": None})
    with pytest.raises(ValueError, match="nowhere"):
        P.run_models(warehouse, models=P.MODELS | {"fact_trip": lost})


def test_the_order_of_all_models():
    reads = P.reads(P.MODELS)
    assert reads["int_both_taxi"] == {"stg_green_taxi", "stg_yellow_taxi"} and reads["dims"] == {"int_metrics_added"}
    assert reads["fact_trip"] == {"int_metrics_added"} and reads["stg_green_taxi"] == set()


def test_an_added_model_needs_nothing_but_its_inputs(spark, sf_dir, warehouse):
    table = replace(P.INT_METRICS.table, name="long_trips")
    model = Model(table, {"int_metrics_added": None}, lambda rows: rows.filter("trip_duration > 30"))
    raw = {f.name: raw_feed(spark, sf_dir, f) for f in S.FEEDS.values()}
    models = P.MODELS | {"long_trips": model}
    done = P.run_models(warehouse, raw, only=["long_trips"], models=models)
    assert list(done) == ["stg_green_taxi", "stg_yellow_taxi", "int_both_taxi", "int_metrics_added", "long_trips"]
    want = warehouse.read(P.INT_METRICS.table).filter("trip_duration > 30").count()
    assert warehouse.read(table).count() == want > 0
    assert done["long_trips"].after == done["int_both_taxi"].after
