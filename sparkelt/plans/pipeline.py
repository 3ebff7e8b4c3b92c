"""All models in dependency order, then all checks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkelt import schemas as S
from sparkelt.operators.filters import since_marks
from sparkelt.operators.quality import CheckSpec
from sparkelt.plans import counters
from sparkelt.plans import models as M
from sparkelt.plans.graph import run_in_order, with_upstream
from sparkelt.plans.incremental import (
    Model,
    RunResult,
    apply_updates,
    current_marks,
    mirror,
    run_model,
)
from sparkelt.sources.warehouse import MarkDict, TableSpec, Warehouse

# --- stored models ----------------------------------------------------------------------------

PICKUP_DATE = T.StructField("pickup_date", T.DateType())
KEY_BLOCK = T.StructField("key_block", T.LongType())
KEYS_PER_BLOCK = 10_000


def _trip_table(layer: str, name: str, schema: T.StructType, sort=None, indexed: bool = False) -> TableSpec:
    # trip_id is a hash over the pickup time among others: one trip_id, one pickup date.
    day = lambda: F.to_date("pickup_datetime")
    return TableSpec(layer, name, schema, "trip_id", PICKUP_DATE, day, sort, indexed)


def _staging_model(feed: S.FeedSpec) -> Model:
    return Model(
        _trip_table("staging", feed.staging_name, S.staging_schema(feed), indexed=True),
        {f"raw_{feed.name}": feed.name},
        lambda raw: M.stg_valid(raw, feed),
        settle=M.stg_newest,
        finish=lambda core: M.stg_flags(core, feed),
        spread=True,
    )


def _dim_model(dim: M.Dimension) -> Model:
    block = lambda: F.expr(f"{dim.key} div {KEYS_PER_BLOCK}")
    order = lambda: [F.col(dim.key)]
    table = TableSpec("mart", dim.name, dim.schema, dim.key, KEY_BLOCK, block, order)
    return Model(table, {"int_metrics_added": None}, lambda metrics: M.dim_table(metrics, dim), spread=True, group="dims")


STAGING = {feed.name: _staging_model(feed) for feed in S.FEEDS.values()}
INT_BOTH = Model(
    _trip_table("intermediate", "int_both_taxi", S.INT_BOTH_SCHEMA, indexed=True),
    {feed.staging_name: feed.name for feed in S.FEEDS.values()},
    M.int_both_taxi,
)
INT_METRICS = Model(
    _trip_table("intermediate", "int_metrics_added", S.INT_METRICS_SCHEMA),
    {"int_both_taxi": None},
    M.int_metrics_added,
    rowwise=True,
)
FACT = Model(
    _trip_table(
        "mart", "fact_trip", S.FACT_SCHEMA, lambda: [F.col("pickup_datetime").desc()]
    ),
    {"int_metrics_added": None},
    M.fact_trip,
    rowwise=True,
)
DIMS = {d.name: _dim_model(d) for d in M.DIMENSIONS.values()}

MODELS = {m.name: m for m in (*STAGING.values(), INT_BOTH, INT_METRICS, FACT, *DIMS.values())}


# --- checks -----------------------------------------------------------------------------------


def _staging_checks(model: str) -> list[CheckSpec]:
    codes = (S.UNKNOWN_CODE, *S.CLEAN_CODES)
    present = (
        "trip_id",
        "vendor_id",
        "pickup_datetime",
        "dropoff_datetime",
        "pu_location_id",
        "do_location_id",
        "ratecode_id_clean",
        "payment_id_clean",
        "loaded_at",
    )
    return [
        CheckSpec(model, "dropoff_after_pickup"),
        *[CheckSpec(model, "not_null", c) for c in present],
        CheckSpec(model, "unique", "trip_id"),
        CheckSpec(model, "accepted_values", "vendor_id", S.VENDORS),
        CheckSpec(model, "accepted_values", "ratecode_id_clean", codes),
        CheckSpec(model, "accepted_values", "payment_id_clean", codes),
    ]


def _gated_checks(model: str) -> list[CheckSpec]:
    amounts = (*S.SHARED_AMOUNTS, *[f.fee for f in S.FEEDS.values()], "total_amount")
    return [
        *[CheckSpec(model, "positive", c) for c in ("passenger_count", "trip_distance")],
        *[CheckSpec(model, "positive_or_zero", c) for c in amounts],
        CheckSpec(model, "accepted_values", "trip_type", S.TRIP_TYPES),
        CheckSpec(model, "accepted_values", "taxi_type", S.FEED_NAMES),
    ]


def _fact_checks(model: str) -> list[CheckSpec]:
    return [
        CheckSpec(model, "relationships", c, to=d.name, field=d.key)
        for d in M.DIMENSIONS.values()
        for c in d.columns
    ]


CHECKS = [
    *[c for feed in S.FEEDS.values() for c in _staging_checks(feed.staging_name)],
    *_gated_checks("int_both_taxi"),
    *_fact_checks("fact_trip"),
]


# --- runs -------------------------------------------------------------------------------------


def reads(models: Mapping[str, Model]) -> dict[str, set[str]]:
    """Node -> nodes that it reads. A node is a model, or a group of them by its name."""
    feeds = {f"raw_{f}" for f in S.FEEDS}
    out: dict[str, set[str]] = {}
    for name, model in models.items():
        known = {models[i].group or i for i in model.inputs if i in models}
        if unknown := set(model.inputs) - set(models) - feeds:
            raise ValueError(f"{name} reads {sorted(unknown)}, neither models nor raw feeds")
        out.setdefault(model.group or name, set()).update(known)
    return out


def run_models(
    wh: Warehouse,
    raw: Mapping[str, DataFrame] | None = None,
    full_refresh: bool = False,
    only: Iterable[str] | None = None,
    models: Mapping[str, Model] = MODELS,
) -> dict[str, RunResult]:
    """Run every model once, in the order that their inputs give.

    ``raw`` replaces the warehouse's own raw tables, by feed name. ``only`` restricts the run to the
    named models, those of their groups, and what they are computed from. Independent models run
    side by side on the same session.
    """
    graph = reads(models)
    wanted = with_upstream(graph, {models[n].group or n for n in (models if only is None else only)})

    def job(node: str, before: dict[str, dict[str, RunResult]]) -> dict[str, RunResult]:
        done = {name: result for results in before.values() for name, result in results.items()}
        if node not in models:
            return GROUPS[node](wh, done, full_refresh)
        model = models[node]
        if model.rowwise:
            (upstream,) = model.inputs
            return {node: _follow(wh, model, models[upstream], done[upstream], full_refresh)}
        return {node: _run(wh, model, models, done, raw, full_refresh)}

    done = run_in_order({n: graph[n] for n in graph if n in wanted}, job)
    results = {name: result for part in done.values() for name, result in part.items()}
    return {name: results[name] for name in models if name in results}


def _run(
    wh: Warehouse,
    model: Model,
    models: Mapping[str, Model],
    done: Mapping[str, RunResult],
    raw: Mapping[str, DataFrame] | None,
    full_refresh: bool,
) -> RunResult:
    """A model from what its inputs have that is new to it."""
    own = None if full_refresh else current_marks(wh, model)
    inputs, complete = {}, {}
    for name, feed in model.inputs.items():
        if name in models:
            feeds = models[name].feeds if feed is None else (feed,)
            inputs[name] = _changed(wh, models[name], done[name], own, feeds)
            complete |= {f: done[name].after[f] for f in feeds}
        elif raw is not None:
            inputs[name] = raw[feed]
        else:
            inputs[name] = wh.read_raw(S.FEEDS[feed], own and own[feed])
    return run_model(wh, model, inputs, complete or None, full_refresh)


def _follow(wh: Warehouse, model: Model, upstream: Model, done: RunResult, full_refresh: bool) -> RunResult:
    """A row-wise model after its upstream's run."""
    return mirror(wh, model, upstream, done, None if full_refresh else current_marks(wh, model))


def _run_dims(wh: Warehouse, done: Mapping[str, RunResult], full_refresh: bool) -> dict[str, RunResult]:
    """The five dimensions from one scan of the new trips, unless their marks have drifted apart."""
    return {r.model: r for r in _dims_after(wh, done[INT_METRICS.name], full_refresh)}


def _dims_after(wh: Warehouse, metrics: RunResult, full_refresh: bool) -> list[RunResult]:
    marks = {d: None if full_refresh else current_marks(wh, m) for d, m in DIMS.items()}
    states = list(marks.values())
    before = states[0]
    fresh = _changed(wh, INT_METRICS, metrics, before, S.FEED_NAMES)
    if any(s != before for s in states):
        whole = wh.read(INT_METRICS.table)
        return _side_by_side(
            [
                lambda m=m: run_model(wh, m, {"int_metrics_added": whole}, metrics.after, full_refresh)
                for m in DIMS.values()
            ]
        )
    if before is not None:
        fresh = since_marks(fresh, before)
    members = M.dim_members(fresh, M.DIMENSIONS.values()).persist()
    try:
        members.count()

        def one(name: str) -> RunResult:
            rows = M.dim_from_members(members, M.DIMENSIONS[name])
            return apply_updates(wh, DIMS[name], rows, before, metrics.after)

        return _side_by_side([lambda n=n: one(n) for n in DIMS])
    finally:
        members.unpersist()


#: How the models of a group are run, given the results of what they read.
GROUPS = {"dims": _run_dims}


def _changed(
    wh: Warehouse, model: Model, result: RunResult, reader: MarkDict | None, feeds: Iterable[str]
) -> DataFrame:
    """The upstream table as its reader needs it: only the units this run wrote if the reader had
    consumed everything before this run, else the whole table."""
    in_step = reader is not None and all(reader.get(f) == result.before.get(f) for f in feeds)
    return wh.read(model.table, units=result.added if in_step else None)


def _side_by_side(jobs: list[Callable]) -> list:
    if not jobs:
        return []
    with ThreadPoolExecutor(len(jobs)) as pool:
        return list(pool.map(lambda job: job(), jobs))


def tables(wh: Warehouse) -> dict[str, DataFrame]:
    return {name: wh.read(m.table) for name, m in MODELS.items()}


def run_pipeline(
    wh: Warehouse, raw: Mapping[str, DataFrame] | None = None, full_refresh: bool = False
) -> DataFrame:
    """Run all models, then all checks; returns the check report. Bad rows are reported, not blocked."""
    run_models(wh, raw, full_refresh)
    return check_report(wh)


def check_report(wh: Warehouse) -> DataFrame:
    """All checks of the stored models; only what no earlier report has counted is read."""
    return counters.report(wh, {name: m.table for name, m in MODELS.items()}, CHECKS)


def table_counts(wh: Warehouse) -> DataFrame:
    """Rows per stored model."""
    counts = None
    for name, df in tables(wh).items():
        one = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("model"), "row_count"
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts
