"""Several incremental runs over random batches against a plain-Python account of the same rules."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from sparkelt import schemas as S
from sparkelt.plans import pipeline as P

MONEY = [None, -1.0, 0.0, 1.5, 1.5, 1.5, 1.5]


def random_row(rng: random.Random, feed: S.FeedSpec, at: datetime) -> dict:
    """A raw row; few keys, so batches overlap, and every rule is hit now and then."""
    n = rng.randrange(24)
    start = datetime(2024, 1, 1 + n % 6, n, 15)
    row = {f.name: rng.choice(MONEY) for f in feed.raw_schema.fields}
    row |= {
        "trip_id": None if rng.random() < 0.03 else f"{feed.name}{n}",
        "VendorID": rng.choice([1, 2, 3]) if rng.random() > 0.03 else None,
        feed.pickup: start,
        feed.dropoff: start + timedelta(minutes=rng.choice([-5, 0, 7, 45, 45, 45])),
        "store_and_fwd_flag": "N",
        "RatecodeID": rng.choice([None, 1, 2, 6, 7]),
        "PULocationID": 100 + n,
        "DOLocationID": 1 + n,
        "passenger_count": rng.choice([None, 0, 1, 2, 2, 2]),
        "trip_distance": rng.choice([None, 0.0, 3.0, 3.0, 3.0]),
        "payment_type": rng.choice([None, 1, 2, 9]),
        "loaded_at": at + timedelta(seconds=rng.randrange(3600)),
    }
    if rng.random() < 0.7:  # most rows are clean, or nothing would pass thirteen flags
        row |= {c: 1.5 for c, t in feed.wire if t == "double"}
        row |= {"passenger_count": 1, "trip_distance": 3.0}
    if feed.has_trip_type:
        row["trip_type"] = rng.choice([None, 1, 2, 2, 3])
    return row


def rank(row: dict) -> tuple:
    """Sort key of versions: NULLs come last."""
    keys = (row["loaded_at"], row["fare_amount"], row["trip_distance"])
    return tuple((k is not None, k) if k is not None else (False,) for k in keys)


class Account:
    """What the tables must hold after each run."""

    def __init__(self):
        self.staged = {f: {} for f in S.FEEDS}
        self.fact, self.dims = {}, defaultdict(dict)
        self.marks = dict.fromkeys(S.FEEDS)

    def run(self, raw: dict[str, list[dict]]) -> None:
        fresh_trips = []
        for name, feed in S.FEEDS.items():
            new = {}
            for r in raw[name]:
                needed = [r["trip_id"], *[r[c] for c in feed.id_cols]]
                newer = self.marks[name] is None or r["loaded_at"] > self.marks[name]
                if newer and None not in needed and r[feed.dropoff] > r[feed.pickup]:
                    old = new.get(r["trip_id"])
                    if old is None or rank(r) > rank(old):
                        new[r["trip_id"]] = r
            self.staged[name] |= new
            if new:
                self.marks[name] = max(r["loaded_at"] for r in new.values())
            fresh_trips += [(feed, r) for r in new.values() if self.passes(feed, r)]
        latest = defaultdict(dict)
        for feed, r in fresh_trips:
            code = lambda c: c if c in S.CLEAN_CODES else -1
            keys = {
                "dim_vendor": [r["VendorID"]],
                "dim_payment": [code(r["payment_type"])],
                "dim_ratecode": [code(r["RatecodeID"])],
                "dim_trip_type": [r["trip_type"] if feed.has_trip_type else 1],
                "dim_location": [r["PULocationID"], r["DOLocationID"]],
            }
            for dim, members in keys.items():
                for m in members:
                    latest[dim][m] = max(latest[dim].get(m, r["loaded_at"]), r["loaded_at"])
            minutes = (r[feed.dropoff] - r[feed.pickup]).total_seconds() / 60
            night = int(r[feed.pickup].hour >= 22 or r[feed.pickup].hour < 6)
            self.fact[r["trip_id"]] = (
                keys["dim_vendor"][0],
                keys["dim_payment"][0],
                keys["dim_ratecode"][0],
                keys["dim_trip_type"][0],
                r["fare_amount"],
                float(int(minutes + 0.5)),
                night,
                int(r[feed.pickup].weekday() >= 5),
                r["loaded_at"],
            )
        for dim, members in latest.items():
            self.dims[dim] |= members

    @staticmethod
    def passes(feed: S.FeedSpec, r: dict) -> bool:
        amounts = [r[feed.staged_columns[c]] for c in feed.amount_cols]
        strictly = [r["passenger_count"], r["trip_distance"]]
        good = all(a is not None and a >= 0 for a in amounts)
        good &= all(v is not None and v > 0 for v in strictly)
        return good and (not feed.has_trip_type or r["trip_type"] in S.TRIP_TYPES)


@pytest.mark.parametrize("seed", [3, 11])
def test_runs_agree_with_the_account(spark, warehouse, seed):
    rng, account = random.Random(seed), Account()
    raw = {f: [] for f in S.FEEDS}
    for step in range(3):
        at = datetime(2024, 2, 1, 1 + 2 * step)
        for name, feed in S.FEEDS.items():
            if not (step == 1 and name == "yellow"):  # one feed pauses
                raw[name] += [random_row(rng, feed, at) for _ in range(80)]
        frames = {
            name: spark.createDataFrame(
                [tuple(r[c] for c in S.FEEDS[name].raw_schema.names) for r in rows],
                S.FEEDS[name].raw_schema,
            )
            for name, rows in raw.items()
        }
        P.run_models(warehouse, frames)
        account.run(raw)
        for name in S.FEEDS:
            got = {r.trip_id: r.loaded_at for r in warehouse.read(P.STAGING[name].table).collect()}
            assert got == {k: r["loaded_at"] for k, r in account.staged[name].items()}
        columns = (
            "vendor_id payment_id ratecode_id trip_type_id fare_amount trip_duration night_flag "
            "weekend_flag loaded_at"
        ).split()
        fact = warehouse.read(P.FACT.table).select("trip_id", *columns).collect()
        assert {r[0]: tuple(r[1:]) for r in fact} == account.fact and len(fact) == len(account.fact)
        for name, model in P.DIMS.items():
            rows = warehouse.read(model.table).collect()
            assert {r[0]: r[2] for r in rows} == account.dims[name] and len(rows) == len(account.dims[name])
    assert len(account.fact) > 15
