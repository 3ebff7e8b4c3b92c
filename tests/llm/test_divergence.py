"""Divergence of sources against a plain computation over the dense tables."""

import random
import re
from collections import Counter, defaultdict

import pytest

from sparkelt.llm import divergence

KIND = "doc_id long, text string, lang string, source string, n string, term string, row string, share string"


def expected(rows, top):
    docs = [(la or "", s or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for _, t, la, s in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        held = Counter(t for d in mine for t in set(d[2]))
        kept = [t for t, n in held.items() if n >= 3]
        counts = defaultdict(Counter)
        for _, source, words in mine:
            counts[source].update(w for w in words if held[w] >= 3)
        whole = sum(counts.values(), Counter())

        def shares(c):
            below = sum(c.values()) + len(kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 1) // below for t in kept}

        p = {s: shares(c) for s, c in counts.items()}
        q = shares(whole)
        for s in p:
            found = [(sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in p if o != s]
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, s, "pair", o, v, i + 1) for i, (v, o) in enumerate(found)]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in kept if counts[s][t] and p[s][t] > q[t]]
            terms.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, s, "term", t, v, i + 1) for i, (v, t) in enumerate(terms[:top])]
    return out


def check(spark, rows, top=divergence.TOP):
    frame = spark.createDataFrame([(*r, None, "x", None, "y") for r in rows], KIND).repartition(4)
    found = [tuple(r) for r in divergence.audit(frame, top=top).collect()]
    assert sorted(found) == sorted(expected(rows, top))
    return found


def made(seed, n=300, sources=7):
    rng = random.Random(seed)
    words = ["the", "The", "of", "ÉTÉ", "été", "漢字", "a1b", "x-y", "😀", *[f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]]
    names = [None, "", "s0", "S0", "é", *[f"s{i}" for i in range(1, sources - 3)]]
    rows = []
    for i in range(n):
        source = "s0" if i % 3 == 0 else rng.choice(names)
        text = " ".join(rng.choice(words[: rng.choice((9, 40, 129))]) for _ in range(rng.randrange(30)))
        rows.append((i, None if i % 50 == 0 else text, rng.choice(["en", "en", "de", None, ""]), source))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_random_groups(spark, seed):
    check(spark, made(seed))


def test_scatter_in_small_steps(monkeypatch):
    import pyarrow as pa

    rng = random.Random(5)
    terms = [sorted(rng.sample(range(6), rng.randrange(2, 7))) for _ in range(80)]
    zero = [rng.randrange(1, 50) for _ in range(6)]
    posts = [[{"row": j, "share": zero[j] + rng.randrange(1000), "zero": zero[j]} for j in t] for t in terms]
    kind = pa.list_(pa.struct([("row", pa.int32()), ("share", pa.int64()), ("zero", pa.int64())]))
    batch = pa.RecordBatch.from_arrays(
        [pa.array([("en", "de")[i % 2] for i in range(80)]), pa.array([6] * 80), pa.array(posts, kind)], ["lang", "peers", "posts"]
    )
    def total(step, cells):
        monkeypatch.setattr(divergence, "STEP", step)
        monkeypatch.setattr(divergence, "CELLS", cells)
        out = Counter()
        for b in divergence._scatter([batch.slice(0, 33), batch.slice(33)]):
            for r in b.to_pylist():
                out[r["lang"], r["g"], r["h"]] += r["value"]
        return out

    def f(p, q):
        return (p - q) ** 2 // q

    want = Counter()
    for i, post in enumerate(posts):
        for a in post:
            for b in post:
                value = f(a["share"], b["share"]) - f(a["share"], b["zero"]) - f(a["zero"], b["share"]) + f(a["zero"], b["zero"])
                want[("en", "de")[i % 2], a["row"], b["row"]] += value
    for step, cells in ((1 << 20, 1 << 20), (7, 3), (1, 1)):
        got = total(step, cells)
        assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v}


def test_counting_in_small_steps(monkeypatch):
    import pyarrow as pa

    texts = [f"a b{'b' * (i % 5)} a" for i in range(40)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 40), pa.array(["s", "t"] * 20), pa.array([t.encode() for t in texts])], ["lang", "source", "text"])
    monkeypatch.setattr(divergence, "ENTRIES", 1)
    monkeypatch.setattr(divergence, "TEXTS_AT_ONCE", 3)
    got = Counter()
    for b in divergence._count([batch]):
        for r in b.to_pylist():
            got[r["source"], r["term"], "n"] += r["n"]
            got[r["source"], r["term"], "docs"] += r["docs"]
    assert got["s", "a", "n"] == 40 and got["s", "a", "docs"] == 20
    assert ("s", None, "n") in got


def test_few_ranks(spark):
    check(spark, made(4), top=3)


def test_odd_tables(spark):
    check(spark, [(1, None, None, None), (1, None, None, "s"), (2, "1 2 3", "en", "s"), (2, "1 2 3", "en", "s")])
    check(spark, [(1, "same " * 100_000, "en", "s"), (1, "same " * 100_000, "en", "s"), (2, "same", "en", "t"), (3, "", "en", "u")])
    assert check(spark, []) == []


def test_index_rows_are_no_pairs(spark):
    """A term in half of all texts of many sources gives a row per source, not one per pair."""
    rows = [(i, "common", "en", f"s{i % 60:02}") for i in range(240)]
    found = check(spark, rows)
    assert len(found) == 60 * 59
