"""Steps of the search for repeated strings: what moves, how much at once, and that bytes decide."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from sparkelt.llm import suffix


def letters(seed, n, alphabet="abcdefghijklmnopqrstuvwxyz "):
    rng = random.Random(seed)
    return "".join(rng.choice(alphabet) for _ in range(n))


def texts_batch(texts):
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(texts)), pa.int64()), pa.array([t.encode() for t in texts], pa.binary())], names=["tid", "bytes"]
    )


def by(name, batches):
    rows = pa.Table.from_batches(batches).sort_by(name)
    return rows.combine_chunks().to_batches(max_chunksize=3)


def test_shared_anchors_go_back_in_a_row_per_part_and_group_of_texts():
    passage = letters("passage", 600)
    texts = [f"{letters(n, 80)}{passage}" for n in range(200)] + [letters("alone", 400)]
    anchors = list(suffix._anchor_blocks(3)(iter([texts_batch(texts[:90]), texts_batch(texts[90:])])))
    assert sum(b.num_rows for b in anchors) == 6
    renumbered = [
        b.set_column(1, "ids", pa.array([(np.frombuffer(i, "<i8") + 90 * (n > 0)).tobytes() for i in b.column("ids").to_pylist()], pa.binary()))
        for n, b in enumerate(anchors)
    ]
    shared = list(suffix._shared_in_part(4)(iter(by("part", renumbered))))
    assert sum(b.num_rows for b in shared) <= 3 * 4  # not a row per part and text
    told = pa.Table.from_batches(suffix._shared_of_texts(iter(by("group", shared)))).to_pylist()
    assert sorted(r["tid"] for r in told) == list(range(200))
    want = None
    for r in told:
        found = set(np.frombuffer(r["shared"], "<u8").tolist())
        assert not r["hot"]
        want = found if want is None else want & found
    data = np.frombuffer(passage.encode(), np.uint8)
    _, keys = suffix._anchor_runs(data, np.arange(len(data) - suffix.WIDTH + 1))
    assert set(suffix._short(keys, 3).tolist()) <= want


def test_short_strings_in_common_move_nothing(spark, docs_of):
    """Texts that share strings of 20 bytes only: by anchors of 16 bytes, all of them moved."""
    common = letters("common", 20)
    texts = [letters(n, 40) + "".join(common + letters(100 * n + k, 20) for k in range(30)) for n in range(12)]
    told = docs_of(list(enumerate(texts))).selectExpr(
        "doc_id owner", "xxhash64(text) tid", "xxhash64(text, 1) tid2", "octet_length(text) n_bytes", "encode(text, 'UTF-8') bytes"
    )
    first = told.select("tid", "tid2", "owner")
    assert suffix._shared_blocks(told, first, 2).count() == 0


@pytest.mark.parametrize("clash", [False, True])
def test_smallest_owner_is_decided_by_bytes(monkeypatch, clash):
    """Also where identifiers of different strings are the same."""
    if clash:
        monkeypatch.setattr(suffix, "_named", lambda words, starts: words[starts] % np.uint64(3))
    rng = np.random.default_rng(5)
    for alphabet, size in ((1, 300), (2, 900), (26, 4000)):
        data = rng.integers(97, 97 + alphabet, size).astype(np.uint8)
        data = np.r_[data, data[50:180], data[: size // 2]]
        starts = np.flatnonzero(rng.random(len(data) - suffix.WIDTH + 1) < 0.8)
        owner = rng.integers(0, 40, len(starts))
        strings = [data[s : s + suffix.WIDTH].tobytes() for s in starts]
        least = {}
        for s, o in zip(strings, owner.tolist()):
            least[s] = min(o, least.get(s, o))
        assert suffix.smallest_owner(data, starts, owner).tolist() == [least[s] for s in strings]


def test_refinement_holds_few_bytes_and_whole_buckets(monkeypatch):
    monkeypatch.setattr(suffix, "REFINE_BYTES", 2000)
    rng = random.Random(3)
    rows = sorted((rng.randrange(60) ** 2, bytes(rng.randrange(50, 90))) for _ in range(900))
    batches = pa.table({"key": pa.array([k for k, _ in rows], pa.int64()), "segment": pa.array([s for _, s in rows], pa.binary())}).to_batches(
        max_chunksize=37
    )
    tables = list(suffix._whole_buckets(iter(batches)))
    keys = [set(t.column("key").to_pylist()) for t in tables]
    assert sum(map(len, keys)) == len(set().union(*keys)) == len({k for k, _ in rows})
    assert [r for t in tables for r in zip(t.column("key").to_pylist(), t.column("segment").to_pylist())] == rows
    largest = max(sum(len(s) for k, s in rows if k == key) for key in {k for k, _ in rows})
    assert max(sum(map(len, t.column("segment").to_pylist())) for t in tables) < 2000 + largest


@pytest.mark.parametrize("piece", [64, 1000, 1 << 16])
def test_pieces_have_every_string_once(monkeypatch, piece):
    monkeypatch.setattr(suffix, "PIECE", piece)
    texts = [letters(n, size) for n, size in enumerate([0, 49, 50, 51, 63, 64, 65, 5000, 3, 200, 1049, 1050, 0])]
    column = pa.array([b"before", *[t.encode() for t in texts]], pa.binary()).slice(1)
    found = [
        (int(n), int(p), data[s : s + suffix.WIDTH].tobytes().decode())
        for data, starts, owner, place in suffix._pieces(*suffix._binary(column))
        for s, n, p in zip(starts, owner, place)
    ]
    assert found == [(n, p, t[p : p + suffix.WIDTH]) for n, t in enumerate(texts) for p in range(len(t) - suffix.WIDTH + 1)]


def test_spans_join_and_what_is_left_is_hashed():
    text = letters("text", 400).encode()
    run = pa.list_(pa.struct([("start", pa.int64()), ("count", pa.int64())]))
    some = [(100, 1), (10, 5), (150, 2), (300, 51), (12, 1)]
    runs = [[{"start": s, "count": c} for s, c in of_text] for of_text in (some, [(0, 351)])]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([7, 8], pa.int64()), pa.array([1, 2], pa.int64()), pa.array([text, text], pa.binary()), pa.array(runs, run)],
        names=["owner", "tid", "bytes", "runs"],
    )
    one, two = pa.Table.from_batches(suffix._cut(iter([batch]))).to_pylist()
    spans = [[10, 64], [100, 201], [300, 400]]
    left = text[:10] + text[64:100] + text[201:300]
    assert (one["spans"], one["n_removed"], one["n_spans"]) == (spans, 54 + 101 + 100, 3)
    assert one["kept_sha256"] == hashlib.sha256(left).hexdigest()
    assert (two["spans"], two["n_removed"], two["kept_sha256"]) == ([[0, 400]], 400, hashlib.sha256(b"").hexdigest())


def test_a_word_repeated_all_over_a_text_is_one_segment():
    word = "over and over "
    block = (word * 300).encode()
    batch = pa.RecordBatch.from_arrays(
        [
            *[pa.array([n, n + 10], pa.int64()) for n in (1, 2, 3)],
            pa.array([block, block + letters("end", 60).encode()], pa.binary()),
            pa.array([b"", b""], pa.binary()),
        ],
        names=["a", "b", "first", "block", "hot"],
    )
    segments = pa.Table.from_batches(suffix._segments(4)(iter([batch]))).sort_by("key")
    assert segments.num_rows < 60
    strings = sum((len(r["segment"]) - suffix.WIDTH + 1) * len(r["places"]) // 8 for r in segments.to_pylist())
    assert strings == 2 * (len(block) - suffix.WIDTH + 1) + 60
    runs = pa.Table.from_batches(suffix._refine(iter(segments.combine_chunks().to_batches()))).to_pylist()
    gone = {r["offset"] + n for r in runs for n in range(r["count"])}
    assert {(r["a"], r["least"]) for r in runs} == {(11, 3)}
    assert gone == set(range(len(block) - suffix.WIDTH + 1)) and sum(r["count"] for r in runs) == len(gone)
