"""The operators that shuffle or call Python: against brute force, exact round trips, held-out labels."""

import base64
import gzip
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

import corpus_pipeline
from sparkelt.llm import components, lines, mixing, simhash, suffix, tokens, warc

LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})
VOCABULARY = [a + b + c for a in ("ba", "de", "fi", "go", "lu") for b in "nrst" for c in ("a", "er", "in", "or")]


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


# --- SimHash ----------------------------------------------------------------------------------


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_reachable(rows):
    """Component ids by comparing all pairs; null ids do not count."""
    fps = [fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(i):
                if (fps[i] ^ fps[j]).bit_count() <= 2 and group[i] != group[j]:
                    group = [min(group[i], group[j]) if g in (group[i], group[j]) else g for g in group]
                    changed = True
    least = {g: min((rows[i][0] for i in range(len(rows)) if group[i] == g and rows[i][0] is not None), default=None) for g in group}
    return [(i, f, least[g]) for (i, _), f, g in zip(rows, fps, group)]


@pytest.mark.parametrize("per_part", [5, 10**6])
def test_simhash_groups_match_all_pairs(docs_of, edge_rows, monkeypatch, per_part):
    monkeypatch.setattr(simhash, "CODES_PER_PART", per_part)
    rows = list(edge_rows)
    for n in range(12):
        text = prose(n, 300)
        rows.append((100 + 10 * n, text))
        for k in range(1, 4):  # near copies: one word changed each
            words = text.split()
            words[17 * k] = "changed"
            rows.append((100 + 10 * n + k, " ".join(words)))
    got = Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in simhash.grouped(docs_of(rows)).collect())
    assert got == Counter(smallest_reachable(rows))
    docs = docs_of(rows)
    kept = simhash.dedup(docs)
    assert kept.columns == docs.columns
    want = Counter()
    for i, _, least in set(smallest_reachable(rows)):
        want[least] = 1
    assert Counter(r.doc_id for r in kept.collect()) == want
    assert simhash.grouped(docs_of([]).limit(0)).count() == 0


def test_index_finds_every_pair_in_dense_and_sparse_groups():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 2**63, dtype=np.uint64)
    dense = centre ^ (np.uint64(1) << rng.integers(0, 40, 300, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 40, 300, dtype=np.uint64))
    codes = np.unique(np.r_[dense, rng.integers(0, 2**63, 300, dtype=np.uint64)])
    groups = codes >> np.uint64(42)
    rank = codes.copy()
    for by in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(by)
    order = np.lexsort((rank, groups))
    codes, groups = codes[order], groups[order]
    index = simhash.Index(codes, groups)
    found = {(int(a), int(b)) for q, c in index.search(codes, groups) for a, b in zip(q, c)}
    apart = np.bitwise_count(codes[:, None] ^ codes[None, :])
    want = {(int(a), int(b)) for a, b in np.argwhere((apart <= 2) & (groups[:, None] == groups[None, :]))}
    assert found == want and len(want) > 2 * len(codes)


def test_stars_join_chains_and_cycles(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 104), (104, 100), (7, 7)]
    got = {(r.u, r.v) for r in components.stars(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {(i, 0) for i in range(1, 41)} | {(102, 100), (104, 100)}


# --- repeated strings -------------------------------------------------------------------------


def repeats(rows):
    docs = sorted(((2**63 if i is None else i), (t or "").encode(), i) for i, t in rows)
    seen, out, pending = set(), Counter(), []
    for n, (order, data, doc_id) in enumerate(docs):
        windows = [data[i : i + 50] for i in range(len(data) - 49)]
        gone = bytearray(len(data))
        for i, w in enumerate(windows):
            if w in seen:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(data, gone) if not g)
        spans = sum(1 for i in range(len(data)) if gone[i] and (not i or not gone[i - 1]))
        out[(doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
        pending += windows
        if n + 1 == len(docs) or docs[n + 1][0] != order:
            seen.update(pending)
            pending = []
    return out


@pytest.mark.parametrize("hot", [1, 10**6])
def test_repeated_bytes_match_brute_force(docs_of, edge_rows, monkeypatch, hot):
    monkeypatch.setattr(suffix, "HOT_TEXTS", hot)
    passage = prose("passage", 40)
    rows = list(edge_rows)
    for n in range(8):
        rows.append((20 + n, f"{prose(n, 30)} {passage if n % 2 else passage[:60]} {prose(n + 50, 20)}"))
    rows += [(40, rows[-1][1]), (41, rows[-2][1] + "é漢"), (42, "a" * 300), (43, "a" * 49), (44, "b" + "a" * 120), (20, passage)]
    got = suffix.repeats(docs_of(rows)).drop("spans").collect()
    assert Counter(tuple(r) for r in got) == repeats(rows)
    assert suffix.repeats(docs_of([]).limit(0)).count() == 0


# --- archives ---------------------------------------------------------------------------------


@pytest.mark.parametrize("segment", [700, 32768])
def test_archives_come_back_as_written(spark, tmp_path, segment):
    same = "<p>é漢" + "same " * 400
    pages = [
        (1, "http://a/\r\nx", same),
        (2, "http://b/ü", same),
        (3, None, same),
        (None, "http://n", same + "x"),
        (4, "http://c", None),
        (5, "http://d", ""),
        (6, "http://e", "short"),
        (7, "http://f", "short"),
        (8, "http://g", "WARC/1.0\r\nWARC-Type: response\r\n\r\n\r\n0\r\n\r\n" * 400),
        (9, "http://h", "z" * 1000),
        (9, "http://h", "z" * 1000),
        (2**60 + 1, "http://i", "far"),
    ]
    table = spark.createDataFrame([(*p, "x", 1) for p in pages], "page_id long, url string, html string, digest string, row int")
    got = warc.round_trip(table.repartition(3), str(tmp_path / "w"), segment).collect()
    want = Counter()
    done = set()
    for i, _, html in pages:
        data = (html or "").encode()
        best = max((p[0] or -1) for p in pages if (p[2] or "").encode() == data)
        first = i == best and (i, data) not in done
        done.add((i, data))
        response = len(data) < 1000 or first or i is None
        want[(i, len(data), hashlib.sha1(data).hexdigest(), "response" if response else "revisit", None if response else best)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want


def record(block, **fields):
    """A record as a foreign writer may make it: other case, other order, a folded line."""
    fields = {"Content-Length": str(len(block)), **{k.replace("_", "-"): v for k, v in fields.items()}}
    head = "".join(f"{k}:{v}\r\n" for k, v in fields.items())
    return b"WARC/1.1\r\nsoftware: some\r\n tool\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def stored(folder, **files):
    folder.mkdir()
    for name, content in files.items():
        (folder / name).write_bytes(content)
    return str(folder)


def sha1(data):
    return hashlib.sha1(data).hexdigest()


HTTP = b"HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"
FOREIGN = [
    record(b"software: x", WARC_Type="warcinfo", WARC_Record_ID="<urn:uuid:0>"),
    record(b"GET / HTTP/1.1\r\n\r\n", warc_type="request", WARC_Record_ID="<urn:uuid:1>"),
    record(
        HTTP + b"one",
        warc_type="response",
        WARC_RECORD_ID="<urn:uuid:2>",
        WARC_Target_URI="http://a/",
        WARC_Payload_Digest="sha1:" + base64.b32encode(hashlib.sha1(b"one").digest()).decode(),
    ),
    record(b"a. IN A 1.2.3.4", WARC_Type="response", WARC_Record_ID="<urn:uuid:3>", WARC_Payload_Digest="md5:00"),
    record(
        HTTP, WARC_Type="revisit", WARC_Record_ID="<urn:uuid:4>", WARC_Refers_To="<urn:uuid:2>", WARC_Payload_Digest=f"sha1:{sha1(b'one')}"
    ),
    record(
        b"HTTP/1.1 200 OK\r\nTransfer-Encoding:chunked\r\n\r\n3;x=y\r\ntwo\r\n0\r\n\r\n", WARC_Type="response", WARC_Record_ID="<urn:uuid:5>"
    ),
]
FOUND = [
    (None, "response", "<urn:uuid:2>", None, 3, sha1(b"one")),
    (None, "response", "<urn:uuid:3>", None, 15, sha1(b"a. IN A 1.2.3.4")),
    (None, "revisit", "<urn:uuid:4>", "<urn:uuid:2>", 3, sha1(b"one")),
    (None, "response", "<urn:uuid:5>", None, 3, sha1(b"two")),
]


def seen(spark, folder):
    columns = ("page_id", "record_type", "record_id", "refers_to_id", "payload_bytes", "payload_digest")
    return Counter(tuple(r[c] for c in columns) for r in warc.read(spark, folder).collect())


def test_a_member_per_record_is_written(spark, tmp_path):
    pages = spark.createDataFrame([(i, "http://a", "p" * i) for i in range(1, 30)], "page_id long, url string, html string")
    warc.write(pages.coalesce(1), str(tmp_path / "w"))
    (archive,) = (tmp_path / "w").glob("part-*")
    whole = archive.read_bytes()
    members, rest = [], whole
    while rest:
        one = zlib.decompressobj(31)
        members.append(one.decompress(rest))
        assert one.eof
        rest = one.unused_data
    assert len(members) == 29 and all(m.startswith(b"WARC/1.0\r\n") and m.endswith(b"\r\n\r\n") for m in members)
    assert gzip.decompress(whole) == b"".join(members)


def test_foreign_archives(spark, tmp_path):
    plain = b"".join(FOREIGN)
    forms = {
        "members": b"".join(gzip.compress(r) for r in FOREIGN),
        "one_member": gzip.compress(plain),
        "cut_anywhere": b"".join(gzip.compress(plain[i : i + 37]) for i in range(0, len(plain), 37)) + bytes(512),
        "plain": plain + b"\r\n",
    }
    for name, content in forms.items():
        assert seen(spark, stored(tmp_path / name, **{f"{name}.warc": content})) == Counter(FOUND), name
    spread = {f"{i}.warc.gz": gzip.compress(r) for i, r in enumerate(FOREIGN)}
    assert seen(spark, stored(tmp_path / "spread", **spread, **{"empty.warc": b""})) == Counter(FOUND)
    assert seen(spark, stored(tmp_path / "empty", **{"empty.warc.gz": b""})) == Counter()


@pytest.mark.parametrize(
    ("content", "error"),
    [
        (gzip.compress(FOREIGN[2]) + gzip.compress(FOREIGN[3])[:-3], "ends within a gzip member"),
        (FOREIGN[2] + FOREIGN[3][:-9], "ends within the record"),
        (gzip.compress(FOREIGN[2]) + gzip.compress(FOREIGN[3][:40]), "ends within the record"),
        (FOREIGN[2] + b"<html>", "no record at byte"),
        (FOREIGN[2].replace(b"Content-Length:3", b"Content-Length:2"), "does not end where its length says"),
        (FOREIGN[2].replace(b"\r\none", b"\r\noen"), "digest mismatch in record <urn:uuid:2>"),
        (FOREIGN[3] + FOREIGN[4], "no response for revisit <urn:uuid:4>"),
        (FOREIGN[2] + FOREIGN[4].replace(sha1(b"one").encode(), sha1(b"two").encode()), "digest mismatch in record <urn:uuid:4>"),
    ],
)
def test_broken_archives_stop_the_job(spark, tmp_path, content, error):
    with pytest.raises(Exception, match=error):
        warc.read(spark, stored(tmp_path / "w", **{"a.warc": content})).collect()


@pytest.mark.parametrize("lost", [0, 2, 4])
def test_a_missing_segment_is_noticed(spark, tmp_path, lost):
    records = warc.records_of(1, "http://a", b"x" * 5000, "0", sha1(b"x" * 5000), None, segment=1000)
    left = b"".join(r for n, r in enumerate(records) if n != lost)
    with pytest.raises(Exception, match="segments are missing"):
        warc.read(spark, stored(tmp_path / "w", **{"a.gz": gzip.compress(left)})).collect()


def test_no_pages_give_no_records(spark, tmp_path):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.round_trip(none, str(tmp_path / "w")).count() == 0


# --- token counts -----------------------------------------------------------------------------


def test_token_counts_are_those_of_whole_texts(docs_of, edge_rows, monkeypatch):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(tokens.MODEL))
    rows = edge_rows + [(10, "<s> </s> <unk> a  b   c \n d"), (11, "x" * 70000), (12, " lead"), (13, "漢字" * 40000)]
    got = Counter(tuple(r) for r in tokens.count(docs_of(rows)).collect())
    counts = [(i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in rows]
    assert got == Counter((i, b, n, n > 4096) for i, b, n in counts)
    dropped = tokens._processor(tokens.MODEL)[1]
    for _, text in rows:
        pieces = tokens.pieces_of(text or "", dropped, 100)
        assert sum(map(len, model.encode(pieces))) == len(model.encode(text or ""))
    assert tokens.count(docs_of([]).limit(0)).count() == 0


# --- line templates ---------------------------------------------------------------------------


def expected_lines(rows):
    """What is left of each row: the same rules, text by text and line by line."""
    texts = {}
    for i, t in rows:
        t = t or ""
        known = texts.get(t)
        texts[t] = min((x for x in (known, i) if x is not None), default=None)
    parsed = {t: [(at, line.split()) for at, line in enumerate(t.split("\n")) if line.split()] for t in texts}

    def is_field(token):
        return bool(re.search(r"[0-9@]|://", token))

    def leaf(tokens):
        return (len(tokens), *["<*>" if is_field(x) else x for x in tokens[:2]])

    holders = {}
    for t, found in parsed.items():
        for _, tokens in found:
            holders.setdefault(tuple(tokens), set()).add(t)
    values = Counter()
    for tokens, held in holders.items():
        for at, x in enumerate(tokens):
            if not is_field(x):
                values[leaf(tokens), at, x] += len(held)
    named, groups = {}, {}
    for tokens, held in holders.items():
        n = len(tokens)
        kept = tuple((at, x) for at, x in enumerate(tokens) if (values[leaf(tokens), at, x] - 1) * n >= lines.REPEATED)
        general = len(kept) >= lines.LITERAL * n and kept
        name = (leaf(tokens), kept) if general else (leaf(tokens), tokens)
        named[tokens] = name, len(kept) if general else n
        groups.setdefault(name, [set(), 0])
        groups[name][0] |= held
        groups[name][1] = max(groups[name][1], named[tokens][1])
    out = []
    for i, t in rows:
        drop = set()
        for at, tokens in parsed[t or ""]:
            held, literals = groups[named[tuple(tokens)][0]]
            known = [(texts[h], h) for h in held if texts[h] is not None]
            if (len(held) - 1) * literals >= lines.REPEATED and known and min(known)[1] != (t or ""):
                drop.add(at)
        left = None if t is None else "\n".join(x for at, x in enumerate(t.split("\n")) if at not in drop)
        out.append((i, left, len((t or "").split("\n")), len(drop)))
    return out


def check_lines(docs_of, rows, largest=lines.LEAF_TOKENS):
    got = [tuple(r) for r in lines.stripped(docs_of(rows), largest=largest).collect()]
    want = expected_lines(rows)
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return {i: (text, dropped) for i, text, _, dropped in want}


@pytest.mark.parametrize("largest", [lines.LEAF_TOKENS, 300, 0])
def test_line_templates_match_a_plain_account(docs_of, edge_rows, largest):
    """Leaves settled in a task each, the larger ones by shuffles, and all by shuffles."""
    rng = random.Random(4)
    forms = ["Page {} of the volume", "posted by {} in the garden forum", "{} replied to {} on this page today", "all rights are reserved by {} and others here", "same"]
    rows = list(edge_rows)
    for n in range(150):
        own = [prose(f"{n}-{k}", rng.randrange(1, 12)) for k in range(rng.randrange(4))]
        shared = [rng.choice(forms).format(rng.choice(VOCABULARY), rng.randrange(99)) for _ in range(rng.randrange(4))]
        text = own + shared
        rng.shuffle(text)
        rows.append((None if n % 40 == 7 else 1000 + n, rng.choice(["\n", "\n", "\n\n"]).join(text)))
    rows += [(3000 + n, rows[20 + n % 5][1]) for n in range(20)]  # exact copies
    found = check_lines(docs_of, rows, largest)
    assert sum(d for _, d in found.values()) > 50


def test_leaves_are_held_whole_however_they_come(monkeypatch):
    """Chunks of any size and batches cut anywhere give the lines that all rows at once give."""
    rng = random.Random(8)
    rows = []
    for _ in range(600):
        leaf, n = rng.randrange(12), rng.randrange(3)
        tokens = np.array([rng.randrange(1, 4) if k == 1 else 7 if k % 3 else rng.randrange(1, 500) for k in range(6 + leaf)], np.uint32)
        rows.append((leaf, hash(tokens.tobytes()), rng.randrange(40), n, rng.choice([None, rng.randrange(99)]), rng.randrange(5), tokens.tobytes()))
    rows.sort(key=lambda r: r[0])
    kinds = [pa.int64()] * 5 + [pa.int32(), pa.binary()]
    names = ["leaf", "line", "a", "b", "doc_id", "at", "tokens"]
    whole = pa.table([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def told(size, at_once):
        monkeypatch.setattr(lines, "TOKENS_AT_ONCE", at_once)
        out = list(lines._lost_by_leaf(lines.REPEATED)(iter(whole.to_batches(size))))
        return sorted({tuple(r.values()) for b in out for r in b.to_pylist()})

    want = told(10**6, 10**9)
    assert want and all(told(size, at_once) == want for size in (1, 7, 100) for at_once in (1, 50, 2000))


def test_a_lower_case_word_may_be_the_field(docs_of):
    names = [a + b for a in ("ann", "bob", "carl", "dora", "emil", "fred") for b in ("a", "e", "i", "o", "u", "y", "ie", "el", "us", "in")]
    rows = [(n, f"{prose(n, 12)}\nposted by {name} in the garden forum") for n, name in enumerate(names)]
    found = check_lines(docs_of, rows)
    assert [d for _, (_, d) in sorted(found.items())] == [0] + [1] * 59


def test_a_quoted_line_stays_once(docs_of):
    long = prose("long", 300)
    found = check_lines(docs_of, [(1, long), (2, f"{long}\n{prose('own', 250)}"), (3, f"{prose('other', 30)}\n{long}")])
    assert found[1] == (long, 0) and found[2] == (prose("own", 250), 1) and found[3] == (prose("other", 30), 1)


def test_equal_texts_are_no_evidence(docs_of):
    copied = "\n".join(prose(f"c{k}", 10) for k in range(6))
    found = check_lines(docs_of, [(n, copied) for n in range(15)] + [(50, prose("x", 40))])
    assert all(d == 0 for _, d in found.values())


def test_boilerplate_that_makes_up_most_of_its_pages_goes(docs_of):
    notice = prose("notice", 12)
    found = check_lines(docs_of, [(n, f"{notice}\n{prose(n, 4)}\n{prose(n + 500, 4)}") for n in range(30)])
    assert [d for _, (_, d) in sorted(found.items())] == [0] + [1] * 29


def test_equal_lines_of_mostly_fields_go(docs_of):
    rows = [(n, f"{prose(n, 20)}\n12 34 56 call 78\n{n} {n + 1} {n + 2} call {n}") for n in range(12)]
    found = check_lines(docs_of, rows)
    assert all(("12 34 56 call 78" in text) == (i == 0) for i, (text, _) in found.items())


def test_clean_keeps_rows_and_columns(docs_of, edge_rows):
    docs = docs_of(edge_rows)
    cleaned = lines.clean(docs)
    assert cleaned.columns == docs.columns and cleaned.count() == len(edge_rows)
    assert lines.clean(docs_of([]).limit(0)).count() == 0


# --- mixing -----------------------------------------------------------------------------------


def labelled(first, n):
    rng = random.Random(first)
    marks = {"toxic": ["scum", "vile", "idiot"], "poor": ["zzz", "qqq", "###"], "good": []}
    out = []
    for i in range(first, first + n):
        domain = rng.choices(list(marks), [1, 2, 5])[0]
        words = prose(i, 60).split()
        for mark in marks[domain]:
            words[rng.randrange(60)] = mark
        out.append((i, " ".join(words), domain))
    return out


def test_mixture_meets_targets_and_holds_out(spark, docs_of, edge_rows):
    seen, held_out = labelled(1000, 600), labelled(5000, 200)
    rows = edge_rows + [(i, t) for i, t, _ in seen + held_out]
    marks = [(i, int(d != "poor"), int(d == "toxic"), "x") for i, _, d in seen] + [(None, 1, 1, "x"), (9, None, None, "x")]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int, text string")
    got = mixing.mixed(docs_of(rows), labels).collect()
    assert len(got) == len(rows)
    domain = {r.doc_id: r.domain for r in got}
    right = sum(domain[i] == d for i, _, d in held_out)
    assert right >= 0.8 * len(held_out)
    total = sum(r.tokens for r in got)
    for d, target in mixing.TARGETS.items():
        share = sum(r.rate * r.tokens * r[f"p_{d}"] for r in got) / total
        assert abs(share - target) < 0.02
    assert all(r.rate >= 0 for r in got) and all(r.rate == 0 for r in got if r.p_toxic > 0.95)
    docs = docs_of(rows)
    kept = mixing.mixture(docs, labels)
    assert kept.columns == [*[c for c in docs.columns if c != "rate"], "rate"]
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in got if r.rate > 0)


def test_mixing_without_labels_or_documents(spark, docs_of, edge_rows):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = mixing.mixed(docs_of(edge_rows), none, {"good": 1.0, "toxic": 1.0}).collect()
    assert len(got) == len(edge_rows) and all(abs(r.p_good - 0.5) < 1e-6 for r in got)
    assert mixing.mixed(docs_of([]).limit(0), none).count() == 0


def test_projected_gradient_matches_a_direct_solver():
    """Few documents: the replayed rounds end where a plain long descent of the same problem ends."""
    rng = np.random.default_rng(3)
    p = rng.dirichlet([0.3, 0.3, 0.3], 40)
    size = rng.integers(10, 100, 40).astype(float)
    goal = np.array([0.7, 0.3, 0.0])
    history = []
    for _ in range(60):
        ahead = mixing.replayed(p, history)[1]
        history.append((ahead * size) @ p / size.sum() - goal)
    rate = np.ones(40)
    for _ in range(100000):
        residual = (rate * size) @ p / size.sum() - goal
        rate = np.maximum(0, rate - 0.5 * (p @ residual + mixing.PULL * (rate - 1)))
    fast = mixing.replayed(p, history)[0]
    miss = lambda r: np.abs((r * size) @ p / size.sum() - goal).max()
    assert miss(fast) < miss(rate) + 0.01


def test_rates_do_not_depend_on_how_rare_or_common_a_domain_is(spark):
    for shares in ({"good": 0.899, "poor": 0.1, "toxic": 0.001}, {"good": 0.17, "poor": 0.8, "toxic": 0.03}):
        rows = [
            (n, n, round(100000 * share) // 10, [0.999 * (d == e) + 0.001 / 3 for e in shares])
            for d, share in shares.items()
            for n in range(10)
        ]
        scored = spark.createDataFrame(rows, "doc_id long, key long, tokens long, p array<double>")
        history = mixing.fit_rates(scored, mixing.TARGETS)
        p = np.array([r[3] for r in rows])
        rate = mixing.replayed(p, history, mixing.barred(p, np.array(list(mixing.TARGETS.values()))))[0]
        got = dict(zip(shares, rate[::10]))
        assert got["toxic"] == 0 and len(history) < mixing.ROUNDS
        for d in ("good", "poor"):
            assert abs(got[d] * shares[d] / mixing.TARGETS[d] - 1) < 0.02, (d, got)


def test_common_poor_text_is_thinned_not_dropped(spark, docs_of):
    rng = random.Random(8)
    texts = [(i, " ".join(rng.choice(VOCABULARY) for _ in range(50)) + (" zzz qqq ###" if i % 10 < 8 else " fine calm true")) for i in range(400)]
    marks = [(i, int(i % 10 >= 8), 0) for i, _ in texts]
    got = mixing.mixed(docs_of(texts), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")).collect()
    assert all(r.rate > 0 for r in got)
    assert abs(sum(r.rate * r.tokens for r in got if r.domain == "poor") / sum(r.tokens for r in got) - 0.05) < 0.01


# --- the pipeline -----------------------------------------------------------------------------


def test_pipeline_catches_what_was_planted(spark, docs_of, tmp_path, edge_rows):
    item = f"Which {prose('item', 30)}?"
    rows = edge_rows + [(i, f"the {t} of the end in the day") for i, t, d in labelled(1000, 120) if d == "good"]
    rows += [(i, f"the {t} of the end in the day") for i, t, d in labelled(3000, 120) if d == "toxic"]
    rows = [r for r in rows if r[0] is not None]
    clean = {i for i, _ in rows if 1000 <= i < 2000}
    copy = next(t for i, t in rows if i in clean)
    rows += [(9001, copy), (9002, copy), (9003, f"the {prose('x', 80)} of the day {item} and to the end")]
    spark_docs = docs_of(rows).select("doc_id", "text", "lang", "source", "n_chars")
    spark_docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    marks = [(i, 1, int(i >= 3000)) for i, _ in rows if 1000 <= i < 9000]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert clean <= got
    assert not got & {1, 2, 3, 9001, 9002, 9003} and not any(3000 <= i < 9000 for i in got)
