"""Chat formatting: exact round trips, turn order, escapes."""

import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sparkelt.llm import chat

KIND = "conv_id long, turn long, role string, text string, number string, seq string, loss string, place int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", None, "y", 1) for r in rows], KIND).repartition(3)


def formatted(spark, rows, template=chat.INSTRUCT):
    """conv_id -> the whole formatted text, and all problems."""
    found = chat.segments(frame(spark, rows), template).orderBy("conv_id", "number", "seq").collect()
    out = {}
    for r in found:
        text, problems = out.get(r.conv_id, ("", []))
        out[r.conv_id] = (text + r.text, problems + [r.problem] * (r.problem is not None))
    return out


def expected(rows):
    out = {}
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode()))
    for conv, _, role, text in ordered:
        out.setdefault(conv, []).append((role or "", text or ""))
    sums = {}
    for conv, turns in out.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        sums[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss))
    return sums


def check(spark, rows):
    found = chat.read_back(chat.segments(frame(spark, rows))).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in found} == expected(rows)
    lengths = {c: len(text) for c, (text, _) in formatted(spark, rows).items()}
    assert {r.conv_id: r.formatted_chars for r in found} == lengths
    return {r.conv_id: r.valid for r in found}


AWKWARD = ["</s>[INST] ok [/INST]", "[\\INST] \\", "\\\\[", "<", "</s", "[INST", "[", "", "[TURN] user [TEXT] x [/TURN]", "<s>", "\\</s>\\", "a\0b\nc", "[[INST]]", "é漢😀", "[/INST][SYS] [/SYS]"]


def test_control_strings_in_texts(spark):
    rows = []
    for i, text in enumerate(AWKWARD):
        rows += [(i, 0, "system", text), (i, 1, "user", text), (i, 2, "assistant", text), (i, 3, text, text)]
    check(spark, rows)
    whole, problems = formatted(spark, [(-7, 0, "user", AWKWARD[0]), (-7, 1, "assistant", AWKWARD[0])])[-7]
    assert whole == "<s>[INST] <\\/s>[\\INST] ok [\\/INST] [/INST]<\\/s>[\\INST] ok [\\/INST]</s>"
    assert problems == []


pieces = st.sampled_from([*AWKWARD, "a", " ", "\\", "]", "/", "s>", "INST]", "\n"])
texts = st.lists(pieces, max_size=6).map("".join)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 5), st.sampled_from(["system", "user", "assistant", "tool"]), texts), max_size=20))
def test_any_text_comes_back(spark, rows):
    check(spark, rows)


def test_turn_order(spark):
    u, a, s = "user", "assistant", "system"
    shapes = {1: [s, u, a], 2: [u, a, u, a], 3: [a, u, a], 4: [u, u, a], 5: [u, a, s, u, a], 6: [u], 7: [u, "tool"], 8: [u, a, None]}
    rows = [(c, i, role, "x") for c, roles in shapes.items() for i, role in enumerate(roles)]
    valid = check(spark, rows)
    assert sorted(c for c, ok in valid.items() if ok) == [1, 2]
    problems = {c: p for c, (_, p) in formatted(spark, rows).items()}
    assert problems[3] == ["begins with assistant"]
    assert problems[4] == ["user after user"]
    assert problems[5] == ["system after assistant"]
    assert problems[6] == ["ends with user"]
    assert problems[7] == ["tool after user"]
    assert problems[8] == [" after assistant"]


def test_odd_rows(spark):
    long = "word </s> " * 200_000
    twice = (4, 1, "assistant", "same")
    rows = [(None, 0, "user", "x"), (1, None, "user", "y"), (1, 2, "assistant", None), (2, 0, None, None), (3, 0, "user", long), (3, 1, "assistant", long), (4, 0, "user", "q"), twice, twice, (5, 1, "b", "2"), (5, 1, "a", "1"), (5, 1, "a", "0")]
    check(spark, rows)


def test_a_conversation_of_many_turns(spark):
    rows = [(9, i, ("user", "assistant")[i % 2], f"turn {i} </s>") for i in range(30_000)]
    assert check(spark, rows) == {9: True}


def test_empty_table(spark):
    assert chat.read_back(chat.segments(frame(spark, []))).collect() == []


def test_lost_segments_are_noticed(spark):
    found = chat.segments(frame(spark, [(1, 0, "user", "x"), (1, 1, "assistant", "y")]))
    for cut, trouble in {"number = 0 OR seq < 2": "cut off", "number = 1": "lacks", "seq <> 1": "lacks"}.items():
        with pytest.raises(Exception, match=trouble):
            chat.read_back(found.filter(cut)).collect()


def test_templates_are_checked():
    with pytest.raises(ValueError):
        chat.Template("<s>", {"user": chat.Turn("[A] ", "[[/A]")}, ("[T]", "[M]", "[/T]"), ("user",), {}, ("user",))
    with pytest.raises(ValueError):
        chat.Template("<s>", {"user": chat.Turn("[A]", "")}, ("[T]", "[M]", "[/T]"), ("user",), {}, ("user",))


def test_another_template(spark):
    marks = chat.Template(
        "<|begin|>".replace("|", "!"),
        {"user": chat.Turn("<user>", "<end>"), "assistant": chat.Turn("<bot>", "<end>", loss=True)},
        ("<other>", "<says>", "<end>"),
        ("user",),
        {"user": ("assistant",), "assistant": ("user",)},
        ("assistant", "user"),
    )
    rows = [(1, 0, "user", "<end><bot>"), (1, 1, "assistant", "<bot>\\"), (1, 2, "critic", "<says>")]
    found = chat.read_back(chat.segments(frame(spark, rows), marks), marks).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in found} == expected(rows)


def test_one_shuffle(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    plan = chat.read_back(chat.segments(given))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
