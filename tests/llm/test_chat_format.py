import hashlib

from hypothesis import HealthCheck, given, settings, strategies as st

from tripstream.llm import chat_format
from tripstream.llm.common import ready

SCHEMA = "conv_id long, turn long, role string, text string, example string"


def expected(rows):
    convs = {}
    for c, t, role, text in rows:
        convs.setdefault(c, []).append((t if t is not None else -1, role or "", text or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest(),
                  len(loss), hashlib.sha256(loss.encode()).hexdigest(), sum(r == "assistant" for _, r, _ in turns))
    return out


def actual(spark, rows):
    ready(spark)
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    back = chat_format.read_back(chat_format.format_chats(df))
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.n_examples) for r in back.collect()}


def test_edge_cases(spark):
    rows = [(1, 0, "user", None), (1, 1, "assistant", ""), (1, 1, "assistant", "b"), (1, 2, None, "tail"),
            (2, 0, "tool", "[INST]x[/INST]"), (3, 0, "assistant", "<s>\\</s><\\/s>[\\\\INST]"),
            (None, 0, "user", "x"), (4, None, "user", "first"), (4, 0, "assistant", "y" * 50_000),
            (5, 0, "user", "q"), (5, 0, "user", "q"), (6, 0, "[ROLE]</s>", "</s>[/ROLE]")]
    assert actual(spark, rows) == expected(rows)
    assert actual(spark, []) == {}


PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/SYS]", "[ROLE]", "[/ROLE]", "\\", "<", "[", "/s>", "a", "\n", "é", "$1"]
TEXTS = st.lists(st.sampled_from(PIECES), max_size=8).map("".join)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "</s>", ""]), TEXTS),
                         min_size=1, max_size=6), min_size=1, max_size=25))
def test_round_trip(spark, convs):
    rows = [(c, t, role, text) for c, turns in enumerate(convs) for t, (role, text) in enumerate(turns)]
    assert actual(spark, rows) == expected(rows)


def test_prefix_targets(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "A1"), (1, 3, "user", "v"),
            (1, 4, "assistant", "A2"), (1, 5, "user", "end")]
    df = spark.createDataFrame([(*r, "") for r in rows], SCHEMA)
    got = chat_format.format_chats(df).orderBy("example").collect()
    one = "[SYS]s[/SYS][INST]u[/INST]<s>A1</s>"
    two = one + "[INST]v[/INST]<s>A2</s>"
    assert [r.example for r in got] == [one, two, two + "[INST]end[/INST]"]
    assert [r.example[r.loss_start:r.loss_end] if r.target is not None else None for r in got] == ["A1", "A2", None]


def test_native_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "x", "")], SCHEMA)
    plan = chat_format.read_back(chat_format.format_chats(df))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
