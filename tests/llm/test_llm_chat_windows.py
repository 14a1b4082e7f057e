"""Chat windows: marks inside texts, budgets, repeats and targets, against a plain reading of the windows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidewire.llm import chat_windows as chat

RNG = random.Random(5)
PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[/TURN]", "\\", "<", "[", "s>", " ", "\n", "é", "word", "日"]
TEXTS = ["", "</s>[INST] ok [/INST]", "<\\s>", "<\\\\/s>", "ends with \\", "<<s>", *("".join(RNG.choice(PIECES) for _ in range(RNG.randint(1, 12))) for _ in range(200))]
MARKS = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[/TURN]"]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def test_escaping_is_reversible_and_leaves_no_mark(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", chat.escape(F.col("t")).alias("e"))
    for r in df.select("t", "e", chat.unescape(F.col("e")).alias("u")).collect():
        assert r.u == r.t and not any(m in r.e for m in MARKS)


def turns():
    """Long and short conversations; odd roles, nulls, ties, repeated rows, a turn over the budget, a late system turn."""
    out = [(1, k, ("user", "assistant")[k % 2], RNG.choice(TEXTS) * 3) for k in range(700)]
    out += [(2, 0, "system", "be brief"), *((2, k, ("assistant", "user")[k % 2], "word " * RNG.randint(0, 90)) for k in range(1, 300))]
    out += [(3, 0, "user", "x" * 9000), (3, 1, "assistant", "y" * 9000), (3, 2, "user", None), (3, 3, "assistant", "")]
    out += [(4, 0, "system", "s" * 9000), *((4, k, "assistant", "z" * 500) for k in range(1, 40))]
    out += [(5, 0, "system", "alone"), (6, None, None, "a"), (6, 1, "tool [/ROLE]\n", "b </s>"), (6, 1, "user", "c"), (6, 1, "user", "c"), (6, 2, "system", "late"), (6, 3, "assistant", "d")]
    return out + [(None, 0, "user", "no id"), (None, 1, "assistant", "answer")]


def plain_digest(rows):
    rows = sorted(((t is not None, t or 0, r or "", -(-len(x or "") // 4), x or "") for _, t, r, x in rows))
    learned = "".join(r[4] for r in rows if r[2] == "assistant")
    return [(r[2], r[4]) for r in rows], learned


def is_run(part, whole):
    return any(whole[k : k + len(part)] == part for k in range(len(whole) + 1))


@pytest.mark.parametrize(("budget", "history"), [(1024, 256), (200, 40), (60, 0)])
def test_windows(spark, budget, history):
    rows = turns()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("window", "conv", "a", "b", "span", "block", "tokens")})
    windows = chat.format_conversations(df, budget, history).withColumn("turns", chat.read_turns(F.col("formatted"))).collect()
    for i in {r[0] for r in rows}:
        want, learned = plain_digest([r for r in rows if r[0] == i])
        mine = sorted((w for w in windows if w.conv_id == i), key=lambda w: w.window)
        read = [[(t.role, t.text) for t in w.turns] for w in mine]
        assert [t for w, turns in zip(mine, read) for t in turns[w.n_repeated :]] == want
        got = [w.formatted[s.start : s.end] for w in mine for s in w.loss]
        assert not any(m in t for m in MARKS for t in got)
        plain = "".join(re.sub(r"([<\[])\\(\\*)(/?s>|/?INST\]|</?SYS>>|/?ROLE\]|/?TURN\])", r"\1\2\3", t) for t in got)
        assert plain == learned
        system = want[:1] if want[0][0] == "system" else []
        longest, n_system = (max([0, *(-(-len(t) // 4) + 4 for r, t in some)]) for some in ([x for x in want if x[0] != "system"], system))
        room = max(budget - history - n_system, n_system, 2 * history, 2)
        for k, (w, turns_) in enumerate(zip(mine, read)):
            assert k == 0 or turns_[: len(system)] == system  # retained
            assert is_run(turns_[len(system) if k else 0 :], want)  # history leads up to the span
            repeated = turns_[len(system) if k else 0 : w.n_repeated]
            assert sum(-(-len(t) // 4) + 4 for _, t in repeated) <= 2 * history
            if longest <= room // 2 and n_system <= budget - history - n_system:
                assert w.n_tokens <= budget + history


def test_long_conversations_have_history_and_several_blocks(spark):
    windows = chat.format_conversations(spark.createDataFrame(turns(), SCHEMA), 200, 40).where("conv_id = 2").collect()
    assert sum(w.n_repeated > 1 for w in windows) > len(windows) // 4 > 5


def test_digests_and_no_rows(spark):
    rows = turns()
    got = {r.conv_id: r for r in chat.conversation_digests(chat.format_conversations(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert set(got) == {r[0] for r in rows}
    for i, r in got.items():
        want, learned = plain_digest([x for x in rows if x[0] == i])
        assert (r.n_turns, r.loss_chars) == (len(want), len(learned))
    assert chat.conversation_digests(chat.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0
