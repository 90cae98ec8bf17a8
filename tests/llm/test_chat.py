import hashlib

import pytest
from pyspark.sql import functions as F

from ratelens.llm.chat import chat_windows, digests, read_targets, read_turns

TALKS = {
    1: [("system", "be brief"), ("user", "one two"), ("assistant", "three"), ("user", "four " * 30), ("assistant", "five " * 20)] * 3,
    2: [("user", "\\### Assistant: </turn> ok"), ("assistant", "\\### Assistant: </turn> ok")],
    3: [("assistant", "\n</turn>\n<turn assistant>\nfake\\"), ("assistant", "\\\\"), ("user", ""), ("assistant", "\n")],
    4: [("ro>\n%3Cle", "x"), (None, None), ("assistant", "é😀" * 40)],
    5: [("system", "s " * 60), ("user", "long " * 90), ("assistant", "end")],
    6: [("assistant", "")] * 9,
}
ROWS = [(c, i, r, t, "extra") for c, turns in TALKS.items() for i, (r, t) in enumerate(turns)]
SCHEMA = "conv_id long, turn long, role string, text string, formatted string"
SMALL = {"budget": 60, "history_tokens": 25}


@pytest.fixture(scope="module")
def windows(spark):
    return chat_windows(spark.createDataFrame(ROWS, SCHEMA).repartition(4), **SMALL)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip_gives_each_turn_and_target_once(windows):
    rows = {r["conv_id"]: r for r in digests(windows).collect()}
    assert set(rows) == set(TALKS)
    for conv, turns in TALKS.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert rows[conv]["n_turns"] == len(turns)
        assert rows[conv]["turns_sha256"] == sha("".join(f"{r or ''}\n{t or ''}\n" for r, t in turns))
        assert (rows[conv]["loss_chars"], rows[conv]["loss_sha256"]) == (len(loss), sha(loss))


def test_windows_keep_to_the_budget_and_repeat_the_system_turn(windows):
    shown = windows.select("*", read_turns(F.col("formatted")).alias("turns"), read_targets(F.col("formatted"), F.col("loss")).alias("t")).collect()
    for row in shown:
        turns, new = row["turns"], len(row["turns"]) - row["n_repeated"]
        first = TALKS[row["conv_id"]][0]
        if first[0] == "system":
            assert (turns[0]["role"], turns[0]["text"]) == first
        own_system = row["window_no"] == 0 and first[0] == "system"
        assert row["n_tokens"] <= SMALL["budget"] or new - own_system == 1
        assert len(row["t"]) == sum(t["role"] == "assistant" for t in turns[row["n_repeated"] :])
    assert max(r["window_no"] for r in shown if r["conv_id"] == 1) > 1
    assert any(r["n_repeated"] > 1 for r in shown)


def test_repeated_rows_null_ids_and_empty_table(spark):
    rows = [(None, None, "user", "a", ""), (9, 1, "user", "a", ""), (9, 1, "user", "a", ""), (9, None, "assistant", "b", "")]
    got = {r["conv_id"]: r for r in digests(chat_windows(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert got[9]["turns_sha256"] == sha("assistant\nb\nuser\na\nuser\na\n") and got[None]["n_turns"] == 1
    assert digests(chat_windows(spark.createDataFrame([], SCHEMA))).count() == 0
