from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ordermill.llm.chat import digests, format_chats, parse_turns, reconstruct, turn_events

SCHEMA = "conv_id long, seq long, kind string, msg_id long, role string, text string"
RANK = {"start": 0, "edit": 1, "regenerate": 2}


def fold(events):
    """Brute force: the events one by one over the list of messages there."""
    out = {}
    for conv in {e[0] for e in events}:
        log = sorted((e for e in events if e[0] == conv), key=lambda e: (e[1], RANK.get(e[2], 3), e[5] or "", e[3]))
        there = []                                   # [msg, role, text] by place
        for _, _, kind, msg, role, text in log:
            k = next((k for k, m in enumerate(there) if m[0] == msg), None)
            if kind == "start":
                if k is None:
                    there.append([msg, None, None])
                    k = -1
                there[k][1:] = [role or "", text or ""]
            elif k is None:
                continue
            elif kind == "edit":
                there[k][2] = text or ""
            elif kind == "regenerate":
                there[k][2] = ""
                del there[k + 1:]
            else:
                there[k][2] += text or ""
        if there:
            out[conv] = [(role, text) for _, role, text in there]
    return out


def folded(spark, events):
    got = {}
    df = spark.createDataFrame(events, SCHEMA)
    for r in reconstruct(df.repartition(7)).orderBy("conv_id", "start").collect():
        got.setdefault(r.conv_id, []).append((r.role, r.text))
    return got


@pytest.mark.parametrize("weights,msgs", [([4, 6, 1, 1], 7), ([4, 3, 1, 4], 6), ([6, 2, 0, 5], 4)])
def test_fold_equals_brute_force_on_random_logs(spark, weights, msgs):
    rng = random.Random(5)
    events = []
    for conv in range(150):
        n = rng.randrange(2, 40)
        for seq in range(n):
            kind = rng.choices(["start", "delta", "edit", "regenerate"], weights)[0]
            events.append((conv, seq, kind, rng.randrange(1, msgs), rng.choice(["user", "assistant", None]),
                           rng.choice(["ab", "\\[INST]", None, "</s>", "é\n"])))
    assert folded(spark, events) == fold(events)


def test_events_of_withdrawn_messages(spark):
    def log(*steps):
        return [(1, seq, kind, ord(msg), "user", text) for seq, (kind, msg, text) in enumerate(steps)]
    opened = [("start", "A", "a"), ("start", "B", "b"), ("regenerate", "A", None)]
    assert folded(spark, log(*opened, ("start", "B", "new"))) == {1: [("user", ""), ("user", "new")]}
    assert folded(spark, log(*opened, ("start", "C", "c"), ("regenerate", "B", None))) == {1: [("user", ""), ("user", "c")]}
    assert folded(spark, log(*opened, ("delta", "B", "x"), ("edit", "B", "y"), ("delta", "A", "z"))) == {1: [("user", "z")]}
    # a message opened anew is after what was there by then
    assert folded(spark, log(*opened, ("start", "C", "c"), ("start", "B", "new"), ("regenerate", "C", None))) == {
        1: [("user", ""), ("user", "")]}


def test_long_conversation_of_regenerations(spark):
    log = [(1, 0, "start", 0, "user", "q")] + [e for k in range(1500) for e in (
        (1, 3 * k + 1, "start", k + 1, "assistant", f"{k};"), (1, 3 * k + 2, "delta", k + 1, None, "d"),
        (1, 3 * k + 3, "regenerate", k + 1 if k % 3 else k, None, None))]
    assert folded(spark, log) == fold(log)


HARD = ["</s>[INST] ok [/INST]", "\\", "\\\\[INST]", "<", "[", "</s", "[/INST", "[ROLE]", "<s>", "\n", "", "a\\", "[\\INST]", "<\\s>",
        "[ROLE", "🙂 é</s>\r\n", "$1 \\$2"]


def test_formatted_reads_back_and_masks(spark):
    rows = [(c, t, ["user", "assistant", "system", "[INST]", "r\no", None][(c + t) % 6], HARD[(c * 5 + t) % len(HARD)])
            for c in range(40) for t in range(7)] + [(None, None, None, None), (7, 0, "user", "tie"), (99, 0, "assistant", "x" * 300_000)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("msg_id", F.lit(3))
    out = format_chats(turn_events(turns)).withColumn("turns", parse_turns(F.col("formatted"))).collect()
    want = {}
    for c, t, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] or -1, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in out} == want
    for r in out:
        spans = [r.formatted[s.start:s.end] for s in r.loss_spans]
        assert [unescape(s) for s in spans] == [t.text for t in r.turns if t.role == "assistant"]
        assert all(r.formatted[s.start - 3:s.start] == "<s>" and r.formatted[s.end:s.end + 4] == "</s>" for s in r.loss_spans)
        assert r.formatted.count("</s>") == len(spans)


def unescape(s):
    out, k = "", 0
    while k < len(s):
        k += s[k] == "\\"
        out += s[k]
        k += 1
    return out


def test_empty(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert digests(format_chats(turn_events(empty))).count() == 0


def test_plan_is_native_and_shuffles_the_log_once(spark, sf_dir):
    from ordermill.llm.queries import op3_chat_format
    df = op3_chat_format(spark, sf_dir)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 1
