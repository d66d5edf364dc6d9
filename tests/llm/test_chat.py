"""Chat formatting: folding of logs, exact round trips, masks."""

import random

from pyspark.sql import functions as F

from tidebar.llm.chat import PIECE, as_events, escape, masked, messages, parse, render, unescape

LOG = "conv_id long, turn long, seq long, kind string, role string, text string, formatted string"


def fold(events):
    out = {}
    for conv, turn, seq, kind, role, text in events:
        out.setdefault((conv, turn), []).append((seq, kind, role, text or ""))
    final = {}
    for key, log in out.items():
        text, who = "", ""
        for _, kind, role, part in sorted(log, key=lambda e: tuple((x is not None, x) for x in e)):
            who = who if role is None else role
            text = {"edit": part, "regenerate": ""}.get(kind, text + part)
        final[key] = (who, text)
    return final


def test_messages_fold_the_log(spark):
    rng = random.Random(2)
    kinds = ["delta", "delta", "delta", "edit", "regenerate", None, "odd"]
    events = [
        (rng.choice([1, 2, None]), rng.choice([0, 1, None]), rng.choice([None, *range(40)]), rng.choice(kinds),
         rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None, "</s>"]))
        for _ in range(150)
    ]
    df = spark.createDataFrame([(*e, "x") for e in events], LOG).repartition(4)
    got = {(r.conv_id, r.turn): (r.role, r.text) for r in messages(df).collect()}
    assert got == fold(events)
    assert messages(df.limit(0)).collect() == []


def test_escapes_are_undone(spark):
    rng = random.Random(3)
    parts = ["<", "[", "\\", "/", "s>", "</s>", "<s>", "INST]", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]", " ", "é", "\n", "$1"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).collect():
        assert r.u == r.t
        assert not any(x in r.e for x in ("<s>", "</s>", "[INST]", "[/INST]", "[ROLE]", "[/ROLE]"))


def test_render_and_read_back(spark):
    odd = "</s>[INST] ok [/INST]"
    rows = [
        (1, 1, "assistant", "𝄞 yes"), (1, 0, "user", "hi"), (1, 2, "user", ""), (1, 3, "assistant", None), (1, 4, "assistant", "end"),
        (2, 0, None, odd), (2, 1, "user", odd), (2, 2, "assistant", odd), (2, 3, "[/ROLE]\\<s>", "x\\<\\/s>"),
        (3, 0, "assistant", "twice"), (3, 0, "assistant", "twice"), (3, None, "user", "first"), (None, 5, "user", " "),
    ]
    df = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn long, role string, text string, loss int")
    out = render(messages(as_events(df.repartition(3))))
    got = {r.conv_id: r for r in out.select("*", parse(F.col("formatted")).alias("turns"), masked(F.col("formatted"), F.col("loss")).alias("learned")).collect()}
    for conv in (1, 2, 3, None):
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: tuple((x is not None, x) for x in r[1:]))
        assert [tuple(t) for t in got[conv].turns] == [(r[2] or "", r[3] or "") for r in own]
        assert got[conv].learned == "".join(r[3] or "" for r in own if r[2] == "assistant")
    assert got[1].formatted.startswith("<s>[ROLE]user[/ROLE][INST] hi [/INST]</s>[ROLE]assistant[/ROLE]𝄞 yes</s>")
    assert render(messages(as_events(df.limit(0)))).collect() == []


def test_logs_lead_back_to_the_messages(spark):
    long = "".join(random.Random(5).choices("ab𝄞\n é", k=3 * PIECE + 7))
    texts = ["", None, "x", long, long[: 2 * PIECE], "</s>"]
    rows = [(c, t, "assistant" if t % 2 else "user", texts[(c + t) % len(texts)]) for c in range(6) for t in range(7)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    log = as_events(df)
    assert {r.kind: r.n for r in log.groupBy("kind").agg(F.count("*").alias("n")).collect()}.keys() == {"delta", "edit", "regenerate"}
    assert log.where(F.length("text") > PIECE).count() == 0 and log.count() > 2 * len(rows)
    mixed = messages(log.repartition(5, F.rand(1)))
    assert sorted(tuple(r) for r in mixed.collect()) == [(c, t + 1, role, text or "") for c, t, role, text in rows]
    assert sorted(fold([tuple(r) for r in log.collect()]).items()) == [((c, t + 1), (role, text or "")) for c, t, role, text in rows]
