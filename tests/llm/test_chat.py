import hashlib

from pyspark.sql import functions as F

from waymark.llm.chat import escape, format_chat, read_back, read_turns, unescape

SCHEMA = "conv_id long, turn long, role string, text string, formatted int"
HARD = ["", "\\", "</s>", "<s>[INST]\\[/INST]", "<|im_end|>", "<<</s>>", "[[INST]]", "\\<s>", "<\\s>", "$1 \\1", "é\n </s", "[/INST", "x" * 200_000]


def test_escape_round_trip(spark):
    df = spark.createDataFrame([(x,) for x in HARD], "t string").select("t", escape(F.col("t")).alias("e"))
    for row in df.withColumn("u", unescape(F.col("e"))).collect():
        assert row.t == row.u
        assert not any(mark in row.e for mark in ("<s>", "</s>", "[INST]", "[/INST]", "<|"))


def test_every_reply_is_a_target_once(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a1</s>"), (1, 3, "user", "v"), (1, 4, "assistant", "a2"), (1, 5, "user", "w")]
    got = format_chat(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)).orderBy("example_no").collect()
    assert [g.n_turns for g in got] == [3, 5, 6]
    assert [g.formatted[g.loss_start : g.loss_start + g.loss_length] for g in got[:2]] == ["a1<\\/s>", "a2"]
    assert (got[2].loss_start, got[2].loss_length, got[2].is_last) == (None, 0, True)


def test_read_back_brute_force(spark):
    rows = [(k, i, ["user", "assistant", "tool<s>", None][(k + i) % 4], HARD[(3 * k + i) % len(HARD)] if i % 5 else None) for k in range(9) for i in range(k + 1)]
    got = {r.conv_id: r for r in read_back(format_chat(spark.createDataFrame([(*r, 0) for r in rows], SCHEMA))).collect()}
    for k in range(9):
        own = [(r or "", t or "") for c, _, r, t in rows if c == k]
        loss = "".join(t for r, t in own if r == "assistant")
        assert got[k].n_turns == len(own)
        assert got[k].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in own).encode()).hexdigest()
        assert (got[k].loss_chars, got[k].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_nulls_ties_and_empty(spark):
    rows = [(None, 0, "user", "q"), (None, 0, "user", "q"), (2, None, "assistant", "z"), (2, 0, "user", "b"), (2, 0, "user", "a"), (2, 0, "user", "a")]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    whole = format_chat(df).where("is_last").withColumn("t", read_turns(F.col("formatted")))
    assert [len(r.t) for r in whole.where("conv_id is null").collect()] == [1, 1]
    assert [t.text for t in whole.where("conv_id = 2").first().t] == ["z", "a", "a", "b"]
    assert read_back(format_chat(df.limit(0))).count() == 0
