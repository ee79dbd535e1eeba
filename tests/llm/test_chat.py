import hashlib

from pyspark.sql import functions as F

from ferrule.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, turns int"


def brute(rows):
    out = {}
    for c in {r[0] for r in rows}:
        key = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == c), key=key)]
        text, before = "", None
        for role, t in turns:
            t = t.replace("&", "&amp;").replace("<", "&lt;")
            r = role.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
            text += ("<and>" if role == before else ("<end>\n" if before is not None else "") + f"<im {r}>") + t
            before = role
        out[c] = (turns, text + "<end>\n")
    return out


def test_round_trip_and_loss(spark, words):
    marks = ["<im user>", "<and>", "<end>\n", "&lt;", "&amp;lt;", "<", "&", ">", "</s>[INST] ok [/INST]", "", "é\n漢"]
    rows = [(1, k, ("user", "assistant")[k % 2], m) for k, m in enumerate(marks)]
    rows += [(2, 0, "user", "a"), (2, 1, "user", "b"), (2, 2, "assistant", "c"), (2, 3, "assistant", "<and>"), (2, 2, "assistant", "c")]
    rows += [(3, None, "assistant", "x"), (3, 0, None, None), (3, 1, "we<i>r&d>", "y"), (None, 1, "user", "n"), (None, 0, "assistant", None)]
    rows += [(4, 0, "assistant", " ".join(words(40_000)))]
    rows += [(5, k, "user" if k % 3 else "assistant", f"t{k}") for k in range(700)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)
    out = chat.format_conversations(df).select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss"),
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("joined"))
    want = brute(rows)
    got = out.collect()
    assert {r["conv_id"] for r in got} == set(want) and len(got) == len(want)
    for r in got:
        turns, text = want[r["conv_id"]]
        assert r["formatted"] == text == r["joined"]
        assert [tuple(t) for t in r["turns"]] == turns
        assert r["loss"] == "".join(t for role, t in turns if role == "assistant")


def test_empty_table(spark):
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark, sf):
    from ferrule.llm.queries import op8_chat_format

    plan = op8_chat_format(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "ExistingRDD"))


def test_given_conversation(spark, sf):
    from ferrule.llm.queries import CONTROL_TEXT, op8_chat_format

    row = op8_chat_format(spark, sf).where("conv_id = -7").first()
    said = f"user\n{CONTROL_TEXT}\nassistant\n{CONTROL_TEXT}\n"
    assert row["n_turns"] == 2 and row["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
    assert row["loss_chars"] == len(CONTROL_TEXT)
