from obslake.llm import chat

SCHEMA = "pair_id long, turn long, role string, text string, chosen string"


def render(turns) -> str:
    return "".join(f"<|im_start|>{role}\n{text}<|im_end|>\n" for role, text in turns)


def test_prefix_completions_and_spans(spark):
    prefix = [("system", "s 🙂"), ("user", "hello")]
    good, bad = [*prefix, ("assistant", "yes"), ("user", "thanks")], [*prefix, ("assistant", "no!")]
    odd = [("user", None), (None, "x")]
    cases = {1: (good, bad), 2: (good, good), 3: (good, prefix), 4: (odd, [("user", "")]), 5: (bad, [("user", "other")])}

    def table(side, only=None):
        rows = [(p, t, *turn, "clash") for p, both in cases.items() for t, turn in enumerate(both[side])]
        return spark.createDataFrame([*rows, (None, 0, "user", "x", "y"), (only, 0, "user", "x", "y")], SCHEMA).repartition(3)

    found = {r["pair_id"]: r for r in chat.preferences(table(0, 8), table(1, 9)).collect()}
    assert set(found) == set(cases)
    row = found[1]
    assert (row["prompt"], row["prompt_turns"]) == (render(prefix), 2)
    assert (row["chosen"], row["rejected"]) == (render(good[2:]), render(bad[2:]))
    for side, answer in (("chosen", "yes"), ("rejected", "no!")):
        whole = row["prompt"] + row[side]
        assert [whole[s["start"] : s["end"]] for s in row[f"{side}_spans"]] == [answer + "<|im_end|>"]
    assert found[2]["prompt"] == render(good) and found[2]["chosen"] == found[2]["rejected"] == ""
    assert found[3]["rejected"] == "" and found[3]["chosen"] == render(good[2:])
    assert found[4]["prompt"] == render([("user", "")]) and found[4]["chosen"] == render([("", "x")])
    assert found[5]["prompt"] == "" and found[5]["prompt_turns"] == 0


def test_plan_has_no_python(spark):
    rows = spark.createDataFrame([(0, 0, "user", "a"), (0, 1, "assistant", "b"), (1, 0, "assistant", "c")], "conv_id long, turn long, role string, text string")
    made = chat.preferences(*chat.swapped_answers(rows))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    found = made.where("pair_id = 0").first()
    assert (found["prompt_turns"], found["chosen"], found["rejected"]) == (1, render([("assistant", "b")]), render([("assistant", "c")]))
    assert chat.preferences(*chat.swapped_answers(rows.where("false"))).count() == 0
