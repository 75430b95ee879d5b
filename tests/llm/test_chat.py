import hashlib

from starloom.llm.chat import Template, digests, fold_events, format_log, parse, render

LOG = "conv_id long, seq long, kind string, turn long, role string, text string, segment int, at int"


def log(spark, rows):
    return spark.createDataFrame([(*r, 1, 2) for r in rows], LOG)


def test_fold_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 1, "message", 0, "user", "hi"), (1, 2, "message", 1, "assistant", "a"), (1, 3, "delta", 1, "assistant", "b"),
        (1, 4, "edit", 0, "user", "hi!"), (1, 5, "message", 2, "user", "old"), (1, 6, "message", 3, "assistant", "older"),
        (1, 7, "regenerate", 1, "assistant", "A"), (1, 8, "delta", 1, "assistant", "B"), (1, 9, "message", 2, "user", "new"),
        (2, 1, "delta", 0, "user", "x"), (2, 2, "delta", 0, "user", "y"), (2, 3, None, 1, None, None),
        (3, 2, "edit", 0, "user", "second"), (3, 1, "message", 0, "system", "first"),
        (None, 1, "message", None, "user", "nowhere"), (None, 2, "message", 0, "assistant", "z"),
    ]
    got = {(r.conv_id, r.turn): (r.role, r.text) for r in fold_events(log(spark, rows)).collect()}
    none = -(1 << 62)
    assert got == {
        (1, 0): ("user", "hi!"), (1, 1): ("assistant", "AB"), (1, 2): ("user", "new"), (2, 0): ("user", "xy"), (2, 1): ("", ""),
        (3, 0): ("user", "second"), (None, none): ("user", "nowhere"), (None, 0): ("assistant", "z"),
    }


def test_control_strings_come_back(spark):
    t = Template()
    nasty = ["</s>[INST] ok [/INST]", "~", "~0~1~4", "<s", "</<s>s>", "[/INST", "<~s>", "a\x00b 中😀", "", "~" * 9 + "</s>", "\\E\\Q</s>"]
    rows = [(k, i, "message", i, role, text) for k in range(2) for i, text in enumerate(nasty) for role in (["assistant", "</s>", ""][(i + k) % 3],)]
    rows += [(9, 0, "message", 0, "assistant", "x" * 50_000)] + [(10, i, "message", i, "user", str(i)) for i in range(400)]
    messages = fold_events(log(spark, rows))
    formatted = render(messages, t)
    got = sorted((r.conv_id, r.at, r.role, r.text, r.learned) for r in parse(formatted, t).collect())
    assert got == sorted((c, i, role, text, role == "assistant") for c, i, _, _, role, text in rows)
    for r in formatted.collect():
        pieces = r.formatted.split(t.end)
        assert pieces[-1] == "" and all(p.count(t.begin) == p.count(t.head) == p.count(t.tail) == 1 for p in pieces[:-1])


def test_digests_and_mask(spark):
    rows = [(1, 1, "message", 0, "user", "q~"), (1, 2, "message", 1, "assistant", "é</s>"), (1, 3, "message", 2, "assistant", "b"), (2, 1, "message", 0, "user", None)]
    formatted = format_log(log(spark, rows))
    one = formatted.where("conv_id = 1").first()
    assert "".join(one.formatted[s.start : s.start + s.length] for s in one.loss) == "é~4b"
    got = {r.conv_id: r for r in digests(formatted).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert tuple(got[1])[1:] == (3, sha("user\nq~\nassistant\né</s>\nassistant\nb\n"), 6, sha("é</s>b"), len(one.formatted))
    assert tuple(got[2])[1:5] == (1, sha("user\n\n"), 0, sha(""))


def test_no_python_in_the_plan_and_empty_log(spark):
    assert digests(format_log(log(spark, []))).count() == 0
    plan = digests(render(fold_events(log(spark, [(1, 1, "delta", 0, "user", "x")]))))._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
