import json

from ledgertalk.operators import quality


def line(*messages):
    return json.dumps({"messages": [{"role": r, "content": c} for r, c in messages]})


SOUND = line(("system", "s"), ("user", "u"), ("assistant", "a £"))
CASES = [
    (SOUND, None),
    ("  " + SOUND + " ", None),
    (SOUND[:-3], "not_json"),
    (SOUND + " tail", "not_json"),
    (SOUND + "," + SOUND, "not_json"),
    (SOUND + "],[" + SOUND, "not_json"),
    (SOUND + '},{"x":' + SOUND, "not_json"),
    (SOUND + ',"x":1', "not_json"),
    ("plain", "not_json"),
    ('{"x":1}', "no_message_list"),
    ("[1]", "no_message_list"),
    ('{"messages":"none"}', "no_message_list"),
    ('{"messages":null}', "no_message_list"),
    ('{"messages":[]}', "message_count"),
    (line(("user", "u"), ("assistant", "a")), "message_count"),
    (line(("user", "u"), ("system", "s"), ("assistant", "a")), "role_order"),
    (line((None, "u"), ("user", "s"), ("assistant", "a")), "role_order"),
    (line(("system", "s"), ("user", ""), ("assistant", "a")), "empty_content"),
    (line(("system", "s"), ("user", None), ("assistant", "a")), "empty_content"),
    (line(("system", "s"), ("user", 5), ("assistant", "a")), "empty_content"),
    (line(("system", "s"), ("user", ["x"]), ("assistant", "a")), "empty_content"),
    ('{"messages":[{"role":"system","content":"s"},{"role":"user"},{"role":"assistant","content":"a"}]}', "empty_content"),
]


def test_first_fault_of_each_line(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, line string")
    found = {r.i: r.fault for r in quality.checked_lines(df).collect()}
    for i, (text, expected) in enumerate(CASES):
        assert found[i] == expected, text


def test_blank_lines_are_skipped_and_max_check_stops_early(spark):
    df = spark.createDataFrame([(SOUND,), ("",), (" \t",), (SOUND,), ("plain",)], "line string")
    counts = {r.result: r.line_count for r in quality.fault_counts(quality.checked_lines(df)).collect()}
    assert counts == {"ok": 2, "not_json": 1}
    assert quality.checked_lines(df, max_check=1).count() == 1
    assert quality.violations(quality.checked_lines(df)).count() == 1


def test_conversations(spark):
    cases = {
        1: (["system", "user", "assistant"], (True, True, True, True)),
        2: (["user", "assistant", "user"], (False, True, True, True)),
        3: (["assistant", "user"], (False, True, False, True)),
        4: (["user", "system"], (True, True, False, True)),
        5: (["system", "system", "user"], (True, True, False, True)),
        6: (["user", "user"], (False, True, False, True)),
    }
    rows = [(c, t, role, "text") for c, (roles, _) in cases.items() for t, role in enumerate(roles)]
    rows += [(7, 1, "user", "x"), (8, 0, "user", ""), (9, 0, "user", "x"), (9, 0, "user", "x")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    found = {
        r.conv_id: (r.has_system, r.numbered, r.roles_ok, r.content_ok)
        for r in quality.conversation_checks(df).collect()
    }
    for conv, (_, expected) in cases.items():
        assert found[conv] == expected, conv
    assert found[7][1] is False and found[8][3] is False and found[9][1] is False
