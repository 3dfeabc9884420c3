from notepairs.llm import preference as P

TURNS = "pair_id long, turn long, role string, text string, prompt string"


def frame(spark, conversations):
    rows = [(i, k, role, text, "x") for i, turns in conversations.items() for k, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, TURNS)


def rendered(turns):
    return "".join(f"<|im_start|>{r or ''}\n{t or ''}<|im_end|>\n" for r, t in turns)


CHOSEN = {
    1: [("user", "Hi"), ("assistant", "Hello"), ("user", "More"), ("assistant", "Good")], 2: [("user", "Q"), ("assistant", "A")],
    3: [("user", "Q"), ("assistant", "A")], 4: [("user", None), (None, "x"), ("assistant", "y")], 5: [("user", "only here"), ("assistant", "a")],
}
REJECTED = {
    1: [("user", "Hi"), ("assistant", "Hello"), ("user", "More"), ("assistant", "Bad")], 2: [("user", "Q"), ("assistant", "A")],
    3: [("user", "Z"), ("assistant", "A"), ("user", "c"), ("assistant", "d")], 4: [("user", None), (None, "x"), ("assistant", "z")], 6: [("user", "only there")],
}


def test_pairs(spark):
    got = {r.pair_id: r for r in P.preference_pairs(frame(spark, CHOSEN), frame(spark, REJECTED)).collect()}
    assert {i: r.prefix_turns for i, r in got.items()} == {1: 3, 2: 2, 3: 0, 4: 2, 5: 0, 6: 0}
    assert {i: r.usable for i, r in got.items()} == {1: True, 2: False, 3: True, 4: True, 5: False, 6: False}
    for i, r in got.items():
        for side, turns in ((r.chosen, CHOSEN.get(i, [])), (r.rejected, REJECTED.get(i, []))):
            text = "".join(s.text for s in side)
            assert (r.prompt if turns else "") + text == rendered(turns)
            assert [s.text for s in side if s.trained] == [(t or "") + P.END for role, t in turns[r.prefix_turns :] if role == "assistant"]


def test_empty_and_repeated(spark):
    none = spark.createDataFrame([], TURNS)
    assert P.preference_pairs(none, none).count() == 0
    twice = frame(spark, CHOSEN).union(frame(spark, CHOSEN))
    got = {r.pair_id: r for r in P.preference_pairs(twice, twice).collect()}
    assert all(not r.usable for r in got.values()) and got[1].prefix_turns == 8


def brute(talks):
    """What ``neighbour_pairs`` makes of ``(conv_id, turn, role, text)`` rows."""
    first = lambda t: (t[0] is not None, t[0] or 0, t[1], t[2])
    convs = {}
    for i, turn, role, text in talks:
        convs.setdefault(i, []).append((turn, role or "", text or ""))
    convs = {i: sorted(turns, key=first) for i, turns in convs.items()}
    at = {i: max((k for k, t in enumerate(turns) if t[1] == "assistant"), default=None) for i, turns in convs.items()}
    out = {}
    for i, turns in convs.items():
        other = None if i is None else i ^ 1
        paired = i is not None and at[i] is not None and other in convs and at[other] is not None
        says = [t[1:] for t in turns]
        rejected = [(r, convs[other][at[other]][2]) if k == at[i] else (r, t) for k, (r, t) in enumerate(says)] if paired else []
        n = next((k for k, (x, y) in enumerate(zip(says, rejected)) if x != y), min(len(says), len(rejected)))
        out[i] = (n, rendered(says[:n]), rendered(says[n:]), rendered(rejected[n:]), paired and any(r == "assistant" for r, _ in says[n:]))
    return out


def formatted(table):
    pairs = P.neighbour_pairs(table)
    rows = pairs.select("pair_id", "prefix_turns", "prompt", P.completion(pairs["chosen"]).alias("c"), P.completion(pairs["rejected"]).alias("r"), "usable").collect()
    got = {r.pair_id: tuple(r)[1:] for r in rows}
    assert len(got) == len(rows)
    return got


def test_every_conversation_is_formatted(spark):
    """Missing neighbours and replies, trailing turns, null ids, equal replies, repeated rows, long texts, clashing names."""
    long = "word " * 200_000
    talks = [
        (0, 0, "user", "a"), (0, 1, "assistant", "b"), (0, 2, "user", "c"), (0, 3, "user", "d"), (1, 0, "user", "d"), (1, 1, "assistant", long),
        (2, 0, "user", "f"), (3, 0, "assistant", "g"), (4, 0, "assistant", "alone"), (None, 0, "assistant", "x"), (None, 1, "user", "y"),
        (6, 0, "assistant", "same"), (7, 5, "assistant", "same"), (8, None, None, None), (8, 1, "assistant", None), (9, 1, "assistant", "i"), (9, 1, "assistant", "i"), (9, 1, "assistant", "h"),
    ]
    table = spark.createDataFrame([(*t, "z", 1, 2) for t in talks], "conv_id long, turn long, role string, text string, prompt string, pair_id int, side int")
    assert formatted(table) == brute(talks)
    assert {i for i, r in formatted(table).items() if r[4]} == {0, 1, 8, 9}
    assert formatted(table.limit(0)) == {}


def test_conversations_lose_no_turn(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    talks = [(r.conv_id, r.turn, r.role, r.text) for r in table.collect()]
    got = formatted(table)
    assert got == brute(talks) and len(got) == len({t[0] for t in talks})
    assert sum((p + c).count(P.END) for _, p, c, _, _ in got.values()) == len(talks)


def test_texts_move_once(spark):
    plan = P.neighbour_pairs(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_masks(spark):
    pairs = P.preference_pairs(frame(spark, CHOSEN), frame(spark, REJECTED)).where("pair_id = 1")
    row = pairs.select(P.completion(pairs["chosen"]).alias("c"), P.mask(pairs["chosen"]).alias("m")).first()
    assert row.m == "0:22,1:15" and len(row.c) == 37
