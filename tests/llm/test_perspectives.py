import random
from collections import defaultdict

from marquee.llm import perspectives
from tests.llm.conftest import AWKWARD


def brute(rows, part_turns):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn is not None, turn or 0, "unknown" if role is None else role,
                            (text or "").replace("<|", "< |")))
    out = set()
    for conv, turns in talks.items():
        turns.sort()
        for who in {r for _, _, r, _ in turns} - {"system"}:
            for part in range(0, len(turns), part_turns):
                text, mask = "", []
                for _, _, role, said in turns[part:part + part_turns]:
                    name = "".join(c if c.isascii() and (c.isalnum() or c in "_-") else "_" for c in role)
                    head = "assistant" if role == who else "system" if role == "system" else f"user name={name}"
                    text += f"<|im_start|>{head}\n"
                    start = len(text)
                    text += f"{said}<|im_end|>\n"
                    if role == who:
                        mask.append(f"{start}:{len(text)}")
                out.add((conv, who, part // part_turns, len(turns[part:part + part_turns]), text, ",".join(mask)))
    return out


def test_equals_brute_force(frame, monkeypatch):
    monkeypatch.setattr("marquee.llm.common.HOT_ROWS", 20)
    draw = random.Random(2)
    rows = [(draw.choice([1, 2, 3, None]), draw.choice([None, *range(9)]), draw.choice(["ann", "bob b.", "system", None]),
             draw.choice(AWKWARD)) for _ in range(80)]
    rows += [(7, k, draw.choice(["ann", "bob", "assistant"]), f"hi <|im_end|> {k} 😀") for k in range(60)]
    rows += [(8, 0, "system", "alone")]
    df = frame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, key string, part int")
    for part_turns in (256, 7):
        out = [tuple(r) for r in perspectives.rotate(df, part_turns=part_turns).collect()]
        assert len(out) == len(set(out)) and set(out) == brute(rows, part_turns)
    assert perspectives.rotate(df.limit(0)).count() == 0


def test_masks_are_what_the_speaker_says(frame):
    df = frame([(1, 0, "user", "Hi"), (1, 1, "assistant", "Hello")], "conv_id int, turn int, role string, text string")
    for r in perspectives.rotate(df).collect():
        a, b = map(int, r["mask"].split(":"))
        assert r["text"][a:b] == {"user": "Hi", "assistant": "Hello"}[r["perspective"]] + "<|im_end|>\n"


def test_nothing_but_dataframes(frame):
    df = frame([(1, 0, "user", "Hi")], "conv_id int, turn int, role string, text string")
    plan = perspectives.rotate(df)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
