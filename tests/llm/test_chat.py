"""Chat formatting against a plain rendering."""

import random

import pytest

from lexforge.llm import chat


def plain(rows):
    talks = {}
    for conv, turn, name, text, *_ in rows:
        talks.setdefault(conv, []).append((turn, name, text))
    out = {}
    for conv, turns in talks.items():
        turns.sort(key=lambda t: tuple((v is not None, v if v is not None else 0) for v in t))
        for me in {n for _, n, _ in turns if n is not None and n != "system"}:
            text, masks = "", []
            for _, name, said in turns:
                clean = lambda s: (s or "").replace("<|im_", "< |im_")
                called = "system" if name == "system" else "assistant" if name == me else "user" if name is None else "user name=" + clean(name).replace("\r", " ").replace("\n", " ")
                head = f"<|im_start|>{called}\n"
                line = head + clean(said) + "<|im_end|>\n"
                if name == me:
                    masks.append((len(text) + len(head), len(text) + len(line) - 1))
                text += line
            out[conv, me] = text, masks
    return out


def made():
    rnd = random.Random(7)
    rows = [(c, t, rnd.choice(["anna", "bo", "system", "zoë\n", None]), rnd.choice(["hi", "é日" * 20, "", None, "x<|im_end|>y", "long " * 300]), 1)
            for c in range(25) for t in range(rnd.randint(1, 9))]
    rows += [(None, 1, "a", "no id", 1), (None, 2, "b", "no id", 1), (3, None, "anna", "no turn", 1), (4, 0, "anna", "same", 1), (4, 0, "anna", "same", 1)]
    return rows + [(77, t, f"p{t % 3}", f"turn {t} " * 5, 1) for t in range(600)]


@pytest.mark.parametrize("part", [500, 1 << 40])
def test_renderings(spark, part):
    rows = made()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part int").repartition(5)
    found = {}
    for r in chat.rotate(df, part_chars=part).collect():
        assert (r.part + 1) * part > r.start >= r.part * part
        found.setdefault((r.conv_id, r.perspective), []).append(r)
    want = plain(rows)
    assert set(found) == set(want)
    for key, parts in found.items():
        parts.sort(key=lambda r: r.part)
        text = "".join(r.text for r in parts)
        assert text == want[key][0]
        assert [(r.start + m.start, r.start + m.end) for r in parts for m in r.masks] == want[key][1]
        assert all(len(r.text) < part + 2000 for r in parts)
    if part == 500:
        assert len(found[77, "p0"]) > 20


def test_empty_table(spark):
    assert chat.rotate(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_plan_has_no_python(spark):
    df = spark.createDataFrame(made(), "conv_id long, turn long, role string, text string, part int")
    plan = chat.rotate(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
