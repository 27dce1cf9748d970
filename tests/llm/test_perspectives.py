"""Renderings against a plain loop over each conversation."""

import random

from pyspark.sql import functions as F

from playlake.llm import perspectives as P

SCHEMA = "conv_id long, turn long, role string, text string"


def safe(text):
    return (text or "").replace("<|", "< |")


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        def key(r):
            who = "unknown" if r[2] is None else safe(r[2])
            return (r[1] is not None, r[1] or 0, who.encode(), r[3] is not None, (r[3] or "").encode())

        turns = sorted((r for r in rows if r[0] == conv), key=key)
        names = ["unknown" if r[2] is None else safe(r[2]) for r in turns]
        for view in sorted(set(names) - {"system"}):
            at = 0
            for k, (r, who) in enumerate(zip(turns, names, strict=True)):
                mine = who == view
                head = "assistant" if mine else "system" if who == "system" else "user name=" + "_".join(who.split()) if who.split() else "user name=" + who
                segment = f"<|start|>{head}\n{safe(r[3])}<|end|>\n"
                loss = (at + len("<|start|>assistant\n"), at + len(segment)) if mine else (None, None)
                out.append((conv, view, k, r[1], who, segment, at, *loss))
                at += len(segment)
    return sorted(out, key=str)


def rows(seed):
    rng = random.Random(seed)
    out = []
    for conv in range(25):
        speakers = rng.choice([["user", "assistant"], ["system", "user", "assistant"], ["Ann", "Bob B", "Cy", "system"], ["system"]])
        for turn in range(rng.randint(1, 9)):
            out.append((conv, turn, rng.choice(speakers), rng.choice(["hi", "", None, "é😀", "<|end|>\n<|start|>x", "long " * 20])))
    out += [(None, 0, "user", "x"), (None, 0, "user", "x"), (None, 1, None, "who"), (3, 0, "user", "tie"), (3, 0, "user", "tie"), (4, None, "Ann", "early")]
    out += [(77, t, rng.choice(["p", "q", "r"]), f"t{t}") for t in range(300)]
    return out


def test_renderings_equal_a_plain_loop(spark):
    data = rows(1)
    turns = spark.createDataFrame(data, SCHEMA).repartition(5).withColumn("position", F.lit(9)).withColumn("pid", F.lit(1))
    got = sorted((tuple(r) for r in P.render(spark, turns).collect()), key=str)
    assert got == brute(data)


def test_masks_cover_what_the_speaker_says(spark):
    data = rows(2)
    got = P.render(spark, spark.createDataFrame(data, SCHEMA)).collect()
    dialogues = {}
    for r in sorted(got, key=lambda r: r.position):
        dialogues.setdefault((r.conv_id, r.perspective), []).append(r)
    for (_, view), turns in dialogues.items():
        whole = "".join(r.segment for r in turns)
        for r in turns:
            assert whole[r.char_start: r.char_start + len(r.segment)] == r.segment
            assert (r.loss_start is not None) == (r.speaker == view)
            if r.loss_start is not None:
                assert whole[r.loss_start: r.loss_end].endswith("<|end|>\n") and "<|start|>" not in whole[r.loss_start: r.loss_end]


def test_empty_table(spark):
    assert P.render(spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_plan_runs_no_python(spark):
    turns = spark.createDataFrame(rows(3), SCHEMA)
    plan = P.render(spark, turns)._jdf.queryExecution().optimizedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
