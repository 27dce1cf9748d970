"""Base figures and line counts against brute force."""

import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from playlake.llm import line_frequency as L

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string"


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def base(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i: i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    repeat = {k for i, w in enumerate(windows) if often[w] > 1 for k in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(repeat) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeat), failed


def brute(rows):
    holds, texts = defaultdict(set), defaultdict(set)
    key = lambda line: " ".join(WORD.findall(ascii_lower(line)))
    for _, t, s in rows:
        texts[s].add(t)
        for line in (t or "").split("\n"):
            if key(line):
                holds[s, key(line)].add(t)
    out = []
    for d, t, s in rows:
        n, *rest, failed = base(t)
        limit = max(L.LEAST, L.SHARE * len(texts[s]))
        gone = sum(len(WORD.findall(x)) for x in (t or "").split("\n") if key(x) and len(holds[s, key(x)]) > limit)
        out.append((d if d is not None else -1, n, *rest, failed, not failed and gone <= 0.5 * n, gone))
    return sorted(out)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "é", "Über", "x#y", "<b>", "100%", "&", "\x00", "the"] + [f"w{i}" for i in range(200)]
    shared = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 12))) for _ in range(5)]
    rows = []
    for d in range(300):
        lines = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choice(shared) if rng.random() < 0.35 else " ".join(rng.choices(vocabulary, k=rng.randint(0, 14)))
            lines.append(rng.choice([line, line.upper(), f"  {line}\t", line.replace(" ", "  ")]))
            if rng.random() < 0.2:
                lines.append(lines[-1])
        rows.append((d, "\n".join(lines), rng.choice(["s0", "s0", "s1", None])))
    rows += [(900, None, "s0"), (901, "", "s1"), (902, "\n\n \n", None), (None, "no id " * 12, "s0"), (5, rows[6][1], "s0")]
    rows += [(1000 + i, "one whole copy of a line that is long enough to pass here", "s1") for i in range(40)]
    return rows


def run(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4).withColumn("line", F.lit("own")).withColumn("row", F.lit(1))
    got = L.quality(spark, docs).collect()
    return sorted((r[0] if r[0] is not None else -1, *r[1:]) for r in got)


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr("playlake.llm.words.SLICE_ROWS", 7)
    rows = corpus(1)
    got = run(spark, rows)
    assert got == brute(rows)
    assert any(r[-1] for r in got) and any(r[6] for r in got) and any(r[7] for r in got)
    assert any(not r[6] and not r[7] for r in got)  # some are depleted
    assert all(r[7] for r in got if r[0] >= 1000)  # copies of one text count once


def test_empty_table_and_long_text(spark):
    assert run(spark, []) == []
    rows = [(1, " ".join(str(i) for i in range(50_000)), "s")]
    assert run(spark, rows) == brute(rows)
