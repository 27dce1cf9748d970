"""Randomised checks of the flagship counts and of distributed global positions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from playlake.operators import gold, ordering

views = st.lists(st.tuples(st.integers(1, 40), st.integers(1, 4), st.integers(1, 3)), min_size=1, max_size=300)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(views, st.booleans(), st.integers(1, 5))
def test_episode_viewers_match_brute_force(spark, rows, strict, min_viewers):
    fact = spark.createDataFrame(rows, "user_key long, title_key long, episode long")
    dim = spark.createDataFrame([(t, f"t{t}") for t in range(1, 5)], "title_key long, title string")
    per = {}
    for u, t, e in rows:
        per.setdefault(t, {1: set(), 2: set()})
        if e <= 2:
            per[t][e].add(u)
    want = {}
    for t, s in per.items():
        e1 = len(s[1])
        e2 = len(s[1] & s[2]) if strict else len(s[2])
        if e1 >= min_viewers:
            want[t] = (e1, e2, round(e2 / e1, 4))
    got = {r.title_key: (r.ep1_viewers, r.ep2_viewers, r.ep2_retention)
           for r in gold.episode_dropoff(fact, dim, min_viewers=min_viewers, strict_cohort=strict).collect()}
    assert got == want


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 5), min_size=1, max_size=400), st.integers(1, 9))
def test_global_position_is_a_dense_stable_ranking(spark, values, parts):
    df = spark.createDataFrame(list(enumerate(values)), "i long, v long")
    out = ordering.global_position(df, [F.col("v").asc(), F.col("i").asc()], num_partitions=parts)
    got = [r.i for r in out.orderBy("position").collect()]
    assert got == sorted(range(len(values)), key=lambda i: (values[i], i))
    assert sorted(r.position for r in out.collect()) == list(range(1, len(values) + 1))


bags = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.sampled_from(["1.0000", "", None])), max_size=30)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(bags, bags)
def test_drift_equals_except_all_both_ways(spark, left, right):
    from playlake.operators import quality

    schema = "t string, v string"
    e, a = spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)
    got = [tuple(r) for r in quality.drift(e, a).collect()]
    want = ([tuple(r) + ("missing",) for r in e.exceptAll(a).collect()]
            + [tuple(r) + ("unexpected",) for r in a.exceptAll(e).collect()])
    key = lambda r: tuple("" if x is None else "~" + x for x in r)
    assert sorted(got, key=key) == sorted(want, key=key)


keyed = st.lists(st.tuples(st.integers(1, 8), st.integers(0, 5)), max_size=25)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(keyed, keyed)
def test_upsert_matches_merge_semantics(spark, target_rows, incoming_rows):
    from playlake.sources import bronze

    target = {}
    for k, v in target_rows:
        target[k] = (v, -1)  # one row per key in a target table
    incoming = [(k, v, i) for i, (k, v) in enumerate(incoming_rows)]
    t = spark.createDataFrame([(k, v, s) for k, (v, s) in target.items()], "k long, v long, s long")
    inc = spark.createDataFrame(incoming, "k long, v long, s long")
    got = {r.k: (r.v, r.s) for r in bronze.upsert(t, inc, ["k"], [F.col("s").desc()]).collect()}
    want = dict(target)
    for k, v, s in incoming:  # later rows win
        want[k] = (v, s)
    assert got == want


lines = st.lists(st.tuples(st.integers(1, 3), st.integers(0, 1000)), max_size=80, unique_by=lambda x: x[1])


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(lines, st.integers(1, 6))
def test_log_tail_matches_brute_force(spark, rows, n):
    from playlake.operators import runlog

    df = spark.createDataFrame([(g, s, f"l{s}") for g, s in rows], "g long, seq long, line string")
    got = {r.g: r.tail for r in runlog.log_tail(df, ["g"], "seq", "line", n).collect()}
    want = {}
    for g in {g for g, _ in rows}:
        seqs = sorted(s for gg, s in rows if gg == g)[-n:]
        want[g] = [f"l{s}" for s in seqs]
    assert got == want


tagsets = st.lists(st.sampled_from(["dark", "cozy", "hype", "melancholy", "absurd", "x"]), max_size=4)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(tagsets, tagsets, st.sampled_from(["", "raw", None])), min_size=1, max_size=20))
def test_eval_counts_add_up_and_swap(spark, rows):
    from playlake.operators import evals
    from playlake.schemas import MOOD_TAGS

    schema = "media_id long, mood_tags array<string>, raw_response string, input_tokens long, output_tokens long"
    sides = [spark.createDataFrame([(i, r[k], r[2], 1, 2) for i, r in enumerate(rows)], schema) for k in (0, 1)]

    def score(golden, preds):
        scored = evals.score_join(golden, preds)
        confusion = evals.tag_confusion(scored, MOOD_TAGS)
        return {r.tag: (r.tp, r.fp, r.fn) for r in confusion.collect()}, evals.eval_summary(golden, scored, evals.tag_prf(confusion)).first()

    (there, one), (back, two) = score(*sides), score(*sides[::-1])
    for tag in MOOD_TAGS:
        tp, fp, fn = there[tag]
        assert (tp + fn, tp + fp) == tuple(sum(tag in r[k] for r in rows) for k in (0, 1))
        assert back[tag] == (tp, fn, fp)
    assert one.mean_jaccard == two.mean_jaccard and one.macro_f1 == two.macro_f1  # both are symmetric
    assert (one.n_scored, one.tokens_per_title) == (len(rows), 3)
    silent = sum(not r[1] and bool(r[2]) for r in rows)
    assert abs(one.parse_fail_rate - silent / len(rows)) <= 0.5e-4
    _, same = score(sides[0], sides[0])
    assert same.mean_jaccard == 1.0

