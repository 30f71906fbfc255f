"""Mined patterns: the tree's rule, and its independence of row and partition order."""

import random

from pyspark.sql import functions as F

from capstream.operators import patterns as P


def tree(spark, lines, parts=3, **kw):
    df = spark.createDataFrame([(x,) for x in lines], "masked string").repartition(parts)
    return {r.masked: r.pattern for r in P.template_tree(df, **kw).collect()}


def brute(lines, depth=2, max_children=16, max_values=4, similarity=0.5):
    lines = {x: (tuple(x.split(" ")), ()) for x in lines if x is not None}
    for level in range(depth):
        below = {}
        for t, path in lines.values():
            if len(t) > level:
                below.setdefault((len(t), path), set()).add(t[level])
        lines = {x: (t, path if len(t) <= level else (*path, "<_>" if len(below[len(t), path]) > max_children else t[level])) for x, (t, path) in lines.items()}
    leaves = {}
    for t, path in lines.values():
        leaves.setdefault((len(t), path), []).append(t)
    out = {}
    for x, (t, path) in lines.items():
        d = [len({u[i] for u in leaves[len(t), path]}) for i in range(len(t))]
        alike = sum(n == 1 for n in d) >= similarity * len(t)
        out[x] = " ".join("<_>" if (n > 1 if alike else n > max_values) or (i < len(path) and path[i] == "<_>") else t[i] for i, n in enumerate(d))
    return out


def test_lines_that_differ_in_a_word_share_a_pattern(spark):
    got = tree(spark, ["user alice logged in", "user bob logged in", "user bob logged out", "job done"])
    assert set(got.values()) == {"user alice logged in", "user bob logged <_>", "job done"}
    assert set(tree(spark, ["user alice logged in", "user bob logged in"], depth=1).values()) == {"user <_> logged in"}
    many = tree(spark, [f"user u{chr(97 + i // 26)}{chr(97 + i % 26)} logged in" for i in range(40)])
    assert set(many.values()) == {"user <_> logged in"}


def test_equals_the_rule_for_any_order(spark):
    rng = random.Random(2)
    lines = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 6))) for _ in range(300)] + ["", " ", "a  b", None, None]
    for kw in ({}, {"depth": 1, "max_children": 2}, {"depth": 0}, {"depth": 3, "max_children": 3, "max_values": 2, "similarity": 0.7}):
        want = brute(lines, **kw)
        rng.shuffle(lines)
        assert tree(spark, lines, rng.randrange(1, 7), **kw) == want


def test_many_and_few_tokens_at_a_position(spark):
    rng = random.Random(5)
    lines = [f"k{rng.randrange(2)} {rng.randrange(10**6)} {rng.choice('abcde')} {rng.choice('xy')} same" for _ in range(2000)]
    for kw in ({}, {"max_values": 1}, {"max_values": 0, "similarity": 0.9}, {"max_values": 100, "similarity": 0.9}):
        assert tree(spark, lines, **kw) == brute(lines, **kw)


def test_lines_are_written_once(spark, monkeypatch):
    sizes, write = {}, P._written
    monkeypatch.setattr(P, "_written", lambda df, name: sizes.setdefault(name, write(df, name)))
    words = [f"w{i}" for i in range(3000)]
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(words).translate(str.maketrans("0123456789", "abcdefghij")) for _ in range(12))) for i in range(4000)]
    df = spark.createDataFrame(rows, "s int, line string").select(F.timestamp_add("SECOND", "s", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")).alias("ts"), "line")
    assert sum(r["count"] for r in P.mined_patterns(df, 60_000).select("pattern", "count").collect()) == 4000
    assert sizes.pop("masked-lines").count() == 4000
    assert sizes and all(t.count() < 100 for t in sizes.values())


def test_counts_per_step(spark):
    df = spark.createDataFrame([(1, "GET /a 10ms"), (2, "GET /a 25ms"), (90, "GET /b 1ms"), (3, None)], "s int, line string").select(
        F.timestamp_add("SECOND", "s", F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00'")).alias("ts"), "line")
    got = sorted((r.pattern or "-", r.bucket_start.minute, r["count"], r.total) for r in P.mined_patterns(df, 60_000, depth=1).collect())
    assert got == [("-", 0, 1, 1), ("GET <_> <_>", 0, 2, 3), ("GET <_> <_>", 1, 1, 3)]
    assert P.mined_patterns(df.limit(0), 60_000).collect() == []


def test_no_python_and_no_window_over_lines(spark, sf, capsys):
    from capstream.plans import standins as S
    P.mined_patterns(S.event_logs(spark, sf), 60_000).explain("formatted")
    p = capsys.readouterr().out
    assert "Python" not in p and "Arrow" not in p
