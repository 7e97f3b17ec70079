import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tuneloom.llm import curriculum, queries, tokens


def brute_targets(sizes, weights, cap=3):
    """Share out, cap, share the excess out again, until none is above."""
    total, target, capped = sum(sizes.values()), dict.fromkeys(sizes, 0.0), set()
    live = {s for s in sizes if sizes[s] > 0 and weights[s] > 0}
    while live - capped:
        rest = total - sum(cap * sizes[s] for s in capped)
        parts = sum(weights[s] for s in live - capped)
        over = {s for s in live - capped if rest * weights[s] / parts > cap * sizes[s]}
        if not over:
            target.update({s: rest * weights[s] / parts for s in live - capped})
            break
        capped |= over
    target.update({s: float(cap * sizes[s]) for s in capped})
    return target


def rows_of(n=150, seed=2):
    rnd = random.Random(seed)
    rows = [(i, "w " * rnd.choice([0, 1, 5, 50, 300]), rnd.choice(["a"] * 6 + ["b", "c", "Z", "é", None])) for i in range(n)]
    rows += [(900, "tiny one", "q"), (901, None, "a"), (901, None, "a"), (902, "x y z", "a"), (902, "x y z", "a"), (None, "n n", None)]
    return rows + [(903, "", "empty"), (904, None, "empty")]


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_mix(make):
    rows = rows_of()
    got = curriculum.mix(make(rows, extra=True)).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + n_words(text)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    want = brute_targets(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for source, target in want.items():
        mine = [r for r in got if r.source == source]
        assert all(r.target == pytest.approx(target) and r.source_size == sizes[source] for r in mine)
        assert sum(r.taken for r in mine) == round(target)
    assert all(0 <= r.taken <= 3 * r.size for r in got)
    assert all((r.position is None) == (r.taken == 0) and 0 <= (r.position or 0) <= 1 for r in got)
    again = curriculum.mix(make(rows[::-1]).repartition(7)).collect()
    key = lambda r: (r.id, r.source, r.size, r.target, r.taken, r.position)
    assert sorted(map(key, got), key=str) == sorted(map(key, again), key=str)


def test_positions_follow_the_schedule(make):
    """The share of a source that is due before a document is the area under its schedule."""
    rows = [(i, "w " * 10, "abc"[i % 3]) for i in range(300)]
    areas = {"a": lambda t: 1.5 * t - 0.5 * t * t, "b": lambda t: 0.5 * t + 0.5 * t * t, "c": lambda t: t}
    for r in curriculum.mix(make(rows)).where("taken > 0").collect():
        assert areas[r.source](r.position) == pytest.approx(r.before / r.target)


def test_schedules_with_several_pieces(spark):
    knots = [(0.0, 1.0), (0.25, 3.0), (0.5, 0.0), (0.75, 0.0), (1.0, 2.0)]

    def area(t):
        steps, total = 20000, 0.0
        for i in range(steps):
            x = t * (i + 0.5) / steps
            for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
                if t0 <= x <= t1:
                    total += (w0 + (w1 - w0) * (x - t0) / (t1 - t0)) * t / steps
                    break
        return total

    whole = area(1.0)
    df = spark.range(1).select(
        F.array(*[F.struct(F.lit(t).alias("t"), F.lit(w).alias("weight")) for t, w in knots]).alias("knots")
    )
    df = df.select(curriculum.segments(F.col("knots")).alias("pieces"))
    for share in (0.0, 0.1, 0.4, 0.7, 0.95, 1.0):
        t = df.select(curriculum.moment(F.col("pieces"), F.lit(share * whole))).first()[0]
        assert area(t) == pytest.approx(share * whole, abs=1e-3)


def test_training_order(make):
    rows = rows_of()
    df = make(rows, extra=True)
    out = curriculum.training_order(df)
    assert out.schema == df.schema
    plan = curriculum.mix(df).collect()
    want = sum(-(-r.taken // r.size) for r in plan if r.taken)
    assert out.count() == want
    assert curriculum.training_order(make([])).count() == 0
    assert curriculum.training_order(make([(1, None), (2, "")])).count() == 0


def later_copies(rows):
    """(due, id, text) of every copy of the mix, found one by one."""
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + n_words(text)
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    slope = {s: ((1.5, 0.5), (0.5, 1.5), (1.0, 1.0))[i % 3] for i, s in enumerate(order)}
    out = []
    for source, target in brute_targets(sizes, weight).items():
        def name(r):
            return hashlib.md5(f"{'' if r[0] is None else r[0]}/{hashlib.md5((r[1] or '').encode()).hexdigest()}".encode()).hexdigest()

        mine, given = sorted((r for r in rows if r[2] == source), key=name), 0
        while given < round(target):
            for r in mine:
                n = n_words(r[1])
                if n and given < round(target):
                    a, b = slope[source]
                    share = min(given, target) / target * (a + b) / 2
                    out.append((2 * share / (a + (a * a + 2 * (b - a) * share) ** 0.5), name(r), r[0], r[1]))
                given += n
    return sorted(out, key=lambda x: x[:2])


def test_copies_are_range_sorted_by_their_positions(spark, make, tmp_path):
    rows = rows_of()
    docs = make(rows).repartition(6)
    want = later_copies(rows)
    got = curriculum.mix(docs).where("taken > 0").select("id", F.posexplode("positions").alias("n", "due")).collect()
    assert sorted(r.due for r in got) == pytest.approx([w[0] for w in want])
    assert max(r.n for r in got) == 2
    for r in curriculum.mix(docs).collect():
        assert r.position == (r.positions[0] if r.positions else None)
        assert r.positions is None or r.positions == sorted(r.positions)
    curriculum.training_order(docs).write.parquet(f"{tmp_path}/ordered")
    back = spark.read.parquet(f"{tmp_path}/ordered")
    back = back.orderBy(*tokens.written_order(back)).collect()
    assert [(r.doc_id, r.text) for r in back] == [w[2:] for w in want]


def test_query_is_range_sorted(spark, make, tmp_path):
    make(rows_of()).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op2_curriculum(spark, str(tmp_path)).collect()
    due = [r.due for r in got]
    first = [d for d in due if d is not None]
    assert first == sorted(first) and due[len(first) :] == [None] * (len(due) - len(first))
    assert sorted(d for r in got for d in r[-3:] if d is not None) == pytest.approx([w[0] for w in later_copies(rows_of())])


def test_place_is_the_same_everywhere(make):
    row = make([(7, "some text")]).select(curriculum.place(F.col("doc_id"), F.col("text"))).first()[0]
    inner = hashlib.md5(b"some text").hexdigest()
    assert row == hashlib.md5(f"7/{inner}".encode()).hexdigest()


def test_main_path_is_native(make):
    plan = curriculum.training_order(make(rows_of(20)))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
