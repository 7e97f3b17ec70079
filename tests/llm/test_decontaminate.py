import random
import re

import pytest

from tuneloom.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(text, items, window=10):
    words, hit, longest = split(text), set(), {}
    for item_id, item in items:
        iw = split(item)
        n = min(window, len(iw))
        if not n:
            continue
        windows = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)}
        for p in range(len(words) - n + 1):
            if tuple(words[p : p + n]) in windows:
                hit |= set(range(p, p + n))
        best = 0
        for p in range(len(words)):
            for o in range(len(iw)):
                k = 0
                while p + k < len(words) and o + k < len(iw) and words[p + k] == iw[o + k]:
                    k += 1
                best = max(best, k)
        if best >= n:
            longest[str(item_id)] = best
    return len(words), len(hit), longest


def data():
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(40)] + ["Élan", "ÄB", "x"]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([1, 3, 9, 10, 11, 25])))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "!!"), (53, items[5][1]), (54, "the the the the the the the the the the the the")]
    docs = []
    for i in range(60):
        words = rnd.choices(vocabulary, k=rnd.choice([0, 5, 30, 60]))
        if rnd.random() < 0.5:
            part = split(rnd.choice(items)[1])
            cut = rnd.randrange(3)
            at = rnd.randrange(len(words) + 1)
            words[at:at] = part[cut:] + (part if rnd.random() < 0.3 else [])
        docs.append((i, rnd.choice([" ", ", ", "\n"]).join(words).upper() if i % 7 == 0 else " ".join(words)))
    return docs + [(70, None), (71, "?!"), (72, "The THE " * 30), (73, "zz " * 5000 + items[4][1]), (73, items[4][1])], items


@pytest.mark.parametrize("block", [1 << 20, 150])
def test_overlap_is_that_of_brute_force(spark, make, block):
    docs, items = data()
    df = make(docs, extra=True)
    tests = spark.createDataFrame(items, "item_id bigint, text string").repartition(3)
    got = decontaminate.find_overlap(df, tests, found="shared", block_bytes=block).collect()
    assert len(got) == len(docs)
    want = {}
    for doc_id, text in docs:
        want.setdefault(doc_id, []).append(brute(text, items))
    seen = {}
    for r in got:
        s = r.shared
        assert s.n_hit == sum(x.stop - x.start for x in s.spans)
        assert all(a.stop < b.start for a, b in zip(s.spans, s.spans[1:]))
        words = split(r.text)
        known = {str(i): split(t) for i, t in items}
        for x in s["items"]:
            assert words[x.doc_start : x.doc_start + x["words"]] == known[x.item_id][x.item_start : x.item_start + x["words"]]
        seen.setdefault(r.doc_id, []).append((s.n_words, s.n_hit, {x.item_id: x["words"] for x in s["items"]}))
    assert {k: sorted(v, key=str) for k, v in seen.items()} == {k: sorted(v, key=str) for k, v in want.items()}


def test_removal(spark, make):
    docs, items = data()
    df = make(docs, extra=True)
    tests = spark.createDataFrame(items, "item_id bigint, text string")
    kept = decontaminate.remove_affected(df, tests)
    assert kept.schema == df.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, t in docs if brute(t, items)[1] == 0)


def test_empty_tables(spark, make):
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontaminate.remove_affected(make([(1, "a b"), (2, None)]), none).count() == 2
    assert decontaminate.remove_affected(make([]), none).count() == 0
    one = spark.createDataFrame([(None, "a b")], "item_id bigint, text string")
    assert decontaminate.remove_affected(make([(1, "a b c"), (2, "a c b")]), one).count() == 1
