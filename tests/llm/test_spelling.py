import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tuneloom.llm import spelling


def edits_of_one(a, b):
    """Whether two texts differ by exactly one inserted, deleted or replaced code point."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows, least_count=5, typo=199):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % typo == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    words = {w: n for w, n in total.items() if len(w) >= 6 and n >= least_count}
    near = {w: [v for v in words if edits_of_one(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted(
        (w, n, len(near[w]), form[w] or "", words.get(form[w], -1), root(w)) for w, n in words.items()
    )


def found(df):
    rows = df.select("word", "n", "n_near", "form", "form_n", "root").collect()
    return sorted((r.word, r.n, r.n_near, r.form or "", -1 if r.form_n is None else r.form_n, r.root) for r in rows)


def some_rows(n=150, seed=3):
    rnd = random.Random(seed)
    letters = "aabbcdeé÷ÿ"
    base = ["".join(rnd.choices(letters, k=rnd.randint(5, 9))) for _ in range(40)]
    many = base[:8] * 30 + base

    def word():
        w = rnd.choice(many)
        kind, i = rnd.random(), rnd.randrange(len(w))
        if kind < 0.1:
            w = w[:i] + w[i + 1 :]
        elif kind < 0.2:
            w = w[:i] + rnd.choice(letters) + w[i:]
        elif kind < 0.3:
            w = w[:i] + rnd.choice(letters) + w[i + 1 :]
        return w.capitalize() if kind > 0.9 and w[0] < "z" else w

    rows = [(i, rnd.choice([" ", "\n", "1", "×", "_"][:3]).join(word() for _ in range(60))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, "12 !? 漢字"), (None, rows[0][1]), rows[1], rows[1]]


def test_words_and_forms_like_brute_force(make):
    rows = some_rows()
    want = brute(rows)
    assert any(w[3] for w in want) and any(w[3] and w[5] != w[3] for w in brute(rows, 1)), "chains are wanted"
    assert found(spelling.variants(make(rows, extra=True))) == want
    assert found(spelling.variants(make(rows), least_count=1)) == brute(rows, 1)


@pytest.mark.parametrize("symbols", [1, 2, 16])
def test_number_of_symbols_changes_no_result(make, symbols):
    rows = some_rows(40)
    assert found(spelling.variants(make(rows), least_count=1, symbols=symbols)) == brute(rows, 1)


def test_letters_left_out(make, monkeypatch):
    rows = some_rows(30, 5)
    total = spelling.word_counts(make(rows), typo=3).where("n >= 2")
    assert sorted(total.collect()) == sorted((w, n) for w, n, *_ in brute(rows, 2, 3))


def test_long_texts_are_read_in_parts(make, monkeypatch):
    assert "".join(spelling.parts("aaa bb  cccccc d", 2)) == "aaa bb  cccccc d"
    for size in (1, 2, 5):
        cut = list(spelling.parts("aaa bb  cccccc d", size))
        assert [w for c in cut for w in c.split()] == ["aaa", "bb", "cccccc", "d"]
    run = "abcdef" * 50_000
    text = (run + " " + "wonder " * 200_000) * 2
    got = {r.word: r.n for r in spelling.word_counts(make([(1, text)]), typo=10**12).collect()}
    assert got == {run: 2, "wonder": 400_000}


def test_very_long_words_are_compared(spark):
    long = "ab" * 60_000
    words = spark.createDataFrame([(long, 10), (long[:-1], 2), (long + "cc", 5), (None, 3)], "word string, n bigint")
    got = {(r.word and len(r.word)): (r.n_near, r.form and len(r.form)) for r in spelling.forms(words).collect()}
    assert got == {120_000: (1, None), 119_999: (1, 120_000), 120_002: (0, None), None: (0, None)}


def test_ties_go_to_the_first_in_code_point_order(spark):
    words = [("bbbbbb", 1), ("bbbbbé", 9), ("bbbbbz", 9), ("abbbbb", 8)]
    rows = spelling.forms(spark.createDataFrame(words, "word string, n bigint")).collect()
    assert {r.word: r.form for r in rows}["bbbbbb"] == "bbbbbz"


def test_circles_are_impossible_and_chains_end(spark):
    chain = [(f"w{i:02d}", f"w{i + 1:02d}") for i in range(37)]
    df = spark.createDataFrame([*chain, ("w37", None)], "word string, form string")
    assert {r.root for r in spelling.roots(df).collect()} == {"w37"}
    assert spelling.roots(df.where("form IS NULL")).count() == 0


def test_one_edit():
    rnd = random.Random(1)
    for _ in range(3000):
        a = "".join(rnd.choices("aé", k=rnd.randint(0, 5)))
        b = "".join(rnd.choices("aé", k=rnd.randint(0, 5)))
        assert spelling.one_edit(a, b) == edits_of_one(a, b), (a, b)


def test_empty_tables(make):
    assert spelling.variants(make([])).collect() == []
    assert spelling.variants(make([(1, None), (2, "short")])).collect() == []


def test_neighbourhood_is_full_and_has_no_repeats():
    words = ["aabba", "a", "zzzz", "bcbcbc"]
    reduced = spelling.Reduced(pa.array(words), 3)
    first = np.cumsum([0, *map(len, words)])
    got: dict[int, list] = {}
    for word, key in reduced.neighbourhood():
        for w, k in zip(word.tolist(), key.tolist()):
            got.setdefault(w, []).append(k)

    def key(symbols):
        return sum(s * pow(spelling.BASE, i, 1 << 64) for i, s in enumerate(symbols)) % (1 << 64)

    for w, word in enumerate(words):
        s = reduced.symbol[first[w] : first[w + 1]].tolist()
        ball = {tuple(s)}
        ball |= {tuple(s[:i] + s[i + 1 :]) for i in range(len(s))}
        ball |= {tuple(s[:i] + [t] + s[i + 1 :]) for i in range(len(s)) for t in (1, 2, 3)}
        ball |= {tuple(s[:i] + [t] + s[i:]) for i in range(len(s) + 1) for t in (1, 2, 3)}
        assert sorted(got[w]) == sorted(map(key, ball)), word
