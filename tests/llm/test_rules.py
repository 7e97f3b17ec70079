import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tuneloom.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """{row: (n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept)}"""

    def norm(line):
        line = " ".join(WORD.findall(line))
        return "".join("0" if c in "0123456789" else c.lower() if "A" <= c <= "Z" else c for c in line)

    texts = defaultdict(dict)  # host -> text -> smallest id
    for doc_id, text, host in rows:
        order = (doc_id is None, doc_id or 0)
        texts[host][text or ""] = min(texts[host].get(text or "", order), order)
    holders = defaultdict(set)
    for host, held in texts.items():
        for text in held:
            for line in text.split("\n"):
                if WORD.search(line):
                    holders[host, norm(line)].add(text)
    out = []
    for doc_id, text, host in rows:
        text = text or ""
        words = WORD.findall(text)
        windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
        repeated = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
        lines = [line for line in text.split("\n") if WORD.search(line)]
        failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
        left = len(words)
        for line in lines:
            held = holders[host, norm(line)]
            if len(held) > 10:
                if min(held, key=lambda t: texts[host][t]) != text:
                    left -= len(WORD.findall(line))
        depleted = left < 10 and left < len(words) / 3
        out.append(
            (doc_id, len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
             len(lines) - len(set(lines)), len(repeated), failed, not failed and not depleted)
        )
    return sorted(out, key=str)


COLUMNS = ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


def rows_of_all_kinds():
    own = ["every own word number %d stands in line %d of this document for now" % (i, i * 7) for i in range(40)]
    own = [re.sub(r"\d+", lambda m: "".join(chr(97 + int(c)) for c in m[0]), t) for t in own]
    note = "All Rights  Reserved by the 7 owners of\tthis page and by nobody else at all"
    rows = [(i, own[i] + "\n" + note.replace("7", str(i)), "s") for i in range(14)]
    rows += [(100 + i, note + "\n" + " x%s" % own[i][16:18], "s") for i in range(6)]  # depleted
    rows += [(200, own[20], "s"), (201, own[20], "s"), (201, own[20], "s"), (None, own[21] + "\n" + note, "s")]
    rows += [(300 + i, note, None) for i in range(3)] + [(400, None, None), (401, "", "s"), (402, " \n\t\n", "t")]
    rows += [(500, "a b c d e f " * 50, "t"), (501, "é#ü*ß$ ñ " * 3 + "\nx\nx\n x", "t"), (502, "w " * 40000, "t")]
    rows += [(503, " ".join(f"v{i}" for i in range(30000)), "t"), (600, "a b c d e q a b c d e r " + own[3], "t")]
    return rows


def test_verdicts_are_those_of_brute_force(make):
    rows = rows_of_all_kinds()
    df = make(rows, extra=True)
    got = sorted(map(tuple, rules.verdicts(df).select(*COLUMNS).collect()), key=str)
    want = brute(rows)
    assert got == want
    assert 0 < sum(not r[-1] and not r[-2] for r in want) < len(want)  # some are depleted


def test_no_documents(make):
    assert rules.verdicts(make([])).count() == 0
    assert rules.apply_rules(make([])).count() == 0


def test_apply_removes_lines_and_documents(make):
    rows = rows_of_all_kinds()
    df = make(rows, extra=True)
    out = rules.apply_rules(df)
    assert out.schema == df.schema
    kept = Counter(r[0] for r in brute(rows) if r[-1])
    got = out.collect()
    assert Counter(r.doc_id for r in got) == kept
    texts = {r.doc_id: r.text for r in got}
    assert texts[0] == rows[0][1]  # the first holder keeps the line
    assert texts[5] == rows[5][1].split("\n")[0]
    assert texts[200] == rows[20][1]
    assert all(r.n_chars == len(r.text) for r in got)


def test_copies_are_one_text(make):
    """Thousands of copies don't make their lines boilerplate."""
    text = "here is a line that was copied\nmany times over the years\nand nobody knows by whom or why"
    rows = [(i, text, "s") for i in range(60)]
    out = rules.verdicts(make(rows))
    assert out.where("kept").count() == 60
    assert out.agg(F.sum("n_words")).first()[0] == 60 * len(text.split())


def test_limit_does_not_grow_with_a_hot_host(make):
    """12 of 3000 texts of one host, 0.4 %, hold a line: all but the first lose it."""
    word = lambda i: "".join(chr(97 + int(c)) for c in str(i))
    rows = [(i, " ".join(f"own{word(i * 20 + k)}" for k in range(12)), "hot") for i in range(3000)]
    note = "subscribe to our letter and never miss any of the news again"
    rows[:12] = [(i, t + "\n" + note, h) for i, t, h in rows[:12]]
    rows += [(4000 + i, f"{note}\nx{word(i)}", "hot") for i in range(2)] + [(5000, note + "\nq", "cold")]
    df = make(rows).repartition(5)
    got = {r.id: r.kept for r in rules.verdicts(df).collect()}
    assert [i for i, kept in got.items() if not kept] in ([4000, 4001], [4001, 4000])
    left = {r.doc_id: r.text for r in rules.apply_rules(df).collect()}
    assert len(left) == 3001 and [i for i, t in left.items() if note in t and i < 5000] == [0]
    assert left[5000] == note + "\nq"
