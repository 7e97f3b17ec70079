import random

import numpy as np
import pytest
import xxhash

from tuneloom.llm import components, neardup
from tuneloom.llm.tables import raw_text


def brute_print(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = lowered.encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    prints = [brute_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc_id, f"{prints[i]:016x}", min(ids, default=None)))
    return sorted(out, key=str)


def spark_groups(df):
    got = neardup.groups(neardup.fingerprints(df)).select(
        "id", neardup.as_hex(neardup.F.col("fingerprint")), "component_id"
    )
    return sorted(map(tuple, got.collect()), key=str)


def some_texts(n=120, seed=1):
    rnd = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(300)] + ["É", "ß", "AB", "ab"]
    rows = []
    for i in range(n):
        kind = rnd.random()
        if rows and kind < 0.3:
            rows.append((i, rnd.choice(rows)[1]))
        elif rows and kind < 0.6:
            words = (rnd.choice(rows)[1] or "x").split()
            words[rnd.randrange(len(words)) if words else 0 :][:1] = ["changed"]
            at = rnd.randrange(len(words)) if words else 0
            words[at : at + 1] = ["changed"]
            rows.append((i, " ".join(words)))
        else:
            rows.append((i, " ".join(rnd.choices(vocabulary, k=rnd.choice([1, 2, 3, 5, 40, 400])))))
    return rows


def test_groups_are_those_of_brute_force(make):
    rows = some_texts()
    assert spark_groups(make(rows, extra=True)) == brute_groups(rows)


def test_odd_rows(make):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (None, "one two three four"),
        (8, "one two three four"), (8, "one two three four"), (9, "x " * 30000), (None, "alone in the world"),
    ]
    assert spark_groups(make(rows)) == brute_groups(rows)
    assert spark_groups(make([])) == []


def test_prints_of_dense_cube_are_linked_like_brute_force(spark):
    """Many fingerprints around one centre: buckets with more than two members."""
    rnd = random.Random(3)
    centre = rnd.getrandbits(64)
    prints = {centre ^ sum(1 << rnd.randrange(10) for _ in range(rnd.randrange(3))) for _ in range(60)}
    prints |= {rnd.getrandbits(64) for _ in range(40)} | {centre ^ 0b111 << 50, centre ^ 0b11 << 63 & (2**64 - 1)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(signed)], "id bigint, fingerprint bigint")
    got = {r.id: r.component_id for r in neardup.groups(df).collect()}
    group = {i: i for i in got}
    changed = True
    values = list(prints)
    while changed:
        changed = False
        for i in group:
            for j in group:
                if (values[i] ^ values[j]).bit_count() <= 2 and group[j] < group[i]:
                    group[i], changed = group[j], True
    assert got == group


def test_keep_one(make):
    text = " ".join(f"a{i}" for i in range(50))
    rows = [(7, text), (3, text), (3, text), (5, "other words here " * 9), (None, "b c d e"), (None, "b c d e"), (2, None)]
    df = make(rows, extra=True)
    kept = neardup.keep_one(df)
    assert kept.schema == df.schema
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(3, text), (5, "other words here " * 9), (None, "b c d e"), (2, None)], key=str
    )
    assert neardup.keep_one(make([])).count() == 0


def test_simhash_of_more_shingles_than_a_block():
    import pyarrow as pa

    texts = [" ".join(str(i * i % 77) for i in range(n)) for n in (0, 1, 254, 257, 258, 1000)]
    got = neardup.simhash(*raw_text(pa.array(texts)))
    assert got.tolist() == [brute_print(t) for t in texts]
    assert neardup.simhash(b"", np.zeros(1, np.int64)).tolist() == []


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(110)] + [(i, i + 1) for i in range(300, 340)]
    edges += [(500, 500 + i) for i in range(1, 60)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    label = {n: n for e in edges if None not in e and e[0] != e[1] for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a in label and b in label:
                low = min(label[a], label[b])
                changed |= label[a] != low or label[b] != low
                label[a] = label[b] = low
    got = {r.node: r.root for r in components.components(df).collect()}
    assert got == {n: r for n, r in label.items() if n != r}
