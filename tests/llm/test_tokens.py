import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tuneloom.llm import separators, tokens
from tuneloom.llm.queries import byte_bpe
from tuneloom.llm.tables import raw_text

TEXTS = [
    "Hello world, it's we'll they're I'm. A.b.c!? x;y:z", " leading  two   three \n\n new\tline \r\n end ", "", None,
    "été ñandú straße Öl  nbsp　ideographic  em a\u0085b", "汉字 漢字 テスト한국어 עברית عربي हिन्दी",
    "<|endoftext|> is no text <|endoftext|>", "a. <|endoftext|>. b  <|endoftext|>  <|endoftext|><|endoftext|", " <|endoftext|> ", "a" * 3000, "1234 56.7 8,9 ½ ² x1 1x", "emoji 😀😃 👩‍👩‍👧 end", " ", "  ", "\n",
    "don't 'tis '' '' \"q\" (p) [b] {c} a.B.C ,,, ...word word...", "́ á é ẞ ǅ ʰ x​z", "tail ", " . ! , ;a ;",
]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(byte_bpe())
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def random_texts(n=300):
    rnd = random.Random(9)
    alphabet = [" ", " ", " ", "\n", "\t", "a", "b", "Z", "é", "ß", "ı", "1", ".", ",", "!", "'", "s", "t", " ", "漢", "-", "😀", "ʰ", "<|endoftext|>"]
    return ["".join(rnd.choices(alphabet, k=rnd.randrange(60))) for _ in range(n)]


def test_encoder_gives_the_ids_of_whole_texts(tokenizer):
    texts = TEXTS + random_texts()
    flat, counts = tokens.Encoder(byte_bpe()).encode(*raw_text(pa.array(texts)))
    ends = np.cumsum(counts)
    for text, b, e in zip(texts, ends - counts, ends):
        assert flat[b:e].tolist() == tokenizer(text), repr(text)


def test_special_names_are_special_tokens(tokenizer):
    assert 50256 in tokenizer("a <|endoftext|> b")
    assert tokens.Encoder(byte_bpe()).encode(*raw_text(pa.array(["<|endoftext|>"])))[0].tolist() == [50256]


def test_memory_of_cuttings_is_bounded(monkeypatch, tokenizer):
    monkeypatch.setattr(tokens, "REMEMBERED_BYTES", 5000)
    encoder = tokens.Encoder(byte_bpe())
    for n in range(30):
        texts = [f"{chr(97 + n % 26)}word{i} x{'漢' * 500}{n}" for i in range(20)]
        flat, counts = encoder.encode(*raw_text(pa.array(texts)))
        assert flat.tolist() == [i for t in texts for i in tokenizer(t)]
        assert encoder.held < 5000 + 60 * 400 and max(map(len, encoder.known)) <= tokens.REMEMBERED_LETTERS


def test_other_tokenizers_are_refused(tmp_path):
    from tokenizers import Tokenizer, models, normalizers, pre_tokenizers

    for change in ("normalizer", "pre_tokenizer", "special"):
        t = Tokenizer(models.BPE())
        t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
        if change == "normalizer":
            t.normalizer = normalizers.Lowercase()
        elif change == "pre_tokenizer":
            t.pre_tokenizer = pre_tokenizers.Whitespace()
        else:
            t.add_special_tokens(["<a b>"])
        t.save(str(tmp_path / "t.json"))
        with pytest.raises(ValueError):
            tokens.Encoder(str(tmp_path / "t.json"))


@pytest.mark.parametrize("ids", [[], [0], [255, 256, 65535, 65536, 2**32 - 1, 3], list(range(0, 70000, 7)), [300] * 1025])
def test_packed_ids(ids):
    packed = tokens.Packed(tokens.pack(np.array(ids, np.uint32)))
    assert len(packed) == len(ids)
    assert packed.all().tolist() == ids
    places = np.array(random.Random(1).choices(range(len(ids)), k=60) if ids else [], np.int64)
    assert packed.get(places).tolist() == [ids[p] for p in places]
    with pytest.raises(ValueError):
        tokens.Packed(b"nope" * 5)


def brute(rows, tokenizer):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*tokenizer(text), 2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_files_are_read_back(spark, make, tokenizer):
    texts = TEXTS + random_texts(60) + ["very long " * 20000]
    rows = [(3 * i % 101, t) for i, t in enumerate(texts[:78])]
    df = make(rows, extra=True).repartition(5)
    segments = tokens.token_files(df, byte_bpe(), segment_ids=200)
    assert segments.count() > 4
    got = sorted(map(tuple, tokens.read_tokens(segments).collect()), key=lambda r: r[1])
    assert got == brute(rows, tokenizer)
    stream = [i for _, t in sorted(rows) for i in [*tokenizer(t), 2]]
    asked = [0, 1, 5, 199, 200, 201, 500, len(stream) - 1, 5, len(stream), -1, None]
    places = spark.createDataFrame([(a,) for a in asked], "place bigint")
    found = sorted(map(tuple, tokens.tokens_at(segments, places).collect()))
    assert found == sorted((a, stream[a]) for a in asked if a is not None and 0 <= a < len(stream))


def test_odd_documents(make, tokenizer):
    rows = [(None, "no key"), (1, None), (1, None), (2, "twice"), (2, "twice"), (4, "")]
    got = tokens.read_tokens(tokens.token_files(make(rows), byte_bpe())).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == brute(rows, tokenizer)
    assert tokens.read_tokens(tokens.token_files(make([]), byte_bpe())).count() == 0


def test_counts_by_separators(make, tokenizer):
    texts = TEXTS + random_texts(50) + ["word " * 3000]
    rows = [(i, t) for i, t in enumerate(texts)] + [(5, TEXTS[0]), (None, "x y"), (7, None)]
    df = make(rows, extra=True).repartition(3)
    got = separators.token_counts(df, byte_bpe(), block_ids=100)
    plain = tokens.Encoder(byte_bpe(), names_as_text=True).tokenizer  # the separator must not be in a text
    want = sorted(((i, len(plain.encode(t or "", add_special_tokens=False).ids)) for i, t in rows), key=str)
    assert sorted(map(tuple, got.collect()), key=str) == want
    assert separators.token_counts(make([]), byte_bpe()).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 7, 100])
def test_scan_of_flat_blocks(spark, size):
    rnd = random.Random(size)
    files = {f: [rnd.choice([9, 1, 1, 1]) for _ in range(n)] for f, n in enumerate((0, 1, 5, 40, 41))}
    files[7] = [1] * 30
    files[8] = [9, 9, 9]
    blocks = [
        (f, k, bytearray(np.array(ids[at : at + size], "<u2").tobytes()))
        for f, ids in files.items()
        for k, at in enumerate(range(0, len(ids), size))
    ]
    df = spark.createDataFrame(blocks, "file int, block int, payload binary")
    want = []
    for f, ids in files.items():
        docs = "".join("|" if i == 9 else "x" for i in ids).split("|")
        docs = docs[:-1] if not docs[-1] else docs
        want += [(f, n, len(d)) for n, d in enumerate(docs)]
    got = separators.count_documents(df, separator=9)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert got.select(F.sum("n_tokens")).first()[0] == sum(i != 9 for ids in files.values() for i in ids)
