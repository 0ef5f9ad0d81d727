import random
import uuid
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from regspan.llm import tokens, tokenstore
from regspan.llm.tokens import encoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", "<|endoftext|>", "a<|endoftext|>b", "A <|ENDOFTEXT|> x", "<|startoftext|>Hi",
    "it's IT'S don't 'tis ''s end'. x'.,", "ΣΑΣ ΌΣΟΣ İstanbul ǅ ß ẞ", "été Å å été, été***",
    "x  \t b", "x  \t\tb", "a\x1cb c\x85d", "  lead  trail  ", "\n\n\n", "a\n b\t\tc  \n",
    "日本語 テキスト です。", "12345 12.5% $3,000", "مرحبا", "🙂🙂 x🙂", "naïve café, résumé!! (ok) [x] {y}",
    "ﬁ ﬀ Ⅷ ²", "a" * 3000, "  ", "x  \t b", "​zero", "abc...def", "foo_bar-baz",
    "_x_", "x’s", "' s", "thnd*** and&&& | pipe |",
]


def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@pytest.mark.parametrize("file, space", [("byte_bpe_50k.json", "keep"), ("word_bpe_49k.json", "drop")])
def test_encoder_gives_the_ids_of_the_library(given, file, space):
    path = public_tokenizers.path(file)
    whole, own = library(path), encoder(path, space)
    r = random.Random(1)
    letters = "aAbé Éñ.,'\"<|>#\n\t ́ßΣσ1²☃ "
    noise = ["".join(r.choice(letters) for _ in range(r.randrange(1, 60))) for _ in range(1500)]
    given_texts = [x.text for x in given.select("text").collect()]
    for text in TEXTS + noise + given_texts:
        ids = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own(text), "<u4").tolist() == ids, text


@pytest.mark.parametrize("file, space", [("byte_bpe_50k.json", "keep"), ("word_bpe_49k.json", "drop")])
@pytest.mark.parametrize("chunk", [1, 200, 1 << 24])
def test_many_texts_at_once(file, space, chunk, monkeypatch):
    import pyarrow as pa

    path = public_tokenizers.path(file)
    monkeypatch.setattr(tokens, "_CHUNK", chunk)
    r = random.Random(4)
    letters = "aAbé .,'<|>\n\t\x0b\r\x1c\u2003́ßΣ1☃🙂\0 "
    noise = ["".join(r.choice(letters) for _ in range(r.randrange(0, 30))) for _ in range(3000)]
    texts = pa.array(["cut off", None, *TEXTS, "", *noise, " ", "\n", None, "  \n\n  x", "cut off"]).slice(1)
    texts = texts.slice(0, len(texts) - 1)
    encode, found = library(path).encode, tokens.Encoder(path, space).many(texts)
    for text, ids in zip(texts.to_pylist(), found, strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encode(text or "", add_special_tokens=False).ids, text
    for few in ([], [None], ["", ""]):
        assert tokens.Encoder(path, space).many(pa.array(few, pa.string())) == [b""] * len(few)


def test_a_distinct_piece_is_looked_up_once():
    import pyarrow as pa

    class Counting(tokens.Encoder):
        looked_up = 0

        def __getitem__(self, piece):
            self.looked_up += 1
            return super().__getitem__(piece)

    counting = Counting(PATH, "keep")
    assert len(counting.many(pa.array(["some plain words " * 50 + "some"] * 100))) == 100
    assert counting.looked_up <= 10


def expected(rows):
    encode = library(PATH).encode
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = np.array(encode(text or "", add_special_tokens=False).ids + [0], "<u4").tobytes()
        out.append((doc_id, start, len(ids) // 4, zlib.crc32(ids), ids))
        start += len(ids) // 4
    return out


def check(spark, docs, path):
    tokenstore.write_store(docs, path, PATH)
    got = [
        (r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids))
        for r in tokenstore.read_store(spark, path).orderBy("start").collect()
    ]
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got == expected(rows)


def test_round_trips(spark, given, odd, docs_of, tmp_path):
    for docs in (given, odd, docs_of(TEXTS), docs_of([""]), docs_of([])):
        check(spark, docs, f"{tmp_path}/{uuid.uuid4().hex}")


def test_small_blocks(spark, given, tmp_path, monkeypatch):
    monkeypatch.setattr(tokenstore, "BLOCK", 1000)
    check(spark, given, f"{tmp_path}/s")
    blocks = spark.read.parquet(f"{tmp_path}/s/blocks")
    assert blocks.count() > 50
    order = [r.start for r in blocks.select("start").orderBy(F.element_at("doc_ids", 1)).collect()]
    assert order == sorted(order)


def test_repeated_rows_and_extra_columns(clashing, spark, tmp_path):
    check(spark, clashing, f"{tmp_path}/c")


def huffman_cost(counts):
    import heapq

    heap = [c for c in counts if c]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    return total


def test_code_lengths():
    r = random.Random(2)
    for n in (2, 3, 17, 300):
        counts = [r.choice([0, 1, 3, 2**r.randrange(30)]) for _ in range(n)] + [5, 9]
        bits = tokenstore.code_lengths(counts, 40)
        assert sum(c * int(b) for c, b in zip(counts, bits)) == huffman_cost(counts)
        short = tokenstore.code_lengths(counts, 10)
        assert short.max() <= 10 and sum(2.0 ** -int(b) for b in short if b) <= 1
        assert all((b > 0) == (c > 0) for b, c in zip(short, counts))
    fibonacci = [1, 1]
    while len(fibonacci) < 30:
        fibonacci.append(sum(fibonacci[-2:]))
    assert tokenstore.code_lengths(fibonacci, 40).max() == 29
    assert tokenstore.code_lengths(fibonacci, 12).max() == 12


def test_codes_have_no_prefix_and_decode():
    r = np.random.default_rng(3)
    for n in (1, 2, 50, 5000):
        counts = r.integers(0, 1000, n) ** 3 + (np.arange(n) == 0)
        bits = tokenstore.code_lengths(counts, 20)
        codes = tokenstore.canonical_codes(bits)
        words = sorted(f"{int(c):0{int(b)}b}" for c, b in zip(codes, bits) if b)
        assert not any(b.startswith(a) for a, b in zip(words, words[1:]))
        ids = r.choice(np.flatnonzero(bits), 1000)
        payload, checkpoints = tokenstore.encode_ids(ids, codes, bits)
        lookup = tokenstore.decode_table(bits)
        assert (tokenstore.decode_ids(payload, checkpoints, len(ids), lookup) == ids).all()
