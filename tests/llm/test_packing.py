import random
import zlib

import numpy as np
import pytest
from ledgerlens.llm import packing, registry
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(registry.tokenizer_path())


def _ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


def _pieces(ids, capacity):
    return [(k, s, len(ids[s:s + capacity]), zlib.crc32(ids[s:s + capacity].tobytes())) for k, s in enumerate(range(0, len(ids), capacity))]


def _check_layout(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_query_on_whole_table(spark, sf_dir, tokenizer):
    got = registry.op8_packing(spark, sf_dir).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    mine = {}
    for r in got:
        mine.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    assert {d: sorted(x) for d, x in mine.items()} == {d: _pieces(_ids(tokenizer, t), 4096) for d, t in docs.items()}
    assert _check_layout(got, 4096) <= -(-sum(r.length for r in got) // 4096) + 1


HARD = ["", None, "It's  THE dogs' we'll\tDON'T x y", "ÀÉ é İstanbul İ ß ﬁ ½ ² ٣٤", "日本語テスト 你好 🙂🙂 \x00\x01", "<|endoftext|> <|startoftext|>a", "a <|endoftext|> b<|startoftext|>", "x<|endoftext|><|endoftext|>y\t<|startoftext|>", "a" * 5000, "12345 1,000.50 ...!!! ''' 're",
        "́x ͅ Σίσυφος ΣΑΣ", "word " * 9000, "x\x0by\x0cz\r\n\x1c\x1d\x85w"]


def test_words_encode_as_whole_texts_do(spark, tokenizer):
    docs = spark.createDataFrame([(i, t, "n") for i, t in enumerate(HARD)] + [(None, "no id", "n"), (0, "again", "n")], "doc_id bigint, text string, length string")
    got = packing.pack_documents(docs, registry.tokenizer_path(), 64).collect()
    mine = {}
    for r in got:
        mine.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for i, t in enumerate(HARD[1:], 1):
        assert sorted(mine[i]) == _pieces(_ids(tokenizer, t), 64), t
    assert len(mine[None]) == 1 and len(mine[0]) == 2
    _check_layout(got, 64)


def test_sequences_hold_the_tokens(spark, tokenizer):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(HARD)], "doc_id bigint, text string")
    got = packing.packed_sequences(docs, registry.tokenizer_path(), 256).collect()
    want = sorted(i for t in HARD for i in _ids(tokenizer, t).tolist())
    assert sorted(i for r in got for i in r.ids) == want and all(len(r.ids) <= 256 for r in got)


def test_random_strings(tokenizer):
    rng = random.Random(2)
    chars = "aAbZ09'’.,-_ \n\té́ßΣς中🙂²½  <|>"
    texts = ["".join(rng.choice(chars) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    encoder = packing._Encoder(registry.tokenizer_path())
    for t, ids in zip(texts, packing._token_ids([t.encode() for t in texts], encoder), strict=True):
        assert ids.tolist() == _ids(tokenizer, t).tolist(), repr(t)


def _plain_best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return sorted(rooms)


def test_runs_equal_best_fit_document_by_document():
    rng = random.Random(6)
    for _ in range(60):
        capacity = rng.choice((7, 16, 50))
        lengths = [rng.randint(1, rng.choice((3, capacity))) for _ in range(rng.randint(0, 200))]
        histogram = {n: lengths.count(n) for n in set(lengths)}
        rooms, placed = {}, {}
        for n, rank, count, first, offset in packing.best_fit(histogram, capacity):
            placed.setdefault(n, []).append((rank, count))
            for b in range(first, first + count):
                assert capacity - rooms.get(b, capacity) == offset
                rooms[b] = rooms.get(b, capacity) - n
        assert sorted(rooms.values()) == _plain_best_fit(lengths, capacity)
        for n, parts in placed.items():
            at = 0
            for rank, count in sorted(parts):
                assert rank == at
                at += count
            assert at == histogram[n]


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id bigint, text string"), registry.tokenizer_path()).count() == 0
