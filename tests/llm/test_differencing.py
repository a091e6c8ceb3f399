import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from ledgerlens.llm import differencing, registry, tokens
from tokenizers import Tokenizer

PATH = registry.tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def _ids(tokenizer, text):
    return np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


def _check(rows, docs, tokenizer, capacity):
    """Every id in one piece, pieces gapless in their sequences; the number of sequences."""
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        bins[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(docs)
    for doc, text in docs.items():
        ids, at = _ids(tokenizer, text), 0
        for start, length, crc, total in sorted(pieces[doc]):
            assert (start, total) == (at, len(ids)) and crc == zlib.crc32(ids[at:at + length].tobytes()), (doc, start)
            at += length
        assert at == len(ids)
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(bins)


def test_query_on_whole_table(spark, sf_dir, tokenizer):
    got = registry.op12_differencing(spark, sf_dir).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    n = _check(got, docs, tokenizer, 1024)
    assert n == -(-sum(r.length for r in got) // 1024)


HARD = ["", None, " ", "\n\n", "It's  THE dogs' we'll\tDON'T x y ", "ÀÉ é İstanbul  x 　 y \tz\u0085 w", "日本語 テスト 你好 🙂🙂 \x00\x01 \x1c \x1d x",
        "<|endoftext|> a<|endoftext|>b <|endoftext|>\n <|endoftext|><|endoftext|> ", "a" * 3000, "  two   spaces\r\n\r\n and\x0b\x0c more \t ", "12345 1,000.50 ...!!! ''' 're", "word " * 4000, "x\n y\n\nz \n"]


def test_stretches_encode_as_whole_texts_do(tokenizer, monkeypatch):
    rnd = random.Random(7)
    alphabet = ["a", "b'", "'s", " ", "  ", "\n", "\t", " ", "　", " ", "é", "1", "日", "<|endoftext|>", ".", "\x85", "\x1f", "\r\n", "🙂", "᠎", "﻿"]
    texts = HARD + ["".join(rnd.choices(alphabet, k=rnd.randint(1, 60))) for _ in range(1500)]
    encoder = tokens.Encoder(PATH)
    for step in (1 << 20, 64):
        monkeypatch.setattr(tokens, "STEP", step)
        monkeypatch.setattr(tokens, "REMEMBERED", 1 << 20 if step > 64 else 500)
        found = defaultdict(list)
        for i, ids, _ in tokens.token_ids([t.encode() if t is not None else None for t in texts], encoder):
            found[i].append(ids)
        for i, t in enumerate(texts):
            assert np.concatenate(found[i]).tolist() == tokenizer.encode(t or "", add_special_tokens=False).ids, repr(t)


def test_defined_cases(spark, tokenizer):
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(HARD)], "doc_id bigint, text string, length int")
    for capacity, bucket in ((64, 4), (1024, 1024), (7, 3)):
        got = differencing.pack(docs.repartition(5), PATH, capacity, bucket).collect()
        n = _check(got, dict(enumerate(HARD)), tokenizer, capacity)
        assert n == -(-sum(r.length for r in got) // capacity)
    again = spark.createDataFrame([(1, "same text"), (1, "same text"), (None, "no id")], "doc_id bigint, text string")
    got = differencing.pack(again, PATH).collect()
    assert sorted((r.doc_id or -1, r.length) for r in got) == [(-1, 3), (1, 3), (1, 3)] and {r.sequence_id for r in got} == {got[0].sequence_id}
    assert differencing.pack(docs.where("false"), PATH).collect() == []


def test_levels_leave_one_open_sequence(spark, tokenizer):
    rnd = random.Random(3)
    docs = {i: " ".join(rnd.choices(["alpha", "beta", "of", "the"], k=rnd.randint(1, 90))) for i in range(300)}
    table = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string").repartition(23)
    got = differencing.pack(table, PATH, 50, bucket=3).collect()
    assert _check(got, docs, tokenizer, 50) == -(-sum(r.length for r in got) // 50)


def test_differencing_evens_out():
    rnd = random.Random(5)
    sizes = [rnd.randint(1, 1023) for _ in range(400)]
    for k in (1, 2, 7, 150):
        windows = differencing.differenced(sizes, k)
        assert sorted(i for w in windows for i in w) == list(range(400))
        sums = [sum(sizes[i] for i in w) for w in windows]
        assert len(windows) == k and max(sums) - min(sums) <= {1: 0, 2: 1, 7: 3, 150: 300}[k]
    # the classic example: differencing leaves 4 + 7 + 5 against 8 + 6, a difference of 2
    two = differencing.differenced([8, 7, 6, 5, 4], 2)
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in w) for w in two) == [14, 16]


def test_sequences_hold_the_ids(spark, tokenizer):
    docs = {i: f"document {i} " * i for i in range(40)}
    table = spark.createDataFrame(list(docs.items()), "doc_id bigint, text string")
    rows = differencing.packed_sequences(table, PATH, 64).collect()
    for r in rows:
        assert len(r.ids) == (r.n_tokens if r.n_tokens & (r.n_tokens - 1) == 0 else 64)
    whole = sorted(x for r in rows for x in r.ids[:r.n_tokens])
    assert whole == sorted(x for t in docs.values() for x in _ids(tokenizer, t).tolist())


def test_a_text_of_64_megabytes(spark, tokenizer):
    """Worked on in steps; checked against the ids of its repeated block."""
    block = "The quick brown fox, the lazy dog; 12 of them.\n" * 1000
    n = (64 << 20) // len(block) + 1
    docs = spark.range(1).selectExpr("id AS doc_id", f"repeat('{block[:47].strip()}\n', {n * 1000}) AS text")
    got = differencing.pack(docs, PATH).agg({"length": "sum", "doc_tokens": "max"}).first()
    one, two = (len(tokenizer.encode((block[:46] + "\n") * k, add_special_tokens=False).ids) for k in (1, 2))
    assert got["sum(length)"] == got["max(doc_tokens)"] == one + (two - one) * (n * 1000 - 1) + 1
