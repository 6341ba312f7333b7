"""Operators 1, 4, 6 and 9 against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as public
import pytest
from tokenizers import Tokenizer

from reviewforge.llm import bpe_codec, packing, token_counts, token_files
from tests.llm.helpers import EDGE_TEXTS, edge_docs

BYTES, WORDS = public.path("byte_bpe_50k.json"), public.path("word_bpe_49k.json")
PARTS = ["a", "b", " ", "  ", "\n", "\t", "'s", "'ll", "é", "é", "Σ", "İ", "1", "23", "<|endoftext|>", "<|startoftext|>", "!!", "\x1c", "\x85", "\xa0", "日", "Ǆ", "word", "ing", "\r\n", "<|", "|>", "౜", "Ɤ"]


def texts():
    r = random.Random(1)
    return [t or "" for t in EDGE_TEXTS] + ["".join(r.choice(PARTS) for _ in range(r.randint(0, 14))) for _ in range(3000)]


def test_codecs_equal_the_library():
    lib_b, lib_w = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
    count, codec, encode, packer = token_counts.Counter(BYTES), bpe_codec.Codec(WORDS), token_files.Encoder(BYTES), packing.Encoder(WORDS)
    for t in texts():
        ids = lib_b.encode(t, add_special_tokens=False).ids
        assert count(t) == len(ids) and encode(t).tolist() == ids, t
        ids = lib_w.encode(t, add_special_tokens=False).ids
        assert codec.encode(t) == ids and np.frombuffer(packer(t), "<u4").tolist() == ids, t
        assert codec.decode(ids) == lib_w.decode(ids, skip_special_tokens=False)


def test_forced_boundaries_cut_words():
    codec = bpe_codec.Codec(WORDS)
    symbols = [codec.inner[b] for b in "日本語".encode()]
    assert any(p not in codec.joined for p in zip(symbols, symbols[1:]))


def test_counts_and_digests_of_edge_documents(spark):
    docs = edge_docs(spark)
    lib_b, lib_w = Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)
    rows = [(r.doc_id, r.text or "") for r in docs.collect()]
    got = sorted(map(tuple, token_counts.count_tokens(docs).collect()), key=str)
    want = [(i, len(t.encode()), n := len(lib_b.encode(t, add_special_tokens=False).ids), n > 1024) for i, t in rows]
    assert got == sorted(want, key=str)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = [(i, len(ids := lib_w.encode(t, add_special_tokens=False).ids), sha(" ".join(map(str, ids))), sha(lib_w.decode(ids, skip_special_tokens=False))) for i, t in rows]
    assert sorted(map(tuple, bpe_codec.digests(docs).collect()), key=str) == sorted(want, key=str)
    full = [(r.doc_id, r.ids, r.decoded) for r in bpe_codec.encode(docs).collect()]
    assert sorted((i, len(ids), sha(" ".join(map(str, ids))), sha(text)) for i, ids, text in full if i is not None) == sorted(w for w in want if w[0] is not None)


@pytest.mark.parametrize("width", [1, 5, 8, 13, 16, 17, 31, 32])
def test_packing_of_bits_round_trips(width):
    ids = np.random.default_rng(width).integers(0, 2**width, 1001, dtype=np.uint64).astype(np.uint32)
    data = token_files.pack(ids, width)
    assert len(data) == -(-1001 * width // 8)
    assert (token_files.unpack(data, width, 1001) == ids).all()


def test_token_file_random_access(tmp_path):
    r = np.random.default_rng(3)
    docs = [(None if k == 2 else k, r.integers(0, 50257, n, dtype=np.uint32)) for k, n in enumerate([5, 0, 100, 1, 64, 300])]
    for width, block in ((16, 64), (17, 7)):
        path = tmp_path / f"{width}.tok"
        path.write_bytes(token_files.to_file(docs, width, block))
        file = token_files.TokenFile(str(path))
        every = np.concatenate([x for _, x in docs])
        assert [(d, s, x.tolist()) for d, s, x in file.documents()] == [(d, sum(len(y) for _, y in docs[:k]), x.tolist()) for k, (d, x) in enumerate(docs)]
        for a, b in ((0, 1), (63, 65), (10, 400), (469, 470), (5, 5)):
            assert file.ids(a, b).tolist() == every[a:b].tolist()


def test_token_files_of_edge_documents(spark, tmp_path):
    docs, lib = edge_docs(spark), Tokenizer.from_file(BYTES)
    token_files.write_token_files(docs, f"file://{tmp_path}/t", block=16, file_tokens=64)
    got = sorted(map(tuple, token_files.read_token_files(spark, f"file://{tmp_path}/t").collect()), key=lambda r: r[1])
    order = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    at, want = 0, []
    for i, t in order:
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert got == want
    assert token_files.token_files(docs.limit(0)).count() == 0


def check_packing(rows, docs, size):
    lib = Tokenizer.from_file(WORDS)
    want = sorted((i, k // size, k, len(p := ids[k : k + size]), zlib.crc32(p.tobytes())) for i, t in docs for ids in [np.array(lib.encode(t or "", add_special_tokens=False).ids + [0], "<u4")] for k in range(0, len(ids), size))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in bins.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= size
    return len(bins)


def test_packing_of_documents(spark):
    docs = edge_docs(spark).where("doc_id is not null")
    rows = packing.pack(docs, size=64).collect()
    total = sum(r.length for r in rows)
    assert check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()], 64) <= -(-total // 64) + 1
    assert packing.pack(docs.limit(0)).count() == 0


def test_best_two_fit_replaces_the_smallest():
    # greedy puts 6 and 3 in a bin of 10; 2 and 2 fit the gap of 4 better than 3
    plan = packing.best_two_fit({6: 1, 3: 1, 2: 2}, 10)
    assert plan[0] == (1, [6, 2, 2])
    r = random.Random(2)
    for _ in range(200):
        counts = {k: r.randint(1, 30) for k in r.sample(range(1, 33), r.randint(1, 10))}
        plan = packing.best_two_fit(counts, 32)
        used = {}
        for bins, items in plan:
            assert bins > 0 and sum(items) <= 32
            for k in items:
                used[k] = used.get(k, 0) + bins
        assert used == counts
