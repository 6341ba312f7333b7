"""Operator 12 against token by token loops over the libraries' own ids."""

import hashlib
from collections import Counter

import public_tokenizers as public
import pytest
import sentencepiece
from tokenizers import Tokenizer

from reviewforge.llm import token_alignment as align
from reviewforge.llm.bpe import byte_chars
from tests.conftest import SF_SMALL
from tests.llm.helpers import edge_docs

MORE = ["  two  spaces ", "tab\tand\nline\n", " a", "ﬁ ligature", "é", "\x00", "<s> x </s> <unk>", "a<|endoftext|>b", "▁ under", "日本 ", "▁", "x" * 50, "…", "ＡＢ", "​zero", "é"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))


def plain(texts, libraries):
    a, b = libraries
    code = {c: i for i, c in enumerate(byte_chars())}
    docs, counts = [], Counter()
    for t in texts:
        if not t:
            docs.append(([], [], []))
            continue
        ids_a, ids_b = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        bytes_a = [bytes(code[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, b.id_to_piece(ids_b))]
        if not (b"".join(bytes_a) == b"".join(bytes_b) == b" " + t.encode()):
            docs.append(([], [], []))
            continue
        spans = []
        for ids, parts in ((ids_a, bytes_a), (ids_b, bytes_b)):
            at, own = 0, []
            for i, p in zip(ids, parts):
                own.append((at, at + len(p), i))
                at += len(p)
            spans.append(own)
        first, linked = 0, []
        for s, e, i in spans[0]:
            while first < len(spans[1]) and spans[1][first][1] <= s:
                first += 1
            k = first
            while k < len(spans[1]) and spans[1][k][0] < e:
                linked.append((i, spans[1][k][2]))
                k += 1
        counts.update(linked)
        docs.append((*spans, linked))
    best = Counter()
    for (_, j), n in counts.items():
        best[j] = max(best[j], n)
    out = []
    for x, y, linked in docs:
        cuts = sorted({e for _, e, _ in x} & {e for _, e, _ in y})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for _, e, i in side if low < e <= cut) for side in (x, y)))
            low = cut
        text = ";".join(groups)
        out.append((len(x), len(y), len(groups), len(linked), sum(counts[p] == best[p[1]] for p in linked), sum(counts[p] for p in linked), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


def answers(docs):
    return sorted(map(tuple, align.align(docs).collect()), key=str)


def test_documents_equal_the_plain_version(spark, libraries, monkeypatch):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = sorted(((i, *w) for (i, _), w in zip(rows, plain([t for _, t in rows], libraries))), key=str)
    assert answers(docs) == want
    assert answers(docs.repartition(7)) == want  # more bundles


def test_edges(spark, libraries):
    more = spark.createDataFrame([(100 + i, t, None, None, None, None, None, None) for i, t in enumerate(MORE)], edge_docs(spark).schema)
    docs = edge_docs(spark).unionByName(more).unionByName(more.limit(2))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert answers(docs) == sorted(((i, *w) for (i, _), w in zip(rows, plain([t for _, t in rows], libraries))), key=str)
    assert answers(docs.where("false")) == []
    assert answers(docs.where("text is null or text = ''")) == [(0, *[0] * 6, ""), (1, *[0] * 6, "")]


def test_many_slices_and_one_long_text(spark, libraries, monkeypatch):
    texts = ["word ing, the 123 " * 400, "", None, "short", "ab " * 3000, "x"]
    monkeypatch.setattr(align, "SLICE", 1000)
    got = align.align_texts(texts, public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model"))
    want = plain(texts, libraries)
    for c, k in (("n_a", 0), ("n_b", 1), ("n_groups", 2), ("n_links", 3), ("groups_sha256", 6)):
        assert got[c].to_pylist() == [w[k] for w in want]
    assert [s[:2] for s in align._slices(texts)] == [(0, 1), (1, 5), (5, 6)]


def test_ends_are_merged_without_a_join(libraries, monkeypatch):
    monkeypatch.setattr(align.pa, "table", None)
    texts = ["one two", None, "naïve café", "", "one two"]
    found = align.align_texts(texts, public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model"))
    assert found["n_a"].to_pylist() == [len(libraries[0].encode(" " + x, add_special_tokens=False).ids) if x else 0 for x in texts]
    assert found["n_links"].to_pylist()[1::2] == [0, 0] and len(found["pairs"][0]) == found["n_links"][0].as_py() > 0
    assert found["pairs"][0] == found["pairs"][4]
