"""Alignment against a plain version over whole texts, byte by byte."""

from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer

from adpulse.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
EMPTY = (0, 0, 0, 0, 0, 0, "")


def plain(texts):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)."""
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    table = {}
    shown = list(range(33, 127)) + list(range(161, 173)) + list(range(174, 256))
    for b in range(256):
        table[chr(b) if b in shown else chr(256 + len([x for x in range(b) if x not in shown]))] = b
    rows = []
    for text in texts:
        if not text:
            rows.append(None)
            continue
        a = tok.encode(" " + text, add_special_tokens=False).ids
        b = sp.encode(text)
        bytes_a = [bytes(table[c] for c in tok.id_to_token(i)) for i in a]
        bytes_b = [bytes([int(sp.id_to_piece(i)[3:-1], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            rows.append(None)
            continue
        # which token holds each byte
        own_a, own_b = ([i for i, t in enumerate(tokens) for _ in t] for tokens in (bytes_a, bytes_b))
        pairs = sorted(set(zip(own_a, own_b)))
        links = [(a[i], b[j]) for i, j in pairs]
        groups, ids_a, ids_b = [], [], []
        for k, (i, j) in enumerate(zip(own_a, own_b)):
            end = k + 1 == len(own_a)
            if end or own_a[k + 1] != i:
                ids_a.append(str(a[i]))
            if end or own_b[k + 1] != j:
                ids_b.append(str(b[j]))
            if end or own_a[k + 1] != i and own_b[k + 1] != j:
                groups.append(",".join(ids_a) + "|" + ",".join(ids_b))
                ids_a, ids_b = [], []
        rows.append((a, b, groups, links))
    count = Counter(p for r in rows if r for p in set(r[3]))
    most: dict = {}
    for (x, _), n in count.items():
        most[x] = max(n, most.get(x, 0))
    return [EMPTY if r is None else (
        len(r[0]), len(r[1]), len(r[2]), len(r[3]), sum(count[p] == most[p[0]] for p in r[3]), sum(count[p] for p in r[3]),
        hashlib.sha256(";".join(r[2]).encode()).hexdigest()) for r in rows]


def shown(r):
    return r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups


SOME = ["Hello  world", " x", "a▁b", "a ▁ b", "ﬁ x <s> <unk> <0x41> <|endoftext|> it's", "a\tb\nc ", "x\0y", "éè 漢字こ \U0001f600 é", "  ", "\r\n",
        "ab" * 300, "it's we'll   12345 !!!   z", "naïve café 　 x", None, "", "Hello  world", "Hello world"]


def test_parts_and_wholes(spark, monkeypatch):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(SOME)], "doc_id long, text string").repartition(3)
    monkeypatch.setattr(align, "FREQUENT", 4)  # nearly all pairs are joined
    rows = {r.doc_id: r for r in align.link_scores(df, A, B).collect()}
    for i, want in enumerate(plain(SOME)):
        assert shown(rows[i]) == want, SOME[i]


def test_documents(docs, rows):
    want = dict(zip([r.doc_id for r in rows], plain([r.text for r in rows])))
    assert {r.doc_id: shown(r) for r in align.link_scores(docs, A, B).collect()} == want


def test_edges(edge, empty):
    rows = align.link_scores(edge, A, B).collect()
    want = Counter((r.doc_id, w) for r, w in zip(edge.collect(), plain([r.text for r in edge.collect()])))
    assert Counter((r.doc_id, shown(r)) for r in rows) == want
    assert align.link_scores(empty, A, B).collect() == []


def test_groups_are_given(spark):
    df = spark.createDataFrame([(1, "Hello world")], "doc_id long, text string")
    row = align.align(df, A, B).first()
    assert row.groups == "18435|22557;995|1526" and row.n_links == 2
    assert align.align_ids([0, 1], [2, 3], [b"ab", b"cd"], [b"", b"", b"a", b"bcd"]) == ("0,1|2,3", [2, 3, 1 << 32 | 3])
