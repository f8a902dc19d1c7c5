"""Chunked SentencePiece coding and token alignment against the libraries on whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers as P
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from millrace.llm import alignment, pieces
from millrace.llm.queries import op12_piece_round_trip, op13_token_alignment

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
TEXTS = ["", " ", "  ", "a", "a ", " a", "a  ", "a   b  c", "\ta\n b \n  c\n\n", "a▁b", "▁", "a▁ b", " ▁a", "a\0b", "<s> </s><unk> <0x0A> <|endoftext|>", "﻿a　b c d\x85e\x1cf g", "é́ 中文 \U0001f600\U0001f468‍\U0001f469 ﬁ", "x" * 3000, "ab " * 40_000, " " * 300, "'s don't 1234  56.7%% \r\n end", "é" * 50, "\x1c a", "word\nword\n\nword  \n  word"]


def mixed(r):
    return ["".join(r.choice([" ", " ", "\n", "\t", "a", "the", "tion", "é", "12", "'s", "!", "▁", "　", "\x1f", "<s>", "\U0001f600"]) for _ in range(r.choice([3, 12, 60]))) for _ in range(150)]


@pytest.fixture(scope="module")
def rows(spark, sf):
    texts = [*TEXTS, None, "a  ", *mixed(random.Random(4)), *(r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect())]
    return [*enumerate(texts), (None, "no id"), (3, "again")]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_round_trip_equals_the_library(spark, rows):
    sp = SentencePieceProcessor(model_file=B)
    df = spark.createDataFrame([(*x, 1) for x in rows], "doc_id long, text string, ids int")
    want = [(d, len(i := sp.encode(t or "", add_eos=True)), sha(" ".join(map(str, i))), sha(sp.decode(i))) for d, t in rows]
    assert [tuple(r) for r in pieces.piece_round_trip(df.coalesce(1), B).collect()] == want
    coded = pieces.piece_encode(df.coalesce(1), B)
    assert [r.ids for r in coded.collect()] == [sp.encode(t or "", add_eos=True) for _, t in rows]
    assert [r.text for r in pieces.piece_decode(coded, B).collect()] == [sp.decode(sp.encode(t or "")) for _, t in rows]
    assert pieces.piece_round_trip(df.limit(0), B).count() == 0


def test_round_trip_query_on_all_documents(spark, sf):
    sp = SentencePieceProcessor(model_file=B)
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = {(r.doc_id, len(i := sp.encode(r.text or "", add_eos=True)), sha(" ".join(map(str, i))), sha(sp.decode(i))) for r in docs}
    assert {tuple(r) for r in op12_piece_round_trip(spark, sf).collect()} == want


def test_a_forgotten_table_changes_nothing(monkeypatch):
    small, known = pieces.Model(B), pieces.Model(B)
    monkeypatch.setattr(pieces, "REMEMBERED", 100)
    for t in mixed(random.Random(9)):
        assert list(small.both([t])) == list(known.both([t])) and small.encode(t) == known.library.encode(t)


def test_pieces_that_cross_marks_are_seen():
    """A model whose pieces may hold a mark behind another character isn't cut."""
    whole = pieces.Model(B)
    assert whole.splits
    whole.splits = False
    for t in TEXTS:
        assert whole.chunks(t) == ([t] if t else []) and whole.encode(t) == whole.library.encode(t)


def slow_alignment(rows):
    """Whole texts by both libraries, links by comparing intervals."""
    a, sp = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [c for c in range(256) if c not in own]
    byte = {chr(c): c for c in own} | {chr(256 + k): c for k, c in enumerate(rest)}

    def intervals(ids, label):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(label(i)), i))
            at += len(label(i))
        return out, b"".join(map(label, ids))

    def b_label(i):
        return bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode()

    every, counts = [], Counter()
    for d, t in rows:
        x, x_bytes = intervals(a.encode(" " + (t or ""), add_special_tokens=False).ids, lambda i: bytes(map(byte.__getitem__, a.id_to_token(i))))
        y, y_bytes = intervals(sp.encode(t or ""), b_label)
        if not t or {x_bytes, y_bytes} != {(" " + t).encode()}:
            every.append((d, [], [], [], []))
            continue
        links, low = [], 0
        for s, e, i in x:
            while y[low][1] <= s:
                low += 1
            k = low
            while k < len(y) and y[k][0] < e:
                links.append((i, y[k][2]))
                k += 1
        ends = sorted({e for _, e, _ in x} & {e for _, e, _ in y})
        place = {e: k for k, e in enumerate(ends)}
        groups = [([], []) for _ in ends]
        for side, tokens in ((0, x), (1, y)):
            g = 0
            for _, e, i in tokens:
                groups[g][side].append(i)
                g += e in place
        every.append((d, x, y, links, groups))
        counts.update(set(links))
    most = defaultdict(int)
    for (i, _), n in counts.items():
        most[i] = max(most[i], n)
    for d, x, y, links, groups in every:
        code = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)
        yield d, len(x), len(y), len(groups), len(links), sum(counts[k] == most[k[0]] for k in links), sum(counts[k] for k in links), sha(code) if x else ""


@pytest.mark.parametrize("share", [2_000_000, 300, 1])
def test_alignment_equals_brute_force(spark, rows, share):
    """With all pairs broadcast, with some and with none."""
    df = spark.createDataFrame([(*x, 1, 2) for x in rows], "doc_id long, text string, pair int, row int").repartition(3)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted((tuple(r) for r in alignment.aligned(df, A, B, share=share).collect()), key=key) == sorted(slow_alignment(rows), key=key)
    assert alignment.aligned(df.limit(0), A, B).count() == 0


def test_alignment_query_on_all_documents(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, op13_token_alignment(spark, sf).collect())) == sorted(slow_alignment(docs))


def test_groups_of_a_text(spark):
    df = spark.createDataFrame([(1, "tokenization of é"), (2, None), (3, "a▁")], "doc_id long, text string")
    found = {r.doc_id: r.groups for r in alignment.token_groups(df, A, B).collect()}
    assert found[2] == found[3] == []
    a, sp = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    assert [i for g in found[1] for i in g.a] == a.encode(" tokenization of é", add_special_tokens=False).ids
    assert [i for g in found[1] for i in g.b] == sp.encode("tokenization of é")


def test_texts_are_encoded_once(spark, monkeypatch):
    """The passes over the linked pairs don't see the texts."""
    seen, ran = spark.sparkContext.accumulator(0), alignment.link_batches

    def counting(batches, a_path, b_path):
        for batch in ran(batches, a_path, b_path):
            seen.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(alignment, "link_batches", counting)
    df = spark.createDataFrame([(k, f"token number {k} of é") for k in range(20)], "doc_id long, text string")
    assert alignment.aligned(df, A, B, share=5).count() == 20 and seen.value == 20
