"""Alignment of two tokenizers against a brute force over single bytes, and its edge cases."""

import hashlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.conftest import rows
from wardflow.llm import queries, token_alignment

A, B = queries.TOKENIZERS + "/byte_bpe_50k.json", queries.TOKENIZERS + "/piece_bpe_32k.model"
COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
CASES = [
    (1, None), (2, ""), (3, " "), (4, "The cat sat on the mat."), (5, "The cat sat on the mat."), (5, "The cat"), (None, "naïve  Straße\n\n\t日本語 👩‍👩‍👧 x"),
    (6, "<|endoftext|> <s> </s> <0x41> ▁"), (7, "a▁b"), (8, "ab" * 30000), (9, "word " * 20000), (10, "  lead and trail  "), (11, "́e ﬁ ① \x00 \x85"),
]


def byte_labels():
    """Bytes of every id, read from the libraries: A's by its decoder alphabet, B's piece by piece."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    letters |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    library = Tokenizer.from_file(A)
    a = {i: bytes(letters[c] for c in t) for t, i in library.get_vocab(with_added_tokens=False).items() if t != "<|endoftext|>"}
    model = sentencepiece.SentencePieceProcessor(model_file=B)
    b = {}
    for i in range(model.get_piece_size()):
        p = model.id_to_piece(i)
        b[i] = bytes([int(p[3:-1], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode()
    library.encode_special_tokens = True
    return library, model, a, b


@pytest.fixture(scope="module")
def brute():
    library, model, a_label, b_label = byte_labels()

    def run(texts):
        docs, corpus = [], Counter()
        for key, text in texts:
            raw = (" " + (text or "")).encode()
            a = library.encode(" " + text, add_special_tokens=False).ids if text else []
            b = model.encode(text) if text else []
            if b"".join(a_label[i] for i in a) != raw or b"".join(b_label[i] for i in b) != raw:
                a = b = []
            spans = [[], []]
            for side, ids, label in ((0, a, a_label), (1, b, b_label)):
                at = 0
                for i in ids:
                    spans[side].append((at, at + len(label[i]), i))
                    at += len(label[i])
            owner = [-1] * (len(raw) if a else 0)
            for k, (s, e, _) in enumerate(spans[1]):
                owner[s:e] = [k] * (e - s)
            links = [(i, spans[1][k][2]) for s, e, i in spans[0] for k in sorted(set(owner[s:e]))]
            ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
            groups, sides = [], []
            for side in (0, 1):
                where = np.searchsorted(ends, [e for _, e, _ in spans[side]])
                made = [[] for _ in ends]
                for k, (_, _, i) in zip(where, spans[side]):
                    made[k].append(str(i))
                sides.append(made)
            groups = ";".join(f"{','.join(x)}|{','.join(y)}" for x, y in zip(*sides))
            corpus.update(links)
            docs.append((key, len(a), len(b), len(ends), links, hashlib.sha256(groups.encode()).hexdigest() if a else ""))
        top = Counter()
        for (_, b), n in corpus.items():
            top[b] = max(top[b], n)
        return sorted(
            ((k, na, nb, ng, len(li), sum(corpus[p] == top[p[1]] for p in li), sum(corpus[p] for p in li), d) for k, na, nb, ng, li, d in docs), key=repr
        )

    return run


@pytest.mark.parametrize("share", [token_alignment.SHARE, 50, 0])
def test_cases_however_many_pairs_are_frequent(table, brute, share):
    found = token_alignment.alignment(table(CASES, clash=True), A, B, share=share)
    assert rows(found, *COLUMNS) == brute(CASES)


def test_query(spark, sf_dir, brute):
    texts = [(r["doc_id"], r["text"]) for r in queries.documents(spark, sf_dir).select("doc_id", "text").collect()]
    found = queries.op12_token_alignment(spark, sf_dir)
    assert rows(found, *COLUMNS) == brute(texts)


def test_forgetting_changes_nothing(spark, sf_dir, brute):
    both = token_alignment.sides(A, B)
    texts = [r["text"] for r in queries.documents(spark, sf_dir).select("text").limit(60).collect()]
    made = [[token_alignment.Aligner(both, kept).document(*ids)[:3] for ids in both.encode(texts)] for kept in (10**6, 0)]
    assert made[0] == made[1]


def test_windows_are_looked_up_while_that_answers_documents(spark, sf_dir):
    both = token_alignment.sides(A, B)
    texts = [r["text"] for r in queries.documents(spark, sf_dir).select("text").limit(60).collect()]
    ids = [pair for pair in both.encode(texts) if len(pair[0])]
    lookup, arrays = (token_alignment.Aligner(both, tried=n) for n in (10**6, 8))
    made = [[[x.tolist() if isinstance(x, np.ndarray) else x for x in w.document(*pair)] for pair in ids] for w in (lookup, arrays)]
    assert made[0] == made[1]
    assert lookup._known and not arrays._known
    same = token_alignment.Aligner(both, tried=8)
    assert len({same.document(*ids[0])[2] for _ in range(40)}) == 1 and same._known


def test_every_document_is_cut_into_windows():
    both, cut = token_alignment.sides(A, B), []

    class Watched(token_alignment.Aligner):
        def _looked_up(self, *of):
            cut.append(len(of[2]) - 1)
            return super()._looked_up(*of)

    texts = [f"one two w{k}x{k * k} unlike{k} all  others\n{k}" for k in range(300)]
    watched, alone = Watched(both), []
    for a, b in both.encode(texts):
        got, own = watched.document(a, b), token_alignment.Aligner(both).document(a, b)
        assert got[:3] == own[:3] and all(x.tolist() == y.tolist() for x, y in zip(got[3:], own[3:]))
        alone.append(own[1])
    assert len(cut) == len(texts) and min(cut) > 2 and min(alone) > 2


def test_windows_end_at_shared_ends(spark):
    both = token_alignment.sides(A, B)
    ((a, b),) = both.encode(["one two  three\nfour"])
    ends = np.cumsum(both.a_sizes[a]), np.cumsum(both.b_sizes[b])
    cuts_a, cuts_b, _, _ = token_alignment.Aligner(both).anchors(np.array(a), *ends)
    assert len(cuts_a) == len(cuts_b) > 2
    for i, j in zip(cuts_a, cuts_b):
        assert b"".join(both.a_bytes[k] for k in a[:i]) == b"".join(both.b_bytes[k] for k in b[:j])


def test_packing():
    pairs, times = np.array([3, 5, 7 << 40]), np.array([1, 2, 10**12])
    back = token_alignment.unpacked(token_alignment.packed(pairs, times))
    assert back[0].tolist() == pairs.tolist() and back[1].tolist() == times.tolist()
    assert [len(x) for x in token_alignment.unpacked(token_alignment.packed(pairs[:0], times[:0]))] == [0, 0]


def test_empty(table):
    assert token_alignment.alignment(table([]), A, B).collect() == []
