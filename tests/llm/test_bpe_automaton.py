"""The tokenisation automaton against the tokenizers library, and round trips."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from wardflow.llm import bpe_automaton, queries

PATH = f"{queries.TOKENIZERS}/byte_bpe_50k.json"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def same(library, automaton, text):
    ids = np.frombuffer(automaton.encode(text), "<u4").tolist()
    return ids == library.encode(text, add_special_tokens=False).ids and automaton.decode(automaton.encode(text)) == library.decode(ids, skip_special_tokens=False)


def texts():
    rng = random.Random(3)
    yield from ["", " ", "\n\n ", "fff ffff fffff", "I'll we've 'S", "<|endoftext|>", "a<|endoftext|> b<|endoftext|", "\x00\x1f\x85 ", "՘࢏"]
    for k in range(1500):
        letters = "abcdefghi thes'tre 12\n\t.,!?éüß ñ日本語😀‍กก" if k % 2 else "theanisorfe "
        yield "".join(rng.choice(letters) for _ in range(rng.randint(0, 80)))
    for _ in range(300):
        yield "".join(chr(rng.choice([rng.randrange(32, 0xD800), rng.randrange(0xE000, 0x20000)])) for _ in range(20))


def test_same_as_library(library):
    automaton = bpe_automaton.compiled(PATH)
    assert [t for t in texts() if not same(library, automaton, t)] == []


def test_small_tables_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe_automaton, "KEPT_STATES", 40)
    monkeypatch.setattr(bpe_automaton, "KEPT_WORDS", 10)
    automaton = bpe_automaton.compiled.__wrapped__(PATH)
    assert all(same(library, automaton, t) for k, t in enumerate(texts()) if k % 4 == 0)
    assert same(library, automaton, "abcde" * 4000)


def test_token_automaton_accepts_only_what_merges_make(library):
    automaton = bpe_automaton.compiled(PATH)
    for word in (" internationalization", "tokenization", " aaaaaaa"):
        ids = library.encode(word).ids
        assert all(automaton.allows(a, b) for a, b in zip(ids, ids[1:]))
    a, b = (library.token_to_id(x) for x in ("h", "e"))
    assert not automaton.allows(a, b)


def test_query(spark, sf_dir, library):
    found = {r["doc_id"]: r for r in queries.op6_bpe_automaton(spark, sf_dir).collect()}
    for doc_id, text in queries.documents(spark, sf_dir).select("doc_id", "text").collect():
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert found[doc_id]["n_tokens"] == len(ids)
        assert found[doc_id]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert found[doc_id]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_edges(table):
    found = bpe_automaton.encoded(table([(None, None), (1, ""), (2, "a b"), (2, "a b"), (3, "x" * 300000)], clash=True), PATH).collect()
    assert sorted(r["decoded"] for r in found) == ["", "", "a b", "a b", "x" * 300000]
    assert bpe_automaton.encoded(table([]), PATH).count() == bpe_automaton.token_digest(table([]), PATH).count() == 0
