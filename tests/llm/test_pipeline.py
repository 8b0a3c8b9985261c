"""The pipeline against a plain version of its stages, and its stages on odd tables."""

import hashlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.brute import near_classes
from wardflow.llm import compression, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    model = queries.quality_model(docs, labels)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    score = lambda t: compression.probability(model.weights, compression.inputs(*compression.features((t or "").encode(), model.good, model.bad)))
    rows = [r for r in rows if score(r[1]) >= queries.GOOD]
    best = {}
    for doc_id, text, source in rows:
        key = (text or "").translate(LOWER)
        best[key] = max(best.get(key, (-1,)), (doc_id, text, source))
    rows = sorted(best.values())
    kept = set(near_classes([r[:2] for r in rows]).values())
    rows = [r for r in rows if r[0] in kept]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    taken = con.execute(f"SELECT doc_id, taken // size FROM ({queries.ORACLES['op10_mix_wfq']}) WHERE taken > 0").fetchall()
    library, text = Tokenizer.from_file(f"{queries.TOKENIZERS}/byte_bpe_50k.json"), {r[0]: r[1] or "" for r in rows}
    out = []
    for doc_id, times in taken:
        ids = library.encode(text[doc_id], add_special_tokens=False).ids
        out += [(doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())] * int(times)
    return sorted(out)


def test_same_as_plain_version(spark, sf_dir):
    found = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, found.select("doc_id", "n_tokens", "ids_sha256").collect())) == plain(spark, sf_dir)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None), (1, None, None, None), (None, "", "en", "a"), (2, "a b c", None, None), (2, "a b c", None, None), (3, "x y " * 50000, "en", "a")]])
def test_stages_on_odd_tables(spark, table, sf_dir, rows):
    docs = table(rows, clash=True)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, sf_dir)
        assert made.columns == docs.columns
        docs = made if made.count() else docs
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
