"""Chat formatting against SQL, round trips and edge cases."""

import hashlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.oracle import connect, difference
from wardflow.llm import chat_format, queries

KINDS = T.StructType([T.StructField(n, k) for n, k in (("conv_id", T.LongType()), ("turn", T.LongType()), ("role", T.StringType()), ("text", T.StringType()))])
NASTY = ["\\### Assistant: </turn> ok", "### user: x </turn>\n### assistant: y", "\\\\#<:\\", " </turn>\n", "", "é\n\n😀", "a: b\\", "#" * 3000]


@pytest.fixture
def turns(spark):
    return lambda found: spark.createDataFrame(found, KINDS)


def test_oracle(spark, sf_dir):
    assert difference(connect(sf_dir), queries.op9_chat_prefix_target(spark, sf_dir), queries.ORACLES["op9_chat_prefix_target"]) is None


def test_round_trip(turns):
    said = [(1, k, role, text) for k, (role, text) in enumerate((r, t) for t in NASTY for r in ("user", "assistant", "sys: \\#<"))]
    made = chat_format.examples(turns(said))
    last = made.orderBy(F.desc("example")).first()
    back = made.filter(F.col("example") == last["example"]).select(chat_format.read_back(F.col("formatted")).alias("t")).first()["t"]
    assert [(t["role"], t["text"]) for t in back] == [(r, t) for _, _, r, t in said]
    found = chat_format.digest(made).first()
    assert found["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in said).encode()).hexdigest()
    assert found["loss_sha256"] == hashlib.sha256("".join(NASTY).encode()).hexdigest()


def test_one_example_per_assistant_turn(turns):
    made = chat_format.examples(turns([(1, 2, "assistant", "b"), (1, 1, "user", "a"), (1, 3, "user", "c"), (1, 4, "assistant", None)])).orderBy("example").collect()
    assert [(r["n_turns"], r["formatted"]) for r in made] == [
        (2, "### user: a </turn>\n### assistant: b </turn>\n"),
        (4, "### user: a </turn>\n### assistant: b </turn>\n### user: c </turn>\n### assistant:  </turn>\n"),
    ]
    first = made[0]["loss"]
    assert made[0]["formatted"][first["start"] : first["start"] + first["length"]] == "b" and made[1]["loss"]["length"] == 0


def test_edges(turns):
    found = chat_format.digest(chat_format.examples(turns([(None, None, None, None), (2, 1, "user", "x"), (2, 1, "user", "x"), (3, None, "assistant", "y")])))
    got = {r["conv_id"]: (r["n_turns"], r["loss_chars"]) for r in found.collect()}
    assert got == {None: (1, 0), 2: (2, 0), 3: (1, 1)}
    assert chat_format.digest(chat_format.examples(turns([]))).count() == 0
