"""Operator 8 against the tokeniser as it is loaded, added tokens included."""

import random

import corpus_pipeline
import pytest
from tokenizers import Tokenizer
from vulnlake.llm import packing, queries

from tests.llm import brute
from tests.llm.test_packing import PATH, whole

END = "<|endoftext|>"


@pytest.fixture(scope="module")
def loaded():
    return Tokenizer.from_file(PATH)


def mixed():
    rng = random.Random(1)
    parts = ["ab", "it's", "x", "über", " ", "  ", "\n", "<|", "|>", "<|endoftext", END, END]
    return ["", END, END * 3, f"a{END}b", f" {END} ", f"<|endof{END}text|>", *("".join(rng.choice(parts) for _ in range(rng.randrange(60))) for _ in range(500))]


def test_ids_of_added_tokens(loaded):
    texts = mixed() + ["w " * 300000 + END + "'s " * 300000]
    got = [x.tolist() for x in packing.token_ids([t.encode() for t in texts], PATH, 2, added=True)]
    assert got == [[*loaded.encode(t, add_special_tokens=False).ids, 2] for t in texts]
    assert got[3] == [64, 50256, 65, 2]


def test_query_and_stage_use_them(spark, loaded, tmp_path):
    data = brute.rows([*mixed(), None, f"{END} word" * 700])
    spark.createDataFrame(data, brute.DOCS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    whole(queries.QUERIES["op8_residual_packing"](spark, str(tmp_path)).collect(), [r[:2] for r in data], loaded, 1024)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    whole(corpus_pipeline.pack_sequences(spark, docs, str(tmp_path)).collect(), [r[:2] for r in data], loaded, 1024)
