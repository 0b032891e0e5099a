import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import types as T

from radiospark.llm import bpe
from radiospark.llm.queries import op10_bpe

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.load_ranks(PATH)
ORACLE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})

HARD = [
    "", " ", "\n\n  a", "Hello's world", "ÄÖü ß 東京 🙂🙂", "x" * 5000, "\x1c\x1d\x85᠎  z", "a b　c",
    "<|endoftext|> 12345 !!!???", "été" * 900, " \t \r\n x  ", "I'LL we'll 'S",
]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(RANKS)


def test_matches_the_library(vocabulary):
    rng = random.Random(5)
    mixed = ["".join(rng.choice("ab éß \n'sXY1!日🙂thein") for _ in range(rng.randrange(300))) for _ in range(300)]
    encoder = bpe.Encoder(vocabulary, public_tokenizers.PATTERN)
    texts = HARD + mixed
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == ORACLE.encode_ordinary(text), text[:50]
        assert vocabulary.decode(ids.tolist()) == text.encode()


def test_long_pieces_agree_with_the_matrix(vocabulary):
    rng = random.Random(6)
    for _ in range(50):
        piece = "".join(rng.choice("théinßon") for _ in range(rng.randrange(2, 200))).encode()
        assert vocabulary.merge_long(piece) == ORACLE._encode_single_piece(piece)


def test_nulls_clashes_and_repeats(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("n_tokens", T.StringType())])
    rows = [(1, None, "a"), (None, "the end", None), (2, "the end", "b"), (2, "the end", "b"), (3, "", None)]
    got = bpe.round_trip(spark.createDataFrame(rows, schema), PATH, public_tokenizers.PATTERN)
    assert got.columns == ["doc_id", "text", "in_n_tokens", "n_tokens", "ids_sha256", "decoded_sha256"]
    empty = hashlib.sha256(b"").hexdigest()
    by = sorted((r["text"] or "", r["n_tokens"], r["ids_sha256"]) for r in got.collect())
    assert by[0] == by[1] == ("", 0, empty) and by[2] == by[3] == by[4]
    assert bpe.round_trip(spark.createDataFrame([], schema), PATH, public_tokenizers.PATTERN).count() == 0
    ids = bpe.encode(spark.createDataFrame(rows, schema), PATH, public_tokenizers.PATTERN)
    back = bpe.decode(ids, PATH).collect()
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in back)


def test_whole_table(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op10_bpe(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = ORACLE.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
