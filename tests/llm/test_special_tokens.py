"""Special tokens in texts: the queries of token ids against the library as it is."""

from __future__ import annotations

import collections
import random
import zlib

import numpy as np
from tokenizers import Tokenizer

from parley.llm import queries, tokens

ODD = [None, "", "<|endoftext|>", "a <|endoftext|> b<|startoftext|>", "<|endoftext|><|endoftext|> ", "<|ENDOFTEXT|>", "<|endoftext", "e<|endoftext|>\u0301 \n <|startoftext|> 's", "<<|endoftext|>>  x", "plain words's end"]


def rows():
    r = random.Random(4)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|", "|>", " ", "\n", "It's", "caf\u00e9", "12"]
    return [(7 * i - 50, t) for i, t in enumerate(ODD + ["".join(r.choice(parts) for _ in range(r.randrange(40))) for _ in range(150)])]


def ids_of(name, end):
    t = Tokenizer.from_file(tokens.vocabulary(name))
    return lambda x: np.array([*t.encode(x or "", add_special_tokens=False).ids, end], "<u4")


def test_special_tokens_in_files_and_sequences(spark, tmp_path):
    docs = rows()
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    ids, want, at = ids_of("word_bpe_49k.json", 2), [], 0
    for d, t in docs:  # in order of doc_id
        x = ids(t)
        want.append((d, at, len(x), zlib.crc32(x.tobytes())))
        at += len(x)
    got = queries.op4_repair_files(spark, str(tmp_path)).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want
    ids = ids_of("byte_bpe_50k.json", 0)
    got = queries.op5_pattern_packing(spark, str(tmp_path)).select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert collections.Counter(map(tuple, got)) == collections.Counter((d, 0, 0, len(ids(t)), zlib.crc32(ids(t).tobytes())) for d, t in docs)
