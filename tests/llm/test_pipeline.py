"""The pipeline against brute-force versions of its stages."""

import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from test_llm_operators import TERM, ascii_lower, brute_components
from tokenizers import Tokenizer


def test_stages(spark, data, tmp_path):
    docs = first = spark.read.parquet(f"{data}/documents.parquet")
    frames = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, data).write.parquet(f"{tmp_path}/{number}")
        docs = spark.read.parquet(f"{tmp_path}/{number}")
        frames.append(docs)
    assert all(frame.columns == first.columns for frame in frames[:4])
    texts = [{row["doc_id"]: row["text"] for row in frame.collect()} for frame in [first, *frames[:4]]]
    assert set(texts[1]) == {i for i, text in texts[0].items() if any(map(str.isalpha, text or ""))}
    groups = brute_components(texts[1].items())
    assert set(texts[2]) == {i for i, (_, component) in groups.items() if i == component}
    windows = set()
    for row in spark.read.parquet(f"{data}/benchmark.parquet").collect():
        words = TERM.findall(ascii_lower(row["text"]))
        windows |= {tuple(words[i:i + 10]) for i in range(max(1, len(words) - 9)) if words}

    def dirty(text):
        words = TERM.findall(ascii_lower(text))
        return any(tuple(words[i:i + 10]) in windows for i in range(len(words)))
    assert set(texts[3]) == {i for i, text in texts[2].items() if not dirty(text)}
    assert set(texts[4]) <= set(texts[3]) and frames[3].groupBy("doc_id").count().agg(F.max("count")).first()[0] <= 3
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    start, want = 0, []
    for doc_id, text in sorted((row["doc_id"], row["text"] or "") for row in frames[3].collect()):
        ids = np.array(tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(tuple(row) for row in frames[4].collect()) == want
    again = corpus_pipeline.run(spark, data)
    assert sorted(tuple(row) for row in again.collect()) == want
