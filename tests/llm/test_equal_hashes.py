"""Texts that a polynomial hash modulo 2**64 cannot tell apart: Thue-Morse
strings and their complements. No operator may take them as equal."""

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keelson.llm import byte_bpe, lines, quality, samples, vectors


def thue_morse(n, one="a", two="b"):
    return "".join(one if bin(i).count("1") % 2 == 0 else two for i in range(n))


@pytest.fixture(params=[1024, 4096])
def pair(request):
    return thue_morse(request.param), thue_morse(request.param, "b", "a")


def test_the_pair_collides(pair):
    column = pa.array([" ".join(pair)])
    assert len(set(vectors.Texts(column).words().tolist())) == 1


@pytest.mark.parametrize("constant", [False, True])
def test_quality_counts(pair, constant, monkeypatch):
    if constant:
        monkeypatch.setattr(vectors.Texts, "words", lambda t: t.start.astype("u8") * 0 + 1)
    model = quality.train([])
    text = "\n".join(pair) + "\n" + " ".join(["x y z v " + pair[0], "x y z v " + pair[1]])
    got = quality.measure(pa.array([text, text + "\n" + pair[0]]), model)
    assert got["n_dup_lines"].tolist() == [0, 1]
    assert got["n_repeat_words"].tolist() == [0, 0]


def test_line_dedup_keeps_different_lines(spark, pair):
    docs = spark.createDataFrame(
        [(1, pair[0]), (2, pair[1]), (3, pair[0])], "doc_id long, text string")
    got = lines.remove(docs, bounds=lines.BOUNDS).orderBy("doc_id").collect()
    assert [r.text for r in got] == [pair[0], pair[1], ""]


def test_byte_bpe_of_equal_hashes(pair):
    facts = byte_bpe.BpeFile(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = byte_bpe.Encoder(facts)
    text = f"{pair[0]} {pair[1]} {pair[0]}"
    assert encoder.encode_many([text, pair[1]]) == [encoder._ids(text), encoder._ids(pair[1])]


def test_one_long_text_does_not_empty_the_sample(spark):
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.when(
        F.col("id") < 4, F.repeat(F.lit("long "), 1000)).otherwise(F.lit("short")).alias("text"))
    labels = spark.range(40).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic"))
    rows = samples.labelled_sample(docs, labels, "toxic", most_bytes=4000, longest=100)
    assert len(rows) == 36 and {r.label for r in rows} == {0, 1}
    with pytest.raises(Exception, match="sample holds the labels"):
        samples.fitted(samples.sample_frame(docs, labels.where("toxic = 0 or doc_id < 4"), "toxic",
                                            longest=100), len)
    assert samples.fitted(samples.sample_frame(docs, labels, "toxic"), len) == 40
