"""Language identification against plain substring search, and held-out accuracy."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import language

SCHEMA = "doc_id long, text string, lang string, score string, held_out int"


def plain_phrases(text: bytes, sample: bytes) -> tuple[int, int]:
    """Phrases that the sample holds, and symbols that it lacks."""
    phrases = missing = 0
    for window in (text[i : i + language.WINDOW] for i in range(0, len(text), language.WINDOW)):
        at = 0
        while at < len(window):
            if window[at : at + 1] not in sample:
                missing += 1
                at += 1
                continue
            length = 1
            while at + length < len(window) and window[at : at + length + 1] in sample:
                length += 1
            at += length
            phrases += 1
    return phrases, missing


def plain_judge(text: bytes, samples):
    costs = []
    for _, sample in samples:
        phrases, missing = plain_phrases(text, sample)
        bits = phrases * (1 + math.log2(max(2, len(sample)))) + missing * (1 + language.LITERAL_BITS)
        costs.append(bits / len(text))
    best = min(range(len(samples)), key=costs.__getitem__)
    lead = 1 - sorted(costs)[0] / sorted(costs)[1] if len(costs) > 1 else 1.0
    return samples[best][0], lead


def test_automaton_spells_the_substrings_and_nothing_else():
    rng = random.Random(4)
    for _ in range(20):
        text = bytes(rng.choices(b"abc ", k=rng.randint(1, 40)))
        edges = language.suffix_automaton(text)
        assert len(edges) <= 2 * len(text) + 1

        def spells(word):
            state = 0
            for symbol in word:
                state = edges[state].get(symbol)
                if state is None:
                    return False
            return True

        for _ in range(60):
            word = bytes(rng.choices(b"abc ", k=rng.randint(1, 8)))
            assert spells(word) == (word in text)
        assert all(spells(text[i:j]) for i in range(len(text)) for j in range(i, len(text) + 1))


@pytest.mark.parametrize("seed", range(4))
def test_costs_equal_plain_parsing(seed, monkeypatch):
    monkeypatch.setattr(language, "WINDOW", [5, 64, 512, 1][seed])
    rng = random.Random(seed)
    samples = [
        (name, bytes(rng.choices(letters, k=rng.randint(1, 300))))
        for name, letters in [("aa", b"abcde "), ("bb", b"cdefg "), ("cc", b"xyz\xc3\xa9")]
    ]
    texts = [bytes(rng.choices(b"abcdefgxyz \xc3\xa9q", k=rng.choice([1, 2, 30, 700]))) for _ in range(30)]
    parser = language.Parser(samples)
    expected = np.array([[plain_phrases(t, s) for _, s in samples] for t in texts])
    assert (np.stack(parser.phrases(texts), axis=2) == expected).all()
    for (name, lead), text in zip(parser.judge(texts), texts, strict=True):
        want, want_lead = plain_judge(text, samples)
        assert name == want and abs(lead - want_lead) < 1e-12


def test_query_equals_plain_parsing_of_its_sample(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    rows = docs.select("doc_id", "text", "lang").collect()
    labelled = docs.where(~language.held_out(F.col("doc_id"))).select(
        F.col("lang").alias("lang__"), F.col("text").alias("text__")
    )
    samples = language.learn(labelled)
    found = {r["doc_id"]: r for r in language.predict(docs).collect()}
    assert len(found) == len(rows)
    for row in rows[:25]:
        want, lead = plain_judge(language.symbols(row["text"]), samples)
        got = found[row["doc_id"]]
        assert got["lang_pred"] == want and abs(got["score"] - lead) < 1e-12
        assert got["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.predict(docs).join(docs.select("doc_id", "lang"), "doc_id")
    right = found.where("held_out").select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")))
    assert right.first()[0] > 0.98


def test_held_out_labels_are_not_read(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    twisted = docs.withColumn(
        "lang", F.when(language.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang"))
    ).withColumn("source", F.lit("other"))
    assert sorted(language.predict(docs).collect()) == sorted(language.predict(twisted).collect())


def test_nulls_empty_long_repeated_and_clashing(spark):
    english, greek = "the cat and the dog of the house ", "η γάτα και ο σκύλος του σπιτιού "
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 != 2][:12]
    rows = [(i, english * 5 if n % 2 else greek * 5, "en" if n % 2 else "el", "x", 1) for n, i in enumerate(ids)]
    rows += [
        (100, None, "en", "x", 1), (101, "", None, "x", 1), (102, "12 34 ... ٣", "en", None, 1),
        (None, "ΤΗΕ ΓΆΤΑ", None, "x", None), (103, english * 40000, None, "x", 1),
        (104, "DOG", "en", "x", 1), (104, "DOG", "en", "x", 1), (105, "中文", "", "x", 1),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    result = language.predict(df)
    assert result.columns == ["doc_id", "held_out", "lang_pred", "score"]
    found = {}
    for r in result.collect():
        found.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
        assert 0 <= r["score"] <= 1
    assert found[100] == found[101] == found[102] == [("und", 0.0)]
    assert [found[i][0][0] for i in (None, 103)] == ["el", "en"]
    assert len(found[104]) == 2 and found[104][0] == found[104][1]
    assert found[104][0][0] == "en"


def test_nothing_learned_and_one_language(spark):
    none = spark.createDataFrame([(1, "some words", None, "x", 1)], SCHEMA)
    assert [tuple(r)[2:] for r in language.predict(none).collect()] == [("und", 0.0)]
    one = spark.createDataFrame([(1, "some words", "en", "x", 1), (3, "zq", "en", "x", 1)], SCHEMA)
    assert {tuple(r)[2:] for r in language.predict(one).collect()} == {("en", 1.0)}
    assert language.predict(none.limit(0)).collect() == []


def test_many_languages_get_smaller_samples(monkeypatch):
    samples = [(f"l{i}", bytes([97 + i]) * 1000) for i in range(4)]
    monkeypatch.setattr(language, "TABLE_BYTES", 4000)
    parser = language.Parser(samples)
    assert parser.table.nbytes <= 4000 + 4 * 4 * parser.width
    assert [name for name, _ in parser.judge([b"aaaa", b"dd"])] == ["l0", "l3"]


def test_copies_do_not_fill_the_sample(spark):
    rows = [(i, "same text again", "en", "x", 1) for i in range(200)] + [
        (1000 + i, f"other word{chr(97 + i)} here", "en", "x", 1) for i in range(20)
    ]
    labelled = spark.createDataFrame(rows, SCHEMA).select(
        F.col("lang").alias("lang__"), F.col("text").alias("text__")
    )
    assert language.sample(labelled).count() == 21
    assert language.sample(labelled, sample_texts=5).count() == 5
