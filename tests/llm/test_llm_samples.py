"""The learning samples stay within their bounds, and scores equal plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from registrar.llm import langid, quality


@pytest.fixture
def seen(monkeypatch):
    """What reaches the training of the network: (pieces, languages)."""
    calls = []

    def record(pieces, languages):
        calls.append((pieces, languages))

    monkeypatch.setattr(langid, "train", record)
    return calls


def test_copies_of_a_text_do_not_fill_the_language_sample(spark, seen):
    copies = spark.range(30_000).select(F.col("id").alias("doc_id"), F.lit("the same text").alias("text"), F.lit("en").alias("lang"))
    others = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text of its own "), F.sha1(F.col("id").cast("string"))).alias("text"), F.lit("en").alias("lang"))
    more = others.withColumn("lang", F.lit("fr"))
    langid.learn(copies.union(others).union(more), F.lit(True), per_language=200)
    (pieces, languages), = seen
    assert len(pieces) == len(set(zip(pieces, languages))) and pieces.count(b"the same text") <= 1
    assert all(120 <= languages.count(x) <= 300 for x in ("en", "fr"))


def test_language_states_equal_a_plain_loop():
    """All positions of texts of any length, one stretch at a time, the last one filled up."""
    network = langid.train([b"the cat sat on the mat " * 5, "über die Straße gehen ".encode() * 5], ["en", "de"])
    texts = [b"", b"a", b"the cat " * 40, "schöne Straße ".encode() * 30, b"x" * 128, b"y" * 129]
    data = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
    got = langid.pool(network, data, offsets)
    for row, text in zip(got, texts):
        total = np.zeros(len(network.languages))
        for start in range(0, len(text), langid.STRETCH):
            piece = np.frombuffer(text[start : start + langid.STRETCH], np.uint8)
            codes = np.append(piece, np.zeros(langid.STRETCH - len(piece), np.uint8))[:, None]
            total += network.labels(network.states(codes))[: len(piece), :, 0].sum(0)
        assert np.allclose(row, total / max(1, len(text)), atol=1e-5)


def test_repeated_doc_ids_do_not_fill_the_quality_sample(spark, monkeypatch):
    sizes = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, good: sizes.append(len(x)) or fit(x, good))
    free = [i for i in range(400) if __import__("zlib").crc32(str(i).encode()) % 3 != 1]
    many = spark.range(20_000).select(F.lit(free[0]).cast("long").alias("doc_id"), F.concat(F.lit("copy "), F.col("id").cast("string")).alias("text"))
    some = spark.createDataFrame([(i, ("Good prose, told well. " if i % 2 else "$$$ click ### now ") * 9) for i in free], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in free] * 3, "doc_id long, quality int")
    ranking = quality.learn(many.union(some), labels)
    assert sizes == [len(free)]
    quality.learn(many.union(some), labels, labelled=40)
    assert 10 <= sizes[1] <= 80
    scored = {r.doc_id: r.predicted for r in quality.score(some, ranking).collect()}
    assert np.mean([scored[i] == i % 2 for i in free]) > 0.95


def test_threshold_is_the_quantile_of_all_labelled_documents(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    ranking = quality.learn(docs, labels, labelled=60)  # the sample is a part only
    import zlib

    known = {}
    for r in labels.filter("quality IS NOT NULL").collect():
        if zlib.crc32(str(r.doc_id).encode()) % 3 != 1:
            known[r.doc_id] = min(r.quality, known.get(r.doc_id, 1))
    raw = {}
    for r in docs.collect():
        data = np.frombuffer((r.text or "").encode(), np.uint8)
        x = quality.features(data, np.array([0, len(data)]))
        raw[r.doc_id] = float(ranking.raw(x)[0])
    values = sorted(raw[i] for i in known)
    bad = np.mean([known[i] != 1 for i in known])
    below = np.mean([v < ranking.threshold for v in values])
    assert abs(below - bad) <= 1.5 / len(values)
    rows = quality.score(docs, ranking).collect()
    for r in rows:  # scores by a plain loop
        expected = 1 / (1 + np.exp(-np.clip((raw[r.doc_id] - ranking.threshold) / ranking.spread, -30, 30)))
        assert abs(r.score - expected) < 1e-9 and r.predicted == int(r.score >= 0.5)
