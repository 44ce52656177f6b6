import zlib

import numpy as np
import pytest

from claimloom.llm import quality_cnn as q

GOOD, BAD = "the quick thing was near a calm river and so on ", "BUY!! NOW$$$ %%% ###&&& CLICK*** "


@pytest.fixture(scope="module")
def tables(spark):
    rows = [(i, (GOOD if i % 3 else BAD) * (1 + i % 40), "s", 0.5) for i in range(600)] + [(900, None, "s", 0.1), (901, "", "s", 0.1), (5, GOOD, "s", 0.1), (None, GOOD, "s", 0.1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, score double")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(600)] + [(None, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    return docs, labels


def test_held_out_accuracy_and_defined_cases(tables):
    docs, labels = tables
    rows = q.classify(docs, labels).collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    judged = [r.predicted == int(r.doc_id % 3 > 0) for r in rows if r.held_out and r.doc_id < 600]
    assert sum(judged) >= 0.95 * len(judged) > 50
    assert len({r.score for r in rows if r.doc_id in (900, 901)}) == 1


def test_held_out_labels_change_nothing(tables):
    docs, labels = tables
    from pyspark.sql import functions as F

    turned = labels.withColumn("quality", F.when(q.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    order = lambda df: sorted((str(r.doc_id), r.score) for r in df.collect())
    assert order(q.classify(docs, turned)) == order(q.classify(docs, labels))


def test_rows_that_stay_are_unchanged(tables):
    docs, labels = tables
    stay = q.accepted(docs, labels)
    assert stay.columns == docs.columns and stay.schema == docs.schema
    kept = {r.doc_id for r in q.classify(docs, labels).collect() if r.predicted}
    assert sorted(map(str, stay.collect())) == sorted(str(r) for r in docs.collect() if r.doc_id in kept)


def test_scores_do_not_depend_on_portions(monkeypatch):
    net = q.Network.fresh(3)
    texts = [b"", b"a", b"x y z " * 3000, b"q" * 512, "é🙂".encode() * 900, b""]
    alone = np.concatenate([net.score([t]) for t in texts])
    together = net.score(texts)
    monkeypatch.setattr(q, "PORTION", 1024)
    small = net.score(texts)
    assert np.allclose(alone, together, atol=1e-6)
    assert np.allclose(small, alone, atol=1e-6)


def plain_score(net, text):
    """The network by its definition: windows of eight bytes at every fourth, chunks of 512 bytes at every 256."""
    size = max(256, -(-len(text) // 256) * 256)
    bytes_ = list(text) + [0] * (size - len(text) + 8)
    seen = np.array([bytes_[at : at + 8] if at + 8 <= size else bytes_[at : at + 4] + [-1] * 4 for at in range(0, size, 4)])
    inputs = np.where((seen >= 0)[:, :, None], net.embed[seen], 0).reshape(len(seen), -1)
    responses = inputs @ np.concatenate([net.filters[0], net.filters[1]]) + net.bias
    chunks = np.array([np.maximum(responses[at // 4 : (at + 512) // 4].max(axis=0), 0) for at in range(0, size, 256)])
    z = (np.concatenate([chunks.mean(axis=0), chunks.max(axis=0)]) - net.mean) / net.scale
    return float(1 / (1 + np.exp(-(np.maximum(z @ net.dense + net.dense_bias, 0) @ net.out + net.out_bias[0]))))


def test_scores_against_the_definition():
    rng = np.random.default_rng(4)
    net = q.Network.fresh(5)
    texts = [rng.integers(1, 256, n, dtype=np.uint8).tobytes() for n in (0, 1, 3, 4, 7, 255, 256, 257, 511, 512, 513, 900, 5000)]
    assert np.allclose(net.score(texts), [plain_score(net, t) for t in texts], atol=1e-5)


def test_training_rows_are_whole_bounded_and_defined(spark):
    rows = [(i, chr(97 + i % 26) * (300 * (i % 7)), i) for i in range(60)] + [(3, "another", 1), (3, "another", 2), (4, None, 3), (58, "long" * 400, 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, quality int").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(59)] + [(5, 0), (6, 1), (None, 1)], "doc_id bigint, quality int")
    found = [q.training_rows(docs, labels, 40, 1500, 12_000) for _ in range(2)]
    assert found[0][0] == found[1][0] and found[0][1].tolist() == found[1][1].tolist()
    texts = [t.rstrip(b"\0").decode() for t in found[0][0]]
    assert 5 < len(texts) <= 40 and sum(map(len, texts)) <= 12_000 and all(len(t) <= 1500 for t in texts)
    assert set(texts) <= {t or "" for _, t, _ in rows}


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    net = q.Network.fresh(1)
    samples = [rng.integers(1, 256, 256 * k, dtype=np.uint8).tobytes() for k in (1, 3, 2)]
    labels, weight = np.array([1.0, 0.0, 1.0], np.float32), np.ones(3)

    def loss():
        data = np.frombuffer(b"".join(samples), np.uint8)
        pooled = np.split(net.pooled(data, np.array([0, 1, 4])), [1, 4])
        p = net.probability(np.array([np.concatenate([x.mean(axis=0), x.max(axis=0)]) for x in pooled]))
        return -np.mean(np.where(labels == 1, np.log(p), np.log(1 - p)))

    for w, g in zip(net.weights(), q._gradients(net, samples, labels, weight), strict=True):
        for at in list(zip(*np.nonzero(np.abs(g) > 1e-4), strict=True))[:5]:
            old = w[at]
            w[at] = old + 1e-2
            up = loss()
            w[at] = old - 1e-2
            down = loss()
            w[at] = old
            assert abs((up - down) / 2e-2 - g[at]) < 0.15 * abs(g[at]) + 2e-3


def test_no_labels_and_empty_table(spark, tables):
    docs, labels = tables
    assert {r.score for r in q.classify(docs, labels.limit(0)).collect()} == {0.5}
    assert q.classify(docs.limit(0), labels).collect() == []
