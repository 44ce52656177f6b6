from pathlib import Path
from types import SimpleNamespace

import pytest

from claimloom.llm import common


def test_memo_is_bounded_and_keeps_recent_keys():
    made = []
    memo = common.Memo(lambda k: made.append(k) or k * 2, limit=10, longest=3)
    for n in range(35):
        assert memo[f"{n}"] == f"{n}{n}"
        assert len(memo) + len(memo.older) <= 20
    assert memo["34"] == "3434" and memo["25"] == "2525" and len(made) == 35
    assert memo["a long key"] == "a long keya long key" and "a long key" not in memo
    memo["0"]
    assert len(made) == 37


def test_one_thing_is_kept_at_a_time():
    first = common.kept("a", list)
    assert common.kept("a", list) is first
    assert common.kept("b", dict) == {} and common.kept("a", list) is not first


def test_written_and_discarded(spark):
    frame, place = common.written(spark.range(5), "numbers")
    folder = Path(place.removeprefix("file:"))
    assert frame.count() == 5 and folder.is_dir() and str(folder).startswith(common.shared_folder(spark).removeprefix("file:"))
    common.discard(spark, place)
    assert not folder.exists()


def test_the_cluster_names_the_folder():
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: {"spark.checkpoint.dir": "hdfs://x/y"}.get(key, default)))
    assert common.shared_folder(named) == "hdfs://x/y"


def test_no_machine_local_folder_on_a_cluster():
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda name, default: default), sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        common.shared_folder(cluster)
    cluster.conf.get = lambda name, default: "hdfs:///shared"
    assert common.shared_folder(cluster) == "hdfs:///shared"


def test_segments_end_before_white_space():
    for text in (b"", b"word", b"ab cd  ef\ngh " * 50, b"x" * 200, b" " * 200):
        for size in (1, 7, 64, 10_000):
            parts = list(common.segments(text, size))
            assert b"".join(parts) == text and [w for p in parts for w in p.split()] == text.split()
