"""Packing, slices and components."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from junctura.llm import files, packing, rolling, slices, store
from junctura.llm.components import components
from junctura.llm.store import Scratch


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), max_size=50))
def test_packing(values):
    v = np.array(sorted(values), np.uint64)
    assert (packing.unpack_sorted(packing.pack_sorted(v)) == v).all()
    assert (packing.unpack_ints(packing.pack_ints(v)) == v).all()
    f = v % np.uint64(2) == 0
    assert (packing.unpack_flags(packing.pack_flags(f)) == f).all()


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=5, max_size=80))
def test_window_hashes(data):
    a = np.frombuffer(data, np.uint8)
    h = rolling.windows(rolling.prefixes(a), 5, slice(None))
    words = [data[i : i + 5] for i in range(len(data) - 4)]
    assert len(h) == len(words)
    assert all((h[i] == h[j]) == (words[i] == words[j]) for i in range(len(words)) for j in range(i))


@pytest.mark.parametrize("same", [False, True])
def test_distinct_slices(monkeypatch, same):
    if same:  # all hashes alike: the comparison finds out
        monkeypatch.setattr(rolling, "slices", lambda sums, a, b: np.zeros(len(a), np.uint64))
    data = np.frombuffer(b"ab cd ab  ef ab cd", np.uint8)
    starts = np.array([0, 3, 6, 10, 13, 16])
    words, place = slices.distinct_slices(data, starts, starts + 2)
    assert [words[i] for i in place] == [b"ab", b"cd", b"ab", b"ef", b"ab", b"cd"] and words[0] == b"ab"


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8), (8, 9), (7, 7), (20, 1), (21, 20), (30, 31), (31, 32), (33, 32)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {r.node: r.component for r in components(df, Scratch(spark, "test"), "c").collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 20: 1, 21: 1, 8: 8, 9: 8, 30: 30, 31: 30, 32: 30, 33: 30}
    assert components(df.limit(0), Scratch(spark, "test"), "c").collect() == []


def test_hub_components(spark):
    edges = [(0, i) for i in range(1, 400)] + [(1000 + i, 399) for i in range(50)] + [(None, 1), (2, None)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "test"), "c").collect()}
    assert set(got.values()) == {0} and len(got) == 450


class Context:
    def __init__(self, master, folder):
        self.master, self.folder = master, folder

    def getCheckpointDir(self):
        return self.folder


class Session:
    """A session that names no folder."""

    def __init__(self, spark, master, folder):
        self._jvm, self._jsc, self.sparkContext = spark._jvm, spark._jsc, Context(master, folder)
        self.conf = self

    def get(self, key, default):
        return default


def test_shared_folder(spark, tmp_path):
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        store.shared_dir(Session(spark, "spark://host:7077", None))
    assert store.shared_dir(Session(spark, "spark://host:7077", f"file:{tmp_path}")) == f"file://{tmp_path}"
    assert store.shared_dir(Session(spark, "local[2]", None)) == store.DEFAULT_DIR


def test_concurrent_writes_put_settings_back(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    with store.writing(spark):
        with store.writing(spark):
            pass
        assert spark.conf.get(key) == "1000"
    assert spark.conf.get(key) == before


def test_file_systems(tmp_path):
    system, path = files.system_of(f"file://{tmp_path}/a")
    assert path == f"{tmp_path}/a" and system.type_name == "local"
    with pytest.raises(ValueError, match="no file system for unheard"):
        files.system_of("unheard://x/y")
