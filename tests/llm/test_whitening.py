"""Whitening against numpy's eigenvectors, exact deviations, edges."""

import numpy as np
import pytest
from pyspark.sql import types as T

from txlake.llm import whitening

TYPE = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))]
    + [T.StructField(c, T.LongType()) for c in ("x", "n", "dim", "component", "at", "sums")]
)


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], *[1] * 6) for i, v in rows], TYPE)


def expected(vectors, k):
    x = np.floor(64 * np.array(vectors, dtype=np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    whole = n * x - s
    c = whole / n
    values, parts = np.linalg.eigh(c.T @ c / n)
    values, parts = values[::-1], parts[:, ::-1]
    return (whole * whole).sum(axis=1), c @ parts[:, :k] / np.sqrt(values[:k]), values[:k] / values.sum()


def check(df, ids, vectors, k):
    got = df.toPandas()
    deviation, white, explained = expected(vectors, k)
    assert len(got) == len(ids) * k and (got["n"] == len(ids)).all()
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    table = got.pivot(index="vec_id", columns="component", values="whitened").loc[ids].to_numpy()
    table = table * np.sign((table * white).sum(axis=0))
    assert np.abs(table - white).max() < 1e-7
    first = got[got["component"] == 1].set_index("vec_id").loc[ids]
    assert (first["deviation"].to_numpy() == deviation).all()
    share = got.drop_duplicates("component").sort_values("component")["explained"].to_numpy()
    assert np.abs(share / explained - 1).max() < 1e-9


@pytest.mark.parametrize("d,k", [(6, 6), (40, 32)])
def test_against_eigenvectors(spark, d, k):
    rng = np.random.default_rng(d)
    mixed = rng.standard_normal((300, d)) @ rng.standard_normal((d, d)) + 5
    rows = [(i * 7, v) for i, v in enumerate(mixed)]
    check(whitening.whitened(frame(spark, rows).repartition(4)), [r[0] for r in rows], mixed, k)


def test_edges(spark):
    rng = np.random.default_rng(1)
    good = rng.standard_normal((40, 5))
    rows = [(i, v) for i, v in enumerate(good)]
    bad = [(100, None), (101, [1, None, 1, 1, 1]), (102, [1, float("nan"), 0, 0, 0]), (103, [float("inf")] * 5), (104, []), (105, [1, 2])]
    check(whitening.whitened(frame(spark, rows + bad)), list(range(40)), good, 5)
    null_and_repeated = rows + [(None, good[0]), (3, good[3]), (3, good[3])]
    got = whitening.whitened(frame(spark, null_and_repeated)).toPandas()
    assert len(got) == 43 * 5 and got["vec_id"].isna().sum() == 5 and (got["vec_id"] == 3).sum() == 15


def test_rank_below_dimension_and_no_rows(spark):
    rng = np.random.default_rng(2)
    thin = (rng.integers(-8, 9, (60, 2)) @ rng.integers(-3, 4, (2, 6))) / 8.0
    rows = [(i, v) for i, v in enumerate(thin)]
    check(whitening.whitened(frame(spark, rows)), list(range(60)), thin, 2)
    assert whitening.whitened(frame(spark, [])).collect() == []
    assert whitening.whitened(frame(spark, [(1, [1, 2, 3])])).collect() == []
    assert whitening.whitened(frame(spark, [(i, [1, 2, 3]) for i in range(5)])).collect() == []


def test_equal_deviations(spark):
    """Repeated singular values: the process starts anew, the space is whole."""
    eye = np.vstack([np.eye(4), -np.eye(4)]) * 2
    got = whitening.whitened(frame(spark, [(i, v) for i, v in enumerate(eye)])).toPandas()
    assert sorted(got["component"].unique()) == [1, 2, 3, 4]
    assert got["identity_error"].max() < 1e-9 and np.allclose(got["explained"], 0.25)


def test_large_entries_are_exact(spark):
    """Whole numbers beyond 64 bits in between; a deviation that does not fit is null."""
    rng = np.random.default_rng(3)
    big = rng.standard_normal((20, 3)) * 1e6
    got = whitening.whitened(frame(spark, [(i, v) for i, v in enumerate(big)])).collect()
    x = np.floor(64 * big.astype(np.float32).astype(np.float64)).astype(np.int64).astype(object)
    whole = 20 * x - x.sum(axis=0)
    want = {i: int(s) for i, s in enumerate((whole * whole).sum(axis=1))}
    assert {(r.vec_id, r.deviation) for r in got} == {(i, w if w < 2**63 else None) for i, w in want.items()}
    huge = whitening.whitened(frame(spark, [(i, v * 1e9) for i, v in enumerate(big)])).toPandas()
    assert huge["deviation"].isna().all() and huge["identity_error"].max() < 1e-6


def test_stops_early_when_the_wanted_parts_are_found(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FULL", 8)
    rng = np.random.default_rng(4)
    scale = np.concatenate([[50, 40, 30], np.full(27, 0.5)])
    steep = rng.standard_normal((200, 30)) * scale
    got = whitening.whitened(frame(spark, [(i, v) for i, v in enumerate(steep)]), components=3).toPandas()
    _, white, _ = expected(steep, 3)
    table = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    assert np.abs(table * np.sign((table * white).sum(axis=0)) - white).max() < 1e-6
