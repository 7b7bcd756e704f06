"""Whitening against an eigendecomposition in numpy, and rows that do not count."""

import numpy as np
import pyarrow as pa
import pytest

from releasecat.llm.queries import QUERIES
from releasecat.llm.whitening import Whitening, deviations, solved, whiten

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, components=32):
    """Longs, covariance and components with numpy alone."""
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for _, v in rows], object)
    n, sums = len(x), x.sum(0)
    apart = (n * x - sums).astype(float) / n
    values, axes = np.linalg.eigh(apart.T @ apart / n)
    values, axes = values[::-1], axes[:, ::-1]
    real = values[:components] > values[0] * 1e-12
    deviation = {i: int(sum((n * a - s) ** 2 for a, s in zip(row, sums))) for (i, _), row in zip(rows, x)}
    return values[:components][real], values.sum(), apart @ axes[:, :components][:, real], deviation


def check(found, rows, rule=Whitening()):
    values, trace, projected, deviation = plain(rows, rule.components)
    expected = projected / np.sqrt(values)
    table = found.toPandas().sort_values(["vec_id", "component"])
    assert len(table) == len(rows) * len(values)
    assert set(table["n"]) == {len(rows)}
    assert all(deviation[i] == d for i, d in zip(table["vec_id"], table["deviation"]))
    order = np.argsort([i for i, _ in rows], kind="stable")
    whitened = table["whitened"].to_numpy().reshape(len(rows), len(values))
    signs = np.sign((whitened * expected[order]).sum(0))
    assert np.allclose(whitened * signs, expected[order], atol=1e-7)
    assert np.allclose(table["explained"].to_numpy()[: len(values)], values / trace, rtol=1e-10)
    assert table["identity_error"].nunique() == 1 and table["identity_error"].iloc[0] < 1e-9


def test_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(QUERIES["op12_cholesky_whitening"](spark, sf_dir), rows)


def test_rows_that_do_not_count(spark):
    rng = np.random.default_rng(3)
    good = [(i, rng.normal(0, 3, 4).tolist()) for i in range(40)]
    bad = [
        (90, None),
        (91, []),
        (92, [1.0, None, 2.0, 3.0]),
        (93, [float("nan"), 0.0, 0.0, 0.0]),
        (94, [0.0, float("inf"), 0.0, 0.0]),
        (95, [1.0, 2.0]),
        (96, [1e300, 0.0, 0.0, 0.0]),
    ]
    df = spark.createDataFrame([(i, v, 0) for i, v in good + bad], SCHEMA).withColumnRenamed("label", "component")
    check(whiten(df.repartition(5)), good)


def test_repeated_rows_and_ids(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 1, 3).tolist()) for i in range(10)]
    hot = rows + [(10 + i, rows[0][1]) for i in range(200)]
    check(whiten(spark.createDataFrame([(i, v, 0) for i, v in hot], SCHEMA)), hot)
    twice = whiten(spark.createDataFrame([(1, v, 0) for _, v in rows] + [(None, rows[0][1], 0)], SCHEMA))
    assert twice.count() == 11 * 3 and twice.where("vec_id IS NULL").count() == 3


def test_ill_conditioned_and_dependent_dimensions(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(0, 1, (100, 3))
    wide = [(i, [1e4 * a, b, c, 1e4 * a, 7.0]) for i, (a, b, c) in enumerate(base.tolist())]
    table = whiten(spark.createDataFrame([(i, v, 0) for i, v in wide], SCHEMA)).toPandas()
    # The copy and the constant add no component; the short axes are whitened as well as the long one.
    assert sorted(set(table["component"])) == [1, 2, 3]
    assert table["identity_error"].iloc[0] < 1e-4
    check(whiten(spark.createDataFrame([(i, v, 0) for i, v in wide], SCHEMA)), wide)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0], 0)], [(1, [1.0], 0), (2, [1.0], 0)], [(1, None, 0)]])
def test_nothing_to_whiten(spark, rows):
    found = whiten(spark.createDataFrame(rows, SCHEMA))
    assert found.count() == 0
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_most_common_length_wins_and_ties_go_to_the_longest(spark):
    rows = [(0, [0.0], 0), (1, [1.0], 0), (2, [0.0, 1.0], 0), (3, [1.0, 3.0], 0)]
    assert {r.vec_id for r in whiten(spark.createDataFrame(rows, SCHEMA)).collect()} == {2, 3}
    rows.append((4, [3.0], 0))
    assert {r.vec_id for r in whiten(spark.createDataFrame(rows, SCHEMA)).collect()} == {0, 1, 4}


def test_deviation_is_exact_or_null():
    x = np.array([[1 << 20, 0], [1 << 21, 5]])
    assert deviations(x, 3, np.array([7, 9])).to_pylist() == [
        sum((3 * a - s) ** 2 for a, s in zip(row, (7, 9))) for row in x.tolist()
    ]
    far = np.array([[1 << 30, 0], [3, 4]])
    assert deviations(far, 4, np.array([0, 0])).to_pylist() == [None, 16 * 25]
    assert deviations(far[:0], 4, np.array([0, 0])) == pa.array([], pa.int64())


def test_triangles_are_solved_one_after_the_other():
    rng = np.random.default_rng(6)
    a, first, second = rng.normal(size=(5, 3)), np.triu(rng.normal(size=(3, 3)) + 3 * np.eye(3)), np.triu(np.ones((3, 3)))
    assert np.allclose(solved(a, [first, second]) @ second @ first, a)
