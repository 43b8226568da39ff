import numpy as np
import pytest

from tablework.recommend import als as R
from tablework.recommend import topn as T
from tests.conftest import rows


class Model:
    """Factors in place of a fitted model."""

    def __init__(self, spark, users, items):
        self.userFactors, self.itemFactors = (
            spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(m)], "id int, features array<float>").repartition(3) for m in (users, items)
        )


def brute(users, items, n):
    out = {}
    for u, v in enumerate(users):
        scores = items.astype(np.float32) @ v.astype(np.float32)
        order = sorted(range(len(items)), key=lambda i: (-scores[i], i))[:n]
        out[u] = [float(scores[i]) for i in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("user", "place").collect():
        out.setdefault(r.user, []).append(r)
    return out


@pytest.mark.parametrize("block, n", [(7, 3), (50, 1), (1000, 10)])
def test_equals_all_pairs(spark, block, n):
    draw = np.random.default_rng(block)
    users, items = draw.normal(size=(40, 5)), draw.normal(size=(200, 5)) * draw.pareto(1.5, size=(200, 1))
    best, share = T.top_items(Model(spark, users, items), n, block=block)
    want, got = brute(users, items, n), found(best)
    assert set(got) == set(want)
    for u, best_rows in got.items():
        assert [r.place for r in best_rows] == list(range(1, n + 1)) and len({r.item for r in best_rows}) == n
        assert [r.prediction for r in best_rows] == pytest.approx(want[u], rel=1e-5)
    assert share == 1 if block == 1000 else 0 < share < 0.7


def test_equal_lengths_fewer_items_than_wanted_and_empty(spark):
    users, items = np.eye(3), np.eye(3)
    best, share = T.top_items(Model(spark, users, np.repeat(items, 20, axis=0)), 2, block=5)  # all of one length
    assert all([r.prediction for r in b] == [1.0, 1.0] for b in found(best).values()) and share <= 1
    best, share = T.top_items(Model(spark, users, items), 9, spark.createDataFrame([(1,), (1,), (77,)], "user int"))
    assert {u: len(b) for u, b in found(best).items()} == {1: 3} and share == 1
    none = Model(spark, users, items)
    none.itemFactors = none.itemFactors.limit(0)
    assert T.top_items(none, 2)[0].count() == 0


def test_equals_the_product_of_a_fitted_model(spark):
    draw = np.random.default_rng(3)
    cells = [(int(u), int(i), float(draw.integers(1, 6))) for u in range(60) for i in draw.choice(80, 12, replace=False)]
    model = R.als(spark.createDataFrame(cells, "user int, item int, rating float"), rank=4, iterations=4)
    best, _ = T.top_items(model, 5, block=16)
    shipped = {(r.user, r.place): r.prediction for r in R.recommend(model, 5).collect()}
    assert {(r.user, r.place): r.prediction for r in best.collect()} == pytest.approx(shipped, rel=1e-4)
    assert rows(best.groupBy("user").count()) == [(u, 5) for u in range(60)]
