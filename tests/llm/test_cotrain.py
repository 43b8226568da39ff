import random

import numpy as np
import pytest

from tablework.llm import cotrain as C

LABELS = "doc_id long, quality int, toxic int"


def corpus(n, seed=1):
    """Bad texts shout; bad pages mostly come from one source."""
    draw = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = [draw.choice(["alpha", "beta", "gamma", "delta", "omega"]) + str(draw.randint(0, 9)) for _ in range(draw.randint(20, 60))]
        docs.append((i, " ".join(w.upper() + "!!" if bad else w for w in words), "en", "junk" if bad and draw.random() < 0.9 else "good"))
        labels.append((i, 0 if bad else 1, 0))
    return docs, labels


def test_held_out_accuracy_and_clean_documents(spark, docs_of):
    docs, labels = corpus(600)
    extra = [(1001, None), (1002, ""), (None, "alpha1 beta2 " * 20, None, None), (1003, "omega3 " * 30000, "en", "good")]
    known = spark.createDataFrame([*labels[:200], (9999, 0, 0), (1, None, 1), (None, 0, 0)], LABELS)
    rows = {r.doc_id: r for r in C.classify(docs_of([*docs, *extra]).withColumnRenamed("n_chars", "score"), known).collect()}
    assert len(rows) == len(docs) + len(extra)
    assert all(0 <= r.score <= 1 and r.kept == (r.score >= C.CUT) for r in rows.values())
    assert all(rows[i].kept for i in range(200, 600) if i % 4)  # clean documents stay
    assert sum(rows[i].kept for i in range(200, 600) if i % 4 == 0) <= 10  # of a hundred bad ones


def test_views_teach_each_other():
    """Few labels, a strong and a weak view: pseudo-labels of the strong view make the weak one better."""
    rng = np.random.default_rng(0)
    n = 3000
    y = (rng.random(n) < 0.5).astype(float)
    strong = np.hstack([(y[:, None] * 6 - 3) + rng.normal(size=(n, 1)), rng.normal(size=(n, 3))]).astype(np.float32)
    weak = np.hstack([(y[:, None] * 2 - 1) * 0.7 + rng.normal(size=(n, 1)), rng.normal(size=(n, 30))]).astype(np.float32)
    labelled = np.arange(n) < 60
    held = np.arange(60) % 4 == 0
    views = strong[labelled], weak[labelled]
    pool = strong[~labelled], weak[~labelled]
    right = lambda m: ((C.odds(pool[1], m.weights[1]) > 0) == (y[~labelled] > 0)).mean()
    alone, taught = (C.co_train(views, y[labelled], held, pool, rounds=r) for r in (0, 3))
    assert right(taught) > right(alone) + 0.02


def test_logistic_regression_meets_its_optimality_condition():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 5))
    y = (rng.random(400) < C.sigmoid(x @ [1, -2, 0, 0.5, 0] + 0.3)).astype(float)
    w = C.fit_logistic(x, y, ridge=0.5)
    slope = np.hstack([x, np.ones((400, 1))]).T @ (C.sigmoid(x @ w[:-1] + w[-1]) - y) + np.append(np.full(5, 0.5 * 4), 0) * w
    assert np.abs(slope).max() < 1e-5


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(77, 0, 0)]])
def test_without_both_classes_everything_stays(spark, docs_of, labels):
    docs, _ = corpus(20)
    assert all(r.kept and r.score == 1 for r in C.classify(docs_of(docs), spark.createDataFrame(labels, LABELS)).collect())


def test_reject_keeps_the_columns(spark, docs_of):
    docs, labels = corpus(300)
    frame = docs_of([*docs, (5, "alpha1 beta2 gamma3 " * 10)]).withColumnRenamed("n_chars", "quality_score")
    kept = C.reject(frame, spark.createDataFrame(labels, LABELS))
    assert kept.columns == frame.columns and {i for i in range(300) if i % 4} <= {r.doc_id for r in kept.collect()}
    assert kept.count() < 260
    assert C.reject(frame.limit(0), spark.createDataFrame(labels, LABELS)).count() == 0


def test_features_do_not_depend_on_neighbours():
    texts = ["Über öl\nÜber öl", "", "a", "bc", "THE END!! " * 50]
    together = C.content_features(texts)
    alone = np.vstack([C.content_features([t]) for t in texts])
    assert np.allclose(together, alone)


def plain_logistic(rows, y, ridge=C.RIDGE, steps=12):
    """Newton's method in plain loops; the last weight is the intercept."""
    from math import exp

    rows = [[*map(float, r), 1.0] for r in rows]
    d, n = len(rows[0]), len(rows)
    penalty = [ridge * n / 100] * (d - 1) + [1e-9]
    w = [0.0] * d
    for _ in range(steps):
        grid, slope = [[penalty[i] if i == j else 0.0 for j in range(d)] for i in range(d)], [penalty[i] * w[i] for i in range(d)]
        for r, t in zip(rows, y, strict=True):
            z = min(35.0, max(-35.0, sum(a * b for a, b in zip(r, w, strict=True))))
            p = 1 / (1 + exp(-z))
            curve = max(p * (1 - p), 1e-6)
            for i in range(d):
                slope[i] += r[i] * (p - t)
                for j in range(d):
                    grid[i][j] += curve * r[i] * r[j]
        for i in range(d):  # elimination with the largest pivot
            best = max(range(i, d), key=lambda k: abs(grid[k][i]))
            grid[i], grid[best], slope[i], slope[best] = grid[best], grid[i], slope[best], slope[i]
            for k in range(i + 1, d):
                f = grid[k][i] / grid[i][i]
                slope[k] -= f * slope[i]
                grid[k] = [a - f * b for a, b in zip(grid[k], grid[i], strict=True)]
        move = [0.0] * d
        for i in reversed(range(d)):
            move[i] = (slope[i] - sum(grid[i][j] * move[j] for j in range(i + 1, d))) / grid[i][i]
        w = [a - b for a, b in zip(w, move, strict=True)]
        if max(map(abs, move)) < 1e-6:
            break
    return w


def plain_co_training(views, y, held, pool, rounds):
    """The rounds written out row by row; also which rows of the pool each view was taught, in order."""
    from math import ceil, exp, log

    z = lambda r, w: sum(float(a) * b for a, b in zip(r, w, strict=False)) + w[-1]
    p = lambda v: 1 / (1 + exp(-min(35.0, max(-35.0, v))))
    taught = [[(list(r), t) for r, t, h in zip(x, y, held, strict=True) if not h] for x in views]
    good = sum(t for _, t in taught[0]) / len(taught[0])
    free, told = set(range(len(pool[0]))), [[], []]
    learn = lambda: [plain_logistic([r for r, _ in rows], [t for _, t in rows]) for rows in taught]
    weights = learn()
    for _ in range(rounds):
        chosen = []
        for k in (0, 1):
            for label, part in ((1.0, good), (0.0, 1 - good)):
                single = {i: np.float32(1) / (np.float32(1) + np.exp(-np.float32(np.clip(z(pool[k][i], weights[k]), -35, 35)))) for i in free}  # confidences have 32 bits
                sure = {i: v if label else np.float32(1) - v for i, v in single.items()}
                able = sorted((i for i in free if sure[i] >= C.SURE), key=lambda i: (-sure[i], i))
                chosen.append((1 - k, able[: ceil(C.SHARE * part * len(pool[0]))], label))
        for k, rows, label in chosen:
            taught[k] += [(list(pool[k][i]), label) for i in rows]
            told[k] += [(i, label) for i in rows]
            free -= set(rows)
        if not any(rows for _, rows, _ in chosen):
            break
        weights = learn()
    kept = [(i, t) for i, (t, h) in enumerate(zip(y, held, strict=True)) if h]
    slopes = []
    for x, w in zip(views, weights, strict=True):
        scaled = [[min(35.0, max(-35.0, z(x[i], w)))] for i, _ in kept]
        slopes.append(plain_logistic(scaled, [t for _, t in kept], ridge=1.0))
    share = sum(t for _, t in kept) / len(kept)
    prior = log(share / (1 - share))
    return weights, slopes, lambda a, b: p(sum(c[0] * z(r, w) + c[1] for r, w, c in zip((a, b), weights, slopes, strict=True)) - prior), told


@pytest.mark.parametrize("seed, tied", [(3, False), (4, False), (5, True)])
def test_rounds_equal_plain_loops(seed, tied):
    rng = np.random.default_rng(seed)
    n, known = 200, 60
    y = (rng.random(n) < 0.6).astype(float)
    content = (rng.normal(size=(n, 3)) + (2 * y[:, None] - 1) * [1.6, 0.8, 0]).astype(np.float32)
    page = (rng.normal(size=(n, 2)) + (2 * y[:, None] - 1) * [1.2, 0.3]).astype(np.float32)
    if tied:  # many rows of the pool are alike, so confidences tie at the cut and the first rows go first
        content, page = np.round(content), np.round(page)
    views, pool, held = (content[:known], page[:known]), (content[known:], page[known:]), np.arange(known) % 4 == 0
    model = C.co_train(views, y[:known], held, pool, rounds=3)
    weights, slopes, score, told = plain_co_training(views, y[:known], held, pool, 3)
    assert all(len(t) > 5 for t in told)
    for got, want in zip(model.weights, weights, strict=True):
        assert np.allclose(got, want, rtol=1e-3, atol=1e-3)
    for got, want in zip(model.calibration, slopes, strict=True):
        assert np.allclose(got, want, rtol=1e-2, atol=1e-2)
    found = model.scores((content, page))
    assert np.allclose(found, [score(a, b) for a, b in zip(content, page, strict=True)], atol=5e-3)


def test_empty_table(spark, docs_of):
    assert C.classify(docs_of([]), spark.createDataFrame([(1, 1, 0), (2, 0, 0)], LABELS)).count() == 0
