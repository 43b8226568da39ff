import random
from collections import Counter

import pytest

from tablework.llm import rules as R

WHITE = " \t\n\x0b\x0c\r"


def split(text):
    for c in WHITE:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def brute(text):
    text = text or ""
    words = split(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    again = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    lines, dup, have = text.split("\n"), 0, set()
    for line in lines:
        if split(line):
            dup += line in have
            have.add(line)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(again))


def counted(docs):
    return {r.doc_id: tuple(r[c] for c in R.COUNTS) for r in R.statistics(docs).collect()}


def test_counts_against_brute_force(spark, docs_of):
    draw = random.Random(2)
    bits = ["a", "b", "c", "É", "🙂", " ", "\n", "\t", "\r", "\x0b", "|", "##", "<>", "\xa0", "\x1f", "b c", "!"]
    texts = ["".join(draw.choice(bits) + draw.choice(["", " "]) for _ in range(draw.randint(0, 60))) for _ in range(800)]
    texts += ["a b " * 20000, " ".join(map(str, range(30000))), "x\n" * 5000, "a b", "a b c", "a b c a", "\n\n", "a a a a"]
    rows = [*enumerate(texts), (-1, None), (-2, ""), (-3, "a")]
    docs = docs_of(rows).withColumnRenamed("lang", "n_words").withColumnRenamed("source", "kept")
    assert counted(docs) == {i: brute(t) for i, t in rows}


def corpus(n, seed=1):
    draw = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = [draw.choice("abcdefgh") * draw.randint(2, 6) + str(draw.randint(0, 999)) for _ in range(draw.randint(60, 90))]
        docs.append((i, " ".join(w + "***" * bad for w in words)))
        labels.append((i, 0 if bad else 1, 0))
    return docs, labels


def test_learned_list_rejects_the_bad_and_keeps_the_clean(spark, docs_of):
    docs, labels = corpus(400)
    known = spark.createDataFrame([*labels[:300], (5000, 0, 0), (1, None, None)], "doc_id long, quality int, toxic int")
    rows = {r.doc_id: r for r in R.judge(docs_of([*docs, (900, "too short"), (901, None), (902, "w x y z " * 30)]), known).collect()}
    for i, _, _ in labels:
        assert not rows[i].base_failed and rows[i].kept == (i % 5 != 0), rows[i]
    assert all(rows[i].base_failed and not rows[i].kept for i in (900, 901, 902))


@pytest.mark.parametrize("labels", [[], [(0, 1, 0), (1, 1, 0)], [(0, 0, 0)]])
def test_without_both_classes_the_base_rule_decides(spark, docs_of, labels):
    docs, _ = corpus(10)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert all(r.kept and r.rule is None for r in R.judge(docs_of(docs), known).collect())


def test_empty(spark, docs_of):
    assert R.judge(docs_of([]), spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_best_condition_is_the_best_of_all():
    hist = {"a": [(0, 10), (5, 5), (9, 0)], "b": [(14, 0), (0, 15), (0, 0)]}
    condition, left = R.best_condition(hist, {"a": [1.0, 2.0], "b": [1.0, 2.0]})
    assert (condition, left) == (R.Condition("b", False, 1.0), 0)
    assert str(condition) == "b <= 1"


def test_list_is_ordered(spark):
    one, two = (R.Condition("n_words", True, 5.0),), (R.Condition("n_words", True, 3.0), R.Condition("mean_word", False, 2.0))
    frame = spark.createDataFrame([(6.0, 1.0), (4.0, 1.0), (4.0, 3.0)], "f_n_words double, f_mean_word double")
    assert [r[0] for r in frame.select(R.verdict([one, two])).collect()] == [1, 2, None]
