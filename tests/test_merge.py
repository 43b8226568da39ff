import pytest

from tablework.operators import merge as M
from tablework.sinks.tables import drop_old_versions, partition_columns, swap_table, write_table
from tests.conftest import rows

SCHEMA = "k int, v string, w double"


def sides(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", None)], SCHEMA)
    source = spark.createDataFrame([(2, "B", 2.0), (3, "c", None), (4, "d", 4.0)], SCHEMA)
    return target, source


def test_actions(spark):
    got = dict(rows(M.merge_actions(*sides(spark), ["k"]), "k", "_action"))
    assert got == {1: "delete", 2: "update", 3: "keep", 4: "insert"}
    upsert = M.merge_actions(*sides(spark), ["k"], delete_missing=False)
    assert rows(upsert, "k", "v") == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]


def test_sync_counts_and_idempotence(spark, db):
    target, source = sides(spark)
    assert M.merge_sync(spark, f"{db}.t", target, ["k"])["insert"] == 3
    assert M.merge_sync(spark, f"{db}.t", source, ["k"]) == {"insert": 1, "update": 1, "keep": 1, "delete": 1}
    assert rows(spark.table(f"{db}.t")) == rows(source)
    assert M.merge_sync(spark, f"{db}.t", source, ["k"]) == {"insert": 0, "update": 0, "keep": 3, "delete": 0}
    assert rows(spark.table(f"{db}.t")) == rows(source)


def test_source_may_be_computed_from_the_target(spark, db):
    write_table(sides(spark)[0], f"{db}.t")
    source = spark.table(f"{db}.t").where("k > 1")
    assert M.merge_sync(spark, f"{db}.t", source, ["k"])["delete"] == 1
    assert rows(spark.table(f"{db}.t"), "k") == [(2,), (3,)]


def test_duplicate_source_key_is_refused(spark, db):
    target, source = sides(spark)
    write_table(target, f"{db}.t")
    with pytest.raises(M.DuplicateSourceKey):
        M.merge_sync(spark, f"{db}.t", source.union(source.where("k = 4")), ["k"])
    assert rows(spark.table(f"{db}.t")) == rows(target)


def test_null_keys_match_only_when_asked(spark):
    one = spark.createDataFrame([(None, "x", 1.0)], SCHEMA)
    other = spark.createDataFrame([(None, "y", 1.0)], SCHEMA)
    assert sorted(r[0] for r in M.merge_actions(one, other, ["k"]).select("_action").collect()) == ["delete", "insert"]
    assert rows(M.merge_actions(one, other, ["k"], null_safe=True)) == [(None, "y", 1.0, "update")]


def test_swap_replaces_schema_and_survives_self_read(spark, db):
    t = write_table(sides(spark)[0], f"{db}.t")
    out = swap_table(t.selectExpr("k * 10 AS ten", "v"), f"{db}.t")
    assert out.columns == ["ten", "v"] and rows(out, "ten") == [(10,), (20,), (30,)]
    part = swap_table(spark.table(f"{db}.t"), f"{db}.t", ["v"])
    assert rows(part, "ten", "v") == [(10, "a"), (20, "b"), (30, "c")]


def test_empty_sides(spark, db):
    target, source = sides(spark)
    write_table(target, f"{db}.t")
    assert M.merge_sync(spark, f"{db}.t", source.limit(0), ["k"])["delete"] == 3
    assert M.merge_sync(spark, f"{db}.t", source.limit(0), ["k"]) == {"insert": 0, "update": 0, "keep": 0, "delete": 0}
    assert M.merge_sync(spark, f"{db}.t", source, ["k"])["insert"] == 3
    assert spark.table(f"{db}.t").columns == ["k", "v", "w"]


def test_merge_keeps_partitions(spark, db):
    target, source = sides(spark)
    write_table(target, f"{db}.t", partition_by=["v"])
    assert M.merge_sync(spark, f"{db}.t", source, ["k"])["update"] == 1
    assert partition_columns(spark, f"{db}.t") == ["v"]
    assert rows(spark.table(f"{db}.t"), "k", "v", "w") == rows(source)


def test_write_merge_write_and_clean_up(spark, db):
    target, source = sides(spark)
    name = f"{db}.t"
    write_table(target, name)
    M.merge_sync(spark, name, source, ["k"])
    write_table(target, name)
    write_table(target, name, "append")
    assert spark.table(name).count() == 6
    write_table(spark.table(name).select("k"), name)
    write_table(target, name, partition_by=["v"])
    assert drop_old_versions(spark, name) == 4
    assert rows(spark.table(name), "k", "v", "w") == rows(target)
    assert drop_old_versions(spark, name) == 0


def files_of(spark, name):
    return {f.rsplit("/", 2)[-2] + "/" + f.rsplit("/", 1)[-1] for f in spark.table(name).inputFiles()}


def test_merge_writes_only_touched_partitions(spark, db):
    name = f"{db}.parts"
    target = spark.createDataFrame([(k, f"v{k}", f"p{k // 10}") for k in range(50)] + [(None, "n", None)], "k int, v string, p string")
    write_table(target, name, "overwrite", ["p"])
    before = files_of(spark, name)
    # 12 changes, 33 moves to another partition, 40..49 go altogether, 60 is new; p0 stays as it is
    wanted = [(k, "new" if k == 12 else f"v{k}", "p1" if k == 33 else f"p{k // 10}") for k in range(40)] + [(60, "x", "p6"), (None, "n", None)]
    source = spark.createDataFrame(wanted, "k int, v string, p string")
    counts = M.merge_sync(spark, name, source, ["k"])
    assert counts == {"insert": 2, "update": 2, "keep": 38, "delete": 11}
    assert rows(spark.table(name)) == rows(source)
    after = files_of(spark, name)
    kept = {f.split("/")[0] for f in before & after}
    assert kept == {"p=p0", "p=p2"} and "p=p4" not in {f.split("/")[0] for f in after}
    again = M.merge_sync(spark, name, source, ["k"])
    assert again == {"insert": 1, "update": 0, "keep": 41, "delete": 1} and rows(spark.table(name)) == rows(source)


@pytest.mark.parametrize("kind", ["int", "date", "timestamp_ntz", "double"])
def test_merge_writes_only_touched_ranges(spark, db, kind):
    name = f"{db}.ranged"
    key = {"int": "id", "date": "date_add(date'2024-01-01', int(id))", "timestamp_ntz": "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, int(id))", "double": "id / 4"}[kind]
    data = spark.range(1000).selectExpr(f"CAST({key} AS {kind}) AS k", "id * 2 AS v")
    M.write_ranged(data, name, "k", 8)
    assert len({f.split("/")[0] for f in files_of(spark, name)}) == 8
    before = files_of(spark, name)
    source = spark.range(1, 1001).selectExpr(f"CAST({key} AS {kind}) AS k", "IF(id = 500, -1, id * 2) AS v")
    assert M.merge_sync(spark, name, source, ["k"]) == {"insert": 1, "update": 1, "keep": 998, "delete": 1}
    assert rows(spark.table(name).drop(M.RANGE)) == rows(source)
    assert len(before & files_of(spark, name)) >= 5


def test_merge_of_a_scope_leaves_the_rest(spark, db):
    name = f"{db}.scoped"
    for parts in (["p"], None):
        write_table(spark.createDataFrame([(k, k, k // 10) for k in range(40)], "k int, v int, p int"), name, "overwrite", parts)
        source = spark.createDataFrame([(k, -k, 1) for k in range(10, 15)], "k int, v int, p int")
        assert M.merge_sync(spark, name, source, ["k"], scope=F.col("p") == 1) == {"insert": 0, "update": 5, "keep": 0, "delete": 5}
        assert rows(spark.table(name).groupBy("p").agg(F.count("*"), F.sum("v"))) == [(0, 10, 45), (1, 5, -60), (2, 10, 245), (3, 10, 345)]
        spark.sql(f"DROP TABLE {name}")
