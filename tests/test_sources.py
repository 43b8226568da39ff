import datetime as dt
import os

import pytest

from tablework.schemas import table
from tablework.sinks import tables as K
from tablework.sources import files as S
from tablework.sources import text as TX
from tests.conftest import rows


def brute_blocks(texts):
    out = []
    for text in texts:
        item = None
        for line in text.splitlines():
            if line.endswith(":"):
                item = line[:-1]
            else:
                user, score, day = line.split(",")
                out.append((item, user, int(score), dt.date.fromisoformat(day)))
    return sorted(out)


def test_block_text_meets_in_segments(spark, tmp_path, monkeypatch):
    """A split of any size is cut into segments of few lines; most of them hold no header."""
    monkeypatch.setattr(TX, "SEGMENT", 7)
    texts = ["\n".join(["1:", *(f"{u},3,2005-09-01" for u in range(100)), "2:", "5,1,2005-09-02", "3:", *(f"{u},4,2005-09-03" for u in range(30))]), "4:\n1,1,2005-01-01"]
    for i, text in enumerate(texts):
        (tmp_path / f"{i}.txt").write_text(text)
    found = TX.parse_block_ratings(spark, [str(tmp_path / f"{i}.txt") for i in range(2)])
    assert sorted(tuple(r) for r in found.collect()) == brute_blocks(texts)
    windows = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in x]
    assert any("segment" in x.split("], [")[1] for x in windows)


@pytest.mark.parametrize("split", [None, "64", "400"])
def test_block_text_across_splits(spark, tmp_path, split):
    """Splits far smaller than a block: most of them hold no header at all."""
    texts = []
    for f in range(2):
        lines = []
        for item in range(1, 5):
            lines.append(f"{f * 10 + item}:")
            size = 120 if item == 2 else 3  # one item holds most of the rows
            lines += [f"{u},{u % 5 + 1},2005-09-{u % 28 + 1:02d}" for u in range(size)]
        texts.append("\n".join(lines) + "\n")
    paths = []
    for i, text in enumerate(texts):
        path = tmp_path / f"combined_{i}.txt"
        path.write_text(text)
        paths.append(str(path))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        if split:
            spark.conf.set("spark.sql.files.maxPartitionBytes", split)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = sorted(tuple(r) for r in TX.parse_block_ratings(spark, paths).collect())
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert got == brute_blocks(texts)


def test_ragged_titles(spark, tmp_path):
    path = tmp_path / "titles.csv"
    path.write_bytes("1,2003,Dinosaur Planet\n2,NULL,Lock, Stock, and Two\n3,1997,Caf\xe9 \"Q\"\n".encode("latin-1"))
    assert rows(TX.parse_titles(spark, str(path))) == [
        ("1", 2003, "Dinosaur Planet"), ("2", None, "Lock Stock and Two"), ("3", 1997, 'Café "Q"'),
    ]


def test_discovery_takes_files_and_folders(spark, tmp_path):
    (tmp_path / "train.csv").write_text("a\n1\n2\n")
    (tmp_path / "notes.txt").write_text("x")
    K.export_csv(spark.range(3), str(tmp_path / "test.csv"))
    assert list(S.discover_csv(spark, str(tmp_path))) == ["bronze_test", "bronze_train"]
    assert rows(S.discovered(spark, str(tmp_path))) == [("bronze_test", 3), ("bronze_train", 2)]
    assert S.discover_csv(spark, str(tmp_path / "none")) == {}


def test_file_year_of_plain_file_and_folder(spark, tmp_path):
    (tmp_path / "properties_2016.csv").write_text("id\n1\n")
    K.export_csv(spark.createDataFrame([(2,)], "id int"), str(tmp_path / "properties_2017.csv"))
    paths = [str(tmp_path / f"properties_{y}.csv") for y in (2016, 2017)]
    assert rows(S.with_file_year(S.read_csv(spark, paths, table("id int")))) == [(1, "2016"), (2, "2017")]


def test_ingest_metadata(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("id\n1\n")
    r = S.with_ingest_metadata(S.read_csv(spark, str(path), table("id int")), "r1", "g").first()
    assert r.file_name == "x.csv" and r.file_size == os.path.getsize(path) and r.run_id == "r1" and r.job_group == "g"
    assert r.file_path.endswith("/x.csv") and r.process_timestamp is not None


def test_bad_cells_become_null_with_a_schema(spark, tmp_path):
    path = tmp_path / "x.csv"
    path.write_text("id,v\n1,2.5\nx,3\n2,\n")
    assert rows(S.read_csv(spark, str(path), table("id int", "v double"))) == [(None, 3.0), (1, 2.5), (2, None)]


def test_month_headers():
    wide = [f"{m} {y}" for y in range(2010, 2018) for m in S.MONTHS]
    names = [S.clean_name(c) for c in wide]
    assert names[0] == "jan_2010" and names[-1] == "dec_2017" and len(set(names)) == len(wide)
    assert S.clean_name("Population Rank") == "Population_Rank" and S.clean_name("Sept 2010") == "Sept_2010"
    assert S.clean_name("May 2010", month_style=False) == "May_2010"


def test_times_survive_csv_and_json(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 2, 3, 4, 567891),)], "t timestamp_ntz")
    schema = table("t timestamp_ntz")
    assert rows(S.read_csv(spark, K.export_csv(df, str(tmp_path / "c")), schema)) == rows(df)
    assert rows(S.read_json(spark, K.export_json(df, str(tmp_path / "j")), schema)) == rows(df)


def test_tables(spark, db):
    df = spark.range(4).selectExpr("id", "id % 2 AS p")
    K.write_table(df, f"{db}.t", "append", ["p"])
    K.write_table(df, f"{db}.t", "append", ["p"])
    assert rows(K.partition_inventory(spark, f"{db}.t", "p")) == [(0, 4), (1, 4)]
    K.write_table(df.limit(1), f"{db}.t")
    assert spark.table(f"{db}.t").count() == 1
    K.ctas(df, f"{db}.c")
    K.ctas(df.limit(0), f"{db}.c", if_not_exists=True)
    assert spark.table(f"{db}.c").count() == 4


def test_marks_are_per_table(spark, db):
    marks = f"{db}.marks"
    assert K.get_watermark(spark, marks, "a") == -1
    K.set_watermark(spark, marks, "a", 5)
    K.set_watermark(spark, marks, "b", 7)
    K.set_watermark(spark, marks, "a", 6)
    assert (K.get_watermark(spark, marks, "a"), K.get_watermark(spark, marks, "b")) == (6, 7)
    assert K.get_watermark(spark, marks, "c") == -1


def test_malformed_rows_are_kept_apart(spark, db, tmp_path):
    from tablework.sources.files import load_csv_checked

    schema = table("id bigint", "name string", "amount double")
    (tmp_path / "a.csv").write_text('id,name,amount\n1,a,1.5\nx,b,2\n3,c\n4,d,4,extra\n5,,\n"6","e,e",6\n')
    (tmp_path / "b.csv").write_text("id,name,amount\n7,g,seven\n8,h,8\n")
    for n in (1, 2):
        counts = load_csv_checked(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], schema, f"{db}.good", f"{db}.bad")
        assert counts == {"good": 4, "bad": 4}
        assert spark.table(f"{db}.good").count() == 4 * n  # loads append
    assert rows(spark.table(f"{db}.good").distinct()) == [(1, "a", 1.5), (5, None, None), (6, "e,e", 6.0), (8, "h", 8.0)]
    bad = rows(spark.table(f"{db}.bad").select("raw_text", "file_path").distinct())
    assert [r[0] for r in bad] == sorted({"x,b,2", "3,c", "4,d,4,extra", "7,g,seven"})
    assert [r[1].rsplit("/", 1)[-1] for r in bad] == ["a.csv", "a.csv", "b.csv", "a.csv"]
    (tmp_path / "c.csv").write_text("id,name,amount\n")
    assert load_csv_checked(spark, str(tmp_path / "c.csv"), schema, f"{db}.good", f"{db}.bad") == {"good": 0, "bad": 0}
