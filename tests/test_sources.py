import json

import pytest
from pyspark.sql import functions as F

from tertulia.operators import report
from tertulia.sources import files
from tertulia.sources.layout import RunLayout


def test_byte_order_mark_quotes_and_line_breaks(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("﻿Autor,Texto\nana,\"dice \"\"sí\"\"\ny sigue\"\nluz,\n".encode())
    df = files.scan_csv(spark, str(path))
    assert df.columns == ["Autor", "Texto"]
    assert [tuple(r) for r in df.orderBy("Autor").collect()] == [("ana", 'dice "sí"\ny sigue'), ("luz", None)]


def test_long_lines_are_left_out_and_short_ones_filled(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text('a,b,c\n1,2,3\n4,5,6,7\n8\n9,"x,y",\n10,11,12,\n')
    df = files.scan_csv_tolerant(spark, str(path))
    rows = sorted((tuple(r) for r in df.collect()), key=lambda r: int(r[0]))
    assert rows == [("1", "2", "3"), ("8", None, None), ("9", "x,y", None)]
    assert files.count_skipped(spark, str(path)) == 2


def test_folder_reads_only_its_ending_and_checks_headers(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a;b\n1;\n")
    (tmp_path / "2.csv").write_text("a;b\n2;x\n")
    (tmp_path / "note.txt").write_text("nothing")
    rows = sorted(tuple(r) for r in files.scan_csv_dir(spark, str(tmp_path), sep=";").collect())
    assert rows == [("1", None), ("2", "x")]
    (tmp_path / "3.csv").write_text("b;a\n2;x\n")
    with pytest.raises(Exception):
        files.scan_csv_dir(spark, str(tmp_path), sep=";").collect()


def test_union_by_name(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(2,)], "i int")
    assert sorted(tuple(r) for r in files.union_sources([a, b]).collect()) == [(1, "x"), (2, None)]


def test_written_text_reads_back(spark, tmp_path):
    rows = [(1, 'a "b", c\nd'), (2, " lead "), (3, None), (4, "back\\slash")]
    df = spark.createDataFrame(rows, "i int, s string")
    files.write_csv(df, str(tmp_path / "t"))
    back = files.scan_csv(spark, str(tmp_path / "t")).select(F.col("i").cast("int"), "s")
    assert sorted((tuple(r) for r in back.collect())) == rows


def test_report_fills_missing_values(spark, tmp_path):
    record = report.run_report(spark, {"Path_raw_data": "x", "data volume": {"read": 3}}, min_topics=4, max_topics=10)
    files.write_document(report.as_document(record), str(tmp_path / "m"))
    text = next((tmp_path / "m").glob("part-*")).read_text()
    got = json.loads(text)
    assert got["Recommended k"] == "Not K" and got["Range_LDA"] is True and got["Max Topics"] == 10
    assert got["Path_raw_data"] == "x" and got["data volume"] == {"read": 3}


def test_conflict_modes(spark, tmp_path):
    layout = RunLayout(str(tmp_path), "l", "p", "v")
    spark.range(1).write.parquet(layout.table("x"))
    assert layout.settle(spark, "fail") == (layout, "errorifexists")
    assert layout.settle(spark, "replace")[1] == "overwrite"
    assert layout.settle(spark, "rename")[0].version == "v 1"


@pytest.mark.parametrize("tolerant", [True, False])
def test_rows_are_numbered_in_file_order(spark, tmp_path, tolerant):
    """The same numbers whatever the size of the splits; files are dealt to tasks by size, not by name."""
    want = []
    for name, rows in [("b.csv", 900), ("a.csv", 40), ("c.csv", 2000), ("d.csv", 0)]:
        lines = [f"{name}-{i},x" for i in range(rows)]
        want += [(name, line.split(",")[0]) for line in lines]
        if tolerant and lines:
            lines.insert(len(lines) // 2, "bad,line,with,more")
        (tmp_path / name).write_text("word,other\n" + "".join(f"{line}\n" for line in lines))
    want = [w for _, w in sorted(want, key=lambda r: r[0])]
    reader = files.scan_csv_tolerant if tolerant else files.scan_csv
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("3000", "700", usual):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "10")
            rows = files.in_file_order(reader(spark, str(tmp_path), ",", False).where("other = 'x'")).collect()
            assert [r.word for r in sorted(rows, key=lambda r: r.post_id)] == want and {r.post_id for r in rows} == set(range(len(want)))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
        spark.conf.unset("spark.sql.files.openCostInBytes")
