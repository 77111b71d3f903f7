import csv
import io
import random

import pytest

from tallyframe.sources import csvsplit, tables


@pytest.fixture
def slices(spark):
    """Read files in slices of so many bytes."""
    key = "spark.sql.files.maxPartitionBytes"
    yield lambda size: spark.conf.set(key, str(size))
    spark.conf.unset(key)


def some_table(seed, rows):
    source = random.Random(seed)
    pieces = ['"', "\n", "a", "é,", " b ", "\n\n", '""', "\r\n", "x" * 40]
    return [(str(i), "".join(source.choices(pieces, k=source.randrange(1, 9))), source.choice(["k", "l,m"]))
            for i in range(rows)]


def as_csv(rows, end="\n"):
    held = io.StringIO()
    writer = csv.writer(held, lineterminator=end)
    writer.writerow(["i", "t", "c"])
    writer.writerows(rows)
    return held.getvalue()


@pytest.mark.parametrize("size", [7, 64, 700, 1 << 20])
def test_slices_give_the_records_of_the_whole_file(spark, tmp_path, slices, size):
    rows = some_table(size, 25 if size == 7 else 120)
    rows.append(("last", "very long\n" * 60, "spans many slices"))
    (tmp_path / "a.csv").write_text(as_csv(rows[:70]), newline="")
    (tmp_path / "b.csv").write_text("﻿" + as_csv(rows[70:], "\r\n") + "\r\n", newline="")
    slices(size)
    got = tables.read_csv(spark, str(tmp_path), tokens=())
    assert got.columns == ["i", "t", "c"]
    texts = {"i": str, "t": str, "c": str}
    found = sorted((str(r.i), r.t, r.c) for r in got.collect())
    assert found == sorted(tuple(texts[k](v) for k, v in zip("itc", r, strict=True)) for r in rows)


def test_split_equals_the_reader_of_whole_files(spark, tmp_path, slices):
    rows = [r for r in some_table(5, 90) if "\r" not in r[1]]
    (tmp_path / "a.csv").write_text(as_csv(rows), newline="")
    slices(50)
    split = tables.read_csv(spark, str(tmp_path)).collect()
    whole = tables.read_csv(spark, str(tmp_path), multiline=True).collect()
    assert sorted(map(repr, split)) == sorted(map(repr, whole))
    assert len({r.slice for r in csvsplit.lines_of(spark, str(tmp_path)).collect()}) > 10


def test_an_open_quote_raises(spark, tmp_path, slices):
    (tmp_path / "a.csv").write_text('i,t,c\n1,"never closed,x\n' + "2,y,z\n" * 50)
    slices(40)
    with pytest.raises(ValueError, match="ends within quotes"):
        tables.read_csv(spark, str(tmp_path))


def test_headers_must_agree(spark, tmp_path):
    (tmp_path / "a.csv").write_text("i,t\n1,x\n")
    schema = "i bigint, other string"
    from pyspark.sql import types as T
    with pytest.raises(ValueError, match="differs from the columns"):
        tables.read_csv(spark, str(tmp_path), T.StructType.fromDDL(schema))
    (tmp_path / "b.csv").write_text("i,u\n1,x\n")
    with pytest.raises(ValueError, match="different headers"):
        tables.read_csv(spark, str(tmp_path))
    with pytest.raises(ValueError, match="unknown multiline"):
        tables.read_csv(spark, str(tmp_path), multiline="else")


def test_no_records(spark, tmp_path):
    from pyspark.sql import types as T
    (tmp_path / "a.csv").write_text("")
    schema = T.StructType.fromDDL("i bigint")
    assert tables.read_csv(spark, str(tmp_path), schema).collect() == []
    (tmp_path / "a.csv").write_text("i\n")
    assert tables.read_csv(spark, str(tmp_path), schema).collect() == []


def test_many_small_slices_are_few_tasks(spark, tmp_path):
    rows = [(i, "a\n" * (i % 40) + "b") for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, t string")
    tables.write_table(df.coalesce(1), str(tmp_path), "one", "csv")
    key = "spark.sql.files.maxPartitionBytes"
    usual = spark.conf.get(key)
    spark.conf.set(key, "256")
    try:
        lines = csvsplit.lines_of(spark, f"{tmp_path}/one")
        tasks = lines.rdd.getNumPartitions()
        assert tasks <= 4 * spark.sparkContext.defaultParallelism < lines.select("slice").distinct().count()
        got = tables.read_csv(spark, f"{tmp_path}/one", df.schema)
        assert sorted((r.id, r.t) for r in got.collect()) == rows
    finally:
        spark.conf.set(key, usual)
