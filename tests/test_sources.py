import json

import pytest
from pyspark.sql import functions as F

from tallyframe.session import scratch_path, shared_folder
from tallyframe.sources import records, tables
from tallyframe.streaming.scoring import run_available, start_with_rejects, stream_records, write_batch


def test_csv_quirks(spark, tmp_path):
    path = tmp_path / "raw.csv"
    header = ",".join(tables.REPORT_SCHEMA.names)
    row = ['2015-05-22', 'UI', 'NA', '"two\nlines"', '"say ""hi"", ok"', 'null', '', 'fixed', '1', 'closed', '4',
           '2015-05-27', '0', 'NA', '2015-05-27', '2', 'normal', '2']
    path.write_text(header + "\n" + ",".join(row) + "\n")
    got = tables.read_csv(spark, str(path), tables.REPORT_SCHEMA).first()
    assert got["product_name"] is None and got["assignee_name"] is None and got["reporter_name"] is None
    assert got["short_description"] == "two\nlines" and got["long_description"] == 'say "hi", ok'
    assert got["quantity_of_comments"] is None and got["status_code"] == 4
    assert got["creation_date"] == "2015-05-22"
    inferred = tables.read_csv(spark, str(path))
    assert dict(inferred.dtypes)["status_code"] == "bigint"
    row[10] = "four"
    path.write_text(header + "\n" + ",".join(row) + "\n")
    assert tables.read_csv(spark, str(path), tables.REPORT_SCHEMA, invalid="null").first()["status_code"] is None
    with pytest.raises(Exception, match="status_code is no bigint: four"):
        tables.read_csv(spark, str(path), tables.REPORT_SCHEMA).collect()


def test_types_are_inferred_after_null_tokens(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("i,d,b,s,n\nn/a,1.5,true,x,\n2,NaN,False,1,NA\n-3,4,null,,n/a\n")
    got = tables.read_csv(spark, str(path))
    assert dict(got.dtypes) == {"i": "bigint", "d": "double", "b": "boolean", "s": "string", "n": "string"}
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(None, 1.5, True, "x", None), (2, None, False, "1", None), (-3, 4.0, None, None, None)], key=str)


def test_rejected_records(spark, tmp_path):
    rows = spark.createDataFrame([(1, "no json"), (2, None), (3, "[1]"), (4, "{}"), (5, '{"status_code": 9')], "k int, value string")
    got = {r.k: r for r in records.parse_records(rows, keep=("k",), invalid="null").collect()}
    assert {k for k, r in got.items() if r.rejected is not None} == {1, 2, 3, 5}
    assert all(got[k][c] is None for k in (1, 2, 3, 5) for c in records.RECORD_DEFAULTS)
    assert {c: got[4][c] for c in records.RECORD_DEFAULTS} == records.RECORD_DEFAULTS
    with pytest.raises(Exception, match="not a JSON object"):
        records.parse_records(rows.where("k = 1")).collect()
    path = tmp_path / "r.json"
    path.write_text('{"status_code": 7}\nbroken\n')
    read = records.read_records(spark, str(path), invalid="null").collect()
    assert sorted(r.rejected or "" for r in read) == ["", "broken"]


@pytest.mark.parametrize("format", ["csv", "parquet"])
def test_table_round_trip(spark, tmp_path, reports, format):
    path = tables.write_table(reports, str(tmp_path), "final_selection", format)
    options = {"schema": reports.schema} if format == "csv" else {}
    back = tables.read_table(spark, path, format, **options)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, reports.collect()))
    with pytest.raises(ValueError):
        tables.write_table(reports, str(tmp_path), "x", "xml")


def test_records(spark, tmp_path):
    path = tmp_path / "r.json"
    path.write_text("\n".join(json.dumps(r) for r in (
        {"component_name": "core", "status_code": "6", "bug_fix_time": 5}, {"severity_code": None}, {})))
    got = records.read_records(spark, str(path)).orderBy(F.desc("bug_fix_time")).collect()
    assert got[0].asDict() == {**records.RECORD_DEFAULTS, "component_name": "core", "status_code": 6, "bug_fix_time": 5}
    assert got[1].asDict() == got[2].asDict() == records.RECORD_DEFAULTS
    bad = spark.createDataFrame([('{"status_code": "six"}',)], "value string")
    assert records.parse_records(bad, invalid="null").first()["status_code"] is None
    with pytest.raises(Exception, match="status_code is not an integer"):
        records.parse_records(bad).collect()


def test_streamed_records_equal_batch(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(json.dumps({"component_name": f"c{i}", "status_code": str(i)}))
    stream = stream_records(spark, str(tmp_path), max_files=1)
    streamed = run_available(stream, lambda rows: rows, "records")
    batch = records.read_records(spark, str(tmp_path))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, batch.collect()))


def test_rejected_records_of_a_stream(spark, tmp_path):
    """Two sinks; a batch that is written again adds nothing, and a restart goes on."""
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    (source / "0.json").write_text('{"component_name": "a"}\nbroken\n')
    keep = {"output": f"{out}/scored", "rejected": f"{out}/rejected"}

    def run():
        stream = stream_records(spark, str(source), max_files=1, invalid="null")
        start_with_rejects(stream, lambda rows: rows.select("component_name"), progress=f"{out}/p", **keep).awaitTermination()

    def found():
        return (sorted(r.component_name for r in spark.read.parquet(keep["output"]).collect()),
                sorted(r.rejected for r in spark.read.parquet(keep["rejected"]).collect()))

    run()
    assert found() == (["a"], ["broken"])
    batch = records.read_records(spark, str(source), invalid="null")
    write_batch(batch, 0, lambda rows: rows.select("component_name"), **keep)
    run()
    assert found() == (["a"], ["broken"])
    (source / "1.json").write_text('[1]\n{"component_name": "b"}\n{"component_name": "c"}\n')
    run()
    assert found()[0] == ["a", "b", "c"] and len(found()[1]) == 2
    with pytest.raises(ValueError, match="not a stream"):
        start_with_rejects(batch, lambda rows: rows, progress=f"{out}/q", **keep)


def test_only_small_tables_are_spread(spark, reports, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    assert tables.spread(reports.coalesce(1)).rdd.getNumPartitions() == cores
    assert tables.spread(wide := reports.repartition(cores + 3)) is wide
    monkeypatch.setattr(tables, "SMALL_PARTITIONS", 2)
    assert tables.spread(some := reports.repartition(3)) is some


def test_scratch_paths_are_fresh_and_shared(spark):
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert scratch_path(spark, "a").startswith(shared_folder(spark).rstrip("/"))


def test_types_are_those_of_plain_casts(spark):
    texts = ["1", "-7", "+3", " 4 ", "\t5\n", "2.5", ".5", "5.", "1e3", "-Infinity", "inf", "NaN", "0x1p3", "true", "F", " yes ",
             "No", "T\r", "x1", "1x", "12 13", "--1", "", "-", "9223372036854775808", "1L", "1.0", "3d", "\x0b6", "y\x1f", "٣"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for kind, pattern in tables.LOOKS_LIKE.items():
        lost = df.where(F.col("t").try_cast(kind).isNotNull() & ~F.col("t").rlike(pattern)).collect()
        assert lost == [], kind
    for text, kind in (("7", "bigint"), ("7.5", "double"), ("yes", "boolean"), ("x", "string")):
        assert tables.infer_types(df.where(F.col("t") == "1").select(F.lit(text).alias("c"))) == {"c": kind}


def test_inferred_texts_are_parsed_once(spark, tmp_path):
    (tmp_path / "a.csv").write_text("n,t\n1,x\n2,y\n")
    plan = tables.read_csv(spark, str(tmp_path))._jdf.queryExecution().toString()
    assert "from_csv" not in plan and "MapInArrow" not in plan
