"""Annotated CSV files in, CSV and staged tables out."""

import codecs

import pytest
from helpers import as_dict, rows
from pyspark.sql import functions as F

from tonnage.plans.inputs import PREAMBLE, TABLE_SCHEMAS, read_table
from tonnage.sources import read_annotated, read_header, schemas, stage, write_csv
from tonnage.sources.schemas import schema
from tonnage.sources.staging import shared_folder

BOM = codecs.BOM_UTF8.decode("utf8")


def write(path, *lines, end="\r\n"):
    path.write_bytes(end.join(lines).encode("utf8"))
    return str(path)


STOCK = (
    BOM + "# File: stock.csv",
    "# Title: stock by country",
    "# Units: km, and GVA for transformers",
    '"# Description: lines, transformers, and more"',
    "# Source: made for this test",
    "# Column types: cnn",
    "# ----------",
    "Country,transmission,2017",
    'Alpha ,"6,347",0',
    '"Côte, the",-,12.5',
    "Beta,7,",
    "Total,6354,12.5",
)
SPEC = schema("cnn", "country", "km", "gva")


def test_preamble_bom_grouping_dash_and_trailing_space(spark, tmp_path):
    path = write(tmp_path / "a.csv", *STOCK)
    assert rows(read_annotated(spark, path, SPEC, skip=7)) == [
        ("Alpha", 6347.0, 0.0), ("Beta", 7.0, None), ("Côte, the", None, 12.5), ("Total", 6354.0, 12.5),
    ]
    assert read_header(spark, path, skip=7) == ["Country", "transmission", "2017"]


def test_a_folder_of_files_reads_as_one_table(spark, tmp_path):
    write(tmp_path / "a.csv", *STOCK)
    other = [line.replace("made for this test", "another note") for line in STOCK]
    write(tmp_path / "b.csv", *other, end="\n")
    paths = [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]
    assert read_annotated(spark, paths, SPEC, skip=7).count() == 8


def test_preamble_without_hash_and_no_preamble(spark, tmp_path):
    path = write(tmp_path / "i.csv", BOM + "income per head,,", "scenario,region,2015",
                 '"Ref,date=2022",North,0.5')
    table = read_annotated(spark, path, schema("ccn", "scenario", "region", "income_pc"), skip=1)
    assert rows(table) == [("Ref,date=2022", "North", 0.5)]
    path = write(tmp_path / "p.csv", '"resource","price_unit","year","price"', '"steel","$/kg",2020,0.1')
    assert rows(read_annotated(spark, path, schemas.PRICES)) == [("steel", "$/kg", 2020, 0.1)]


def test_only_the_first_lines_go(spark, tmp_path):
    """Rows that look like a note or the header are data."""
    lines = ["# note", "name,x", "#tag,1", "plain,2", "name,x", '"#quoted",3', "# note,4", "name,x"]
    path = write(tmp_path / "a.csv", *lines)
    spec = schema("cn", "name", "x")
    want = [("# note", 4.0), ("#quoted", 3.0), ("#tag", 1.0), ("name", None), ("name", None), ("plain", 2.0)]
    assert rows(read_annotated(spark, path, spec, skip=1)) == want
    (tmp_path / "many").mkdir()
    for i in range(3):
        write(tmp_path / "many" / f"{i}.csv", f"# note {i}", *lines[1:])
    found = read_annotated(spark, str(tmp_path / "many"), spec, skip=1)
    assert rows(found) == sorted(want * 3, key=lambda r: [(v is not None, str(v)) for v in r])


def test_a_large_file_is_split_and_loses_nothing(spark, conf, tmp_path):
    conf(spark__sql__files__maxPartitionBytes="64KB", spark__sql__files__openCostInBytes="1KB")
    lines = ["# n", "k,v", *[f"{i % 10},{i}" if i % 50 else "k,v" for i in range(40_000)]]
    table = read_annotated(spark, write(tmp_path / "big.csv", *lines, end="\n"), schema("cn", "k", "v"), skip=1)
    assert table.rdd.getNumPartitions() > 3
    assert table.count() == 40_000 and table.where("k = 'k'").count() == 800


def test_headers_of_a_folder_must_agree(spark, tmp_path):
    paths = [write(tmp_path / "a.csv", "name,x", "a,1"), write(tmp_path / "b.csv", "Name,x", "b,2")]
    with pytest.raises(ValueError, match="one header"):
        read_annotated(spark, paths, schema("cn", "name", "x"))
    with pytest.raises(ValueError, match="before its header"):
        read_annotated(spark, write(tmp_path / "c.csv", "# only a note"), schema("c", "a"), skip=1)


def test_text_and_missing_values_differ_in_the_export(spark, frame, tmp_path):
    df = frame([("NA", None, 1.0), (None, 1, float("inf")), ('say "x"', 2, float("nan"))], "s string, i int, x double")
    write_csv(df.coalesce(1), str(tmp_path / "out"), notes=["# one"])
    lines = [r.value for r in spark.read.text(str(tmp_path / "out")).collect()]
    assert lines == ["# one", '"s","i","x"', '"NA",NA,1.0', "NA,1,Inf", '"say ""x""",2,NaN']
    back = read_annotated(spark, str(tmp_path / "out"), schema("cin", "s", "i", "x"), skip=1)
    assert rows(back) == [(None, None, 1.0), (None, 1, float("inf")), ('say "x"', 2, "nan")]


def test_staged_tables_go(spark, frame):
    from pyspark.errors import AnalysisException

    from tonnage.sources.staging import release, staged

    with staged(frame([(1,)], "k int")) as table:
        files = table.inputFiles()
        assert table.count() == 1
    with pytest.raises(AnalysisException):
        spark.read.parquet(files[0])
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"
    kept = stage(frame([(1,)], "k int")).inputFiles()[0]
    assert release(spark) >= 1 and release(spark) == 0
    with pytest.raises(AnalysisException):
        spark.read.parquet(kept)


def test_quoted_header_with_comma(spark, tmp_path):
    path = write(tmp_path / "u.csv", "# note", 'region,"income, PPP",mineral ', "X,1,2")
    assert read_header(spark, path, 1) == ["region", "income, PPP", "mineral"]


def test_column_count_must_match(spark, tmp_path):
    path = write(tmp_path / "a.csv", "a,b", "1,2", "1,2,3,4")
    with pytest.raises(Exception, match="MALFORMED"):
        read_annotated(spark, path, schema("nn", "a", "b")).collect()
    with pytest.raises(ValueError, match="columns are declared"):
        read_annotated(spark, path, schema("nnn", "a", "b", "c"))


def test_unread_columns_are_not_parsed(spark, tmp_path):
    """Only the wanted fields of a line are converted."""
    path = write(tmp_path / "a.csv", *STOCK)
    table = read_annotated(spark, path, SPEC, skip=7).select("country")
    assert table.count() == 4
    assert "try_cast" not in table._jdf.queryExecution().optimizedPlan().toString()


def test_declared_schemas_cover_every_input():
    assert set(TABLE_SCHEMAS) == set(PREAMBLE)
    assert [f.dataType.simpleString() for f in schemas.HIERARCHY] == ["string", "string", "string", "int"]
    assert len(schemas.LINE_LENGTH) == 12
    with pytest.raises(ValueError, match="types"):
        schema("cc", "a")


def test_read_table_uses_the_table_layout(spark, tmp_path):
    lines = ["# note"] * 6 + ["id,name", "1,North", "2,South"]
    assert rows(read_table(spark, "regions", write(tmp_path / "r.csv", *lines))) == [(1, "North"), (2, "South")]


def test_csv_export(spark, frame, tmp_path):
    df = frame([("a, b", 2020, 1.5), ("c", 2025, None)], "region string, year int, cost double")
    path = str(tmp_path / "out")
    write_csv(df, path, {"cost": "input.cost"})
    text = spark.read.text(path)
    assert {r.value for r in text.collect()} >= {'"region","year","input.cost"', '"a, b",2020,1.5', '"c",2025,NA'}
    back = read_annotated(spark, path, schema("cin", "region", "year", "cost"))
    assert rows(back) == rows(df)


def test_stage_keeps_rows_types_and_odd_names(frame):
    df = frame([(1, None, 2.0), (2, "x", float("nan"))], "k int, `a b` string, `v.1` double")
    staged = stage(df)
    assert staged.schema == df.schema
    assert rows(staged) == rows(df)


def test_stage_uses_the_folder_the_session_names(spark, frame):
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert folder is None or shared_folder(spark) == folder.rstrip("/")
    assert shared_folder(spark) == shared_folder(spark)
    staged = stage(frame([(1, 2.0)], "k int, v double"))
    assert shared_folder(spark).split(":")[-1].rstrip("/") in staged.inputFiles()[0]


def test_staged_size_decides_on_the_broadcast(spark, conf):
    from helpers import plan

    from tonnage.operators import join_left

    small = stage(spark.range(500).select("id", F.rand(1).alias("w")))
    big = spark.range(1000).select("id", F.lit(1).alias("v"))
    assert "BroadcastHashJoin" in plan(join_left(big, small, ["id"]))
    conf(spark__sql__autoBroadcastJoinThreshold="1KB")
    assert "BroadcastHashJoin" not in plan(join_left(big, small, ["id"]))
    assert as_dict(join_left(big, small, ["id"]).groupBy("v").count(), "count", "v") == {1: 1000}


def jobs_of(spark, work):
    """What work returns, and how many jobs it ran."""
    context = spark.sparkContext
    group = f"count-{id(work)}"
    context.setJobGroup(group, "counted")
    try:
        out = work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    return out, len(context.statusTracker().getJobIdsForGroup(group))


def test_a_thousand_files_take_two_jobs(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    for i in range(1000):
        (folder / f"{i:04}.csv").write_text(f"# note {i}\nk,v\nk,v\n# note {i},{i}\n" if i % 100 else "# note\nk,v\n")
    table, jobs = jobs_of(spark, lambda: read_annotated(spark, str(folder), schema("cn", "k", "v"), skip=1))
    assert jobs == 2
    assert table.where("k = 'k' and v is null").count() == 990
    assert table.agg(F.sum("v")).first()[0] == sum(i for i in range(1000) if i % 100)
    assert table.count() == 1980


def test_small_files_of_a_split_folder_keep_their_lines(spark, conf, tmp_path):
    """Files of several blocks beside files of one, whatever the session packs together."""
    conf(spark__sql__files__maxPartitionBytes="4KB", spark__sql__files__openCostInBytes="1", spark__sql__files__maxPartitionNum="3")
    want = 0
    for i, n in enumerate((1, 3000, 0, 5, 2000)):
        write(tmp_path / f"{i}.csv", BOM + '"a note, quoted"', "", "k , v", *[f"x,{j}" for j in range(n)], end="\n")
        want += n
    (tmp_path / "empty.csv").write_text("")
    table = read_annotated(spark, str(tmp_path), schema("cn", "k", "v"), skip=2)
    assert table.count() == want and table.where("k <> 'x' or v is null").count() == 0
    assert spark.conf.get("spark.sql.files.openCostInBytes") == "1"
    assert spark.conf.get("spark.sql.files.maxPartitionNum") == "3"


def test_headers_may_be_spelled_differently_but_not_be_others(spark, tmp_path):
    write(tmp_path / "a.csv", 'k,"v"', "a,1")
    write(tmp_path / "b.csv", BOM + '"k" , v ', "b,2")
    spec = schema("cn", "k", "v")
    assert rows(read_annotated(spark, str(tmp_path), spec)) == [("a", 1.0), ("b", 2.0)]
    for other in ("k", "k,v,w", "v,k", ""):
        write(tmp_path / "c.csv", other, "c,3")
        with pytest.raises(ValueError, match="one header.*c.csv"):
            read_annotated(spark, str(tmp_path), spec)
    (tmp_path / "n").mkdir()
    write(tmp_path / "n" / "b.csv", "# note", "k,v", "a,1")
    write(tmp_path / "n" / "c.csv", "# only")
    with pytest.raises(ValueError, match="1 of 2 files end before"):
        read_annotated(spark, str(tmp_path / "n"), spec, skip=1)


def parts_of(path):
    return [p.read_text() for p in sorted(path.glob("part-*"))]


def test_parts_are_sorted_as_a_whole(spark, conf, frame, tmp_path):
    conf(spark__sql__adaptive__coalescePartitions__enabled="false")
    df = frame([((i * 7919) % 500 or None, f"r{i}") for i in range(500)], "k int, name string").repartition(6)
    write_csv(df, str(tmp_path / "one"), notes=["# n"], order=["k", "name"], one_head=True)
    parts = parts_of(tmp_path / "one")
    lines = "".join(parts).splitlines()
    assert len([p for p in parts if p]) > 2 and lines[:3] == ["# n", '"k","name"', 'NA,"r0"']
    assert [int(x.split(",")[0]) for x in lines[3:]] == list(range(1, 500))
    write_csv(df, str(tmp_path / "each"), order=["k"])
    parts = [p.splitlines() for p in parts_of(tmp_path / "each") if p]
    assert {p[0] for p in parts} == {'"k","name"'}
    assert [int(x.split(",")[0]) for p in parts for x in p[1:] if not x.startswith("NA")] == list(range(1, 500))


def test_a_table_without_rows_still_has_a_head(frame, tmp_path):
    write_csv(frame([], "k int"), str(tmp_path / "out"), order=["k"], one_head=True)
    assert "".join(parts_of(tmp_path / "out")) == '"k"\n'
    with pytest.raises(ValueError, match="order"):
        write_csv(frame([], "k int"), str(tmp_path / "x"), one_head=True)
    with pytest.raises(ValueError, match="no column"):
        write_csv(frame([], "k int"), str(tmp_path / "x"), order=["z"])


def test_only_partitions_at_hand_are_replaced(spark, frame, tmp_path):
    from tonnage.sources import read_partitions, write_partitions

    path = str(tmp_path / "table")
    first = frame([("007", 2000, 1.0), ("007", 2001, 2.0), (None, 2000, 3.0), ("b c/d", 2000, 4.0)], "code string, year int, v double")
    again = frame([("007", 2001, 9.0), ("007", 2001, 8.0), (None, 2000, 7.0), ("x", 2002, 6.0)], "code string, year int, v double")
    write_partitions(first, path, ["code", "year"])
    for _ in range(2):
        write_partitions(again, path, ["code", "year"])
        assert rows(read_partitions(spark, path, first.schema)) == rows(
            frame([("007", 2000, 1.0), ("007", 2001, 9.0), ("007", 2001, 8.0), (None, 2000, 7.0), ("b c/d", 2000, 4.0), ("x", 2002, 6.0)], "code string, year int, v double")
        )
    with pytest.raises(Exception, match="empty text"):
        write_partitions(frame([("", 1)], "code string, v int"), path, ["code"])
    with pytest.raises(ValueError, match="not all"):
        write_partitions(frame([("a", 1)], "code string, v int"), path, ["code", "v"])


def test_a_partition_has_few_files_and_a_hot_one_is_split(spark, conf, tmp_path):
    from tonnage.sources import write_partitions

    # Keys that share a shuffle partition with the hot one would be split with it.
    conf(spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB", spark__sql__shuffle__partitions="200")
    df = spark.range(0, 200_000, 1, 12).select(F.when(F.col("id") % 50 == 0, F.col("id") % 400).otherwise(1).alias("k"), F.rand(3).alias("v"))
    write_partitions(df, str(tmp_path / "t"), ["k"])
    files = {p.name: len(list(p.glob("part-*"))) for p in (tmp_path / "t").iterdir() if p.is_dir()}
    assert files.pop("k=1") > 3 and max(files.values()) <= 3
