import csv
import io
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from orderlens.sources import (
    COLUMNS,
    cancellation_rows,
    classify_lines,
    land,
    read_partitions,
    read_permissive,
    read_strict,
    require_columns,
    require_width,
    spread_rows,
    write_parquet,
    write_partitions,
    write_text,
)
from orderlens.sources.contract import HEADER_PREFIX, SPREAD_COLUMNS
from orderlens.sources.sinks import work_folder

HEADER = ",".join(COLUMNS)


def record(**fields):
    row = [fields.get(name.replace(" ", "_").replace("-", "_"), "") for name in COLUMNS]
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(row)
    return out.getvalue()


@pytest.mark.parametrize(
    "line, fault",
    [
        (HEADER, "header"),
        (record(index="1", promotion_ids="A , B", ship_city='5" gate, west'), None),
        (record(index="1", ship_city='mid 5" quote'), None),
        ("," * 23, None),
        ("," * 22, "wrong_column_count"),
        ("," * 24, "wrong_column_count"),
        ("", "bad_csv"),
        ('1,"open' + "," * 22, "bad_csv"),
        ("," * 23 + '"open', "bad_csv"),
        ('1,"a"b' + "," * 22, "bad_csv"),
        ('1,"a" ' + "," * 22, None),
        ('1,5" x 7",' + "," * 21, None),
        ('1,"a""b, ""c"' + "," * 22, None),
        ('"' + "," * 23 + '"', "wrong_column_count"),
    ],
)
def test_line_faults(spark, line, fault):
    lines = spark.createDataFrame([(line,)], "value string")
    assert classify_lines(lines).first()["fault"] == fault


def test_strict_read_splits_good_from_quarantined(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "\n".join(
            [
                HEADER,
                record(index="1", promotion_ids="A , B", ship_city='5" gate, west'),
                "1,2,3",
                HEADER,
                record(index="2", Amount=" 7 "),
                '"broken',
            ]
        )
    )
    (tmp_path / "b.csv").write_text(HEADER + "\n" + record(index="3") + "," + "\n\n")
    good, rejected = read_strict(spark, str(tmp_path))
    rows = {row["index"]: row for row in good.collect()}
    assert set(rows) == {"1", "2"}
    assert rows["1"]["promotion-ids"] == "A , B"
    assert rows["1"]["ship-city"] == '5" gate, west'
    assert rows["2"]["Amount"] == " 7 "
    assert good.columns == list(COLUMNS)
    faults = sorted(row["fault"] for row in rejected.collect())
    assert faults == ["bad_csv", "bad_csv", "wrong_column_count", "wrong_column_count"]


def test_permissive_read_pads_and_cuts(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        "\n".join([HEADER, "1,x", record(index="2", promotion_ids="A,B") + ",more"])
    )
    frame = require_width(read_permissive(spark, str(tmp_path)))
    rows = {row["index"]: row for row in frame.collect()}
    assert rows["1"]["Order ID"] == "x" and rows["1"]["Date"] is None
    assert rows["2"]["promotion-ids"] == "A,B"


def test_contract_errors_name_every_missing_column(spark):
    frame = spark.createDataFrame([("1", "x")], "index string, Date string")
    with pytest.raises(ValueError, match="'SKU', 'Amount', 'promotion-ids'"):
        require_columns(frame, SPREAD_COLUMNS)
    with pytest.raises(ValueError, match="2 columns in place of 24"):
        require_width(frame)
    assert require_columns(frame, ["index"]) is frame


def test_header_prefix_matches_contract():
    assert HEADER.startswith(HEADER_PREFIX)


def test_spread_rows_drop_rows_without_id_date_or_sku(raw):
    base = {"index": "1", "Date": "04-30-22", "SKU": " a ", "Amount": "", "promotion-ids": "A,,B"}
    rows = [
        base,
        {**base, "index": "x"},
        {**base, "Date": "02-30-22"},
        {**base, "SKU": "  "},
        {**base, "SKU": None},
    ]
    assert [tuple(r) for r in spread_rows(raw(rows)).collect()] == [(1, "a", "2022-04", None, 2)]


def test_lenient_scan_reads_only_the_columns_a_job_needs(spark, tmp_path):
    (tmp_path / "a.csv").write_text(HEADER + "\n" + record(index="1"))
    prepared = cancellation_rows(read_permissive(spark, str(tmp_path)))
    plan = prepared.select("city", "status")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Status:string,ship-city:string>" in plan


def test_sinks_replace_output_and_keep_order(spark, tmp_path):
    path = str(tmp_path / "out")
    frame = spark.range(50).select(
        (50 - F.col("id")).alias("k"), F.when(F.col("id") > 0, "v").alias("v")
    )
    write_text(frame.limit(3), path)
    write_text(frame.repartition(3), path, order_by=["k"])
    files = sorted((tmp_path / "out").glob("part-*"))
    lines = [line for part in files for line in part.read_text().splitlines()]
    assert lines == [f"{k},v" for k in range(1, 50)] + ["50,"]
    write_parquet(frame, path, single_file=True)
    assert len(list((tmp_path / "out").glob("part-*.parquet"))) == 1
    assert land(frame, str(tmp_path / "landed")).count() == 50


def test_work_folder_follows_the_shared_setting():
    def session(master, settings):
        context = SimpleNamespace(master=master, applicationId="app-1")
        conf = SimpleNamespace(
            get=lambda key, default: settings.get(key, default), set=settings.__setitem__
        )
        return SimpleNamespace(sparkContext=context, conf=conf)

    shared = session("yarn", {"spark.checkpoint.dir": "/shared/points/"})
    first, second = work_folder(shared, "x"), work_folder(shared, "x")
    assert first.startswith("/shared/points/orderlens/app-1/x-") and first != second
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(session("yarn", {}), "x")
    settings = {}
    assert work_folder(session("local[2]", settings), "x").startswith("/tmp/checkpoints/")
    assert settings == {"spark.checkpoint.dir": "/tmp/checkpoints"}


def test_long_and_odd_quoted_fields_do_not_stop_the_reader(spark):
    tail = ",x" * 22
    long_field = '"' + '""' * 20_000 + '"'
    lines = [f"1,{long_field}{tail}", f"1,\u0001abc,\"q, r\"{tail[2:]}", f'1,"a"b{tail}', f'1,"open{tail}', f'1,""{tail}']
    frame = classify_lines(spark.createDataFrame([(line,) for line in lines], "value string"))
    assert [r["fault"] for r in frame.collect()] == [None, None, "bad_csv", "bad_csv", None]


def test_a_rewritten_value_leaves_the_others_files(spark, tmp_path):
    path = str(tmp_path / "out")
    frame = spark.range(60).select(F.concat(F.lit("2022-0"), F.col("id") % 3 + 1).alias("month"), "id")
    frame = frame.withColumn("month", F.when(F.col("id") > 2, F.col("month")))
    files = lambda: {str(f.relative_to(path)): f.stat().st_mtime_ns for f in (tmp_path / "out").glob("month=*/*.parquet")}
    write_partitions(frame, path, ["month"], order_by=["id"])
    before = files()
    assert len({f.split("/")[0] for f in before}) == 4
    write_partitions(spark.createDataFrame([("2022-02", 7), ("2022-04", 8)], frame.schema), path, ["month"])
    after = files()
    assert {f: t for f, t in before.items() if "2022-02" not in f}.items() <= after.items()
    assert not any(f in after for f in before if "2022-02" in f)
    found = sorted(map(tuple, read_partitions(spark, path, frame.schema).collect()), key=str)
    expected = [(m, i) for m, i in map(tuple, frame.collect()) if m != "2022-02"] + [("2022-02", 7), ("2022-04", 8)]
    assert found == sorted(expected, key=str)
    write_partitions(frame.limit(0), path, ["month"])
    assert files() == after
    with pytest.raises(Exception, match="blank month"):
        write_partitions(frame.withColumn("month", F.lit("")), path, ["month"])
    assert files() == after


def test_stored_values_are_sorted_and_pruned(spark, tmp_path):
    path = str(tmp_path / "out")
    frame = spark.range(5000).select((F.col("id") % 2).cast("string").alias("month"), (-F.col("id")).alias("id"))
    write_partitions(frame.repartition(5), path, ["month"], order_by=["id"])
    for part in (tmp_path / "out").glob("month=*/*.parquet"):
        ids = [r["id"] for r in spark.read.parquet(str(part)).collect()]
        assert ids == sorted(ids)
    plan = read_partitions(spark, path, frame.schema).where("month = '1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
