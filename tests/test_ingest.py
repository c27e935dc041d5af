"""Parsing, routing and the ingest job."""

import pytest

from proxysift import JobParams, schemas
from proxysift import operators as op
from proxysift.__main__ import parse_args
from proxysift.plans import run_job

FIELDS = [
    "<134>gw--sg1", "proxy", "2018-07-01", "2018-07-01T12:00:00+0000", "12:00:00", "35", "10.0.0.1",
    "user1", '"Domain  Users"', "-", "OBSERVED", '"News;Search Engines"', "-", "200", "TCP_MISS",
    "GET", "text/html", "http", "www.shop.com", "443", "/a", "?q=1", "html", '"Agent 1 (X11)"',
    "10.9.9.9", "99999999999", "512", "-", '"none"', '"none"',
]
GOOD = " ".join(FIELDS)
QUOTES = GOOD.replace('(X11)"', "(X11)")
SHORT = GOOD.rsplit(" ", 1)[0]
BAD_TIME = GOOD.replace("2018-07-01T12", "2018-07-01X12")


def lines_of(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def write_lines(spark, path, *lines):
    lines_of(spark, *lines).coalesce(1).write.text(str(path))
    return str(path)


def test_outcome_of_each_line(spark):
    parsed = op.parse_lines(lines_of(spark, GOOD, "   ", QUOTES, SHORT, BAD_TIME))
    found = {row.raw: (row.error, row.stage) for row in parsed.collect()}
    assert found == {
        GOOD: (None, None),
        QUOTES: ("Unbalanced quotes", "parser"),
        SHORT: ("Columns != 31", "parser"),
        BAD_TIME: ("Invalid timestamp", "convertToTargetTZ"),
    }


def test_faults_are_named_in_order(spark):
    all_wrong = BAD_TIME.replace('(X11)"', "(X11)").rsplit(" ", 1)[0]
    short_and_late = BAD_TIME.rsplit(" ", 1)[0]
    rejects = op.rejected(op.parse_lines(lines_of(spark, all_wrong, short_and_late)))
    assert sorted(row.error for row in rejects.collect()) == ["Columns != 31", "Unbalanced quotes"]


def test_record_table(spark):
    row = op.cast_columns(op.record_table(op.parse_lines(lines_of(spark, GOOD)))).first().asDict()
    assert list(row) == [*schemas.PROXY_FIELDS, *schemas.TIME_FIELDS, "event_date"]
    assert row["time"] == row["orig_timestamp"] == "2018-07-01T12:00:00+0000"
    assert row["syslog_timestamp"] == "2018-07-01T12:00:00"
    assert row["iso_timestamp"] == "2018-07-01T08:00:00.000-04:00"
    assert row["cs_auth_group"] == '"Domain Users"'
    assert (row["time_taken"], row["sc_bytes"], row["event_date"]) == (35, 99999999999, "20180701")


def test_casts_give_null(spark):
    df = spark.createDataFrame(
        [("-", "12", "12.5", "99999999999", "x")],
        "time_taken string, sc_status string, cs_uri_port string, sc_bytes string, cs_bytes string",
    )
    assert tuple(op.cast_columns(df).first()) == (None, 12, None, 99999999999, None)


def test_timestamp_position_by_source():
    names = ["Proxy", "BlueCoat", "Infobox", "FireEye", "Panlogs", "Snare", "Other"]
    assert [op.timestamp_index(name) for name in names] == [0, 0, 4, 4, 4, 7, 4]


def test_time_enrichment_variants(spark):
    accepted = op.accepted(op.parse_lines(lines_of(spark, GOOD)))
    with_original = op.with_converted_time(accepted)
    without = op.with_converted_time(accepted, zone="UTC", keep_original=False)
    assert with_original.columns[-3:] == list(schemas.TIME_FIELDS)
    assert without.columns[-2:] == list(schemas.TIME_FIELDS[1:])
    assert without.first().iso_timestamp == "2018-07-01T12:00:00.000+00:00"


def test_job_writes_both_outputs(spark, tmp_path):
    source = write_lines(spark, tmp_path / "in", GOOD, GOOD, "", " ", QUOTES, SHORT, BAD_TIME)
    params = JobParams("Proxy", in_path=source, out_path=str(tmp_path / "out"))
    result = run_job(spark, params)
    table, rejects = spark.read.parquet(params.out_path), spark.read.parquet(params.invalid_path)
    assert (result.valid, result.invalid) == (table.count(), rejects.count()) == (2, 3)
    assert [p.name for p in (tmp_path / "out").glob("event_date=*")] == ["event_date=20180701"]
    assert rejects.columns == schemas.REJECTS.names
    partitioned = {f.name: f.dataType for f in table.schema}
    expected = {f.name: f.dataType for f in schemas.PARSED if f.name != "event_date"}
    assert expected.items() <= partitioned.items() and "time" not in partitioned


def test_empty_outputs_are_not_written(spark, tmp_path):
    good = JobParams("Proxy", in_path=write_lines(spark, tmp_path / "g", GOOD), out_path=str(tmp_path / "go"))
    bad = JobParams("Proxy", in_path=write_lines(spark, tmp_path / "b", SHORT), out_path=str(tmp_path / "bo"))
    none = JobParams("Proxy", in_path=write_lines(spark, tmp_path / "n", " "), out_path=str(tmp_path / "no"))
    assert [run_job(spark, p).invalid for p in (good, bad, none)] == [0, 1, 0]
    written = sorted(p.name for p in tmp_path.iterdir())
    assert written == ["b", "bo_invalid", "g", "go", "n"]


def test_save_modes(spark, tmp_path):
    source = write_lines(spark, tmp_path / "in", GOOD, SHORT)

    def job(mode):
        return run_job(spark, JobParams("Proxy", in_path=source, out_path=str(tmp_path / "out"), save_mode=mode))

    def rows():
        return spark.read.parquet(str(tmp_path / "out")).count()

    job("error")
    with pytest.raises(Exception, match="already exists"):
        job("error")
    assert job("append").valid == 1 and rows() == 2
    assert job("ignore").invalid == 1 and rows() == 2
    job("overwrite")
    assert rows() == 1


def test_outputs_agree_in_every_save_mode(spark, tmp_path):
    mixed, clean = write_lines(spark, tmp_path / "m", GOOD, SHORT), write_lines(spark, tmp_path / "c", GOOD)
    bad = write_lines(spark, tmp_path / "b", SHORT)
    out, rejects = str(tmp_path / "out"), str(tmp_path / "out_invalid")

    def job(source, mode):
        return run_job(spark, JobParams("Proxy", in_path=source, out_path=out, save_mode=mode))

    job(mixed, "overwrite")
    assert job(clean, "overwrite").invalid == 0
    assert spark.read.parquet(rejects).count() == 0 and spark.read.parquet(out).count() == 1
    assert job(bad, "overwrite").valid == 0
    assert spark.read.parquet(rejects).count() == 1 and spark.read.parquet(out).count() == 0
    other = str(tmp_path / "new")
    spark.read.parquet(rejects).write.parquet(other + "_invalid")
    with pytest.raises(FileExistsError, match="new_invalid"):
        run_job(spark, JobParams("Proxy", in_path=mixed, out_path=other))
    assert not (tmp_path / "new").exists()


def test_placeholders_do_not_reach_the_analysis(spark):
    line = GOOD.replace("?q=1", "-").replace("www.shop.com", "-", 1)
    parsed = op.parse_lines(lines_of(spark, GOOD, line))
    adapted = op.adapt_for_analysis(op.cast_columns(op.record_table(parsed)))
    assert adapted.where("csHost = '-' OR csUriQuery = '-'").count() == 0


def test_other_output_format_and_options(spark, tmp_path):
    source = write_lines(spark, tmp_path / "in", GOOD)
    params = JobParams(
        "Proxy", out_format="csv", in_path=source, out_path=str(tmp_path / "out"),
        out_options={"header": "true", "sep": ";"},
    )
    run_job(spark, params)
    read = spark.read.csv(params.out_path, header=True, sep=";")
    assert read.first().c_ip == "10.0.0.1"


def test_unknown_parser(spark):
    with pytest.raises(ValueError, match="DNS"):
        run_job(spark, JobParams("DNS"))


def test_command_line():
    params = parse_args(
        "-p Proxy -i text -o parquet -s /in -d /out -m append --input-options a=1,b=2 "
        "--output-options compression=zstd".split()
    )
    assert params == JobParams(
        "Proxy", "text", "parquet", "/in", "/out", "append", {"a": "1", "b": "2"}, {"compression": "zstd"}
    )
    with pytest.raises(SystemExit):
        parse_args(["-p", "Proxy"])


def test_csv_repair(spark):
    lines = ['1,"x, y",z', "1,2", '1,"open,3', '4,\\"q, r\\",s', '5,"a ""b""",c', "6,,", "1,2,3,4"]
    rows, rejects = op.parse_csv(lines_of(spark, *lines), ["a", "b", "c"])
    assert sorted(map(tuple, rows.collect())) == [
        ("1", "x, y", "z"), ("4", "q, r", "s"), ("5", "a ''b''", "c"), ("6", "", ""),
    ]
    assert sorted(row.line for row in rejects.collect()) == ["1,\"open,3", "1,2", "1,2,3,4"]


def test_adapter_feeds_the_analysis(spark):
    table = op.cast_columns(op.record_table(op.parse_lines(lines_of(spark, GOOD))))
    adapted = op.adapt_for_analysis(table)
    assert adapted.schema.names == schemas.ANALYSIS_INPUT.names
    clean = op.clean_records(adapted).first()
    assert (clean.p_date, clean.fulluri, clean.respcode) == ("2018-07-01", "www.shop.com/a?q=1", "200")
