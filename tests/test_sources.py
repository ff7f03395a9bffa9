"""Sources, transforms, streaming and publication on small files: what is refused, what an empty input gives, what a second run changes."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from palimpsest.operators import merge, publish, transforms
from palimpsest.queries import landings
from palimpsest.sources import ingest, raw
from palimpsest.streaming.landings import stream_merge

from .conftest import SF

NOW = datetime.datetime(2024, 2, 1)


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_landing_is_written_once_and_empty_ones_are_only_recorded(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, name string")
    load = raw.land_raw(df, str(tmp_path), "s", "d", "r1", NOW).first()
    assert (load["rows_downloaded"], load["rows_written"]) == (2, 2)
    with pytest.raises(Exception, match="already exists"):
        raw.land_raw(df, str(tmp_path), "s", "d", "r1", NOW)
    empty = raw.land_raw(df.limit(0), str(tmp_path), "s", "d", "r2", NOW, note="none today").first()
    assert empty["path"] is None and empty["rows_written"] == 0 and empty["note"] == "none today"
    got = raw.raw_snapshots(spark, str(tmp_path), "s", "d", None, {"act": "string"})
    assert got.filter("act IS NULL AND run_id = 'r1'").count() == 2
    assert [r["rows"] for r in raw.file_ledger(spark, str(tmp_path)).orderBy("rows").collect() if r["rows"]] != []


def test_snapshots_unite_by_name(spark, tmp_path):
    raw.land_raw(spark.createDataFrame([(1, "a")], "id long, name string"), str(tmp_path), "s", "d", "r1", NOW)
    raw.land_raw(spark.createDataFrame([(5, 2)], "size long, id long"), str(tmp_path), "s", "d", "r2", NOW)
    got = {r["id"]: (r["name"], r["size"]) for r in raw.raw_snapshots(spark, str(tmp_path), "s", "d").collect()}
    assert got == {1: ("a", None), 2: (None, 5)}


def test_watermark_of_nothing_keeps_all(spark):
    df = spark.createDataFrame([(datetime.date(2024, 1, 1),), (datetime.date(2024, 1, 9),)], "d date")
    assert raw.past_watermark(df, df.limit(0), "d", 3).count() == 2
    assert raw.past_watermark(df, df, "d", 3).count() == 1


def test_index_line_of_four_fields_raises(spark, tmp_path):
    head = "Description: index\n\nCIK|Name|Form|Date|File\n-----\n"
    good = write(tmp_path / "a" / "2024Q1.idx", head + "7|Firm|10-K|2024-01-02|edgar/data/7/x.txt\n")
    assert ingest.ingest_index(spark, good).first().asDict()["quarter"] == "2024Q1"
    bad = write(tmp_path / "b" / "2024Q1.idx", head + "7|Firm|10-K|2024-01-02\n")
    with pytest.raises(Exception, match="not five fields"):
        ingest.ingest_index(spark, bad).collect()


def test_submission_arrays_must_match(spark, tmp_path):
    recent = {"accessionNumber": ["a", "b"], "filingDate": ["2024-01-01", "2024-01-02"], "reportDate": ["", ""], "form": ["4", "8-K"], "items": ["", ""]}
    doc = {"cik": 7, "name": "Firm", "tickers": ["F"], "filings": {"recent": recent}}
    details, filings = ingest.ingest_submissions(spark, write(tmp_path / "a.json", json.dumps(doc, indent=1)))
    assert details.count() == 1 and [r["form"] for r in filings.orderBy("accessionNumber").collect()] == ["4", "8-K"]
    recent["form"] = ["4"]
    with pytest.raises(Exception, match="different lengths"):
        ingest.ingest_submissions(spark, write(tmp_path / "b.json", json.dumps(doc)))[1].collect()


def test_fact_values_stay_as_sent(spark, tmp_path):
    rows = [{"end": "2024-01-01", "val": 12345678901234567890, "accn": "x", "fy": 2024, "fp": "FY", "form": "10-K", "filed": "2024-02-01"}]
    doc = {"cik": 7, "entityName": "Firm", "facts": {"us-gaap": {"Assets": {"label": "A", "description": None, "units": {"USD": rows}}}}}
    facts, concepts, changes = ingest.ingest_companyfacts(spark, write(tmp_path / "a.json", json.dumps(doc)))
    assert facts.first()["val"] == "12345678901234567890" and concepts.first()["label"] == "A" and changes.first()["document_found"]
    facts, _, changes = ingest.ingest_companyfacts(spark, write(tmp_path / "b.json", json.dumps({"cik": 8, "facts": {}})))
    assert facts.count() == 0 and not changes.first()["document_found"]


def test_concepts_are_read_without_their_documents(spark, tmp_path):
    doc = {"cik": 7, "entityName": "Firm", "facts": {"dei": {}, "us-gaap": {"Assets": {"label": "A", "description": None, "units": {}}, "Cash": {"label": None, "description": "d", "units": {"USD": [{"end": "2024-01-01", "val": 1}]}}}}}
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, [doc, {"cik": 8}])))
    facts, concepts, changes = ingest.ingest_companyfacts(spark, str(tmp_path / "a.json"), multi_line=False)
    assert not any("json" in x._jdf.queryExecution().analyzed().toString() for x in (concepts, changes))
    assert sorted(map(tuple, concepts.collect())) == [(7, "Firm", "us-gaap", "Assets", "A", None), (7, "Firm", "us-gaap", "Cash", None, "d")]
    assert sorted(map(tuple, changes.collect())) == [(7, True), (8, False)] and facts.count() == 1


def test_truncated_macro_document_raises(spark, tmp_path):
    series = write(tmp_path / "s.json", json.dumps({"seriess": []}))
    doc = {"series_id": "GDP", "count": 2, "observations": [{"date": "2024-01-01", "realtime_start": "2024-02-01", "realtime_end": "9999-12-31", "value": "."}]}
    with pytest.raises(Exception, match="cut off: GDP"):
        ingest.ingest_fred(spark, write(tmp_path / "a.json", json.dumps(doc)), series)[0].collect()


def test_strict_csv_refuses_other_headers_bad_values_and_no_rows(spark, tmp_path):
    schema = "a int, b string"
    assert ingest.ingest_csv_strict(spark, write(tmp_path / "1.csv", "a,b\n1,x\n"), schema).count() == 1
    for n, text in enumerate(["b,a\nx,1\n", "a,b\nx,x\n", "a,b\n"]):
        with pytest.raises(Exception):
            ingest.ingest_csv_strict(spark, write(tmp_path / f"bad{n}.csv", text), schema).collect()


def test_optional_csv_needs_its_required_columns(spark, tmp_path):
    a, b = write(tmp_path / "a.csv", 'ID,Count\n1,"1,234"\n'), write(tmp_path / "b.csv", "other\n1\n")
    assert ingest.ingest_csv_optional(spark, [a], ["id"], {"id": "int", "count": "int", "gone": "string"}).first() == (1, 1234, None)
    with pytest.raises(ValueError, match="lacks"):
        ingest.ingest_csv_optional(spark, [a, b], ["id"], {"id": "int"})


def test_two_notes_of_one_series_raise(spark, tmp_path):
    series = '<Series COUNTRY="A" INDICATOR="G"><Obs TIME_PERIOD="2020" OBS_VALUE="1.5"/></Series>'
    note = '<Group COUNTRY="A" INDICATOR="G" NOTE="n"/>'
    general = '<Group INDICATOR="G" NOTE="all"/>'
    key = "_COUNTRY string, _INDICATOR string"
    read = lambda name, body: ingest.ingest_sdmx(spark, write(tmp_path / name, f"<DataSet>{body}</DataSet>"), key, "_TIME_PERIOD int, _OBS_VALUE double", f"{key}, _NOTE string")
    values, heads = read("a.xml", series + note + general)
    assert values.first()["obs_value"] == 1.5 and (heads.first()["note"], heads.first()["indicator_note"]) == ("n", "all")
    with pytest.raises(Exception, match="two groups"):
        read("b.xml", series + note + note)[1].collect()


def test_unknown_pull_reason_and_bad_text_raise(spark):
    with pytest.raises(Exception, match="unknown pull reason"):
        transforms.full_pull_flag(spark.createDataFrame([("odd",)], "pull_reason string")).collect()
    with pytest.raises(ValueError, match="no_start"):
        transforms.assert_catalog(spark.createDataFrame([("fred", "D", None)], "source string, frequency string, active_from date"), ["fred"], ["D"])
    with pytest.raises(ValueError, match="t_off"):
        transforms.assert_sums(spark.createDataFrame([(3, 1, 1)], "t int, a int, b int"), {"t": "a + b"})


def test_version_that_fails_its_count_is_not_served(spark, tmp_path):
    df = spark.range(5)
    publish.build_version(spark, str(tmp_path), "v1", {"t": df})
    with pytest.raises(ValueError, match="not published"):
        publish.build_version(spark, str(tmp_path), "v2", {"t": df}, {"t": 6})
    assert publish.current_version(spark, str(tmp_path)) == "v1" and publish.served(spark, str(tmp_path), "t").count() == 5


def test_stream_merge_equals_reading_all_landings_and_a_rerun_changes_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "r1"), (2, "b", "r1"), (1, "a", "r2"), (2, "c", "r2"), (3, None, "r2"), (2, "b", "r3")], "id long, v string, run_id string")
    at = lambda n: str(tmp_path / n)
    for run in ("r1", "r2", "r3", "none"):
        rows.filter(F.col("run_id") == run).write.parquet(f"{at('in')}/{run}")
        got = stream_merge(spark, at("in"), at("out"), at("state"), ["id"], ["run_id"], "id long, v string, run_id string")
    got = stream_merge(spark, at("in"), at("out"), at("state"), ["id"], ["run_id"], "id long, v string, run_id string")
    want = merge.merge_newest(rows, ["id"], ["run_id"])
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_changes_of_companyfacts_are_not_broadcast(spark):
    """The table of changes has a row for each document; its small files don't make it one to collect in the driver."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        plan = landings.a9_ingest_companyfacts(spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan and plan.count("SortMergeJoin") == 2
