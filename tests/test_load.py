"""Text exports to warehouse tables."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from carelattice.functions.dates import lenient_timestamp
from carelattice.operators import quality
from carelattice.plans import load, readmission
from carelattice.schemas import TABLES
from carelattice.sources import text_tables
from carelattice.sources.warehouse import Warehouse

# Small exports: header blanks, missing-value texts, a quoted line break, bad values, copies.
FILES = {
    "patients": "Id, BIRTHDATE ,DEATHDATE,FIRST,LAST,SSN,GENDER,RACE,ETHNICITY,MARITAL,CITY,STATE,COUNTY,ZIP,LAT,LON\n"
    "p1,1980-01-01,,Ann1,Lee2,999-11-2222,F,white,NA,M,Provo,Utah,Utah County,00501,40.1234567,-111.5\n"
    'p2,1990-05-05,2020-01-01,"Bo ""B""",Ray,,M,null,x,,"Salt\nLake",Utah,SL,84101,bad,1\n',
    "organizations": "Id,NAME,CITY,STATE,ZIP\no1,Clinic,Provo,UT,84601\n",
    "encounters": "Id,START,STOP,PATIENT,ORGANIZATION,ENCOUNTERCLASS,CODE,DESCRIPTION,BASE_ENCOUNTER_COST,TOTAL_CLAIM_COST,"
    "PAYER_COVERAGE\n"
    "e1,2020-01-01T10:00:00Z,2020-01-02T10:00:00Z,p1,o1,inpatient,11,Stay,10.555,20.5,0\n"
    "e2,2020-01-20 09:00:00,2020-01-21 09:00:00,p1,o9,inpatient,11,Stay,1,2,3\n"
    "e3,soon,,p3,o1,ambulatory,12,Visit,1,2,3\n",
    "conditions": "START,STOP,PATIENT,ENCOUNTER,SYSTEM,CODE,DESCRIPTION\n"
    "2019-12-31,,p1,e1,SNOMED-CT,44054006,Diabetes\n"
    "2019-12-31,,p1,e1,SNOMED-CT,44054006,Diabetes\n"
    "2020-01-05,2020-02-01,p2,e2,SNOMED-CT,11,Earlier text\n"
    "2020-01-05,,p2,e2,SNOMED-CT,,No code\n",
    "procedures": "START,STOP,PATIENT,ENCOUNTER,SYSTEM,CODE,DESCRIPTION,BASE_COST\n"
    "2020-01-01T11:00:00Z,,p1,e1,SNOMED-CT,71,Scan,5\n",
    "medications": "START,STOP,PATIENT,ENCOUNTER,CODE,DESCRIPTION,BASE_COST,DISPENSES,TOTALCOST\n"
    "2020-01-01T12:00:00Z,,p1,e1,11,Pill,1.1,3,3.3\n",
    "observations": "DATE,PATIENT,ENCOUNTER,CATEGORY,CODE,DESCRIPTION,VALUE,UNITS\n"
    "2020-01-01T09:00:00Z,p1,e1,vital,39156-5,BMI,31.5,kg/m2\n"
    "2020-01-01T09:00:00Z,p1,e1,survey,99999-9,Other,1,x\n",
}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("export")
    for name, text in FILES.items():
        (path / f"{name}.csv").write_text(text)
    return str(path)


def test_text_scan(spark, folder):
    assert text_tables.has_quoted_line_breaks(spark, f"{folder}/patients.csv")
    assert not text_tables.has_quoted_line_breaks(spark, f"{folder}/encounters.csv")
    rows = text_tables.read_text_table(spark, f"{folder}/patients.csv").collect()
    assert "BIRTHDATE" in rows[0].asDict()
    assert (rows[0]["ZIP"], rows[0]["ETHNICITY"], rows[1]["RACE"]) == ("00501", None, None)
    assert (rows[1]["FIRST"], rows[1]["CITY"], rows[1]["SSN"]) == ('Bo "B"', "Salt\nLake", None)
    people = text_tables.read_people(spark, f"{folder}/patients.csv")
    assert people.columns == ["patient_id", "dob", "first", "last", "ssn", "zip"]


def test_load_warehouse(spark, folder, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    counts = {r["table"]: r["rows"] for r in load.load_warehouse(spark, folder, wh, single_line=["encounters"]).collect()}
    assert counts == {
        "dim_patient": 2,
        "dim_organization": 1,
        "dim_code": 6,
        "fact_encounter": 3,
        "fact_condition": 4,
        "fact_procedure": 1,
        "fact_medication": 1,
        "fact_observation": 1,
    }
    for name, columns in TABLES.items():
        assert dict(wh.read(name).dtypes) == columns
    e = {r["encounter_id"]: r for r in wh.read("fact_encounter").collect()}
    assert str(e["e1"]["base_cost"]) == "10.56" and e["e3"]["start_ts"] is None
    assert sorted(r["condition_id"] for r in wh.read("fact_condition").collect()) == [1, 2, 3, 4]
    codes = {(r["code_system"], r["code"]): r["description"] for r in wh.read("dim_code").collect()}
    # Conditions come before encounters; medications have their own system.
    assert codes["SNOMED-CT", "11"] == "Earlier text" and codes["RxNorm", "11"] == "Pill"
    assert ("LOINC", "99999-9") not in codes

    orphans = {(r["table"], r["columns"]): r["orphan_rows"] for r in quality.orphan_report(wh.tables()).collect()}
    assert orphans["fact_encounter", "patient_id"] == 1
    assert orphans["fact_encounter", "organization_id"] == 1
    assert orphans["fact_condition", "code_system,code"] == 0
    keys = {r["table"]: r for r in quality.key_report(wh.tables()).collect()}
    assert keys["fact_encounter"]["rows_missing_required"] == 1 and keys["dim_code"]["duplicate_keys"] == 0

    frame = {r["encounter_id"]: r for r in readmission.training_frame(wh.tables()).collect()}
    assert set(frame) == {"e1", "e2"}
    assert (frame["e1"]["readmitted_30d"], frame["e1"]["bmi"], frame["e1"]["chronic_condition_count"]) == (1, 31.5, 2)

    wh.append("fact_procedure", wh.read("fact_procedure"))
    assert wh.read("fact_procedure").count() == 2


def test_empty_table_keeps_its_schema(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    empty = spark.createDataFrame([], "organization_id string, name string, city string, state string, zip string")
    wh.write("dim_organization", empty)
    assert wh.read("dim_organization").count() == 0
    assert list(dict(wh.read("dim_organization").dtypes)) == list(TABLES["dim_organization"])


def test_catalog_location(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS wh_test")
    wh = Warehouse(spark, "catalog:wh_test")
    wh.write("notes", spark.createDataFrame([(1,)], "n int"))
    wh.append("notes", spark.createDataFrame([(2,)], "n int"))
    assert wh.read("notes").count() == 2
    spark.sql("DROP DATABASE wh_test CASCADE")


def test_parse_report(spark, folder):
    raw = text_tables.read_exports(spark, folder, load.export_columns())
    bad = {(r["table"], r["column"]): r["unparsed"] for r in load.parse_report(raw).collect() if r["unparsed"]}
    assert bad == {("fact_encounter", "start_ts"): 1, ("dim_patient", "lat"): 1}


def test_lenient_timestamps(spark):
    texts = ["2020-01-31T05:00:00Z", "2020-01-31 05:00:00", "2020-01-31T05:00:00+02:00", "01/31/2020", "12:30", "x", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["s"] for r in df.select("i", lenient_timestamp(F.col("t")).cast("string").alias("s")).orderBy("i").collect()]
    five = "2020-01-31 05:00:00"
    assert got == [five, five, "2020-01-31 03:00:00", "2020-01-31 00:00:00", None, None, None]


def test_csv_round_trip(spark, tmp_path):
    rows = [("B-1", 'say "x"', None, "1980-01-01", None, "00501"), ("B-2", "two\nlines", "l", "d", "s", "z")]
    df = spark.createDataFrame(rows, "system_b_id string, first string, last string, dob string, ssn string, zip string")
    path = os.path.join(str(tmp_path), "b")
    text_tables.write_csv(df, path)
    assert sorted(map(tuple, text_tables.read_second_list(spark, path).collect()), key=str) == sorted(rows, key=str)
    truth = spark.createDataFrame([("B-1", "p")], "system_b_id string, true_patient_id string")
    truth.write.parquet(f"{tmp_path}/truth.parquet")
    assert text_tables.read_truth(spark, f"{tmp_path}/truth.parquet", "parquet").count() == 1


def test_code_aliases(spark, folder):
    raw = text_tables.read_exports(spark, folder, load.export_columns())
    merged = load.code_dimension(raw, aliases={"RxNorm": "SNOMED-CT"})
    codes = {(r["code_system"], r["code"]): r["description"] for r in merged.collect()}
    assert codes["SNOMED-CT", "11"] == "Earlier text" and len(codes) == 5


def test_dates_are_dates(spark, folder):
    raw = text_tables.read_exports(spark, folder, load.export_columns())
    rows = {r["patient_id"]: r for r in load.typed_table(raw, "dim_patient").collect()}
    assert rows["p2"]["death_date"] == dt.date(2020, 1, 1) and rows["p1"]["death_date"] is None


def test_files_with_other_column_order_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "b.csv").write_text("y,x\n2,1\n")
    with pytest.raises(Exception, match="header"):
        text_tables.read_text_table(spark, str(tmp_path)).collect()


def test_stray_quote_does_not_swallow_lines_declared_plain(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,5" pipe\n2,b\n')
    rows = text_tables.read_text_table(spark, str(tmp_path / "a.csv"), multiline=False).collect()
    assert [tuple(r) for r in rows] == [("1", '5" pipe'), ("2", "b")]


def test_concepts_are_made_distinct_before_anything_is_sorted(spark):
    """Facts of the sources meet a hash aggregate first: sorting them all took memory that grew with the facts."""
    rows = spark.range(40).select((F.col("id") % 3).cast("string").alias("CODE"), F.concat(F.lit("d"), F.col("id") % 5).alias("DESCRIPTION"), F.lit("S").alias("SYSTEM"))
    found = load.code_dimension({source: rows for source, _ in load.CODE_SOURCES})
    plan = found._jdf.queryExecution().sparkPlan().toString().splitlines()
    union = next(n for n, line in enumerate(plan) if "Union" in line)
    assert "HashAggregate" in next(line for line in reversed(plan[:union]) if "Aggregate" in line)
    assert {r["description"] for r in found.collect() if r["code_system"] == "S"} == {"d0"}


def test_compressed_exports_read_back_and_join_tasks_follow_rows(spark, tmp_path, monkeypatch):
    from carelattice.operators import skew
    from carelattice.session import kept
    from carelattice.sources.text_tables import read_text_table, write_csv

    rows = spark.range(25).selectExpr("cast(id as string) a", 'if(id % 2 = 0, \'say "x", y\', null) b').coalesce(1)
    write_csv(rows, f"{tmp_path}/t.csv", compression="gzip", rows=10)
    assert len(list((tmp_path / "t.csv").glob("*.csv.gz"))) == 3
    back = read_text_table(spark, f"{tmp_path}/t.csv", multiline=False)
    assert sorted(map(str, back.collect())) == sorted(map(str, rows.collect())) == sorted(map(str, kept(rows).collect()))


def test_ids_move_rows_once_unless_copies_crowd_a_chunk(spark):
    from carelattice.operators.running import dense_ids
    from carelattice.operators.skew import SkewPolicy

    rows = spark.range(400).selectExpr("if(id < 200, 'same', cast(id as string)) v", "if(id % 2 = 0 and id >= 200, null, 1) w")
    plain, crowded = (dense_ids(rows, "k", SkewPolicy(floor=f, parts=4)) for f in (1_000_000, 10))
    assert sorted(map(str, plain.collect())) == sorted(map(str, crowded.collect()))
    assert sorted(r["k"] for r in plain.collect()) == list(range(1, 401))
    moved = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert moved(plain) < moved(crowded)
