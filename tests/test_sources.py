import pytest
from helpers import cube, rows, table

from tallycube.plans.ingest import ingest, ingest_folder, read_sections
from tallycube.plans.sync import source_slice
from tallycube.session import scratch_path
from tallycube.sources import (
    append_rules,
    discover_columns,
    files_by_role,
    publish_release,
    read_cube,
    read_folder,
    read_release,
    read_rules,
    read_table,
    read_typed,
    read_wide,
    role_from_path,
    role_of,
    section_of,
    write_cube,
    write_release,
    write_report,
    write_version,
)


def test_byte_order_mark_and_leading_zeros(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_bytes("﻿area_name,code\nCôte,011.01\n".encode())
    got = read_wide(spark, str(path))
    assert got.columns == ["area_name", "code"]
    assert rows(got) == [("Côte", "011.01")]


def test_files_read_together_need_one_header(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Country_code,1950,1951\n004,1,2\n")
    (tmp_path / "b.csv").write_text("Country_code,1951,1950\n008,4,3\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_wide(spark, str(tmp_path)).collect()


def test_typed_columns_match_by_name(spark, tmp_path):
    path = tmp_path / "typed.csv"
    path.write_text("Year,Code,Value\n1998,007,1.5\nx,008,y\n")
    got = read_typed(spark, str(path), {"Code": "string", "Value": "double", "Year": "int"})
    assert rows(got) == [("007", 1.5, 1998), ("008", None, None)]


def test_roles_in_order(spark):
    names = ["BOTH_SEXES.csv", "FEMALE.csv", "male_est.csv", "Urban.csv", "rural.csv", "notes.txt"]
    assert [role_of(n) for n in names] == ["total", "female", "male", "urban", "rural", None]
    df = table(spark, "n string", *[(n,) for n in names])
    assert [r[0] for r in df.select(role_from_path("n")).collect()] == [role_of(n) for n in names]
    assert section_of("ESTIMATES") == "estimates"
    assert section_of("MEDIUM VARIANT") == "medium"


def test_header_discovery():
    got = discover_columns(["Index", "Variant", "Country code", "1950", "1951"])
    assert got == ("Variant", "Country code", ["1950", "1951"])
    assert discover_columns(["Country_code", "1998", "1999"], 1999) == (None, "Country_code", ["1999"])
    with pytest.raises(ValueError):
        discover_columns(["Country_code", "1950", "1952"])
    with pytest.raises(ValueError):
        discover_columns(["Variant", "1950"])


def test_ingest_from_files(spark, tmp_path):
    folder = tmp_path / "in put"
    folder.mkdir()
    files = {
        "both_estimates.csv": "Variant,Country_code,1950,1951\nEstimates,004,1 000.5,2\nEstimates,999,1,1\n",
        "both_medium.csv": "Variant,Country_code,1951,1952\nMedium,004,3,..\n",
        "female_estimates.csv": "Variant,Country_code,1950,1951\nEstimates,004,5,6\n",
        "male_estimates.csv": "Variant,Country_code,1950,1951\nEstimates,004,7,8\n",
        "urban.csv": "Country_code,1950\n004,9\n",
        "rural.csv": "Country_code,1950\n004,10\n",
    }
    for name, text in files.items():
        (folder / name).write_text(text)
    found = files_by_role(spark, str(folder))
    assert {r: sorted(s) for r, s in found.items()} == {
        "total": ["estimates", "medium"],
        "female": ["estimates"],
        "male": ["estimates"],
        "urban": ["estimates"],
        "rural": ["estimates"],
    }
    done = ingest(read_sections(spark, str(folder)), table(spark, "code string", ("004",)), 1951, "WPP2019", "WUP2018")
    got = rows(done.cube)
    assert ("004", "511", 1950, 1000.5, "X", "h") in got
    assert ("004", "511", 1951, 2.0, "X", "h") in got
    assert ("004", "511", 1952, 0.0, "O", "h") in got
    assert len(got) == 3 + 2 + 2 + 1 + 1
    assert rows(done.unknown) == [("999",)]
    assert ("004", "511", 1951, 2.0, "estimates") in rows(done.overlaps)
    assert ("004", "511", 1951, 3.0, "projections") in rows(done.overlaps)
    assert {r[1] for r in rows(done.overlaps)} == {"511"}  # roles without projections have nothing to disagree with
    texts = {r.Metadata_Value for r in done.metadata().collect()}
    assert texts == {"WPP2019-Estimates", "WPP2019-Medium", "WUP2018"}


def test_rewriting_a_year_keeps_the_others(spark):
    path = scratch_path(spark, "test")
    write_cube(cube(spark, ("004", "511", 1950, 1), ("004", "511", 1951, 2)), path)
    write_cube(cube(spark, ("004", "511", 1951, 3)), path)
    back = read_cube(spark, path)
    assert rows(back, "geographicAreaM49", "timePointYears", "Value") == [("004", 1950, 1.0), ("004", 1951, 3.0)]
    plan = back.filter("timePointYears = 1951")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(timePointYears" in plan


def test_reports_and_rule_tables(spark):
    path = scratch_path(spark, "test")
    rules = table(spark, "var_type string, master_domain string, code string", ("area", "P", "011"), ("item", "P", "2"))
    append_rules(rules, f"{path}/rules")
    append_rules(rules, f"{path}/rules")
    stored = read_table(spark, f"{path}/rules")
    assert rows(read_rules(stored, ["code"], var_type="area", master_domain="P")) == [("011",), ("011",)]
    write_report(rules, f"{path}/report")
    assert rows(read_wide(spark, f"{path}/report"), "code") == [("011",), ("2",)]


def test_header_below_a_preamble(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\ufeffnotes\nmore, notes\nCode,Name\n004,\"x, y\"\n\n008,z\n", encoding="utf-8")
    assert rows(read_wide(spark, str(tmp_path), start_row=3)) == [("004", "x, y"), ("008", "z")]
    (tmp_path / "b.csv").write_text("notes\nmore\nOther,Name\n1,2\n", encoding="utf-8")
    with pytest.raises(ValueError):
        read_wide(spark, str(tmp_path), start_row=3)


def test_a_folder_is_read_in_one_scan(spark, tmp_path):
    folder = tmp_path / "all tables"
    folder.mkdir()
    (folder / "Both estimates.csv").write_bytes('﻿Country code,Variant,1950,1951\n004,Est,1,"2"\n008,Est,,4\n'.encode())
    (folder / "both medium.csv").write_text('Index,"Notes, all",Variant,Country code,1951,1952\n1,"a,b",Medium,004,20,3\n')
    (folder / "urban ata.csv").write_text("1951,Country code,1950,1952\n6,004,5,7\n")
    (folder / "notes.txt").write_text("Country code,1950\n004,9\n")
    got = read_folder(spark, str(folder), 1951, 1950)
    assert rows(got.filter("section = 'medium'")) == [("Medium", "004", 1951, "20", "511", "medium"), ("Medium", "004", 1952, "3", "511", "medium")]
    assert rows(got.filter("measuredElement = '561'"), "Variant", "timePointYears", "Value") == [(None, 1950, "5"), (None, 1951, "6"), (None, 1952, "7")]
    codes = table(spark, "code string", ("004",))
    done = ingest_folder(spark, str(folder), codes, 1951, first_year=1950)
    assert rows(done.cube, "measuredElement", "timePointYears", "Value") == [
        ("511", 1950, 1.0), ("511", 1951, 2.0), ("511", 1952, 3.0), ("561", 1950, 5.0), ("561", 1951, 6.0), ("561", 1952, 7.0),
    ]
    assert done.cube._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    assert rows(done.unknown) == [("008",)]
    assert rows(done.overlaps, "geographicAreaM49", "Value", "side") == [("004", 2.0, "estimates"), ("004", 20.0, "projections"), ("008", 4.0, "estimates")]
    with pytest.raises(ValueError):
        read_folder(spark, str(tmp_path / "all tables" / "notes.txt"), 1951)


def test_records_below_a_preamble_may_hold_line_breaks(spark, tmp_path):
    text = 'A "note\n\nname,code\n"Afgha\nnistan",004\n"a ""b"", c\n\n",008\n\nplain,010\n'
    for n in range(3):
        (tmp_path / f"t{n}.csv").write_text(text)
    got = read_wide(spark, str(tmp_path), start_row=3)
    want = [("Afgha\nnistan", "004"), ('a "b", c\n\n', "008"), ("plain", "010")]
    assert rows(got) == sorted(3 * want, key=str)
    assert rows(read_wide(spark, str(tmp_path), "code int, name string", start_row=3), "code") == sorted(3 * [(4,), (8,), (10,)], key=str)
    (tmp_path / "t9.csv").write_text("x\ny\nother,code\n")
    with pytest.raises(ValueError):
        read_wide(spark, str(tmp_path), start_row=3)


def test_cube_and_metadata_are_replaced_together(spark, tmp_path):
    path = str(tmp_path / "release")
    texts = lambda *r: table(spark, "geographicAreaM49 string, timePointYears int, Metadata_Value string", *r)
    with pytest.raises(ValueError):
        read_release(spark, path)
    write_release(cube(spark, ("a", "511", 1950, 1), ("a", "511", 1951, 2)), texts(("a", 1950, "m"), ("a", 1951, "m")), path)
    torn = write_version(cube(spark, ("a", "511", 1950, 100)), texts(("a", 1950, "torn")), path)
    write_release(cube(spark, ("b", "511", 1951, 7), ("b", "511", 1952, 8)), texts(("b", 1952, "n")), path)
    values, told = read_release(spark, path)
    assert rows(values, "geographicAreaM49", "timePointYears", "Value") == [("a", 1950, 1.0), ("b", 1951, 7.0), ("b", 1952, 8.0)]
    # The metadata of a year that has none any more go with the year.
    assert rows(told, "geographicAreaM49", "timePointYears", "Metadata_Value") == [("a", 1950, "m"), ("b", 1952, "n")]
    publish_release(spark, path, torn)
    assert rows(read_release(spark, path)[0], "Value") == [(100.0,), (7.0,), (8.0,)]


def test_source_slice_follows_its_code_lists(spark):
    stored = cube(spark, ("004", "511", 1950, 1), ("004", "511", 0, 5), ("008", "511", 1950, 2), ("004", "999", 1950, 3), ("004", "561", 1951, 4))
    stored = stored.withColumnRenamed("geographicAreaM49", "geographicAreaM49_unpd")
    got = source_slice(stored, table(spark, "code string", ("004",), ("004",)), table(spark, "code string", ("0",), ("1950",), ("1951",)))
    assert got.columns[0] == "geographicAreaM49"
    assert rows(got, "geographicAreaM49", "measuredElement", "timePointYears", "Value") == [("004", "511", 1950, 1.0), ("004", "561", 1951, 4.0)]
