import pytest

from silostar import model
from silostar.sources.delimited import (
    ANY,
    CRLF,
    header_map,
    read_country_attributes,
    read_raw,
    read_scores,
    read_source,
    record_end,
)


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_bytes(text.encode())
    return str(path)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_null_rules(spark, tmp_path):
    path = write(
        tmp_path, "a.csv",
        'idKey,a,b\n1,NULL,x\n2,,\n3,"",y\n4,"he said ""hi""","l1\nl2"\n5,z\n6\n7,1,2,3\n8,,q,\n'
        '9,"p,q"\n10,"NULL",0x1\n',
    )
    got = rows(read_raw(spark, path, ["id_key", "a", "b"], multi_line=True))
    assert got == [
        ("1", None, "x"),
        ("2", "", ""),
        ("3", "", "y"),
        ("4", 'he said "hi"', "l1\nl2"),
        ("5", "z", None),
        ("6", None, None),
        ("7", "1", "2"),
        ("8", "", "q"),
        ("9", "p,q", None),
        ("10", None, "0x1"),
    ]


def test_pruned_columns_keep_short_rows_apart(spark, tmp_path):
    path = write(tmp_path, "a.csv", "a,b,c\n1\n1,,\n")
    assert rows(read_raw(spark, path, ["a", "b", "c"]).select("b")) == [(None,), ("",)]


def test_column_order_and_missing_column(spark, tmp_path):
    path = write(tmp_path, "a.csv", "b,a,extra\n2,1,9\n")
    assert rows(read_raw(spark, path, ["a", "b", "c"])) == [("1", "2", None)]
    assert rows(read_raw(spark, path, {"a": "first", "b": "second"})) == [("1", "2")]


def test_header_map():
    header = ["categoryID", "categoryName", "shipperid"]
    assert header_map(["category_id", "shipper_id", "absent"], header) == {
        "categoryID": "category_id", "shipperid": "shipper_id",
    }


def test_semicolons_and_crlf(spark, tmp_path):
    names = ";".join(c.replace("_", "") for c in model.CUSTOMERS.columns)
    line = ";".join(["ALFKI", "Alfreds, Futterkiste"] + ["NULL"] * 9)
    write(tmp_path, "customers.csv", f"{names}\r\n{line}\r\n")
    got = rows(read_source(spark, str(tmp_path), model.CUSTOMERS))
    assert got == [("ALFKI", "Alfreds, Futterkiste", *[None] * 9)]


def test_single_line_mode(spark, tmp_path):
    path = write(tmp_path, "a.csv", "a,b\n1,\n2\n")
    assert rows(read_raw(spark, path, ["a", "b"], multi_line=False)) == [("1", ""), ("2", None)]


LINE_BREAKS = {
    "in the last field": 'a,b\n1,"x\ny"\n',
    "in the first field": 'a,b\n"x\ny",1\n',
    "twice": 'a,b\n1,"x\n\ny"\n2,3\n',
}


@pytest.mark.parametrize("text", LINE_BREAKS.values(), ids=LINE_BREAKS)
def test_line_breaks_are_reported_unless_asked_for(spark, tmp_path, text):
    path = write(tmp_path, "a.csv", text)
    with pytest.raises(Exception, match="use multi_line"):
        read_raw(spark, path, ["a", "b"]).collect()
    assert "\n" in str(rows(read_raw(spark, path, ["a", "b"], multi_line=True))).replace("\\n", "\n")


def test_line_breaks_in_scores_and_countries(spark, tmp_path):
    scores = write(tmp_path, "s.csv", 'customerID;score\n"A\nB";1\n')
    with pytest.raises(Exception, match="use multi_line"):
        read_scores(spark, scores)[0].collect()
    assert rows(read_scores(spark, scores, multi_line=True)[0]) == [("A\nB", "1")]
    countries = write(
        tmp_path, "w.csv",
        "Country,Abbreviation,Capital/Major City,Official language,Currency-Code,Latitude,Longitude\n"
        'Peru,PE,"Li\nma",Spanish,PEN,1,2\n',
    )
    with pytest.raises(Exception, match="use multi_line"):
        read_country_attributes(spark, countries).collect()
    assert rows(read_country_attributes(spark, countries, multi_line=True))[0][2] == "Li\nma"


@pytest.mark.parametrize("multi_line", [False, True])
def test_scores(spark, tmp_path, multi_line):
    path = write(tmp_path, "s.csv", "customerID;score\n ALFKI ;\t4 \nANATR;\nSHORT\nNULL;1\n")
    kept, rejected = read_scores(spark, path, multi_line)
    assert rows(kept) == [("ALFKI", "4"), ("ANATR", ""), ("", "1")]
    assert rows(rejected) == [("SHORT", "SHORT")]


@pytest.mark.parametrize("multi_line", [False, True])
def test_country_attributes_last_record_counts(spark, tmp_path, multi_line):
    path = write(
        tmp_path, "w.csv",
        "Country,Density,Abbreviation,Capital/Major City,Official language,Currency-Code,"
        "Latitude,Longitude\n"
        "Peru,26, PE ,Old,Spanish,PEN,1,2\n"
        "Chile,25,CL,Santiago,,CLP,,-70.6\n"
        "Peru,26, PE ,Lima,Spanish,PEN,-9.1,-75.0\n",
    )
    got = sorted(rows(read_country_attributes(spark, path, multi_line)))
    assert got == [
        ("Chile", "CL", "Santiago", "", "CLP", None, "-70.6"),
        ("Peru", "PE", "Lima", "Spanish", "PEN", "-9.1", "-75.0"),
    ]


def test_crlf_files_with_breaks_in_fields_are_split(spark, tmp_path):
    """The same rows as by one task, from several."""
    lines = [f'{i},"a{i}\nb ""q"", c",NULL,,{"" if i % 3 else "x"}' for i in range(3000)]
    lines[5], lines[7], lines[9] = "5", "7,NULL", '9,"x\ny",1,2,3,4,5'
    path = write(tmp_path, "a.csv", "\r\n".join(["id,a,b,c,d", *lines]) + "\r\n")
    assert record_end(spark, path) == CRLF
    columns = ["id", "a", "b", "c", "d"]
    whole = rows(read_raw(spark, path, columns, multi_line=True))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        split = read_raw(spark, path, columns, ends=CRLF)
        assert split.rdd.getNumPartitions() > 3
        assert rows(split) == whole and len(whole) == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert whole[0][1] == 'a0\nb "q", c' and whole[5] == ("5", None, None, None, None)


def test_records_that_do_not_end_alike_are_reported(spark, tmp_path):
    path = write(tmp_path, "a.csv", "a,b\r\n1,2\n3,4\r\n")
    with pytest.raises(Exception, match="use multi_line"):
        read_raw(spark, path, ["a", "b"], ends=record_end(spark, path)).collect()
    path = write(tmp_path, "b.csv", 'a,b\r\n1,"x\r\ny"\r\n')
    with pytest.raises(Exception, match="use multi_line"):
        read_raw(spark, path, ["a", "b"], ends=record_end(spark, path)).collect()
    assert rows(read_raw(spark, path, ["a", "b"], multi_line=True)) == [("1", "x\ny")]


def test_record_end(spark, tmp_path):
    assert record_end(spark, write(tmp_path, "a.csv", "a,b\n1,2\r\n")) is ANY
    assert record_end(spark, write(tmp_path, "b.csv", "")) is ANY
