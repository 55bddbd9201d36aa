"""Ranked-list and line records: parse, format, write and read back."""

import tempfile

from nextbest.sources import records


def test_ranked_list_round_trip(spark):
    recs = spark.createDataFrame([(10, ["b", "a"]), (2, ["c"]), (33, [])],
                                 "customer long, items array<string>")
    out = tempfile.mkdtemp(prefix="nextbest-rl-")
    records.write_ranked_list(recs, out + "/rl", single_file=True)
    lines = [r.value for r in spark.read.text(out + "/rl").collect()]
    assert lines == ["2,c", "10,b a", "33,"]
    back = {r.customer: r["items"] for r in records.read_ranked_list(spark, out + "/rl").collect()}
    assert back == {2: ["c"], 10: ["b", "a"], 33: []}


def test_parse_ranked_list_strips_carriage_return(spark):
    lines = spark.createDataFrame([("7,x y\r",), ("",), ("8,z",)], "value string")
    got = {r.customer: r["items"] for r in records.parse_ranked_list(lines).collect()}
    assert got == {7: ["x", "y"], 8: ["z"]}


def test_parse_lines_drops_blank_and_header(spark):
    lines = spark.createDataFrame([("ncodpers,ind_empleado,age",), ("  ",), (" 1 , N, 35",)],
                                  "value string")
    got = records.parse_lines(lines, ["ncodpers", "ind_empleado", "age"],
                              header_marker="ind_empleado").collect()
    assert [tuple(r) for r in got] == [("1", "N", "35")]


def test_snapshot_csv_na_tokens(spark):
    d = tempfile.mkdtemp(prefix="nextbest-csv-")
    with open(d + "/s.csv", "w") as f:
        f.write('"a","b","c"\n1,NA," x"\n2,         NA,-999999\n')
    df = records.read_snapshot_csv(spark, d + "/s.csv")
    rows = [tuple(r) for r in df.orderBy("a").collect()]
    assert rows == [("1", None, " x"), ("2", None, None)]
