"""Delimited export: tab, no header, NULL marker, '' kept apart, tab inside quoted (S11)."""

import glob

from salesmart.plans import export_delimited, read_delimited


def test_tsv_round_trip_and_format(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a\tb"), (4, "x")], "k int, s string")
    path = str(tmp_path / "out")
    export_delimited(df.coalesce(1), path)
    text = "".join(open(f).read() for f in sorted(glob.glob(path + "/part-*")))
    lines = sorted(text.splitlines())
    assert lines == ["1\tNULL", '2\t""', '3\t"a\tb"', "4\tx"]
    back = read_delimited(spark, path, df.schema)
    assert sorted((r.k, r.s) for r in back.collect()) == [(1, None), (2, ""), (3, "a\tb"), (4, "x")]
