"""Raw-format semantics of the registry files (no header, Latin-1, ';', '"', no escape)."""

import os

import pytest
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from terrace.sources.raw import parse_lines, scan_raw

S3 = StructType([StructField(n, StringType()) for n in ("a", "b", "c")])


def write_bytes(folder, name, data: bytes):
    with open(os.path.join(folder, name), "wb") as f:
        f.write(data)


def scan_rows(spark, folder, schema=S3):
    return sorted((tuple(r) for r in scan_raw(spark, folder, schema).collect()), key=repr)


def test_file_scan_edge_rows(spark, scratch):
    data = b"\n".join(
        [
            b'"1";"S\xc3O"',          # Latin-1 bytes, not UTF-8
            b'"3";"a;b"',             # delimiter inside quotes
            b'"9";"trail\\"',         # backslash before the closing quote is data
            b'"2";"a ""b"" c"',       # doubled quotes are kept raw (no escape char)
            b'"4";""',                # quoted empty as last field -> a single quote
            b'"";y',                  # quoted empty first field -> null
            b'"1";"";"z"',            # quoted empty middle field -> null
            b'"10";" ";"z"',          # quoted space stays
            b'"11";"x";"y"\r',        # CRLF
            b'"5";',                  # unquoted empty -> null
            b'"12"',                  # short row -> null padded
            b'"13";"a";"b";"extra"',  # long row -> extra dropped
            b"",                      # blank line skipped
        ]
    )
    write_bytes(scratch, "part0.csv", data)
    write_bytes(scratch, "_hidden", b'"99";"hidden";"x"')
    rows = scan_rows(spark, scratch)
    expect = sorted(
        [
            ("1", "SÃO", None),
            ("3", "a;b", None),
            ("9", "trail\\", None),
            ("2", '"a ""b"" c"', None),
            ("4", '"', None),
            (None, "y", None),
            ("1", None, "z"),
            ("10", " ", "z"),
            ("11", "x", "y"),
            ("5", None, None),
            ("12", None, None),
            ("13", "a", "b"),
        ],
        key=repr,
    )
    assert rows == expect


def test_newline_in_quotes_splits_record(spark, scratch):
    write_bytes(scratch, "p.csv", b'"6";"l1\nl2"\n')
    rows = scan_rows(spark, scratch, StructType(S3.fields[:2]))
    assert sorted(rows, key=repr) == sorted([("6", "l1"), ('l2"', None)], key=repr)


def test_int_fields_are_not_trimmed(spark, scratch):
    schema = StructType([StructField("k", StringType()), StructField("n", IntegerType())])
    write_bytes(scratch, "i.csv", b'"a";02\n"b";"02"\n"c";x\n"d";" 2"\n"e";2.0\n"f";2147483648\n"g";\n')
    got = dict(tuple(r) for r in scan_raw(spark, scratch, schema).collect())
    assert got == {"a": 2, "b": 2, "c": None, "d": None, "e": None, "f": None, "g": None}


def test_from_csv_equals_file_scan(spark, scratch):
    lines = ['"1";"a;b";"c"', '"2";"x ""y""";"z"', '"3";"";"w"', '"4";"v";""', '"5"', ";;", '"6";"q\\"']
    write_bytes(scratch, "f.csv", "\n".join(lines).encode("latin-1"))
    from_file = sorted((tuple(r) for r in scan_raw(spark, scratch, S3).collect()), key=repr)
    df = spark.createDataFrame([(v,) for v in lines + [""]], "value string")
    from_lines = sorted((tuple(r) for r in parse_lines(df, S3).collect()), key=repr)
    assert from_file == from_lines


def test_nul_inside_quotes(spark):
    """NUL is the parser's escape character when escape is empty: one NUL inside a
    value survives, two collapse to one, and a NUL right before the closing quote
    escapes that quote (the row then runs on)."""
    from pyspark.sql import functions as F

    rows = ['"1";"a#b";"z"', '"2";"a##b";"z"', '"3";"ab#";"z"']
    df = spark.createDataFrame([(r,) for r in rows], "value string").select(
        F.regexp_replace("value", "#", F.expr("char(0)")).alias("value")
    )
    got = {r["a"]: (r["b"], r["c"]) for r in parse_lines(df, S3).collect()}
    assert got["1"] == ("a\x00b", "z")
    assert got["2"] == ("a\x00b", "z")
    assert got["3"][1] is None and got["3"][0].startswith('"ab')


@pytest.mark.parametrize("escape,expected", [("", '"a ""b"" c"'), ('"', 'a "b" c')])
def test_escape_option(spark, escape, expected):
    df = spark.createDataFrame([('"2";"a ""b"" c"',)], "value string")
    assert parse_lines(df, S3, escape=escape).first()["b"] == expected
