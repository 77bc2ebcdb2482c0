"""Log parsing and the operators on parsed rows."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallybrook import schemas
from tallybrook.functions.log_fields import LOG_PATTERN
from tallybrook.operators.logs import (
    earliest,
    errors_only,
    level_distribution,
    malformed,
    parse_logs,
    parse_well_formed,
    well_formed,
)

HEAD = "2031-12-09 23:59:58.640"
LINES = [
    "2031-12-10 00:00:11.305 DEBUG [io-7] mill.Valve - Pressure 4.2 bar",
    f"{HEAD} WARN [gate] mill.Sluice - Rust on hinge 3",
    "2031-12-10 02:17:44.019 ERROR [io-7] mill.Wheel - Paddle 12 lost",
    "2031-12-10 00:00:11.306 DEBUG [io-7] mill.Valve - Pressure 4.1 bar",
    "2031-12-11 09:30:00.000 DEBUG [io-2] mill.Valve - Closed",
]


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], schemas.LOG_LINE)


def by_five_extracts(df):
    return df.select(
        *[
            F.regexp_extract("value", LOG_PATTERN, i).alias(name)
            for i, name in enumerate(schemas.PARSED_LOG.names, 1)
        ]
    )


@pytest.fixture(scope="module")
def parsed(spark):
    return parse_logs(lines(spark, *LINES))


def test_all_fields_are_text(parsed):
    assert [(f.name, f.dataType) for f in parsed.schema] == [
        (f.name, f.dataType) for f in schemas.PARSED_LOG
    ]


def test_one_row_per_line(parsed):
    assert parsed.count() == 5


def test_first_line(parsed):
    (first,) = earliest(parsed).collect()
    assert tuple(first) == (HEAD, "WARN", "gate", "mill.Sluice", "Rust on hinge 3")


def test_earliest_skips_unmatched_lines_and_breaks_ties(spark):
    df = parse_logs(lines(spark, "junk", f"{HEAD} WARN [b] l - m", f"{HEAD} INFO [z] l - m"))
    assert [r.thread for r in earliest(df).collect()] == ["z"]
    assert [r.thread for r in earliest(df, 5).collect()] == ["z", "b"]


def test_level_distribution(parsed, spark):
    with_junk = parsed.unionAll(parse_logs(lines(spark, "junk", None)))
    counts = {r.level: r.lines for r in level_distribution(with_junk).collect()}
    assert counts == {"DEBUG": 3, "WARN": 1, "ERROR": 1}


def test_well_formed_drops_unmatched_and_null_lines(parsed, spark):
    assert well_formed(parsed).count() == 5
    mixed = parse_logs(lines(spark, LINES[0], "  at mill.Dam(Dam:3)", "", None))
    kept = well_formed(mixed)
    assert kept.columns == schemas.PARSED_LOG.names
    assert [r.message for r in kept.collect()] == ["Pressure 4.2 bar"]


def test_errors_only(parsed):
    out = errors_only(parsed)
    assert out.columns == schemas.ERROR_LOG.names
    assert [r.message for r in out.collect()] == ["Paddle 12 lost"]


def test_ad_hoc_predicate(parsed):
    assert parsed.filter("level = 'DEBUG'").count() == 3


def test_malformed_is_the_complement(spark):
    df = lines(spark, *LINES, "junk", "", None, f"{HEAD} FATAL [m] l - x")
    bad = [r.value for r in malformed(df).collect()]
    assert sorted(bad, key=str) == sorted(["junk", "", None, f"{HEAD} FATAL [m] l - x"], key=str)
    assert well_formed(parse_logs(df)).count() + len(bad) == df.count()


@pytest.mark.parametrize(
    "line, fields",
    [
        (f"{HEAD} ERROR [w] a.b - m", (HEAD, "ERROR", "w", "a.b", "m")),
        (f"{HEAD} INFO [m] l - a - b - c", (HEAD, "INFO", "m", "l", "a - b - c")),
        (f"{HEAD} INFO [a b] l - m", (HEAD, "INFO", "a b", "l", "m")),
        ("2024-99-99 99:00:00.001 INFO [m] l - m",
         ("2024-99-99 99:00:00.001", "INFO", "m", "l", "m")),
        (f"{HEAD} INFO [m] l - m\r", (HEAD, "INFO", "m", "l", "m")),
        (f"{HEAD} INFO [m] l - m\n", (HEAD, "INFO", "m", "l", "m")),
        (f"{HEAD} INFO [m] l -   ", (HEAD, "INFO", "m", "l", " ")),
        (f"{HEAD} INFO [$1\\2] l$ - $3 \\", (HEAD, "INFO", "$1\\2", "l$", "$3 \\")),
        (f"{HEAD} INFO [a\x01b] l\x01 - m\x01n", (HEAD, "INFO", "a\x01b", "l\x01", "m\x01n")),
        (f"{HEAD} TRACE [m] l - m", ("",) * 5),
        (f"{HEAD} FATAL [m] l - m", ("",) * 5),
        (f"{HEAD} info [m] l - m", ("",) * 5),
        (f" {HEAD} INFO [m] l - m", ("",) * 5),
        ("\tat mill.Dam.run(Dam.x:12)", ("",) * 5),
        (f"{HEAD} INFO [] l - m", ("",) * 5),
        (f"{HEAD} INFO [m] l - ", ("",) * 5),
        (f"{HEAD} INFO [m] l - a\nb", ("",) * 5),
        ("not a log line", ("",) * 5),
        ("a\x01b\x01c\x01d", ("",) * 5),
        ("", ("",) * 5),
        (None, (None,) * 5),
    ],
)
def test_grammar(spark, line, fields):
    (row,) = parse_logs(lines(spark, line)).collect()
    assert tuple(row) == fields


PIECES = st.sampled_from(
    [HEAD, " ", "  ", "\t", "INFO", "ERROR", "TRACE", "[", "]", "[t 1]", "a.b", " - ", "-", "m",
     "\n", "\r", "\x01", "$1", "\\", "é", " ", "\u0085", "]]", "[["]
)
SHAPED = st.tuples(
    st.sampled_from([HEAD, "x" + HEAD]),
    st.sampled_from([" INFO ", "\tWARN  ", " NOPE "]),
    st.lists(PIECES, max_size=3).map(lambda p: "[" + "".join(p) + "]"),
    st.sampled_from([" ", "\n "]),
    st.lists(PIECES, min_size=1, max_size=3).map("".join),
    st.sampled_from([" - ", "  -\t", "-"]),
    st.lists(PIECES, max_size=5).map("".join),
).map("".join)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(SHAPED, st.lists(PIECES, max_size=12).map("".join)), min_size=40))
def test_equals_one_extract_per_field(spark, values):
    df = lines(spark, *values)
    got = [tuple(r) for r in parse_logs(df).collect()]
    assert got == [tuple(r) for r in by_five_extracts(df).collect()]
    matched = [row for row in got if row[1]]
    assert [tuple(r) for r in parse_well_formed(df).collect()] == matched
    assert [r.value for r in malformed(df).collect()] == [
        v for v, row in zip(values, got) if not row[1]
    ]
