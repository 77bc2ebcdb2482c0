"""Streams that write batch by batch: routes, counts kept as state, first lines."""

from __future__ import annotations

import os
import random
from collections import Counter
from pathlib import Path

import pytest

from tallybrook.operators.logs import earliest, level_distribution, parse_logs
from tallybrook.plans import log_batches
from tallybrook.plans.log_batches import (
    ROUTES,
    current_earliest,
    current_level_counts,
    read_route,
    routed,
    run_earliest_lines,
    run_level_counts,
    run_routed_log_stream,
)
from tallybrook.streaming.batches import read_batches, stream_tag

LEVELS = ["INFO", "WARN", "ERROR", "DEBUG", "TRACE"]


def line(i, level, second=None):
    return f"2031-05-0{1 + i % 9} 11:00:{i % 60 if second is None else second:02}.{i % 1000:03} {level}  [job-{i % 3}] mill.Wheel - turn {i}"


def write_file(folder, name, lines):
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / name).write_text("\n".join(lines) + "\n")


@pytest.fixture
def place(tmp_path):
    class Place:
        logs, checkpoint, out = (str(tmp_path / n) for n in ("logs", "checkpoint", "out"))

    rng = random.Random(5)
    for f in range(3):
        lines = [line(100 * f + i, rng.choice(LEVELS)) for i in range(40)] + ["", "  at mill.Gear"]
        write_file(Place.logs, f"{f}.log", lines)
    return Place


def to_end(run, spark, place, **options):
    run(spark, place.logs, place.checkpoint, place.out, available_now=True, **options).awaitTermination()


def rows(df):
    return Counter(map(tuple, df.collect()))


def forget_last_commit(place):
    """As if the job had ended after its last batch was written, before it was committed."""
    commits = sorted((int(p.name), p) for p in Path(place.checkpoint, "commits").iterdir() if p.name.isdigit())
    number, path = commits[-1]
    for part in (path, path.with_name(f".{number}.crc")):
        if part.exists():
            os.remove(part)
    return number


def by_batch(spark, place):
    return {route: rows(read_route(spark, place.out, route)) for route in ROUTES}


def expected_routes(spark, place):
    return {route: rows(df) for route, df in routed(spark.read.text(place.logs)).items()}


def test_every_line_reaches_its_routes(spark, place):
    to_end(run_routed_log_stream, spark, place, max_files_per_trigger=1)
    assert by_batch(spark, place) == expected_routes(spark, place)
    lines = sum(expected_routes(spark, place)[r].total() for r in ("well_formed", "malformed"))
    assert lines == 3 * 42


def test_a_batch_run_again_adds_no_row(spark, place):
    to_end(run_routed_log_stream, spark, place, max_files_per_trigger=1)
    number = forget_last_commit(place)
    written = set(Path(place.out).rglob("*.parquet"))
    to_end(run_routed_log_stream, spark, place, max_files_per_trigger=1)
    assert by_batch(spark, place) == expected_routes(spark, place)
    replaced = written - set(Path(place.out).rglob("*.parquet"))
    assert replaced and all(f"batch_id={number}" in str(p) for p in replaced)


def test_a_batch_that_stopped_between_two_routes(spark, place):
    calls = []

    def failing(batch):
        def once():
            for route, df in routed(batch).items():
                if route == "malformed" and not calls:
                    calls.append(route)
                    raise RuntimeError("lost")
                yield route, df

        class Routes(dict):
            items = staticmethod(once)

        return Routes()

    with pytest.raises(Exception, match="lost"):
        to_end(run_routed_log_stream, spark, place, routes_of=failing)
    assert rows(read_route(spark, place.out, "errors"))
    to_end(run_routed_log_stream, spark, place)
    assert by_batch(spark, place) == expected_routes(spark, place)


def test_streams_with_checkpoints_of_their_own_keep_apart(spark, place):
    to_end(run_routed_log_stream, spark, place)
    first = by_batch(spark, place)
    place.checkpoint += "-2"
    to_end(run_routed_log_stream, spark, place)
    assert all(rows_ == first[route] + first[route] for route, rows_ in by_batch(spark, place).items())
    streams = {r["stream"] for r in read_batches(spark, f"{place.out}/errors", ROUTES["errors"]).collect()}
    assert stream_tag(place.checkpoint) in streams and len(streams) == 2


def test_no_line_at_all(spark, place):
    for file in Path(place.logs).iterdir():
        file.write_text("")
    to_end(run_routed_log_stream, spark, place)
    assert not any(by_batch(spark, place).values())


@pytest.mark.parametrize("mode", ["update", "complete"])
class TestCounts:
    def test_counts_go_on_after_a_restart(self, spark, place, mode):
        to_end(run_level_counts, spark, place, output_mode=mode, max_files_per_trigger=1)
        write_file(place.logs, "late.log", [line(i, "WARN") for i in range(9)])
        to_end(run_level_counts, spark, place, output_mode=mode)
        expected = rows(level_distribution(parse_logs(spark.read.text(place.logs))))
        assert rows(current_level_counts(spark, place.out)) == expected

    def test_a_batch_run_again_counts_once(self, spark, place, mode):
        to_end(run_level_counts, spark, place, output_mode=mode, max_files_per_trigger=1)
        forget_last_commit(place)
        to_end(run_level_counts, spark, place, output_mode=mode, max_files_per_trigger=1)
        expected = rows(level_distribution(parse_logs(spark.read.text(place.logs))))
        assert rows(current_level_counts(spark, place.out)) == expected

    def test_what_a_batch_writes(self, spark, place, mode):
        to_end(run_level_counts, spark, place, output_mode=mode)
        write_file(place.logs, "late.log", [line(1, "WARN")])
        to_end(run_level_counts, spark, place, output_mode=mode)
        last = read_batches(spark, place.out, log_batches.LEVEL_COUNTS).where("batch_id = 1").collect()
        assert len(last) == (1 if mode == "update" else 4)


def test_counts_are_never_appended(spark, place):
    with pytest.raises(ValueError, match="update or complete"):
        run_level_counts(spark, place.logs, place.checkpoint, place.out, output_mode="append")


@pytest.mark.parametrize("n", [1, 5, 500])
def test_first_lines_over_batches(spark, place, n):
    write_file(place.logs, "tie.log", [line(0, "DEBUG", 0)] * 3 + [line(0, "WARN", 0)])
    to_end(run_earliest_lines, spark, place, n=n, max_files_per_trigger=1)
    write_file(place.logs, "late.log", ["2030-01-01 00:00:00.000 INFO [a] b - c"])
    to_end(run_earliest_lines, spark, place, n=n)
    want = earliest(parse_logs(spark.read.text(place.logs)), n)
    assert list(map(tuple, current_earliest(spark, place.out, n).collect())) == list(map(tuple, want.collect()))
    forget_last_commit(place)
    to_end(run_earliest_lines, spark, place, n=n)
    assert rows(current_earliest(spark, place.out, n)) == rows(want)
