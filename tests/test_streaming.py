"""The streaming job over real files."""

from __future__ import annotations

import pytest
from pyspark.errors import AnalysisException

from tallybrook import schemas
from tallybrook.operators.logs import parse_logs, well_formed
from tallybrook.plans.log_stream import error_lines, run_log_stream
from tallybrook.sources.text_lines import read_text_lines, stream_text_lines
from tallybrook.streaming.sink import start_stream


def line(i, level="INFO"):
    return f"2024-05-02 06:00:00.{i:03} {level} [t] app.Job - message {i}\n"


@pytest.fixture
def job(spark, tmp_path):
    class Job:
        logs = tmp_path / "logs"
        out = str(tmp_path / "out")
        checkpoint = str(tmp_path / "checkpoint")

        def put(self, name, text):
            (self.logs / name).write_text(text)

        def run(self, **options):
            query = run_log_stream(
                spark, str(self.logs), self.checkpoint, self.out, available_now=True, **options
            )
            query.awaitTermination()
            return query

        def rows(self, schema=schemas.PARSED_LOG):
            return [tuple(r) for r in spark.read.schema(schema).parquet(self.out).collect()]

    Job.logs.mkdir()
    return Job()


def test_keeps_well_formed_lines_of_all_files(job):
    job.put("a.log", line(1) + "\tat app.Job(Job:3)\n\n" + line(2, "ERROR"))
    job.put("b.txt", line(3, "TRACE") + line(4, "DEBUG"))
    job.run()
    assert sorted(r[1] for r in job.rows()) == ["DEBUG", "ERROR", "INFO"]


def test_one_file_per_batch(job):
    for i in range(4):
        job.put(f"{i}.log", line(i))
    query = job.run(max_files_per_trigger=1)
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [1, 1, 1, 1]
    assert len(job.rows()) == 4


def test_default_batch_takes_all_files(job):
    for i in range(9):
        job.put(f"{i}.log", line(i))
    query = job.run()
    assert [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]] == [9]


def test_restart_reads_only_new_files(job):
    job.put("a.log", line(1) + line(2))
    job.run()
    job.run()
    assert len(job.rows()) == 2
    job.put("b.log", line(3))
    job.run()
    assert sorted(r[4] for r in job.rows()) == ["message 1", "message 2", "message 3"]


def test_error_stream(job):
    job.put("a.log", line(1) + line(2, "ERROR") + line(3, "ERROR"))
    job.run(rows_of=error_lines)
    assert sorted(r[2] for r in job.rows(schemas.ERROR_LOG)) == ["message 2", "message 3"]


def test_name_filter_is_optional(job):
    job.put("a.log", line(1))
    job.put("b.txt", line(2))
    job.run(source_options={"pathGlobFilter": "*.log"})
    assert [r[4] for r in job.rows()] == ["message 1"]


def test_stream_equals_batch(spark, job):
    for i in range(3):
        job.put(f"{i}.log", "".join(line(i * 10 + j, lv) for j, lv in
                                    enumerate(["INFO", "WARN", "nope", "ERROR"])) + "junk\n")
    job.run()
    batch = well_formed(parse_logs(read_text_lines(spark, str(job.logs))))
    assert sorted(job.rows()) == sorted(tuple(r) for r in batch.collect())


@pytest.mark.parametrize("interval_ms", [0, 200])
def test_processing_time_trigger(job, spark, interval_ms):
    job.put("a.log", line(1))
    query = run_log_stream(
        spark, str(job.logs), job.checkpoint, job.out, interval_ms=interval_ms, query_name="by_time"
    )
    try:
        assert query.isActive and query.name == "by_time"
        query.processAllAvailable()
        job.put("b.log", line(2))
        query.processAllAvailable()
        assert len(job.rows()) == 2
    finally:
        query.stop()


def test_console_needs_no_path(job, spark, capfd):
    job.put("a.log", line(1))
    job.out = None
    query = job.run(format="console")
    sink = query.lastProgress["sink"]
    assert "Console" in sink["description"]
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1


def test_parquet_needs_a_path(job, spark):
    with pytest.raises(ValueError, match="needs a path"):
        run_log_stream(spark, str(job.logs), job.checkpoint)


def test_complete_mode_needs_an_aggregation(job, spark):
    with pytest.raises(AnalysisException, match="[Oo]utput mode"):
        start_stream(
            well_formed(parse_logs(stream_text_lines(spark, str(job.logs)))),
            job.checkpoint, job.out, output_mode="complete", available_now=True,
        )


def test_negative_interval_is_refused(job, spark):
    with pytest.raises(Exception, match="(?i)negative|interval|non-negative"):
        run_log_stream(spark, str(job.logs), job.checkpoint, job.out, interval_ms=-1)


def test_missing_folder(spark, job):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        run_log_stream(spark, str(job.logs / "none"), job.checkpoint, job.out)
