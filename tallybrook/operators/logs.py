"""Log operators. Each runs unchanged on a batch or a streaming DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallybrook.functions.log_fields import LOG_PATTERN, log_groups, log_level
from tallybrook.schemas import ERROR_LOG, PARSED_LOG


def parse_logs(lines: DataFrame, column: str = "value") -> DataFrame:
    """Split raw lines into the five log fields, one output row per line.

    A line outside the grammar gives ``''`` in all five fields, a NULL line five
    NULLs. ``level`` stays an expression of its own: filters and counts on it push
    down to one cheap match per line, and the other fields are cut out only for
    the rows that are left.
    """
    line = F.col(column)
    split = lines.select(log_level(line).alias("level"), log_groups(line, 1, 3, 4, 5).alias("_g"))

    def field(i: int):
        # otherwise(level): '' for an unmatched line, NULL for a NULL line
        return F.when(F.col("level") != "", F.get("_g", F.lit(i))).otherwise(F.col("level"))

    fields = {"log_timestamp": field(0), "level": F.col("level"), "thread": field(1),
              "logger": field(2), "message": field(3)}
    return split.select(*[fields[name].alias(name) for name in PARSED_LOG.names])


def well_formed(parsed: DataFrame) -> DataFrame:
    """Parsed rows whose line matched the grammar."""
    return parsed.where("level != ''").select(*PARSED_LOG.names)


def parse_well_formed(lines: DataFrame, column: str = "value") -> DataFrame:
    """``well_formed(parse_logs(lines))`` with one match per line less.

    Lines outside the grammar are dropped first, so all fields, the level too, come
    from the one pass that cuts a line up.
    """
    line = F.col(column)
    matching = lines.where(line.rlike(LOG_PATTERN))
    groups = matching.select(log_groups(line, 1, 2, 3, 4, 5).alias("_g"))
    return groups.select(
        *[F.get("_g", F.lit(i)).alias(name) for i, name in enumerate(PARSED_LOG.names)]
    )


def errors_only(parsed: DataFrame) -> DataFrame:
    """ERROR rows for alerting or dead-letter routing, without level and thread."""
    return parsed.where("level = 'ERROR'").select(*ERROR_LOG.names)


def malformed(lines: DataFrame, column: str = "value") -> DataFrame:
    """Raw lines that ``well_formed`` drops, NULL lines included."""
    matches = F.coalesce(F.col(column).rlike(LOG_PATTERN), F.lit(False))
    return lines.where(~matches).select(column)


def level_distribution(parsed: DataFrame) -> DataFrame:
    """Rows per level over the well-formed lines.

    Unmatched lines form a group of their own that is dropped at the end: a filter up
    front would match every line a second time.
    """
    counted = parsed.groupBy("level").agg(F.count_if(F.col("level") != "").alias("lines"))
    return counted.where("lines > 0")


def earliest(parsed: DataFrame, n: int = 1) -> DataFrame:
    """The first ``n`` well-formed lines by time; the other fields break ties.

    The timestamp text is fixed-width, so text order is time order.
    """
    return well_formed(parsed).orderBy(*PARSED_LOG.names).limit(n)
