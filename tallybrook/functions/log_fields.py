"""Log line grammar as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The log grammar. Groups 1-5 are log_timestamp, level, thread,
# logger, message.
LOG_PATTERN = (
    r"^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{3})"
    r"\s+(INFO|WARN|ERROR|DEBUG)"
    r"\s+\[([^\]]+)\]"
    r"\s+(\S+)"
    r"\s+-\s+(.+)$"
)

# Joins the captured groups so that one replacement pass yields all of them.
_SEPARATOR = "\x01"
# ``$`` may stop before a final line terminator; the tail keeps it out of the last group.
_WHOLE_LINE = LOG_PATTERN + r"(?s:.*)"


def log_level(line: Column) -> Column:
    """Level of a log line; ``''`` if the line does not match, NULL for NULL."""
    return F.regexp_extract(line, LOG_PATTERN, 2)


def log_groups(line: Column, *groups: int) -> Column:
    """The wanted groups of a *matching* line as one array, from a single regex pass.

    One ``regexp_extract`` per group would match every line once per group. A line
    that itself holds the separator takes that slower road instead.
    """
    template = _SEPARATOR.join(f"${g}" for g in groups)
    one_pass = F.split(F.regexp_replace(line, _WHOLE_LINE, template), _SEPARATOR, len(groups))
    per_group = F.array(*[F.regexp_extract(line, LOG_PATTERN, g) for g in groups])
    return F.when(line.contains(_SEPARATOR), per_group).otherwise(one_pass)
