"""Log lines of the form 'timestamp - LEVEL - message'."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from parcelflow.functions.text import as_col, contains_any

LOG_PATTERN = r"(?s)^(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}) - ([A-Z]+) - (.*)$"

# Messages with one of these are noise.
NOISE = ["GET /session/", "POST /session/", "Remote response", "Finished Request", "status=200", "http://localhost"]

# The usual level numbers.
LEVELS = {"DEBUG": 10, "INFO": 20, "WARNING": 30, "ERROR": 40, "CRITICAL": 50}


def parse_log_line(c: Column | str) -> Column:
    """Struct of ts, level and message; all null when the line has another form."""
    line = as_col(c)

    def part(i: int) -> Column:
        return F.regexp_extract(line, LOG_PATTERN, i)

    return F.when(
        line.rlike(LOG_PATTERN),
        F.struct(
            F.to_timestamp_ntz(part(1), F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"),
            part(2).alias("level"),
            part(3).alias("message"),
        ),
    )


def level_number(level: Column | str) -> Column:
    name = as_col(level)
    number = F.lit(None).cast("int")
    for text, value in LEVELS.items():
        number = F.when(name == text, F.lit(value)).otherwise(number)
    return number


def level_below(level: Column | str, limit: str) -> Column:
    return level_number(level) < LEVELS[limit]


def is_noise(message: Column | str, patterns: list[str] = NOISE) -> Column:
    return contains_any(message, patterns)
