"""Worker log lines and error codes."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from .text import col_of, let

# Error codes with their names, and code families by first digit.
ERROR_CODES = (
    ("E0000", "UNKNOWN"),
    ("E0001", "CONFIG_ERROR"),
    ("E0002", "INITIALIZATION_ERROR"),
    ("E1001", "BACKEND_NOT_FOUND"),
    ("E1002", "MODEL_LOAD_ERROR"),
    ("E1003", "GENERATION_ERROR"),
    ("E1004", "EDITING_ERROR"),
    ("E2001", "API_CONNECTION_ERROR"),
    ("E2002", "API_TIMEOUT_ERROR"),
    ("E2003", "API_RATE_LIMIT_ERROR"),
    ("E2004", "API_AUTH_ERROR"),
    ("E3001", "DATA_LOAD_ERROR"),
    ("E3002", "IMAGE_LOAD_ERROR"),
    ("E3003", "IMAGE_SAVE_ERROR"),
    ("E4001", "OPTIMIZATION_ERROR"),
)
ERROR_FAMILIES = (("0", "general"), ("1", "backend"), ("2", "api"), ("3", "data"), ("4", "optimization"))

SEPARATOR = " - "
TIME_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"
RANK_PATTERN = r"^\[Rank (\d+)\]$"
PROCESS_PATTERN = r"^\[Process (\d+)\] "
BATCH_PATTERN = r"^Processing batch (\d+)/(\d+)"
COMPLETED_PATTERN = r"^Completed: (\d+) successful, (\d+) failed"
CODE_PATTERN = r"\[(E\d{4})\]"


def _lookup(pairs, key: Column) -> Column:
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(pairs)])
    return F.try_element_at(table, key)


def error_family(code) -> Column:
    return _lookup(ERROR_FAMILIES, F.substring(col_of(code), 2, 1))


def error_name(code) -> Column:
    return _lookup(ERROR_CODES, col_of(code))


def parse_log_line(line) -> Column:
    """STRUCT of the parts of one log line; ``raw`` keeps a line of another shape."""
    line = col_of(line)
    # Cut into time, rank, logger, level and message once; only the message is searched further.
    return let(F.struct(F.split(line, SEPARATOR, 5).alias("p"), line.alias("line")), _parsed)


def _parsed(cut: Column) -> Column:
    p = cut["p"]

    def at(i):
        return F.get(p, F.lit(i))

    shaped = (F.size(p) == 5) & at(0).rlike(TIME_PATTERN) & at(1).rlike(RANK_PATTERN) & at(3).rlike("^[A-Z]+$")
    nothing = F.lit(None).cast("string")
    other = F.struct(*[nothing.alias(n) for n in ("ts", "rank", "logger", "level", "process", "message")],
                     cut["line"].alias("raw"))
    body = at(4)
    process = F.regexp_extract(body, PROCESS_PATTERN, 1)
    head = F.struct(
        at(0).alias("ts"), F.regexp_extract(at(1), RANK_PATTERN, 1).alias("rank"), at(2).alias("logger"),
        at(3).alias("level"), process.alias("process"), F.regexp_replace(body, PROCESS_PATTERN, "").alias("message"),
        nothing.alias("raw"))
    return let(F.when(F.coalesce(shaped, F.lit(False)), head).otherwise(other), _described)


def _described(h: Column) -> Column:
    message = h["message"]
    kind = (
        F.when(message.startswith("Saved: "), F.lit("saved"))
        .when(message.startswith("Skipping "), F.lit("skipping"))
        .when(message.rlike(BATCH_PATTERN), F.lit("batch"))
        .when(message.rlike(COMPLETED_PATTERN), F.lit("completed"))
        .when(message.isNotNull(), F.lit("other"))
    )

    def number(prefix, pattern, i):
        # Most lines do not start this way, so most never reach the pattern.
        return F.when(message.startswith(prefix), F.regexp_extract(message, pattern, i).try_cast("int"))

    return F.struct(
        F.try_to_timestamp(h["ts"], F.lit("yyyy-MM-dd HH:mm:ss")).alias("ts"),
        h["rank"].try_cast("int").alias("rank"),
        h["logger"].alias("logger"),
        h["level"].alias("level"),
        h["process"].try_cast("int").alias("process"),
        kind.alias("kind"),
        F.when(message.startswith("Saved: "), F.substring(message, len("Saved: ") + 1, 2**31 - 1)).alias("path"),
        number("Processing batch", BATCH_PATTERN, 1).alias("batch"),
        number("Processing batch", BATCH_PATTERN, 2).alias("batches"),
        number("Completed: ", COMPLETED_PATTERN, 1).alias("successful"),
        number("Completed: ", COMPLETED_PATTERN, 2).alias("failed"),
        F.nullif(F.regexp_extract(message, CODE_PATTERN, 1), F.lit("")).alias("code"),
        message.alias("message"),
        h["raw"].alias("raw"),
    )
