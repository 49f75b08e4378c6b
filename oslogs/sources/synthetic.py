"""Generated Solaris log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- Fixed values: text pools of the generated log ----------------------------
SEVERITIES = ("warning", "error", "critical", "fatal")
PROBLEM_MESSAGES = (
    "Disk usage warning", "Memory error detected", "Critical disk failure", "Fatal kernel panic", "Service failure",
    "CPU overheating", "I/O error detected", "Process crash", "Disk corruption detected", "Authentication failure",
    "Login failure", "Disk space running low", "Network unreachable", "Service timeout",
)
SUCCESS_MESSAGES = (
    "System initialized successfully", "Disk usage is normal", "Kernel boot successful",
    "Memory allocated successfully", "Process started without errors", "Service apache2 started",
    "Authentication successful for user root", "I/O operation completed successfully", "Disk space is sufficient",
    "Service nginx started", "Filesystem mounted successfully", "System running optimally",
    "Network connection established", "File transfer successful", "Reboot completed successfully",
    "Login successful for user admin", "Configuration applied successfully", "Backup completed without errors",
    "Security audit passed successfully", "Network interface up", "No issues detected",
    "Software update applied successfully", "Application started without issues", "Disk health check passed",
)
LINES, SUCCESS_LINES = 500, 415


def _pick(pool: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, pool)), (F.pmod(number, F.lit(len(pool))) + 1).cast("int"))


def solaris_lines(
    ids: DataFrame, at: Column, is_success: Column, number=lambda id_, salt: F.xxhash64(id_, F.lit(salt))
) -> DataFrame:
    """One generated line (``value``) per row of ``ids``, a frame with a LONG column ``id``.

    ``number(id, salt)`` supplies the pseudo-random choices; any LONG expression will do.
    """
    id_ = F.col("id")
    tag = F.when(is_success, F.lit("success")).otherwise(_pick(SEVERITIES, number(id_, 1)))
    text = F.when(is_success, _pick(SUCCESS_MESSAGES, number(id_, 2))).otherwise(
        _pick(PROBLEM_MESSAGES, number(id_, 3))
    )
    return ids.select(
        F.format_string(
            "%s solaris-host genunix: [ID %d kern.%s] %s",
            F.date_format(at, "MMM dd HH:mm:ss"), F.pmod(number(id_, 4), F.lit(1000)), tag, text,
        ).alias("value")
    )


def synthetic_solaris(
    spark: SparkSession, n: int = LINES, n_success: int = SUCCESS_LINES, seed: int = 0, at: str | None = None
) -> DataFrame:
    """``n`` generated lines of which the first ``n_success`` are successes; repeatable by ``seed``."""
    when = F.lit(at).cast("timestamp_ntz") if at else F.localtimestamp()
    return solaris_lines(
        spark.range(n), when, F.col("id") < n_success,
        lambda id_, salt: F.xxhash64(id_, F.lit(salt), F.lit(seed)),
    )
