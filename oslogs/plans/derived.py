"""Log lines derived from the ``events`` table, as one recipe in Spark SQL and in DuckDB SQL.

The given tables hold no log text, so every event becomes one line per log family. Spark writes the
lines once per session to the shared folder and the queries scan them as they would scan real logs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rules import ERROR_TYPE_WORDS, HRESULT_NAMES, PACKAGE_ACTIONS, SEVERITY_WORDS
from ..session import shared_dir
from ..sources import synthetic

# --- message pools: a line for every rule word, near misses in the other letter case, successes -----
_CALM = (
    "Started Session 12 of user root", "daily apt upgrade finished", "Reached target Timers",
    "link is up at 1000 Mbps", "checkpoint complete: wrote 12 buffers", "synchronized to time server",
)
_OVERLAPS = (
    "oom killer ran", "segfault error", "a]: b error", "kernel bug after process crash", "warning: high usage",
    "malloc failed: out of memory", "critical warning", "  padded line with error  ", "Failed password: a:b",
    "CPU fault and GPU fault", "process freeze, terminated by signal 9",
)


def _words(families: tuple[str, ...]) -> list[str]:
    found: dict[str, None] = {}
    for family in families:
        for words in SEVERITY_WORDS.get(family, {}).values():
            found.update(dict.fromkeys(words))
        for group in ERROR_TYPE_WORDS.get(family, ()):
            for _, words in group:
                found.update(dict.fromkeys(words))
    return list(found)


def _pool(families: tuple[str, ...], extra: tuple[str, ...] = ()) -> tuple[str, ...]:
    words = _words(families)
    swapped = [f"saw {w.swapcase()} once" for w in words]
    return (*(f"{w} on unit" for w in words), *swapped, *_CALM * (1 + len(words) // 12), *extra)


SYSLOG_MESSAGES = _pool(("mem", "proc", "ubu", "mac"), _OVERLAPS)
SOLARIS_MESSAGES = _pool(("sol",), ("connection from 10.0.0.9", "refused connect from host9", "FTPD: EXPORT file a"))
SOLARIS_TAGS = ("success", "warning", "error", "critical", "fatal", "info")
SYSTEM_MESSAGES = _pool(("wsys",), ("Chkdsk was executed\tin read-only mode", "Chkdsk error\tcritical"))
CBS_MESSAGES = (
    *_pool(("cbs",)),
    *(f"Failed to open package [HRESULT = {code} - {name}]" for code, name in HRESULT_NAMES),
    *(f"Appl: result [HRESULT={code}]" for code, _ in HRESULT_NAMES),
    "Loaded Servicing Stack v6.1", "SQM: Failed [HRESULT =  0x80070002]", "HRESULT without a value", "",
)
AUTH_MESSAGES = (
    "pam_unix(sshd:auth): authentication failure; logname= uid=0 euid=0 tty=ssh ruser= rhost=10.0.0.1  user=root",
    "pam_unix(su:auth): authentication failure; logname=ann uid=1000 ruser=ann rhost=  user=bob",
    "pam_unix(sudo:auth): authentication failure; logname=eve ruser=eve rhost=",
    "  ann : TTY=pts/0 ; PWD=/home/ann ; USER=root ; COMMAND=/bin/ls -l",
    "bob : PWD=/srv ; USER=www-data] ; COMMAND=/usr/bin/apt]]",
    "pam_unix(sshd:session): session opened for user ann by (uid=0)",
    "pam_unix(cron:session): session opened for user root by (uid=0)",
    "pam_unix(cron:session): session closed for user root",
    "Accepted publickey for ann from 10.0.0.7 port 50222 ssh2", "Authentication Failure in capitals",
    "Session opened in capitals", "Received disconnect from 10.0.0.7",
)
ACTIONS = (*PACKAGE_ACTIONS, "status", "trigproc", "startup")
LEVELS = ("Information", "Warning", "Error")
SECURITY_ACTIONS = ("Logon", "Logoff", "Special Logon", "User Account Management", "Credential Validation")
SYSTEM_HEADER = ("Level", "Source", "Date and Time", "Event ID", "Task Category")
PAGING_HEADER = ("pgpgin/s", "pgpgout/s")
SAR_METRICS = {"memory": ("kbmemfree", "kbavail"), "paging": ("pgpgin", "pgpgout"), "swapping": ("pswpin", "pswpout")}


def _list(pool: tuple[str, ...], spark: bool) -> str:
    """SQL array literal."""
    if spark:
        quoted = ("'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'" for text in pool)
        return f"array({', '.join(quoted)})"
    return "[" + ", ".join("'" + text.replace("'", "''") + "'" for text in pool) + "]"


def _dialect(spark: bool) -> dict[str, str]:
    """Fragments on which the two SQL dialects differ."""
    def pick(pool, number):
        if spark:
            return f"element_at({_list(pool, True)}, cast(({number}) % {len(pool)} + 1 as int))"
        return f"({_list(pool, False)})[({number}) % {len(pool)} + 1]"

    def stamp(java, c):
        return f'date_format(ts, "{java}")' if spark else f"strftime(ts, '{c}')"

    return {
        "pick": pick,
        "k": "cast(get_json_object(props, '$.k') as bigint)" if spark
        else "cast(json_extract_string(props, '$.k') as bigint)",
        "iso": stamp("yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "%Y-%m-%dT%H:%M:%S.%f"),
        "month": stamp("MMM", "%b"),
        "day": stamp("yyyy-MM-dd", "%Y-%m-%d"),
        "day_first": stamp("dd-MM-yyyy", "%d-%m-%Y"),
        "clock": stamp("HH:mm:ss", "%H:%M:%S"),
        "hour": stamp("HH", "%H"),
        "tab": "chr(9)",
    }


def line_sql(kind: str, spark: bool) -> str:
    """SQL expression over ``events`` for one line of a family."""
    d = _dialect(spark)
    pick, k = d["pick"], d["k"]
    text = lambda e: f"cast({e} as string)" if spark else f"cast({e} as varchar)"
    bsd = f"{d['month']} || ' ' || lpad({text('day(ts)')}, 2, ' ') || ' ' || {d['clock']}"
    host = f"' host' || {text('user_id % 3')} || ' '"
    tag = f"case when user_id % 11 = 0 then 'kernel: ' else event_type || '[' || {text('event_id')} || ']: ' end"
    number = f"event_id * 7 + {k}"
    broken = f"'    at frame ' || {text('event_id')}"
    tab = f" || {d['tab']} || "
    if kind == "iso":
        line = f"{d['iso']} || '+00:00' || {host} || {tag} || {pick(SYSLOG_MESSAGES, number)}"
        return f"case when event_id % 97 = 13 then {broken} else {line} end"
    if kind == "bsd":
        return f"{bsd} || {host} || {tag} || {pick(SYSLOG_MESSAGES, number)}"
    if kind == "mixed":
        whole = f"case when event_id % 2 = 0 then {line_sql('iso', spark)} else {line_sql('bsd', spark)} end"
        return (  # now and then a day or month that does not exist
            "case when event_id % 101 = 7 then '2024-13-45T10:00:00.1+00:00 h a[1]: error' "
            f"when event_id % 101 = 8 then 'Foo  9 10:00:00 h a[1]: error' else {whole} end"
        )
    if kind == "sol":
        return (
            f"{bsd} || ' solaris-host genunix: [ID ' || {text('event_id % 1000')} || ' kern.' || "
            f"{pick(SOLARIS_TAGS, k)} || '] ' || {pick(SOLARIS_MESSAGES, number)}"
        )
    if kind == "auth":
        return (
            f"{d['iso']} || '+00:00' || {host} || {pick(('sudo', 'sshd', 'cron', 'su'), 'user_id')} || '[' || "
            f"{text('event_id')} || ']: ' || {pick(AUTH_MESSAGES, number)}"
        )
    if kind == "dpkg":
        return (
            f"{d['day']} || ' ' || {d['hour']} || ':00:00 ' || {pick(ACTIONS, k)} || ' pkg' || "
            f"{text('user_id % 7')} || ':amd64 1.' || {text(k)} || ' 2.' || {text(k)}"
        )
    if kind == "cbs":
        line = (
            f"{d['day']} || ' ' || {d['clock']} || ', Info                  ' || "
            f"{pick(('CBS', 'CSI'), 'user_id')} || '    ' || {pick(CBS_MESSAGES, number)}"
        )
        return f"case when event_id % 97 = 13 then {broken} else {line} end"
    if kind == "wsys":
        whole = (
            f"{pick(LEVELS, k)}{tab}'Src-' || event_type{tab}{d['day_first']} || ' ' || {d['clock']}{tab}"
            f"{text('event_id')}{tab}'None'{tab}{pick(SYSTEM_MESSAGES, number)}"
        )
        short = f"{pick(LEVELS, k)}{tab}'Src-' || event_type{tab}{d['day_first']}"
        return f"case when user_id % 13 = 0 then {short} else {whole} end"
    if kind == "wsec":
        return (
            f"'Audit Success'{tab}{d['day_first']} || ' ' || {d['clock']}{tab}"
            f"'Microsoft-Windows-Security-Auditing'{tab}{text('4624 + event_id % 4')}{tab}{pick(SECURITY_ACTIONS, k)}"
        )
    if kind == "metrics":
        return f"{pick(('Memory Usage', 'Disk Usage', 'Swap Usage', 'Load'), 'event_id')}{tab}{text(k)}"
    raise ValueError(kind)


def table_columns(kind: str, spark: bool) -> list[str]:
    """SQL select list over ``events`` for the host tables: host, ps, sar."""
    k, text = _dialect(spark)["k"], "string" if spark else "varchar"
    host = f"concat('host', cast(user_id % 3 as {text})) as host"
    if kind == "host":
        return [
            host, "ts", f"cast((event_id * 37 + {k} * 101) % 16001 as int) as mem_used_mb", "16000 as mem_total_mb",
            f"case when user_id % 7 = 0 then '-' else concat(cast({k} as {text}), '%') end as disk_pct",
            "cast((event_id * 53) % 4097 as int) as swap_used_mb",
            "case when user_id % 5 = 0 then 0 else 4096 end as swap_total_mb",
        ]
    if kind == "ps":
        return [
            f"concat('u', cast(user_id as {text})) as {'`user`' if spark else chr(34) + 'user' + chr(34)}",
            "((event_id * 7919) % 9973) / cast(100 as double) as pct_mem", "event_type as command",
            "event_id", host, "cast(ts as date) as log_date",
        ]
    if kind == "sar":
        return [
            host, "cast(ts as date) as log_date", "date_trunc('second', ts) as ts",
            f"cast({k} as double) as pgpgin", "cast(event_id % 1000 as double) as pgpgout",
        ]
    if kind.startswith("sar_"):
        first, second = SAR_METRICS[kind.removeprefix("sar_")]
        return [*table_columns("sar", spark)[:3], f"cast({k} as double) as {first}", f"cast(event_id % 1000 as double) as {second}"]
    raise ValueError(kind)


def table_sql(kind: str) -> str:
    """DuckDB: one of the host tables."""
    return f"select {', '.join(table_columns(kind, spark=False))} from events"


def lines_sql(kind: str) -> str:
    """DuckDB: ``event_id, value`` of a family's lines."""
    return f"select event_id, ts, {line_sql(kind, spark=False)} as value from events"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _with_header(lines: DataFrame, header: str) -> DataFrame:
    """The header before the first line of every file: each task writes one."""
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    return lines.select(
        F.explode(F.when(first, F.array(F.lit(header), "value")).otherwise(F.array("value"))).alias("value")
    )


def _write(spark: SparkSession, sf_dir: str, kind: str, path: str) -> None:
    source = events(spark, sf_dir)
    if kind in ("host", "ps"):
        source.selectExpr(*table_columns(kind, spark=True)).write.parquet(path)
    elif kind == "sar":
        series = source.selectExpr(*table_columns("sar", spark=True))
        row = F.format_string("%s %8.2f %8.2f", F.date_format("ts", "HH:mm:ss"), "pgpgin", "pgpgout")
        named = series.select(row.alias("value"), "host", "log_date").hint("rebalance", "host", "log_date")
        named.write.partitionBy("host", "log_date").text(path)
    elif kind.startswith("sar_"):
        first, second = SAR_METRICS[kind.removeprefix("sar_")]
        unit = "" if kind == "sar_memory" else "/s"
        turned = F.col("host") == "host1"  # this host's files have their columns the other way round
        series = source.selectExpr(*table_columns(kind, spark=True))
        pair = lambda a, b: F.when(turned, F.concat(b, F.lit("  "), a)).otherwise(F.concat(a, F.lit("  "), b))
        row = F.concat(F.date_format("ts", "HH:mm:ss"), F.lit("  "), pair(F.format_string("%.2f", first), F.format_string("%.2f", second)))
        heads = series.select("host", "log_date").distinct().select(
            F.concat(F.lit("00:00:01  "), pair(F.lit(first + unit), F.lit(second + unit))).alias("value"), "host", "log_date", F.lit(0).alias("at"))
        lines = series.select(row.alias("value"), "host", "log_date", F.lit(1).alias("at")).unionByName(heads)
        lines = lines.repartition("host", "log_date").sortWithinPartitions("host", "log_date", "at").drop("at")
        lines.write.partitionBy("host", "log_date").text(path)
    elif kind == "synthetic":
        ids = source.select(F.col("event_id").alias("id"), "ts")
        lines = synthetic.solaris_lines(ids, F.col("ts"), success_of(F.col("id")), number_of)
        lines.write.text(path)
    else:
        lines = source.select("event_id", F.expr(line_sql(kind, spark=True)).alias("value"))
        if kind in ("iso", "mixed", "dpkg"):  # their queries depend on the order of the lines
            lines = lines.orderBy("event_id")
        lines = lines.select("value")
        if kind == "wsys":
            lines = _with_header(lines, "\t".join(SYSTEM_HEADER))
        lines.write.text(path)


def success_of(id_):
    return id_ % synthetic.LINES < synthetic.SUCCESS_LINES


def number_of(id_, salt):
    """Repeatable choice numbers that any SQL engine can compute."""
    return id_ * (7919 + 2 * salt) + salt


_written: dict[tuple[str, str, str], str] = {}


def derived(spark: SparkSession, sf_dir: str, kind: str) -> str:
    """Path of a family's derived input, written on first use in this session."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _written:
        path = fresh_dir(spark, kind)
        _write(spark, sf_dir, kind, path)
        _written[key] = path
    return _written[key]


_count = iter(range(1 << 62))


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared folder."""
    context = spark.sparkContext
    return f"{shared_dir(spark)}/oslogs/{context.applicationId}-{context.startTime}/{next(_count)}-{name}"
