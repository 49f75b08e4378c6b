"""Rule data for classifying and tagging log messages.

Everything in this module is a fixed value: the words, labels and orders decide
the results and are matched case-sensitively as plain substrings.
"""

from __future__ import annotations

# --- Fixed values: severity words per family, tested in this order ------------
SEVERITY_WORDS: dict[str, dict[str, tuple[str, ...]]] = {
    "mem": {
        "severe_error": ("kernel bug", "OOM", "out of memory", "critical", "disk failure", "I/O error"),
        "mild_error": ("error", "fail", "failed"),
        "warning": ("warning", "deprecated", "high usage", "not recommended"),
    },
    "proc": {
        "severe_error": (
            "kernel bug", "process crash", "process hang", "process killed", "CPU fault", "GPU failure", "critical",
        ),
        "mild_error": ("error", "fail", "failed", "CPU warning", "GPU warning", "process issue"),
        "warning": ("warning", "deprecated", "high usage", "not recommended"),
    },
    "ubu": {
        "severe_error": (
            "kernel bug", "process crash", "process hang", "process killed", "CPU fault", "GPU failure", "critical",
            "OOM", "out of memory", "disk failure", "I/O error",
        ),
        "mild_error": ("error", "fail", "failed", "CPU warning", "GPU warning", "process issue"),
        "warning": ("warning", "deprecated", "high usage", "not recommended"),
    },
    "mac": {
        "severe_error": (
            "kernel panic", "EXC_BAD_ACCESS", "EXC_CRASH", "kernel crash", "panic", "out of memory",
            "critical error", "disk failure", "I/O error", "process crash", "process killed", "system fault",
        ),
        "mild_error": (
            "error", "fail", "failed", "crash", "terminated", "signal fault", "process issue", "application error",
            "memory warning", "CPU warning", "GPU warning",
        ),
        "warning": (
            "warning", "deprecated", "high memory usage", "low disk space", "disk warning", "not recommended",
            "slow response",
        ),
    },
    "sol": {
        "severe_error": (
            "kernel bug", "OOM", "out of memory", "critical", "disk failure", "I/O error", "process crash",
            "process hang", "process killed", "CPU fault", "GPU failure", "fatal", "PAM_ERROR_MSG",
            "Account is disabled", "authentication failed", "disk corruption",
        ),
        "mild_error": (
            "error", "fail", "failed", "CPU warning", "GPU warning", "process issue", "login failure",
            "connection refused",
        ),
        "warning": (
            "warning", "deprecated", "high usage", "not recommended", "repeated login failures",
            "performance degradation",
        ),
    },
    "wsys": {
        "severe_error": (
            "kernel bug", "OOM", "out of memory", "critical", "disk failure", "I/O error", "Chkdsk",
        ),
        "mild_error": ("error", "fail", "failed"),
        "warning": ("warning", "deprecated", "high usage", "not recommended"),
    },
    "cbs": {
        "severe_error": ("Error", "E_FAIL", "CBS_E_", "FATAL", "CRITICAL"),
        "mild_error": ("Failed", "HRESULT"),
        "warning": ("Warning", "WARN"),
    },
}

# --- Fixed values: authentication event kinds, first hit wins -----------------
AUTH_WORDS: tuple[tuple[str, str], ...] = (
    ("auth_failure", "authentication failure"),
    ("sudo", "COMMAND="),
    ("session", "session opened"),
)

# --- Fixed values: error types ------------------------------------------------
# A family has independent groups; inside a group the first matching type wins.
_PROCESS = (
    ("process crash", ("process crash",)),
    ("process hang", ("process hang",)),
    ("process killed", ("kernel bug", "process killed")),
)
_CPU = (("cpu error", ("CPU fault", "CPU overload", "CPU failure")),)
_GPU = (("gpu error", ("GPU failure", "GPU overload", "GPU fault")),)
_MEMORY = (
    ("oom", ("oom", "OOM", "out of memory")),
    ("segfault", ("segfault", "Segmentation fault")),
    ("malloc", ("malloc",)),
    ("kernel bug", ("kernel bug",)),
    ("critical", ("critical",)),
    ("disk failure", ("disk failure", "I/O error")),
)

ERROR_TYPE_WORDS: dict[str, tuple[tuple[tuple[str, tuple[str, ...]], ...], ...]] = {
    "mem": (_MEMORY,),
    "proc": (_PROCESS, _CPU, _GPU),
    "ubu": (_PROCESS, _CPU, _GPU, _MEMORY),
    "mac": (
        (
            ("oom", ("out of memory", "OOM", "memory pressure", "EXC_RESOURCE")),
            ("segfault", ("segfault", "EXC_CRASH", "EXC_BAD_ACCESS", "core dump")),
            ("malloc", ("malloc error", "memory allocation failure")),
            ("kernel bug", ("kernel panic", "panic", "EXC_BAD_ACCESS", "EXC_CRASH")),
            ("critical", (
                "critical error", "fatal error", "system failure", "unhandled exception", "system fault",
            )),
            ("disk failure", ("disk failure", "I/O error", "disk read error", "disk write error")),
        ),
        (
            ("process crash", ("process crash", "terminated due to signal", "terminated by signal")),
            ("process hang", ("process hang", "process freeze")),
            ("process killed", ("process killed", "killed by signal")),
        ),
        (("cpu error", ("CPU fault", "CPU overload", "CPU failure", "CPU panic")),),
        (("gpu error", ("GPU failure", "GPU overload", "GPU fault", "GPU panic")),),
    ),
    "sol": (
        (
            ("out of memory", ("out of memory",)),
            ("oom", ("oom", "OOM")),
            ("segfault", ("segfault", "Segmentation fault")),
            ("malloc", ("malloc",)),
        ),
        (
            ("PAM error", ("PAM_ERROR_MSG",)),
            ("login failure", ("repeated login failures",)),
            ("account disabled", ("Account is disabled",)),
        ),
        (("connection issue", ("connection from", "refused connect from")),),
        (("ftp", ("FTPD: IMPORT", "FTPD: EXPORT")),),
        _CPU,
        _GPU,
    ),
    "wsys": (
        (
            ("Out of Memory", ("OOM", "out of memory")),
            ("Kernel Bug", ("kernel bug",)),
            ("Critical", ("critical",)),
            ("Disk Failure", ("disk failure", "I/O error", "Chkdsk")),
        ),
    ),
}

# --- Fixed values: rows of the printed error tables (type, message), in order -
_MEMORY_LABELS = (
    ("oom", "oom"),
    ("segfault", "segfault"),
    ("malloc", "malloc"),
    ("kernel bug", "kernel bug"),
    ("critical", "critical"),
    ("disk failure", "disk failure / I/O error"),
)
_PROCESS_LABELS = (
    ("process crash", "process crash"),
    ("process hang", "process hang"),
    ("process killed", "process killed"),
    ("cpu error", "cpu fault"),
    ("gpu error", "gpu failure"),
)

ERROR_TABLE: dict[str, tuple[tuple[str, str], ...]] = {
    "mem": _MEMORY_LABELS,
    "proc": _PROCESS_LABELS,
    "ubu": _MEMORY_LABELS + _PROCESS_LABELS,
    "mac": _MEMORY_LABELS + _PROCESS_LABELS,
    # "ftp" is counted for Solaris but has no row in its table.
    "sol": (
        ("out of memory", "out of memory"),
        ("oom", "oom"),
        ("segfault", "segfault"),
        ("malloc", "malloc"),
        ("PAM error", "PAM_ERROR_MSG"),
        ("login failure", "repeated login failures"),
        ("account disabled", "Account is disabled"),
        ("connection issue", "connection refused or denied"),
        ("cpu error", "cpu fault"),
        ("gpu error", "gpu failure"),
    ),
    "wsys": (
        ("Out of Memory", "Out of Memory"),
        ("Kernel Bug", "Kernel Bug"),
        ("Critical", "Critical Error"),
        ("Disk Failure", "Disk Failure / I/O Error"),
    ),
}

# --- Fixed values: component-servicing result codes ---------------------------
HRESULT_NAMES: tuple[tuple[str, str], ...] = (
    ("0x80004005", "E_FAIL"),
    ("0x800f080d", "CBS_E_MANIFEST_INVALID_ITEM"),
    ("0x800f0805", "CBS_E_INVALID_PACKAGE"),
)

# --- Fixed values: package actions, report order ------------------------------
PACKAGE_ACTIONS: tuple[str, ...] = ("install", "upgrade", "remove", "configure", "unpack")

# --- Fixed values: category orders and the labels of the exported tables ------
CATEGORIES: tuple[str, ...] = ("severe_error", "mild_error", "warning", "success")
SEVERITY_LABELS: dict[str, str] = {
    "severe_error": "Severe Error", "mild_error": "Mild Error", "warning": "Warning",
}
ERROR_COUNT_LABELS: tuple[tuple[str, str], ...] = (
    ("Severe Errors", "severe"), ("Mild Errors", "mild"), ("Warnings", "warning"), ("Successes", "net_success"),
)
AUTH_COUNT_LABELS: tuple[tuple[str, str], ...] = (
    ("Authentication Failures", "auth_failures"), ("Sudo Privileges", "sudo_commands"),
    ("Session Openings", "sessions"), ("Other Events", "other_events"),
)

# --- Fixed values: default inputs per family ----------------------------------
DEFAULT_PATHS: dict[str, str] = {
    "mem": "/var/log/syslog",
    "proc": "/var/log/syslog",
    "ubu": "/var/log/syslog",
    "dpkg": "/var/log/dpkg.log.1",
    "auth": "/var/log/auth.log",
    "auth_t": "/var/log/auth.log",
}

# --- Fixed values: names of the months in year-less log dates -----------------
MONTHS: tuple[str, ...] = (
    "Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
)
