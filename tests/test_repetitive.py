"""Rules on different messages instead of rows: the same reports from fewer searches."""

import pytest

import oslogs
from oslogs.operators import severity
from oslogs.plans.derived import derived

LOGS = {"mem": "mixed", "proc": "mixed", "ubu": "mixed", "mac": "mixed", "sol": "sol", "cbs": "cbs", "wsys": "wsys"}


def rows_of(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


@pytest.mark.parametrize("kind", LOGS)
def test_reports_are_the_same(spark, sf_dir, kind):
    made = [oslogs.report(oslogs.analyze(spark, kind, "2024-01-01", last="2024-12-31", path=derived(spark, sf_dir, LOGS[kind]), repetitive=r), kind) for r in (False, True)]
    assert made[0]["analysis_summary"].first().total > 100
    for name, table in made[0].items():
        assert rows_of(table) == rows_of(made[1][name]), name


def test_rules_follow_the_counts(spark, log):
    path = log(*["2024-11-09T10:00:00.1 h a[1]: error here"] * 500, "2024-11-09T10:00:00.1 h b[1]: fine")
    rows = oslogs.analyze(spark, "mem", "2024-11-09", path=path, repetitive=True)
    assert sorted((r.message, r.n) for r in rows.collect()) == [("error here", 500), ("fine", 1)]
    plan = severity.severity_by_app(rows)._jdf.queryExecution().sparkPlan().toString()
    steps = [line.strip(" +-:").split("(")[0].split(" ")[0] for line in plan.splitlines()]
    # from the end: count per application, rules, count per message, scan
    assert steps.index("Generate") > steps.index("HashAggregate") and "HashAggregate" in steps[steps.index("Generate"):]


def test_other_families_have_no_such_report(spark, log):
    with pytest.raises(ValueError, match="severities"):
        oslogs.analyze(spark, "dpkg", "2024-11-09", path=log("x"), repetitive=True)
