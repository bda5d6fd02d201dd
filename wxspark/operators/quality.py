"""Declarative one-pass data-quality engine.

``validate(df)`` flags every row against every rule on the *full* input (a row may hit
several rules), keeps rows without a critical flag, and summarises the issues:

* ``flagged``     input + one boolean column per rule + ``critical`` + ``issue_list``
* ``clean``       rows without a critical flag
* ``quarantine``  rows with a critical flag, with the list of rules they broke
* ``warnings``    rows kept in spite of a warning, with the list of rules they broke
* ``issues``      one row per rule that fired (count, id span, offending value span, and the
  ids and values of its ``SAMPLE_ROWS`` first rows by id)
* ``summary``     one row: counts, pass rate, issue entry counts, status
* ``null_counts`` NULL count per column of the clean rows (only > 0)

Scale notes: the only shuffle is the duplicate rule. It pre-aggregates
``min(order)``/``count`` per key (map-side combine, so a hot key costs one row per
task), keeps only keys seen more than once and joins that back; AQE splits a skewed
key on the big side and broadcasts the key side only when its runtime size is small.
Issue and summary statistics are conditional aggregates over the flagged rows: one
partial aggregate per task, no row ever collected.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wxspark.functions import expr as X

CRITICAL = "CRITICAL"
WARNING = "WARNING"

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for equal results.
# ---------------------------------------------------------------------------
REQUIRED_COLUMNS = ("city", "temperature_c", "humidity_pct", "pressure_hpa", "weather_condition", "recorded_at")
TEMP_RANGE = (-90.0, 60.0)
HUMIDITY_RANGE = (0, 100)
PRESSURE_RANGE = (870, 1085)
DUPLICATE_KEY = ("city", "recorded_at")
MIN_CITY_LENGTH = 2

#: Offending rows that the issue list shows for a rule; all of them are in the quarantine,
#: the warnings and the detail queries.
SAMPLE_ROWS = 5


@dataclass(frozen=True)
class Rule:
    """A row-level check. ``violation`` must be a boolean column that is never NULL."""

    rule_id: str
    check: str
    severity: str
    column: str | None
    message: str
    violation: Column | None = field(default=None, compare=False)
    value: Column | None = field(default=None, compare=False)
    valid_range: tuple | None = None
    # Optional SQL forms of ``violation`` / ``value``: built-in rules use them so a
    # validation plan is assembled with a handful of JVM calls instead of thousands.
    violation_sql: str | None = None
    value_sql: str | None = None

    def violation_col(self) -> Column:
        return F.expr(self.violation_sql) if self.violation_sql else self.violation

    def value_expr(self) -> str | Column | None:
        return self.value_sql if self.value_sql else self.value


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _lit_sql(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"{v!r}D"
    if isinstance(v, int):
        return str(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def null_rule(column: str) -> Rule:
    return Rule(
        rule_id=f"null_{column}",
        check="NULL_VALUE",
        severity=CRITICAL,
        column=column,
        message=f"{column} must not be empty",
        violation_sql=f"{_q(column)} IS NULL",
    )


def range_rule(column: str, lo, hi, critical: bool = True) -> Rule:
    """Out of [lo, hi]; NULL never violates (pandas comparisons with NA are false)."""
    c = _q(column)
    return Rule(
        rule_id=f"range_{column}",
        check="RANGE_VIOLATION",
        severity=CRITICAL if critical else WARNING,
        column=column,
        message=f"{column} must lie from {lo} to {hi}",
        violation_sql=f"coalesce({c} < {_lit_sql(lo)} OR {c} > {_lit_sql(hi)}, false)",
        value_sql=f"CAST({c} AS DOUBLE)",
        valid_range=(float(lo), float(hi)),
    )


def short_text_rule(column: str, min_length: int = MIN_CITY_LENGTH) -> Rule:
    """Shorter than ``min_length``; NULL never violates, "" does."""
    return Rule(
        rule_id=f"short_{column}",
        check="SUSPICIOUS_CITY_NAME",
        severity=WARNING,
        column=column,
        message=f"{column} needs {min_length} characters or more",
        violation_sql=f"coalesce(length({_q(column)}) < {int(min_length)}, false)",
    )


DUPLICATE_RULE_ID = "duplicate"


def duplicate_rule(keys=DUPLICATE_KEY) -> Rule:
    """Marker rule; the flag itself is computed by :func:`mark_duplicates`."""
    return Rule(
        rule_id=DUPLICATE_RULE_ID,
        check="DUPLICATE_RECORD",
        severity=CRITICAL,
        column=",".join(keys),
        message=f"{', '.join(keys)}: repeats an earlier row",
        violation_sql="_is_duplicate",
    )


def default_rules() -> list[Rule]:
    """The six checks, in the reference's order (NULLs, 3 ranges, duplicates, city name)."""
    return [
        *[null_rule(c) for c in REQUIRED_COLUMNS],
        range_rule("temperature_c", *TEMP_RANGE, critical=True),
        range_rule("humidity_pct", *HUMIDITY_RANGE, critical=True),
        range_rule("pressure_hpa", *PRESSURE_RANGE, critical=False),
        duplicate_rule(),
        short_text_rule("city"),
    ]


# ---------------------------------------------------------------------------
# "keep first" per key without a window over a possibly hot key
# ---------------------------------------------------------------------------

def mark_duplicates(df: DataFrame, keys=DUPLICATE_KEY, order_col: str = "obs_id", flag: str = "_is_duplicate",
                    first_col: str | None = None) -> DataFrame:
    """Add ``flag`` = row is not the first (smallest ``order_col``) of its key.

    NULL keys compare equal (as pandas ``duplicated`` does). ``order_col`` must be unique
    per row; any orderable type works (e.g. a struct of extraction time, file, position).
    Only keys occurring more than once reach the join; a hot key is pre-aggregated
    map-side to one row per task and split by AQE's skew handling on the probe side.
    """
    renamed = [f"_dk{i}" for i in range(len(keys))]
    firsts = (
        df.groupBy(*[F.col(k).alias(r) for k, r in zip(keys, renamed)])
        .agg(F.min(order_col).alias("_first_order"), F.count(F.lit(1)).alias("_key_rows"))
        .where(F.col("_key_rows") > 1)
        .drop("_key_rows")
    )
    cond = [df[k].eqNullSafe(firsts[r]) for k, r in zip(keys, renamed)]
    joined = df.join(firsts, cond, "left")
    out = joined.withColumn(flag, F.coalesce(F.col(order_col) != F.col("_first_order"), F.lit(False)))
    if first_col:
        out = out.withColumn(first_col, F.coalesce(F.col("_first_order"), F.col(order_col)))
    return out.drop("_first_order", *renamed)


# ---------------------------------------------------------------------------
# engine
# ---------------------------------------------------------------------------

@dataclass
class Validation:
    flagged: DataFrame
    rules: list[Rule]
    columns: list[str]
    id_col: str = "obs_id"

    @property
    def clean(self) -> DataFrame:
        return self.flagged.where(~F.col("critical")).select(*self.columns)

    @property
    def quarantine(self) -> DataFrame:
        return self.flagged.where(F.col("critical")).select(*self.columns, "issue_list")

    @property
    def warnings(self) -> DataFrame:
        warned = F.lit(False)
        for r in self.rules:
            if r.severity == WARNING:
                warned = warned | F.col(f"f_{r.rule_id}")
        return self.flagged.where(~F.col("critical") & warned).select(*self.columns, "issue_list")

    def issues(self, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
        return issues_frame(self.flagged, self.rules, self.id_col, sample_rows)

    def samples(self, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
        return issue_samples(self.flagged, self.rules, self.id_col, sample_rows)

    def summary(self) -> DataFrame:
        return summary_frame(self.flagged, self.rules, self.id_col)

    def with_flagged(self, flagged: DataFrame) -> "Validation":
        """Same rules over a materialised copy of the flagged rows (lineage cut)."""
        return Validation(flagged=flagged, rules=self.rules, columns=self.columns, id_col=self.id_col)

    def null_counts(self) -> DataFrame:
        return null_counts_frame(self.clean, self.columns)


def validate(df: DataFrame, rules: list[Rule] | None = None, order_col: str = "obs_id",
             id_col: str = "obs_id") -> Validation:
    """Flag ``df`` against ``rules``. ``order_col`` decides which duplicate is first;
    ``id_col`` identifies rows in the issue statistics."""
    rules = default_rules() if rules is None else rules
    columns = df.columns
    flagged = df
    dup = [r for r in rules if r.rule_id == DUPLICATE_RULE_ID]
    if dup:
        keys = tuple(dup[0].column.split(","))
        flagged = mark_duplicates(flagged, keys, order_col)
    flagged = flagged.select("*", *[r.violation_col().alias(f"f_{r.rule_id}") for r in rules])
    # One predicate over all critical flags (a count, not an OR): it cannot be split into
    # per-column conjuncts, so the clean/quarantine filter stays above the duplicate join
    # and every flag expression is evaluated once, in the same parallel stage.
    crit_hits = " + ".join(f"CAST({_q('f_' + r.rule_id)} AS INT)" for r in rules if r.severity == CRITICAL)
    crit = f"{crit_hits} > 0" if crit_hits else "false"
    issue_list = ", ".join(f"CASE WHEN {_q('f_' + r.rule_id)} THEN {_lit_sql(r.rule_id)} END" for r in rules)
    flagged = flagged.selectExpr("*", f"({crit}) AS critical", f"concat_ws(',', {issue_list}) AS issue_list")
    return Validation(flagged=flagged, rules=rules, columns=columns, id_col=id_col)


def rule_stats(flagged: DataFrame, rules: list[Rule], order_col: str = "obs_id") -> DataFrame:
    """One row with count / id span / value span per rule (single partial aggregate).

    Both the issue list and the summary derive from it; materialise it once when both
    are needed (one pass over the flagged rows)."""
    o = _q(order_col)
    aggs: list = []
    for r in rules:
        f, rid = _q(f"f_{r.rule_id}"), r.rule_id
        aggs += [
            F.expr(f"count_if({f}) AS {_q(rid + '__n')}"),
            F.expr(f"min(CASE WHEN {f} THEN {o} END) AS {_q(rid + '__first')}"),
            F.expr(f"max(CASE WHEN {f} THEN {o} END) AS {_q(rid + '__last')}"),
        ]
        v = r.value_expr()
        if isinstance(v, Column):
            aggs += [F.min(F.when(F.col(f"f_{rid}"), v)).alias(f"{rid}__vmin"), F.max(F.when(F.col(f"f_{rid}"), v)).alias(f"{rid}__vmax")]
        else:
            vs = v or "CAST(NULL AS DOUBLE)"
            aggs += [
                F.expr(f"min(CASE WHEN {f} THEN {vs} END) AS {_q(rid + '__vmin')}"),
                F.expr(f"max(CASE WHEN {f} THEN {vs} END) AS {_q(rid + '__vmax')}"),
            ]
    aggs += [F.expr("count(1) AS __original"), F.expr("count_if(NOT critical) AS __clean")]
    return flagged.agg(*aggs)


def merge_stats(parts: DataFrame) -> DataFrame:
    """The :func:`rule_stats` rows of several disjoint batches as the row of all of them."""
    def merged(name: str) -> Column:
        if name.endswith(("__first", "__vmin")):
            return F.min(name)
        if name.endswith(("__last", "__vmax")):
            return F.max(name)
        return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")

    return parts.agg(*[merged(c).alias(c) for c in parts.columns])


def issue_samples(flagged: DataFrame, rules: list[Rule], id_col: str = "obs_id", k: int = SAMPLE_ROWS) -> DataFrame:
    """(rule_order, row_id, value) of the ``k`` smallest ids that each rule flags."""
    def value(r: Rule) -> Column:
        v = r.value_expr()
        return F.lit(None).cast("double") if v is None else (F.expr(v) if isinstance(v, str) else v).cast("double")

    hits = [
        F.when(F.col(f"f_{r.rule_id}"), F.struct(F.lit(pos).alias("rule_order"), value(r).alias("value")))
        for pos, r in enumerate(rules)
    ]
    rows = flagged.select(F.col(id_col).alias("row_id"), F.explode(F.array_compact(F.array(*hits))).alias("h"))
    return smallest_rows(rows.select("h.rule_order", "row_id", "h.value"), k)


def smallest_rows(samples: DataFrame, k: int = SAMPLE_ROWS) -> DataFrame:
    """The ``k`` smallest ids a rule. The limit on the rank is also applied before the
    shuffle, by each task, so a rule that flags every row sends ``k`` rows a task. Applied to
    the samples of several batches it gives the sample of all of them."""
    first = F.row_number().over(Window.partitionBy("rule_order").orderBy("row_id", "value"))
    return samples.withColumn("_rank", first).where(F.col("_rank") <= k).drop("_rank")


def with_samples(issues: DataFrame, samples: DataFrame) -> DataFrame:
    """Issue rows + ``sample_ids`` and ``sample_values``: at most ``k`` of each, by id."""
    lists = samples.groupBy("rule_order").agg(F.sort_array(F.collect_list(F.struct("row_id", "value"))).alias("s"))
    return issues.join(lists, "rule_order", "left").select(
        *issues.columns, F.col("s.row_id").alias("sample_ids"), F.col("s.value").alias("sample_values")
    )


def issues_frame(flagged: DataFrame, rules: list[Rule], order_col: str = "obs_id", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    issues = issues_from_stats(rule_stats(flagged, rules, order_col), rules)
    return with_samples(issues, issue_samples(flagged, rules, order_col, sample_rows))


def issues_from_stats(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    entries = []
    for pos, r in enumerate(rules):
        lo, hi = r.valid_range if r.valid_range else (None, None)
        rid = r.rule_id
        entries.append(
            "named_struct("
            f"'rule_order', {pos}, 'check', {_lit_sql(r.check)}, 'column', CAST({_lit_sql(r.column)} AS STRING), "
            f"'severity', {_lit_sql(r.severity)}, 'valid_min', CAST({_lit_sql(lo)} AS DOUBLE), "
            f"'valid_max', CAST({_lit_sql(hi)} AS DOUBLE), 'affected_rows', {_q(rid + '__n')}, "
            f"'first_row_id', {_q(rid + '__first')}, 'last_row_id', {_q(rid + '__last')}, "
            f"'min_value', CAST({_q(rid + '__vmin')} AS DOUBLE), 'max_value', CAST({_q(rid + '__vmax')} AS DOUBLE), "
            f"'message', {_lit_sql(r.message)})"
        )
    return (
        stats.selectExpr(f"explode(array({', '.join(entries)})) AS i")
        .selectExpr("i.*")
        .where("affected_rows > 0")
    )


def summary_frame(flagged: DataFrame, rules: list[Rule], order_col: str = "obs_id") -> DataFrame:
    return summary_from_stats(rule_stats(flagged, rules, order_col), rules)


def summary_from_stats(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    def total(sel) -> str:
        hits = [f"CAST({_q(r.rule_id + '__n')} > 0 AS INT)" for r in rules if sel(r)]
        return " + ".join(hits) if hits else "0"

    return stats.selectExpr(
        "__original AS original_record_count",
        "__clean AS clean_record_count",
        "__original - __clean AS dropped_record_count",
        "CASE WHEN __original > 0 THEN rint(CAST(__clean AS DOUBLE) / __original * 100D * 10D) / 10D ELSE 0D END"
        " AS pass_rate_pct",
        f"{total(lambda r: True)} AS total_issues",
        f"{total(lambda r: r.severity == CRITICAL)} AS critical_issues",
        f"{total(lambda r: r.severity == WARNING)} AS warning_issues",
        "CASE WHEN __original = 0 THEN 'SKIPPED' WHEN __original - __clean = 0 THEN 'PASSED' ELSE 'PARTIAL' END AS status",
    )


def null_counts_frame(clean: DataFrame, columns: list[str]) -> DataFrame:
    """NULL count per column of the clean rows, only columns with a count > 0."""
    counts = clean.agg(*[F.expr(f"count_if({_q(c)} IS NULL) AS {_q(c)}") for c in columns])
    pairs = ", ".join(f"named_struct('column', {_lit_sql(c)}, 'null_count', {_q(c)})" for c in columns)
    return counts.selectExpr(f"explode(array({pairs})) AS p").selectExpr("p.*").where("null_count > 0")
