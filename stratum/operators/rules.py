"""Declarative validation and data-quality rules compiled into one Spark plan.

A rule set for one table becomes a few aggregates over that table:

* row-level rules (NOT_NULL, NON_NEGATIVE, ALLOWED_VALUES, REGEX,
  NUMERIC_RANGE, DATE_RANGE, NULL_PERCENTAGE) are ``count_if`` columns of one
  aggregate: partial aggregation on the map side, only one small row per
  task crosses the network;
* each key of the DUPLICATE_KEY rules is a grouping of its own over a scan of
  the key columns alone; nothing else is in that shuffle;
* DUPLICATE_ROW groups by all columns; where it is asked for, the row-level
  rules are evaluated on the distinct rows of that grouping, weighted by their
  counts, so the table is scanned and shuffled once for both;
* SCHEMA / REQUIRED_COLUMN only look at ``df.columns`` (metadata) and become
  constant rows;
* REFERENTIAL rules (keys that must exist in another table) are extra
  branches: the fact side reduced to distinct keys with counts, anti-joined
  to the reference keys.

DUPLICATE_ROW groups by all columns (exact) or, with ``value="fingerprint"``,
by a 16-byte digest of a lossless JSON form of the row (wide text rows): the
shuffle carries 16 bytes per distinct row, and the chance that two of 2^40
different rows get the same digest is about 2^-48.

The result is a DataFrame with one row per rule:
``rule_name, rule_type, severity, passed, failed_records, details``.
A hot key (one key holding a third of the rows) costs nothing special: the
map-side partial aggregate collapses it to one row per task before the
shuffle.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.errors import ConfigurationError, ValidationError

RESULT_COLUMNS = ["rule_name", "rule_type", "severity", "passed", "failed_records", "details"]
RESULT_DDL = (
    "rule_name string, rule_type string, severity string, passed boolean, "
    "failed_records bigint, details string"
)

# The default severity of each rule type, used when the rule
# metadata gives none.
DEFAULT_SEVERITY = {
    "SCHEMA": "ERROR",
    "REQUIRED_COLUMN": "ERROR",
    "NOT_NULL": "ERROR",
    "NON_NEGATIVE": "ERROR",
    "DUPLICATE_KEY": "ERROR",
    "DUPLICATE_ROW": "WARNING",
    "ALLOWED_VALUES": "ERROR",
    "REGEX": "ERROR",
    "NUMERIC_RANGE": "ERROR",
    "DATE_RANGE": "ERROR",
    "NULL_PERCENTAGE": "WARNING",
    "REFERENTIAL": "ERROR",
    "DUPLICATE_KEY_RUNS": "WARNING",
}

# Result texts.  ``{c}`` is the column (or key list), ``{n}``
# the failing count, other fields are rule parameters; rule names of the
# column rules are "<column> " + the title.
TITLES = {
    "SCHEMA": "Schema Validation",
    "SILVER_SCHEMA": "Silver Schema Validation",
    "REQUIRED_COLUMN": "Required Columns Validation",
    "NOT_NULL": "Not Null Validation",
    "NON_NEGATIVE": "Non-Negative Validation",
    "DUPLICATE_KEY": "Duplicate Key Validation",
    "DUPLICATE_ROW": "Duplicate Row Validation",
    "ALLOWED_VALUES": "Allowed Values Validation",
    "REGEX": "Regex Validation",
    "NUMERIC_RANGE": "Numeric Range Validation",
    "DATE_RANGE": "Date Range Validation",
    "NULL_PERCENTAGE": "Null Percentage Validation",
}
DETAILS = {
    "MISSING_COLUMNS": "Missing columns: {missing}",
    "UNEXPECTED_COLUMNS": "Unexpected columns: {unexpected}",
    "NOT_NULL": "{n} NULL values found in '{c}'.",
    "NON_NEGATIVE": "{n} record(s) have a negative value in '{c}'.",
    "DUPLICATE_KEY": "{n} record(s) belong to duplicate business keys in '{c}'.",
    "DUPLICATE_KEY_RUNS": "{n} record(s) have business keys of earlier loads in '{c}'.",
    "DUPLICATE_ROW": "Found {n} duplicate row(s).",
    "ALLOWED_VALUES": "{n} record(s) contain invalid values for '{c}'.",
    "REGEX": "{n} record(s) failed regex validation.",
    "NUMERIC_RANGE": "{n} record(s) are outside [{lo}, {hi}].",
    "DATE_RANGE": "{n} record(s) are outside {lo} - {hi}.",
    "NULL_PERCENTAGE": "NULL percentage {pct:.2f}% exceeds threshold {threshold:.2f}%.",
}

ROW_RULES = {
    "NOT_NULL", "NON_NEGATIVE", "ALLOWED_VALUES", "REGEX",
    "NUMERIC_RANGE", "DATE_RANGE", "NULL_PERCENTAGE",
}
GROUP_RULES = {"DUPLICATE_KEY", "DUPLICATE_ROW"}
META_RULES = {"SCHEMA", "REQUIRED_COLUMN"}


@dataclass(frozen=True)
class Rule:
    """One rule.  ``column`` may hold several comma-separated key columns for
    DUPLICATE_KEY; ``expected`` is the column list of SCHEMA / REQUIRED_COLUMN."""

    rule_type: str
    column: str | None = None
    value: str | None = None
    threshold: float | None = None
    severity: str | None = None
    label: str | None = None
    expected: tuple[str, ...] | None = None
    name: str | None = None  # overrides the generated rule_name
    display: str | None = None  # key text shown in names/details (internal)

    @property
    def kind(self) -> str:
        return self.rule_type.upper()

    @property
    def effective_severity(self) -> str:
        return (self.severity or DEFAULT_SEVERITY.get(self.kind, "ERROR")).upper()

    @property
    def key_columns(self) -> tuple[str, ...]:
        if self.column is None:
            return ()
        return tuple(c.strip() for c in self.column.split(",") if c.strip())


# --------------------------------------------------------------------------
# parameter parsing (driver side, at compile time)

def parse_allowed_values(value: str | None) -> list[str]:
    if value is None:
        raise ConfigurationError("ALLOWED_VALUES needs a comma-separated rule_value")
    return [v.strip() for v in value.split(",")]


def parse_numeric_range(value: str | None) -> tuple[float, float]:
    try:
        lo, hi = (float(v) for v in (value or "").split(","))
    except ValueError as exc:
        raise ConfigurationError(f"NUMERIC_RANGE needs 'lo,hi', got {value!r}") from exc
    return lo, hi


def parse_date_range(value: str | None) -> tuple[str, str, _dt.date, _dt.date]:
    parts = [v.strip() for v in (value or "").split(",")]
    if len(parts) != 2:
        raise ConfigurationError(f"DATE_RANGE needs 'lo,hi', got {value!r}")
    try:
        lo, hi = (_dt.date.fromisoformat(p) for p in parts)
    except ValueError as exc:
        raise ConfigurationError(f"DATE_RANGE bound is not a date: {value!r}") from exc
    return parts[0], parts[1], lo, hi


# --------------------------------------------------------------------------
# result rows

def _result(rule: Rule, generated: str, failed: Column, details: Column,
            passed: Column | None = None) -> Column:
    failed = F.coalesce(failed.cast("long"), F.lit(0).cast("long"))
    ok = (failed == 0) if passed is None else passed
    return F.struct(
        F.lit(rule.name or generated).alias("rule_name"),
        F.lit(rule.kind).alias("rule_type"),
        F.lit(rule.effective_severity).alias("severity"),
        ok.alias("passed"),
        failed.alias("failed_records"),
        F.when(ok, F.lit("")).otherwise(details).alias("details"),
        F.lit(rule.label).cast("string").alias("rule_label"),
    )


def _const_result(rule: Rule, generated: str, passed: bool, failed: int, details: str) -> Column:
    return F.struct(
        F.lit(rule.name or generated).alias("rule_name"),
        F.lit(rule.kind).alias("rule_type"),
        F.lit(rule.effective_severity).alias("severity"),
        F.lit(passed).alias("passed"),
        F.lit(failed).cast("long").alias("failed_records"),
        F.lit("" if passed else details).alias("details"),
        F.lit(rule.label).cast("string").alias("rule_label"),
    )


def _detail(kind: str, n: Column, **params) -> Column:
    """``DETAILS[kind]`` with ``{n}`` taken from the data and every other field
    filled on the driver (they are rule parameters)."""
    before, after = DETAILS[kind].split("{n}")
    return F.concat(F.lit(before.format(**params)), n.cast("string"), F.lit(after.format(**params)))


def _meta_result(rule: Rule, columns: list[str]) -> Column:
    if rule.kind == "SCHEMA" and rule.expected is None:
        raise ConfigurationError("SCHEMA rule needs the registered column list (expected)")
    expected = list(rule.expected or ())
    if rule.kind == "REQUIRED_COLUMN" and not expected and rule.column:
        expected = list(rule.key_columns)
    missing = [c for c in expected if c not in columns]
    if rule.kind == "SCHEMA":
        unexpected = [c for c in columns if c not in expected]
        parts = []
        if missing:
            parts.append(DETAILS["MISSING_COLUMNS"].format(missing=missing))
        if unexpected:
            parts.append(DETAILS["UNEXPECTED_COLUMNS"].format(unexpected=unexpected))
        ok = not missing and not unexpected
        return _const_result(rule, TITLES["SCHEMA"], ok, 0 if ok else 1, "; ".join(parts))
    ok = not missing
    return _const_result(rule, TITLES["REQUIRED_COLUMN"], ok, 0 if ok else 1,
                         DETAILS["MISSING_COLUMNS"].format(missing=missing))


class _Compiled:
    """Predicates of the row rules plus, per rule, a builder of the result struct."""

    def __init__(self) -> None:
        self.predicates: list[tuple[str, Column]] = []
        self.row_results: list = []      # callables: cols -> struct Column
        self.const_results: list[Column] = []

    def counter(self, predicate: Column) -> str:
        alias = f"__c{len(self.predicates)}"
        self.predicates.append((alias, predicate))
        return alias

    def per_row(self) -> list[Column]:
        """Counters over rows."""
        return [F.count(F.lit(1)).alias("__n")] + [F.count_if(p).alias(a) for a, p in self.predicates]

    def per_group(self) -> list[Column]:
        """The same counters over groups of equal rows of size ``__n``."""
        return [F.sum("__n").alias("__n")] + [
            F.sum(F.when(p, F.col("__n"))).alias(a) for a, p in self.predicates]


def _lossless(c: Column, dtype) -> Column:
    """``c`` in a form whose JSON text differs wherever Spark's grouping tells two
    values apart, and only there."""
    kind = dtype.typeName()
    if kind in ("double", "float"):
        return F.when(c == 0, F.lit("0.0")).otherwise(c.cast("string"))  # -0.0 groups with 0.0
    if kind == "timestamp":
        return F.unix_micros(c)
    if kind == "binary":
        return F.hex(c)
    if kind == "array":
        return F.transform(c, lambda x: _lossless(x, dtype.elementType))
    if kind == "map":
        entries = F.transform(F.map_entries(c), lambda e: F.struct(
            _lossless(e["key"], dtype.keyType).alias("k"), _lossless(e["value"], dtype.valueType).alias("v")))
        by_key = F.transform(entries, lambda e: F.struct(F.to_json(F.struct(e["k"])).alias("k"), F.to_json(F.struct(e["v"])).alias("v")))
        return F.array_sort(by_key)  # entries count, their order does not
    if kind == "struct":
        fields = [_lossless(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(c.isNotNull(), F.struct(*fields)) if fields else c
    return c.cast("string")


def _float_in_map(dtype, inside: bool = False) -> bool:
    kind = dtype.typeName()
    if kind in ("double", "float"):
        return inside
    if kind == "array":
        return _float_in_map(dtype.elementType, inside)
    if kind == "map":
        return _float_in_map(dtype.keyType, True) or _float_in_map(dtype.valueType, True)
    return kind == "struct" and any(_float_in_map(f.dataType, inside) for f in dtype.fields)


def _grouped(df: DataFrame, columns: Sequence[str], *aggregates: Column) -> DataFrame:
    """``df`` grouped by columns, which keep their names and values.  Spark's grouping
    takes a NULL float in a map for zero and rewrites the key so; columns with floats in
    maps are therefore grouped by their lossless form."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    lossless = {c: f"__g{i}" for i, c in enumerate(columns) if _float_in_map(fields[c])}
    if not lossless:
        return df.groupBy(*columns).agg(*aggregates)
    df = df.withColumns({g: _lossless(F.col(f"`{c}`"), fields[c]) for c, g in lossless.items()})
    originals = [F.any_value(F.col(f"`{c}`")).alias(c) for c in lossless]
    grouped = df.groupBy(*[lossless.get(c, c) for c in columns]).agg(*originals, *aggregates)
    return grouped.drop(*lossless.values())


def row_fingerprint(df: DataFrame, columns: Sequence[str]) -> Column:
    """128-bit digest of a row (16-byte binary).  JSON keeps field names, so NULLs
    in different columns never look alike (plain column hashes skip NULLs)."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    row = F.struct(*[_lossless(F.col(f"`{c}`"), fields[c]).alias(c) for c in columns])
    return F.unhex(F.md5(F.to_json(row)))


def _resolves(df: DataFrame, column: str | None) -> bool:
    """True when ``column`` (a name or a nested ``a.b`` path) resolves on
    ``df`` — an analysis check, no job is run."""
    if column is None:
        return False
    if column in df.columns:
        return True
    try:
        df.select(F.col(column)).schema  # noqa: B018 - forces analysis only
        return True
    except Exception:  # noqa: BLE001 - unresolvable column
        return False


def _compile_row_rule(rule: Rule, comp: _Compiled, df: DataFrame) -> None:
    c = rule.column
    kind = rule.kind
    if not _resolves(df, c):
        comp.const_results.append(
            _const_result(rule, f"{c} {TITLES[kind]}", False, 0, f"Column '{c}' not found.")
        )
        return
    col = F.col(c)
    title = f"{c} {TITLES[kind]}"
    if kind == "NOT_NULL":
        a = comp.counter(col.isNull())
        comp.row_results.append(lambda g, a=a: _result(
            rule, title, g(a), _detail("NOT_NULL", g(a), c=c)))
    elif kind == "NON_NEGATIVE":
        a = comp.counter(col.try_cast("double") < 0)
        comp.row_results.append(lambda g, a=a: _result(
            rule, title, g(a), _detail("NON_NEGATIVE", g(a), c=c)))
    elif kind == "ALLOWED_VALUES":
        allowed = parse_allowed_values(rule.value)
        a = comp.counter(~col.cast("string").isin(allowed))
        comp.row_results.append(lambda g, a=a: _result(
            rule, title, g(a), _detail("ALLOWED_VALUES", g(a), c=c)))
    elif kind == "REGEX":
        if not rule.value:
            raise ConfigurationError("REGEX needs a pattern in rule_value")
        a = comp.counter(~col.cast("string").rlike(rule.value))
        comp.row_results.append(lambda g, a=a: _result(
            rule, title, g(a), _detail("REGEX", g(a))))
    elif kind == "NUMERIC_RANGE":
        lo, hi = parse_numeric_range(rule.value)
        num = col.try_cast("double")
        a = comp.counter((num < F.lit(lo)) | (num > F.lit(hi)))
        comp.row_results.append(lambda g, a=a: _result(
            rule, title, g(a), _detail("NUMERIC_RANGE", g(a), lo=lo, hi=hi)))
    elif kind == "DATE_RANGE":
        lo_txt, hi_txt, lo, hi = parse_date_range(rule.value)
        d = col.try_cast("date")
        a = comp.counter((d < F.lit(lo)) | (d > F.lit(hi)))
        comp.row_results.append(lambda g, a=a: _result(
            rule, title, g(a), _detail("DATE_RANGE", g(a), lo=lo_txt, hi=hi_txt)))
    elif kind == "NULL_PERCENTAGE":
        threshold = float(rule.threshold if rule.threshold is not None else (rule.value or 0.0))
        a = comp.counter(col.isNull())

        def build(g, a=a, threshold=threshold):
            nulls = F.coalesce(g(a), F.lit(0))
            total = F.coalesce(g("__n"), F.lit(0))
            pct = F.when(total == 0, F.lit(0.0)).otherwise(nulls / total * 100)
            # the percentage is data: its {pct:.2f} becomes a %.2f of format_string
            template = DETAILS["NULL_PERCENTAGE"].replace("%", "%%").replace("{pct:.2f}", "%.2f")
            details = F.format_string(template.format(threshold=threshold), pct)
            return _result(rule, title, nulls, details, passed=pct <= F.lit(threshold))

        comp.row_results.append(build)
    else:  # pragma: no cover - guarded by caller
        raise ConfigurationError(f"not a row rule: {kind}")


def row_failures(df: DataFrame, rules: Sequence[Rule]) -> Column:
    """The names of the row rules that a row fails, as an array.  A column that is
    missing raises; NULL_PERCENTAGE is no property of a row and not allowed."""
    failed = []
    for rule in rules:
        comp = _Compiled()
        if rule.kind not in ROW_RULES or rule.kind == "NULL_PERCENTAGE" or not _resolves(df, rule.column):
            raise ConfigurationError(f"Not a rule of single rows: {rule}")
        _compile_row_rule(rule, comp, df)
        name = rule.name or f"{rule.column} {TITLES[rule.kind]}"
        failed += [F.when(predicate, F.lit(name)) for _, predicate in comp.predicates]
    return F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")


def _dup_key_result(rule: Rule, failed: Column) -> Column:
    label = rule.display or ", ".join(rule.key_columns)
    return _result(rule, f"{label} {TITLES['DUPLICATE_KEY']}", failed,
                   _detail("DUPLICATE_KEY", failed, c=label))


def _dup_row_result(rule: Rule, failed: Column) -> Column:
    return _result(rule, TITLES["DUPLICATE_ROW"], failed, _detail("DUPLICATE_ROW", failed))


def _keys_not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def quality_report(df: DataFrame, rules: Sequence[Rule], count_rows: bool = False,
                   with_label: bool = False,
                   references: dict[str, DataFrame] | None = None) -> DataFrame:
    """Evaluate all ``rules`` on ``df`` in one pass; one result row per rule.

    Unknown rule types raise :class:`ConfigurationError` (at compile time, no
    Spark job is started).  An empty rule set gives an empty result.
    ``count_rows`` adds an informational ``ROW_COUNT`` row whose
    ``failed_records`` holds the number of rows, taken in the same pass.
    ``with_label`` adds ``rule_label`` (the rule's metadata name).
    REFERENTIAL rules (``value="<table>.<column>"``) take the reference table
    from ``references`` or the catalog and are added as anti-join branches.
    """
    columns = list(df.columns)
    comp = _Compiled()
    if count_rows:
        comp.row_results.append(lambda g: F.struct(
            F.lit("Row Count").alias("rule_name"), F.lit("ROW_COUNT").alias("rule_type"),
            F.lit("INFO").alias("severity"), F.lit(True).alias("passed"),
            F.coalesce(g("__n"), F.lit(0)).cast("long").alias("failed_records"),
            F.lit("").alias("details"), F.lit(None).cast("string").alias("rule_label")))
    dup_keys: list[Rule] = []
    dup_rows: list[Rule] = []
    ref_rules: list[Rule] = []
    for rule in rules:
        kind = rule.kind
        if kind in META_RULES:
            comp.const_results.append(_meta_result(rule, columns))
        elif kind in ROW_RULES:
            _compile_row_rule(rule, comp, df)
        elif kind == "DUPLICATE_KEY":
            missing = [k for k in rule.key_columns if not _resolves(df, k)]
            if missing or not rule.key_columns:
                label = ", ".join(rule.key_columns)
                comp.const_results.append(_const_result(
                    rule, f"{label} {TITLES['DUPLICATE_KEY']}", False, 0,
                    f"Column(s) not found: {missing}."))
            else:
                dup_keys.append(rule)
        elif kind == "DUPLICATE_ROW":
            dup_rows.append(rule)
        elif kind == "REFERENTIAL":
            ref_rules.append(rule)
        else:
            raise ConfigurationError(f"Unknown rule type: {rule.rule_type}")

    ref_branches = [_referential_branch(df, r, references) for r in ref_rules]
    if not (comp.row_results or comp.const_results or dup_keys or dup_rows):
        out = empty_report(df.sparkSession).withColumn("rule_label", F.lit(None).cast("string"))
        for b in ref_branches:
            out = out.unionByName(b)
        return out if with_label else out.drop("rule_label")

    # nested key paths (a.b) become flat internal columns before grouping
    alias: dict[str, str] = {}
    for r in dup_keys:
        for k in r.key_columns:
            if k not in columns and k not in alias:
                alias[k] = f"__key{len(alias)}"
    if alias:
        df = df.withColumns({a: F.col(k) for k, a in alias.items()})
        dup_keys = [replace(r, column=", ".join(alias.get(k, k) for k in r.key_columns),
                            display=", ".join(r.key_columns)) for r in dup_keys]

    def inlined(frame: DataFrame, structs: list[Column]) -> DataFrame:
        return frame.select(F.inline(F.array(*structs)))

    branches: list[DataFrame] = []
    exact = [r for r in dup_rows if (r.value or "").lower() != "fingerprint"]
    counted = bool(comp.row_results)
    if exact:
        # all columns are grouping keys: the row rules are evaluated once per
        # distinct row, after the grouping, and weighted by its count
        rows = _grouped(df, columns, F.count(F.lit(1)).alias("__n"))
        final = rows.agg(*comp.per_group(), F.sum(F.col("__n") - 1).alias("__dup"))
        structs = [b(F.col) for b in comp.row_results] + [_dup_row_result(r, F.col("__dup")) for r in exact]
        branches.append(inlined(final, structs + comp.const_results))
    elif counted or comp.const_results:
        # one row per task crosses the network
        final = df.agg(*comp.per_row())
        branches.append(inlined(final, [b(F.col) for b in comp.row_results] + comp.const_results))
    prints = [r for r in dup_rows if r not in exact]
    if prints:
        rows = df.select(row_fingerprint(df, columns).alias("__fp")).groupBy("__fp").agg(F.count(F.lit(1)).alias("__n"))
        final = rows.agg(F.sum(F.col("__n") - 1).alias("__dup"))
        branches.append(inlined(final, [_dup_row_result(r, F.col("__dup")) for r in prints]))
    by_keys: dict[frozenset, list[Rule]] = {}
    for r in dup_keys:
        by_keys.setdefault(frozenset(r.key_columns), []).append(r)
    for same in by_keys.values():
        # the scan reads the key columns only; a hot key is one row per task
        keys = list(dict.fromkeys(same[0].key_columns))
        groups = _grouped(df.select(*keys).filter(_keys_not_null(keys)), keys, F.count(F.lit(1)).alias("__n"))
        final = groups.agg(F.sum(F.when(F.col("__n") > 1, F.col("__n"))).alias("__dup"))
        branches.append(inlined(final, [_dup_key_result(r, F.col("__dup")) for r in same]))

    out = branches[0]
    for b in branches[1:] + ref_branches:
        out = out.unionByName(b)
    return out.select(*RESULT_COLUMNS, *(["rule_label"] if with_label else []))


def empty_report(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], RESULT_DDL)


def gate(report: DataFrame) -> DataFrame:
    """One row: ``passed`` is false iff an ERROR-severity rule failed.

    WARNING failures never block; an empty report passes (``bool_and`` over no
    rows is NULL, hence the ``coalesce``).
    """
    return report.agg(
        F.coalesce(F.bool_and(F.col("passed") | (F.col("severity") != "ERROR")), F.lit(True))
        .alias("passed"),
        F.count(F.lit(1)).alias("n_rules"),
        F.count_if(~F.col("passed")).alias("n_failed"),
        F.count_if(~F.col("passed") & (F.col("severity") == "ERROR")).alias("n_failed_error"),
    )


def gate_passed(report: DataFrame) -> bool:
    """Driver-side boolean of :func:`gate` (collects one row)."""
    return bool(gate(report).first()["passed"])


def raise_on_failure(report: DataFrame, message: str) -> None:
    """Raise :class:`ValidationError` listing the failing ERROR rules."""
    failed = (
        report.filter(~F.col("passed") & (F.col("severity") == "ERROR"))
        .select("details").collect()  # bounded by the number of rules
    )
    if failed:
        details = "; ".join(r["details"] for r in failed if r["details"])
        raise ValidationError(f"{message}: {details}")


# --------------------------------------------------------------------------
# rules stored as a control table

RULES_DDL = (
    "entity_name string, rule_name string, rule_type string, column_name string, "
    "rule_value string, threshold double, severity string, enabled boolean"
)


def rules_for(rules_df: DataFrame, entity_name: str) -> DataFrame:
    """Enabled rules of one entity (a column predicate, never SQL text)."""
    return (
        rules_df.filter((F.col("entity_name") == F.lit(entity_name)) & F.col("enabled"))
        .select("rule_name", "rule_type", "column_name", "rule_value", "threshold", "severity")
    )


def _to_rule(r, entity_name: str, expected_columns, skip_unknown: bool) -> Rule | None:
    import logging

    kind = (r["rule_type"] or "").upper()
    if kind not in DEFAULT_SEVERITY and skip_unknown:
        logging.getLogger("stratum").warning(
            "skipping rule %r of %r: unknown type %r", r["rule_name"], entity_name, kind)
        return None
    expected = None
    if kind == "SCHEMA" and expected_columns is not None:
        expected = tuple(expected_columns)
    elif kind == "REQUIRED_COLUMN" and r["column_name"]:
        expected = tuple(c.strip() for c in r["column_name"].split(","))
    return Rule(rule_type=kind, column=r["column_name"], value=r["rule_value"],
                threshold=r["threshold"], severity=r["severity"], label=r["rule_name"],
                expected=expected)


def load_rules_by_entity(rules_df: DataFrame, entity_names: Sequence[str],
                         expected_columns: dict | None = None,
                         skip_unknown: bool = True) -> dict[str, list[Rule]]:
    """Enabled rules of several entities with ONE collect (rule rows are small)."""
    rows = (rules_df.filter(F.col("entity_name").isin(list(entity_names)) & F.col("enabled"))
            .select("entity_name", "rule_name", "rule_type", "column_name", "rule_value",
                    "threshold", "severity").collect())
    out: dict[str, list[Rule]] = {e: [] for e in entity_names}
    for r in rows:
        rule = _to_rule(r, r["entity_name"], (expected_columns or {}).get(r["entity_name"]),
                        skip_unknown)
        if rule is not None:
            out[r["entity_name"]].append(rule)
    return out


def load_rules(rules_df: DataFrame, entity_name: str,
               expected_columns: Sequence[str] | None = None,
               skip_unknown: bool = True) -> list[Rule]:
    """Collect an entity's enabled rules (rule metadata is small) into ``Rule``s.

    SCHEMA rules compare with ``expected_columns`` (the registered schema) —
    never with the frame's own columns.  Rows with an unknown ``rule_type`` are
    skipped (with a warning) unless ``skip_unknown`` is false; each result
    carries its own severity, so a skipped row cannot shift another's.
    """
    return load_rules_by_entity(rules_df, [entity_name], {entity_name: expected_columns},
                                skip_unknown)[entity_name]


def stamp_results(report: DataFrame, run_id: str, entity_name: str) -> DataFrame:
    """Persisted form: the result rows plus run id, entity and execution time."""
    return report.select(
        F.lit(run_id).alias("run_id"), F.lit(entity_name).alias("entity_name"),
        *RESULT_COLUMNS, F.current_timestamp().alias("execution_time"),
    )


def _referential_branch(df: DataFrame, rule: Rule, references: dict | None) -> DataFrame:
    """One REFERENTIAL rule as a result branch (all six columns + label)."""
    target = (rule.value or "").strip()
    if "." not in target:
        raise ConfigurationError(f"REFERENTIAL needs '<table>.<column>', got {rule.value!r}")
    table_name, ref_column = target.rsplit(".", 1)
    ref_df = (references or {}).get(table_name)
    if ref_df is None:
        ref_df = df.sparkSession.table(table_name)
    if not _resolves(df, rule.column):
        return df.sparkSession.range(1).select(F.inline(F.array(_const_result(
            rule, f"{rule.column} Referential Integrity Validation", False, 0,
            f"Column '{rule.column}' not found."))))
    return _referential(df, rule, ref_df, ref_column)


def _referential(df: DataFrame, rule: Rule, ref_df: DataFrame, ref_column: str) -> DataFrame:
    column = rule.column
    keys = (df.filter(F.col(column).isNotNull())
            .groupBy(F.col(column).alias("__k")).agg(F.count(F.lit(1)).alias("__n")))
    ref = ref_df.select(F.col(ref_column).alias("__k"))
    missing = keys.join(ref, "__k", "left_anti").agg(F.sum("__n").alias("__m"))
    n = F.coalesce(F.col("__m"), F.lit(0))
    res = _result(rule, f"{column} Referential Integrity Validation", F.col("__m"),
                  F.concat(n.cast("string"),
                           F.lit(f" record(s) reference keys missing from '{ref_column}'.")))
    return missing.select(F.inline(F.array(res)))


def referential_report(df: DataFrame, column: str, ref_df: DataFrame, ref_column: str,
                       severity: str = "ERROR") -> DataFrame:
    """Rows whose non-NULL ``column`` value has no match in ``ref_df.ref_column``.

    The fact side is first reduced to (key, row count) — a partial aggregate,
    so a hot key costs one row per task — and only those distinct keys meet
    the reference keys in the anti join.
    """
    rule = Rule("REFERENTIAL", column, severity=severity)
    return _referential(df, rule, ref_df, ref_column).select(*RESULT_COLUMNS)

