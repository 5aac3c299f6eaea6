"""Data-quality and constraint audits (Q1-Q16).

Spark does not enforce PK / FK / CHECK / NOT NULL / NUMERIC(p,s) / VARCHAR(n) on
plain tables, so the declared constraints of the star schema become audits that
return findings as small tables. Every audit is one scan with a global or keyed
aggregate; keyed ones (duplicates, orphans) aggregate map-side first, so a key
that holds a third of all rows is collapsed before it is shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import mean, quotient
from ..schema import CSV_SCHEMA, TABLE_SPECS, TableSpec
from ..session import materialize
from . import positions

NULL_PROFILE = ("credit_limit", "gender", "education", "marital_status", "age", "default_raw")
CATEGORY_COLUMNS = ("gender", "education", "marital_status", "timeliness_1")
# Source columns as delivered in the CSV (no surrogate key; 'default' is default_raw).
SOURCE_COLUMNS = tuple("default_raw" if f.name == "default" else f.name for f in CSV_SCHEMA.fields)
DESCRIBE_COLUMNS = SOURCE_COLUMNS[:10]
# Text columns whose value frequencies serve both the category audit and describe.
FREQUENCY_COLUMNS = tuple(dict.fromkeys(CATEGORY_COLUMNS + tuple(
    c for c in DESCRIBE_COLUMNS if c not in ("credit_limit", "age"))))


def _union(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def row_count(raw: DataFrame) -> DataFrame:
    """Q1."""
    return raw.agg(F.count(F.lit(1)).cast("bigint").alias("total_rows"))


def null_profile(raw: DataFrame, columns=NULL_PROFILE) -> DataFrame:
    """Q2: COUNT(*) FILTER (WHERE c IS NULL) for each column, one pass."""
    name = {"default_raw": "null_default"}
    return raw.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(name.get(c, f"null_{c}"))
                     for c in columns])


def missing_total(raw: DataFrame, columns=SOURCE_COLUMNS) -> DataFrame:
    """Q3: total missing cells over all source columns (``isna().sum().sum()``)."""
    total = sum((F.col(c).isNull().cast("long") for c in columns[1:]), F.col(columns[0]).isNull().cast("long"))
    return raw.agg(F.sum(total).cast("bigint").alias("missing_cells"))


def duplicate_keys(raw: DataFrame, key: str = "customer_id") -> DataFrame:
    """Q4: keys that occur more than once."""
    return (raw.groupBy(key).agg(F.count(F.lit(1)).cast("bigint").alias("row_count"))
            .where(F.col("row_count") > 1))


def duplicate_rows(raw: DataFrame, columns=SOURCE_COLUMNS) -> DataFrame:
    """Q5: surplus copies of identical source rows (``duplicated().sum()``); NULLs compare
    equal, as in GROUP BY and pandas. Exact, in two phases:

    1. count a 64-bit hash of every row (map-side aggregation; 16 bytes per row cross
       the shuffle instead of the whole row) and write the hashes seen more than once;
    2. verify only rows carrying a candidate hash with an exact GROUP BY over all the
       columns (hash collisions fall apart here). The grouping keys leave the hash out, so
       the semi-join's partitions are not reused and a hash that a third of the rows share
       can be split by the skew rule; its copies then meet in partial counts."""
    h = F.xxhash64(*columns)
    cand = materialize(raw.select(h.alias("_h")).groupBy("_h").count().where(F.col("count") > 1)
                       .select("_h"), "duplicate_candidates")
    rows = raw.select(h.alias("_h"), *columns).join(cand, "_h", "left_semi")
    groups = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def range_check(raw: DataFrame) -> DataFrame:
    """Q6: age NOT BETWEEN 18 AND 100 OR credit_limit <= 0 (three-valued: NULL age alone
    is not flagged)."""
    cond = ~F.col("age").between(18, 100) | (F.col("credit_limit") <= 0)
    return raw.where(cond).select("customer_id", F.col("age").cast("bigint").alias("age"),
                                  F.col("credit_limit").cast("double").alias("credit_limit"))


def value_frequencies(raw: DataFrame, columns) -> DataFrame:
    """(column_name, value, n) for text columns, NULL values included: one scan (stack +
    partial aggregate). Its size is the number of distinct category values, not of rows."""
    expr = "stack({}, {}) AS (column_name, value)".format(
        len(columns), ", ".join(f"'{c}', {c}" for c in columns))
    return raw.select(F.expr(expr)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def category_audit(raw: DataFrame, columns=CATEGORY_COLUMNS, freq: DataFrame | None = None) -> DataFrame:
    """Q7: distinct raw values of the categorical columns (NULL included), one scan; or read
    from a stored ``value_frequencies`` table covering the columns."""
    if freq is not None:
        return (freq.where(F.col("column_name").isin(list(columns))).select("column_name", "value")
                .orderBy("column_name", F.col("value").asc_nulls_last()))
    expr = "stack({}, {}) AS (column_name, value)".format(
        len(columns), ", ".join(f"'{c}', {c}" for c in columns))
    return raw.select(F.expr(expr)).distinct().orderBy("column_name", F.col("value").asc_nulls_last())


def pk_audit(tables: dict[str, DataFrame], specs: dict[str, TableSpec] = TABLE_SPECS) -> DataFrame:
    """Q9: per table, rows vs distinct keys, keys with duplicates and surplus rows."""
    out = []
    for name, df in tables.items():
        key = list(specs[name].key)
        per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
        out.append(per_key.agg(
            F.lit(name).alias("table_name"),
            F.lit(",".join(key)).alias("key_columns"),
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total_rows"),
            F.count(F.lit(1)).cast("bigint").alias("distinct_keys"),
            F.count_if(F.col("n") > 1).cast("bigint").alias("duplicate_keys"),
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("excess_rows"),
        ))
    return _union(out)


def fk_audit(tables: dict[str, DataFrame], specs: dict[str, TableSpec] = TABLE_SPECS, co_bucketed: bool = False) -> DataFrame:
    """Q10: child rows whose key has no parent row.

    A parent and its children are unioned as (key, tag) and counted with ONE GROUP BY key: a
    conditional count per child and one for the parent, aggregated map-side, so a key that
    holds a third of all rows is collapsed before the shuffle; a key without parent rows is
    an orphan. A NULL key has no parent.

    ``co_bucketed``: the tables lie in equal buckets of the key. Counts per key are then taken
    in each bucket, and a child's are joined with the parent's without moving a row (outer on
    both sides: a one-sided join puts a filter between the union of a table's batches and the
    join, and Spark then forgets the buckets)."""
    by_parent: dict[tuple[str, str], list[str]] = {}
    for name in tables:
        parent = specs[name].parent
        if parent is not None and parent[0] in tables:
            by_parent.setdefault(parent, []).append(name)
    out = []
    for (parent, key), children in by_parent.items():
        if co_bucketed:
            known = tables[parent].groupBy(key).agg(F.count(F.lit(1)).alias("_p"))
            for c in children:
                met = tables[c].groupBy(key).agg(F.count(F.lit(1)).alias("_n")).join(known, key, "full_outer")
                lost = F.coalesce(F.sum(F.when(F.col("_p").isNull(), F.col("_n"))), F.lit(0)).cast("bigint")
                out.append(met.agg(F.lit(c).alias("child_table"), F.lit(parent).alias("parent_table"), lost.alias("orphan_rows")))
            continue
        tagged = _union([tables[c].select(key, F.lit(i).alias("_tag")) for i, c in enumerate([*children, parent])])
        per_key = tagged.groupBy(key).agg(*[F.count_if(F.col("_tag") == i).alias(f"n{i}") for i in range(len(children) + 1)])
        orphans = per_key.where(F.col(key).isNull() | (F.col(f"n{len(children)}") == 0))
        wide = orphans.agg(*[F.coalesce(F.sum(f"n{i}"), F.lit(0)).cast("bigint").alias(f"o{i}")
                             for i in range(len(children))])
        stack = "stack({}, {}) AS (child_table, parent_table, orphan_rows)".format(
            len(children), ", ".join(f"'{c}', '{parent}', o{i}" for i, c in enumerate(children)))
        out.append(wide.select(F.expr(stack)))
    return _union(out)


def check_audit(tables: dict[str, DataFrame], specs: dict[str, TableSpec] = TABLE_SPECS) -> DataFrame:
    """Q11: rows violating each CHECK (a NULL result does not violate, as in SQL)."""
    out = []
    for name, df in tables.items():
        for col, cond in specs[name].checks.items():
            out.append(df.agg(F.lit(name).alias("table_name"), F.lit(cond).alias("check_name"),
                              F.count_if(~F.expr(cond)).cast("bigint").alias("violations")))
    return _union(out)


def notnull_audit(tables: dict[str, DataFrame], specs: dict[str, TableSpec] = TABLE_SPECS) -> DataFrame:
    """Q12: NULLs in NOT NULL columns, one aggregate per table, returned long."""
    out = []
    for name, df in tables.items():
        cols = list(specs[name].not_null)
        wide = df.agg(*[F.count_if(F.col(c).isNull()).cast("bigint").alias(c) for c in cols])
        expr = "stack({}, {}) AS (column_name, null_rows)".format(len(cols), ", ".join(f"'{c}', `{c}`" for c in cols))
        out.append(wide.select(F.lit(name).alias("table_name"), F.expr(expr)))
    return _union(out)


def _domain_rules(spec: TableSpec) -> list[tuple[str, str, Column]]:
    rules = []
    for c, (p, s) in spec.numeric.items():
        rules.append((c, f"NUMERIC({p},{s})",
                      F.col(c).isNotNull() & F.col(c).try_cast(f"decimal({p},{s})").isNull()))
    for c, n in spec.varchar.items():
        rules.append((c, f"VARCHAR({n})", F.char_length(F.col(c)) > F.lit(n)))
    if spec.name in ("staging_raw_credit_data", "fact_repayment_history"):
        codes = [c for c in spec.varchar if c.startswith("timeliness")]
        for c in codes:
            parsed = F.replace(F.col(c), F.lit("m"), F.lit("")).try_cast("int")
            rules.append((c, "repayment code", F.col(c).isNotNull() & parsed.isNull()))
    return rules


def domain_audit(tables: dict[str, DataFrame], specs: dict[str, TableSpec] = TABLE_SPECS) -> DataFrame:
    """Q13/Q14: values outside NUMERIC(p,s), strings longer than VARCHAR(n) and repayment
    codes that do not parse; one aggregate per table."""
    out = []
    for name, df in tables.items():
        rules = _domain_rules(specs[name])
        if not rules:
            continue
        wide = df.agg(*[F.count_if(cond).cast("bigint").alias(f"r{i}") for i, (_, _, cond) in enumerate(rules)])
        expr = "stack({}, {}) AS (column_name, rule, violations)".format(
            len(rules), ", ".join(f"'{c}', '{r}', r{i}" for i, (c, r, _) in enumerate(rules)))
        out.append(wide.select(F.lit(name).alias("table_name"), F.expr(expr)))
    return _union(out)


PROFILE_SCHEMA = "table_name string, column_name string, kind string, rule string, not_null int, violations bigint"


def profile(tables: dict[str, DataFrame], specs: dict[str, TableSpec] = TABLE_SPECS) -> DataFrame:
    """One aggregate pass per table computing every single-pass audit number at once.

    Long rows (table_name, column_name, kind, rule, not_null, violations) with kinds
    ``rows`` (row count), ``null`` (NULLs of every column; ``not_null`` marks the
    declared NOT NULL ones), ``domain`` (NUMERIC / VARCHAR / repayment-code rules) and
    ``check`` (CHECK constraints). Q1, Q2, Q3, Q8, Q11, Q12 and Q13/Q14 are projections
    of this small table, so the audit suite costs one scan per table."""
    out = []
    for name, df in tables.items():
        spec = specs[name]
        items = [("*", "rows", "COUNT(*)", 0, F.count(F.lit(1)))]
        items += [(c, "null", "IS NULL", int(c in spec.not_null), F.count_if(F.col(c).isNull()))
                  for c in df.columns]
        items += [(c, "domain", rule, 0, F.count_if(cond)) for c, rule, cond in _domain_rules(spec)]
        items += [(c, "check", cond, 0, F.count_if(~F.expr(cond))) for c, cond in spec.checks.items()]
        wide = df.agg(*[e.cast("bigint").alias(f"v{i}") for i, (*_, e) in enumerate(items)])
        stack = "stack({}, {}) AS (column_name, kind, rule, not_null, violations)".format(
            len(items), ", ".join(f"'{c}', '{k}', '{r}', {nn}, v{i}" for i, (c, k, r, nn, _) in enumerate(items)))
        out.append(wide.select(F.lit(name).alias("table_name"), F.expr(stack)))
    return _union(out)


def notnull_from_profile(prof: DataFrame) -> DataFrame:
    """Q12 from the profile."""
    return (prof.where((F.col("kind") == "null") & (F.col("not_null") == 1))
            .select("table_name", "column_name", F.col("violations").alias("null_rows")))


def domain_from_profile(prof: DataFrame) -> DataFrame:
    """Q13/Q14 from the profile."""
    return prof.where(F.col("kind") == "domain").select("table_name", "column_name", "rule", "violations")


def check_from_profile(prof: DataFrame) -> DataFrame:
    """Q11 from the profile."""
    return prof.where(F.col("kind") == "check").select("table_name", F.col("rule").alias("check_name"), "violations")


def _table_rows(prof: DataFrame, table: str, kind: str) -> DataFrame:
    return prof.where((F.col("table_name") == table) & (F.col("kind") == kind))


def row_count_from_profile(prof: DataFrame, table: str = "staging_raw_credit_data") -> DataFrame:
    """Q1 from the profile."""
    return _table_rows(prof, table, "rows").select(F.col("violations").alias("total_rows"))


def null_profile_from_profile(prof: DataFrame, table: str = "staging_raw_credit_data",
                              columns=NULL_PROFILE) -> DataFrame:
    """Q2 from the profile (one row, one column per profiled column)."""
    name = {"default_raw": "null_default"}
    nulls = _table_rows(prof, table, "null")
    return nulls.agg(*[F.max(F.when(F.col("column_name") == c, F.col("violations")))
                       .alias(name.get(c, f"null_{c}")) for c in columns])


def missing_from_profile(prof: DataFrame, table: str = "staging_raw_credit_data",
                         columns=SOURCE_COLUMNS) -> DataFrame:
    """Q3 from the profile: NULL cells summed over the source columns."""
    nulls = _table_rows(prof, table, "null").where(F.col("column_name").isin(list(columns)))
    return nulls.agg(F.coalesce(F.sum("violations"), F.lit(0)).cast("bigint").alias("missing_cells"))


def default_rate(raw: DataFrame) -> DataFrame:
    """Q15: share of rows whose default text is exactly 'yes' (the exploratory analysis'
    case-sensitive test), next to the SQL rule LOWER(...) = 'yes'; 4 dp."""
    n = F.count(F.lit(1))
    return raw.agg(
        quotient(F.count_if(F.col("default_raw") == F.lit("yes")), n, 4).cast("double").alias("default_rate"),
        quotient(F.count_if(F.lower(F.col("default_raw")) == F.lit("yes")), n, 4).cast("double")
        .alias("default_rate_sql"),
    )


def describe(raw: DataFrame, columns=DESCRIBE_COLUMNS, digits: int = 6,
             freq: DataFrame | None = None) -> DataFrame:
    """Q16: ``describe(include='all')`` of the first source columns, one row per column.

    Strings: count, unique, top (most frequent; ties -> smallest value), freq.
    Numbers: count, mean, std (sample), min, exact linear quartiles, max (integral or
    DECIMAL columns; quartiles come from ``positions.quantiles_linear``).
    Mean and std are rounded to ``digits`` places so results do not depend on the
    summation order of doubles. ``freq``: a stored ``value_frequencies`` table covering the
    text columns, so their statistics need no further scan."""
    types = dict(raw.dtypes)
    numeric = [c for c in columns if not types[c].startswith("string")]
    text = [c for c in columns if types[c].startswith("string")]
    parts = []
    if text:
        src = freq if freq is not None else value_frequencies(raw, text)
        freq = src.where(F.col("column_name").isin(text) & F.col("value").isNotNull())
        # top = most frequent value, ties -> smallest value: min_by over (-n, value) is an
        # ordinary partial/final aggregate, so no column's distinct values meet in one task.
        parts.append(freq.groupBy("column_name").agg(
            F.sum("n").cast("bigint").alias("count"),
            F.count(F.lit(1)).cast("bigint").alias("unique"),
            F.min_by("value", F.struct((-F.col("n")).alias("neg_n"), F.col("value").alias("v"))).alias("top"),
            F.max("n").cast("bigint").alias("freq"),
        ).select("column_name", "count", "unique", "top", "freq",
                 *[F.lit(None).cast("double").alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")]))
    # Exact quartiles of all numeric columns in shared bounded-selection passes
    # (no column is gathered into one task).
    keys = {}
    for c in numeric:
        sc = getattr(raw.schema[c].dataType, "scale", 0)
        keys[c] = ((F.col(c) * F.lit(10 ** sc)).cast("bigint") if sc else F.col(c).cast("bigint"), sc)
    quart = positions.quantiles_linear(raw, keys, [0.25, 0.5, 0.75]) if keys else {}
    # One aggregate for all numeric columns; the mean is the exact sum over the count.
    if numeric:
        stats = {"count": lambda c: F.count(c).cast("bigint"), "mean": lambda c: mean(F.col(c), digits, frac=keys[c][1]),
                 "std": lambda c: F.round(F.stddev_samp(F.col(c).cast("double")), digits),
                 "min": lambda c: F.min(F.col(c).cast("double")), "max": lambda c: F.max(F.col(c).cast("double"))}
        wide = raw.agg(*[stat(c).alias(f"{c}_{name}") for c in numeric for name, stat in stats.items()])
        rows = ", ".join(f"'{c}', " + ", ".join(f"`{c}_{name}`" for name in stats) for c in numeric)
        long = wide.select(F.expr(f"stack({len(numeric)}, {rows}) AS (column_name, {', '.join(stats)})"))
        quartile = {p: F.create_map(*[x for c in numeric for x in (F.lit(c), F.lit(quart[c][1][i]).cast("double"))])
                    for i, p in enumerate(("p25", "p50", "p75"))}
        none = F.lit(None)
        parts.append(long.select(
            "column_name", "count", none.cast("bigint").alias("unique"), none.cast("string").alias("top"),
            none.cast("bigint").alias("freq"), "mean", "std", "min",
            *[m[F.col("column_name")].cast("double").alias(p) for p, m in quartile.items()], "max"))
    return _union(parts)
