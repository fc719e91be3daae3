"""Data checks: specifications in, one result row (stage, test, status, message) per check out.

All checks of a table share one scan and one shuffle: keys are counted by grouping sets, of which the empty one takes the
checks of single rows. Groups are counted after a partial aggregation, so a hot key costs one row per task. Only
references are joined apart.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import number
from ..schemas import CDC_COLUMNS, CHECK_RESULT, TABLES


@dataclass(frozen=True)
class Check:
    """One check: `kind` is a key of `KINDS` or `columns`, `cdc`, `duplicates`, `unique`, `key`, `references`."""

    stage: str
    kind: str
    table: str
    column: str | None = None
    columns: tuple[str, ...] = ()
    min_rows: int = 1
    values: tuple[str, ...] = ()
    parent: str | None = None
    parent_column: str | None = None
    max_length: int = 0
    test: str | None = None

    @property
    def base(self) -> str:
        return self.table.split(".")[-1]


def _not_numeric(c: Column) -> Column:
    return c.isNotNull() & number(c.cast("string")).isNull()


# Per kind the name of the test and the text of its message. `{t}` is the table, `{b}` its name
# without schema, `{s}` the stage, `{c}` the column, `{n}` the count found, `{m}` the minimum.
NAMES = {
    "columns": "extract_schema_{b}", "cdc": "cdc_{b}", "rows": "{s}_rowcount_{b}",
    "not_empty": "extract_notempty_{b}", "not_null": "{s}_notnull_{b}_{c}", "not_null@transform": "transform_null_{b}_{c}",
    "duplicates": "transform_dedup_{b}_{c}", "unique": "load_unique_{b}_{c}",
    "numeric": "transform_dtype_{b}_{c}", "references": "load_fk_{b}_{c}", "positive": "positive_{b}_{c}",
    "in_set": "value_in_set_{b}_{c}", "lineage": "lineage_exists", "length": "length_{b}_{c}", "key": "key_{b}",
}
MESSAGES = {
    "rows": "{t} tem {n} registros (minimo: {m})", "not_empty": "{t} ({n} registros)",
    "not_null": "{t}.{c}: {n} nulos", "duplicates": "{t}: {n} duplicatas em {c}",
    "unique": "{t}.{c}: {n} duplicatas", "numeric": "{t}.{c}: {n} valores nao numericos",
    "references": "{t}.{c}: {n} chaves invalidas", "positive": "{t}.{c}: {n} negativos",
    "in_set": "{t}.{c}: {n} invalidos", "lineage": "{t} tem {n} registros",
    "length": "{t}.{c}: {n} textos longos demais", "key": "{t}: {n} chaves repetidas",
}

# Counts a single scan can take: kind to the Column that counts.
KINDS: dict[str, Callable[[Check], Column]] = {
    "rows": lambda k: F.count("*"),
    "not_empty": lambda k: F.count("*"),
    "lineage": lambda k: F.count("*"),
    "not_null": lambda k: F.count_if(F.col(k.column).isNull()),
    "numeric": lambda k: F.count_if(_not_numeric(F.col(k.column))),
    "positive": lambda k: F.count_if(F.col(k.column) < 0),
    "length": lambda k: F.count_if(F.length(k.column) > k.max_length),
    "in_set": lambda k: F.count_if(~F.coalesce(F.col(k.column).isin(*k.values), F.lit(False))),
}


def duplicate_keys(df: DataFrame, *columns: str) -> DataFrame:
    """How many keys occur more than once (`n`), and how many rows they have together (`n_rows`)."""
    return (df.groupBy(*columns).count().filter("count > 1")
            .agg(F.count("*").alias("n"), F.coalesce(F.sum("count"), F.lit(0)).alias("n_rows")))


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """The child keys without a parent and their row counts; a NULL key has none.

    The child is counted per key first, so the join sees each key once.
    """
    keys = child.groupBy(F.col(column).alias("_key")).agg(F.count("*").alias("n"))
    known = parent.select(F.col(parent_column).alias("_key"))
    return keys.join(known, "_key", "left_anti").withColumnRenamed("_key", column)


def _fill(text: str, k: Check) -> str:
    return text.format(t=k.table, b=k.base, s=k.stage, c=k.column, m=k.min_rows, n="%d")


def _name(k: Check) -> str:
    return k.test or _fill(NAMES.get(f"{k.kind}@{k.stage}", NAMES[k.kind]), k)


def _passes(k: Check, n: Column) -> Column:
    if k.kind == "rows":
        return n >= k.min_rows
    return n > 0 if k.kind in ("not_empty", "lineage") else n == 0


def _result(k: Check, n: Column) -> Column:
    return F.struct(
        F.lit(k.stage).alias("stage"), F.lit(_name(k)).alias("test"),
        F.when(_passes(k, n), "PASS").otherwise("FAIL").alias("status"),
        F.format_string(_fill(MESSAGES[k.kind], k), n).alias("message"))


#: Kinds that count keys: whether a key with a NULL is one, and what is counted of the repeated keys.
KEY_KINDS = {"duplicates": (True, "1"), "unique": (True, "_n"), "key": (False, "1")}


def _key(k: Check) -> tuple[str, ...]:
    return tuple(dict.fromkeys(k.columns if k.kind == "key" else (k.column,)))


def _counted(df: DataFrame, scans: list[Check], keyed: list[Check]) -> DataFrame:
    """One row with the count of every check, `c0`, `c1` and so on: first those of `scans`, then those of `keyed`."""
    counts = [KINDS[k.kind](k).alias(f"c{i}") for i, k in enumerate(scans)]
    if not keyed:
        return df.agg(*counts)
    columns = list(dict.fromkeys(c for k in keyed for c in _key(k)))
    renamed = df.withColumns({f"_k{i}": F.col(c) for i, c in enumerate(columns)})  # the checks still see every value
    names = {c: f"_k{i}" for i, c in enumerate(columns)}
    sets = [*([[]] if scans else []), *dict.fromkeys(tuple(sorted(names[c] for c in _key(k))) for k in keyed)]
    groups = renamed.groupingSets([list(s) for s in sets], *names.values()).agg(
        F.grouping_id(*names.values()).alias("_set"), F.count("*").alias("_n"), *counts)

    def number(own: set[str]) -> int:  # a bit per column that is not in the set, the first column's highest
        return sum(1 << (len(columns) - 1 - i) for i in range(len(columns)) if f"_k{i}" not in own)
    rows = [F.coalesce(F.max(F.when(F.col("_set") == number(set()), F.col(f"c{i}"))), F.lit(0)).alias(f"c{i}") for i in range(len(scans))]
    for i, k in enumerate(keyed, len(scans)):
        own = {names[c] for c in _key(k)}
        with_nulls, what = KEY_KINDS[k.kind]
        twice = (F.col("_set") == number(own)) & (F.col("_n") > 1)
        for name in () if with_nulls else sorted(own):
            twice &= F.col(name).isNotNull()
        rows.append(F.coalesce(F.sum(F.when(twice, F.expr(what))), F.lit(0)).alias(f"c{i}"))
    return groups.agg(*rows)


def _column_rows(spark: SparkSession, checks: list[Check], tables: dict[str, DataFrame | None]) -> DataFrame:
    rows = []
    for k in checks:
        df = tables[k.table]
        wanted = CDC_COLUMNS if k.kind == "cdc" and not k.columns else k.columns
        missing = [c for c in wanted if df is None or c not in df.columns]
        if df is None:
            message = f"{k.table} nao existe"
        elif missing:
            message = f"{k.table}: colunas faltando {missing}"
        else:
            message = f"{k.table}: {len(df.columns)} colunas"
        ok = df is not None and not missing
        rows.append((k.stage, _name(k), "PASS" if ok else "FAIL", message))
    return spark.createDataFrame(rows, CHECK_RESULT)


def run_checks(spark: SparkSession, checks: list[Check], resolve: Callable[[str], DataFrame | None]) -> DataFrame:
    """Results of all checks. `resolve` gives a table's frame, or None when there is no such table."""
    names = {k.table for k in checks} | {k.parent for k in checks if k.parent}
    tables = {t: resolve(t) for t in sorted(names)}
    gone = [k for k in checks if tables[k.table] is None or (k.parent and tables[k.parent] is None)]
    by_schema = [k for k in checks if k.kind in ("columns", "cdc") or k in gone]
    parts = [_column_rows(spark, by_schema, tables)] if by_schema else []

    for table, df in tables.items():
        mine = [k for k in checks if k.table == table and k not in by_schema]
        scans = [k for k in mine if k.kind in KINDS]
        keyed = [k for k in mine if k.kind in KEY_KINDS]
        if scans or keyed:
            counted = _counted(df, scans, keyed)
            parts.append(counted.select(F.inline(F.array(*[_result(k, F.col(f"c{i}")) for i, k in enumerate(scans + keyed)]))))
        for k in mine:
            if k.kind == "references":
                lost = orphans(df, k.column, tables[k.parent], k.parent_column or k.column)
                total = lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
                parts.append(total.select(_result(k, F.col("n")).alias("r")).select("r.*"))
    return reduce(DataFrame.unionByName, parts)


# The check lists of the full suite and of the mart suite.
SHOP_COLUMNS = {
    "books": ("product_id", "name", "price", "source", "_extract_ts"),
    "amazon": ("product_id", "name", "price", "_extract_ts"),
    "americanas": ("product_id", "name", "_extract_ts"),
    "kabum": ("product_id", "name", "_extract_ts"),
}
MART_SOURCES = ("amazon", "americanas", "kabum")
MART_TIERS = ("Economico", "Medio", "Premium", "Luxo")
MART_IDS = (("dim_books", "book_id", "book_name"), ("dim_products", "id", "product_name"))


def full_suite() -> list[Check]:
    """29 checks over raw, staging, marts, change columns and lineage."""
    checks = [Check("extract", "columns", f"raw.{s}", columns=c) for s, c in SHOP_COLUMNS.items()]
    checks += [Check("extract", "not_empty", f"raw.{s}") for s in SHOP_COLUMNS]
    checks += [Check("transform", "not_null", f"staging.stg_{s}", c) for s in SHOP_COLUMNS for c in ("product_id", "name")]
    checks += [Check("transform", "duplicates", "staging.stg_books", "product_id"),
               Check("transform", "rows", "staging.stg_books", min_rows=0)]
    checks += [Check("load", "unique", f"marts.{t}", key) for t, key, _ in MART_IDS]
    checks += [Check("load", "not_null", f"marts.{t}", name) for t, _, name in MART_IDS]
    checks += [Check("load", "rows", f"marts.{t}", min_rows=0) for t, _, _ in MART_IDS]
    checks += [Check("cdc", "cdc", f"raw.{s}") for s in SHOP_COLUMNS]
    return checks + [Check("lineage", "lineage", "lineage.data_lineage")]


def mart_suite() -> list[Check]:
    """14 checks over staging names and the marts."""
    checks = [Check("staging", "not_null", f"staging.stg_{s}", "name") for s in SHOP_COLUMNS]
    for table, key, name in MART_IDS:
        checks += [Check("marts", "unique", f"marts.{table}", key), Check("marts", "not_null", f"marts.{table}", name),
                   Check("marts", "positive", f"marts.{table}", "price"),
                   Check("marts", "rows", f"marts.{table}", min_rows=100)]
    return checks + [Check("marts", "in_set", "marts.dim_products", "source", values=MART_SOURCES),
                     Check("marts", "in_set", "marts.dim_products", "price_tier", values=MART_TIERS)]


def definition_checks(table: str, stage: str = "load") -> list[Check]:
    """What a table's definition promises and Spark does not enforce: key, parents, text lengths."""
    definition = TABLES[table]
    checks = [Check(stage, "key", table, columns=definition.key)] if definition.key else []
    checks += [Check(stage, "references", table, child, parent=parent, parent_column=column)
               for child, (parent, column) in definition.parents.items()]
    return checks + [Check(stage, "length", table, c, max_length=n) for c, n in definition.limits.items()]


def stage_suite(stage: str) -> list[Check]:
    """Checks right after a stage of the daily run: 8 after `extract`, 4 after `transform`, 6 after `load`."""
    if stage == "extract":
        return ([Check(stage, "not_empty", f"raw.{s}") for s in SHOP_COLUMNS] + [Check(stage, "cdc", f"raw.{s}") for s in SHOP_COLUMNS])
    if stage == "transform":
        return [Check(stage, "rows", "staging.stg_books", min_rows=0), Check(stage, "duplicates", "staging.stg_books", "product_id"),
                *(Check(stage, "not_null", "staging.stg_books", c) for c in ("product_id", "name"))]
    if stage != "load":
        raise ValueError(f"no checks after stage {stage}")
    return [*(Check(stage, "unique", f"marts.{t}", key) for t, key, _ in MART_IDS),
            *(Check(stage, "not_null", f"marts.{t}", name) for t, _, name in MART_IDS),
            Check(stage, "rows", "marts.dim_books", min_rows=0), Check(stage, "lineage", "lineage.data_lineage")]


def by_stage(results: DataFrame, stage: str) -> DataFrame:
    return results.filter(F.col("stage") == stage)


def failed(results: DataFrame) -> DataFrame:
    return results.filter("status = 'FAIL'")


def pass_count(results: DataFrame) -> DataFrame:
    """Passed and total checks in one row, and whether all passed."""
    return results.agg(F.count_if(F.col("status") == "PASS").alias("passed"), F.count("*").alias("total"),
                       F.coalesce(F.min(F.col("status") == "PASS"), F.lit(True)).alias("all_passed"))
