"""Raw text telemetry -> canonical warehouse columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetlens.functions.casts import clean_text, safe_cast
from fleetlens.functions.dates import partition_month, partition_year
from fleetlens.schema import CANONICAL_COLUMNS

# Fixed value: model text used when none is known.
UNKNOWN_MODEL = "UNKNOWN"


def resolve_aliases(columns: list[str], spec=CANONICAL_COLUMNS) -> dict[str, str | None]:
    """canonical name -> source column (first alias present, case-insensitive) or None."""
    lookup: dict[str, str] = {}
    for c in columns:
        lookup.setdefault(c.lower(), c)
    out = {}
    for name, _type, aliases in spec:
        out[name] = next((lookup[a.lower()] for a in aliases if a.lower() in lookup), None)
    return out


def canonical_columns(columns: list[str], spec=CANONICAL_COLUMNS) -> list[Column]:
    """Select list producing the canonical schema from whatever columns a file has."""
    src = resolve_aliases(columns, spec)
    out = []
    for name, typ, _aliases in spec:
        s = src[name]
        if s is None:
            out.append(F.lit(None).cast(typ).alias(name))
        else:
            out.append(safe_cast(F.col(f"`{s}`"), typ).alias(name))
    return out


def canonicalize(df: DataFrame, spec=CANONICAL_COLUMNS) -> DataFrame:
    """Resolve aliases, clean and cast every canonical column; absent -> typed null."""
    return df.select(*canonical_columns(df.columns, spec))


def drop_null_keys(df: DataFrame, keys: tuple[str, ...] = ("date", "serial_number")) -> DataFrame:
    """Rows need a day and a drive serial."""
    cond = None
    for k in keys:
        c = F.col(k).isNotNull()
        cond = c if cond is None else cond & c
    return df.where(cond)


def with_partition_keys(df: DataFrame, date_col: str = "date") -> DataFrame:
    """Add ``year`` (int) and ``month`` ('01'..'12') partition columns."""
    return df.withColumns({"year": partition_year(date_col), "month": partition_month(date_col)})


def default_model(model, preferred=None) -> Column:
    """Preferred (cohort) model, else the row's cleaned model, else UNKNOWN."""
    parts = ([preferred] if preferred is not None else []) + [clean_text(model), F.lit(UNKNOWN_MODEL)]
    return F.coalesce(*parts)


def date_range(df: DataFrame, start, end, date_col: str = "date",
               partition_cols: tuple[str, str] | None = None) -> DataFrame:
    """Inclusive day range; with ``partition_cols=(year, month)`` the same bound is
    stated on the partition columns too, so a year/month-partitioned scan prunes
    directories (Spark does not derive that from a date predicate)."""
    s = F.lit(start).cast("date") if not isinstance(start, Column) else start
    e = F.lit(end).cast("date") if not isinstance(end, Column) else end
    out = df.where(F.col(date_col).between(s, e))
    if partition_cols:
        y, m = partition_cols
        ym = F.col(y).cast("int") * 100 + F.col(m).cast("int")
        out = out.where(ym.between(F.year(s) * 100 + F.month(s), F.year(e) * 100 + F.month(e)))
    return out


def _digest_number(columns: list[str], hex_digits: int):
    """The first hex digits of the row's MD5 as a number: the same in any engine."""
    text = F.concat_ws("|", *[F.col(c).cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, hex_digits), 16, 10).cast("bigint")


def sample_rows(df: DataFrame, columns: list[str], percent: int) -> DataFrame:
    """A repeatable sample: rows whose digest of ``columns`` falls in the first ``percent`` of 100 buckets."""
    return df.where(_digest_number(columns, 8) % 100 < percent)


def limit_rows(df: DataFrame, order: list[str], n: int | None) -> DataFrame:
    """The first ``n`` rows in ``order`` (None or 0: all), the knob of smoke runs."""
    return df.orderBy(*order).limit(n) if n else df


#: Hex digits of a row's digest that name its node, from the leaves up; the last is the root.
MERKLE_LEVELS = (6, 4, 2, 0)


def dataset_hash(df: DataFrame, columns: list[str], missing: str = "manifest_missing") -> DataFrame:
    """One row ``dataset_hash``: the root of a Merkle tree over the rows.

    A leaf is the SHA-256 of a row's fields (each with its length, null apart from empty) with
    the number of equal rows.  Leaves meet by the first digits of their digest; a node is the
    SHA-256 of what it holds in order.  So the order of rows doesn't matter, every field of
    every row and every repetition does, and a task holds a 16-millionth of the rows, then at
    most 256 nodes.  Without a row it is ``missing``.
    """
    fields = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("n"))
              for c in columns]
    nodes = df.groupBy(F.sha2(F.concat_ws(",", *fields), 256).alias("name")).agg(F.count(F.lit(1)).cast("string").alias("held"))
    for digits in MERKLE_LEVELS:
        nodes = nodes.groupBy(F.substring("name", 1, digits).alias("name")).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(
            F.concat_ws(":", "name", "held"))), ","), 256).alias("held"))
    return nodes.agg(F.coalesce(F.max("held"), F.lit(missing)).alias("dataset_hash"))
