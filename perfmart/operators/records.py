"""Nested report records to the raw text extract: flatten, decode, stringify."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perfmart.functions.casts import MISSING
from perfmart.operators.joins import BROADCAST_ROWS, fits
from perfmart.operators.windows import window_bounds
from perfmart.plans.columns import raw_name
from perfmart.plans.reports import ReportSpec

REPORTED_STATUSES = ("ENABLED", "PAUSED", "REMOVED")

#: So many codes at most, of all enums together, are looked up in a map.
MAP_CODES = 20_000


def _leaves(schema: T.StructType, prefix: str = "") -> list[str]:
    paths: list[str] = []
    for f in schema.fields:
        path = f"{prefix}{f.name}"
        if isinstance(f.dataType, T.StructType):
            paths += _leaves(f.dataType, f"{path}.")
        else:
            paths.append(path)
    return paths


def flatten_records(df: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """One column per leaf field: ``campaign.id`` becomes ``campaign_id``.

    ``fields`` are dotted paths; by default every leaf of the schema.
    """
    paths = fields if fields is not None else _leaves(df.schema)
    return df.select(*[F.col(p).alias(raw_name(p)) for p in paths])


def decode_enums(
    df: DataFrame, enums: Mapping[str, Mapping[int, str]], fields: Mapping[str, str]
) -> DataFrame:
    """Codes to names with enums known in full: a literal map, no join.

    ``fields`` maps a column to its enum.  A code without a name becomes NULL; a
    column that is not listed keeps its codes.
    """
    decoded = {}
    for column, enum in fields.items():
        if column in df.columns:
            pairs = [F.lit(v) for pair in sorted(enums[enum].items()) for v in pair]
            decoded[column] = F.create_map(*pairs)[F.col(column).try_cast("int")]
    return df.withColumns(decoded) if decoded else df


def decode_enums_by_table(
    df: DataFrame,
    dim: DataFrame,
    fields: Mapping[str, str],
    max_codes: int = MAP_CODES,
    max_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Codes to names with a dimension ``(enum, code, name)``.

    While the codes in use fit ``max_codes``, they become one map of maps, a scalar
    subquery that all fields share: no join, and no shuffle of ``df``.  Beyond that each
    field is a left join, broadcast up to ``max_rows`` codes; a larger one shuffles both
    sides and copies neither.  A code with several names takes the least of them.
    """
    fields = {column: enum for column, enum in fields.items() if column in df.columns}
    if not fields:
        return df
    used = dim.select("enum", F.col("code").try_cast("int").alias("code"), "name").where(
        F.col("enum").isin(*sorted(set(fields.values()))) & F.col("code").isNotNull()
    )
    if fits(used, max_codes):
        of_enum = used.groupBy("enum", "code").agg(F.min("name").alias("name")).groupBy("enum").agg(
            F.map_from_entries(F.collect_list(F.struct("code", "name"))).alias("names")
        )
        names = of_enum.agg(F.map_from_entries(F.collect_list(F.struct("enum", "names"))).alias("names")).scalar()
        return df.withColumns({c: names[F.lit(enum)][F.col(c).try_cast("int")] for c, enum in fields.items()})
    order = df.columns
    small = fits(used, max_rows)
    for column, enum in fields.items():
        side = used.where(F.col("enum") == enum).groupBy(F.col("code").alias("_code")).agg(F.min("name").alias("_name"))
        coded = df.withColumn("_code", F.col(column).try_cast("int")).drop(column)
        df = coded.join(F.broadcast(side) if small else side, "_code", "left").withColumnRenamed("_name", column).select(*order)
    return df


def float_text(x: Column) -> Column:
    """A double as the extract prints it: ``10000000.0``, ``1e+16``, ``1.5e-05``, ``nan``.

    Spark's own text switches to an exponent from 1.0E7 on, which the bigint cast
    of the load would read as missing.  The digits are the JVM's; some versions
    print more of them than the shortest text of the same number has.
    """
    text = x.cast("string")
    size = F.abs(x)
    plain = F.rtrim(text.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"[.]0$", "")
    exponent = F.substring_index(text, "E", -1).try_cast("int")
    digits = F.abs(exponent).cast("string")
    digits = F.when(F.length(digits) < 2, F.lpad(digits, 2, "0")).otherwise(digits)
    sign = F.when(exponent < 0, "-").otherwise("+")
    return (
        F.when(F.isnan(x), "nan")
        .when(size == float("inf"), F.when(x < 0, "-inf").otherwise("inf"))
        .when(x == 0, F.when(text.startswith("-"), "-0.0").otherwise("0.0"))
        .when((size >= 1e-4) & (size < 1e16), plain)
        .when(x.isNotNull(), F.concat(mantissa, F.lit("e"), sign, digits))
    )


def _text(column: str, data_type: T.DataType) -> Column:
    x = F.col(column)
    if isinstance(data_type, T.DoubleType):
        return float_text(x)
    if isinstance(data_type, T.BooleanType):
        return F.when(x, "True").when(~x, "False")
    if isinstance(data_type, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(x)
    return x.cast("string")


def stringify(df: DataFrame) -> DataFrame:
    """Every column as text, ``'None'`` where there is no value.

    Booleans are ``'True'``/``'False'``, repeated fields JSON text.
    """
    return df.select(
        *[
            F.coalesce(_text(f.name, f.dataType), F.lit(MISSING)).alias(f.name)
            for f in df.schema.fields
        ]
    )


def record_filter(
    df: DataFrame, spec: ReportSpec, run_date: str, lookback: int, reported: Collection[int]
) -> DataFrame:
    """The same rows as ``source_filter``, of nested records that still hold codes.

    ``reported`` are the codes of the reported statuses.  The conditions compare fields
    with literals, so a columnar source applies them in its scan.
    """
    paths = {raw_name(p): F.col(p) for p in _leaves(df.schema)}
    kept = paths["segments_date"].between(*window_bounds(run_date, lookback))
    for status in spec.statuses:
        kept = kept & paths[status].isin(*sorted(reported))
    return df.where(kept)


def source_filter(df: DataFrame, spec: ReportSpec, run_date: str, lookback: int) -> DataFrame:
    """Rows the source would report: dates of the window, known statuses only.

    ``df`` is flat and decoded.
    """
    start, end = window_bounds(run_date, lookback)
    kept = F.col("segments_date").between(start, end)
    for status in spec.statuses:
        kept = kept & F.col(status).isin(*REPORTED_STATUSES)
    return df.where(kept)
