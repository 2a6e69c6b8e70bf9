"""Column rules shared by the exports: schema conformance, defaults, language lookup, joins by id."""

from __future__ import annotations

import re
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.schemas import outbound_schema

# Fixed value: shape of a language code that may be read from a translated field.
LANGUAGE_CODE = re.compile(r"^[a-z]{2}_[A-Z]{2}$")


_ids_only: ContextVar[bool] = ContextVar("ids_only", default=False)


@contextmanager
def ids_only():
    """Exports that are planned inside are meant for their id columns: joins that only bring along other columns are left
    out, and those columns are NULL. Such a join, to one row at most, changes no row, but the optimiser can't know."""
    token = _ids_only.set(True)
    try:
        yield
    finally:
        _ids_only.reset(token)


def skipped(names) -> bool:
    """Whether a join for the columns ``names`` is left out now."""
    return _ids_only.get() and not any(n.endswith("_id") for n in names)


def conform(df: DataFrame, entity: str, **values: str | Column) -> DataFrame:
    """Select the declared columns of ``entity`` in order, cast to their declared types.

    A column comes from ``values`` when named there; otherwise from the column of the same
    name, or, for ``_odoo_<x>``, from column ``<x>``.
    """
    present = set(df.columns)
    out = []
    for field in outbound_schema(entity):
        value = values.pop(field.name, None)
        if value is None:
            short = field.name.removeprefix("_odoo_")
            value = field.name if field.name in present else short
            if value not in present:
                raise KeyError(f"{entity}: no source for column {field.name}")
        column = F.col(value) if isinstance(value, str) else value
        out.append(column.cast(field.dataType).alias(field.name))
    if values:
        raise KeyError(f"{entity}: not in the schema: {sorted(values)}")
    return df.select(*out)


def fill(df: DataFrame, **defaults) -> DataFrame:
    """Replace NULL by a default in columns the source must have."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def optional(df: DataFrame, **defaults) -> DataFrame:
    """As :func:`fill`, for columns the source may lack: then the default is the column.

    A default of None keeps the NULLs of an existing column.
    """
    present = set(df.columns)
    absent = {c: F.lit(v) for c, v in defaults.items() if c not in present}
    known = {c: v for c, v in defaults.items() if c in present and v is not None}
    return fill(df.withColumns(absent), **known)


def first_column(df: DataFrame, *names: str) -> Column:
    """The first of ``names`` that ``df`` has, else NULL."""
    present = set(df.columns)
    return next((F.col(n) for n in names if n in present), F.lit(None))


def language_key(lang: str | None) -> str | None:
    """``lang`` if it is shaped like a language code, else None."""
    return lang if lang and LANGUAGE_CODE.match(lang) else None


def json_text(field: str | Column, key: str | None) -> Column:
    """Text of one key of a JSON object column; NULL if the key is absent or no key is given."""
    if key is None:
        return F.lit(None).cast("string")
    if not re.fullmatch(r"\w+", key):
        raise ValueError(f"not a plain key: {key!r}")
    return F.get_json_object(F.col(field) if isinstance(field, str) else field, f"$.{key}")


def attach(
    rows: DataFrame, relation: DataFrame, key: str, how: str = "left", row_id: str = "id", **take: str | Column
) -> DataFrame:
    """Equi-join ``rows.key`` to ``relation.id`` and bring along the ``take`` columns.

    Only the taken columns travel, and they replace columns of the same name. No side is forced to
    broadcast: Spark decides by measured size, and splits a hot key of a shuffled join at run time.
    What it cannot split well is a left join with many missing keys, which all hash alike: so both
    sides also join on a salt, which is 0 wherever there is a key and differs by ``row_id`` elsewhere.
    """
    if how == "left" and skipped(take):
        plain = {n: relation.schema[v].dataType if isinstance(v, str) else "string" for n, v in take.items()}
        return rows.withColumns({n: F.lit(None).cast(kind) for n, kind in plain.items()})
    taken = [(F.col(v) if isinstance(v, str) else v).alias(n) for n, v in take.items()]
    if how == "inner":
        kept = [c for c in rows.columns if c == key or c not in take]
        return rows.select(*kept).join(relation.select(F.col("id").alias(key), *taken), key)
    kept = [c for c in rows.columns if c not in take]
    salt = F.when(F.col(key).isNull(), F.xxhash64(row_id)).otherwise(0)
    keyed = rows.select(*kept, F.col(key).alias("_join"), salt.alias("_salt"))
    here = F.pmod(F.col("id").cast("bigint"), F.lit(1))  # always 0; a plain 0 would be optimised out of the join's key
    picked = relation.select(F.col("id").alias("_join"), here.alias("_salt"), *taken)
    return keyed.join(picked, ["_join", "_salt"], how).drop("_join", "_salt")
