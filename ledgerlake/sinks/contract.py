"""A table's contract: what may be written into it, checked before anything is."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}  # digits


class ContractError(ValueError):
    """A write that the contract refuses; ``refused`` has (column, expected type, found type or None)."""

    def __init__(self, table: str, refused: list[tuple[str, str | None, str | None]]) -> None:
        self.refused = refused
        listed = "; ".join(f"{name}: expected {wanted or 'no such column'}, found {found or 'none'}" for name, wanted, found in refused)
        super().__init__(f"{table} refuses {listed}")


def widens(found: T.DataType, wanted: T.DataType) -> bool:
    """Whether every value of one type is a value of the other, exactly."""
    if isinstance(found, T.NullType):
        return True
    if type(found) in _WHOLE:
        digits = _WHOLE[type(found)]
        if type(wanted) in _WHOLE:
            return _WHOLE[type(wanted)] >= digits
        if isinstance(wanted, T.DecimalType):
            return wanted.precision - wanted.scale >= digits
        return isinstance(wanted, T.DoubleType) and digits <= 10 or isinstance(wanted, T.FloatType) and digits <= 5
    if isinstance(found, T.DecimalType) and isinstance(wanted, T.DecimalType):
        return wanted.scale >= found.scale and wanted.precision - wanted.scale >= found.precision - found.scale
    if isinstance(found, T.FloatType):
        return isinstance(wanted, T.DoubleType)
    return isinstance(found, T.DateType) and isinstance(wanted, T.TimestampNTZType)


def contract_actions(df: DataFrame, contract: T.StructType) -> list[tuple[str, str | None, str | None, str]]:
    """(column, expected type, found type, action) for each column: kept, widened, filled (nullable and absent) or refused."""
    found = {f.name: f for f in df.schema.fields}
    out = []
    for f in contract.fields:
        have = found.get(f.name)
        if have is None:
            action = "filled" if f.nullable else "refused"
        elif have.dataType == f.dataType:
            action = "kept"
        else:
            action = "widened" if widens(have.dataType, f.dataType) else "refused"
        out.append((f.name, f.dataType.simpleString(), have and have.dataType.simpleString(), action))
    known = set(contract.names)
    out += [(n, None, f.dataType.simpleString(), "refused") for n, f in found.items() if n not in known]
    return out


def conforming(df: DataFrame, contract: T.StructType, table: str = "the contract") -> DataFrame:
    """The rows with the contract's columns, order and types.

    Types are widened where that keeps every value, and absent nullable columns are NULL.  Anything else is
    refused as a whole, before a row is read: a narrower or another type, an unknown column, an absent one that
    may not be NULL.  NULLs in a column that may not hold them fail the write.
    """
    refused = [(name, wanted, found) for name, wanted, found, action in contract_actions(df, contract) if action == "refused"]
    if refused:
        raise ContractError(table, refused)

    def column(f: T.StructField):
        c = F.col(f"`{f.name}`").cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if not f.nullable:
            c = F.coalesce(c, F.raise_error(F.lit(f"{table}: {f.name} is NULL")).cast(f.dataType))
        return c.alias(f.name)

    return df.select(*[column(f) for f in contract.fields])
