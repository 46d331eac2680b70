"""Feed values to the declared types of a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rinkframe.specs import TableSpec


# Every text that casts to a whole number, and every one that casts to a decimal, has
# this form. A cast that fails raises inside Spark, with a stack trace per value, so
# texts are looked at first.
_WHOLE_FORM = r"^[\x00-\x20\x7f]*[+-]?[0-9]+[\x00-\x20\x7f]*\z"
_DECIMAL_FORM = r"^[\x00-\x20\x7f]*[+-]?[\p{Nd}.]+([eE][+-]?\p{Nd}+)?[\x00-\x20\x7f]*\z"


def _has_form(value: Column, form: str) -> Column:
    return (F.typeof(value) != "string") | value.cast("string").rlike(form)


def whole_text(value: Column, target: str = "bigint") -> Column:
    """Whole number of text without a fraction; else NULL."""
    return F.when(_has_form(value, _WHOLE_FORM), value.try_cast(target))


def whole_number(value: Column, target: str = "bigint") -> Column:
    """Whole number of text or a number: ``12``, ``"12"`` and ``12.0``; else NULL."""
    exact = value.try_cast("decimal(38,6)")
    return whole_text(value, target).when(
        _has_form(value, _DECIMAL_FORM), F.when(exact == F.floor(exact), exact).try_cast(target))


def to_type(name: str, have: T.DataType | None, want: T.DataType) -> str:
    """SQL cast of a column: what does not fit is NULL, a NULL array is empty."""
    target = want.simpleString()
    if not isinstance(want, T.ArrayType):
        if have is None:
            return f"cast(NULL AS {target})"
        if have == want:
            return f"`{name}`"
        cast = f"try_cast(`{name}` AS {target})"
        if isinstance(have, T.StringType) and isinstance(want, T.IntegralType):
            return f"CASE WHEN `{name}` RLIKE r'{_WHOLE_FORM}' THEN {cast} END"
        return cast
    if not isinstance(have, T.ArrayType):
        return f"cast(array() AS {target})"
    present = f"filter(coalesce(`{name}`, array()), x -> x IS NOT NULL)"
    return present if have.elementType == want.elementType else f"try_cast({present} AS {target})"


def conform(df: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns of a table, in order and typed; absent ones are NULL.

    ``keep`` names helper columns to carry along behind them.
    """
    have = {f.name: f.dataType for f in df.schema}
    columns = [f"{to_type(c.name, have.get(c.name), c.spark_type)} AS `{c.name}`"
               for c in spec.columns]
    return df.selectExpr(*columns, *(f"`{k}`" for k in keep))


def save_counts(raw: Column, saves: Column, shots: Column) -> tuple[Column, Column]:
    """Saves and shots of a goalie.

    ``raw`` is a variant: text "saves/shots" or a number of shots. Explicit
    ``saves`` and ``shots`` win. Where the first part of the text is needed and
    is no number, the second is not used either.
    """
    text = F.try_variant_get(raw, "$", "string")
    is_text = F.schema_of_variant(raw) == "STRING"
    is_pair = F.coalesce(is_text & text.contains("/"), F.lit(False))
    first = whole_text(F.split_part(text, F.lit("/"), F.lit(1)))
    second = whole_text(F.split_part(text, F.lit("/"), F.lit(2)))
    saves_out = F.when(is_pair, F.coalesce(saves, first)).otherwise(saves)
    number = F.when(~is_text, F.try_variant_get(raw, "$", "double").cast("bigint"))
    shots_out = F.coalesce(
        shots,
        F.when(is_pair & saves_out.isNotNull(), second).when(~is_pair, number),
    )
    return saves_out, shots_out
