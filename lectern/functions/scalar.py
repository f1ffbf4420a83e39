"""Scalar column functions with the calendar, text and rounding rules of the model."""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from lectern.functions.status import _c

# English names by number; other languages are passed in.
DAY_NAMES = ("Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday")
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June", "July", "August",
    "September", "October", "November", "December",
)


def date_key(d) -> Column:
    """yyyymmdd as a number, by arithmetic rather than by formatting."""
    c = _c(d)
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def date_parts(d) -> dict[str, Column]:
    c = _c(d)
    return {"Ano": F.year(c), "Mes": F.month(c), "Dia": F.dayofmonth(c), "Trimestre": F.quarter(c)}


def week_us(d) -> Column:
    """Week of the year where week 1 holds 1 January and weeks start on Sunday."""
    c = _c(d)
    first = F.dayofweek(F.trunc(c, "year"))
    return (F.floor((F.dayofyear(c) + first - 2) / 7) + 1).cast("int")


def weekday(d) -> Column:
    return F.dayofweek(_c(d))


def is_weekend(d) -> Column:
    return F.dayofweek(_c(d)).isin(1, 7)


def _pick(names, number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in names]), number)


def day_name(d, names=DAY_NAMES) -> Column:
    return _pick(names, F.dayofweek(_c(d)))


def month_name(d, names=MONTH_NAMES) -> Column:
    return _pick(names, F.month(_c(d)))


def minute_floor(ts) -> Column:
    """Start of the minute; keeps the type, so no zone is involved for zoneless values."""
    c = _c(ts)
    zero = F.lit(0)
    return c - F.make_dt_interval(zero, zero, zero, F.date_part(F.lit("SECOND"), c))


def add_days(d, n: int) -> Column:
    return F.date_add(_c(d), n)


def days_between(a, b) -> Column:
    return F.datediff(_c(b), _c(a))


def add_minutes(ts, n: int) -> Column:
    zero = F.lit(0)
    return _c(ts) + F.make_dt_interval(zero, zero, F.lit(n))


def to_day(ts) -> Column:
    return F.to_date(_c(ts))


def concat0(*cols) -> Column:
    """Concatenation in which NULL counts as the empty string."""
    return F.concat_ws("", *[_c(c).cast("string") for c in cols])


def isnull(c, default) -> Column:
    return F.coalesce(_c(c), default if isinstance(default, Column) else F.lit(default))


def nullif(c, value) -> Column:
    return F.nullif(_c(c), value if isinstance(value, Column) else F.lit(value))


def round_dec(c, precision: int, scale: int) -> Column:
    return F.round(_c(c), scale).cast(f"decimal({precision},{scale})")


def doc_hash(c) -> Column:
    return F.unhex(F.sha2(_c(c), 256))


def default_uuid(c) -> Column:
    return F.coalesce(_c(c), F.uuid())


def is_json(c) -> Column:
    """Is the whole text one JSON object or array?  NULL stays NULL.

    The parser reads the first value of a text and leaves the rest.  So the text is
    read as the first element of an array whose second is the text's own hash:
    only if the hash is found there has the first element ended where the text does.
    A text nested too deeply for the parser counts as no JSON.  Repeated names are
    allowed (``session.RUNTIME_CONF``).
    """
    col = _c(c)
    digest = F.sha2(col, 256)
    pair = F.try_parse_json(F.concat(F.lit("["), col, F.lit(',"'), digest, F.lit('"]')))
    first = F.schema_of_variant(F.try_variant_get(pair, "$[0]", "variant"))
    whole = F.try_variant_get(pair, "$[1]", "string") == digest
    valid = whole & (first.startswith("OBJECT") | first.startswith("ARRAY"))
    return F.when(col.isNotNull(), F.coalesce(valid, F.lit(False)))


def json_obj(fields: dict[str, Column | str]) -> Column:
    return F.to_json(F.struct(*[_c(c).alias(name) for name, c in fields.items()]))


# Fixed value: reference month, YYYY-MM.
COMPETENCE_PATTERN = "^[12][0-9]{3}-(0[1-9]|1[0-2])$"


def is_competence(c) -> Column:
    return _c(c).rlike(COMPETENCE_PATTERN)
