"""Canonical JSON of typed columns: keys sorted at each level, no white space, ASCII only, numbers as Python prints them.

The text is that of ``json.dumps(value, sort_keys=True, separators=(",", ":"))``, so that digests made elsewhere agree. It
is made of built-in functions by the column's type, however deeply structs, maps and arrays nest.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters that have a short escape.
_SHORT = [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\f", "\\f"), ("\b", "\\b")]


def json_string(text: Column) -> Column:
    """A text in quotes, with all but printable ASCII characters escaped (beyond 16 bits, as two)."""
    out = text
    for plain, escaped in _SHORT:
        out = F.replace(out, F.lit(plain), F.lit(escaped))
    code = lambda c: F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", r"\\u$1")
    wide = F.array_join(F.transform(F.split(out, ""), lambda c: F.when(c.rlike("[^ -~]"), code(c)).otherwise(c)), "")
    return F.concat(F.lit('"'), F.when(out.rlike("[^ -~]"), wide).otherwise(out), F.lit('"'))


def json_float(x: Column) -> Column:
    """A double as Python prints it: the fewest digits that read as the same number, positional from 1e-4 up to 1e16, and
    with an exponent of two digits or more elsewhere."""
    x = x.cast("double")
    shorter = [F.format_string(f"%.{digits - 1}e", x) for digits in (15, 16)]
    text = F.coalesce(*(F.when(s.try_cast("double") == x, s) for s in shorter), F.format_string("%.16e", x))
    part = lambda k: F.regexp_extract(text, r"^(-?)(\d)\.(\d*?)0*e([+-]\d+)$", k)
    sign, lead, rest, e = part(1), part(2), part(3), part(4).try_cast("int")
    digits = F.concat(lead, rest)
    whole = F.concat(F.rpad(digits, e + 1, "0"), F.lit(".0"))
    split = F.concat(F.substring(digits, F.lit(1), e + 1), F.lit("."), F.substring(digits, e + 2, F.length(digits)))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -e - 1), digits)
    power = F.concat(F.when(e < 0, "-").otherwise("+"), F.lpad(F.abs(e).cast("string"), F.greatest(F.lit(2), F.length(F.abs(e).cast("string"))), F.lit("0")))
    far = F.concat(lead, F.when(rest != "", F.concat(F.lit("."), rest)).otherwise(""), F.lit("e"), power)
    scaled = F.when((e >= 0) & (e < 16), F.when(F.length(rest) <= e, whole).otherwise(split)).when((e < 0) & (e >= -4), small).otherwise(far)
    plain = (x == 0) | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.when(plain, x.cast("string")).otherwise(F.concat(sign, scaled))


def canonical_json(value: Column, kind: T.DataType) -> Column:
    """The canonical JSON of a column of type ``kind``; null is ``null``, also as a field of a struct or a value of a map."""
    if isinstance(kind, T.StructType):
        fields = [F.concat(json_string(F.lit(f.name)), F.lit(":"), canonical_json(value.getField(f.name), f.dataType)) for f in sorted(kind, key=lambda f: f.name)]
        out = F.concat(F.lit("{"), F.concat_ws(",", *fields) if fields else F.lit(""), F.lit("}"))
    elif isinstance(kind, T.MapType):
        if not isinstance(kind.keyType, T.StringType):
            raise TypeError(f"JSON has no keys of type {kind.keyType.simpleString()}")
        pairs = F.transform(F.array_sort(F.map_keys(value)), lambda k: F.concat(json_string(k), F.lit(":"), canonical_json(value[k], kind.valueType)))
        out = F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))
    elif isinstance(kind, T.ArrayType):
        out = F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: canonical_json(x, kind.elementType)), ","), F.lit("]"))
    elif isinstance(kind, T.StringType):
        out = json_string(value)
    elif isinstance(kind, (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        out = value.cast("string")
    elif isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        out = json_float(value)
    else:
        raise TypeError(f"JSON has no form for {kind.simpleString()}")
    return F.coalesce(out, F.lit("null"))
