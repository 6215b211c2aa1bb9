"""Text built from rows: the replay hash, the natural key and number spelling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgersieve.schemas import FEED_FIELDS


# The hashed texts in order; an absent field counts as ''.
_HASHED = ["source_name", *[f"coalesce({name}, '')" for name in FEED_FIELDS]]


def line_hash() -> Column:
    """SHA-256 of the source name and the eight feed fields, joined with ``|``.

    Known limit, kept for equal results: a ``|`` inside a field is not escaped (see ``has_separator``).
    """
    return F.expr(f"sha2(concat_ws('|', {', '.join(_HASHED)}), 256)")


def has_separator() -> Column:
    """Whether any hashed field holds the separator, so that other fields could give the same hash."""
    return F.expr(f"contains(concat({', '.join(_HASHED)}), '|')")


def hash_bytes(name: str = "raw_line_hash") -> Column:
    """The bytes a hash's text spells, half as long and in the same order; null where the text would not come back."""
    return F.expr(f"if(lower(hex(unhex({name}))) = {name}, unhex({name}), null)")


def hash_text(name: str) -> Column:
    return F.lower(F.hex(name))


def key_start() -> Column:
    """The natural key without its posting time: of rows posted at one time, equal just where the whole key is."""
    return F.expr("concat_ws('', source_name, '|', raw_transaction_id, '|')")


def natural_key() -> Column:
    """Source, transaction id and posting time. Nulls are left out; ``concat`` would turn the key null."""
    return F.expr("concat_ws('', source_name, '|', raw_transaction_id, '|', string(posted_at))")


def plain_number(name: str) -> Column:
    """Shortest text of a double column: plain digits from 1e-4 up to 1e16, else like ``1.5e+16`` or ``2e-05``.

    Spark's own cast turns to ``1.5E7`` much earlier.
    """
    short = f"string({name})"
    digits = f"regexp_replace(string(try_cast({short} as decimal(38, 21))), '0+$', '')"
    mantissa = f"regexp_replace(regexp_extract({short}, '^(.*)E', 1), r'\\.0$', '')"
    exponent = f"regexp_extract({short}, 'E-?([0-9]+)$', 1)"
    return F.expr(
        f"""case
        when isnan({name}) then 'nan'
        when {name} = double('infinity') then 'inf'
        when {name} = double('-infinity') then '-inf'
        when not contains({short}, 'E') then {short}
        when abs({name}) >= 1e-4 and abs({name}) < 1e16 then regexp_replace({digits}, r'\\.$', '.0')
        else concat({mantissa}, if(contains({short}, 'E-'), 'e-', 'e+'),
          lpad({exponent}, greatest(2, length({exponent})), '0'))
        end"""
    )
