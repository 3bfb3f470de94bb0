"""Declared schemas (§1.2, §1.3).

The reading table is positional: six nullable columns, applied over a CSV whose
own header is skipped. Energy is ``double`` everywhere (float is neither exact
to sum nor accepted by the document store, P9).
"""

from __future__ import annotations

from pyspark.sql import types as T

# The reading column names, in file order.
HOUSEHOLD = "LCLid"
TARIFF = "stdorToU"
TIME = "DateTime"
ENERGY = "KWH_per_hh_per_30min"
ACORN = "Acorn"
GROUP = "Acorn_grouped"
READING_COLUMNS = [HOUSEHOLD, TARIFF, TIME, ENERGY, ACORN, GROUP]

# Tariff labels; "ToU" households were warned of price changes.
TARIFF_FLAT = "Std"
TARIFF_WARNED = "ToU"

# Fixed value: the raw header of the energy column ends in a blank.
RAW_ENERGY_HEADER = "KWH/hh (per half hour) "


def reading_schema(zoned: bool = False, energy_type: T.DataType | None = None) -> T.StructType:
    """Schema of the meter-reading table.

    Readings are wall-clock half hours, so the default time type is
    ``timestamp_ntz`` (no session-zone shifts, D15). ``zoned=True`` gives the
    zoned ``timestamp`` the original files were declared with.
    """
    time_type = T.TimestampType() if zoned else T.TimestampNTZType()
    return T.StructType([
        T.StructField(HOUSEHOLD, T.StringType(), True),
        T.StructField(TARIFF, T.StringType(), True),
        T.StructField(TIME, time_type, True),
        T.StructField(ENERGY, energy_type or T.DoubleType(), True),
        T.StructField(ACORN, T.StringType(), True),
        T.StructField(GROUP, T.StringType(), True),
    ])


READING_SCHEMA = reading_schema()

PEOPLE_SCHEMA = T.StructType([
    T.StructField("age", T.LongType(), True),
    T.StructField("name", T.StringType(), True),
])
