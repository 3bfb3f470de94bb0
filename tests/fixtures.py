"""Test inputs described in FIXTURES.md, written as text by the tests."""

from __future__ import annotations

import os

# Meter-reading CSV, variant (a): header + rows. Covers three households, both
# tariffs, all four groups, months 9, 10, 12 of 2012 and 1 of 2013, a literal
# ``Null`` energy cell, a wholly empty row, a null key, a null energy, an exact
# duplicate pair, tied largest readings, values around the bounds 1 and 2,
# timestamps with and without fractional seconds, and padded cells.
HEADER = "LCLid,stdorToU,DateTime,KWH/hh (per half hour) ,Acorn,Acorn_grouped"
ROWS = [
    "MAC000002,Std,2012-10-12 00:30:00.0000000,0.143,ACORN-A,Affluent",
    "MAC000002,Std,2012-10-12 01:00:00,1,ACORN-A,Affluent",
    "MAC000002,Std,2012-09-30 23:30:00,2,ACORN-A,Affluent",
    "MAC000003,ToU,2012-12-01 12:00:00,0.999,ACORN-E,Comfortable",
    "MAC000003,ToU,2012-12-01 12:30:00,1.001,ACORN-E,Comfortable",
    "MAC000003,ToU,2013-01-02 00:00:00,2.001,ACORN-E,Comfortable",
    "MAC000034,ToU,2013-01-05 00:00:00,6.51,ACORN-P,Adversity",
    "MAC000034,ToU,2013-01-05 00:00:00,6.51,ACORN-P,Adversity",
    "MAC000034,Std,2013-01-06 00:00:00,6.51,ACORN-Q,Adversity",
    "MAC000035,Std,2012-09-01 10:00:00,1.999,ACORN-U,ACORN-U",
    " MAC000035 , Std , 2012-09-01 10:30:00 , 0.5 , ACORN-U , ACORN-U ",
    "MAC000035,Std,2012-09-01 11:30:00,Null,ACORN-U,ACORN-U",
    ",,,,,",
    ",Std,2012-09-01 12:00:00,0.25,ACORN-U,ACORN-U",
    "MAC000036,ToU,2012-12-24 18:00:00,,ACORN-A,Affluent",
]
N_ROWS = len(ROWS)
N_COMPLETE = N_ROWS - 4  # Null energy, empty row, null key, empty energy

PEOPLE_JSON = ['{"name":"Ingrid"}', '{"name":"Tomas", "age":41}', '{"name":"Wanda", "age":17}']

TEXT_LINES = ["a  b a", "", "b "]
TEXT_COUNTS = {"": 3, "a": 2, "b": 2}


def write_lines(path: str, lines: list[str]) -> str:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    return path


def meter_csv(folder: str, header: bool = True) -> str:
    return write_lines(os.path.join(folder, "power.csv"), ([HEADER] if header else []) + ROWS)
