"""Options of an export, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass, fields
from enum import Enum

from parquill.errors import SettingsError


class Option(str, Enum):
    """An enumeration whose members also go by aliases."""

    @classmethod
    def of(cls, value: str):
        value = str(getattr(value, "value", value)).lower()
        value = ALIASES.get(cls.__name__, {}).get(value, value)
        try:
            return cls(value)
        except ValueError:
            raise SettingsError(f"{cls.__name__}: {value!r} is none of {', '.join(m.value for m in cls)}") from None


class Macaddr(Option):
    TEXT, BYTES, INT64 = "text", "byte-array", "int64"


class Json(Option):
    TEXT, MARKED = "text", "text-marked-as-json"


class EnumAs(Option):
    TEXT, PLAIN, INT = "text", "plain-text", "int"


class Interval(Option):
    INTERVAL, STRUCT = "interval", "struct"


class Numeric(Option):
    DECIMAL, DOUBLE, FLOAT32, STRING = "decimal", "double", "float32", "string"


class Array(Option):
    PLAIN, DIMS, DIMS_LB = "plain", "dimensions", "dimensions+lowerbound"


class Float16(Option):
    FLOAT32, FLOAT16 = "float32", "float16"


class Rounding(Option):
    TRUNCATE, HALF_UP = "truncate", "half_up"


class MacLayout(Option):
    HIGH, LOW = "high", "low"


class TimeAs(Option):
    TIME, MICROS = "time", "micros"


#: Other names of options on the command line.
ALIASES = {
    "Numeric": {"float": "double", "float64": "double"},
    "Array": {"dims": "dimensions", "dimensions+lower_bound": "dimensions+lowerbound", "dims+lb": "dimensions+lowerbound", "dimensions+lb": "dimensions+lowerbound", "dims+lowerbound": "dimensions+lowerbound"},
}


@dataclass(frozen=True)
class Settings:
    """How types without one natural Parquet form are written."""

    macaddr: Macaddr = Macaddr.TEXT
    json: Json = Json.TEXT
    enum: EnumAs = EnumAs.TEXT
    interval: Interval = Interval.INTERVAL
    numeric: Numeric = Numeric.DOUBLE
    decimal_scale: int = 18
    decimal_precision: int = 38
    array: Array = Array.PLAIN
    float16: Float16 = Float16.FLOAT32
    # beyond the command line
    rounding: Rounding = Rounding.TRUNCATE
    mac_layout: MacLayout = MacLayout.HIGH
    time: TimeAs = TimeAs.TIME
    keep_netmask: bool = False

    def __post_init__(self):
        kinds = {"macaddr": Macaddr, "json": Json, "enum": EnumAs, "interval": Interval, "numeric": Numeric, "array": Array, "float16": Float16, "rounding": Rounding, "mac_layout": MacLayout, "time": TimeAs}
        for f in fields(self):
            if f.name in kinds:
                object.__setattr__(self, f.name, kinds[f.name].of(getattr(self, f.name)))
        if self.numeric is Numeric.DECIMAL:
            if not 0 < self.decimal_precision <= 38:
                raise SettingsError(f"decimal precision {self.decimal_precision}: Spark has 1 to 38 digits; numeric=string keeps all")
            if not 0 <= self.decimal_scale <= self.decimal_precision:
                raise SettingsError(f"decimal scale {self.decimal_scale} is not between 0 and the precision {self.decimal_precision}")
