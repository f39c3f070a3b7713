"""SQL expressions that turn raw text into typed values; bad text becomes null."""

from __future__ import annotations

# Text read as missing (the defaults of a common CSV reader).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Date patterns tried after ISO text.
DATE_FORMATS = ["M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy", "yyyy/M/d"]


def missing_to_null(text: str, tokens: list[str]) -> str:
    quoted = ", ".join(f"'{t}'" for t in tokens)
    return f"if(trim({text}) in ({quoted}), null, {text})"


def money(text: str) -> str:
    """``"$1,333.80 "`` to 1333.8."""
    return rf"try_cast(regexp_replace({text}, '[$,\\s]', '') as double)"


def number(text: str, type_name: str = "double") -> str:
    return f"try_cast(trim({text}) as {type_name})"


def whole_number(text: str) -> str:
    """Integer text, also when written with a decimal point."""
    return f"try_cast(try_cast(trim({text}) as double) as int)"


def flag(text: str) -> str:
    return f"case upper(trim({text})) when 'TRUE' then 1 when 'FALSE' then 0 end"


def timestamp(text: str, formats: list[str] = DATE_FORMATS) -> str:
    attempts = [f"try_cast(trim({text}) as timestamp_ntz)"]
    attempts += [f"cast(try_to_timestamp(trim({text}), '{f}') as timestamp_ntz)" for f in formats]
    return f"coalesce({', '.join(attempts)})"
