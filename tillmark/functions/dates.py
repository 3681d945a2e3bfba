"""Whether text is a date or time in a strptime format, as a regular expression and a calendar check."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# English names, as in the C locale.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
DAYS = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")

#: Text of each directive. One digit is enough where two are usual.
FIELDS = {
    "Y": "[0-9]{4}", "y": "[0-9]{2}", "m": "1[0-2]|0[1-9]|[1-9]", "d": "3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9]",
    "H": "2[0-3]|[01][0-9]|[0-9]", "I": "1[0-2]|0[1-9]|[1-9]", "M": "[0-5][0-9]|[0-9]", "S": "[0-5][0-9]|[0-9]",
    "f": "[0-9]{1,6}", "p": "am|pm", "j": "36[0-6]|3[0-5][0-9]|[12][0-9][0-9]|0[1-9][0-9]|00[1-9]|[1-9][0-9]|0[1-9]|[1-9]", "w": "[0-6]", "u": "[1-7]",
    "z": "z|[+-](?:2[0-3]|[01][0-9]):?[0-5][0-9](?::?[0-5][0-9](?:[.][0-9]{1,6})?)?", "Z": "utc|gmt",
    "B": "|".join(MONTHS), "b": "|".join(name[:3] for name in MONTHS), "A": "|".join(DAYS), "a": "|".join(name[:3] for name in DAYS),
}
#: Directives that stand for several.
WHOLE = {"c": "%a %b %d %H:%M:%S %Y", "x": "%m/%d/%y", "X": "%H:%M:%S", "D": "%m/%d/%y", "T": "%H:%M:%S", "F": "%Y-%m-%d", "R": "%H:%M"}


def _pattern(strptime_format: str) -> tuple[str, list[str]]:
    """The regular expression of a format and the directives of its groups, in order."""
    found: list[str] = []
    for letter, text in WHOLE.items():
        strptime_format = re.sub(rf"(?<!%)((?:%%)*)%{letter}", lambda match, text=text: match.group(1) + text, strptime_format)

    def piece(match: re.Match) -> str:
        directive, blank, literal = match.groups()
        if blank:
            return r"\s+"
        if literal:
            return re.sub(r"([^\w\s])", r"\\\1", literal, flags=re.ASCII)
        if directive == "%":
            return "%"
        if directive not in FIELDS or directive in found:
            raise ValueError(f"unsupported_date_directive: %{directive}")
        found.append(directive)
        return f"({FIELDS[directive]})"

    body = re.sub(r"%(.?)|(\s+)|([^%\s]+)", piece, strptime_format, flags=re.DOTALL)
    return f"(?i)^{body}$", found


def fits_format(text: Column, strptime_format: str) -> Column:
    """Whether all of stripped text reads as the format, names in any case, and names a day that exists.

    A year that is not given is 1900; a day of the year goes before month and day.
    """
    pattern, directives = _pattern(strptime_format)
    fits = text.rlike(pattern)

    def group(directive: str) -> Column:
        return F.regexp_extract(text, pattern, directives.index(directive) + 1)

    def number(directive: str) -> Column:
        return F.trim(group(directive)).try_cast("int")

    year = F.lit(1900)
    if "Y" in directives:
        year = number("Y")
        fits = fits & (year > 0)
    elif "y" in directives:
        year = F.when(number("y") < 69, number("y") + 2000).otherwise(number("y") + 1900)
    leap = (year % 4 == 0) & ((year % 100 != 0) | (year % 400 == 0))
    if "j" in directives:
        # The last year there is has no day behind its last.
        return fits & ~((year == 9999) & (number("j") == 366))
    if "d" not in directives:
        return fits
    day = number("d")
    if "m" in directives:
        short, february = number("m").isin(4, 6, 9, 11), number("m") == 2
    elif {"b", "B"} & set(directives):
        name = F.left(F.lower(group("B" if "B" in directives else "b")), F.lit(3))
        short, february = name.isin("apr", "jun", "sep", "nov"), name == "feb"
    else:
        return fits
    return reduce(lambda a, b: a & b, [fits, ~(short & (day > 30)), ~(february & (day > F.when(leap, 29).otherwise(28)))])
