"""Invoice time stamps: each text is parsed on its own, bad ones become null.

Every form is rewritten to ISO text and cast without a zone, so no session setting matters.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Slash dates are month-first; day-first only where the first number cannot be a month.
SLASH_DATE = r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})(.*)$"
MONTH_FIRST = "$3-$1-$2$4"
DAY_FIRST = "$3-$2-$1$4"

# Month names; each may be cut to its first three letters.
MONTHS = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]

CLOCK_END = r"(:\d{2}(?::\d{2}(?:\.\d+)?)?)\s*"
REST = r"(?=[ T]|$)"


def _rewriting() -> list[tuple[str, str]]:
    """Patterns and what replaces them, in order: any other form becomes ISO text."""
    rules = [(rf"(?i)\b12{CLOCK_END}am\s*$", "00$1"), (rf"(?i)\b((?:0?[1-9]|1[01]){CLOCK_END})am\s*$", "$1")]
    rules += [(rf"(?i)\b0?{hour}{CLOCK_END}pm\s*$", f"{hour + 12}$1") for hour in range(1, 12)]
    rules += [(rf"(?i)\b(12{CLOCK_END})pm\s*$", "$1")]
    for number, name in enumerate(MONTHS, 1):
        # The month's name, as <6>, and then the two orders that it may come in.
        short = f"{name[:3]}(?:{name[3:]})?" if name != "september" else "sep(?:t|tember)?"
        rules.append((rf"(?i)\b{short}\b\.?", f"<{number}>"))
    return rules + [
        (rf"^\s*<(\d+)>\s+(\d{{1,2}}),?\s+(\d{{4}}){REST}", "$3-$1-$2"),
        (rf"^\s*(\d{{1,2}})[\s-]<(\d+)>,?[\s-](\d{{4}}){REST}", "$3-$2-$1"),
        # Two digits of a year are 1969 to 2068.
        (rf"^\s*(\d{{1,2}})([/-])(\d{{1,2}})\2([0-5]\d|6[0-8]){REST}", "$1$2$3$220$4"),
        (rf"^\s*(\d{{1,2}})([/-])(\d{{1,2}})\2(69|[7-9]\d){REST}", "$1$2$3$219$4"),
        (rf"^\s*(1[3-9]|[23]\d)([/-])(\d{{1,2}})\2(\d{{4}}){REST}", "$4-$3-$1"),
        (rf"^\s*(\d{{1,2}})([/-])(\d{{1,2}})\2(\d{{4}}){REST}", "$4-$1-$3"),
        (rf"^\s*(\d{{4}})/(\d{{1,2}})/(\d{{1,2}}){REST}", "$1-$2-$3"),
        (rf"^\s*(\d{{4}})(\d{{2}})(\d{{2}}){REST}", "$1-$2-$3"),
    ]


def _other_forms(text: Column) -> Column:
    for pattern, replacement in _rewriting():
        text = F.regexp_replace(text, pattern, replacement)
    return text.try_cast("timestamp_ntz")


def timestamp(text: Column) -> Column:
    """ISO first, then slash dates, then rarer forms; the cast is zone-free throughout.

    Those are times with AM or PM, years of two digits, dashed dates (month first), slashed ISO,
    compact dates and dates with the month's name. Being rare, they are rewritten within a function
    of an array element, which keeps them out of the generated code that all lines run through.
    """
    return F.coalesce(
        text.try_cast("timestamp_ntz"),
        F.regexp_replace(text, SLASH_DATE, MONTH_FIRST).try_cast("timestamp_ntz"),
        F.regexp_replace(text, SLASH_DATE, DAY_FIRST).try_cast("timestamp_ntz"),
        F.transform(F.array(text), _other_forms)[0],
    )


def month(moment: Column) -> Column:
    """YYYY-MM, taken from the text so that no time zone is involved."""
    return F.substring(moment.cast("string"), 1, 7)


def day(moment: Column) -> Column:
    return F.substring(moment.cast("string"), 1, 10)


def second(moment: Column) -> Column:
    return F.substring(moment.cast("string"), 1, 19)


def iso_text(moment: Column) -> Column:
    """Seconds, with six decimals only when there is a fraction."""
    text = moment.cast("string")
    return F.when(
        F.length(text) > 19, F.rpad(text, 26, "0")
    ).otherwise(text)
