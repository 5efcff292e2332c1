"""Column functions over text, cells and paths. All of them run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Control characters that no sound text layer holds (tab, line feed and carriage return may occur).
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
#: Eight capitals or more in one go: words that may have lost the spaces between them.
MERGED_RUN = r"(?U)\b[A-Z]{8,}\b"
#: Runs of five ASCII letters or more, the tokens of spelling reconciliation.
TOKEN = r"[A-Za-z]{5,}"
HEADING = r"(?sU)^(#{1,6})\s+(.+?)\s*\z"
PAGE_MARKER = r"^<!-- page (\d+) -->"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space at either end, as Unicode counts it, the four ASCII separators included."""
    return F.regexp_replace(_column(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def letters_only(c: Column | str) -> Column:
    """ASCII letters alone, upper case."""
    return F.upper(F.regexp_replace(_column(c), "[^A-Za-z]", ""))


def page_marker(number: Column | str) -> Column:
    return F.concat(F.lit("<!-- page "), _column(number).cast("string"), F.lit(" -->"))


def control_ratio(text: Column | str) -> Column:
    """Share of control characters among all characters; 0 for an empty text."""
    t = _column(text)
    return F.regexp_count(t, F.lit(CONTROL)) / F.greatest(F.length(t), F.lit(1))


def escape_pipes(c: Column | str) -> Column:
    return F.replace(_column(c), F.lit("|"), F.lit("\\|"))


def pipe_row(cells: Column) -> Column:
    return F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))


def pipe_rule(width: Column) -> Column:
    """The line below a table's header."""
    return F.concat(F.lit("|"), F.array_join(F.array_repeat(F.lit("---"), width), "|"), F.lit("|"))


def format_cell(kind: Column, num: Column, text: Column, ts: Column, flag: Column, number_format: Column) -> Column:
    """A cell as its own format displays it: '' for a blank, thousands separators only where the format has a comma.

    Negative numbers stand in parentheses, whole numbers have no decimals and
    others two, moments show their day, and a pipe in a text is escaped.
    """
    size = F.abs(num)
    grouped = F.when(size == F.floor(size), F.format_number(size, 0)).otherwise(F.format_number(size, 2))
    plain = F.when(F.coalesce(number_format, F.lit("")).contains(","), grouped).otherwise(F.replace(grouped, F.lit(","), F.lit("")))
    number = F.when(num < 0, F.concat(F.lit("("), plain, F.lit(")"))).otherwise(plain)
    return (
        F.when(kind == "bool", F.when(flag, "TRUE").otherwise("FALSE"))
        .when(kind == "num", number)
        .when(kind == "date", F.date_format(ts, "yyyy-MM-dd"))
        .when(kind == "text", escape_pipes(strip(text)))
        .otherwise("")
    )


def file_name(path: Column | str) -> Column:
    return F.regexp_extract(_column(path), r"([^/]*)\z", 1)


def stem(path: Column | str) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(file_name(path), r"(?s)(.)\.[^.]*\z", "$1")


def extension(path: Column | str) -> Column:
    """Last extension in lower case; '' if there is none."""
    return F.lower(F.regexp_extract(file_name(path), r"(?s).\.([^.]*)\z", 1))


#: SQL functions that :func:`register` makes: name, parameters, result, body.
SQL_FUNCTIONS = (
    ("leaf_strip", "t STRING", "STRING", r"regexp_replace(t, '(?U)^[\\s\\x1c-\\x1f]+|[\\s\\x1c-\\x1f]+\\z', '')"),
    ("leaf_letters", "t STRING", "STRING", "upper(regexp_replace(t, '[^A-Za-z]', ''))"),
    ("leaf_page_marker", "n BIGINT", "STRING", "concat('<!-- page ', n, ' -->')"),
    ("leaf_control_ratio", "t STRING", "DOUBLE", r"regexp_count(t, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]') / greatest(length(t), 1)"),
    ("leaf_extension", "p STRING", "STRING", r"lower(regexp_extract(p, '[^/]\\.([^./]*)\\z', 1))"),
)


def register(spark) -> list[str]:
    """Make this module's functions callable from SQL in the session, as SQL functions that Catalyst inlines."""
    for name, parameters, result, body in SQL_FUNCTIONS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {result} RETURN {body}")
    return [x[0] for x in SQL_FUNCTIONS]
