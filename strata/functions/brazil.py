"""Brazilian numbers and dates held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Cell contents that carry no value.
BLANK_CELLS = ["", "-", "R$", "R$ -"]

# The accepted number forms. ``1.234`` is read as thousands, so
# the Brazilian form is tried before the plain one.
BR_NUMBER = r"^(R\$[\s\xA0]*)?-?(\d{1,3}(\.\d{3})+|\d+)(,\d+)?$"
PLAIN_NUMBER = r"^-?\d+\.\d+$"

# The accepted date forms, as (shape, format).
DATE_FORMS = [
    (r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
    (r"^\d{2}/\d{2}/\d{4}$", "dd/MM/yyyy"),
]

DATE_LENGTH = 10

# White space in cells; spreadsheets also use the non-breaking blank.
_SPACES = " \t\r\n\x0b\f\xa0"

NUMBER = T.DecimalType(38, 9)


def trimmed(text: Column) -> Column:
    return F.trim(text, F.lit(_SPACES))


def ends_in_digit(cell: Column) -> Column:
    """True for every number and date: a cheap test before the patterns."""
    return F.right(cell, F.lit(1)).between("0", "9")


def is_blank(text: Column) -> Column:
    """True for NULL and for cells without a value, however they are spaced."""
    cells = [c.replace(" ", "") for c in BLANK_CELLS]
    return text.isNull() | F.translate(text, _SPACES, "").isin(cells)


def plain_number(cell: Column) -> Column:
    """Number text with a decimal point only, or NULL when it is no number.

    The cell has no blanks around it.
    """
    # Decimal comma to point; currency mark, thousands points and blanks vanish.
    plain = F.translate(cell, ",.R$" + _SPACES, ".")
    number = F.when(cell.rlike(BR_NUMBER), plain).when(cell.rlike(PLAIN_NUMBER), cell)
    return F.when(ends_in_digit(cell), number)


def number_form(cell: Column) -> Column:
    """``br`` or ``plain`` if the number has only that form, ``both`` for ``1.234``, ``any`` for whole numbers.

    NULL when the cell is no number. The cell has no blanks around it.
    """
    br, plain = cell.rlike(BR_NUMBER), cell.rlike(PLAIN_NUMBER)
    # The characters of a cell leave one pattern to try, or two.
    form = (
        F.when((F.instr(cell, ",") > 0) | F.startswith(cell, F.lit("R")), F.when(br, "br"))
        .when(F.instr(cell, ".") > 0, F.when(br & plain, "both").when(br, "br").when(plain, "plain"))
        .when(cell.rlike(r"^-?\d+$"), "any")
    )
    return F.when(ends_in_digit(cell), form)


def number_text_in_form(cell: Column, form: str) -> Column:
    """Number text with a decimal point only, of a cell that is known to be blank or a number of this form."""
    return cell if form == "plain" else F.translate(cell, ",.R$" + _SPACES, ".")


def number_in_form(cell: Column, form: str, dtype: T.DecimalType = NUMBER) -> Column:
    """Number of a cell that is known to be blank or a number of this form."""
    return number_text_in_form(cell, form).try_cast(dtype)


def cell_number(cell: Column, dtype: T.DecimalType = NUMBER) -> Column:
    """Number of a cell that has no blanks around it."""
    return plain_number(cell).try_cast(dtype)


def cell_date(cell: Column) -> Column:
    """Date of a cell that has no blanks around it."""
    first, *rest = DATE_FORMS
    out = F.when(cell.rlike(first[0]), F.try_to_date(cell, first[1]))
    for shape, fmt in rest:
        out = out.when(cell.rlike(shape), F.try_to_date(cell, fmt))
    return F.when(F.length(cell) == DATE_LENGTH, out)  # a cheap test before the patterns


def parse_number(text: Column, dtype: T.DecimalType = NUMBER) -> Column:
    """``R$ 1.234,56`` to 1234.56; blank and other text to NULL."""
    return cell_number(trimmed(text), dtype)


def parse_date(text: Column) -> Column:
    """``31/12/2024`` or ``2024-12-31`` to a date; impossible dates to NULL."""
    return cell_date(trimmed(text))


def number_text(value: Column, dtype: T.DataType) -> Column:
    """Number as text with its exact digits, without a Java style exponent.

    Binary floating point follows the shortest form that a relational database
    prints: ``5``, ``123456789``, ``1e+20``, ``1.5e-07``.
    """
    text = value.cast("string")
    if not isinstance(dtype, (T.FloatType, T.DoubleType)):
        return text
    size = F.abs(value)
    limit = 1e6 if isinstance(dtype, T.FloatType) else 1e15
    fixed = text.try_cast(T.DecimalType(38, 20)).cast("string")
    fixed = F.regexp_replace(F.regexp_replace(fixed, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    exponent = F.regexp_replace(F.regexp_replace(text, r"\.0E", "E"), r"E(\d)", "E+$1")
    exponent = F.regexp_replace(exponent, r"E([+-])(\d)$", "E$10$2")
    return (
        F.when(size == 0, F.regexp_replace(text, r"\.0$", ""))
        .when((size >= 1e-4) & (size < limit), fixed)
        .when(text.contains("E"), F.lower(exponent))
        .otherwise(F.regexp_replace(text, r"\.0$", ""))
    )
