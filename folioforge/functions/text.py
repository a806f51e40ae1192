"""Label and text normalisation as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that label cleaning maps or deletes, and the replacements of transliterated labels in their order.
TO_SPACE = ""
DELETED = " \u0010\u0009‍"
TSHEG_VARIANT, TSHEG = "༌", "་"
WYLIE_REPLACEMENTS = (
    ("\\u0f85", "&"), ("\\u0f09", "ä"), ("\\u0f13", "ö"), ("\\u0f12", "ü"), ("\\u0fd3", "@"), ("\\u0fd4", "#"), ("\\u0f00", "oM"), ("\\u0f7f", "}"),
    ("＠", "@"), ("।", "|"), ("*", " "), ("  ", " "), ("_", ""), ("[", ""), ("]", ""), (" ", "§"),
)


def clean_label(c: Column, brackets_with_content: bool = False) -> Column:
    """Private-use and invisible characters out, variants unified, brackets out (with the flag: with what they hold)."""
    c = F.translate(c, TO_SPACE + TSHEG_VARIANT + DELETED, " " + TSHEG)
    return F.regexp_replace(c, r"[\[(].*?[\])]" if brackets_with_content else r"[()]", "")


def finish_wylie_label(c: Column) -> Column:
    for old, new in WYLIE_REPLACEMENTS:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def strip(c: Column) -> Column:
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def finish_text(c: Column, drop_spaces: bool = False) -> Column:
    """Recognised text: § is a space; the evaluation path first deletes spaces that were read as such."""
    c = F.replace(c, F.lit(" "), F.lit("")) if drop_spaces else c
    return F.replace(strip(c), F.lit("§"), F.lit(" "))


def characters(c: Column) -> Column:
    return F.filter(F.split(c, ""), lambda x: x != "")


def encode_label(c: Column, charset: list[str]) -> Column:
    """1-based places in the charset; -1 for a character that it lacks. Of a symbol that the charset holds twice, the first place."""
    if all(len(s) == 1 for s in charset):
        place = lambda x: F.call_function("instr", F.lit("".join(charset)), x)
    else:
        place = lambda x: F.array_position(F.array(*map(F.lit, charset)), x)
    return F.transform(characters(c), lambda x: F.coalesce(F.nullif(place(x).cast("int"), F.lit(0)), F.lit(-1)))


def decode_label(ids: Column, charset: list[str]) -> Column:
    """The inverse; places outside 1..n are left out."""
    symbols = F.array(*map(F.lit, charset))
    inside = F.filter(ids, lambda i: (i > 0) & (i <= len(charset)))
    return F.array_join(F.transform(inside, lambda i: F.element_at(symbols, i.cast("int"))), "")


def first_line(c: Column) -> Column:
    return F.split(c, "\n", 2)[0]


def vocabulary(charset: str | list[str], add_blank: bool) -> tuple[list[str], int]:
    """A model's output symbols and the place of the blank: put first where the charset lacks one, else that of "<blk>", or of " ", or the first."""
    symbols = list(charset)
    if add_blank:
        return ["<blk>", *symbols], 0
    return symbols, next((symbols.index(b) for b in ("<blk>", " ") if b in symbols), 0)


def stacks(c: Column) -> Column:
    """Tokens of stacked script: a base letter with its subjoined letters and vowel signs; anything else one character each."""
    return F.regexp_extract_all(c, F.lit("([\\u0F40-\\u0F6C][\\u0F71-\\u0F87\\u0F8D-\\u0FBC\\u0F39]*|[^\\u0F40-\\u0F6C])"), F.lit(1))


def xml_escape(c: Column) -> Column:
    for old, new in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(old), F.lit(new))
    return c
