"""Regular-expression views of the few statement shapes a command log holds.

These are column expressions over the statement text, not a parser: one
single-table INSERT, UPDATE, DELETE or DDL statement per log row. What they do
not recognise is reported by the caller, never guessed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shapes of names, literals and statements.
NAME = r'["`\[]?([A-Za-z_][A-Za-z0-9_$]*)["`\]]?'
NAME_ = NAME.replace("(", "(?:", 1)
# a schema before a table name is not kept: a device's log writes to one database
TABLE = r'(?:["`\[]?[A-Za-z_][A-Za-z0-9_$]*+["`\]]?\.)?' + NAME
# possessive repeats: nothing is tried twice, and no call depth grows with a text
LITERAL = (
    r"(?:[Xx]'[0-9A-Fa-f]*'|'[^']*+(?:''[^']*+)*+'|\?|[-+]?[0-9]+(?:\.[0-9]+)?(?:[eE][-+]?[0-9]+)?"
    r"|(?i:NULL|TRUE|FALSE))"
)
TEXT_LITERAL = r"'[^']*+(?:''[^']*+)*+'"
PAIR = NAME + r"\s*=\s*(" + LITERAL + ")"
PAIR_ = NAME_ + r"\s*=\s*" + LITERAL
SET_LIST = rf"^\s*{PAIR_}(?:\s*,\s*{PAIR_})*+\s*$"
EQUALITIES = rf"(?i)^\s*{PAIR_}(?:\s+AND\s+{PAIR_})*+\s*$"
TERM = NAME + r"\s*(<>|!=|<=|>=|=|<|>)\s*(" + LITERAL + ")"
TERM_ = NAME_ + r"\s*(?:<>|!=|<=|>=|=|<|>)\s*" + LITERAL
COMPARISONS = rf"(?i)^\s*{TERM_}(?:\s+AND\s+{TERM_})*+\s*$"
VALUE_LIST = rf"^\s*{LITERAL}(?:\s*,\s*{LITERAL})*+\s*$"

INSERT_INTO = (
    r"(?is)^\s*(INSERT|INSERT\s+OR\s+(?:REPLACE|IGNORE)|REPLACE|UPSERT)\s+INTO\s+" + TABLE + r"\s*(?:\(([^)]*)\))?\s*"
    r"VALUES\s*\((.*?)\)\s*(ON\s+CONFLICT\s*(?:\([^)]*\))?\s*DO\s+(?:UPDATE\b.*|NOTHING\s*))?;?\s*$"
)
TUPLE = r"\(\s*" + LITERAL + r"(?:\s*,\s*" + LITERAL + r")*+\s*\)"
#: A statement with several rows of values: what stands before them, the rows, and what follows.
MANY_ROWS = r"(?is)^(\s*(?:INSERT|REPLACE|UPSERT)\b[^']*?\bVALUES)\s*(" + TUPLE + r"(?:\s*,\s*" + TUPLE + r")++)\s*(.*)$"
UPDATE_SET = r"(?is)^\s*UPDATE\s+" + TABLE + r"\s+SET\s+(.*?)(?:\s+WHERE\s+(.*?))?\s*;?\s*$"
DELETE_FROM = r"(?is)^\s*DELETE\s+FROM\s+" + TABLE + r"(?:\s+WHERE\s+(.*?))?\s*;?\s*$"
TRUNCATE_TABLE = r"(?is)^\s*TRUNCATE\s+(?:TABLE\s+)?" + TABLE + r"\s*;?\s*$"
WRITTEN_TABLE = (
    r"(?i)^\s*(?:INSERT\s+(?:OR\s+(?:REPLACE|IGNORE)\s+)?INTO|REPLACE\s+INTO|UPSERT\s+INTO|UPDATE|DELETE\s+FROM"
    r"|TRUNCATE(?:\s+TABLE)?)\s+" + TABLE
)
REPLAY_TXN = r"(?i)^\s*REPLAY_TXN\s*\(?\s*([0-9]*)"

CREATE_TABLE = r"(?is)^\s*CREATE\s+TABLE\s+(?:IF\s+NOT\s+EXISTS\s+)?" + TABLE + r"\s*\((.*)\)\s*;?\s*$"
DROP_TABLE = r"(?is)^\s*DROP\s+TABLE\s+(?:IF\s+EXISTS\s+)?" + TABLE + r"\s*;?\s*$"
ALTER = r"(?is)^\s*ALTER\s+TABLE\s+" + TABLE + r"\s+"
ADD_COLUMN = ALTER + r"ADD\s+(?:COLUMN\s+)?" + NAME + r"\s+([A-Za-z]+).*$"
# what stands between a column's type and its default holds no text
ADD_DEFAULT = ALTER + r"ADD\s+(?:COLUMN\s+)?" + NAME + r"\s+[A-Za-z]+[^']*?\bDEFAULT\s*\(?\s*(" + LITERAL + r").*$"
WIDEN_COLUMN = ALTER + r"ALTER\s+(?:COLUMN\s+)?" + NAME + r"\s+(?:SET\s+DATA\s+)?(?:TYPE\s+)?([A-Za-z]+).*$"
RENAME_COLUMN = ALTER + r"RENAME\s+COLUMN\s+" + NAME + r"\s+TO\s+" + NAME + r"\s*;?\s*$"
RENAME_TABLE = ALTER + r"RENAME\s+TO\s+" + NAME + r"\s*;?\s*$"
DROP_COLUMN = ALTER + r"DROP\s+(?:COLUMN\s+)?" + NAME + r"\s*;?\s*$"
COLUMN_DEF = r"(?i)(?:^|,)\s*(?!PRIMARY\b|UNIQUE\b|CONSTRAINT\b|FOREIGN\b|CHECK\b)" + NAME + r"\s+([A-Za-z]+)"
COLUMN_DEFAULT = r"(?i)(?:^|,)\s*" + NAME + r"\s+[A-Za-z]+[^,']*?\bDEFAULT\s*\(?\s*(" + LITERAL + ")"
INLINE_KEY = r"(?i)(?:^|,)\s*" + NAME + r"\s+[A-Za-z]+(?:\([^)]*\))?\s+PRIMARY\s+KEY"
TABLE_KEY = r"(?i)(?:^|,)\s*PRIMARY\s+KEY\s*\(([^)]*)\)"


def piece(text: Column, pattern: str, group: int) -> Column:
    """Captured group, or null when the pattern does not match or captured nothing."""
    found = F.regexp_extract(text, pattern, group)
    return F.when(text.rlike(pattern) & (F.length(found) > 0), found)


SEPARATOR = "\u0001"


def groups(text: Column, pattern: str, count: int, where: Column) -> Column:
    """All groups of a pattern in one regex pass, for :func:`part`.

    Evaluated only for rows that pass the cheap test ``where``. A text that does
    not match comes back as a single piece, so every group of it is null.
    """
    joined = F.regexp_replace(text, pattern, "".join(f"{SEPARATOR}${i}" for i in range(1, count + 1)))
    return F.when(where, F.split(joined, SEPARATOR))


def matched(found: Column) -> Column:
    return F.coalesce(F.size(found) > 1, F.lit(False))


def part(found: Column, index: int) -> Column:
    """Group ``index`` (from 1) of :func:`groups`; empty captures are null."""
    return F.nullif(F.get(found, F.lit(index)), F.lit(""))


def starts_with(text: Column, *words: str) -> Column:
    """Cheap test on the first six letters of a statement."""
    first = F.upper(F.substring(F.ltrim(text), 1, 6))
    return F.coalesce(first.isin([w[:6] for w in words]), F.lit(False))


def pieces(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def names(text: Column) -> Column:
    return pieces(text, NAME, 1)


def bound_values(tokens: Column, args: Column, skipped: Column) -> Column:
    """Literal tokens as binary values; ``?`` takes the next bound argument.

    ``skipped`` is the number of arguments consumed by earlier clauses.
    """

    def convert(token: Column, index: Column) -> Column:
        marks = F.size(F.filter(F.slice(tokens, F.lit(1), index + F.lit(1)), lambda t: t == F.lit("?")))
        body = F.substring(token, F.lit(2), F.length(token) - F.lit(2))
        return (
            F.when(token == "?", F.try_element_at(args, (skipped + marks).cast("int")))
            .when(token.startswith("'"), F.replace(body, F.lit("''"), F.lit("'")).cast("binary"))
            .when(F.upper(token).startswith("X'"), F.unhex(F.substring(token, F.lit(3), F.length(token) - F.lit(3))))
            .when(F.upper(token) == "NULL", F.lit(None).cast("binary"))
            .when(F.upper(token) == "TRUE", F.lit("1").cast("binary"))
            .when(F.upper(token) == "FALSE", F.lit("0").cast("binary"))
            .otherwise(token.cast("binary"))
        )

    count = F.size(tokens)
    only_marks = (F.array_min(tokens) == "?") & (F.array_max(tokens) == "?") & (F.size(args) >= skipped + count)
    return F.when(only_marks, F.slice(args, skipped + 1, count)).otherwise(F.transform(tokens, convert))


def marks_in(tokens: Column) -> Column:
    return F.coalesce(F.size(F.filter(tokens, lambda t: t == F.lit("?"))), F.lit(0))
