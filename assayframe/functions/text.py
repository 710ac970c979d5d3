"""Column expressions for text: JVM-style trim, quote stripping, label
normalisation and the quote-aware comma split.

Everything here returns a ``Column`` built from Spark built-ins, so it runs
inside whole-stage codegen; there is no Python on the data path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayframe.functions._util import as_col

# --- fixed values: text rules that must equal the original jobs ------------
# Characters removed by a JVM String.trim: every code point from U+0000 to U+0020.
TRIM_CHARS = "".join(chr(c) for c in range(0x21))
# Whitespace as the JVM regex class \s (ASCII): space, tab, newline, vertical tab,
# form feed, carriage return.
WHITESPACE_CLASS = " \\t\\n\\x0B\\f\\r"
# Label normalisation, applied in this order after lower-casing:
PAREN_GROUP = r"\(.*?\)"                         # 1. drop "(...)", shortest match
NOT_LABEL_CHAR = f"[^a-z0-9{WHITESPACE_CLASS}]"  # 2. keep a-z, 0-9 and whitespace
WHITESPACE_RUN = f"[{WHITESPACE_CLASS}]+"        # 4. after trim, runs become one space
QUOTE = '"'
EDGE_QUOTE = r'^"|"\z'                          # one leading, then one trailing quote
# Look-ahead split: a comma followed by an even number of quotes up to the end.
LOOKAHEAD_COMMA = ',(?=([^"]*"[^"]*")*[^"]*$)'
# ---------------------------------------------------------------------------

# Stand-ins used by the comma split; any occurrence in the input is escaped first.
_ESC = "\x1e"
_SEP = "\x1f"


def jvm_trim(c) -> Column:
    """Remove every character <= U+0020 from both ends (Spark's ``trim`` only
    removes spaces)."""
    return F.btrim(as_col(c), F.lit(TRIM_CHARS))


def strip_quotes(c) -> Column:
    """Drop one leading and then one trailing double quote, if present (a
    lone quote becomes empty)."""
    return F.regexp_replace(as_col(c), EDGE_QUOTE, "")


def normalise_text(c) -> Column:
    """Lower-case, drop parenthesised groups, keep only [a-z0-9] and whitespace,
    trim, collapse whitespace runs to one space. Non-Latin text becomes empty."""
    c = F.lower(as_col(c))
    c = F.regexp_replace(c, PAREN_GROUP, "")
    c = F.regexp_replace(c, NOT_LABEL_CHAR, "")
    c = jvm_trim(c)
    return F.regexp_replace(c, WHITESPACE_RUN, " ")


def split_csv(line) -> Column:
    """Quote-aware comma split of one line into ``array<string>``.

    A comma separates fields iff an even number of quotes follows it on the
    line. Linear-time form: split the line at quotes; the commas of the
    segment that is ``j``-th from the end (counting from 0) are separators
    iff ``j`` is even; turn those into a stand-in character, rejoin, split at
    the stand-in. Empty trailing fields
    are kept. Each field is then trimmed and loses one leading and one
    trailing quote. Doubled quotes inside a field are left as they are.
    """
    line = as_col(line)
    # Escape the two stand-in characters so they cannot collide with input.
    escaped = F.replace(F.replace(line, F.lit(_ESC), F.lit(_ESC + "e")), F.lit(_SEP), F.lit(_ESC + "s"))
    # Count segments from the end by reversing the array: the lambda then needs
    # only its own index. (A lambda that refers to an outer expression such as
    # the array size re-evaluates it for every element: quadratic per line.)
    segments_from_end = F.reverse(F.split(escaped, QUOTE, -1))
    marked = F.reverse(F.transform(
        segments_from_end,
        lambda s, i: F.when(i % 2 == 0, F.replace(s, F.lit(","), F.lit(_SEP))).otherwise(s),
    ))
    raw_fields = F.split(F.array_join(marked, QUOTE), _SEP, -1)
    return F.transform(raw_fields, lambda f: strip_quotes(jvm_trim(_unescape(f))))


def _unescape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit(_ESC + "s"), F.lit(_SEP)), F.lit(_ESC + "e"), F.lit(_ESC))


def split_csv_regex(line) -> Column:
    """The look-ahead regex form of ``split_csv`` (quadratic per line; kept
    only to cross-check the linear form and for comparison benchmarks)."""
    raw_fields = F.split(as_col(line), LOOKAHEAD_COMMA, -1)
    return F.transform(raw_fields, lambda f: strip_quotes(jvm_trim(f)))
