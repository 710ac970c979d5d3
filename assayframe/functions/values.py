"""Column expressions for values: missing-value words, reading text, numbers.

Spark 4 runs with ANSI mode on, so every text-to-number step goes through a
grammar check and ``try_cast``; a bad value can never fail a task.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from assayframe.functions._util import as_col
from assayframe.functions.text import jvm_trim, strip_quotes

# --- fixed values: vocabularies and grammar that must equal the original jobs
UNKNOWN = "Unknown"          # sentinel for a missing field or reading
NO_LIMIT = "NA"              # flag when a reading cannot be judged
# Words (any case) that standardise to UNKNOWN after trimming; blank too.
MISSING_WORDS = ("null", "unknown", "unknown or not stated", "n/a", "na")
# Words (any case) that make a record incomplete in a required field; blank too.
REQUIRED_REJECT_WORDS = ("unknown", "unknown or not stated")
# Profiling: reading text containing any of these (any case) is not a number.
PROFILE_REJECT_SUBSTRINGS = ("unknown", "na")
# Number grammar of a JVM Double.parseDouble on trimmed text: signed decimal
# with optional exponent, NaN, Infinity, hexadecimal with binary exponent, and
# an optional f/F/d/D suffix. Spark's own cast would also take "nan" or "inf".
JVM_DOUBLE = (
    r"^[+-]?(NaN|Infinity|("
    r"(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
    r"|0[xX]([0-9a-fA-F]+\.?[0-9a-fA-F]*|\.[0-9a-fA-F]+)[pP][+-]?\d+"
    r")[fFdD]?)\z"
)
# ---------------------------------------------------------------------------


def parse_double(text) -> Column:
    """``double`` from text that a JVM number parser accepts, else NULL.
    Leading/trailing characters <= U+0020 are ignored, as the JVM parser does."""
    t = jvm_trim(as_col(text))
    # Spark's cast is the JVM parser plus the words inf / infinity / nan in any
    # case. Each of those holds an "n", so only text with an n or N needs the
    # grammar (an anchored match yields "" otherwise, which does not cast).
    maybe_word = t.contains("n") | t.contains("N")
    return F.when(maybe_word, F.regexp_extract(t, JVM_DOUBLE, 0)).otherwise(t).try_cast("double")


def _lower_in(c: Column, words) -> Column:
    return F.lower(c).isin(*words)


def standardise_missing(c) -> Column:
    """Trimmed text; blank or a missing word (any case) becomes ``Unknown``."""
    v = jvm_trim(F.coalesce(as_col(c), F.lit("")))
    return F.when((v == "") | _lower_in(v, MISSING_WORDS), F.lit(UNKNOWN)).otherwise(v)


def clean_reading(c) -> Column:
    """Reading text: trim, strip quotes, drop thousands commas, trim again.
    Kept as text when it is a JVM number that is not negative (NaN and -0.0
    stay); otherwise ``Unknown``."""
    v = jvm_trim(F.replace(strip_quotes(jvm_trim(as_col(c))), F.lit(","), F.lit("")))
    # NULL (not a number) fails the test as well as a negative value does.
    return F.when(~(parse_double(v) < 0), v).otherwise(F.lit(UNKNOWN))


def reading_value(reading) -> Column:
    """Typed value of a cleaned reading; NULL for ``Unknown`` (or any text
    that is not a number)."""
    r = as_col(reading)
    return F.when(r != UNKNOWN, parse_double(r))


def typed_name(reading: str = "reading") -> str:
    """The column that holds the numbers of a reading column in a typed table."""
    return f"{reading}_value"


def number_of(df, reading: str = "reading") -> Column:
    """The value of each reading of ``df``, NULL where it is not known: the typed column
    where the table has one, else parsed from the text."""
    return F.col(typed_name(reading)) if typed_name(reading) in df.columns else reading_value(reading)


def profile_reading(c) -> Column:
    """Profiling's reading parser: strip quotes and commas; text that is blank
    or contains ``unknown`` or ``na`` in any case (so ``NaN`` too) is rejected;
    negatives are kept. NULL when rejected or not a number."""
    v = F.replace(strip_quotes(jvm_trim(as_col(c))), F.lit(","), F.lit(""))
    lv = F.lower(v)
    reject = F.lit(False)
    for word in PROFILE_REJECT_SUBSTRINGS:
        reject = reject | lv.contains(word)
    # Blank text does not parse, so only the word test needs its own branch.
    return F.when(~reject, parse_double(v))


def is_missing_required(c) -> Column:
    """True when a required field is blank or a reject word (any case).
    ``null``, ``n/a`` and ``na`` are not rejected here."""
    c = as_col(c)
    return (F.length(jvm_trim(c)) == 0) | _lower_in(c, REQUIRED_REJECT_WORDS)
