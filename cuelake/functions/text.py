"""Text expressions: redaction, whitespace handling and n-gram tokens.

Everything is a plain Column expression, so it stays inside the JVM and fuses
with the scan. ``\\b`` is spelled out as look-arounds because its meaning varies
with the JDK and because Java's form leaks before combining marks.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cuelake.functions.vectors import let

# The redaction vocabulary, patterns and masks.
SECRET_WORDS = [
    "password", "passcode", "pin", "ssn", "secret", "token",
    r"api[\s\x1c-\x1f]*key", r"api[\s\x1c-\x1f]*secret", "credit card", "card number",
]
SECRET_MASK = "<SECRET>"
EMAIL_MASK = "<EMAIL>"
NUM_MASK = "<NUM>"
EMAIL_PATTERN = r"(?iU)[a-z0-9._%+\-]+@[a-z0-9.\-]+\.[a-z]{2,}"
DIGITS_PATTERN = r"\d{4,}"
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"

# Unicode whitespace, with the four separators \x1c-\x1f.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000"
              "\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")
CLOSING = ".!?"

_WORD_START = r"(?<![\p{L}\p{N}_])"
_WORD_END = r"(?![\p{L}\p{N}_])"
_SPACE = r"[\s\x1c-\x1f]"
# Pieces one of which every secret word contains, and the letters outside ASCII that
# case-insensitive matching takes for s, i and k.
_SECRET_HINTS = ["pass", "pin", "ssn", "secret", "token", "api", "card"]
_FOLDED_LETTERS = ["ſ", "ı", "İ", "K"]


def _replace(c: Column, pattern: str, replacement: str) -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(replacement))


def _contains_any(c: Column, pieces: list[str]) -> Column:
    found = F.contains(c, F.lit(pieces[0]))
    for piece in pieces[1:]:
        found = found | F.contains(c, F.lit(piece))
    return found


def lowercase(c: Column) -> Column:
    return F.lower(c)


def strip(c: Column) -> Column:
    """Trim Unicode whitespace at both ends (SQL ``trim`` only removes blanks)."""
    return F.trim(c, F.lit(WHITESPACE))


def collapse_whitespace(c: Column) -> Column:
    return strip(_replace(c, rf"(?U){_SPACE}+", " "))


def strip_terminal_punct(c: Column) -> Column:
    """Drop the closing run of whitespace and ``.!?``."""
    return F.rtrim(c, F.lit(WHITESPACE + CLOSING))


def mask_secret_tail(c: Column) -> Column:
    """Keep the first secret word of each line and mask the rest of that line.

    The pattern runs only on texts with a hint of a secret word, found by plain search.
    ``let`` keeps ``c`` to one mention, so a chain of masks does not multiply when the
    optimizer inlines it.
    """
    words = "|".join(SECRET_WORDS)
    pattern = f"(?imdU){_WORD_START}({words}){_WORD_END}.*$"

    def mask(x):
        maybe = let(F.lower(x), lambda low: _contains_any(low, _SECRET_HINTS)) | _contains_any(x, _FOLDED_LETTERS)
        return F.when(maybe, _replace(x, pattern, f"$1 {SECRET_MASK}")).otherwise(x)
    return let(c, mask)


def mask_email(c: Column) -> Column:
    return let(c, lambda x: F.when(
        F.contains(x, F.lit("@")), _replace(x, EMAIL_PATTERN, EMAIL_MASK)).otherwise(x))


def mask_digits(c: Column) -> Column:
    # The look-ahead rejects a non-digit before the costlier look-behind is tried.
    return _replace(c, rf"(?U)(?=\d){_WORD_START}{DIGITS_PATTERN}{_WORD_END}", NUM_MASK)


def normalize_text(c: Column) -> Column:
    """Lowercase, closing punctuation, secrets, e-mail addresses, digit runs."""
    for step in (lowercase, strip_terminal_punct, mask_secret_tail, mask_email, mask_digits):
        c = step(c)
    return c


def drop_apostrophes(c: Column) -> Column:
    return F.replace(c, F.lit("'"), F.lit(""))


def drop_closing_punct(c: Column) -> Column:
    """Remove trailing ``.?!``, then trailing whitespace."""
    return F.rtrim(F.rtrim(c, F.lit(CLOSING)), F.lit(WHITESPACE))


def is_blank(c: Column) -> Column:
    """True for NULL or whitespace-only text."""
    return strip(F.coalesce(c, F.lit(""))) == ""


def words(c: Column) -> Column:
    """Whitespace-separated words; a blank text has one empty word."""
    return F.split(collapse_whitespace(c), " ")


def tokens(c: Column) -> Column:
    """Lowercased word tokens of two or more word characters."""
    return F.regexp_extract_all(F.lower(c), F.lit(f"({TOKEN_PATTERN})"), F.lit(1))


def pair_up(toks: Column) -> Column:
    """Adjacent token pairs joined by a blank."""
    n = F.greatest(F.size(toks) - 1, F.lit(0))
    return F.zip_with(F.slice(toks, F.lit(1), n), F.slice(toks, F.lit(2), n),
                      lambda a, b: F.concat_ws(" ", a, b))


def unigrams_and_bigrams(c: Column) -> Column:
    return let(tokens(c), lambda toks: F.concat(toks, pair_up(toks)))
