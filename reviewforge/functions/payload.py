"""Payload hashing over JSON text.

The text that is hashed is the one Python's ``json.dumps(value, sort_keys=True,
ensure_ascii=False)`` writes for the parsed payload, so hashes are equal to
those of ledgers that were filled by such a writer.

It is written natively and at any depth. A Variant sorts the keys of every
object, but keeps neither the kind nor the digits of a number (``1.0`` becomes
``1``). So each number travels through it as a string with a mark, each string
with another mark, and both are written out from the sorted text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stand-ins for escaped backslashes and quotes. Raw control characters are not
# allowed in JSON, so a text that holds them is no JSON.
_BACKSLASH, _QUOTE = "\x01", "\x02"
_END = "end"
_NUMBER = r"-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"
_INTEGER = r"^-?[0-9]+$"
# A decimal of up to 15 digits is the shortest one of its double, away from the ends of the range.
_EXACT_DIGITS, _EXACT_EXPONENT = 15, 290
# Exponents that are written without "e".
_PLAIN_FROM, _PLAIN_BELOW = -4, 16


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def _masked(text: Column) -> Column:
    """JSON text in which every quote begins or ends a string."""
    no_backslashes = F.replace(text, F.lit("\\\\"), F.lit(_BACKSLASH))
    return F.replace(no_backslashes, F.lit('\\"'), F.lit(_QUOTE))


def _unmasked(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))


def _pieces(masked: Column, outside: Callable[[Column], Column], inside: Callable[[Column], Column], glue: str) -> Column:
    """Rewrite what is outside and what is inside strings. Quotes end the pieces, so every second one is a string."""
    rewritten = F.transform(F.split(masked, '"'), lambda x, i: F.when(i % 2 == 0, outside(x)).otherwise(inside(x)))
    return F.array_join(rewritten, glue)


def _mantissa(text: Column) -> Column:
    return F.regexp_extract(text, r"^-?([0-9.]+)", 1)


def _significant(text: Column) -> Column:
    """The digits of a decimal without zeros in front and behind."""
    return F.regexp_replace(F.replace(_mantissa(text), F.lit("."), F.lit("")), "^0+|0+$", "")


def _exponent(text: Column) -> Column:
    """The power of ten of a decimal's first significant digit."""
    whole = F.substring_index(_mantissa(text), ".", 1)
    digits = F.replace(_mantissa(text), F.lit("."), F.lit(""))
    zeros = F.length(F.regexp_extract(digits, "^0*", 0))
    # An exponent beyond an int ends at zero or infinity however long it is.
    said = F.coalesce(F.nullif(F.regexp_extract(text, r"[eE]([+-]?[0-9]+)$", 1), F.lit("")).try_cast("int"), F.lit(0))
    return said + F.length(whole) - F.lit(1) - zeros


def _one_digit_less(text: Column) -> Column:
    """A double's text, or one with a digit less if that is the same double: older JVMs write one too many at times."""
    digits = _significant(text)
    up = (F.right(digits, F.lit(1)) >= "5").cast("bigint")
    fewer = F.substr(digits, F.lit(1), F.length(digits) - 1).try_cast("bigint") + up
    rounded = F.concat(fewer.cast("string"), F.lit("e"), (_exponent(text) - F.length(digits) + 2).cast("string"))
    return F.when(rounded.try_cast("double") == text.try_cast("double"), rounded).otherwise(text)


def _float_text(text: Column) -> Column:
    """The shortest text of the double that a JSON decimal means, as Python writes it."""
    value = text.cast("double")
    exact = (F.length(_significant(text)) <= _EXACT_DIGITS) & (F.abs(_exponent(text)) <= _EXACT_EXPONENT)
    sign = F.when(text.startswith("-"), "-").otherwise("")

    def write(p: Column) -> Column:
        digits, at = p["digits"], p["at"]
        rest = F.substr(digits, F.lit(2))
        power = F.abs(at).cast("string")
        whole = F.concat(F.rpad(digits, at + 1, F.lit("0")), F.lit(".0"))
        cut = F.concat(F.substr(digits, F.lit(1), at + 1), F.lit("."), F.substr(digits, at + 2))
        small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -at - 1), digits)
        scientific = F.concat(
            F.substr(digits, F.lit(1), F.lit(1)),
            F.when(F.length(rest) > 0, F.concat(F.lit("."), rest)).otherwise(""),
            F.when(at < 0, "e-").otherwise("e+"),
            F.when(F.length(power) < 2, F.concat(F.lit("0"), power)).otherwise(power),
        )
        return (
            F.when(digits == "", "0.0")
            .when((at < _PLAIN_FROM) | (at >= _PLAIN_BELOW), scientific)
            .when(at < 0, small)
            .when(F.length(digits) <= at + 1, whole)
            .otherwise(cut)
        )

    shortest = F.when(exact, text).otherwise(_let(F.abs(value).cast("string"), _one_digit_less))
    written = _let(shortest, lambda t: _let(F.struct(_significant(t).alias("digits"), _exponent(t).alias("at")), write))
    return F.concat(sign, F.when(F.abs(value) == F.lit(float("inf")), "Infinity").otherwise(written))


def _number_text(text: Column) -> Column:
    integer = F.when(text == "-0", "0").otherwise(text)
    return F.when(text.rlike(_INTEGER), integer).otherwise(_float_text(text))


def _low_hex(text: Column) -> Column:
    """Escapes of control characters with small hex digits."""
    out = text
    for digit in "ABCDEF":
        for row in "01":
            out = F.replace(out, F.lit(f"\\u00{row}{digit}"), F.lit(f"\\u00{row}{digit.lower()}"))
    return F.when(F.contains(text, F.lit("\\u00")), out).otherwise(text)


def canonical_json(payload: Column) -> Column:
    """The payload's JSON text with sorted keys, ``", "`` and ``": "`` between members,
    characters beyond ASCII as they are, integers digit by digit and other
    numbers as the shortest text of their double.

    NULL when the text is no JSON or repeats a key within an object. Doubles
    given by more than 15 digits are written by the JVM, whose text of a few
    rare ones is not the nearest of the shortest before version 19. Keys are ordered by UTF-16
    units, which differs from code points only between keys with characters
    beyond U+FFFF and ones from U+E000 to U+FFFF.
    """
    marked = _pieces(
        _masked(payload),
        lambda x: F.regexp_replace(x, f"({_NUMBER})", '"n$1"'),
        lambda x: F.concat(F.lit("s"), x),
        '"',
    )
    # The parser ignores what follows a value, so the value must be followed by an
    # end that no payload can spell: its strings all begin with a mark.
    ended = F.concat(F.lit("["), _unmasked(marked), F.lit(f',"{_END}"]'))
    tidy = F.try_parse_json(F.when(~payload.rlike(f"[{_BACKSLASH}{_QUOTE}]"), ended))

    def sorted_text(v: Column) -> Column:
        text = F.to_json(v)
        inner = F.substr(text, F.lit(2), F.length(text) - F.lit(len(_END) + 5))
        return F.when(F.try_variant_get(v, "$[1]", "string") == _END, _masked(inner))

    ordered = _let(tidy, sorted_text)

    def write(text: Column) -> Column:
        out = _pieces(
            text,
            lambda x: F.replace(F.replace(x, F.lit(","), F.lit(", ")), F.lit(":"), F.lit(": ")),
            lambda x: F.when(x.startswith("n"), _number_text(F.substr(x, F.lit(2)))).otherwise(
                F.concat(F.lit('"'), _low_hex(F.substr(x, F.lit(2))), F.lit('"'))
            ),
            "",
        )
        return F.when(~text.rlike('"n[^"]*":'), _unmasked(out))  # a number is no key

    return _let(ordered, write)


def canonical_hash(payload: Column) -> Column:
    """SHA-256 (hex) of the canonical JSON: equal for payloads that differ
    only in key order or spacing.

    Applied to the landed payload it covers the fetch metadata the run adds
    (``app_id``, ``page``, ``cursor``, ``fetched_at``), so the same review
    fetched twice hashes differently; applied to the review as the API
    returned it (``content_hash``) it does not.
    """
    return F.sha2(canonical_json(payload), 256)


def content_hash(review: Column) -> Column:
    """Hash of the review object as returned by the API, before the run adds
    its fetch metadata: unchanged reviews hash the same across fetches."""
    return canonical_hash(review)
