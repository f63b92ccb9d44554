"""Text expressions with Unicode-aware classes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

WORD = r"(?U)\S+"
TERM = r"[\p{L}\p{N}_]{2,}"  # runs of letters, digits and underscores


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_blank(text: Column | str) -> Column:
    """Strip Unicode white space at both ends."""
    return F.regexp_replace(_col(text), r"(?U)^\s+|\s+$", "")


def words(text: Column | str) -> Column:
    """White-space separated words."""
    return F.regexp_extract_all(_col(text), F.lit(WORD), F.lit(0))


# The characters of the property White_Space.
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def word_count(text: Column | str) -> Column:
    """Number of ``words``, without a pattern."""
    return F.size(F.array_remove(F.split(F.translate(_col(text), BLANKS, " " * len(BLANKS)), " "), ""))


def first_token(text: Column | str) -> Column:
    return F.get(words(text), 0)


def split_list(text: Column | str, separator: str = ",") -> Column:
    """Items of a separated list, stripped, blanks dropped; missing is an empty list."""
    parts = F.split(_col(text), f"\\Q{separator}\\E")
    items = F.filter(F.transform(parts, trim_blank), lambda item: item != "")
    return F.coalesce(items, F.array().cast("array<string>"))


def join_list(items: Column | str, separator: str = ", ") -> Column:
    """Items as one string; a missing or empty list gives an empty string."""
    return F.concat_ws(separator, F.coalesce(_col(items), F.array().cast("array<string>")))


def preview(text: Column | str, width: int = 200) -> Column:
    """The first ``width`` characters, for display columns only."""
    return F.substring(_col(text), 1, width)


def search_query(*parts: Column | str) -> Column:
    """Words joined by ``+`` with ampersands removed."""
    joined = F.concat_ws(" ", *[_col(p) for p in parts])
    return F.replace(F.replace(joined, F.lit("&"), F.lit("")), F.lit(" "), F.lit("+"))


def tokens(text: Column | str) -> Column:
    """Lower-case tokens of two or more word characters."""
    return F.regexp_extract_all(F.lower(_col(text)), F.lit(TERM), F.lit(0))


def ngrams(items: Column | str, n: int) -> Column:
    """Runs of ``n`` neighbouring items joined by a blank; ``items`` should be a plain column."""
    column = _col(items)
    count = F.greatest(F.size(column) - (n - 1), F.lit(0))
    grams = F.slice(column, F.lit(1), count)
    for shift in range(1, n):
        grams = F.zip_with(
            grams, F.slice(column, F.lit(shift + 1), count), lambda head, tail: F.concat_ws(" ", head, tail)
        )
    return grams


def with_terms(df: DataFrame, text: str, max_n: int = 2, out: str = "terms") -> DataFrame:
    """Add tokens and their n-grams up to ``max_n``; the tokens become a column first, so that
    the pattern runs once per text."""
    held = df.withColumn("_tokens", tokens(text))
    grams = [F.col("_tokens"), *[ngrams("_tokens", n) for n in range(2, max_n + 1)]]
    return held.withColumn(out, F.concat(*grams)).drop("_tokens")


def keyword_hits(text: Column | str, keywords: Sequence[str]) -> Column:
    """How many of ``keywords`` occur in the lower-cased text, each counted once."""
    lowered = F.lower(_col(text))
    return sum(
        (F.when(F.contains(lowered, F.lit(word)), 1).otherwise(0) for word in keywords), F.lit(0)
    )
