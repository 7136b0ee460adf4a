"""Name features as columns."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(fn: Callable[[Column], Column], **parts: Column) -> Column:
    """``fn`` over a struct of parts that are evaluated once per row: Spark would repeat an
    expression for every place, and every element of a lambda, that mentions it."""
    return F.transform(F.array(F.struct(*[c.alias(n) for n, c in parts.items()])), fn)[0]


def _folding() -> tuple[str, str]:
    """Upper-case letters with an accent, and the same without: all that Unicode takes apart into a letter and marks."""
    pairs = {}
    for code in range(0xC0, 0x250):
        letter = chr(code).upper()
        base = unicodedata.normalize("NFD", letter)[0]
        if len(letter) == 1 and base != letter and base.isascii():
            pairs[letter] = base
    return "".join(pairs), "".join(pairs.values())


ACCENTED, PLAIN = _folding()


def normalise(name: Column) -> Column:
    """Upper case without accents, all but letters and digits of any script to blanks, single
    blanks, trimmed; empty becomes null."""
    bare = F.regexp_replace(F.translate(F.upper(name), ACCENTED, PLAIN), r"\p{M}+", "")
    plain = F.trim(F.regexp_replace(bare, r"[^\p{L}\p{N}]+", " "))
    return F.when(plain != "", plain)


def comma_flip(name: Column) -> Column:
    """"LAST,FIRST" -> "FIRST LAST"."""
    parts = F.split(name, ",")
    return F.when(F.size(parts) > 1, F.concat_ws(" ", F.trim(parts[1]), F.trim(parts[0]))).otherwise(name)


def tokens(name: Column) -> Column:
    """Words of a name; an empty list for null."""
    return F.filter(F.split(F.coalesce(name, F.lit("")), r"\s+"), lambda t: t != "")


def token_count(name: Column) -> Column:
    return F.size(tokens(name))


def token_overlap(a: Column, b: Column) -> Column:
    """Words of a that occur in b, duplicates counted."""
    return bind(lambda p: F.size(F.filter(p["a"], lambda t: F.array_contains(p["b"], t))), a=tokens(a), b=tokens(b))


def grams(name: Column, n: int) -> Column:
    last = F.length(name) - n + 1
    return F.when(last >= 1, F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(name, i, F.lit(n)))).otherwise(
        F.array().cast("array<string>"))


def ngram_score(a: Column, b: Column, n: int) -> Column:
    """n-grams of a that occur in b, over the longer list."""
    def score(p: Column) -> Column:
        longest = F.greatest(F.size(p["a"]), F.size(p["b"]))
        return F.when(longest > 0, F.size(F.filter(p["a"], lambda g: F.array_contains(p["b"], g))) / longest).otherwise(0.0)
    return bind(score, a=grams(a, n), b=grams(b, n))


def edit_ratio(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; 0 when a name is missing."""
    def ratio(p: Column) -> Column:
        longest = F.greatest(F.length(p["a"]), F.length(p["b"]))
        return F.when(p["a"].isNull() | p["b"].isNull(), 0.0).when(longest == 0, 1.0).otherwise(
            1 - F.levenshtein(p["a"], p["b"]) / longest)
    return bind(ratio, a=a, b=b)


def sorted_tokens(name: Column) -> Column:
    """Non-ASCII dropped, lower case, words in alphabetical order."""
    ascii_only = F.regexp_replace(name, r"[^\x00-\x7F]", "")
    return F.array_join(F.array_sort(tokens(F.regexp_replace(F.lower(ascii_only), r"[^0-9a-z]+", " "))), " ")


def token_sort_ratio(a: Column, b: Column) -> Column:
    return edit_ratio(sorted_tokens(a), sorted_tokens(b))


def alias_best(name: Column, aliases: Column) -> Column:
    """Best of both ratios over the ``;``-separated aliases; null without any."""
    def best(p: Column) -> Column:
        scores = F.transform(F.transform(p["aliases"], comma_flip), lambda x: F.greatest(
            edit_ratio(x, p["name"]), edit_ratio(sorted_tokens(x), p["sorted"])))
        return F.array_max(scores)
    found = bind(best, name=name, sorted=sorted_tokens(name), aliases=F.split(aliases, ";"))
    return F.when(aliases.isNotNull() & (aliases != ""), found)


def common_run(a: Column, b: Column) -> Column:
    """Length of the longest common substring. It grows by one at most with each further
    character of a, and does so if the end of a so far, one longer than the best, is in b."""
    def step(best: Column, end: Column) -> Column:
        return best + F.when(F.contains(b, F.substring(a, end - best, best + 1)), 1).otherwise(0)
    return F.aggregate(F.when(F.length(a) > 0, F.sequence(F.lit(1), F.length(a))).otherwise(F.array().cast("array<int>")), F.lit(0), step)


def subset_ratio(a: Column, b: Column) -> Column:
    """Longest common substring over the longer length; null without a name or for two empty ones."""
    def ratio(p: Column) -> Column:
        longest = F.greatest(F.length(p["a"]), F.length(p["b"]))
        return F.when(p["a"].isNotNull() & p["b"].isNotNull() & (longest > 0), common_run(p["a"], p["b"]) / longest)
    return bind(ratio, a=a, b=b)


def unique_names(names: Column) -> Column:
    """Distinct names of a ``;`` list, blanks dropped, in order of first use."""
    parts = F.transform(F.split(names, ";"), lambda x: F.trim(x))
    return F.array_join(F.array_distinct(F.filter(parts, lambda x: x != "")), ";")
