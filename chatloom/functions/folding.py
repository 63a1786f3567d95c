"""Case folding of columns that agrees with the case-insensitive match of a word pattern."""

import sys
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import fold_char


def fold(text: Column) -> Column:
    """``text`` with each character replaced by what case-insensitive matching compares.

    ``lower`` alone differs for a few characters (long s, Kelvin sign, dotless i, final sigma, ...),
    which are translated first.
    """
    sources, targets = _irregular()
    return F.lower(F.translate(text, sources, targets))


@cache
def _irregular() -> tuple[str, str]:
    """Characters whose fold is not their lower case, and the folds, from the case tables."""
    pairs = [
        (char, fold_char(char))
        for char in map(chr, range(sys.maxunicode + 1))
        # A capital sigma becomes one of two letters depending on what follows it.
        # Marks are not word characters and must not become letters.
        if (char.lower() != fold_char(char) or char == "Σ") and char.isalnum()
    ]
    return "".join(source for source, _ in pairs), "".join(target for _, target in pairs)
