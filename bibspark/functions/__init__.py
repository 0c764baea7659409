from .clean import (
    DEFAULTS,
    classify_type,
    clean_name,
    extract_year,
    normalize_authors,
    standalone_year,
    strict_year,
    with_defaults,
)
from .text import ascii_fold, snippet, strip_blanks
from .tokens import ngrams, tokens

__all__ = [
    "DEFAULTS",
    "ascii_fold",
    "classify_type",
    "clean_name",
    "extract_year",
    "ngrams",
    "normalize_authors",
    "snippet",
    "standalone_year",
    "strict_year",
    "strip_blanks",
    "tokens",
    "with_defaults",
]
