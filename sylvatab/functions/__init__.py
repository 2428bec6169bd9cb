from sylvatab.functions.text import (
    mentions,
    normalise_name_case,
    paste_na,
    prints_with_zero,
    squish,
    title_genus,
)

__all__ = [
    "mentions",
    "normalise_name_case",
    "paste_na",
    "prints_with_zero",
    "squish",
    "title_genus",
]
