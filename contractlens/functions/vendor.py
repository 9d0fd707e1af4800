"""Vendor names."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from contractlens import fixed_values as fixed
from contractlens.functions.text import slug


def company_suffixes() -> list[str]:
    return [s.strip() for s in fixed.COMPANY_SUFFIXES.replace("\n", " ").split(",")]


def _places() -> dict[str, list[int]]:
    """First word of a suffix -> its 1-based places in the list."""
    places: dict[str, list[int]] = {}
    for place, suffix in enumerate(company_suffixes(), start=1):
        places.setdefault(suffix.split(" ")[0], []).append(place)
    return places


def _drop_suffix(name: Column, suffix: Column) -> Column:
    ending = F.concat(F.lit(" "), suffix)
    cut = F.left(name, F.length(name) - F.length(ending))
    at_end = F.when(F.endswith(name, ending), cut).otherwise(name)
    return F.replace(at_end, F.concat(ending, F.lit(" ")), F.lit(" "))


def clean_vendor_name(name: Column) -> Column:
    """Upper-case words without company suffixes. The suffix order matters.

    Only suffixes whose first word occurs in the name are walked, in list order: a
    name has none or few of them.
    """
    words = F.upper(slug(F.replace(name, F.lit("/"), F.lit(" / ")), " "))
    places = _places()
    first_words = F.array(*[F.lit(w) for w in places])
    place_of = F.create_map(
        *[x for w, at in places.items() for x in (F.lit(w), F.array(*[F.lit(i) for i in at]))]
    )
    suffixes = F.array(*[F.lit(s) for s in company_suffixes()])

    def without_suffixes(word: Column) -> Column:
        present = F.array_intersect(first_words, F.split(word, " "))
        order = F.array_sort(F.flatten(F.transform(present, lambda w: F.element_at(place_of, w))))
        walked = F.aggregate(order, word, lambda n, i: _drop_suffix(n, F.element_at(suffixes, i)))
        return F.trim(walked)

    # a one-element array lets the words be worked out once and used twice
    return F.transform(F.array(words), without_suffixes)[0]
