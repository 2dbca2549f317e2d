"""Search keys: accents, case and punctuation taken away, so that texts can be looked up in one another."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Words that name contact and legal pages, legal forms, and words an address shares with any other.
CONTACT_WORDS = ("contact", "contactez", "telephone", "tel", "appeler", "joindre", "email", "courriel", "devis")
CONTACT_LINK_WORDS = (*CONTACT_WORDS, "nous contacter", "contact us")
LEGAL_LINK_WORDS = ("mentions legales", "mention legale", "legal notice", "informations legales", "impressum")
LEGAL_FORMS = ("sa", "sas", "sasu", "sarl", "eurl", "ei", "eirl", "scop", "scea", "selarl")
ADDRESS_STOP_WORDS = ("de", "du", "des", "la", "le", "les", "a", "au", "aux", "rue", "route", "avenue", "boulevard", "chemin", "impasse")

_OTHER = re.compile("[^a-z0-9]+")


def search_key_of(text: str | None) -> str:
    text = text or ""
    if not text.isascii():  # no ASCII character decomposes or combines
        text = "".join(c for c in unicodedata.normalize("NFKD", text) if c.isascii() or not unicodedata.combining(c))
    return _OTHER.sub(" ", text.casefold()).strip()


@F.pandas_udf(StringType())
def search_key(text: pd.Series) -> pd.Series:
    """Words of ``a-z0-9`` with single spaces; decomposing characters is what no built-in function does."""
    return text.map(search_key_of)


def has_word(key: Column, words: Iterable[str]) -> Column:
    """Whether a search key has one of ``words``: single ones as whole words, phrases anywhere."""
    single = [w for w in words if " " not in w]
    tests = [F.contains(key, F.lit(w)) for w in words if " " in w]
    if single:
        tests.append(F.arrays_overlap(F.split(key, " "), F.array(*map(F.lit, single))))
    return F.coalesce(F.greatest(*tests) if len(tests) > 1 else tests[0], F.lit(False))


def has_word_of(key: str, words: Iterable[str]) -> bool:
    tokens = set(key.split())
    return any(w in key if " " in w else w in tokens for w in words)


def name_key(key: Column) -> Column:
    """A company's search key without the legal forms at its ends, and without spaces."""
    forms = "|".join(LEGAL_FORMS)
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(key, f"^(?:(?:{forms})(?: |$))+", ""), f"(?:(?:^| )(?:{forms}))+$", ""), " ", "")


def address_words(key: Column) -> Column:
    """The words of an address's search key that tell it from others: numbers and longer words."""
    stop = F.array(*map(F.lit, ADDRESS_STOP_WORDS))
    return F.filter(F.split(key, " "), lambda w: ~F.array_contains(stop, w) & (w.rlike("^[0-9]+$") | (F.length(w) >= 4)))
