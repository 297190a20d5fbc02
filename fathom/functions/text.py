"""Text helpers as JVM column expressions (no Python UDFs).

* ``trigrams`` / ``trigram_similarity``: pg_trgm-style similarity. Words are
  the lower-cased alphanumeric runs; each word is padded with two spaces in
  front and one behind and cut into 3-character grams; similarity is
  |A n B| / |A u B| of the two gram sets.
* ``slug``: lower-case ASCII with '&' spelled out and dashes between words.
* ``charm_cents``: a price turned into cents ending in 99.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def words(s) -> Column:
    parts = F.split(F.lower(_c(s)), "[^a-z0-9]+")
    return F.filter(parts, lambda w: w != "")


def trigrams(s) -> Column:
    def grams(w):
        padded = F.concat(F.lit("  "), w, F.lit(" "))
        return F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: padded.substr(i, F.lit(3)))
    return F.array_distinct(F.flatten(F.transform(words(s), grams)))


def trigram_similarity(a, b) -> Column:
    ta, tb = trigrams(a), trigrams(b)
    union = F.size(F.array_union(ta, tb))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(ta, tb)) / union)


# fixed transliteration of common Latin letters with marks (input rule for slugs)
_FROM = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ"
_TO = "aaaaaaceeeeiiiinooooouuuuyy"


def slug(s) -> Column:
    x = F.lower(_c(s))
    x = F.translate(x, _FROM, _TO)
    x = F.regexp_replace(x, "&", "and")
    x = F.regexp_replace(x, "[^a-z0-9]+", "-")
    return F.regexp_replace(x, "^-+|-+$", "")


def charm_cents(price) -> Column:
    """A price as cents ending in 99: round(price) dollars minus one cent; under 5, the
    price itself in cents (at least 99). Rounding is half away from zero."""
    p = _c(price).cast("double")
    half_up = lambda v: F.floor(v + 0.5)  # noqa: E731  prices are positive
    return F.when(p < 5, F.greatest(F.lit(99), half_up(p * 100))).otherwise(half_up(p) * 100 - 1).cast("bigint")
