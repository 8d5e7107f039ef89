"""Text scalars (F-S1..F-S6, F-U1) as Column expressions.

All of them stay JVM-side: accent folding is a generated ``translate`` map
plus one guarded code-point map for the rare characters that expand to
several ASCII characters, so no Python runs per row.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rewrite rules that turn a normalized name into an entity
# key (trailing "(**)" marker, slash as dash, no spaces around dashes, one
# dash), applied in this order.
ENTITY_NAME_RULES = [
    ("\\s*\\(\\*+\\)\\s*$", ""),
    ("\\s*/\\s*", "-"),
    ("\\s*-\\s*", "-"),
    ("-{2,}", "-"),
]

# Whitespace as Python's ``re`` sees it on ASCII text (``\s`` also covers the
# four information separators); Java's and RE2's ``\s`` are narrower.
WS_CLASS = "[\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f ]"
# Every character for which Python's ``str.isspace`` is true
# (what ``str.strip()`` removes); Spark's ``trim`` removes only spaces.
PY_SPACE_CLASS = ("[\\t\\n\\x0b\\x0c\\r\\x1c-\\x1f \\x85\\xa0\\u1680\\u2000-\\u200a"
                  "\\u2028\\u2029\\u202f\\u205f\\u3000]")
NON_ASCII = "[^\\x00-\\x7F]"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


@lru_cache(maxsize=1)
def fold_tables() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition (NFKD) folded to ASCII, per code point.

    Returns ``(src, dst, multi)``: ``translate(s, src, dst)`` handles every
    character whose folded form is a single ASCII character; ``multi`` maps
    the few hundred characters that fold to several (``½`` -> ``12``).
    Characters that fold to nothing are removed by the non-ASCII sweep.
    Built once per driver from ``unicodedata``.
    """
    src, dst, multi = [], [], {}
    for cp in range(0x80, 0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        if not unicodedata.decomposition(ch):
            continue
        folded = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
        if len(folded) == 1:
            src.append(ch)
            dst.append(folded)
        elif len(folded) > 1:
            multi[ch] = folded
    return "".join(src), "".join(dst), multi


def fold_ascii(c) -> Column:
    """NFKD + drop non-ASCII, for text that is already case-mapped. Plain ASCII rows pass through untouched."""
    src, dst, multi = fold_tables()
    plain = F.octet_length(_col(c)) == F.length(_col(c))
    s = F.translate(_col(c), src, dst)
    keys = sorted(multi)
    mapping = F.create_map(*[F.lit(x) for k in keys for x in (k, multi[k])])
    expanded = F.array_join(
        F.transform(F.regexp_extract_all(s, F.lit("(?s)(.)"), 1),
                    lambda ch: F.coalesce(F.element_at(mapping, ch), ch)),
        "")
    # The per-character path only runs on rows that contain such a character.
    # Detect them with a hash-based translate (deleting them shortens the
    # text); a regex class of several hundred characters is tested linearly.
    has_multi = F.length(F.translate(s, "".join(keys), "")) != F.length(s)
    folded = F.regexp_replace(F.when(has_multi, expanded).otherwise(s), NON_ASCII, "")
    return F.when(plain, _col(c)).otherwise(folded)


def strip_ws(c) -> Column:
    """Python ``str.strip()``: remove leading/trailing Unicode whitespace."""
    return F.regexp_replace(_col(c).cast("string"), f"^{PY_SPACE_CLASS}+|{PY_SPACE_CLASS}+$", "")


def collapse_ws(c) -> Column:
    return F.trim(F.regexp_replace(_col(c), WS_CLASS + "+", " "))


def normalize_text(c) -> Column:
    """F-S1: trim, upper, NFKD, drop non-ASCII, collapse whitespace; NULL -> ''.

    For numeric input wrap the column in ``null_nan`` first so NaN is blank.
    """
    s = F.upper(_col(c).cast("string"))
    return F.coalesce(collapse_ws(fold_ascii(s)), F.lit(""))


def entity_key(normalized) -> Column:
    """The F-S2 rewrite rules applied to text that is already normalized."""
    s = _col(normalized)
    for pattern, replacement in ENTITY_NAME_RULES:
        s = F.regexp_replace(s, pattern, replacement)
    return collapse_ws(s)


def normalize_entity_name(c) -> Column:
    """F-S2: normalize_text, drop a trailing ``(***)`` marker, ``/`` -> ``-``,
    no spaces around ``-``, runs of ``-`` collapsed."""
    return entity_key(normalize_text(c))


def title_case(c) -> Column:
    """F-S3: Python ``str.title``: every run of letters is capitalised.

    ``initcap`` only starts a word after a space, so a space is appended to
    every non-letter, ``initcap`` runs, and the added spaces are removed
    again (each non-letter is followed by exactly one added space, so the
    left-to-right removal pairs them up). Three regex passes, no arrays.
    """
    spaced = F.regexp_replace(F.lower(_col(c)), "(\\P{L})", "$1 ")
    return F.regexp_replace(F.initcap(spaced), "(\\P{L}) ", "$1")


def slugify(c) -> Column:
    """F-S4: non-alphanumerics -> ``_``, strip ``_``, lower."""
    return F.lower(F.btrim(F.regexp_replace(_col(c), "[^a-zA-Z0-9_]+", "_"), F.lit("_")))


def url_host(c) -> Column:
    return F.lower(F.try_parse_url(_col(c), F.lit("HOST")))


def url_allowed(c, hosts: list[str], strict: bool = True) -> Column:
    """Scheme must be https and the host must belong to an allowed domain.

    ``strict`` requires the host to equal the domain or end with ``.domain``
    (the bare-suffix test also accepts ``evildomain.es``).
    """
    host = url_host(c)
    scheme = F.lower(F.try_parse_url(_col(c), F.lit("PROTOCOL")))
    ok = F.lit(False)
    for h in hosts:
        h = h.lower()
        if strict:
            ok = ok | (host == F.lit(h)) | host.endswith("." + h)
        else:
            ok = ok | host.endswith(h)
    return F.coalesce((scheme == F.lit("https")) & ok, F.lit(False))
