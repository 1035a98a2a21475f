"""Name derivations used by the load pipeline.

All of these are compositions of Spark SQL string functions, so they run in
the JVM and can be used in ``select``, ``filter`` or SQL alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rel_type_name(line) -> Column:
    """Line name to relationship type: upper case, then every space becomes
    ``_``, then every ``&`` becomes ``AND`` (``Blue & Gold`` -> ``BLUE_AND_GOLD``).
    """
    c = F.upper(_col(line))
    c = F.replace(c, F.lit(" "), F.lit("_"))
    return F.replace(c, F.lit("&"), F.lit("AND"))


def user_identifier(user, prefix: str) -> Column:
    """``<prefix>_<local part>`` of an e-mail style user name, with ``.`` and
    ``-`` turned into ``_`` so the result is a valid catalog identifier."""
    local = F.substring_index(_col(user), "@", 1)
    return F.concat(F.lit(prefix + "_"), F.translate(local, ".-", "__"))


def catalog_from_path(path) -> Column:
    """Second element of a ``/landing/<catalog>/<schema>/<volume>`` path."""
    trimmed = F.regexp_replace(_col(path), r"^/+|/+$", "")
    return F.split(trimmed, "/").getItem(1)


def schema_from_path(path) -> Column:
    """Third element of a ``/landing/<catalog>/<schema>/<volume>`` path."""
    trimmed = F.regexp_replace(_col(path), r"^/+|/+$", "")
    return F.split(trimmed, "/").getItem(2)
