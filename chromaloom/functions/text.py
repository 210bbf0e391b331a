"""Names as delivered, brought to plain form; every expression stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any kind: the Unicode property White_Space and the four separators of ASCII.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0"
    "\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def trimmed(c: Column) -> Column:
    """Without white space at both ends; NULL stays NULL."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def plain(c: Column) -> Column:
    """Trimmed, in lower case."""
    return F.lower(trimmed(c))


def is_missing(c: Column) -> Column:
    """True for NULL and for strings without any letter or digit; never NULL."""
    return ~F.coalesce(c.rlike(r"[\p{L}\p{N}]"), F.lit(False))


def _number(c: Column) -> Column:
    return F.coalesce(c.try_cast("bigint").cast("string"), c)


#: Names that are in plain form but for letter case: nearly all, so that the rest's work is done for the rest.
_USUAL_SLICE = r"^[!-{}~]+\|[a-z]+\|(?:0|[1-9][0-9]{0,17})\|(?:0|[1-9][0-9]{0,17})$"


def plain_slice(c: Column) -> Column:
    """``read|pe|slice|uid`` with each part in plain form, the last two as numbers.

    A name that hasn't four parts keeps those it has, each in plain form.
    """
    c = F.lower(c)
    parts = F.split(c, r"\|")
    part = [plain(F.get(parts, F.lit(i))) for i in range(4)]
    usual = F.concat_ws("|", part[0], part[1], _number(part[2]), _number(part[3]))
    return F.when(c.rlike(_USUAL_SLICE), c).when(F.size(parts) == 4, usual).otherwise(F.array_join(F.transform(parts, plain), "|"))


# The same in SQL, for the checks against another engine.

SQL_WHITE_SPACE = "'" + WHITE_SPACE + "'"


def sql_plain(c: str) -> str:
    return f"lower(trim({c}, {SQL_WHITE_SPACE}))"


def sql_missing(c: str) -> str:
    return f"(NOT coalesce(regexp_matches({c}, '[\\p{{L}}\\p{{N}}]'), false))"


def sql_plain_slice(c: str) -> str:
    def at(i: int) -> str:
        return sql_plain(f"split_part({c}, '|', {i})")

    return f"{at(1)} || '|' || {at(2)} || '|' || CAST(CAST({at(3)} AS BIGINT) AS VARCHAR) || '|' || CAST(CAST({at(4)} AS BIGINT) AS VARCHAR)"
