"""Header names and text cells."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space in the sense of Python's str.strip.
_SPACES = [chr(i) for i in range(0x3001) if chr(i).isspace()]


def canonical_name(header: str, aliases: dict[str, str]) -> str:
    """Canonical column name for a raw header, e.g. `` Sub-Category `` -> ``sub_category``."""
    joined = re.sub("[ -]+", "_", header.strip().lower())
    plain = "".join(ch for ch in joined if ch == "_" or ch.isalnum())
    return aliases.get(plain, plain)


def _padded(cell: Column) -> Column:
    """Whether white space may stand at an end: "!" follows the blank, and most cells begin in ASCII.

    Most cells also end in it, which the last byte tells without counting characters.
    """
    first = (cell < "!") | ((cell >= "\x7f") & F.left(cell, F.lit(1)).isin(_SPACES))
    byte = F.substring(cell.cast("binary"), -1, 1)
    return first | (~byte.between(F.lit(b"!"), F.lit(b"~")) & F.right(cell, F.lit(1)).isin(_SPACES))


def _bare(cell: Column) -> Column:
    return F.btrim(cell, F.lit("".join(_SPACES)))


def without_tokens(cell: Column, tokens: Iterable[str]) -> Column:
    """NULL where the whole cell is one of the missing-value tokens (case-sensitive)."""
    listed = list(tokens)
    # A length is cheaper than a look into the list.
    longer = F.octet_length(cell) > max((len(t.encode()) for t in listed), default=0)
    return F.when(longer | ~cell.isin(listed), cell)


def tidied(cell: Column, tokens: Iterable[str]) -> Column:
    """Cell without surrounding white space, NULL where what remains is one of ``tokens``.

    Trimming by a character list costs several times a look at both ends, and
    few cells need it. The stripped cell is one expression used twice, which Spark
    computes in a function of its own: the code of many columns stays small enough
    to be compiled.
    """
    bare = F.when(_padded(cell), _bare(cell)).otherwise(cell)
    return without_tokens(bare, list(tokens))
