"""Array-column helpers for token and outcome lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def outcome_name(token_ids, outcomes, pos) -> Column:
    """Outcome label of the token at 0-based ``pos`` of ``token_ids``.

    The index into ``outcomes`` counts only the non-null tokens up to and
    including ``pos``, minus one: with ``[null, "B"]`` token ``B`` takes the
    first outcome. A negative index counts from the end, as list indexing
    does in the source; past the end gives null.
    """
    token_ids, outcomes, pos = _c(token_ids), _c(outcomes), _c(pos)
    seen = F.size(F.filter(F.slice(token_ids, 1, pos + 1), lambda x: x.isNotNull()))
    idx = seen - 1
    return F.when(idx >= 0, F.get(outcomes, idx)).otherwise(F.get(outcomes, F.size(outcomes) + idx))


def join_strings(arr, sep: str = ",") -> Column:
    """Flatten a string array to text (null array -> null) for sinks and checks."""
    return F.concat_ws(sep, _c(arr))
