"""Row rules: name the first rule a row breaks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def first_failed(rules: Sequence[tuple[Column, str]]) -> Column:
    """Reason of the first broken rule, NULL when none is. A rule that is NULL counts as kept."""
    (broken, reason), *rest = rules
    chain = F.when(broken, reason)
    for broken, reason in rest:
        chain = chain.when(broken, reason)
    return chain
