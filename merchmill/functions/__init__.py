"""Column expressions. All are built from Spark's own functions, so they stay inside the JVM."""

from merchmill.functions.lookups import age_group, category_group, derived_age, order_status
from merchmill.functions.money import average, cents, from_cents, percent
from merchmill.functions.text import initcap_words, title_words, trim_blank
from merchmill.functions.times import day_of, timestamp_or

__all__ = [
    "age_group", "average", "category_group", "cents", "day_of", "derived_age", "from_cents",
    "initcap_words", "order_status", "percent", "timestamp_or", "title_words", "trim_blank",
]
