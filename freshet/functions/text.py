"""Names, labels and captions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The fields of a model-run name, in order.
RUN_FIELDS = ("variable", "time_step", "GCM", "experiment", "ensemble_id", "realisation", "date_range")

# State names and their codes.
STATE_CODES = {
    "New South Wales": "NSW",
    "Victoria": "VIC",
    "Queensland": "QLD",
    "South Australia": "SA",
    "Western Australia": "WA",
    "Tasmania": "TAS",
    "Northern Territory": "NT",
    "Australian Capital Territory": "ACT",
}


def run_fields(file_name: Column) -> dict[str, Column]:
    """The seven ``_``-separated fields before the first ``.`` of a base file name."""
    parts = F.split(F.split_part(file_name, F.lit("."), F.lit(1)), "_")
    return {field: parts[i] for i, field in enumerate(RUN_FIELDS)}


def state_code(name: Column) -> Column:
    """Code of a state name, NULL for any other name."""
    code = F.lit(None).cast("string")
    for full, short in STATE_CODES.items():
        code = F.when(name == full, F.lit(short)).otherwise(code)
    return code


def letter(position: Column) -> Column:
    """A for 1, B for 2, ..., AA for 27, ..., ZZZ for 18,278; an error beyond."""
    n = position - 1

    def place(x: Column) -> Column:
        return F.char(F.lit(65) + x.cast("int") % 26)

    return (
        F.when(position < 1, F.lit(None).cast("string"))
        .when(n < 26, place(n))
        .when(n < 702, F.concat(place(F.floor(n / 26) - 1), place(n)))
        .when(n < 18278, F.concat(place(F.floor((n - 702) / 676)), place(F.floor((n - 702) / 26)), place(n - 702)))
        .when(position.isNotNull(), F.raise_error(F.lit("no letters for a place behind 18278")))
    )


def lettered_list(labels: Column) -> Column:
    """``[g1, g2, g3]`` to ``"g1 (A), g2 (B) and g3 (C)."``."""
    named = F.transform(labels, lambda x, i: F.concat(x, F.lit(" ("), letter(i + 1), F.lit(")")))
    count = F.size(named)
    head = F.when(
        count > 1, F.concat(F.array_join(F.slice(named, F.lit(1), count - 1), ", "), F.lit(" and "))
    ).otherwise(F.lit(""))
    return F.when(count > 0, F.concat(head, F.element_at(named, -1), F.lit(".")))
