from touchline.operators.dense_index import dense_index
from touchline.operators.extremes import extreme_rows, extreme_rows_by
from touchline.operators.histogram import histogram
from touchline.operators.membership import present_in_all, rows_with, rows_within, rows_without
from touchline.operators.sides import outcome_counts, two_sided

__all__ = [
    "dense_index",
    "extreme_rows",
    "extreme_rows_by",
    "histogram",
    "outcome_counts",
    "present_in_all",
    "rows_with",
    "rows_within",
    "rows_without",
    "two_sided",
]
