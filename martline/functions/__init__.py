"""Column-expression helpers (the reference's scalar functions F1-F21)."""

from martline.functions import dates, numeric, text  # noqa: F401
