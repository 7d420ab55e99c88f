"""Column helpers and run naming."""

from tierbed.functions.columns import as_text, fill_default, output_slices
from tierbed.functions.runs import new_run_id, run_id_text, run_path

__all__ = [
    "as_text",
    "fill_default",
    "new_run_id",
    "output_slices",
    "run_id_text",
    "run_path",
]
