"""Column functions of the engine, for select and filter expressions of one's own."""

from strandflow.operators.canonical import known, success_label
from strandflow.operators.dataset import assign_split, split_share
from strandflow.operators.evaluate import smooth_l1
from strandflow.operators.metrics import penalty

__all__ = ["assign_split", "known", "penalty", "smooth_l1", "split_share", "success_label"]
