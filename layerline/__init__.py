"""Named datasets for layered batch jobs (raw -> refined -> mart) on Spark."""

from layerline import streaming  # noqa: F401  adds the stream dataset type
from layerline.sources import Dataset, RunContext, open_datasets

__all__ = ["Dataset", "RunContext", "open_datasets"]
