"""Where data lives and how Spark reads and writes it."""

from layerline.sources.groups import DATASET_TYPES, DatasetGroup, DatasetType, open_datasets, read_dataset
from layerline.sources.run import RunContext
from layerline.sources.specs import Dataset

__all__ = ["DATASET_TYPES", "Dataset", "DatasetGroup", "DatasetType", "RunContext", "open_datasets", "read_dataset"]
