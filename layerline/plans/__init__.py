"""Jobs: read named datasets, transform, write named datasets."""
