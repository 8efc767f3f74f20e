"""Reading, writing and finding datasets."""
