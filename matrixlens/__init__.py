"""Exploring annotated matrices of any size with Spark."""

from matrixlens.components import Document, Matrix
from matrixlens.dataset import AnnotatedDataset
from matrixlens.sources.catalog import locate_datasets
from matrixlens.sources.layout import open_dataset, vacuum_dataset, write_dataset

__all__ = ["AnnotatedDataset", "Document", "Matrix", "locate_datasets", "open_dataset", "vacuum_dataset", "write_dataset"]
