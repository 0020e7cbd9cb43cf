"""Curation and export of dataset-publication link tables, written as Spark DataFrame jobs."""

from linkloom.corpus import Corpus

__all__ = ["Corpus"]
