"""Prompt-bank and dataset-curation engine on PySpark."""
