"""Operators for preparing text corpora for language-model training.

Every operator takes and returns DataFrames; Spark partitions and shuffles the
work and Python runs only inside tasks, over Arrow batches.
"""
