"""Readers and writers of the text formats around sequencing, by Spark's own readers."""
