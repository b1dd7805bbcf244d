"""Operators of a training-data pipeline: texts in, judged or rewritten texts out."""
