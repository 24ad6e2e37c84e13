"""Operators that prepare text for training language models, each a Spark job.

They take a table of texts (by default columns ``doc_id`` and ``text``) and read nothing
else of it, so further columns, whatever their names, do no harm.
"""
