"""tidemark: landing partitioned message streams into tables and querying how far each stream has got.

Everything is a DataFrame in, DataFrame out operator, or a StreamingQuery built from them.
"""
