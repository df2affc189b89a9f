"""Operators for preparing training corpora, and their queries.

Nothing else in the library imports this package.  Every operator takes and
returns DataFrames, reads only the columns it names, and leaves other
columns (also ones with clashing names) alone.
"""
