"""Operators of a training-data pipeline: filters, scans, deduplication, tokenization, mixing.

Nothing else in the library imports this subpackage.  Each operator lives in
one module and takes DataFrames; ``queries.py`` binds the operators to the
given tables.  Conventions shared by all operators:

* ids identify documents: rows that repeat an id are the same document;
* null texts count as empty texts, null ids sort first and compare null-safe;
* only the named id / text / key columns are read, so further columns, also
  ones named like an output column, never clash;
* an empty table gives an empty result with the documented columns.
"""
