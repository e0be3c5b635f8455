"""Training-data operators: quality, mixing, tokenisation, secrets, extraction, deduplication, fingerprints.

One module per operator; ``registry`` lists the queries that apply them to the given tables. Nothing else in
the library imports this subpackage.
"""
