"""Operators for preparing training text: de-duplication, language, decontamination, packing, scoring.

Each module holds one operator with a general interface over DataFrames; ``queries`` applies them to
the test tables. Nothing outside this package imports it.
"""
