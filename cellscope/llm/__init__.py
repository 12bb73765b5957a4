"""Operators for preparing large text corpora (scoring, dedup, packing, archives).

Nothing outside this subpackage imports it. Each module holds one operator with a general
interface; `queries` derives the registered result tables from them.
"""
