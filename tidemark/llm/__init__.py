"""Operators for large training-text corpora.

Nothing else in the library imports this subpackage. Every operator takes and
returns DataFrames, works on whole texts and all rows, and names the columns
it reads; other columns of its input are ignored, whatever they are called.
"""
