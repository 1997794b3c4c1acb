"""Operators for preparing language-model training data.

Each module holds one operator with a general interface; ``queries`` registers
one query per operator.  Nothing outside this subpackage imports it, apart
from the entry file and ``corpus_pipeline`` at the repository top.
"""
