"""Training-data operators.

Nothing outside this subpackage imports it; every module here stands on Spark, numpy and the
libraries its docstring names.
"""
