"""clickmart: e-commerce event analytics expressed as Spark DataFrames.

Every building block is a function ``DataFrame -> DataFrame``.  Writing happens
only in :mod:`clickmart.sinks` and :mod:`clickmart.storage`.
"""

__version__ = "0.1.0"
