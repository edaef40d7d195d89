"""streamweave: event and sensor analytics as Spark DataFrame operators.

Every operator is a plain function over DataFrames. Bounded (batch) forms
are checked against SQL; streaming forms live in ``streamweave.streaming``.
"""

__version__ = "0.1.0"
