"""ledgerflow: card-transaction batch and streaming analytics on Spark DataFrames.

Every job is a pure ``DataFrame -> DataFrame`` function with an explicit ``as_of``
time, so results repeat and can be compared with an independent SQL oracle.
"""

__version__ = "0.1.0"
