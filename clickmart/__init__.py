"""clickmart: shopping-behaviour analytics on Spark DataFrames.

Ranked top-k reports, distinct-buyer shares, a (user, merchant)
feature table and Spark ML repeat-buyer models over an
e-commerce click log.
"""

__version__ = "0.1.0"
