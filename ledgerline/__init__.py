"""ledgerline: record-keeping data jobs as Spark DataFrame operators.

Every operator is a function from DataFrame(s) to DataFrame built on Spark's
own expressions, joins, windows and Structured Streaming. See README.md.
"""

__version__ = "0.1.0"
