"""voxloom: customer-feedback analytics as Spark DataFrame operators.

Sub-packages
------------
``functions``  Column -> Column expressions (text, labels, dates, intervals)
``operators``  DataFrame -> DataFrame operators (dedupe, metrics, sampling, ...)
``sources``    readers, sinks and adapters from source layouts to one table
``plans``      the registered queries and their SQL counterparts
"""

__version__ = "0.1.0"
