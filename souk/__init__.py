"""souk: retail analytics on Spark.

A validated load pipeline (stage, check, quarantine, publish with audit) and
parameterised reports over orders, items, customers, products and places,
written as plain DataFrame code that Catalyst optimises and Spark distributes.
"""

__version__ = "0.1.0"
