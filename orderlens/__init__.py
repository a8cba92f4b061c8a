"""Order analytics and return prediction as plain Spark DataFrame jobs.

``functions``  column -> column expressions
``operators``  DataFrame -> DataFrame operators
``sources``    readers, writers, scratch tables, run registry
``plans``      end-to-end jobs composed of the operators
``streaming``  continuous scoring
"""
