"""Fleet telemetry analytics on PySpark.

Every operator is a plain ``DataFrame -> DataFrame`` function, so the same code
runs on batch tables and on streams.
"""
