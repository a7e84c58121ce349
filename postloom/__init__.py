"""postloom: PySpark-native processing of job-posting feeds.

Sub-packages: ``sources`` (readers and provider adapters), ``functions`` (column functions), ``operators`` (DataFrame
operators), ``plans`` (named queries), ``streaming`` (stateful stream forms) and ``llm`` (training-data operators; nothing
else in the library imports it).
"""
