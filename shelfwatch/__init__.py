"""shelfwatch: Spark-native product price-history analytics.

Operators are plain DataFrame -> DataFrame functions over Spark SQL:
``sources`` (readers, the HTML extraction job, the test-table binding), ``functions``
(cleaning and display scalars), ``operators`` (snapshots, de-duplication, change
detection, analytics, search, data quality), ``sinks`` (warehouse loads), ``plans``
(reports and the registered queries) and ``streaming`` (incremental ingestion).
"""

__version__ = "0.1.0"
