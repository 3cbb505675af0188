"""tidemark: a PySpark toolkit for medallion-style data quality and incremental modelling.

Everything is expressed as DataFrame / Spark SQL / Structured Streaming programs;
no Python UDF is used anywhere in the library.
"""

__version__ = "0.1.0"
