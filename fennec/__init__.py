"""fennec: a Spark-native feature, encoding and ensemble library for product
records with semi-structured catalog text.

Sub-packages
------------
functions  column expressions (text extraction, measures, flags, numerics, metrics)
operators  DataFrame operators (encoders, TF-IDF, scaling, ensembles, checks)
sources    readers/writers, the catalog view over the driver tables, fitted state
plans      composite estimators and jobs (variant A / variant B feature plans)
streaming  Structured Streaming scoring with fitted state
"""

__version__ = "0.1.0"
