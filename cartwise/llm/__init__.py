"""Training-data pipeline operators.

Ten operators for preparing text corpora on Spark, their registered queries
(``queries.py``) and their SQL (``oracle.py``).  Nothing else in the library
imports this subpackage; it uses only general helpers from outside it.
"""
