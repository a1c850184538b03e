"""Loan features, labels, models and monitoring expressed as Spark jobs.

Sub-packages
------------
``functions``  Column -> Column builders (cleaning, ratios, dates).
``operators``  DataFrame -> DataFrame operators (ledger, joins, encoding,
               imputation, profiling, order statistics, modelling, drift).
``sources``    reading and writing snapshot tables, models and run metadata.
``plans``      composed jobs (silver, gold, training, scoring, monitoring).
"""

__version__ = "0.1.0"
