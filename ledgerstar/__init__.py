"""ledgerstar: transaction analytics on Spark.

Raw transactions are cleaned, masked and shaped into a star schema
(``plans.star``), loaded with insert-if-new, type-1, type-2 and
replace-by-partition semantics (``operators.warehouse``), checked by
data-quality operators (``operators.quality``) and analysed by the queries
of ``plans.analytics``. Everything is a DataFrame plan.
"""

__version__ = "0.1.0"
