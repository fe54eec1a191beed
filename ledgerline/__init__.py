"""ledgerline: reconcile several sources of the same products into one trusted
table and derive checked figures from it, as DataFrame-to-DataFrame functions.

Subpackages:

* ``sources``   -- readers/writers by root URI (CSV, Parquet, listings) and the
                   mapping of the test tables onto the three source roles.
* ``functions`` -- column expressions (rounding, key normalisation, names).
* ``operators`` -- cleaning, deduplication, fusion, metrics, quality rules, reports.
* ``plans``     -- the staged batch run and the registry of named queries.
* ``streaming`` -- incremental landing of raw CSV drops (available-now trigger).
"""

__version__ = "0.1.0"
